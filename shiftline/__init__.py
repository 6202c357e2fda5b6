"""shiftline — shift-level manufacturing analytics as Spark DataFrame jobs.

Layers:
  sources/    readers and writers (CSV, Parquet warehouse, driver fixture mapping)
  operators/  reusable DataFrame transformations (cleaning, joins, windows, splits)
  functions/  column expressions (safe division, rounding, calendar keys, measures)
  plans/      the analytical queries built from operators and functions
  streaming/  incremental (micro-batch) form of the validated ingest
"""

from shiftline.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
