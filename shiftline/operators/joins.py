"""Whether the planner broadcasts a join side, from its own size estimate."""

from __future__ import annotations

from pyspark.sql import DataFrame


def plan_broadcasts(df: DataFrame) -> bool:
    """True when the optimizer's size in bytes is within the session's broadcast threshold.

    Reads plan statistics (file sizes for stored tables); no job runs. Used
    to choose between plans, never to put a hint on one: at run time the
    planner and AQE still decide each join by its measured size.
    """
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= conf.autoBroadcastJoinThreshold()
