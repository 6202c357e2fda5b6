"""Operators of a training-data pipeline.

One module per operator; ``queries.py`` applies each to its whole table and
``corpus_pipeline.py`` (repository top) chains five of them. Nothing outside
this package imports it except ``__spark_entry__.py``, behind a guard.
"""
