"""Readers and writers: CSV files, the Parquet warehouse and the test-data mapping."""
