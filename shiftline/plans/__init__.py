"""Analytical queries over a ``Star`` (each returns a lazy DataFrame)."""
