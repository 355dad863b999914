"""Trace analytics on PySpark: TraceQL search, metrics, structure and tags over span DataFrames."""
