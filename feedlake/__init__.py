"""Incremental reads of paged, nested records on PySpark."""
