"""Lakehouse analytics on plain Parquet, written as ordinary Spark jobs.

``sources`` and ``sinks`` read, generate and write tables, ``plans`` holds the
analytics questions, ``operators`` the versioned tables, maintenance and checks,
``streaming`` the config-driven log ingest and ``functions`` shared expressions.
"""
