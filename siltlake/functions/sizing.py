"""Materialising an intermediate result."""

from __future__ import annotations

from pyspark.sql import DataFrame

from siltlake.session import scratch


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once, written below the shared folder and read back with its size known.

    Adaptive execution then chooses joins by that size.
    """
    path = scratch(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
