"""Parquet sinks: overwrite, append, partitioned and sorted writes, CTAS."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def laid_out(df: DataFrame, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> DataFrame:
    """Rows placed for a partitioned, sorted write.

    The rebalance hint gathers a partition value into few files and lets adaptive
    execution split a value that holds much of the table, where a plain repartition on
    the partition columns would give it to one task.
    """
    if partition_by:
        # A directory cannot be named by an empty text: it would read back as NULL.
        texts = [c for c in partition_by if isinstance(df.schema[c].dataType, T.StringType)]
        df = df.withColumns({
            c: F.when(F.col(f"`{c}`") == "", F.raise_error(F.lit(f"empty text in partition column {c}")).cast("string"))
            .otherwise(F.col(f"`{c}`")) for c in texts
        })
        df = df.hint("rebalance", *[F.col(f"`{c}`") for c in partition_by])
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    return df


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    compression: str = "snappy",
) -> DataFrame:
    """Write a Parquet table and return a scan of it."""
    writer = laid_out(df, partition_by, sort_by).write.mode(mode).option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    # Partition values keep their declared types; inference would turn "007" into 7.
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ctas(df: DataFrame, table: str, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Create a catalog table from a query, with a partitioning of its own."""
    writer = laid_out(df, partition_by).write.format("parquet").mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.option("path", path).option("compression", "snappy").saveAsTable(table)
    return df.sparkSession.table(table)


def preview(df: DataFrame, key: Sequence[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows in key order, as a report prints them."""
    return df.orderBy(*key).limit(n)


def write_by_day(df: DataFrame, path: str, ts: str, day: str = "_day", mode: str = "overwrite") -> DataFrame:
    """Partition by a day derived from a timestamp column."""
    return write_table(df.withColumn(day, F.to_date(ts)), path, mode, partition_by=[day])


def read_between(spark: SparkSession, path: str, ts: str, start: str, end: str, day: str = "_day") -> DataFrame:
    """Rows of a ``write_by_day`` table with ``start <= ts < end``.

    The filter on the timestamp is repeated on the derived day, so that only the touched
    directories are read; the day column itself stays hidden from the caller.
    """
    low, high = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    return (
        spark.read.parquet(path)
        .where((F.col(day) >= low.cast("date")) & (F.col(day) <= high.cast("date")))
        .where((F.col(ts) >= low) & (F.col(ts) < high))
        .drop(day)
    )
