"""Profiles of whatever tables a folder holds, kept as mergeable sketches per partition directory."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltlake.session import list_names

SUFFIX = ".parquet"
#: Log of the buckets of a sketch: 16 KB at most, a standard error of 0.8 %.
LOG_BUCKETS = 14

_STORED = (
    "`table` string, place string, signature string, `column` string, position int, type string, rows long, filled long, "
    "sketch binary, taken timestamp"
)


def discover(spark: SparkSession, folder: str) -> list[str]:
    """Names of the Parquet tables that lie in a folder, files or directories."""
    return sorted(n.removesuffix(SUFFIX) for n in list_names(spark, folder) if n.endswith(SUFFIX) and not n.startswith(("_", ".")))


class ProfileStore:
    """Row counts, nulls and value sketches of tables, one stored row per directory and column.

    A directory, which is a partition of a partitioned table and the table itself otherwise, is known by
    number, size and age of its files. ``update`` lists the files and reads only directories that are
    new or changed; ``profile`` merges what is stored of those that are there.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def _places(self, folder: str, table: str) -> DataFrame:
        """``(place, signature)`` of the directories of a table; files are listed, not opened."""
        root = f"{folder.rstrip('/')}/{table}{SUFFIX}"
        listed = (
            self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{SUFFIX}")
            .load(root).select("path", "length", "modificationTime")
        )
        age = F.max("modificationTime").cast("double").cast("string")
        return listed.groupBy(_place(F.col("path"), table).alias("place")).agg(
            F.concat_ws("/", F.count("*"), F.sum("length"), age).alias("signature")).select(F.lit(table).alias("table"), "*")

    def _stored(self) -> DataFrame:
        try:
            return self.spark.read.schema(_STORED).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return self.spark.createDataFrame([], _STORED)
            raise

    def update(self, folder: str, tables: Iterable[str] | None = None) -> list[str]:
        """Read the directories that are new or changed and store their profiles; returns these."""
        names, read = list(tables) if tables is not None else discover(self.spark, folder), []
        for table in names:
            known = self._stored().select("table", "place", "signature").distinct()
            new = self._places(folder, table).join(known, ["table", "place", "signature"], "left_anti")
            found = {r.place: r.signature for r in new.collect()}  # directories that came since the last time
            if found:
                self._read(folder, table, found).write.mode("append").parquet(self.path)
                read += [f"{table}{place}" for place in sorted(found)]
        return read

    def _read(self, folder: str, table: str, found: dict[str, str]) -> DataFrame:
        """One pass over some directories: a row per directory and column."""
        root = f"{folder.rstrip('/')}/{table}{SUFFIX}"
        reader = self.spark.read
        if set(found) != {""}:
            reader = reader.option("basePath", root)
        rows = reader.parquet(*[root + place for place in sorted(found)])
        rows = rows.withColumn("_place", _place(F.col("_metadata.file_path"), table))
        fields = [f for f in rows.schema.fields if f.name != "_place"]
        cells = [
            F.struct(
                F.lit(f.name).alias("column"), F.lit(i).alias("position"), F.lit(f.dataType.simpleString()).alias("type"),
                F.count("*").alias("rows"), F.count(f"`{f.name}`").alias("filled"),
                F.hll_sketch_agg(_text(f), LOG_BUCKETS).alias("sketch"))
            for i, f in enumerate(fields)
        ]
        held = rows.groupBy("_place").agg(F.array(*cells).alias("cells")).select("_place", F.inline("cells"))
        # A directory without rows is stored too, as one without columns.
        known = self.spark.createDataFrame(list(found.items()), "place string, signature string")
        return known.join(held, F.col("place") == F.col("_place"), "left").select(
            F.lit(table).alias("table"), "place", "signature", "column", "position", "type",
            "rows", "filled", "sketch", F.current_timestamp().alias("taken"))

    def profile(self, folder: str, tables: Iterable[str] | None = None) -> DataFrame:
        """``(table, column, type, rows, nulls, distinct)`` of tables as they were updated last.

        ``distinct`` is an estimate. Directories that are gone since do not count, nor do those not read yet.
        """
        names, out = list(tables) if tables is not None else discover(self.spark, folder), None
        for table in names:
            here = self._places(folder, table)
            out = here if out is None else out.unionByName(here)
        if out is None:
            out = self.spark.createDataFrame([], "`table` string, place string, signature string")
        stored = self._stored().dropDuplicates(["table", "place", "signature", "column"])
        return (
            stored.where(F.col("column").isNotNull()).join(out, ["table", "place", "signature"], "left_semi").groupBy("table", "column", "position", "type")
            .agg(
                F.sum("rows").alias("rows"), (F.sum("rows") - F.sum("filled")).alias("nulls"),
                F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).alias("distinct"))
            .drop("position")
        )


def _place(path: Column, table: str) -> Column:
    """The directory below the table's own, empty for the table itself."""
    return F.regexp_extract(path, rf"/{table}{SUFFIX.replace('.', '[.]')}((?:/[^/]+=[^/]*)*)(?:/[^/]*)?$", 1)


def _text(f: T.StructField) -> Column:
    """A value as text, of which sketches are made."""
    cell = F.col(f"`{f.name}`")
    nested = isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))
    return F.to_json(cell) if nested else cell.cast("string")
