"""Data quality rules, reconciliation of two tables and table profiles."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltlake.functions.sizing import settled
from siltlake.sources.tables import STAR_TABLES, read_table


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    """Union as a balanced tree: a chain would analyse its growing plan once per member."""
    if len(parts) == 1:
        return parts[0]
    half = len(parts) // 2
    return _union(parts[:half]).unionByName(_union(parts[half:]))


def check(df: DataFrame, rules: Iterable[tuple[str, Column]]) -> DataFrame:
    """``(rule, failed_rows)`` for row rules, all in one pass; a NULL outcome fails."""
    cells = [
        F.struct(
            F.lit(name).alias("rule"),
            F.count_if(~F.coalesce(rule, F.lit(False))).alias("failed_rows"),
        )
        for name, rule in rules
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def check_unique(df: DataFrame, name: str, key: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each key."""
    return (
        df.groupBy(*key).agg(F.count("*").alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("failed_rows"))
        .select(F.lit(name).alias("rule"), "failed_rows")
    )


def check_reference(df: DataFrame, name: str, column: str, target: DataFrame, target_column: str) -> DataFrame:
    """Rows whose non-null ``column`` has no match; repeats are counted before the join."""
    used = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_k")).agg(F.count("*").alias("n"))
    known = target.select(F.col(target_column).alias("_k"))
    return (
        used.join(known, "_k", "left_anti")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failed_rows"))
        .select(F.lit(name).alias("rule"), "failed_rows")
    )


def reconcile(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows one table has more often than the other: the row, ``side`` and ``copies``.

    Both directions of a multiset difference in one shuffle: copies are counted with a sign,
    and equal rows cancel before they are moved where they meet.
    """
    if sorted(a.columns) != sorted(b.columns):
        raise ValueError("the tables have different columns")
    sign = "_sign"
    both = a.withColumn(sign, F.lit(1)).unionByName(b.withColumn(sign, F.lit(-1)))
    return (
        both.groupBy(*a.columns).agg(F.sum(sign).alias(sign)).where(F.col(sign) != 0)
        .select(
            *a.columns,
            F.when(F.col(sign) > 0, "left").otherwise("right").alias("side"),
            F.abs(sign).alias("copies"),
        )
    )


#: Buckets that a bucket of checksums is divided into, and rows of one that are compared as they are.
FAN, LEAF_ROWS = 4096, 10_000


def reconcile_digests(a: DataFrame, b: DataFrame, fan: int = FAN, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """``reconcile`` for tables that mostly agree: only checksums and the rows of unequal buckets are moved.

    Rows fall into ``fan`` buckets by a hash of all their values. A bucket's checksum is the number
    of its rows and sums of two hashes of them, which depend on no order and count repeats;
    those of both tables cancel before they are shuffled. Buckets that differ are divided again,
    until one holds about ``leaf_rows`` rows, and only rows of buckets that still differ are compared.
    A level reads both tables once more. Where more than half of the buckets differ there is
    nothing to leave out, and all rows of these are compared at once.

    Two different sets of rows have the same checksum with a chance of 2**-64 or so.
    """
    if sorted(a.columns) != sorted(b.columns):
        raise ValueError("the tables have different columns")
    # One type per column, as a union has, so that equal values have equal hashes.
    types = {f.name: f.dataType for f in a.unionByName(b).schema.fields}
    sides = [df.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) for c in a.columns]) for df in (a, b)]
    rows, depth, found = max(1, a.count()), 1, None
    while True:
        found = settled(_unequal(sides, fan, depth, found))
        differ = found.count()
        if not differ or differ > fan**depth / 2 or rows / fan**depth <= leaf_rows:
            break
        depth += 1
    first, _ = _hashes(a.columns)
    left, right = (df.join(found, F.pmod(first, F.lit(fan**depth)) == found["_bucket"], "left_semi") for df in sides)
    return reconcile(left, right)


def _hashes(columns: Sequence[str]) -> tuple[Column, Column]:
    """Two hashes of a row. A hash leaves nulls out, so each has to be told which values are null."""
    cells = [F.col(f"`{c}`") for c in columns]
    known = [c.isNotNull() for c in cells]
    return F.xxhash64(*cells, *known), F.xxhash64(F.lit("second"), *known, *cells)


def _unequal(sides: Sequence[DataFrame], fan: int, depth: int, within: DataFrame | None) -> DataFrame:
    """Buckets of a level whose checksums differ, of those whose parents do."""
    parts = []
    for df, sign in zip(sides, (1, -1)):
        first, second = _hashes(df.columns)
        hashed = df.select(first.alias("h"), second.alias("g"), F.pmod(first, F.lit(fan**depth)).alias("_bucket"))
        if within is not None:
            hashed = hashed.join(within, F.pmod("h", F.lit(fan ** (depth - 1))) == within["_bucket"], "left_semi")
        halves = [F.shiftrightunsigned(c, 32) for c in ("h", "g")] + [F.col(c).bitwiseAND(0xFFFFFFFF) for c in ("h", "g")]
        parts.append(hashed.select(
            "_bucket", F.lit(sign).cast("long").alias("n"), *[(sign * c).alias(f"s{i}") for i, c in enumerate(halves)]))
    names = ("n", "s0", "s1", "s2", "s3")
    sums = parts[0].unionByName(parts[1]).groupBy("_bucket").agg(*[F.sum(n).alias(n) for n in names])
    return sums.where(" or ".join(f"{n} <> 0" for n in names)).select("_bucket")


def profile(df: DataFrame, table: str, exact: bool = True) -> DataFrame:
    """``(table, column, type, rows, nulls, distinct)`` for every column.

    Exact counts group each column by itself: a columnar scan then reads every column once,
    and only distinct values are shuffled, where one aggregate with several distinct counts
    would copy each row once per column. Without ``exact`` a sketch per column is merged in
    one pass and nothing else is shuffled.
    """
    if exact:
        return _union([_profile_column(df, table, f) for f in df.schema.fields])
    cells = [
        F.struct(
            *_labels(table, f), F.count("*").alias("rows"),
            (F.count("*") - F.count(f"`{f.name}`")).alias("nulls"),
            F.approx_count_distinct(f"`{f.name}`").alias("distinct"),
        )
        for f in df.schema.fields
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def _labels(table: str, f: T.StructField) -> list[Column]:
    return [
        F.lit(table).alias("table"), F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
    ]


def _profile_column(df: DataFrame, table: str, f: T.StructField) -> DataFrame:
    values = df.groupBy(F.col(f"`{f.name}`").alias("v")).agg(F.count("*").alias("n"))
    zero = F.lit(0).cast("long")
    return values.agg(
        *_labels(table, f),
        F.coalesce(F.sum("n"), zero).alias("rows"),
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), zero).alias("nulls"),
        F.count("v").alias("distinct"),
    )


def describe_tables(
    spark: SparkSession, base: str | None = None, tables: Iterable[str] = STAR_TABLES, exact: bool = True
) -> DataFrame:
    """Profile of every table of a folder, or of catalog tables."""
    return _union([profile(read_table(spark, t, base), t, exact) for t in tables])


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table, rows)`` for several tables."""
    return _union(
        [df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("table"), "rows") for n, df in tables.items()]
    )
