"""Table scans, views over a star schema, schema conformance and text files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The tables of the star schema that views are registered for.
STAR_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

CORRUPT = "_corrupt_record"


def read_table(spark: SparkSession, name: str, base: str | None = None) -> DataFrame:
    """Scan a catalog table, or ``<base>/<name>.parquet`` when a folder is given."""
    return spark.table(name) if base is None else spark.read.parquet(f"{base}/{name}.parquet")


def register_views(spark: SparkSession, base: str, tables: Iterable[str] = STAR_TABLES) -> None:
    for name in tables:
        read_table(spark, name, base).createOrReplaceTempView(name)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to ``schema`` in its declared order.

    A NULL in a non-null column, or a value that does not fit its type, fails the job
    with the column's name. A number does not fit an integral or decimal type that would
    change it: 3.7 is no int. Columns the schema does not list are dropped; one that
    ``df`` lacks becomes a typed NULL, which only a nullable column accepts.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in have and not f.nullable]
    if missing:
        raise ValueError(f"non-null columns are missing: {missing}")
    out: list[Column] = []
    for f in schema.fields:
        given = F.col(f"`{f.name}`") if f.name in have else F.lit(None)
        value = given.cast(f.dataType)
        if f.name in have and _may_lose(have[f.name], f.dataType):
            value = F.when(_kept(given, have[f.name], f.dataType), value).otherwise(
                F.raise_error(F.lit(f"value of {f.name} changes as {f.dataType.simpleString()}")).cast(f.dataType)
            )
        if not f.nullable:
            value = F.coalesce(
                value, F.raise_error(F.lit(f"NULL in non-null column {f.name}")).cast(f.dataType)
            )
        out.append(value.alias(f.name))
    return df.select(*out)


def _may_lose(given: T.DataType, wanted: T.DataType) -> bool:
    """Whether a cast between two types of number may round; between texts and others it is parsing."""
    return given != wanted and isinstance(given, T.NumericType) and isinstance(wanted, (T.IntegralType, T.DecimalType))


def _kept(value: Column, given: T.DataType, wanted: T.DataType) -> Column:
    """Whether the cast value, cast back, is the value again."""
    return value.try_cast(wanted).try_cast(given).eqNullSafe(value)


def violations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows that would break ``conform``, counted per column in one pass.

    Returns ``(column, nulls, misfits)``: NULLs in non-null columns and values that the
    declared type cannot hold, or only by changing them.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    cells = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`") if f.name in have else F.lit(None)
        nulls = F.lit(0).cast("long") if f.nullable else F.count_if(c.isNull())
        lost = c.isNotNull() & c.try_cast(f.dataType).isNull()
        if f.name in have and _may_lose(have[f.name], f.dataType):
            lost = lost | ~_kept(c, have[f.name], f.dataType)
        misfit = F.count_if(lost)
        cells.append(
            F.struct(F.lit(f.name).alias("column"), nulls.alias("nulls"), misfit.alias("misfits"))
        )
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame:
    """CSV under a declared schema; a broken line keeps its text in ``_corrupt_record``."""
    return _text(spark, schema).options(**options).csv(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame:
    """JSON lines under a declared schema; a broken line keeps its text in ``_corrupt_record``."""
    return _text(spark, schema).options(**options).json(path)


def _text(spark: SparkSession, schema: T.StructType):
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(with_corrupt)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )


def split_corrupt(df: DataFrame, required: Iterable[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Split text rows into good rows and dead letters ``(value, reason)``."""
    reason = F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed"))
    for name in required:
        reason = reason.when(F.col(name).isNull(), F.lit(f"missing {name}"))
    rows = [c for c in df.columns if c != CORRUPT]
    tagged = df.withColumn("_reason", reason)
    good = tagged.where(F.col("_reason").isNull()).select(*rows)
    bad = tagged.where(F.col("_reason").isNotNull()).select(
        F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*rows))).alias("value"),
        F.col("_reason").alias("reason"),
    )
    return good, bad
