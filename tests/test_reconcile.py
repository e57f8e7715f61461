"""Reconciliation by checksums: whatever differs is found, and equal tables move only checksums."""

import random

import pytest
from pyspark.sql import functions as F

from siltlake.operators import quality

SCHEMA = "id long, name string, x double, d date, flag boolean, tags array<string>"


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(5000).selectExpr(
        "id", "concat('n', id % 50) AS name", "if(id % 7 = 0, NULL, id / 8) AS x", "date_add(date'2024-01-01', cast(id % 30 as int)) AS d",
        "if(id % 5 = 0, NULL, id % 2 = 0) AS flag", "if(id % 11 = 0, NULL, array('a', cast(id % 3 as string))) AS tags")
    return spark.createDataFrame(df.collect(), SCHEMA)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def same(a, b, **kw):
    assert got(quality.reconcile_digests(a, b, **kw)) == got(quality.reconcile(a, b))


NEW = {"id": "-1L", "name": "'other'", "x": "NULL", "d": "date'1999-01-01'", "flag": "NULL", "tags": "array('b')"}


@pytest.mark.parametrize("column", NEW)
@pytest.mark.parametrize("fan,leaf", [(16, 20), (4096, 10_000)])
def test_a_difference_in_any_column_is_found(rows, column, fan, leaf):
    changed = rows.withColumn(column, F.when(F.col("id") == 1234, F.expr(NEW[column])).otherwise(F.col(column)))
    found = quality.reconcile_digests(rows, changed, fan=fan, leaf_rows=leaf)
    assert sorted(r.side for r in found.collect()) == ["left", "right"]
    same(rows, changed, fan=fan, leaf_rows=leaf)


def test_repeated_and_missing_rows(rows):
    same(rows, rows.union(rows.where("id in (3, 4)")).union(rows.where("id = 4")).where("id <> 9"), fan=16, leaf_rows=20)
    # Two rows twice on one side, two others on the other: counts agree, and so would a plain XOR.
    a, b = rows.where("id < 10"), rows.where("id < 8")
    same(a.union(rows.where("id = 100")).union(rows.where("id = 100")), b.union(b.where("id < 4")).union(a.where("id >= 8")), fan=8, leaf_rows=1)


def test_nulls_in_other_places_differ(spark):
    a = spark.createDataFrame([(None, "a"), ("b", None)], "x string, y string")
    b = spark.createDataFrame([("a", None), (None, "b")], "x string, y string")
    assert quality.reconcile_digests(a, b).count() == 4


def test_order_of_columns_and_width_of_types_do_not_count(rows):
    b = rows.select("tags", F.col("name"), "d", "x", "flag", F.col("id").cast("int").alias("id"))
    assert quality.reconcile_digests(rows, b).count() == 0
    with pytest.raises(ValueError, match="different columns"):
        quality.reconcile_digests(rows, rows.drop("x"))


def test_tables_that_have_little_in_common(rows):
    same(rows, rows.withColumn("x", F.col("x") + 1), fan=8, leaf_rows=2)
    same(rows, rows.limit(0), fan=8, leaf_rows=2)
    same(rows.limit(0), rows.limit(0), fan=8, leaf_rows=2)


def test_random_differences(spark, rows):
    dice = random.Random(3)
    for _ in range(3):
        ids = dice.sample(range(5000), 5)
        same(rows, rows.withColumn("name", F.when(F.col("id").isin(ids), "z").otherwise(F.col("name"))), fan=8, leaf_rows=dice.choice([1, 30]))


def test_equal_tables_shuffle_only_checksums(spark, rows, tmp_path):
    for name in ("a", "b"):
        rows.write.parquet(str(tmp_path / name))
    a, b = (spark.read.parquet(str(tmp_path / n)) for n in ("a", "b"))
    digests = quality._unequal([a, b], 64, 1, None)
    plan = digests._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    moved = next(line for line in plan.splitlines() if "HashAggregate" in line and "partial_sum" in line)
    assert "_bucket" in moved and not any(f"{c}#" in moved.split("functions")[1] for c in ("name", "tags", "flag"))
    assert plan.index("Exchange") < plan.index("partial_sum")
    assert quality.reconcile_digests(a, b).count() == 0
