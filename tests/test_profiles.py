"""Stored profiles: found by listing, read once per directory, merged by column."""

import pytest
from pyspark.sql import functions as F

from siltlake.operators.profiles import ProfileStore, discover
from siltlake.operators.quality import profile


@pytest.fixture
def folder(spark, tmp_path):
    place = tmp_path / "data"
    rows = spark.range(4000).selectExpr("id", "if(id % 10 = 0, NULL, id % 700) AS v", "concat('p', id % 3) AS p", "array(id % 5) AS a")
    rows.write.partitionBy("p").parquet(str(place / "parts.parquet"))
    rows.drop("p").write.parquet(str(place / "flat.parquet"))
    rows.limit(0).drop("p").write.parquet(str(place / "none.parquet"))
    (place / "notes.txt").write_text("no table")
    return str(place)


def test_tables_are_found_by_listing(spark, folder):
    assert discover(spark, folder) == ["flat", "none", "parts"]


def test_counts_and_estimates(spark, folder, tmp_path):
    store = ProfileStore(spark, str(tmp_path / "store"))
    assert store.update(folder) == ["flat", "none", "parts/p=p0", "parts/p=p1", "parts/p=p2"]
    got = {(r.table, r.column): r for r in store.profile(folder).collect()}
    for table in ("flat", "parts"):
        for want in profile(spark.read.parquet(f"{folder}/{table}.parquet"), table).collect():
            r = got.pop((table, want.column))
            assert (r.type, r.rows, r.nulls) == (want.type, want.rows, want.nulls)
            assert abs(r["distinct"] - want["distinct"]) <= 0.05 * want["distinct"]
    assert {(t, r.rows) for (t, _), r in got.items()} <= {("none", 0)}


def test_a_new_partition_is_read_alone(spark, folder, tmp_path):
    store = ProfileStore(spark, str(tmp_path / "store"))
    store.update(folder)
    assert store.update(folder) == []
    more = spark.range(5000, 5100).selectExpr("id", "id AS v", "array(id) AS a").withColumn("p", F.lit("p9"))
    more.write.mode("append").partitionBy("p").parquet(f"{folder}/parts.parquet")
    assert store.update(folder) == ["parts/p=p9"]
    rows = {r.column: r for r in store.profile(folder, ["parts"]).collect()}
    assert rows["id"].rows == 4100 and abs(rows["p"]["distinct"] - 4) < 1
    # A changed directory is read again and replaces what was stored of it.
    more.write.mode("append").partitionBy("p").parquet(f"{folder}/parts.parquet")
    assert store.update(folder) == ["parts/p=p9"]
    assert {r.column: r.rows for r in store.profile(folder, ["parts"]).collect()}["id"] == 4200


def test_a_directory_that_is_gone_does_not_count(spark, folder, tmp_path):
    from siltlake.session import delete_path

    store = ProfileStore(spark, str(tmp_path / "store"))
    store.update(folder)
    delete_path(spark, f"{folder}/parts.parquet/p=p0")
    rows = {r.column: r.rows for r in store.profile(folder, ["parts"]).collect()}
    assert rows["id"] == spark.read.parquet(f"{folder}/parts.parquet").count() < 4000


def test_an_empty_folder(spark, tmp_path):
    (tmp_path / "nothing").mkdir()
    store = ProfileStore(spark, str(tmp_path / "store"))
    assert store.update(str(tmp_path / "nothing")) == [] and store.profile(str(tmp_path / "nothing")).count() == 0
