"""Versioned tables: edge cases that the registered queries do not reach."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from siltlake.operators import changelog as log
from siltlake.operators import dml

AT = [dt.datetime(2024, 1, d) for d in range(1, 10)]


@pytest.fixture
def table(spark, base):
    rows = [(1, "a", 1.0), (2, "b", None), (3, None, 3.0), (4, "d", 4.0)]
    dml.create_or_replace(spark.createDataFrame(rows, "id long, name string, x double"), base, ["id"], at=AT[0])
    return base


def got(df):
    return sorted([tuple(r) for r in df.collect()], key=lambda r: r[0])


def test_null_predicates_keep_rows(spark, table):
    dml.delete(spark, table, F.col("x") > 0, at=AT[1])
    assert got(log.read_version(spark, table)) == [(2, "b", None)]
    dml.update(spark, table, "x > 0", {"name": F.lit("z")}, at=AT[2])
    assert got(log.read_version(spark, table)) == [(2, "b", None)]


def test_set_sees_the_old_row(spark, table):
    dml.update(spark, table, "id = 1", {"x": F.col("x") + 1, "name": F.concat("name", F.col("x").cast("string"))})
    assert got(log.read_version(spark, table))[0] == (1, "a1.0", 2.0)


def test_update_that_hits_nothing_is_a_version(spark, table):
    dml.update(spark, table, "id = 99", {"x": F.lit(0.0)}, at=AT[1])
    assert got(log.read_version(spark, table)) == got(log.read_version(spark, table, version=1))
    assert log.snapshots(spark, table).count() == 2


def test_deleted_key_comes_back(spark, table):
    dml.delete(spark, table, "id = 1", at=AT[1])
    new = spark.createDataFrame([(1, "again", 9.0)], "id long, name string, x double")
    commit = dml.append(new, table, at=AT[2])
    assert commit.kind == "fresh"
    assert got(log.read_version(spark, table))[0] == (1, "again", 9.0)
    dml.delete(spark, table, "name = 'again'", at=AT[3])
    assert [r[0] for r in got(log.read_version(spark, table))] == [2, 3, 4]
    assert [r[0] for r in got(log.read_version(spark, table, version=3))] == [1, 2, 3, 4]


def test_append_of_known_key_replaces(spark, table):
    new = spark.createDataFrame([(1, "new", 5.0), (7, "g", 7.0)], "id long, name string, x double")
    assert dml.append(new, table).kind == "delta"
    rows = got(log.read_version(spark, table))
    assert rows[0] == (1, "new", 5.0) and len(rows) == 5


def test_many_deltas_keep_the_newest(spark, table):
    for i in range(1, 5):
        dml.update(spark, table, "id <= 2", {"x": F.lit(float(i))}, at=AT[i])
    assert [r[2] for r in got(log.read_version(spark, table))] == [4.0, 4.0, 3.0, 4.0]
    assert [r[2] for r in got(log.read_version(spark, table, version=3))] == [2.0, 2.0, 3.0, 4.0]


def test_newest_image_may_hold_nulls(spark, table):
    dml.update(spark, table, "id = 1", {"name": F.lit("x")}, at=AT[1])
    dml.update(spark, table, "id = 1", {"name": F.lit(None).cast("string")}, at=AT[2])
    assert got(log.read_version(spark, table))[0] == (1, None, 1.0)


def test_repeated_or_null_keys_are_refused_and_leave_no_version(spark, table):
    for bad in ([(5, "x", 1.0), (5, "y", 1.0)], [(None, "x", 1.0)]):
        with pytest.raises(ValueError, match="NULL or repeated"):
            dml.append(spark.createDataFrame(bad, "id long, name string, x double"), table)
    assert log.resolve(log.load(spark, table)).version == 1
    with pytest.raises(ValueError):
        dml.update(spark, table, "id = 1", {"id": F.lit(2)})


def test_unknown_versions_and_times(spark, table, tmp_path):
    with pytest.raises(log.NoSuchVersion):
        log.read_version(spark, table, version=2)
    with pytest.raises(log.NoSuchVersion):
        log.read_version(spark, table, as_of=AT[0] - dt.timedelta(seconds=1))
    assert log.read_version(spark, table, as_of=AT[0]).count() == 4
    with pytest.raises(log.NoSuchVersion):
        log.read_version(spark, str(tmp_path / "nothing"))


def test_uncommitted_data_is_invisible(spark, table):
    head = log.load(spark, table)[-1]
    log.write_log(log.upserts(log.read_version(spark, table), head), table, 2, ())
    dml.delete(spark, table, "id = 1", at=AT[1])
    assert log.read_version(spark, table).count() == 3


def test_schema_evolution_by_version(spark, table):
    dml.add_column(spark, table, "stock", "int", at=AT[1])
    dml.update(spark, table, "id = 1", {"stock": F.lit(7)}, at=AT[2])
    dml.rename_column(spark, table, "x", "price", at=AT[3])
    dml.drop_column(spark, table, "stock", at=AT[4])
    dml.add_column(spark, table, "stock", "string", at=AT[5])
    columns = [log.read_version(spark, table, version=v).columns for v in range(1, 7)]
    assert columns == [
        ["id", "name", "x"], ["id", "name", "x", "stock"], ["id", "name", "x", "stock"],
        ["id", "name", "price", "stock"], ["id", "name", "price"], ["id", "name", "price", "stock"],
    ]
    assert got(log.read_version(spark, table, version=3))[0] == (1, "a", 1.0, 7)
    assert got(log.read_version(spark, table))[0] == (1, "a", 1.0, None)
    dml.update(spark, table, "id = 2", {"stock": F.lit("many"), "price": F.lit(2.5)}, at=AT[6])
    assert got(log.read_version(spark, table))[:2] == [(1, "a", 1.0, None), (2, "b", 2.5, "many")]
    with pytest.raises(ValueError):
        dml.drop_column(spark, table, "id")
    with pytest.raises(ValueError):
        dml.add_column(spark, table, "name", "int")


def test_renamed_key(spark, table):
    dml.rename_column(spark, table, "id", "key", at=AT[1])
    dml.delete(spark, table, "key = 1", at=AT[2])
    dml.append(spark.createDataFrame([(2, "bb", 0.0)], "key long, name string, x double"), table, at=AT[3])
    assert got(log.read_version(spark, table)) == [(2, "bb", 0.0), (3, None, 3.0), (4, "d", 4.0)]


def test_replace_changes_schema_and_keeps_history(spark, table):
    dml.create_or_replace(spark.createDataFrame([("p", 1)], "k string, v int"), table, ["k"], ["v"], at=AT[1])
    assert got(log.read_version(spark, table)) == [("p", 1)]
    assert log.read_version(spark, table, version=1).count() == 4
    dml.delete(spark, table, "k = 'p'", at=AT[2])
    assert log.read_version(spark, table).count() == 0


def test_rows_move_between_partitions(spark, base):
    rows = spark.createDataFrame([(i, "a" if i % 2 else "b") for i in range(20)], "id long, p string")
    dml.create_or_replace(rows, base, ["id"], ["p"], at=AT[0])
    dml.update(spark, base, "id < 4", {"p": F.lit("c")}, at=AT[1])
    dml.delete(spark, base, "id = 19", at=AT[2])
    dml.update(spark, base, "id = 0", {"p": F.lit(None).cast("string")}, at=AT[3])
    counts = {r.p: r["rows"] for r in log.partitions(spark, base, "p").collect()}
    assert counts == {"a": 7, "b": 8, "c": 3, None: 1}
    assert log.read_version(spark, base).where("p = 'c'").count() == 3


def test_filters_reach_the_base_scan(spark, base):
    rows = spark.range(100).select("id", (F.col("id") % 3).cast("string").alias("p"), F.rand(1).alias("x"))
    dml.create_or_replace(rows, base, ["id"], ["p"], at=AT[0])
    dml.update(spark, base, "x > 0.9", {"x": F.lit(0.0)}, at=AT[1])
    plan = log.read_version(spark, base).where("p = '1' AND x > 0.5").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "BroadcastHashJoin" in plan
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "= 1)" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "GreaterThan(x,0.5)" in scan


def test_adopted_files_are_not_copied(spark, base, tmp_path):
    path = str(tmp_path / "plain")
    spark.createDataFrame([(1, "a"), (2, "b")], "id long, p string").write.partitionBy("p").parquet(path)
    dml.adopt(spark, path, base, ["id"], ["p"], at=AT[0])
    assert not (tmp_path / "table" / "log").exists()
    dml.update(spark, base, "id = 1", {"p": F.lit("z")}, at=AT[1])
    assert got(log.read_version(spark, base)) == [(1, "z"), (2, "b")]
    assert got(log.read_version(spark, base, version=1)) == [(1, "a"), (2, "b")]
    assert log.files(spark, base).count() == 3


def test_merge(spark, table):
    source = spark.createDataFrame([(1, 10.0), (2, 20.0), (9, 90.0), (4, -1.0)], "id long, y double")
    dml.merge(
        spark, table, source, ["id"], matched_update={"x": F.col("s.y") + F.coalesce("t.x", F.lit(0.0))},
        matched_delete=F.col("s.y") < 0, insert={"x": F.col("s.y"), "name": F.lit("n")}, at=AT[1],
    )
    assert got(log.read_version(spark, table)) == [(1, "a", 11.0), (2, "b", 20.0), (3, None, 3.0), (9, "n", 90.0)]
    snap = log.snapshots(spark, table).orderBy("snapshot_id").collect()[-1]
    assert (snap.upserts, snap.deletes) == (3, 1)


def test_merge_with_fewer_clauses(spark, table):
    source = spark.createDataFrame([(1,), (9,)], "id long")
    dml.merge(spark, table, source, ["id"], matched_update={"name": F.lit("m")}, at=AT[1])
    assert got(log.read_version(spark, table))[0] == (1, "m", 1.0)
    dml.merge(spark, table, source, ["id"], insert={"name": F.lit("i")}, at=AT[2])
    assert got(log.read_version(spark, table))[-1] == (9, "i", None)
    dml.merge(spark, table, source, ["id"], matched_delete=F.lit(True), at=AT[3])
    assert [r[0] for r in got(log.read_version(spark, table))] == [2, 3, 4]


def test_merge_refuses_repeated_source_keys(spark, table):
    source = spark.createDataFrame([(1, 1.0), (1, 2.0)], "id long, y double")
    with pytest.raises(Exception, match="source repeats"):
        dml.merge(spark, table, source, ["id"], matched_update={"x": F.col("s.y")})
    assert log.resolve(log.load(spark, table)).version == 1


def test_commit_times_never_run_backwards(spark, table):
    dml.delete(spark, table, "id = 1", at=AT[0] - dt.timedelta(days=5))
    chain = log.load(spark, table)
    assert chain[1].at == chain[0].at
