"""Cursors over the changes of a table: restarts, lost steps, rewrites and expiry."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from siltlake.operators import dml, feed, maintenance
from siltlake.operators import changelog as log

AT = [dt.datetime(2024, 1, d) for d in range(1, 20)]
FAR = dt.datetime(2100, 1, 1)


@pytest.fixture
def table(spark, base):
    dml.create_or_replace(spark.range(20).selectExpr("id", "id * 1D AS x"), base, ["id"], at=AT[0])
    return base


def got(df):
    return sorted(tuple(r) for r in df.collect())


def test_each_change_is_seen_once(spark, table, tmp_path):
    seen = []
    handle = lambda df, low, high: seen.extend((low, high, r.change, (r.after or r.before).id) for r in df.collect())
    feed.Cursor(spark, table, "a").open()
    steps = [
        lambda: dml.delete(spark, table, "id = 3", at=AT[1]), lambda: maintenance.rewrite(spark, table, at=AT[2]),
        lambda: dml.update(spark, table, "id < 2", {"x": F.lit(9.0)}, at=AT[3]), lambda: maintenance.expire(spark, table, FAR),
        lambda: dml.append(spark.createDataFrame([(50, 1.0)], "id long, x double"), table, at=AT[4]),
    ]
    for step in steps:
        step()
        feed.follow(feed.Cursor(spark, table, "a"), handle, str(tmp_path / "ck")).awaitTermination()
    assert [s[2:] for s in sorted(seen)] == [("delete", 3), ("update", 0), ("update", 1), ("insert", 50)]
    assert not feed.Cursor(spark, table, "a").advance(handle)
    assert feed.Cursor(spark, table, "a").position() == log.load(spark, table)[-1].version


def test_a_lost_step_is_handed_out_again_between_the_same_versions(spark, table):
    cursor, tried = feed.Cursor(spark, table, "a"), []
    assert cursor.open() == 1
    dml.delete(spark, table, "id = 3", at=AT[1])

    def lost(df, low, high):
        tried.append((low, high, df.count()))
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        cursor.advance(lost)
    dml.delete(spark, table, "id = 4", at=AT[2])
    assert feed.Cursor(spark, table, "a").position() == 1
    again = feed.Cursor(spark, table, "a")
    for _ in range(2):
        assert again.advance(lambda df, low, high: tried.append((low, high, df.count())))
    assert tried == [(1, 2, 1), (1, 2, 1), (2, 3, 1)]


def test_expiry_waits_for_the_slowest_cursor(spark, table):
    for name in ("slow", "fast"):
        feed.Cursor(spark, table, name).open()
    dml.delete(spark, table, "id = 3", at=AT[1])
    dml.delete(spark, table, "id = 4", at=AT[2])
    assert feed.Cursor(spark, table, "fast").advance(lambda *a: None)
    maintenance.expire(spark, table, FAR)
    assert [c.version for c in log.live(log.load(spark, table))] == [1, 2, 3]
    seen = []
    feed.Cursor(spark, table, "slow").advance(lambda df, low, high: seen.extend(r.before.id for r in df.collect()))
    assert sorted(seen) == [3, 4]
    maintenance.expire(spark, table, FAR)
    assert [c.version for c in log.live(log.load(spark, table))] == [3]
    dml.delete(spark, table, "id = 5", at=AT[3])
    feed.Cursor(spark, table, "fast").advance(lambda *a: None)
    feed.Cursor(spark, table, "slow").close()
    maintenance.expire(spark, table, FAR)
    assert [c.version for c in log.live(log.load(spark, table))] == [4]
    with pytest.raises(ValueError, match="no cursor"):
        feed.Cursor(spark, table, "slow").advance(lambda *a: None)


def test_a_replica_follows(spark, table, tmp_path):
    target = str(tmp_path / "replica")
    handle, cursor = feed.replicate(spark, target, ["id"]), feed.Cursor(spark, table, "r")
    dml.create_or_replace(log.read_version(spark, table), target, ["id"])
    cursor.open()
    for i, step in enumerate((
        lambda: dml.update(spark, table, "id < 5", {"x": F.lit(None)}), lambda: dml.delete(spark, table, "id = 7"),
        lambda: dml.append(spark.createDataFrame([(7, 7.5), (70, None)], "id long, x double"), table),
    )):
        step()
        assert cursor.advance(handle)
        assert sorted(map(str, got_rows(spark, target))) == sorted(map(str, got_rows(spark, table)))


def got_rows(spark, base):
    return [tuple(r) for r in log.read_version(spark, base).collect()]
