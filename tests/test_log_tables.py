"""Tables without a key, small files, dropped ranges and the commits data set."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from siltlake.operators import cdc, dml, maintenance
from siltlake.operators import changelog as log

AT = [dt.datetime(2024, 1, d) for d in range(1, 20)]
DAY = dt.date(2024, 3, 1)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def files(base):
    """Path and time of every data file."""
    out = {}
    for place, _, names in os.walk(f"{base}/log"):
        out |= {f"{place}/{n}": os.stat(f"{place}/{n}").st_mtime_ns for n in names if n.endswith(".parquet")}
    return out


def days(spark, low, high, per_day=10):
    """Rows of some days from ``DAY`` on."""
    d = F.date_add(F.lit(DAY), F.expr(f"cast(id div {per_day} as int)"))
    return spark.range(low * per_day, high * per_day, 1, 1).select("id", d.alias("d"), (F.col("id") % 3).cast("string").alias("k"))


@pytest.fixture
def events(spark, base):
    """A log of ten days, one batch a day, and the first day once more."""
    dml.create_log(spark, base, days(spark, 0, 1).schema, ["d"], at=AT[0])
    for i in range(10):
        dml.append(days(spark, i, i + 1), base, at=AT[i + 1], writer="w", batch=i)
    dml.append(days(spark, 0, 1), base, at=AT[11], writer="w", batch=10)
    return base


def test_rows_of_a_log_may_repeat_and_batches_may_not(spark, events):
    assert log.read_version(spark, events).count() == 110
    again = dml.append(days(spark, 3, 4), events, writer="w", batch=3)
    assert again.version == 5 and log.read_version(spark, events).count() == 110
    assert dml.append(days(spark, 3, 4), events, writer="v", batch=3).version == 13
    assert log.read_version(spark, events, version=1).count() == 0
    assert log.read_version(spark, events, as_of=AT[2]).count() == 20


def test_a_log_takes_appends_only(spark, events):
    for change in (lambda: dml.delete(spark, events, "id = 1"), lambda: dml.update(spark, events, "id = 1", {"k": F.lit("x")}),
                   lambda: dml.merge(spark, events, days(spark, 0, 1), ["id"])):
        with pytest.raises(ValueError, match="appends only"):
            change()


def test_retention_hides_and_expiry_removes(spark, events):
    before = files(events)
    maintenance.apply_retention(spark, events, "d", 4, at=AT[12])
    assert files(events) == before
    assert got(log.read_version(spark, events)) == got(days(spark, 6, 10))
    assert log.read_version(spark, events, version=12).count() == 110
    plan = log.read_version(spark, events).where("k = '1'")._jdf.queryExecution().executedPlan().toString()
    assert "isnull(d" in plan.split("PartitionFilters")[1].split("PushedFilters")[0] or "d#" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    # Rows that come later are kept, whatever their day.
    dml.append(days(spark, 1, 2), events, at=AT[13])
    assert got(log.read_version(spark, events)) == got(days(spark, 6, 10).union(days(spark, 1, 2)))
    maintenance.expire(spark, events, AT[12])
    assert got(log.read_version(spark, events)) == got(days(spark, 6, 10).union(days(spark, 1, 2)))
    assert len(files(events)) == 5 and set(files(events)) & set(before) == {f for f in before if f.split("/d=")[1][:10] >= "2024-03-07"}
    assert {r.d for r in log.partitions(spark, events, "d").collect()} == {DAY + dt.timedelta(days=i) for i in (1, 6, 7, 8, 9)}


def test_retention_that_drops_nothing_is_no_version(spark, events):
    assert maintenance.apply_retention(spark, events, "d", 10).version == 12
    assert maintenance.apply_retention(spark, events, "d", 4, as_of=DAY).version == 12
    with pytest.raises(ValueError, match="no date"):
        maintenance.apply_retention(spark, events, "k", 4)
    with pytest.raises(ValueError, match="range is"):
        dml.drop_range(spark, events, "d", ">", DAY)


def test_the_widest_range_counts(spark, events):
    for bound in (5, 3, 6):
        dml.drop_range(spark, events, "d", "<", DAY + dt.timedelta(days=bound))
    chain = log.load(spark, events)
    assert log.drops_after(chain, chain[1], chain[-1]) == (("d", "<", "2024-03-07"),)
    assert got(log.read_version(spark, events)) == got(days(spark, 6, 10))
    numbers = spark.range(30).withColumn("n", F.col("id").cast("int"))
    base = events + "-n"
    dml.create_or_replace(numbers, base, ["id"], ["n"])
    dml.drop_range(spark, base, "n", "<", 9)
    dml.drop_range(spark, base, "n", "<", 10)
    dml.drop_range(spark, base, "n", "=", 20)
    assert log.read_version(spark, base).count() == 19


def test_retention_of_a_table_with_changes(spark, base):
    rows = days(spark, 0, 10)
    dml.create_or_replace(rows, base, ["id"], ["d"], at=AT[0])
    # Row 5 moves to a late day and row 95 to an early one; row 97 is changed in place.
    dml.update(spark, base, "id = 5", {"d": F.lit(DAY + dt.timedelta(days=9))}, at=AT[1])
    dml.update(spark, base, "id = 95", {"d": F.lit(DAY)}, at=AT[2])
    dml.update(spark, base, "id = 97", {"k": F.lit("new")}, at=AT[3])
    maintenance.apply_retention(spark, base, "d", 4, at=AT[4])
    want = sorted([*range(60, 95), *range(96, 100), 5])
    assert sorted(r.id for r in log.read_version(spark, base).collect()) == want
    dml.append(days(spark, 0, 1), base, at=AT[5])  # dropped keys come back
    dml.delete(spark, base, "id = 98", at=AT[6])
    assert sorted(r.id for r in log.read_version(spark, base).collect()) == sorted({*want, *range(10)} - {98})
    now = got(log.read_version(spark, base))
    maintenance.rewrite(spark, base, at=AT[7])
    assert got(log.read_version(spark, base)) == now
    maintenance.expire(spark, base, AT[7])
    assert got(log.read_version(spark, base)) == now


@pytest.mark.parametrize("v1,v2", [(1, 12), (3, 13), (12, 14), (13, 15), (2, 15), (15, 2), (13, 13)])
def test_changes_of_a_log(spark, events, v1, v2):
    maintenance.apply_retention(spark, events, "d", 4, at=AT[12])  # 13
    dml.append(days(spark, 1, 2), events, at=AT[13])  # 14
    maintenance.rewrite(spark, events, at=AT[14])  # 15
    changed = cdc.changes(spark, events, v1, v2)
    gone = changed.where("change = 'delete'").select("before.*")
    come = changed.where("change = 'insert'").select("after.*")
    a, b = (log.read_version(spark, events, version=v) for v in (v1, v2))
    assert got(a.exceptAll(gone).unionAll(come)) == got(b)
    assert changed.count() == gone.count() + come.count()


@pytest.mark.parametrize("v1,v2", [(1, 4), (2, 5), (3, 5), (1, 6), (6, 1)])
def test_changes_of_a_table_over_a_dropped_range(spark, base, v1, v2):
    dml.create_or_replace(days(spark, 0, 10), base, ["id"], ["d"], at=AT[0])
    dml.update(spark, base, "id = 5", {"d": F.lit(DAY + dt.timedelta(days=9))}, at=AT[1])
    dml.update(spark, base, "id in (7, 95)", {"k": F.lit("z")}, at=AT[2])
    maintenance.apply_retention(spark, base, "d", 4, at=AT[3])
    dml.append(days(spark, 0, 1), base, at=AT[4])
    maintenance.rewrite(spark, base, fold=True, at=AT[5])
    changed = cdc.changes(spark, base, v1, v2)
    a, b = (log.read_version(spark, base, version=v) for v in (v1, v2))
    gone = changed.where("before is not null").select("before.*")
    come = changed.where("after is not null").select("after.*")
    assert got(a.exceptAll(gone).unionAll(come)) == got(b)


def test_expiry_of_a_log_writes_no_data(spark, events):
    before = files(events)
    maintenance.expire(spark, events, AT[9])
    assert files(events) == before
    assert log.read_version(spark, events).count() == 110
    assert log.read_version(spark, events, version=10).count() == 90
    with pytest.raises(log.NoSuchVersion):
        log.read_version(spark, events, version=9)
    assert [r.snapshot_id for r in log.snapshots(spark, events).orderBy("snapshot_id").collect()] == [10, 11, 12]


def test_small_files_go_together_and_others_stay(spark, base):
    big = spark.range(0, 40_000, 1, 1).selectExpr("id", "cast(null as date) AS d", "cast(rand(7) as string) AS k")
    dml.create_or_replace(big, base, ["id"], at=AT[0])
    before = files(base)
    size = max(os.path.getsize(f) for f in before)
    for i in range(6):
        dml.append(spark.range(50_000 + i * 10, 50_010 + i * 10, 1, 1).selectExpr("id", "cast(null as date) AS d", "'x' AS k"), base, at=AT[i + 1])
    rows = got(log.read_version(spark, base))
    old = got(log.read_version(spark, base, version=4))
    maintenance.rewrite(spark, base, target_mb=size / 1024 / 1024, at=AT[8])
    head = log.load(spark, base)[-1]
    assert (head.kind, head.merged) == ("fresh", (2, 3, 4, 5, 6, 7))
    assert {f: t for f, t in files(base).items() if f in before} == before
    assert got(log.read_version(spark, base)) == rows and got(log.read_version(spark, base, version=4)) == old
    assert {r.file_path.removeprefix("file://").removeprefix("file:") for r in log.files(spark, base).collect()} >= set(before)
    assert log.files(spark, base).count() == 2
    # Nothing more to gain.
    assert maintenance.rewrite(spark, base, target_mb=size / 1024 / 1024).version == head.version
    # The small ones go with the versions that read them.
    maintenance.expire(spark, base, AT[8])
    assert len(files(base)) == 2 and got(log.read_version(spark, base)) == rows


def test_small_files_of_a_partition_go_together(spark, events):
    rows = got(log.read_version(spark, events))
    before = files(events)
    maintenance.rewrite(spark, events, at=AT[12])
    # Only the first day stands in two directories; the others would gain nothing.
    head = log.load(spark, events)[-1]
    assert head.merged == (2, 12) and got(log.read_version(spark, events)) == rows
    new = set(files(events)) - set(before)
    assert len(new) == 1 and "/d=2024-03-01/" in next(iter(new))
    assert {r.d: r.files for r in log.partitions(spark, events, "d").collect()} == {DAY + dt.timedelta(days=i): 1 for i in range(10)}


def test_changes_of_rows_are_folded_into_one_directory(spark, base):
    big = spark.range(0, 40_000, 1, 1).selectExpr("id", "cast(rand(7) as string) AS k")
    dml.create_or_replace(big, base, ["id"], at=AT[0])
    before = files(base)
    for i in range(4):
        dml.update(spark, base, f"id < {20 - i}", {"k": F.lit(f"v{i}")}, at=AT[i + 1])
    dml.delete(spark, base, "id = 3", at=AT[5])
    rows = got(log.read_version(spark, base))
    size = max(os.path.getsize(f) for f in before)
    maintenance.rewrite(spark, base, target_mb=size / 1024 / 1024, at=AT[6])
    chain = log.load(spark, base)
    plain, deltas = log.members(chain, chain[-1])
    assert [c.version for c in plain] == [1] and [c.merged for c in deltas] == [(2, 3, 4, 5, 6)]
    assert got(log.read_version(spark, base)) == rows
    dml.append(spark.createDataFrame([(3, "back")], "id long, k string"), base, at=AT[7])
    assert log.read_version(spark, base).where("id = 3").first().k == "back"
    assert cdc.changes(spark, base, 6, 7).count() == 0 and cdc.changes(spark, base, 2, 8).count() == 19
    maintenance.rewrite(spark, base, target_mb=size / 1024 / 1024, fold=True, at=AT[8])
    assert log.members(log.load(spark, base), log.load(spark, base)[-1])[1] == []
    assert len(got(log.read_version(spark, base))) == 40_000


def test_commits_are_folded(spark, events):
    def held():
        return len([f for f in os.listdir(f"{events}/commits") if f.endswith(".parquet")])

    want, rows = got(log.snapshots(spark, events)), got(log.read_version(spark, events))
    assert held() == 12
    log.fold_commits(spark, events)
    assert held() == 1 and got(log.snapshots(spark, events)) == want and got(log.read_version(spark, events)) == rows
    maintenance.rewrite(spark, events, at=AT[12])
    maintenance.apply_retention(spark, events, "d", 4, at=AT[13])
    dml.append(days(spark, 20, 21), events, at=AT[14], writer="w", batch=11)
    dml.append(days(spark, 20, 21), events, at=AT[15], writer="other", batch=0)
    rows = got(log.read_version(spark, events))
    maintenance.expire(spark, events, AT[15])
    assert held() == 1 and got(log.read_version(spark, events)) == rows
    # Gone with their data are the commits that were put together; a writer's last batch is still known.
    assert log.committed(log.load(spark, events), "w", 11) and not log.committed(log.load(spark, events), "w", 0)
    assert dml.append(days(spark, 20, 21), events, writer="w", batch=11).version == 15


def test_columns_come_and_types_stay(spark, events):
    schema = log.read_version(spark, events).schema
    assert dml.create_log(spark, events, schema, ["d"]).version == 12
    wider = dml.create_log(spark, events, schema.add("x", "integer"), ["d"])
    assert wider.version == 13 and log.read_version(spark, events).columns == ["id", "d", "k", "x"]
    with pytest.raises(ValueError, match="other types"):
        dml.create_log(spark, events, spark.range(1).selectExpr("id", "'a' AS d").schema, ["d"])
    with pytest.raises(ValueError, match="partitions"):
        dml.create_log(spark, events, schema, ["k"])
