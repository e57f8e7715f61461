"""Hidden partitions: derived from a column, pruned by what is asked of it, and in no result."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from siltlake.operators import cdc, dml, maintenance
from siltlake.operators import changelog as log

AT = [dt.datetime(2024, 1, d) for d in range(1, 20)]
START = dt.datetime(2024, 2, 27)


@pytest.fixture(params=["timestamp_ntz", "timestamp", "date"])
def events(spark, base, request):
    """Ten days of hourly events and one without a time."""
    ts = F.when(F.col("id") > 0, F.lit(START) + F.make_interval(hours=F.col("id").cast("int"))).cast(request.param)
    rows = spark.range(240).select("id", ts.alias("ts"), F.concat(F.lit("u"), (F.col("id") % 9).cast("string")).alias("user"))
    dml.create_or_replace(rows, base, ["id"], ["day(ts)", "bucket(4, user)"], at=AT[0])
    return base


def got(df):
    return sorted(tuple(r) for r in df.collect())


def pruned(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.partition("PartitionFilters: [")[2].split("PushedFilters")[0]


def test_ranges_and_values(spark, events):
    every = log.read_version(spark, events)
    assert every.columns == ["id", "ts", "user"] and every.count() == 240
    low, high = START + dt.timedelta(days=2, hours=5), START + dt.timedelta(days=3)
    kind = every.schema["ts"].dataType
    for a, b in ((low, high), (None, low), (low, None), (low, low), (high, high + dt.timedelta(hours=1))):
        want = every.where((F.lit(a is None) | (F.col("ts") >= F.lit(a).cast(kind))) & (F.lit(b is None) | (F.col("ts") < F.lit(b).cast(kind))))
        found = log.read_version(spark, events, between={"ts": (a, b)})
        assert got(found) == got(want.where("ts is not null" if (a, b) != (None, None) else "true"))
        assert found.columns == ["id", "ts", "user"]
        assert "_day_ts" in pruned(found) or not want.count()  # Spark sees that no value is in an empty range
    found = log.read_version(spark, events, between={"ts": (low, high)}, equal={"user": "u3"})
    assert got(found) == got(log.read_version(spark, events, between={"ts": (low, high)}).where("user = 'u3'"))
    assert "_bucket_user" in pruned(found)


def test_changes_keep_to_their_days(spark, events):
    dml.update(spark, events, "id = 30", {"ts": F.col("ts") + F.expr("interval 5 days")}, at=AT[1])
    dml.delete(spark, events, "id = 31", at=AT[2])
    dml.append(log.read_version(spark, events).where("id = 40").withColumn("id", F.lit(1000).cast("long")), events, at=AT[3])
    day = (START + dt.timedelta(days=1), START + dt.timedelta(days=2))
    want = [*[i for i in range(24, 48) if i not in (30, 31)], 1000]
    for _ in range(3):
        assert [r[0] for r in got(log.read_version(spark, events, between={"ts": day}))] == want
        before = got(log.read_version(spark, events))
        maintenance.rewrite(spark, events, at=AT[5])
        assert got(log.read_version(spark, events)) == before
        maintenance.expire(spark, events, AT[5])
    assert cdc.changes(spark, events, 5, 5).count() == 0


def test_the_source_is_renamed_but_not_dropped(spark, events):
    dml.rename_column(spark, events, "ts", "at", at=AT[1])
    head = log.load(spark, events)[-1]
    assert dml.partitioning(head) == ["day(at)", "bucket(4, user)"]
    found = log.read_version(spark, events, between={"at": (START, START + dt.timedelta(days=1))})
    assert found.count() == 23 and "_day_ts" in pruned(found)
    with pytest.raises(ValueError, match="partition column"):
        dml.drop_column(spark, events, "at")


def test_months_and_logs(spark, base):
    rows = spark.range(60).select(F.date_add(F.lit("2024-01-15").cast("date"), F.col("id").cast("int")).alias("d"), "id")
    dml.create_log(spark, base, rows.schema, ["month(d)"])
    dml.append(rows, base)
    assert dml.create_log(spark, base, rows.schema, ["month(d)"]).version == 2
    found = log.read_version(spark, base, between={"d": (dt.date(2024, 2, 1), dt.date(2024, 3, 1))})
    assert found.count() == 29 and "_month_d" in pruned(found)
    places = {r.file_path.split("_month_d=")[1][:10] for r in log.files(spark, base).collect()}
    assert places == {"2024-01-01", "2024-02-01", "2024-03-01"}


@pytest.mark.parametrize("place", ["week(ts)", "bucket(ts)", "bucket(0, ts)", "day(nowhere)", "day(2, ts)", "nowhere"])
def test_what_is_no_partition(spark, base, place):
    rows = spark.range(3).selectExpr("id", "current_timestamp() AS ts")
    with pytest.raises(ValueError):
        dml.create_or_replace(rows, base, ["id"], [place])
