"""Planted bad input, partition of the messages, restart, isolation and supervision."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from siltlake.operators import changelog as log
from siltlake.operators import dml, maintenance
from siltlake.plans.registered_streams import configs
from siltlake.streaming import config, ingest

TOPIC = "user-events"


def event(**data):
    full = {
        "timestamp": "2024-05-01T10:00:00.123456Z", "event_date": "2024-05-01", "user_id": "u", "session_id": "s",
        "event_type": "click", **data,
    }
    return json.dumps({
        "_log_type": "user_events", "_log_class": "UserEvents", "_version": "1.0.0",
        "data": {k: v for k, v in full.items() if v is not None},
    })


GOOD = [
    event(), event(duration_ms="bad"), event(surprise=1), event(properties={"a": "1", "b": "2"}), event(timestamp=1714557600),
]
BAD = {
    "no json at all": "no envelope", "": "empty", None: "empty", "   ": "no envelope", "[1, 2]": "no envelope",
    '{"data": {}}': "no envelope", '{"_log_type": null, "data": {}}': "no envelope",
    '{"_log_type": "user_events"}': "missing data", event(user_id=None): "missing user_id",
    event(timestamp="yesterday"): "missing timestamp", event(event_date="soon"): "missing event_date",
    '{"_log_type": "other", "data": {"user_id": "u"}}': "unknown type other",
    '{"_log_type": "user_activity", "data": {"user_id": "u"}}': "missing event_type",
    event()[:-3]: "no envelope",
}


def frame(spark, values):
    return spark.createDataFrame([(v.encode() if v is not None else None,) for v in values], "value binary")


def test_every_message_goes_to_one_place(spark):
    cfgs = [configs()["user_events"], configs()["user_activity"]]
    df = frame(spark, [*GOOD, *BAD])
    routed = ingest.route(df, cfgs)
    assert routed["user_events"].count() == len(GOOD)
    assert routed["user_activity"].count() == 0
    letters = {r.value: (r.reason, r.topic) for r in ingest.dead_letters(df, cfgs).collect()}
    assert letters == {v: (reason, TOPIC) for v, reason in BAD.items()}


def test_fields_are_typed(spark):
    cfg = configs()["user_events"]
    rows = ingest.route_one(frame(spark, GOOD), cfg).collect()
    assert rows[0].timestamp == dt.datetime(2024, 5, 1, 10, 0, 0, 123456) or rows[0].timestamp.microsecond == 123456
    assert rows[0].event_date == dt.date(2024, 5, 1)
    assert rows[1].duration_ms is None and rows[1].user_id == "u"
    assert rows[3].properties == {"a": "1", "b": "2"}


def test_decode_keeps_rows_that_do_not_parse(spark):
    rows = ingest.decode(frame(spark, [GOOD[0], "x", None]), config.schema_of(configs()["user_events"])).collect()
    assert [r.user_id for r in rows] == ["u", None, None]


def test_each_message_is_parsed_once(spark, tmp_path):
    path = str(tmp_path / "m")
    frame(spark, GOOD).write.parquet(path)
    raw, cfgs = spark.read.parquet(path), [configs()["user_events"], configs()["user_activity"]]
    for df, parses in ((ingest.route_one(raw, cfgs[0]), 2), (ingest.dead_letters(raw, cfgs), 3)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert sum(line.split("DataFilters")[0].count("from_json") for line in plan.splitlines()) == parses


def test_schema_and_names(spark):
    cfgs = configs()
    schema = config.schema_of(cfgs["user_activity"])
    assert schema["metadata"].dataType.simpleString() == "map<string,string>"
    assert schema["event_date"].dataType.simpleString() == "date"
    assert config.table_of(cfgs["api_metrics"]) == "api_metrics"
    assert config.table_of({"name": "SomeLog"}) == "somelog"
    assert config.partition_of(cfgs["api_metrics"]) == ["metric_date", "service_name"]
    both = {**cfgs["user_events"], config.TABLE_SECTION: {"partition_fields": ["event_date"], "sort_fields": ["user_id"]}}
    assert config.partition_of(both) == ["event_date"] and config.sort_of(both) == ["user_id"]
    assert config.retention_of(cfgs["user_events"]) == 90
    with pytest.raises(ValueError, match="unknown type"):
        config.schema_of({"name": "X", "fields": [{"name": "a", "type": "varchar(3)"}]})


def test_config_folder(spark, tmp_path):
    cfg = configs()["user_events"]
    (tmp_path / "a.json").write_text(json.dumps(cfg))
    (tmp_path / "b.json.disabled").write_text(json.dumps(cfg))
    (tmp_path / "c.json").write_text("{ not json")
    (tmp_path / "d.json").write_text(json.dumps({**cfg, config.TABLE_SECTION: {"enabled": False}}))
    good, bad = ingest.read_configs(tmp_path)
    assert [config.enabled(c) for c in good] == [True, False]
    assert [b.name for b in bad] == ["c.json"]


def run(spark, tmp_path, cfgs, **kw):
    started = ingest.run_ingest(
        spark, cfgs, lambda c: ingest.stream_source(spark, c, replay_dir=str(tmp_path / "in")), str(tmp_path / "out"),
        str(tmp_path / "ckpt"), **kw,
    )
    return ingest.supervise(spark, started)


def test_restart_adds_nothing_twice(spark, tmp_path):
    cfgs = [configs()["user_events"], configs()["user_activity"]]
    for n in (1, 2, 2):
        if n == 1 or not (tmp_path / "second").exists():
            frame(spark, [*GOOD, *BAD]).write.mode("append").parquet(str(tmp_path / "in" / TOPIC))
        if n == 2:
            (tmp_path / "second").touch()
        assert not [s for s in run(spark, tmp_path, cfgs) if s.error]
        out = str(tmp_path / "out")
        assert ingest.read_ingested(spark, cfgs[0], out).count() == n * len(GOOD)
        assert ingest.read_dead_letters(spark, [TOPIC], out).count() == n * len(BAD)
    # Two commits with data, each partitioned by date and type, and no log of a file sink.
    base = tmp_path / "out" / "user_events"
    assert len(list(base.glob("log/*/event_date=2024-05-01/event_type=click"))) == 2
    assert not list((tmp_path / "out").rglob("_spark_metadata"))
    assert [ingest.read_ingested(spark, cfgs[0], out, version=v).count() for v in (1, 2, 3)] == [0, len(GOOD), 2 * len(GOOD)]


def test_failures_are_reported_per_config(spark, tmp_path):
    cfgs = configs()
    frame(spark, GOOD).write.parquet(str(tmp_path / "in" / TOPIC))
    wrong = {**cfgs["api_metrics"], "fields": [{"name": "a", "type": "colour"}]}
    # No replay folder for this topic: its queries cannot start.
    lost = {**cfgs["user_activity"], "kafka": {"topic": "nowhere"}}
    done = {s.name: s.error for s in run(spark, tmp_path, [wrong, lost, cfgs["user_events"]])}
    assert "unknown type" in done["ApiMetrics"]
    assert done["UserActivity"] is not None
    assert done["UserEvents"] is None
    assert ingest.read_ingested(spark, cfgs["user_events"], str(tmp_path / "out")).count() == len(GOOD)


def letters(spark, tmp_path):
    found = ingest.read_dead_letters(spark, [TOPIC], str(tmp_path / "out"))
    return sorted((r.value or "", r.reason) for r in found.collect())


def test_fan_out_agrees_with_route_and_dead_letters(spark):
    cfgs = configs()
    activity = {**cfgs["user_activity"], "fields": [
        # The same name with another type: a schema of its own.
        {**f, "type": "string"} if f["name"] == "timestamp" else f for f in cfgs["user_activity"]["fields"]]}
    good = json.dumps({"_log_type": "user_activity", "data": {
        "user_id": "u", "event_type": "signup", "event_date": "2024-05-01", "timestamp": "any text", "metadata": {"k": "v"}}})
    df = frame(spark, [*GOOD, *BAD, good])
    for members in ([cfgs["user_events"], cfgs["user_activity"]], [cfgs["user_events"], activity], [cfgs["user_activity"]], []):
        routed = ingest.fan_out(df, members)
        assert routed.count() == len(GOOD) + len(BAD) + 1
        for cfg in members:
            mine = ingest.rows_of(routed, cfg, members)
            want = ingest.route_one(df, cfg)
            assert mine.schema.names == want.schema.names and sorted(map(str, mine.collect())) == sorted(map(str, want.collect()))
        if members:
            want = sorted((r.value or "", r.reason) for r in ingest.dead_letters(df, members).collect())
            assert sorted((r.value or "", r.reason) for r in routed.where("_to = 'dead_letters'").collect()) == want


def test_a_topic_is_read_and_parsed_once(spark, tmp_path):
    """Three tables and the dead letters: one scan, one parse, in the plan that every batch runs."""
    path = str(tmp_path / "m")
    frame(spark, GOOD).write.parquet(path)
    cfgs = [{**c, "kafka": {"topic": TOPIC}} for c in configs().values()]
    assert len(cfgs) == 3
    plan = ingest.fan_out(spark.read.parquet(path), cfgs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert sum(line.split("DataFilters")[0].count("from_json") for line in plan.splitlines()) == 1


def test_a_batch_that_is_replayed_commits_once(spark, tmp_path):
    cfgs = [configs()["user_events"], configs()["user_activity"]]
    writer = ingest.TopicWriter(spark, TOPIC, str(tmp_path / "out"), str(tmp_path / "staged"))
    for c in cfgs:
        writer.open(c)
        writer.running.append((c, ingest.Started(c["name"])))
    writer.open_letters()
    batch = frame(spark, [*GOOD, *BAD])
    for number in (0, 0, 1, 1, 0):
        writer._deliver(batch, "query", number)
    out = str(tmp_path / "out")
    assert ingest.read_ingested(spark, cfgs[0], out).count() == 2 * len(GOOD)
    assert ingest.read_dead_letters(spark, [TOPIC], out).count() == 2 * len(BAD)


def test_a_table_that_fails_parks_its_messages_and_gets_them_later(spark, tmp_path, monkeypatch):
    cfgs = [configs()["user_events"], configs()["user_activity"]]
    good = json.dumps({"_log_type": "user_activity", "data": {
        "user_id": "u", "event_type": "signup", "event_date": "2024-05-01", "timestamp": "2024-05-01T10:00:00Z"}})
    frame(spark, [*GOOD, *BAD, good]).write.parquet(str(tmp_path / "in" / TOPIC))
    real = dml.append

    def broken(df, base, **kw):
        if base.endswith("user_events"):
            raise RuntimeError("disk full")
        return real(df, base, **kw)

    monkeypatch.setattr(dml, "append", broken)
    done = {s.name: s.error for s in run(spark, tmp_path, cfgs)}
    assert "disk full" in done["UserEvents"] and done["UserActivity"] is None and done[f"dead_letters.{TOPIC}"] is None
    out = str(tmp_path / "out")
    assert ingest.read_ingested(spark, cfgs[1], out).count() == 1
    monkeypatch.setattr(dml, "append", real)
    for _ in range(2):
        assert not [s for s in run(spark, tmp_path, cfgs) if s.error]
        assert ingest.read_ingested(spark, cfgs[0], out).count() == len(GOOD)
    assert letters(spark, tmp_path) == sorted((v or "", reason) for v, reason in BAD.items())


def test_a_replayed_batch_leaves_parked_messages_to_redelivery(spark, tmp_path, monkeypatch):
    cfg = configs()["user_events"]
    writer = ingest.TopicWriter(spark, TOPIC, str(tmp_path / "out"), str(tmp_path / "staged"))
    writer.open(cfg)
    writer.running.append((cfg, ingest.Started("UserEvents")))
    writer.open_letters()
    real = dml.append
    monkeypatch.setattr(dml, "append", lambda df, base, **kw: 1 / 0 if base.endswith("user_events") else real(df, base, **kw))
    writer._deliver(frame(spark, GOOD), "query", 0)
    monkeypatch.setattr(dml, "append", real)
    writer.running[0][1].error = None  # started again; the lost run had not finished the batch
    writer.redeliver(cfg)
    writer._deliver(frame(spark, GOOD), "query", 0)
    assert ingest.read_ingested(spark, cfg, str(tmp_path / "out")).count() == len(GOOD)


def test_a_type_that_was_unknown_is_taken_in_once_it_has_a_config(spark, tmp_path):
    cfgs = [configs()["user_events"], configs()["user_activity"]]
    frame(spark, [*GOOD, *BAD]).write.parquet(str(tmp_path / "in" / TOPIC))
    run(spark, tmp_path, cfgs[1:])
    assert ("unknown type user_events" in {r for _, r in letters(spark, tmp_path)})
    assert not [s for s in run(spark, tmp_path, cfgs) if s.error]
    assert ingest.read_ingested(spark, cfgs[0], str(tmp_path / "out")).count() == len(GOOD)
    assert letters(spark, tmp_path) == sorted((v or "", reason) for v, reason in BAD.items())


def test_a_config_that_gains_a_field_widens_its_table(spark, tmp_path):
    cfg = configs()["user_events"]
    out = str(tmp_path / "out")
    frame(spark, GOOD).write.parquet(str(tmp_path / "in" / TOPIC))
    run(spark, tmp_path, [cfg])
    wider = {**cfg, "fields": [*cfg["fields"], {"name": "surprise", "type": "int"}]}
    frame(spark, GOOD).write.mode("append").parquet(str(tmp_path / "in" / TOPIC))
    assert not [s for s in run(spark, tmp_path, [wider]) if s.error]
    assert sorted(r.surprise or 0 for r in ingest.read_ingested(spark, wider, out).collect()) == [0] * 9 + [1]
    other = {**cfg, "fields": [{**f, "type": "string"} if f["name"] == "duration_ms" else f for f in cfg["fields"]]}
    assert "other types" in {s.name: s.error for s in run(spark, tmp_path, [other])}["UserEvents"]


def test_one_log_type_and_one_table_have_one_writer(spark, tmp_path):
    cfg = configs()["user_events"]
    again = {**cfg, "name": "Again", "warehouse": {"table_name": "again"}}
    elsewhere = {**cfg, "name": "Elsewhere", "kafka": {"topic": "other"}}
    for topic in (TOPIC, "other"):
        frame(spark, GOOD).write.parquet(str(tmp_path / "in" / topic))
    done = {s.name: s.error for s in run(spark, tmp_path, [cfg, again, elsewhere])}
    assert done["UserEvents"] is None and "takes user_events" in done["Again"] and "one writer" in done["Elsewhere"]


def test_orphans_of_a_killed_batch_are_found_and_committed_files_never(spark, tmp_path):
    cfg = configs()["user_events"]
    frame(spark, GOOD).write.parquet(str(tmp_path / "in" / TOPIC))
    run(spark, tmp_path, [cfg])
    base = str(tmp_path / "out" / "user_events")
    head = log.load(spark, base)[-1]
    left = log.write_log(log.upserts(log.read_version(spark, base), head), base, 9, head.partition_by)
    later = log.now() + dt.timedelta(days=1)
    log.fold_commits(spark, base)
    assert {f"log/{r.directory}" for r in maintenance.orphans(spark, base, later).collect()} == {left}
    maintenance.orphans(spark, base, later, delete=True)
    assert maintenance.orphans(spark, base, later).count() == 0
    assert ingest.read_ingested(spark, cfg, str(tmp_path / "out")).count() == len(GOOD)


def test_a_failing_query_is_seen_while_others_run(spark, tmp_path):
    frame(spark, GOOD).write.parquet(str(tmp_path / "in" / TOPIC))
    raw = spark.readStream.schema("value binary").parquet(str(tmp_path / "in" / TOPIC))
    boom = raw.select(F.raise_error(F.lit("boom")).cast("string").alias("x"))
    forever = ingest.start_sink(raw, str(tmp_path / "a"), str(tmp_path / "ca"), once=False, trigger="1 second")
    failing = ingest.start_sink(boom, str(tmp_path / "b"), str(tmp_path / "cb"))
    seen = ingest.Started("failing", failing)
    ingest.supervise(spark, [seen])
    assert "boom" in seen.error and forever.isActive
    forever.stop()


def test_a_disabled_type_waits_in_the_topic(spark, tmp_path):
    frame(spark, [*GOOD, *BAD]).write.parquet(str(tmp_path / "in" / TOPIC))
    off = {**configs()["user_events"], config.TABLE_SECTION: {"enabled": False}}
    done = run(spark, tmp_path, [off, configs()["user_activity"]])
    assert [s.name for s in done if s.error] == ["UserEvents"] and not any(s.failed for s in done)
    out = str(tmp_path / "out")
    dead = ingest.read_dead_letters(spark, [TOPIC], out)
    assert dead.where("value LIKE '%UserEvents%' AND reason LIKE 'unknown type%'").count() == 0
    # Once enabled it gets what came before, whether or not the topic still has it.
    cfg = configs()["user_events"]
    assert not [s for s in run(spark, tmp_path, [cfg, configs()["user_activity"]]) if s.error]
    assert ingest.read_ingested(spark, cfg, out).count() == len(GOOD)
    assert letters(spark, tmp_path) == sorted((v or "", reason) for v, reason in BAD.items())


def test_kafka_source_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        ingest.stream_source(spark, configs()["user_events"])
