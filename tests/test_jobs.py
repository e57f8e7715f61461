import json

from siltlake.jobs import ingest_logs, load_shop
from siltlake.plans.registered_streams import configs
from siltlake.streaming import config
from test_ingest import GOOD, TOPIC, frame


def test_load_shop_in_both_formats_gives_the_same_rows(spark, tmp_path, capsys):
    sizes = dict(customers=50, products=10, orders=200)
    plain = load_shop.load(spark, str(tmp_path / "plain"), **sizes)
    versioned = load_shop.load(spark, str(tmp_path / "versioned"), **sizes, versioned=True)
    for name in load_shop.TABLES:
        columns = sorted(plain[name].columns)
        assert sorted(plain[name].select(columns).collect()) == sorted(versioned[name].select(columns).collect())
    load_shop.report(plain)
    assert "top customers by revenue" in capsys.readouterr().out


def test_ingest_job(spark, tmp_path):
    folder = tmp_path / "configs"
    folder.mkdir()
    cfg = {**configs()["user_events"], "warehouse": {"table_name": "job_logs.user_events"}}
    (folder / "user_events.json").write_text(json.dumps(cfg))
    (folder / "broken.json").write_text("{")
    no_such = {**configs()["user_activity"], "warehouse": {"table_name": "job_logs.odd", "partition_by": ["nowhere"]}}
    no_such.pop(config.TABLE_SECTION, None)
    (folder / "no_such_column.json").write_text(json.dumps(no_such))
    told = []
    frame(spark, GOOD).write.parquet(str(tmp_path / "in" / TOPIC))
    done = ingest_logs.ingest(
        spark, str(folder), str(tmp_path / "out"), str(tmp_path / "ckpt"), once=True, replay_dir=str(tmp_path / "in"),
        report=lambda s: told.append(s.name),
    )
    assert {s.name: s.error is None for s in done} == {
        "broken.json": False, "UserActivity": False, "UserEvents": True, f"dead_letters.{TOPIC}": True,
    }
    assert sorted(told) == ["UserActivity", "broken.json"]
    assert spark.table("job_logs.user_events").count() == len(GOOD)
    plan = spark.table("job_logs.user_events")._jdf.queryExecution().executedPlan().toString()
    assert "isnotnull(_dir" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
