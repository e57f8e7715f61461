"""Registered queries: the log ingest, replayed from the ``events`` table.

Events become log messages on two topics: errors are API metrics, sign-ups user activity,
the rest user events, the last two on one topic. Events of small value are planted faults:
below 1 the text is no JSON, below 2 the user is missing (it is required), below 3 the log
type is unknown, and an error between 3 and 4 carries a status code of the wrong type.
"""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltlake.functions.envelope import envelope
from siltlake.operators.changelog import load, read_version
from siltlake.operators.maintenance import apply_retention, retain
from siltlake.operators.quality import row_counts
from siltlake.plans.registry import register
from siltlake.session import scratch
from siltlake.sources.tables import read_table
from siltlake.streaming import config, ingest
from siltlake.streaming.catalog import publish

CONFIG_DIR = Path(__file__).parent.parent / "configs"


def configs() -> dict[str, config.Config]:
    return {p.stem: config.load_config(p) for p in config.config_files(CONFIG_DIR)}


def _data(kind: str, broken: bool = False) -> Column:
    user = F.when((F.col("value") < 1) | (F.col("value") >= 2), F.concat(F.lit("user_"), F.col("user_id").cast("string")))
    day = F.to_date("ts")
    ms = F.round(F.col("value") * 100).cast("long")
    if kind == "api_metrics":
        return F.struct(
            F.col("ts").alias("timestamp"), day.alias("metric_date"),
            F.when(user.isNotNull(), F.lit("shop")).alias("service_name"),
            F.lit("/api/v1/orders").alias("endpoint"), F.lit("GET").alias("method"),
            F.lit("broken" if broken else 500).alias("status_code"),
            ms.alias("response_time_ms"), user.alias("user_id"), F.lit("failed").alias("error_message"),
        )
    if kind == "user_activity":
        return F.struct(
            user.alias("user_id"), F.col("event_type"), day.alias("event_date"), F.col("ts").alias("timestamp"),
            ms.alias("response_time_ms"), F.from_json("props", "map<string,string>").alias("metadata"),
        )
    return F.struct(
        F.col("ts").alias("timestamp"), day.alias("event_date"), user.alias("user_id"),
        F.concat(F.lit("s"), F.col("user_id").cast("string")).alias("session_id"), F.col("event_type"),
        F.concat(F.lit("/e/"), F.col("event_id").cast("string")).alias("page_url"),
        F.from_json("props", "map<string,string>").alias("properties"), ms.alias("duration_ms"),
    )


# Log type, class and topic of each event type.
_KINDS = {
    "api_metrics": ("ApiMetrics", "api-metrics", ("error",)),
    "user_activity": ("UserActivity", "user-events", ("signup",)),
    "user_events": ("UserEvents", "user-events", ("click", "view", "purchase")),
}


def messages(events: DataFrame) -> DataFrame:
    """``(topic, value)``: every event as message bytes."""
    value, size = F.lit(None).cast("string"), F.col("value")
    topic = value
    for kind, (log_class, to, types) in _KINDS.items():
        mine = F.col("event_type").isin(*types)
        topic = F.when(mine, to).otherwise(topic)
        value = F.when(mine, envelope(kind, log_class, "1.0.0", _data(kind))).otherwise(value)
    value = (
        F.when(size < 1, F.concat(F.lit("no json "), F.col("event_id").cast("string")))
        .when((size >= 2) & (size < 3), envelope("mystery", "Mystery", "1.0.0", F.struct("event_id")))
        .when(
            (F.col("event_type") == "error") & (size >= 3) & (size < 4),
            envelope("api_metrics", "ApiMetrics", "1.0.0", _data("api_metrics", broken=True)),
        )
        .otherwise(value)
    )
    return events.select(topic.alias("topic"), F.encode(value, "UTF-8").alias("value"))


def _replay(spark: SparkSession, sf: str) -> str:
    """Messages of all events, one folder per topic as a stream source reads them."""
    path = scratch(spark, "replay")
    sent = messages(read_table(spark, "events", sf))
    for topic in sorted({to for _, to, _ in _KINDS.values()}):
        sent.where(F.col("topic") == topic).select("value").write.parquet(f"{path}/{topic}")
    return path


def _ingest(spark, replay, cfgs, out, checkpoints, **kw):
    started = ingest.run_ingest(
        spark, cfgs, lambda c: ingest.stream_source(spark, c, replay_dir=replay), out, checkpoints, **kw
    )
    return ingest.supervise(spark, started)


def _ingested(spark, sf, *names, **kw) -> str:
    """Run the ingest for some configs to its end and return the output folder."""
    out, cfgs = scratch(spark, "ingest"), configs()
    done = _ingest(spark, _replay(spark, sf), [cfgs[n] for n in names], out, scratch(spark, "ckpt"), **kw)
    failed = [(s.name, s.error) for s in done if s.error]
    if failed:
        raise RuntimeError(f"ingest failed: {failed}")
    return out


def _plain(df: DataFrame) -> DataFrame:
    """Instants as zone-less UTC timestamps and the map as its ``k`` entry, for comparison."""
    for f in df.schema.fields:
        if f.dataType.typeName() == "timestamp":
            df = df.withColumn(f.name, F.col(f.name).cast("timestamp_ntz"))
        if f.dataType.typeName() == "map":
            df = df.withColumn(f.name, F.try_element_at(f.name, F.lit("k")))
    return df


_K = "json_extract_string(props, '$.k')"
_USER_EVENTS = f"""SELECT ts AS "timestamp", CAST(ts AS DATE) AS event_date, 'user_' || user_id AS user_id,
    's' || user_id AS session_id, event_type, '/e/' || event_id AS page_url, {_K} AS properties,
    CAST(NULL AS VARCHAR) AS device_type, CAST(round(value * 100) AS BIGINT) AS duration_ms
    FROM events WHERE value >= 3 AND event_type IN ('click', 'view', 'purchase')"""
_USER_ACTIVITY = f"""SELECT 'user_' || user_id AS user_id, CAST(NULL AS VARCHAR) AS username, event_type,
    CAST(ts AS DATE) AS event_date, ts AS "timestamp", CAST(NULL AS VARCHAR) AS ip_address,
    CAST(NULL AS VARCHAR) AS user_agent, CAST(NULL AS VARCHAR) AS endpoint, CAST(NULL AS VARCHAR) AS http_method,
    CAST(NULL AS INTEGER) AS status_code, CAST(round(value * 100) AS BIGINT) AS response_time_ms,
    CAST(NULL AS VARCHAR) AS session_id, {_K} AS metadata
    FROM events WHERE value >= 3 AND event_type = 'signup'"""
_API_METRICS = """SELECT ts AS "timestamp", CAST(ts AS DATE) AS metric_date, 'shop' AS service_name,
    '/api/v1/orders' AS endpoint, 'GET' AS method, 500 AS status_code,
    CAST(round(value * 100) AS BIGINT) AS response_time_ms, CAST(NULL AS BIGINT) AS request_size_bytes,
    CAST(NULL AS BIGINT) AS response_size_bytes, 'user_' || user_id AS user_id, CAST(NULL AS VARCHAR) AS client_ip,
    'failed' AS error_message FROM events WHERE value >= 4 AND event_type = 'error'"""
_TOPIC = "CASE WHEN event_type = 'error' THEN 'api-metrics' ELSE 'user-events' END"
_DEAD = f"""SELECT {_TOPIC} AS topic, CASE WHEN value < 1 THEN 'no envelope'
    WHEN value < 2 THEN CASE WHEN event_type = 'error' THEN 'missing service_name' ELSE 'missing user_id' END
    WHEN value < 3 THEN 'unknown type mystery' ELSE 'missing status_code' END AS reason
    FROM events WHERE value < 3 OR (value < 4 AND event_type = 'error')"""


@register(_USER_EVENTS)
def decoded_messages(spark, sf):
    """Batch decode of stored messages with the schema of a config."""
    cfg = configs()["user_events"]
    raw = messages(read_table(spark, "events", sf)).where(F.col("topic") == config.topic_of(cfg))
    return _plain(ingest.route(raw, [cfg])[config.table_of(cfg)])


@register("""SELECT count(*) AS messages, count(*) FILTER (WHERE value >= 3 OR value >= 1 AND value < 2) AS with_type
    FROM events WHERE event_type IN ('click', 'view', 'purchase')""")
def decoded_everything(spark, sf):
    """Plain decode keeps a row for every message: those that do not parse are all NULL."""
    cfg = configs()["user_events"]
    mine = read_table(spark, "events", sf).where(F.col("event_type").isin("click", "view", "purchase"))
    rows = ingest.decode(messages(mine), config.schema_of(cfg))
    return rows.agg(F.count("*").alias("messages"), F.count("event_type").alias("with_type"))


@register(_USER_EVENTS)
def ingested_user_events(spark, sf):
    """Routed by log type from a shared topic, partitioned by date and type."""
    cfg = configs()["user_events"]
    out = _ingested(spark, sf, "user_events", "user_activity")
    return _plain(ingest.read_ingested(spark, cfg, out))


@register(_USER_ACTIVITY)
def ingested_user_activity(spark, sf):
    cfg = configs()["user_activity"]
    out = _ingested(spark, sf, "user_events", "user_activity")
    return _plain(ingest.read_ingested(spark, cfg, out))


@register(_API_METRICS)
def ingested_api_metrics(spark, sf):
    cfg = configs()["api_metrics"]
    return _plain(ingest.read_ingested(spark, cfg, _ingested(spark, sf, "api_metrics")))


@register(f"SELECT topic, reason, count(*) AS n FROM ({_DEAD}) GROUP BY 1, 2")
def dead_letter_reasons(spark, sf):
    """All configs at once: what no table took, by topic and reason."""
    out = _ingested(spark, sf, *configs())
    letters = ingest.read_dead_letters(spark, sorted({to for _, to, _ in _KINDS.values()}), out)
    return letters.groupBy("topic", "reason").agg(F.count("*").alias("n"))


@register(f"""SELECT event_date, event_type, count(*) AS n FROM ({_USER_EVENTS}) GROUP BY 1, 2""")
def ingest_after_restart(spark, sf):
    """The ingest run twice over one checkpoint, with messages arriving in between."""
    cfg, out = _ingested_twice(spark, sf)
    return ingest.read_ingested(spark, cfg, out).groupBy("event_date", "event_type").agg(F.count("*").alias("n"))


def _ingested_twice(spark, sf) -> tuple[config.Config, str]:
    """Clicks arrive after the first run: version 1 is the empty table, 2 has the others, 3 all."""
    cfg = configs()["user_events"]
    replay, out, checkpoints = scratch(spark, "replay"), scratch(spark, "ingest"), scratch(spark, "ckpt")
    sent = messages(read_table(spark, "events", sf).where(~F.col("event_type").isin("error", "click")))
    late = messages(read_table(spark, "events", sf).where(F.col("event_type") == "click"))
    for part in (sent, late):
        part.select("value").write.mode("append").parquet(f"{replay}/{config.topic_of(cfg)}")
        _ingest(spark, replay, [cfg], out, checkpoints)
    return cfg, out


@register(f"SELECT * FROM ({_USER_EVENTS}) WHERE event_type <> 'click'")
def ingested_version_by_number(spark, sf):
    """An ingested table as it was after the first run."""
    cfg, out = _ingested_twice(spark, sf)
    return _plain(ingest.read_ingested(spark, cfg, out, version=2))


@register(f"""SELECT 'before the late ones' AS at, count(*) AS n FROM ({_USER_EVENTS}) WHERE event_type <> 'click'
    UNION ALL SELECT 'now', count(*) FROM ({_USER_EVENTS})""")
def ingested_version_by_time(spark, sf):
    """The same table at the time its first batch was committed, and now."""
    cfg, out = _ingested_twice(spark, sf)
    first = load(spark, f"{out}/{config.table_of(cfg)}")[1]
    return row_counts({
        "before the late ones": ingest.read_ingested(spark, cfg, out, as_of=first.at),
        "now": ingest.read_ingested(spark, cfg, out),
    }).select(F.col("table").alias("at"), F.col("rows").alias("n"))


@register(f"""SELECT 'before' AS state, count(*) AS n FROM ({_API_METRICS}) UNION ALL
    SELECT 'after', count(*) FROM ({_API_METRICS}) WHERE metric_date > (SELECT max(metric_date) FROM ({_API_METRICS})) - 15""")
def ingested_retention(spark, sf):
    """Retention by a config's days, applied to its table: the version before still shows all rows."""
    cfg = configs()["api_metrics"]
    out = _ingested(spark, sf, "api_metrics")
    base = f"{out}/{config.table_of(cfg)}"
    held = load(spark, base)[-1].version
    apply_retention(spark, base, config.partition_of(cfg)[0], config.retention_of(cfg) // 2)
    return row_counts({
        "before": ingest.read_ingested(spark, cfg, out, version=held), "after": ingest.read_ingested(spark, cfg, out),
    }).select(F.col("table").alias("state"), F.col("rows").alias("n"))


@register(f"""SELECT event_type, count(*) AS n, count(*) AS stamped, 1 AS one_date
    FROM ({_USER_ACTIVITY}) GROUP BY 1""")
def stamped_ingest(spark, sf):
    """Ingestion time and date are set on every row and agree with each other."""
    cfg = configs()["user_activity"]
    out = _ingested(spark, sf, "user_activity", stamped=True)
    rows = read_version(spark, f"{out}/{config.table_of(cfg)}")
    agree = F.to_date("_ingestion_timestamp") == F.col("_ingestion_date")
    return rows.groupBy("event_type").agg(
        F.count("*").alias("n"), F.count_if(agree).alias("stamped"),
        F.max(F.when(agree, 1).otherwise(0)).alias("one_date"),
    )


@register(f"""SELECT 'ApiMetrics' AS name, 'ended' AS state, count(*) AS "rows" FROM ({_API_METRICS})
    UNION ALL SELECT 'UserActivity', 'disabled', 0 UNION ALL SELECT 'UserEvents', 'failed', 0""")
def isolated_configs(spark, sf):
    """One config runs, one is switched off and one declares a type that does not exist."""
    cfgs = configs()
    off = {**cfgs["user_activity"], config.TABLE_SECTION: {"enabled": False}}
    wrong = {**cfgs["user_events"], "fields": [{"name": "timestamp", "type": "instant"}]}
    out = scratch(spark, "ingest")
    done = _ingest(spark, _replay(spark, sf), [cfgs["api_metrics"], off, wrong], out, scratch(spark, "ckpt"))
    states = [
        (s.name, "ended" if s.error is None else "disabled" if s.error == "disabled" else "failed")
        for s in done if not s.name.startswith(ingest.DEAD_LETTERS)
    ]
    counted = ingest.read_ingested(spark, cfgs["api_metrics"], out).agg(F.count("*").alias("rows")).select(
        F.lit("ApiMetrics").alias("name"), "rows"
    )
    listed = spark.createDataFrame(states, "name string, state string")
    return listed.join(counted, "name", "left").na.fill(0, ["rows"])


@register(f"SELECT event_type, count(*) AS n, min(\"timestamp\") AS first FROM ({_USER_EVENTS}) GROUP BY 1")
def configured_table(spark, sf):
    """The config's namespace and table, shown in the catalog after each commit of the ingest."""
    cfg, out = configs()["user_events"], scratch(spark, "ingest")
    # A namespace of its own keeps runs in one session apart.
    cfg = {**cfg, "warehouse": {**cfg["warehouse"], "table_name": f"logs_{uuid.uuid4().hex[:8]}.user_events"}}
    _ingest(
        spark, _replay(spark, sf), [cfg], out, scratch(spark, "ckpt"), after=lambda c, base: publish(spark, c, base)
    )
    rows = _plain(spark.table(config.target_of(cfg).full_name))
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.min("timestamp").alias("first"))


@register(_USER_EVENTS)
def compacted_ingest(spark, sf):
    """An ingested table rewritten in few files, sorted by the config's sort columns."""
    cfg = configs()["user_events"]
    out = _ingested(spark, sf, "user_events")
    return _plain(ingest.compact(spark, cfg, out, scratch(spark, "compacted")))


@register(f"""SELECT metric_date, count(*) AS n FROM ({_API_METRICS})
    WHERE metric_date > (SELECT max(metric_date) FROM ({_API_METRICS})) - 15 GROUP BY 1""")
def retained_metrics(spark, sf):
    """The newest days of an ingested table, pruned by its date partitions."""
    cfg = configs()["api_metrics"]
    rows = ingest.read_ingested(spark, cfg, _ingested(spark, sf, "api_metrics"))
    newest = rows.agg(F.max("metric_date")).scalar()
    return retain(rows, "metric_date", config.retention_of(cfg) // 2, newest).groupBy("metric_date").agg(F.count("*").alias("n"))
