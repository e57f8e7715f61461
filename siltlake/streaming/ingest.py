"""Enveloped JSON logs into versioned tables: one query per topic, restart, supervise.

A topic's query reads and parses every message once and appends a commit per micro-batch to
each table that gets rows, and to the dead letters. Commits name the batch they came from, so
a restart from the checkpoint adds nothing twice, and every batch is a version that can be read.
``start_sink`` writes a single stream to plain files instead.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from pathlib import Path

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from siltlake.operators import dml
from siltlake.operators.changelog import VERSION, committed, fold_commits, load, read_version, resolve, state_rows
from siltlake.sinks.parquet import write_table
from siltlake.streaming.config import (
    Config, config_files, enabled, load_config, partition_of, schema_of, sort_of, table_of, topic_of,
)
from siltlake.streaming.routing import (  # noqa: F401
    DEAD_LETTERS, PARKED, complete, dead_letters, decode, destination, fan_out, route, route_one, rows_of, schema_of_routed,
)

#: Columns of stamped rows.
STAMPS = T.StructType().add("_ingestion_timestamp", "timestamp").add("_ingestion_date", "date")
#: Micro-batches after which a table's commits are put into one file.
FOLD_EVERY = 100
#: Files that a micro-batch adds to a table partition at most.
TASKS_PER_PARTITION = 4


def stream_source(
    spark: SparkSession,
    cfg: Config,
    replay_dir: str | None = None,
    servers: str = "localhost:9092",
    max_offsets: int | None = None,
) -> DataFrame:
    """The config's topic as a stream with a ``value`` column.

    Reads Kafka from the earliest offset; ``max_offsets`` bounds a micro-batch, without which
    the first one is the whole topic. The Kafka connector is not part of Spark's own
    distribution: where it is absent, ``replay_dir`` streams Parquet files with a binary
    ``value`` from ``<replay_dir>/<topic>`` through the same transformations.
    """
    if replay_dir is not None:
        reader = spark.readStream.schema("value binary")
        if max_offsets:
            reader = reader.option("maxFilesPerTrigger", max_offsets)
        return reader.parquet(f"{replay_dir}/{topic_of(cfg)}")
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic_of(cfg))
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", "false")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load()


def start_sink(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    name: str | None = None,
    once: bool = True,
    trigger: str = "1 minute",
    tasks_per_partition: int | None = TASKS_PER_PARTITION,
) -> StreamingQuery:
    """Append a stream to Parquet, exactly once per checkpoint.

    ``tasks_per_partition`` bounds the files a micro-batch adds to a partition: rows are
    shuffled to that many tasks per partition value, by row hash, so that one value holding
    much of the batch still has several writers. With None nothing is shuffled and every
    input task writes its own files.
    """
    if tasks_per_partition and partition_by:
        lot = F.pmod(F.xxhash64(*[c for c, t in df.dtypes if not t.startswith("map")]), F.lit(tasks_per_partition))
        df = df.repartition(*[F.col(c) for c in partition_by], lot)
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=trigger)
    return writer.start(path)


DISABLED = "disabled"


@dataclass
class Started:
    """A query of the ingest, or why it did not start or stopped."""

    name: str
    query: StreamingQuery | None = None
    error: str | None = None

    @property
    def failed(self) -> bool:
        return self.error not in (None, DISABLED)


def read_configs(folder: str | Path) -> tuple[list[Config], list[Started]]:
    """Configs of a folder, disabled ones too; a file that cannot be read is reported, not raised."""
    good, bad = [], []
    for path in config_files(folder):
        try:
            cfg = load_config(path)
            schema_of(cfg), topic_of(cfg)
            good.append(cfg)
        except Exception as e:
            bad.append(Started(path.name, error=f"{type(e).__name__}: {e}"))
    return good, bad


class TopicWriter:
    """Takes the micro-batches of one topic to the tables of its configs, in one read and parse.

    A batch is routed once and staged below the checkpoints; every table that gets rows of it
    then makes one commit, named by query and batch. A batch that is replayed after a failure
    is skipped by the tables that have it, so each message is in a table once.

    A table that cannot be written does not hold up the others: its messages are parked, as are
    those of disabled configs, and ``redeliver`` brings them in when the config runs again.
    """

    def __init__(
        self, spark: SparkSession, topic: str, out: str, staging: str, stamped: bool = False,
        after: Callable[[Config, str], object] | None = None,
    ) -> None:
        self.spark, self.topic, self.out, self.staging, self.stamped, self.after = spark, topic, out, staging, stamped, after
        self.running: list[tuple[Config, Started]] = []
        self.parked: list[str] = []

    def base(self, cfg: Config) -> str:
        return f"{self.out}/{table_of(cfg)}"

    def path(self, kind: str) -> str:
        return f"{self.out}/{kind}/{self.topic}"

    def open(self, cfg: Config) -> None:
        """Create or widen the config's table."""
        schema = schema_of(cfg)
        if self.stamped:
            schema = T.StructType([*schema.fields, *STAMPS.fields])
        if table_of(cfg) in (DEAD_LETTERS, PARKED):
            raise ValueError(f"{table_of(cfg)} is where the ingest keeps what no table takes")
        if any(c["log_type"] == cfg["log_type"] for c, _ in self.running):
            raise ValueError(f"another config of {self.topic} takes {cfg['log_type']}")
        dml.create_log(self.spark, self.base(cfg), schema, partition_of(cfg))

    def open_letters(self) -> None:
        dml.create_log(self.spark, self.path(DEAD_LETTERS), T.StructType.fromDDL("value string, reason string, topic string"))
        dml.create_log(self.spark, self.path(PARKED), T.StructType.fromDDL("log_type string, value string"))

    def write(self, batch: DataFrame, number: int) -> None:
        """One micro-batch; the function that ``foreachBatch`` calls."""
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        self._deliver(batch, query, number)

    def _deliver(self, batch: DataFrame, writer: str, number: int, only: Config | None = None) -> None:
        cfgs = [c for c, s in self.running if not s.error] if only is None else [only]
        off = [*self.parked, *[c["log_type"] for c, s in self.running if s.error]] if only is None else []
        fan_out(batch, cfgs, off).write.mode("overwrite").partitionBy("_to").parquet(self.staging)
        routed = self.spark.read.schema(schema_of_routed(cfgs)).parquet(self.staging)
        present = {r["_to"] for r in routed.select("_to").distinct().collect()}  # the log types of one topic
        # An earlier attempt at this batch may have parked a config's messages, which are then redelivered.
        aside = load(self.spark, self.path(PARKED))
        for cfg in cfgs:
            if destination(cfg) in present and not committed(aside, self._own(cfg, writer), number):
                self._append(cfg, rows_of(routed, cfg, cfgs), batch, writer, number, only is not None)
        if DEAD_LETTERS in present:
            letters = routed.where(F.col("_to") == DEAD_LETTERS).select("value", "reason", F.lit(self.topic).alias("topic"))
            dml.append(letters, self.path(DEAD_LETTERS), writer=writer, batch=number)
        if PARKED in present:
            waiting = routed.where(F.col("_to") == PARKED).select("log_type", "value")
            dml.append(waiting, self.path(PARKED), writer=writer, batch=number)

    def _append(self, cfg: Config, rows: DataFrame, batch: DataFrame, writer: str, number: int, must: bool) -> None:
        """Commit a config's rows of a batch, or park its messages where that fails."""
        if self.stamped:
            rows = rows.withColumns({"_ingestion_timestamp": F.current_timestamp(), "_ingestion_date": F.current_date()})
        try:
            dml.append(rows, self.base(cfg), writer=self._own(cfg, writer), batch=number)
        except Exception as e:
            if must:
                raise
            mine = batch.where(complete(cfg)).select(F.lit(cfg["log_type"]).alias("log_type"), F.col("value").cast("string").alias("value"))
            dml.append(mine, self.path(PARKED), writer=self._own(cfg, writer), batch=number)
            next(s for c, s in self.running if c is cfg).error = f"{type(e).__name__}: {e}"
            return
        if number % FOLD_EVERY == FOLD_EVERY - 1:
            fold_commits(self.spark, self.base(cfg))
        if self.after is not None:
            self.after(cfg, self.base(cfg))

    def _own(self, cfg: Config, writer: str) -> str:
        return f"{writer}:{cfg['log_type']}"

    def redeliver(self, cfg: Config) -> None:
        """Bring in messages of the config's type that wait: parked ones and dead letters of an unknown type.

        The commit of the table names the newest version of what waited, so a job lost on the way
        repeats nothing; then the messages are dropped from where they waited.
        """
        for kind, column, value in (
            (PARKED, "log_type", cfg["log_type"]), (DEAD_LETTERS, "reason", f"unknown type {cfg['log_type']}")
        ):
            place = self.path(kind)
            chain = load(self.spark, place)
            if not any(c.data for c in chain):
                continue
            waiting = state_rows(self.spark, place, chain, resolve(chain)).where(F.col(column) == value)
            newest = waiting.agg(F.max(VERSION)).first()[0]
            if newest is not None:
                self._deliver(waiting.select("value"), f"{kind}:{self.topic}", newest, cfg)
                dml.drop_range(self.spark, place, column, "=", value, operation="redelivered")


def run_ingest(
    spark: SparkSession,
    cfgs: Iterable[Config],
    source: Callable[[Config], DataFrame],
    out: str,
    checkpoints: str,
    once: bool = True,
    stamped: bool = False,
    prepare: Callable[[Config], object] | None = None,
    trigger: str = "1 minute",
    after: Callable[[Config, str], object] | None = None,
) -> list[Started]:
    """Start one query per topic, which reads and parses it once for all its enabled configs.

    Tables are versioned logs below ``out``; ``prepare`` runs before a config's table is opened,
    ``after`` gets config and table once it is open
    and after each commit. A config that fails at its start is reported
    in its entry and does not keep the others from running, as is one whose table fails later. Messages of both, and of disabled configs, wait in ``parked``.
    ``stamped`` adds ``_ingestion_timestamp`` and ``_ingestion_date``, fixed per micro-batch.
    """
    started, topics, owners = [], {}, {}
    for cfg in cfgs:
        entry = Started(cfg.get("name", "?"))
        started.append(entry)
        try:
            topic = topic_of(cfg)
            if topic not in topics:
                topics[topic] = (cfg, TopicWriter(spark, topic, out, f"{checkpoints}/{topic}.staged", stamped, after))
            writer = topics[topic][1]
            if not enabled(cfg):
                entry.error = DISABLED
                writer.parked.append(cfg["log_type"])
                continue
            try:
                if prepare is not None:
                    prepare(cfg)
                if owners.setdefault(table_of(cfg), topic) != topic:
                    raise ValueError(f"{table_of(cfg)} is written from {owners[table_of(cfg)]}; a table has one writer")
                writer.open(cfg)
                if after is not None:
                    after(cfg, writer.base(cfg))
                writer.running.append((cfg, entry))
            except Exception:
                writer.parked.append(cfg["log_type"])
                raise
        except Exception as e:
            entry.error = f"{type(e).__name__}: {e}"
    for topic, (cfg, writer) in topics.items():
        entry = Started(f"{DEAD_LETTERS}.{topic}")
        mine = [s for _, s in writer.running]
        try:
            stream = source(cfg)
            writer.open_letters()
            for c, s in writer.running:
                try:
                    writer.redeliver(c)
                except Exception as e:
                    s.error = f"{type(e).__name__}: {e}"
            trig = {"availableNow": True} if once else {"processingTime": trigger}
            entry.query = (
                stream.writeStream.foreachBatch(writer.write)
                .option("checkpointLocation", f"{checkpoints}/{topic}").trigger(**trig).start()
            )
            for s in mine:
                s.query = entry.query
        except Exception as e:
            for s in [entry, *mine]:
                s.error = s.error or f"{type(e).__name__}: {e}"
        started.append(entry)
    return started


def supervise(
    spark: SparkSession, started: Sequence[Started], report: Callable[[Started], object] | None = None
) -> list[Started]:
    """Wait until every query has ended, noting the error of each that failed.

    A failure is seen, and handed to ``report``, when it happens, whichever query it is, not
    once earlier ones end; those that did not start come first.
    """
    told: set[int] = set()

    def tell() -> None:
        for s in started:
            if s.failed and id(s) not in told:
                told.add(id(s))
                if report is not None:
                    report(s)

    waiting = [s for s in started if s.query is not None]
    tell()
    while waiting:
        for s in waiting:
            if not s.query.isActive and s.query.exception() is not None and not s.error:
                s.error = str(s.query.exception())
        waiting = [s for s in waiting if s.query.isActive]
        tell()
        if waiting:
            try:
                spark.streams.awaitAnyTermination(5)
            except StreamingQueryException:
                pass  # noted from the query itself in the next round
            spark.streams.resetTerminated()
    return list(started)


def read_ingested(
    spark: SparkSession, cfg: Config, out: str, version: int | None = None, as_of: dt.datetime | None = None
) -> DataFrame:
    """A table that the ingest wrote, under its declared columns: now, or at a version or time."""
    return read_version(spark, f"{out}/{table_of(cfg)}", version, as_of).select(*[f"`{n}`" for n in schema_of(cfg).names])


def read_dead_letters(spark: SparkSession, topics: Iterable[str], out: str) -> DataFrame:
    """Dead letters of several topics, without those whose type has been taken in since."""
    return reduce(DataFrame.unionByName, [read_version(spark, f"{out}/{DEAD_LETTERS}/{t}") for t in topics])


def compact(spark: SparkSession, cfg: Config, out: str, target: str) -> DataFrame:
    """A copy of an ingested table in few files, sorted by the config's sort columns."""
    return write_table(read_ingested(spark, cfg, out), target, partition_by=partition_of(cfg), sort_by=sort_of(cfg))
