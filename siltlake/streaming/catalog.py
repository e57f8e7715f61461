"""Log tables in the session catalog, under the namespace and name that their config declares."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from siltlake.operators.changelog import DIRECTORY, LOG_FIELDS, Commit, Drops, drops_after, hidden_fields, load, members, resolve
from siltlake.streaming.config import Config, quoted, target_of


def publish(spark: SparkSession, cfg: Config, base: str) -> str:
    """Show the current version of a log table as the config's view; returns the view's name.

    Below the view lies a table over the log directory, partitioned by commit and by the
    config's columns. The view names the directories of committed data and the ranges dropped
    from them, so filters prune both, and what a failed attempt left behind is never seen. It is
    replaced after each commit; maintenance that moves data is followed by another ``publish``.
    """
    target, chain = target_of(cfg), load(spark, base)
    head = resolve(chain)
    plain, deltas = members(chain, head)
    if deltas:
        raise ValueError("only tables without changes of rows can be shown by a filter")
    log_table = quoted(target.database, f"{target.table}__log")
    spark.sql(f"create database if not exists {quoted(target.database)}")
    if not spark.catalog.tableExists(log_table):
        _create(spark, log_table, head, f"{base}/log")
    known = {c.lower() for c in spark.table(log_table).columns}
    for f in head.physical_schema.fields:  # columns that came since
        if f.name.lower() not in known:
            spark.sql(f"alter table {log_table} add columns ({T.StructType([f]).toDDL()})")
    if plain:  # else there is no directory yet
        spark.sql(f"msck repair table {log_table} sync partitions")
    spark.catalog.refreshTable(log_table)
    groups: dict[Drops, list[str]] = {}
    for c in plain:
        groups.setdefault(drops_after(chain, c, head), []).append(c.data.removeprefix(f"log/{DIRECTORY}="))
    kept = " or ".join(f"({_kept(drops, head, names)})" for drops, names in groups.items()) or "false"
    cells = ", ".join(f"{quoted(p)} as {quoted(n)}" for n, p, _ in head.columns)
    spark.sql(f"create or replace view {target.full_name} as select {cells} from {log_table} where {kept}")
    return target.full_name


def _create(spark: SparkSession, name: str, head: Commit, location: str) -> None:
    schema = T.StructType([*head.physical_schema.fields, *hidden_fields(head.hidden), *LOG_FIELDS]).add(DIRECTORY, "string")
    places = ", ".join(quoted(c) for c in (DIRECTORY, *head.partition_by))
    spark.sql(f"create table {name} ({schema.toDDL()}) using parquet partitioned by ({places}) location {_text(location)}")


def _kept(drops: Drops, head: Commit, names: list[str]) -> str:
    types = {p: t for _, p, t in head.columns}
    parts = [f"{quoted(DIRECTORY)} in ({', '.join(map(_text, names))})"]
    for column, op, value in drops:
        keep = ">=" if op == "<" else "<>"
        parts.append(f"({quoted(column)} {keep} cast({_text(value)} as {types[column]}) or {quoted(column)} is null)")
    return " and ".join(parts)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
