"""Commits that change a versioned table: create, append, adopt, update, delete, merge."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltlake.functions.sizing import settled
from siltlake.operators.changelog import (
    DELETE, OP, RESERVED, TRANSFORMS, UPSERT, Commit, commit_rows, committed, load, now, record, require_key, resolve,
    state, successor, tombstones, upserts,
)
from siltlake.sinks.parquet import write_table


_DERIVED = re.compile(r"(\w+)\(\s*(?:(\d+)\s*,\s*)?(.+?)\s*\)")


def _first(df_schema: T.StructType, operation: str, key, partition_by, at) -> Commit:
    for i, n in enumerate(df_schema.names):
        _require_free(n, df_schema.names[:i])
    places, hidden = [], []
    for place in partition_by:
        made = _DERIVED.fullmatch(place) if place not in df_schema.names else None
        if made:
            transform, size, source = made.groups()
            if transform not in TRANSFORMS or (transform == "bucket") != bool(size) or size == "0":
                raise ValueError(f"{place} is no day(c), month(c) or bucket(n, c)")
            place = f"_{transform}_{source}"
            hidden.append((place, source, transform, int(size or 0)))
        places.append(place)
    derived_from = [source for _, source, _, _ in hidden]
    unknown = [c for c in [*key, *places, *derived_from] if c not in df_schema.names and c not in [h[0] for h in hidden]]
    if unknown or {h[0] for h in hidden} & set(df_schema.names):
        raise ValueError(f"key and partition columns must exist, unknown: {unknown}")
    columns = tuple((f.name, f.name, f.dataType.simpleString()) for f in df_schema.fields)
    return Commit(
        1, at or now(), operation, "base", None, 0, 0, tuple(key), tuple(places), columns, 1, 1, hidden=tuple(hidden))


def partitioning(commit: Commit) -> list[str]:
    """Partitions as they are declared, under the columns' current names."""
    made = {
        n: f"{transform}({f'{size}, ' if size else ''}{commit.logical(source)})" for n, source, transform, size in commit.hidden}
    return [made.get(p) or commit.logical(p) for p in commit.partition_by]


def _after(chain: Sequence[Commit], first: Commit) -> Commit:
    """``first`` moved behind an existing chain."""
    if not chain:
        return first
    return replace(
        first, version=chain[-1].version + 1, at=max(first.at, chain[-1].at),
        seq=max(c.seq for c in chain) + 1, floor=max(c.floor for c in chain), operation="replace",
    )


def create_or_replace(
    df: DataFrame, base: str, key: Sequence[str], partition_by: Sequence[str] = (), at: dt.datetime | None = None,
    writer: str | None = None,
) -> Commit:
    """Create the table, or replace rows, schema, key and partitioning in a new version.

    Partitions are columns, or ``day(c)``, ``month(c)`` and ``bucket(n, c)``, which are derived from a
    column, hidden in the files, and pruned by what readers ask of it. Without a key the table takes
    appends only, and rows may repeat.
    """
    spark = df.sparkSession
    draft = replace(_after(load(spark, base), _first(df.schema, "create", key, partition_by, at)), writer=writer)
    check = (lambda written: require_key(written, draft.key)) if key else None
    return commit_rows(spark, base, draft, upserts(df, draft), check)


def create_log(
    spark: SparkSession, base: str, schema: T.StructType, partition_by: Sequence[str] = (), at: dt.datetime | None = None
) -> Commit:
    """An empty table without a key; one that exists gains the columns it lacks and stays otherwise.

    A column that exists with another type, or another partitioning, is an error.
    """
    chain = load(spark, base)
    if not chain:
        return record(spark, base, _first(schema, "create", (), partition_by, at))
    head = resolve(chain)
    have = {n: t for n, _, t in head.columns}
    other = [f.name for f in schema.fields if have.get(f.name, f.dataType.simpleString()) != f.dataType.simpleString()]
    if other or partitioning(head) != list(partition_by):
        raise ValueError(f"the table has other types or partitions: {other or list(head.partition_by)}")
    for f in schema.fields:
        if f.name not in have:
            add_column(spark, base, f.name, f.dataType.simpleString(), at)
    return resolve(load(spark, base))


def adopt(
    spark: SparkSession, path: str, base: str, key: Sequence[str], partition_by: Sequence[str] = (),
    at: dt.datetime | None = None,
) -> Commit:
    """Turn existing Parquet files into version 1 of a table where they lie; nothing is copied."""
    if load(spark, base):
        raise ValueError(f"{base} already is a table")
    if not path.startswith("/") and "://" not in path:
        raise ValueError("give the absolute path of the files")
    found = spark.read.parquet(path)
    require_key(found, key)
    draft = _first(found.schema, "adopt", key, partition_by, at)
    if draft.hidden:
        raise ValueError("files that lie where they are have no hidden partitions")
    return record(spark, base, replace(draft, data=path, upserts=found.count()))


def dual_write(
    df: DataFrame, path: str, base: str, key: Sequence[str], partition_by: Sequence[str] = (),
    at: dt.datetime | None = None,
) -> Commit:
    """Write the same rows as a plain and as a versioned table.

    The versioned table is written from the plain one, so ``df`` runs once and both hold the
    same rows even if it would not give them twice.
    """
    plain = write_table(df, path, partition_by=partition_by)
    return create_or_replace(plain, base, key, partition_by, at)


def append(
    df: DataFrame, base: str, at: dt.datetime | None = None, writer: str | None = None, batch: int | None = None,
) -> Commit:
    """Add rows; a row whose key the table already holds replaces the old one.

    When all keys are new, which is checked by a semi-join on the key columns, the commit is
    marked ``fresh`` and readers take its rows as they are. The check looks only at rows in
    the new keys' range, so ever-growing keys touch little of the table. Rows of a table without
    a key are always new.

    A ``batch`` that its ``writer`` has already committed is not appended again: the commit it
    left is returned.
    """
    spark = df.sparkSession
    chain = load(spark, base)
    if writer is not None and (done := committed(chain, writer, batch)):
        return done
    draft = successor(chain, "append", "delta", at, writer=writer, batch=batch)
    extra = [c for c in df.columns if c not in draft.schema.names]
    if extra:
        raise ValueError(f"columns the table does not have: {extra}")
    head = resolve(chain)
    if not head.key:
        return commit_rows(spark, base, replace(draft, kind="fresh"), upserts(df, draft))

    def kind(written: DataFrame) -> str:
        require_key(written, draft.key)
        lead, new = draft.key[0], written.select(*draft.key)
        low, high = written.agg(F.min(f"`{lead}`"), F.max(f"`{lead}`")).first()
        current = state(spark, base, chain, head).select(*head.key_names).toDF(*draft.key)
        current = current.where(F.col(f"`{lead}`").between(F.lit(low), F.lit(high)))
        known = current.join(new, list(draft.key), "left_semi").head(1)
        return "delta" if known else "fresh"

    return commit_rows(spark, base, draft, upserts(df, draft), kind)


def _keyed(head: Commit) -> Commit:
    if not head.key:
        raise ValueError("a table without a key takes appends only")
    return head


def drop_range(
    spark: SparkSession, base: str, column: str, op: str, value: object, at: dt.datetime | None = None,
    operation: str = "drop range",
) -> Commit:
    """Take away the rows whose ``column`` is less than (``<``) or equal to (``=``) ``value``; no data is written.

    The commit holds the range, and readers of it and of later versions leave out what earlier
    commits have in it: as partition filters where the table is partitioned by the column. Rows
    where it is NULL stay. ``maintenance.expire`` removes the files.
    """
    if op not in ("<", "="):
        raise ValueError("a range is < or =")
    chain = load(spark, base)
    head = resolve(chain)
    physical = head.physical(column)
    return record(spark, base, successor(chain, operation, "drop", at, drops=((physical, op, str(value)),)))


def update(
    spark: SparkSession, base: str, where: Column | str, set: Mapping[str, Column | str],
    at: dt.datetime | None = None,
) -> Commit:
    """UPDATE ... SET ... WHERE: new images of the matching rows; right sides see the old row."""
    chain = load(spark, base)
    head = _keyed(resolve(chain))
    moved = [c for c in set if c in head.key_names]
    if moved:
        raise ValueError(f"key columns identify rows and cannot be set: {moved}")
    rows = state(spark, base, chain, head)
    for name in set:
        head.physical(name)  # fails on an unknown column
    new = {n: F.expr(v) if isinstance(v, str) else v for n, v in set.items()}
    hit = rows.where(where).withColumns(new)
    return commit_rows(spark, base, successor(chain, "update", "delta", at), upserts(hit, head))


def delete(spark: SparkSession, base: str, where: Column | str, at: dt.datetime | None = None) -> Commit:
    """DELETE WHERE: tombstones for the matching rows; a NULL predicate keeps the row."""
    chain = load(spark, base)
    head = _keyed(resolve(chain))
    hit = state(spark, base, chain, head).where(where)
    return commit_rows(spark, base, successor(chain, "delete", "delta", at), tombstones(hit, head))


def merge(
    spark: SparkSession,
    base: str,
    source: DataFrame,
    on: Sequence[str],
    matched_update: Mapping[str, Column] | None = None,
    matched_delete: Column | None = None,
    insert: Mapping[str, Column] | None = None,
    at: dt.datetime | None = None,
    writer: str | None = None,
) -> Commit:
    """MERGE INTO on the table's key; expressions name the target ``t`` and the source ``s``.

    For a matched row ``matched_delete`` is tried first, then ``matched_update``; a source row
    without a match becomes an ``insert``. A key that the source repeats fails the job.

    Only rows the source touches can change, so the target is first cut down by a semi-join
    on the source's keys, which are written first: Spark sees their size and broadcasts few of
    them itself, so that the target is scanned in place. The source is computed once, and only its
    keys are grouped to see whether one repeats.
    """
    chain = load(spark, base)
    head = _keyed(resolve(chain))
    if sorted(on) != sorted(head.key_names):
        raise ValueError(f"merge on the table's key {head.key_names}")
    once = settled(source)
    keys = once.select(*on)
    fault = F.raise_error(F.lit(f"source repeats a value of {list(on)}")).cast("long")
    keys.groupBy(*on).agg(F.count("*").alias("_n")).agg(F.max(F.when(F.col("_n") > 1, fault))).collect()
    target = state(spark, base, chain, head)
    touched = target.join(keys, list(on), "left_semi").withColumn("_hit", F.lit(True))
    s, t = once.alias("s"), touched.alias("t")
    same = F.lit(True)
    for k in on:
        same = same & (F.col(f"s.{k}") == F.col(f"t.{k}"))
    joined = s.join(t, same, "left")

    hit = F.col("t._hit").isNotNull()
    gone = F.coalesce(matched_delete, F.lit(False)) if matched_delete is not None else F.lit(False)
    action = F.when(hit & gone, F.lit(DELETE))
    if matched_update is not None:
        action = action.when(hit, F.lit(UPSERT))
    if insert is not None:
        action = action.when(~hit, F.lit(UPSERT))

    cells = []
    for name, physical, ddl in head.columns:
        old, new = F.col(f"t.{name}"), F.lit(None)
        if name in on:
            old = new = F.col(f"s.{name}")
        elif insert is not None and name in insert:
            new = insert[name]
        if matched_update is not None and name in matched_update and name not in on:
            old = F.when(gone, old).otherwise(matched_update[name])
        cells.append(F.when(hit, old).otherwise(new).cast(ddl).alias(physical))
    rows = joined.select(*cells, action.alias(OP)).where(F.col(OP).isNotNull())
    return commit_rows(
        spark, base, successor(chain, "merge", "delta", at, writer=writer), rows,
        lambda written: require_no_null(written, head.key),
    )


def require_no_null(df: DataFrame, key: Sequence[str]) -> None:
    bad = F.lit(False)
    for k in key:
        bad = bad | F.col(f"`{k}`").isNull()
    if df.where(bad).head(1):
        raise ValueError(f"key {list(key)} must not be NULL")


# --- schema evolution ------------------------------------------------------------------


def _require_free(name: str, taken: Sequence[str]) -> None:
    """Names that differ only in case are one name to Spark."""
    if name.lower() in {n.lower() for n in [*taken, *RESERVED]}:
        raise ValueError(f"column {name} exists or is reserved")


def _reshape(spark: SparkSession, base: str, operation: str, columns, at) -> Commit:
    chain = load(spark, base)
    return record(spark, base, successor(chain, operation, "schema", at, columns=tuple(columns)))


def add_column(spark: SparkSession, base: str, name: str, type: str, at: dt.datetime | None = None) -> Commit:
    """ADD COLUMN: NULL in every earlier row; no data is written."""
    chain = load(spark, base)
    head = resolve(chain)
    _require_free(name, head.schema.names)
    ddl = T.StructType.fromDDL(f"c {type}")["c"].dataType.simpleString()
    used = {p.lower() for c in chain for _, p, _ in c.columns}
    physical = name
    while physical.lower() in used:  # files may still hold an older column of this name
        physical = f"{physical}__{chain[-1].version + 1}"
    return _reshape(spark, base, "add column", [*head.columns, (name, physical, ddl)], at)


def rename_column(spark: SparkSession, base: str, old: str, new: str, at: dt.datetime | None = None) -> Commit:
    """RENAME COLUMN: the files keep the physical name."""
    head = resolve(load(spark, base))
    head.physical(old)
    _require_free(new, [n for n in head.schema.names if n != old])
    columns = [(new if n == old else n, p, t) for n, p, t in head.columns]
    return _reshape(spark, base, "rename column", columns, at)


def drop_column(spark: SparkSession, base: str, name: str, at: dt.datetime | None = None) -> Commit:
    """DROP COLUMN: hidden from this version on; earlier versions still show it."""
    head = resolve(load(spark, base))
    if head.physical(name) in (*head.key, *head.partition_by, *[source for _, source, _, _ in head.hidden]):
        raise ValueError(f"{name} is a key or partition column")
    return _reshape(spark, base, "drop column", [c for c in head.columns if c[0] != name], at)
