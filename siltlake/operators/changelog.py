"""Versioned tables on plain Parquet: an append-only change log and its commits.

A table directory holds

* ``log/_dir=<name>/``: one Parquet data set per commit, row columns plus ``_op``
  (``U`` upsert, ``D`` delete) and ``_version``;
* ``commits/``: one small row per commit, written after the data, so a version exists
  only once its data is complete.

Three kinds of commit carry data. A ``base`` is the whole table. ``fresh`` rows have keys
the table did not hold, and ``delta`` rows replace or remove earlier rows. The state at a
version is the last base and the fresh rows after it, *anti-joined* with the keys that the
deltas touched, plus the newest delta row of each key:

    base + fresh  LEFT ANTI  touched keys    UNION ALL    newest delta rows

so filters and column pruning reach the scan of the base, a small delta is broadcast, and
only the deltas are ever folded per key. Columns have a stable physical name in the files
and a per-version logical name, so renaming or dropping one rewrites nothing. There is one
writer at a time.

Some commits write no data of their own or stand for others'. A ``merged`` list names
versions whose rows a later commit holds in fewer files: from then on they are read there.
``drops`` are ranges or values of a column that are gone from all earlier commits; on a
partition column they prune directories. ``writer`` and ``batch`` name the micro-batch a
commit came from, so that one that is replayed is known. ``hidden`` columns are derived from
others, stand in the files for their partitions only, and are in no result: ranges and values
asked of their source are turned into ranges and values of them. A table without a key takes
appends only.
"""

from __future__ import annotations

import datetime as dt
import decimal
import uuid
from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltlake.session import delete_path
from siltlake.sinks.parquet import laid_out
from siltlake.sources.tables import conform

OP, VERSION, DIRECTORY = "_op", "_version", "_dir"
RESERVED = (OP, VERSION, DIRECTORY)
UPSERT, DELETE = "U", "D"
LOG_FIELDS = (T.StructField(OP, T.StringType()), T.StructField(VERSION, T.LongType()))

COMMIT_SCHEMA = (
    "_version long, committed_at timestamp_ntz, operation string, kind string, data string, "
    "upserts long, deletes long, key array<string>, partition_by array<string>, "
    "columns array<struct<name: string, physical: string, type: string>>, floor long, seq long, "
    "writer string, batch long, merged array<long>, drops array<struct<column: string, op: string, value: string>>, "
    "hidden array<struct<name: string, source: string, transform: string, size: int>>"
)


class NoSuchVersion(ValueError):
    """The version or time is unknown to the table, or has been expired."""


@dataclass(frozen=True)
class Commit:
    """One row of the commits data set; ``key`` and ``partition_by`` are physical names."""

    version: int
    at: dt.datetime
    operation: str
    kind: str  # base, fresh, delta or schema
    data: str | None  # below the table directory, or an absolute path for adopted files
    upserts: int
    deletes: int
    key: tuple[str, ...]
    partition_by: tuple[str, ...]
    columns: tuple[tuple[str, str, str], ...]  # (logical name, physical name, type)
    floor: int  # versions below are expired
    seq: int  # a later record of the same version replaces an earlier one
    writer: str | None = None
    batch: int | None = None
    merged: tuple[int, ...] = ()
    drops: tuple[tuple[str, str, str], ...] = ()  # (physical name, "<" or "=", value as text)
    hidden: tuple[tuple[str, str, str, int], ...] = ()  # (name, physical source, transform, buckets)

    @property
    def adopted(self) -> bool:
        return self.data is not None and not self.data.startswith("log/")

    def physical(self, name: str) -> str:
        for logical, physical, _ in self.columns:
            if logical == name:
                return physical
        raise ValueError(f"no column {name}")

    def logical(self, physical: str) -> str:
        return next(n for n, p, _ in self.columns if p == physical)

    @property
    def key_names(self) -> list[str]:
        return [self.logical(p) for p in self.key]

    @property
    def schema(self) -> T.StructType:
        """The table's schema at this version, in logical names."""
        return T.StructType([T.StructField(n, _type(t)) for n, _, t in self.columns])

    @property
    def physical_schema(self) -> T.StructType:
        return T.StructType([T.StructField(p, _type(t)) for _, p, t in self.columns])


def _type(ddl: str) -> T.DataType:
    return T.StructType.fromDDL(f"c {ddl}")["c"].dataType


def now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


# --- commits ---------------------------------------------------------------------------


def load(spark: SparkSession, base: str) -> list[Commit]:
    """Commits in version order, expired ones too where their data is still read; a few hundred bytes each."""
    found = _commit_rows(spark, base)
    newest = {
        r[VERSION]: Commit(
            r[VERSION], r.committed_at, r.operation, r.kind, r.data, r.upserts, r.deletes,
            tuple(r.key), tuple(r.partition_by), tuple(tuple(c) for c in r.columns), r.floor, r.seq,
            r.writer, r.batch, tuple(r.merged or ()), tuple(tuple(d) for d in r.drops or ()), tuple(tuple(h) for h in r.hidden or ()),
        )
        for r in sorted(found.collect() if found else (), key=lambda r: r.seq)
    }
    return [newest[v] for v in sorted(newest)]


def _commit_rows(spark: SparkSession, base: str) -> DataFrame | None:
    try:
        return spark.read.schema(COMMIT_SCHEMA).parquet(f"{base}/commits")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def fold_commits(spark: SparkSession, base: str) -> None:
    """Put the commits into one file; those that are expired and whose data nothing reads go.

    The new file is complete before the old ones are removed, and a commit that stands in both is
    the same one, so a job lost in between changes nothing.
    """
    rows = spark.read.schema(COMMIT_SCHEMA).parquet(f"{base}/commits")
    before = [r.file_path for r in rows.select("_metadata.file_path").distinct().collect()]
    chain = load(spark, base)
    read, last = needed(chain), {c.writer: c.version for c in chain}
    floor = max(c.floor for c in chain)
    # A writer's last batch may still be replayed, and a drop counts as long as older rows are read.
    known = [c for c in chain if c.version >= floor or c.data in read or c.batch is not None and last[c.writer] == c.version]
    known = sorted({*known, *(c for c in chain if c.drops and any(k.version < c.version and k.data for k in known))}, key=lambda c: c.version)
    # Tuples of the row's shape; at most a few hundred bytes per commit that still counts.
    spark.createDataFrame([_row(c) for c in known], COMMIT_SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/commits")
    for path in before:
        delete_path(spark, path)


def _row(c: Commit) -> tuple:
    return (
        c.version, c.at, c.operation, c.kind, c.data, c.upserts, c.deletes, list(c.key), list(c.partition_by), list(c.columns),
        c.floor, c.seq, c.writer, c.batch, list(c.merged), list(c.drops), list(c.hidden),
    )


def live(chain: Sequence[Commit]) -> list[Commit]:
    """Commits that have not been expired."""
    if not chain:
        raise NoSuchVersion("the table has no commits")
    floor = max(c.floor for c in chain)
    return [c for c in chain if c.version >= floor]


def resolve(
    chain: Sequence[Commit], version: int | None = None, as_of: dt.datetime | None = None
) -> Commit:
    """The commit a version number or a time stands for; the current one by default."""
    alive = live(chain)
    if version is not None and as_of is not None:
        raise ValueError("give a version or a time, not both")
    if as_of is not None:
        known = [c for c in alive if c.at <= as_of]
        if not known:
            raise NoSuchVersion(f"no version at {as_of}")
        return known[-1]
    if version is not None:
        for c in alive:
            if c.version == version:
                return c
        raise NoSuchVersion(f"no version {version}")
    return alive[-1]


def record(spark: SparkSession, base: str, commit: Commit) -> Commit:
    """Append one commit row: the single write that makes a version visible."""
    def texts(values: Sequence[str]) -> Column:
        return F.array(*map(F.lit, values)).cast("array<string>")

    def structs(rows: Sequence[tuple], *names: str) -> Column:
        return F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(r, names)]) for r in rows])

    cells = {
        VERSION: F.lit(commit.version), "committed_at": F.lit(commit.at.isoformat(sep=" ")),
        "operation": F.lit(commit.operation), "kind": F.lit(commit.kind), "data": F.lit(commit.data),
        "upserts": F.lit(commit.upserts), "deletes": F.lit(commit.deletes), "key": texts(commit.key),
        "partition_by": texts(commit.partition_by), "columns": structs(commit.columns, "name", "physical", "type"),
        "floor": F.lit(commit.floor), "seq": F.lit(commit.seq), "writer": F.lit(commit.writer), "batch": F.lit(commit.batch),
        "merged": F.array(*map(F.lit, commit.merged)),
        "drops": structs(commit.drops, "column", "op", "value"),
        "hidden": structs(commit.hidden, "name", "source", "transform", "size"),
    }
    row = spark.range(0, 1, 1, 1).select(
        *[cells[f.name].cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(COMMIT_SCHEMA).fields]
    )
    row.write.mode("append").parquet(f"{base}/commits")
    return commit


def successor(chain: Sequence[Commit], operation: str, kind: str, at: dt.datetime | None, **changes) -> Commit:
    """The next commit after ``chain``; times never run backwards."""
    last = chain[-1]
    fields = {"data": None, "upserts": 0, "deletes": 0, "writer": None, "batch": None, "merged": (), "drops": (), **changes}
    return replace(
        last, version=last.version + 1, at=max(at or now(), last.at), operation=operation,
        kind=kind, seq=max(c.seq for c in chain) + 1, **fields,
    )


def committed(chain: Sequence[Commit], writer: str, batch: int) -> Commit | None:
    """The commit that a micro-batch of a writer has left, if it has."""
    return next((c for c in chain if c.writer == writer and c.batch == batch), None)


# --- data ------------------------------------------------------------------------------


def location(base: str, commit: Commit) -> str:
    return commit.data if commit.adopted else f"{base}/{commit.data}"


# --- hidden partitions -------------------------------------------------------------------

#: The transforms, the type of what they give, and whether they keep the order of values.
TRANSFORMS = {"day": ("date", True), "month": ("date", True), "bucket": ("int", False)}


def derived(transform: str, size: int, value: Column) -> Column:
    if transform == "day":
        return value.cast("date")
    if transform == "month":
        return F.trunc(value.cast("date"), "month")
    return F.when(value.isNotNull(), F.pmod(F.xxhash64(value), F.lit(size)).cast("int"))


def hidden_fields(hidden: Sequence[tuple[str, str, str, int]]) -> list[T.StructField]:
    return [T.StructField(n, _type(TRANSFORMS[transform][0])) for n, _, transform, _ in hidden]


def with_hidden(rows: DataFrame, hidden: Sequence[tuple[str, str, str, int]]) -> DataFrame:
    return rows.withColumns({
        n: derived(transform, size, F.col(f"`{source}`")) for n, source, transform, size in hidden if n not in rows.columns})


@dataclass(frozen=True)
class Asked:
    """Values of one column that a reader wants: ``low <= column < high``, or just ``value``."""

    column: str
    low: object = None
    high: object = None
    value: object = None

    def rows(self, cell: Column, type: T.DataType) -> Column:
        tests = [(self.low, lambda v: cell >= v), (self.high, lambda v: cell < v), (self.value, lambda v: cell == v)]
        return reduce(lambda a, b: a & b, [t(F.lit(v).cast(type)) for v, t in tests if v is not None], F.lit(True))

    def partitions(self, cell: Column, transform: str, size: int, type: T.DataType) -> Column:
        """What holds of the derived column in every row wanted; the last value of a range may lie in the next partition."""
        at = lambda v: derived(transform, size, F.lit(v).cast(type))
        tests = [(self.value, lambda v: cell == at(v))]
        if TRANSFORMS[transform][1]:
            tests += [(self.low, lambda v: cell >= at(v)), (self.high, lambda v: cell <= at(v))]
        return reduce(lambda a, b: a & b, [t(v) for v, t in tests if v is not None], F.lit(True))


Drops = tuple[tuple[str, str, str], ...]


def drops_after(chain: Sequence[Commit], commit: Commit, head: Commit) -> Drops:
    """What later commits up to ``head`` took away from the rows of ``commit``; of ranges the widest."""
    found: dict[tuple[str, str], list[str]] = {}
    for c in chain:
        if commit.version < c.version <= head.version:
            for column, op, value in c.drops:
                found.setdefault((column, op), []).append(value)
    types = {p: t for _, p, t in head.columns}

    def rank(column: str):
        numeric = isinstance(_type(types.get(column, "string")), T.NumericType)
        return decimal.Decimal if numeric else str

    return tuple(sorted(
        (column, op, value) for (column, op), values in found.items()
        for value in ([max(values, key=rank(column))] if op == "<" else set(values))
    ))


def gone(drop: tuple[str, str, str], schema: T.StructType) -> Column:
    """Whether a row is dropped; NULL is in no range and equals nothing."""
    column, op, value = drop
    cell, bound = F.col(f"`{column}`"), F.lit(value).cast(schema[column].dataType)
    return cell.isNotNull() & ((cell < bound) if op == "<" else (cell == bound))


def scan(
    spark: SparkSession, base: str, commits: Sequence[Commit], schema: T.StructType, extra: Sequence[str] = (),
    drops: Callable[[Commit], Drops] = lambda c: (), asked: Sequence[Asked] = (),
) -> DataFrame:
    """Log rows of some commits, as physical columns plus ``_op`` and ``_version``.

    The schema is given, not inferred: no file is opened to plan the scan, and a column
    that older files lack reads as NULL. Commits that share a layout and have lost the same
    ranges, which ``drops`` tells, are one scan. Of what is ``asked`` of physical columns, the
    rows that have it are returned.
    """
    groups: dict[tuple, list[Commit]] = {}
    for c in commits:
        groups.setdefault((c.partition_by, c.version if c.adopted else None, drops(c), c.hidden), []).append(c)
    scans = []
    for (_, adopted, lost, hidden), members in groups.items():
        reader = spark.read.schema(T.StructType([*schema.fields, *hidden_fields(hidden), *LOG_FIELDS]))
        if adopted is None:
            # Directories of one layout are partitions of the log, not roots of their own.
            reader = reader.option("basePath", f"{base}/log")
        rows = reader.parquet(*[location(base, c) for c in members])
        if adopted is not None:
            rows = rows.withColumns({OP: F.lit(UPSERT), VERSION: F.lit(adopted).cast("long")})
        for drop in lost:
            rows = rows.where(~gone(drop, schema))
        for a in asked:
            rows = rows.where(a.rows(F.col(f"`{a.column}`"), schema[a.column].dataType))
            for n, source, transform, size in hidden:
                if source == a.column:
                    rows = rows.where(a.partitions(F.col(n), transform, size, schema[source].dataType))
        scans.append(rows.select(*[f"`{n}`" for n in schema.names], OP, VERSION, *extra))
    if not scans:
        return spark.createDataFrame([], T.StructType([*schema.fields, *LOG_FIELDS]))
    out = scans[0]
    for other in scans[1:]:
        out = out.unionByName(other)
    return out


def members(chain: Sequence[Commit], head: Commit) -> tuple[list[Commit], list[Commit]]:
    """Commits whose data makes up the state at ``head``: (base and fresh, deltas)."""
    upto = [c for c in chain if c.version <= head.version]
    start = max((i for i, c in enumerate(upto) if c.kind == "base"), default=0)
    merged = {v for c in upto for v in c.merged}
    part = [c for c in upto[start:] if c.data is not None and c.version not in merged]
    return [c for c in part if c.kind != "delta"], [c for c in part if c.kind == "delta"]


def needed(chain: Sequence[Commit]) -> set[str]:
    """Directories that some live version reads.

    A commit's data is read until a later version starts anew or holds its rows; live versions
    are the ones from the floor on, without a gap.
    """
    floor = max((c.floor for c in chain), default=0)
    bases = [c.version for c in chain if c.kind == "base"]
    merged = {v: c.version for c in reversed(chain) for v in c.merged}
    out = set()
    for c in chain:
        ends = [v for v in (*bases, merged.get(c.version, 0)) if v > c.version]
        if c.data is not None and not any(v <= floor for v in ends):
            out.add(c.data)
    return out


def state(
    spark: SparkSession, base: str, chain: Sequence[Commit], head: Commit, only: Collection[int] | None = None,
    asked: Sequence[Asked] = (),
) -> DataFrame:
    """The table at ``head``, in logical names; with ``only``, what it has from the plain rows of these versions."""
    rows = state_rows(spark, base, chain, head, only, [replace(a, column=head.physical(a.column)) for a in asked])
    return rows.select(*[F.col(f"`{p}`").alias(n) for n, p, _ in head.columns])


def state_rows(
    spark: SparkSession, base: str, chain: Sequence[Commit], head: Commit, only: Collection[int] | None = None,
    asked: Sequence[Asked] = (), near: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``state`` as log rows: physical columns, ``_op`` and the version each row was written in.

    Rows that ``near`` drops, which judges each by itself, are in no result; plain rows pass it before
    the touched keys are looked up.
    """
    plain, deltas = members(chain, head)
    schema, key = head.physical_schema, list(head.key)
    rows = scan(
        spark, base, [c for c in plain if only is None or c.version in only], schema,
        drops=lambda c: drops_after(chain, c, head), asked=asked)
    if near is not None:
        rows = near(rows)
    if deltas:
        changed = scan(spark, base, deltas, schema)
        newest, touched = newest_rows(changed, key, deltas), changed.select(*key, VERSION)
        if len(deltas) > 1:
            touched = touched.groupBy(*key).agg(F.max(VERSION).alias(VERSION))
        r, t = rows.alias("r"), touched.alias("t")
        same = F.col(f"t.{VERSION}") > F.col(f"r.{VERSION}")
        for k in key:
            same = same & (F.col(f"r.`{k}`") == F.col(f"t.`{k}`"))
        rows = r.join(t, same, "left_anti")
        if only is None:
            newest = newest.where(F.col(OP) == UPSERT)
            for a in asked:
                newest = newest.where(a.rows(F.col(f"`{a.column}`"), schema[a.column].dataType))
            for c in chain:
                for drop in c.drops if c.version <= head.version else ():
                    newest = newest.where(~(gone(drop, schema) & (F.col(VERSION) < c.version)))
            rows = rows.unionByName(newest if near is None else near(newest))
    return rows


def newest_rows(changed: DataFrame, key: Sequence[str], commits: Sequence[Commit]) -> DataFrame:
    """The last log row of each key; within one commit a key has one row already."""
    if len(commits) <= 1:
        return changed
    # One max_by per column, not one of a struct, so that unused columns are pruned.
    return changed.groupBy(*key).agg(
        *[F.max_by(f"`{c}`", VERSION).alias(c) for c in changed.columns if c not in key]
    )


def write_log(
    df: DataFrame, base: str, version: int, partition_by: Sequence[str], placed: bool = False,
    hidden: Sequence[tuple[str, str, str, int]] = (),
) -> str:
    """Write one commit's rows to a directory of their own and return its name.

    A name is never used twice, so what a failed attempt leaves behind can be neither read
    nor overwritten; ``orphans`` finds it. ``placed`` rows keep the layout they come with, and
    rows that have a version keep it.
    """
    data = f"log/{DIRECTORY}={version:08d}-{uuid.uuid4().hex[:12]}"
    rows = with_hidden(df if VERSION in df.columns else df.withColumn(VERSION, F.lit(version).cast("long")), hidden)
    writer = (rows if placed else laid_out(rows, partition_by)).write.mode("errorifexists").option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{base}/{data}")
    return data


def commit_rows(
    spark: SparkSession,
    base: str,
    draft: Commit,
    rows: DataFrame,
    check: Callable[[DataFrame], str | None] | None = None,
) -> Commit:
    """Write ``rows`` (physical columns and ``_op``), check what was written, then commit.

    ``check`` gets a scan of the written rows, so the input is computed once; it may return
    the kind of commit, or raise, and then no commit is made.
    """
    draft = replace(draft, data=write_log(rows, base, draft.version, draft.partition_by, hidden=draft.hidden))
    written = scan(spark, base, [draft], draft.physical_schema)
    if check is not None:
        try:
            draft = replace(draft, kind=check(written) or draft.kind)
        except Exception:
            delete_path(spark, location(base, draft))
            raise
    upserts, deletes = written.agg(
        F.count_if(F.col(OP) == UPSERT), F.count_if(F.col(OP) == DELETE)
    ).first()
    return record(spark, base, replace(draft, upserts=upserts, deletes=deletes))


def require_key(df: DataFrame, key: Sequence[str]) -> None:
    """Fail unless ``key`` is non-null and unique; reads the key columns only, all partitions at once."""
    bad = F.col("n") > 1
    for k in key:
        bad = bad | F.col(f"`{k}`").isNull()
    found = df.groupBy(*[f"`{k}`" for k in key]).agg(F.count("*").alias("n")).where(bad).agg(F.first(F.struct("*"))).first()[0]
    if found:
        raise ValueError(f"key {list(key)} is NULL or repeated, for example {found}")


def upserts(df: DataFrame, head: Commit) -> DataFrame:
    """Rows under the table's logical schema as physical upsert rows."""
    rows = conform(df, head.schema)
    return rows.select(*[F.col(f"`{n}`").alias(p) for n, p, _ in head.columns], F.lit(UPSERT).alias(OP))


def tombstones(df: DataFrame, head: Commit) -> DataFrame:
    """Delete rows: only key and partition columns are kept, and those that partitions derive from."""
    keep = {*head.key, *head.partition_by, *[source for _, source, _, _ in head.hidden]}
    return df.select(
        *[
            (F.col(f"`{n}`") if p in keep else F.lit(None).cast(_type(t))).alias(p)
            for n, p, t in head.columns
        ],
        F.lit(DELETE).alias(OP),
    )


# --- reading ---------------------------------------------------------------------------


def read_version(
    spark: SparkSession, base: str, version: int | None = None, as_of: dt.datetime | None = None,
    between: Mapping[str, tuple[object, object]] = {}, equal: Mapping[str, object] = {},
) -> DataFrame:
    """The current table, or the table at a version or time (UTC).

    ``between`` wants ``low <= column < high``, where None is no bound, and ``equal`` one value. On a
    column that hidden partitions derive from, both also prune directories; a plain ``where`` on
    the result gives the same rows from all of them.
    """
    chain = load(spark, base)
    asked = [Asked(c, low, high) for c, (low, high) in between.items()] + [Asked(c, value=v) for c, v in equal.items()]
    return state(spark, base, chain, resolve(chain, version, as_of), asked=asked)


def snapshots(spark: SparkSession, base: str) -> DataFrame:
    """One row per live version: id, parent, time, operation and row counts; the commits are read when it is."""
    found = _commit_rows(spark, base)
    if found is None:
        raise NoSuchVersion("the table has no commits")
    fields = ("committed_at", "operation", "upserts", "deletes")
    newest = found.groupBy(F.col(VERSION).alias("snapshot_id")).agg(*[F.max_by(c, "seq").alias(c) for c in fields])
    # Versions are numbered without a gap.
    parent = F.when(F.col("snapshot_id") > 1, F.col("snapshot_id") - 1)
    return newest.where(F.col("snapshot_id") >= found.agg(F.max("floor")).scalar()).select(
        "snapshot_id", parent.alias("parent_id"), *fields
    )


def history(spark: SparkSession, base: str) -> DataFrame:
    """When each live version became current; the log is linear, so all are ancestors."""
    return snapshots(spark, base).select(
        F.col("committed_at").alias("made_current_at"), "snapshot_id", "parent_id",
        F.lit(True).alias("is_current_ancestor"),
    )


def files(spark: SparkSession, base: str) -> DataFrame:
    """Data files behind the current version: path, size, log rows and version."""
    chain = load(spark, base)
    head = resolve(chain)
    return _with_files(spark, base, chain, head, ()).groupBy("file_path", "file_bytes").agg(
        F.count("*").alias("rows"), F.max(VERSION).alias("version")
    )


def partitions(spark: SparkSession, base: str, col: str) -> DataFrame:
    """Rows of the current version per value of ``col``, with the files that hold them."""
    chain = load(spark, base)
    head = resolve(chain)
    rows = state(spark, base, chain, head).groupBy(col).agg(F.count("*").alias("rows"))
    held = (
        _with_files(spark, base, chain, head, [head.physical(col)])
        .groupBy(F.col(head.physical(col)).alias("_value"), "file_path").agg(F.first("file_bytes").alias("b"))
        .groupBy("_value").agg(F.count("*").alias("files"), F.sum("b").alias("bytes"))
    )
    # A value may live only in superseded rows, and NULL is a value of its own.
    return rows.join(held, F.col(col).eqNullSafe(F.col("_value")), "left").select(
        col, "rows", "files", "bytes"
    )


def _with_files(
    spark: SparkSession, base: str, chain: Sequence[Commit], head: Commit, columns: Sequence[str]
) -> DataFrame:
    """Log rows behind a version with the file they come from; only the named columns are read."""
    plain, deltas = members(chain, head)
    kept = ["_metadata.file_path", "_metadata.file_size"]
    # A delta counts as a whole: its rows also hide older ones.
    lost = lambda c: () if c.kind == "delta" else drops_after(chain, c, head)
    found = scan(spark, base, [*plain, *deltas], head.physical_schema, kept, lost)
    return found.select(*columns, VERSION, "file_path", F.col("file_size").alias("file_bytes"))
