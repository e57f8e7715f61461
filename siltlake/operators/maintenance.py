"""Expiry, orphan files, rewriting of small files and retention by days."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltlake.functions.sizing import settled
from siltlake.operators import dml
from siltlake.operators.changelog import (
    DIRECTORY, OP, UPSERT, VERSION, Commit, drops_after, fold_commits, live, load, location, members, needed, newest_rows,
    record, resolve, scan, state, state_rows, successor, upserts, with_hidden, write_log,
)
from siltlake.session import delete_path


def expire(spark: SparkSession, base: str, older_than: dt.datetime) -> Commit:
    """Forget versions made before ``older_than``, but never the current one nor what a cursor still has to read.

    The oldest version that stays becomes a base if changes of rows lie before it: its state is
    written to a new directory, and one commit row moves the table over to it. Where only rows
    were added, which is all that a log table sees, nothing is written. Only then are directories
    removed that no live version reads, partitions that lie in a range dropped before, and commit
    rows that say nothing any more, so a job lost on the way leaves the table as it was.
    """
    chain = load(spark, base)
    alive = live(chain)
    wanted = _cursors(spark, base)
    kept = [c for c in alive if c.at >= older_than or c.version >= wanted] or alive[-1:]
    first = kept[0]
    if first is alive[0]:
        return first
    before = needed(chain)
    folded = replace(first, floor=first.version, seq=max(c.seq for c in chain) + 1)
    if members(chain, first)[1]:
        rows = upserts(state(spark, base, chain, first), first)
        folded = replace(
            folded, kind="base", data=write_log(rows, base, first.version, first.partition_by, hidden=first.hidden)
        )
    record(spark, base, folded)
    chain = load(spark, base)
    for data in before - needed(chain):
        if data.startswith("log/"):
            delete_path(spark, f"{base}/{data}")
    _remove_dropped(spark, base, chain, folded)
    fold_commits(spark, base)
    return folded


def _cursors(spark: SparkSession, base: str) -> float:
    """The least version that a cursor of the table stands at."""
    try:
        rows = spark.read.schema("low long, high long, done boolean").option("recursiveFileLookup", "true").parquet(f"{base}/cursors")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return math.inf
        raise
    # Between two writes a cursor has a row too many; the lesser version is the safe one.
    least = rows.agg(F.min(F.when(F.col("done"), F.col("high")).otherwise(F.col("low")))).first()[0]
    return math.inf if least is None else least


def _remove_dropped(spark: SparkSession, base: str, chain: Sequence[Commit], first: Commit) -> None:
    """Delete partition directories that lie in ranges which the oldest live version has already lost."""
    read = needed(chain)
    for c in chain:
        lost = [d for d in drops_after(chain, c, first) if d[0] in c.partition_by] if c.data in read and not c.adopted else []
        if not lost or c.kind == "delta":
            continue
        types = {p: t for _, p, t in c.columns}
        listed = _listing(spark, location(base, c)).select(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("place")).distinct()
        gone = F.lit(False)
        for column, op, value in lost:
            text = F.regexp_extract("place", rf"/{column}=([^/]*)", 1)
            cell = F.when(text != "__HIVE_DEFAULT_PARTITION__", F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))).try_cast(types[column])
            bound = F.lit(value).cast(types[column])
            gone = gone | F.coalesce((cell < bound) if op == "<" else (cell == bound), F.lit(False))
        for row in listed.where(gone).toLocalIterator():  # one per partition that goes
            delete_path(spark, row.place)


def _listing(spark: SparkSession, *places: str) -> DataFrame:
    """``(path, length, modificationTime)`` of the data files below some directories; none is opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return reader.load(list(places)).select("path", "length", "modificationTime")


def rewrite(
    spark: SparkSession, base: str, target_mb: float = 128, sort_by: Sequence[str] = (),
    at: dt.datetime | None = None, fill: float = 0.5, fold: bool = False,
) -> Commit:
    """Write badly sized files anew as files of about ``target_mb``, in a new version of the same rows.

    Commit directories are read and written only if they hold a file of more than twice the
    target, or small files (``fill`` of the target on average, or less) that go together: within
    a partition, small directories fill one bin after the other in the order of their versions,
    and one that is alone in all its bins would gain nothing. The others keep their path and time.
    The commit names the versions whose rows it holds; earlier versions read their own files.

    Rows that changes have replaced are left out, and more than one change directory is folded
    into one by another commit. Where every directory is small, or with ``fold``, the changes are
    applied and the new directory is the whole table. Rows are range-partitioned on
    partition columns, then the sort columns (or the key), so that a partition value that holds
    much of them is split between tasks and a file covers a narrow range. A table that gains
    nothing stays as it is, and its current commit is returned.
    """
    chain = load(spark, base)
    head = resolve(chain)
    plain, deltas = members(chain, head)
    target = target_mb * 1024 * 1024
    sizes = _sizes(spark, base, plain, head)
    whole = sizes.groupBy("version").agg(
        F.sum("bytes").alias("bytes"), F.sum("files").alias("files"), F.max("largest").alias("largest"))
    # Names of directories, which go into the commit: one per small or oversized commit.
    judged = whole.select("version", (F.col("bytes") < fill * target * F.col("files")).alias("small")).where(
        F.col("small") | (F.col("largest") > 2 * target)).collect()
    small = [r.version for r in judged if r.small]
    fold = bool(deltas) and (fold or len(small) == len(plain))
    if fold:
        chosen = {c.version for c in plain}
    else:
        bins = _bins(sizes.where(F.col("version").isin(small)), head.partition_by, target)
        together = Window.partitionBy(*[F.col(f"`{p}`") for p in head.partition_by], "bin")
        gain = bins.withColumn("all", F.sum("files").over(together)).where("all > 1").select("version").distinct()
        chosen = {r.version for r in judged if not r.small} | {r.version for r in gain.collect()}
    if chosen:
        draft = successor(chain, "rewrite", "fresh", at, merged=tuple(sorted(chosen)))
        rows = state_rows(spark, base, chain, head, None if fold else chosen).withColumn(OP, F.lit(UPSERT))
        if fold:
            draft, rows = replace(draft, kind="base", merged=()), rows.drop(VERSION)
        held = whole.where(F.col("version").isin(chosen)).agg(F.sum("bytes")).first()[0] or 0
        order = [*head.partition_by]
        order += [p for p in map(head.physical, sort_by or head.key_names) if p not in order]
        rows = _placed(with_hidden(rows, head.hidden), math.ceil(held / target), order)
        data = write_log(rows, base, draft.version, draft.partition_by, placed=True)
        head = record(spark, base, replace(draft, data=data))
    if len(deltas) > 1 and not fold:
        chain = load(spark, base)
        draft = successor(chain, "rewrite", "delta", at, merged=tuple(c.version for c in deltas))
        newest = newest_rows(scan(spark, base, deltas, head.physical_schema), head.key, deltas)
        head = record(spark, base, replace(draft, data=write_log(newest, base, draft.version, draft.partition_by, hidden=draft.hidden)))
    return head


def _placed(rows: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """``rows`` in ``n`` ranges of ``order``, sorted; without an order they are only spread."""
    keys = [F.col(f"`{c}`") for c in order]
    if not keys:
        return rows.repartition(max(1, n))
    return rows.repartitionByRange(max(1, n), *keys).sortWithinPartitions(*keys)


def _sizes(spark: SparkSession, base: str, commits: Sequence[Commit], head: Commit) -> DataFrame:
    """``(version, <partition values as text>, bytes, files, largest)`` of commit directories, by listing."""
    own = [c for c in commits if not c.adopted and c.partition_by == head.partition_by]
    listed = "path string, length long, modificationTime timestamp, version long"
    parts = [spark.createDataFrame([], listed)]
    if own:
        names = spark.createDataFrame([(c.data.removeprefix("log/"), c.version) for c in own], "directory string, version long")
        found = _listing(spark, *[location(base, c) for c in own]).withColumn(
            "directory", F.regexp_extract("path", rf"/log/({DIRECTORY}=[^/]+)/", 1))
        parts.append(found.join(names, "directory").drop("directory"))
    for c in commits:
        if c not in own:  # adopted files and other layouts
            parts.append(_listing(spark, location(base, c)).withColumn("version", F.lit(c.version).cast("long")))
    values = [F.regexp_extract("path", rf"/{p}=([^/]*)/", 1).alias(p) for p in head.partition_by]
    return (
        reduce(DataFrame.unionByName, parts).groupBy("version", *values)
        .agg(F.sum("length").alias("bytes"), F.count("*").alias("files"), F.max("length").alias("largest"))
    )


def _bins(sizes: DataFrame, partition_by: Sequence[str], target: float) -> DataFrame:
    """``sizes`` with ``bin``: within a partition, directories fill bins of ``target`` bytes one after the other."""
    upto = Window.partitionBy(*[F.col(f"`{p}`") for p in partition_by]).orderBy("version").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("bin", F.floor(F.coalesce(F.sum("bytes").over(upto), F.lit(0)) / target).cast("int"))


def apply_retention(
    spark: SparkSession, base: str, column: str, days: int, as_of: dt.date | None = None, at: dt.datetime | None = None
) -> Commit:
    """Drop what is older than the last ``days`` days up to ``as_of`` (by default the newest day held).

    ``column`` is a date the table is partitioned by. The new version prunes the directories of
    older days, earlier versions still show them, and ``expire`` removes them; rows without a
    date stay. Nothing is committed where no day is old enough.
    """
    chain = load(spark, base)
    head = resolve(chain)
    if head.physical(column) not in head.partition_by or head.schema[column].dataType.typeName() != "date":
        raise ValueError(f"{column} is no date that the table is partitioned by")
    days_held = state(spark, base, chain, head).agg(F.min(column), F.max(column)).first()
    end = as_of or days_held[1]
    if end is None or days_held[0] is None or days_held[0] > (bound := end - dt.timedelta(days=days)):
        return head
    return dml.drop_range(spark, base, column, "<", bound + dt.timedelta(days=1), at, "retention")


def orphans(
    spark: SparkSession, base: str, older_than: dt.datetime, delete: bool = False
) -> DataFrame:
    """Files below ``log/`` in directories that no live version names.

    A directory counts once all its files are older than ``older_than``, so a commit that is
    still being written is left alone. Files are listed, not opened. ``delete`` removes the
    directories; the returned rows then are what was removed.
    """
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .load(f"{base}/log").select("path", "length", "modificationTime")
        .withColumn("directory", F.regexp_extract("path", rf"/log/({DIRECTORY}=[^/]+)/", 1))
    )
    named = [d.removeprefix("log/") for d in needed(load(spark, base)) if d.startswith("log/")]
    known = spark.createDataFrame([(d,) for d in named], "directory string")
    loose = found.join(known, "directory", "left_anti")
    old = (
        loose.groupBy("directory").agg(F.max("modificationTime").alias("newest"))
        .where(F.col("newest").cast("timestamp_ntz") < F.lit(older_than).cast("timestamp_ntz"))
    )
    out = loose.join(old, "directory", "left_semi").select(
        "directory", "path", "length", "modificationTime"
    )
    if delete:
        out = settled(out)
        for row in out.select("directory").distinct().toLocalIterator():  # one per failed attempt
            delete_path(spark, f"{base}/log/{row.directory}")
    return out


def retain(df: DataFrame, date_col: str, days: int, as_of: dt.date | Column) -> DataFrame:
    """Rows of the last ``days`` days up to ``as_of``; later ones stay, undated ones go.

    The bound is a constant or a scalar subquery, so on a date-partitioned table it prunes
    partitions.
    """
    end = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return df.where(F.col(date_col).cast("date") > F.date_sub(end, days))
