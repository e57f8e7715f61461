"""Changes between two versions, and aggregates maintained from them."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltlake.operators.changelog import (
    OP, UPSERT, VERSION, Commit, drops_after, gone, live, load, newest_rows, resolve, scan, state, state_rows,
)

# Commits that change no row.
SILENT = ("rewrite", "add column", "rename column", "drop column")

SIGN = "_sign"


def changes(spark: SparkSession, base: str, v1: int, v2: int, as_newest: bool = False) -> DataFrame:
    """Rows that differ between two versions: ``change``, then old and new images.

    ``change`` is insert, update or delete; the images are the structs ``before`` and
    ``after`` under each version's own columns, or with ``as_newest`` both under those of the
    later version. A key that was touched but ends with the same values is no change. In a table
    without a key rows come by appends and go by dropped ranges only.

    Unless the table was replaced in between, only keys that the log between the versions
    names can differ. Their new images are the newest of those log rows, and the older state
    is cut down to these keys, so the table is scanned once, for the old images.
    """
    chain = load(spark, base)
    low, high = sorted((v1, v2))
    a, b = resolve(chain, version=low), resolve(chain, version=high)
    if a.key != b.key:
        raise ValueError("the table was replaced under another key")
    between, drops = logged_between(chain, low, high)
    replaced = any(c.kind == "base" for c in between)
    lost = _lost(a, drops)
    names = {(n if replaced else p): n for n, p, _ in a.columns}
    if not a.key and not replaced:
        out = _changes_of_log(spark, base, chain, a, b, between, lost, names if as_newest else None)
        return out if v1 <= v2 else _reversed(out)
    if replaced:
        if not a.key:
            raise ValueError("rows of a replaced table without a key cannot be told apart")
        old, new = state(spark, base, chain, a), state(spark, base, chain, b)
    else:
        old, new = _touched(spark, base, chain, a, b, between, drops)
    image = F.struct("*")
    if as_newest:
        image = F.struct(*[
            (F.col(f"`{names[n if replaced else p]}`") if (n if replaced else p) in names else F.lit(None)).cast(t).alias(n)
            for n, p, t in b.columns
        ])
    before = old.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(a.key_names)], image.alias("before"))
    after = new.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(b.key_names)], F.struct("*").alias("after"))
    both = before.join(after, [f"_k{i}" for i in range(len(a.key))], "full")
    # A column is the same under its physical name; across a replacement, where physical names
    # start anew, under its name. One that was added held NULL before, so a value in it is a
    # change; one that was dropped is a change of schema, not of the row.
    same = F.lit(True)
    for n, p, _ in b.columns:
        old_name = names.get(n if replaced else p)
        was = F.lit(None) if old_name is None else F.col(f"before.`{n if as_newest else old_name}`")
        same = same & F.col(f"after.`{n}`").eqNullSafe(was)
    kind = (
        F.when(F.col("before").isNull(), "insert")
        .when(F.col("after").isNull(), "delete")
        .when(~same, "update")
    )
    found = both.select(kind.alias("change"), "before", "after").where(F.col("change").isNotNull())
    return found if v1 <= v2 else _reversed(found)


def logged_between(chain: Sequence[Commit], low: int, high: int) -> tuple[list[Commit], list[tuple[int, tuple[str, str, str]]]]:
    """Commits after ``low`` up to ``high`` whose rows may change the table, and the ranges dropped there by version."""
    span = [c for c in live(chain) if low < c.version <= high]
    return [c for c in span if c.data is not None and c.operation not in SILENT], [(c.version, d) for c in span for d in c.drops]


def _lost(a: Commit, drops: Sequence[tuple[int, tuple[str, str, str]]]) -> Column:
    return reduce(lambda x, y: x | y, [gone(d, a.physical_schema) for _, d in drops], F.lit(False))


def _touched(spark, base, chain, a, b, between, drops) -> tuple[DataFrame, DataFrame]:
    """Old and new images of the keys that the log between two versions of a keyed table names."""
    logged = scan(spark, base, between, b.physical_schema)
    touched = logged.select(*b.key)
    newest = newest_rows(logged, b.key, between).where(F.col(OP) == UPSERT)
    if drops:
        touched = touched.union(state_rows(spark, base, chain, a).where(_lost(a, drops)).select(*a.key))
        for version, d in drops:
            newest = newest.where(~(gone(d, b.physical_schema) & (F.col(VERSION) < version)))
    if drops or len(between) > 1:  # one commit has a key once
        touched = touched.distinct()
    old = state(spark, base, chain, a).join(touched.toDF(*a.key_names), a.key_names, "left_semi")
    return old, newest.select(*[F.col(f"`{p}`").alias(n) for n, p, _ in b.columns])


def signed_changes(spark: SparkSession, base: str, v1: int, v2: int) -> DataFrame:
    """What a table has lost and gained from ``v1`` to the later ``v2``: old images with ``_sign`` -1, new ones with 1.

    Columns are those of ``v2``. The images of a key are not held against each other, so a row that
    was touched and is the same comes with both signs, which cancel in a sum.
    """
    chain = load(spark, base)
    a, b = resolve(chain, version=v1), resolve(chain, version=v2)
    between, drops = logged_between(chain, v1, v2)
    if a.key and a.key == b.key and not any(c.kind == "base" for c in between):
        old, new = _touched(spark, base, chain, a, b, between, drops)
        names = {p: n for n, p, _ in a.columns}
        old = old.select(*[(F.col(f"`{names[p]}`") if p in names else F.lit(None)).cast(t).alias(n) for n, p, t in b.columns])
    else:
        found = changes(spark, base, v1, v2, as_newest=True)
        old, new = (found.where(F.col(image).isNotNull()).select(f"{image}.*") for image in ("before", "after"))
    return old.withColumn(SIGN, F.lit(-1)).unionByName(new.withColumn(SIGN, F.lit(1)))


def _changes_of_log(spark, base, chain, a, b, between, lost: Column, names: Mapping[str, str] | None) -> DataFrame:
    """Changes of a table without a key: rows that came and are still there, and rows that were dropped."""
    came = scan(spark, base, between, b.physical_schema, drops=lambda c: drops_after(chain, c, b))
    after = F.struct(*[F.col(f"`{p}`").alias(n) for n, p, _ in b.columns])
    was = [(n, p, t) for n, p, t in (a.columns if names is None else b.columns)]
    have = {p for _, p, _ in a.columns}
    before = F.struct(*[(F.col(f"`{p}`") if p in have else F.lit(None)).cast(t).alias(n) for n, p, t in was])
    went = state_rows(spark, base, chain, a).where(lost).select(F.lit("delete").alias("change"), before.alias("before"))
    return went.unionByName(came.select(F.lit("insert").alias("change"), after.alias("after")), allowMissingColumns=True).select(
        "change", "before", "after")


def _reversed(changed: DataFrame) -> DataFrame:
    turned = F.when(F.col("change") == "insert", "delete").when(F.col("change") == "delete", "insert").otherwise("update")
    return changed.select(turned.alias("change"), F.col("after").alias("before"), F.col("before").alias("after"))


#: The type that amounts add up in unless the caller names another.
EXACT = "decimal(38,18)"


def aggregate(rows: DataFrame, group: Mapping[str, Column], sums: Mapping[str, Column], exact: str = EXACT) -> DataFrame:
    """``n`` rows and exact sums per group, added up in the decimal type ``exact``.

    An amount that the type would change fails the job. A group without an amount sums to NULL.
    """
    return partial(rows, group, sums, exact).select(*group, "n", *sums)


def partial(rows: DataFrame, group: Mapping[str, Column], sums: Mapping[str, Column], exact: str) -> DataFrame:
    """``aggregate`` with the number of amounts behind each sum, as it is stored."""
    return rows.groupBy(*[c.alias(n) for n, c in group.items()]).agg(
        F.count("*").alias("n"), *[c.alias(n) for n, c in _sums(sums, exact).items()]
    )


def held(name: str) -> str:
    return f"_held_{name}"


def _sums(sums: Mapping[str, Column], exact: str) -> dict[str, Column]:
    out = {}
    for name, amount in sums.items():
        out[name] = F.sum(fitting(name, amount, amount.try_cast(exact), exact))
        out[held(name)] = F.count(amount)
    return out


def fitting(name: str, amount: Column, value: Column, exact: str) -> Column:
    """``value``, which is the amount in the type ``exact``; one that the type would change fails the job."""
    return F.when(amount.isNull() | (value == amount), value).otherwise(
        F.raise_error(F.lit(f"an amount of {name} does not fit {exact}")).cast(exact))


def refresh(
    view: DataFrame, changed: DataFrame, group: Mapping[str, Column], sums: Mapping[str, Column], exact: str = EXACT
) -> DataFrame:
    """A stored view brought up to date by rows from ``changes``, both images under the newest names.

    Each change adds its new image and takes away its old one. Counts and decimal sums stay
    exact under this; a group that loses its last row disappears, and a sum that loses its last
    amount is NULL. Changed rows are added up per group first, so a group that changed a lot is
    not gathered row by row.
    """
    plus = partial(changed.where(F.col("after").isNotNull()).select("after.*"), group, sums, exact)
    minus = partial(changed.where(F.col("before").isNotNull()).select("before.*"), group, sums, exact)
    names = ["n", *sums, *map(held, sums)]
    signed = view.unionByName(plus).unionByName(
        minus.select(*group, *[(-F.col(n)).alias(n) for n in names])
    )
    total = (
        signed.groupBy(*group)
        .agg(*[F.sum(n).cast(view.schema[n].dataType).alias(n) for n in names])
        .where(F.col("n") > 0)
    )
    return total.select(
        *group, "n", *[F.when(F.col(held(s)) > 0, F.col(s)).alias(s) for s in sums], *map(held, sums)
    )


def refresh_extremes(
    view: DataFrame, changed: DataFrame, rows: DataFrame, group: Mapping[str, Column],
    lows: Mapping[str, Column], highs: Mapping[str, Column],
) -> DataFrame:
    """A view of ``n``, minima and maxima brought up to date by rows from ``changes``.

    New values are merged in. Only a group that lost the extreme it stood at, and gained none
    as far out, is computed anew from ``rows``.
    """
    plus = _extremes(changed.where(F.col("after").isNotNull()).select("after.*"), group, lows, highs)
    minus = _extremes(changed.where(F.col("before").isNotNull()).select("before.*"), group, lows, highs)
    names = ["n", *lows, *highs]

    def tagged(part: DataFrame, tag: str) -> DataFrame:
        return part.select(*group, *[F.col(n).alias(f"{tag}_{n}") for n in names])

    sides = tagged(view, "is").unionByName(tagged(plus, "in"), True).unionByName(tagged(minus, "out"), True)
    side = sides.groupBy(*group).agg(*[F.max(c).alias(c) for c in sides.columns if c not in group])
    lost = F.lit(False)
    for n in lows:
        lost = lost | (F.col(f"out_{n}") <= F.col(f"is_{n}")) & ~F.coalesce(F.col(f"in_{n}") <= F.col(f"is_{n}"), F.lit(False))
    for n in highs:
        lost = lost | (F.col(f"out_{n}") >= F.col(f"is_{n}")) & ~F.coalesce(F.col(f"in_{n}") >= F.col(f"is_{n}"), F.lit(False))
    count = [F.coalesce(F.col(f"{tag}_n"), F.lit(0)) for tag in ("is", "in", "out")]
    side = side.withColumns({"_n": count[0] + count[1] - count[2], "_lost": F.coalesce(lost, F.lit(False))}).where("_n > 0")
    merged = side.where("not _lost").select(
        *group, F.col("_n").alias("n"),
        *[F.least(f"is_{n}", f"in_{n}").alias(n) for n in lows],
        *[F.greatest(f"is_{n}", f"in_{n}").alias(n) for n in highs],
    )
    keyed = rows.withColumns({f"_g_{n}": c for n, c in group.items()})
    gone = side.where("_lost").select(*[F.col(n).alias(f"_lost_{n}") for n in group])
    hit = F.lit(True)
    for n in group:
        hit = hit & F.col(f"_g_{n}").eqNullSafe(F.col(f"_lost_{n}"))
    anew = _extremes(keyed.join(gone, hit, "left_semi"), {n: F.col(f"_g_{n}") for n in group}, lows, highs)
    return merged.unionByName(anew)


def _extremes(
    rows: DataFrame, group: Mapping[str, Column], lows: Mapping[str, Column], highs: Mapping[str, Column]
) -> DataFrame:
    return rows.groupBy(*[c.alias(n) for n, c in group.items()]).agg(
        F.count("*").alias("n"), *[F.min(c).alias(n) for n, c in lows.items()], *[F.max(c).alias(n) for n, c in highs.items()]
    )


def refresh_groups(
    view: DataFrame, changed: DataFrame, rows: DataFrame, group: Mapping[str, Column], values: Mapping[str, Column]
) -> DataFrame:
    """``view`` brought up to date for aggregates that cannot be corrected by a difference: groups that a change left or entered are computed anew from
    ``rows``, all others are kept."""
    names = [c.alias(n) for n, c in group.items()]
    left = changed.where(F.col("before").isNotNull()).select("before.*").select(*names)
    entered = changed.where(F.col("after").isNotNull()).select("after.*").select(*names)
    touched = left.unionByName(entered).distinct()

    def same(a: DataFrame) -> Column:
        out = F.lit(True)
        for n in group:
            out = out & a[n].eqNullSafe(touched[n])
        return out

    grouped = rows.withColumns({f"_g_{n}": c for n, c in group.items()})
    hit = F.lit(True)
    for n in group:
        hit = hit & F.col(f"_g_{n}").eqNullSafe(touched[n])
    anew = grouped.join(touched, hit, "left_semi").groupBy(*names).agg(
        *[c.alias(n) for n, c in values.items()]
    )
    return view.join(touched, same(view), "left_anti").unionByName(anew)


class MaintainedAggregate:
    """A stored aggregate of a versioned table, refreshed from the change rows.

    It holds ``n`` and ``sums`` per group, corrected by the difference each change makes, or
    ``n`` and the minima ``lows`` and maxima ``highs``, where only groups that lost an extreme
    are computed anew. With ``values``, which are any aggregates, or with both sums and extremes,
    every touched group is. Columns are named as in the table's current version.

    ``path`` holds one Parquet data set per refresh and a small ``versions`` data set that
    names the current one, written last.
    """

    def __init__(
        self, spark: SparkSession, base: str, path: str, group: Mapping[str, Column], sums: Mapping[str, Column] = {},
        values: Mapping[str, Column] = {}, lows: Mapping[str, Column] = {}, highs: Mapping[str, Column] = {},
        exact: str = EXACT,
    ) -> None:
        self.spark, self.base, self.path, self.group = spark, base, path, group
        self.sums, self.values, self.lows, self.highs, self.exact = sums, values, lows, highs, exact

    def _current(self) -> tuple[int, str] | None:
        try:
            rows = self.spark.read.schema("version long, data string").parquet(f"{self.path}/versions")
            newest = rows.orderBy(F.desc("version")).head(1)
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        return (newest[0].version, newest[0].data) if newest else None

    def refresh(self) -> DataFrame:
        """Bring the stored aggregate to the table's current version and return it."""
        chain = load(self.spark, self.base)
        head = resolve(chain)
        done = self._current()
        if done and done[0] == head.version:
            return self.read()
        alive = {c.version for c in live(chain)}
        if done and done[0] in alive:
            changed = changes(self.spark, self.base, done[0], head.version, as_newest=True)
            rows, extremes = state(self.spark, self.base, chain, head), self.lows or self.highs
            if self.values or extremes and self.sums:
                view = refresh_groups(self._stored(), changed, rows, self.group, self._all())
            elif extremes:
                view = refresh_extremes(self._stored(), changed, rows, self.group, self.lows, self.highs)
            else:
                view = refresh(self._stored(), changed, self.group, self.sums, self.exact)
        else:  # first build, or the version it stands at has been expired
            rows = state(self.spark, self.base, chain, head)
            view = rows.groupBy(*[c.alias(n) for n, c in self.group.items()]).agg(
                *[c.alias(n) for n, c in self._all().items()]
            )
        data = f"at-{head.version:08d}-{uuid.uuid4().hex[:12]}"
        view.write.parquet(f"{self.path}/{data}")
        self.spark.createDataFrame([(head.version, data)], "version long, data string").coalesce(1).write.mode(
            "append"
        ).parquet(f"{self.path}/versions")
        return self.read()

    def _all(self) -> dict[str, Column]:
        lows, highs = ({n: f(c) for n, c in m.items()} for f, m in ((F.min, self.lows), (F.max, self.highs)))
        return {"n": F.count("*"), **_sums(self.sums, self.exact), **lows, **highs, **self.values}

    def _stored(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{self._current()[1]}")

    def read(self) -> DataFrame:
        return self._stored().drop(*map(held, self.sums))
