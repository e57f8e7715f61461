"""A stored aggregate over the join of two versioned tables, refreshed from the changes of both.

What a join gains and loses between two states of its sides L and R is

    (change of L) JOIN (new R)   UNION ALL   (old L) JOIN (change of R)

with a sign on every row, so a refresh joins only changed rows. They are added up per group and
distinct values at once, and stored: counts and exact sums are the sums of these cells. Distinct
values cannot be counted that way: for each, a versioned table holds how many rows of the join carry
a value in a group. Cells are merged into it, a value whose last row is gone leaves it, and the keys
that came and went in that table are the changes of the count.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltlake.functions.sizing import settled
from siltlake.operators import dml
from siltlake.operators.cdc import EXACT, SIGN, changes, fitting, held, logged_between, signed_changes
from siltlake.operators.changelog import OP, UPSERT, live, load, members, read_version, resolve, scan, state_rows

KEY, VALUE, REFS, WAS = "_key", "_value", "_refs", "_was"

#: Changes of at most this many log rows are written first, broadcast, and looked up before the other side is joined.
FEW = 1_000_000

_POINTER = "seq long, left long, right long, refs map<string,long>, data string"

Versions = tuple[int, int]


@dataclass(frozen=True)
class _At:
    """What the stored rows stand for: versions of both sides and of the value counts."""

    versions: Versions
    refs: Mapping[str, int]
    data: str
    seq: int


class MaintainedJoin:
    """``n``, ``sums`` and numbers of ``distinct`` values per group of ``left JOIN right``.

    Expressions name the sides ``l`` and ``r`` and their columns as in the current versions; ``on``
    maps columns of the left to those of the right. NULL keys join nothing, NULL values are not
    counted, and NULL is a group like any other. Amounts add up in the decimal type ``exact``.

    ``path`` holds one Parquet data set per refresh, a versioned table of value counts per
    distinct column, and a small ``versions`` data set that names what is current, written last. Each
    table of counts names in its commits the versions it stands at, so a refresh that was lost on
    the way is taken up where it was: nothing is added twice. A side whose old version has expired
    is read anew.
    """

    def __init__(
        self, spark: SparkSession, left: str, right: str, path: str, on: Mapping[str, str], group: Mapping[str, Column],
        sums: Mapping[str, Column] = {}, distinct: Mapping[str, Column] = {}, exact: str = EXACT,
    ) -> None:
        self.spark, self.left, self.right, self.path, self.on = spark, left, right, path, on
        self.group, self.sums, self.distinct, self.exact = group, sums, distinct, exact

    # --- rows of the join --------------------------------------------------------------

    def _join(self, left: DataFrame, right: DataFrame, sign: Column) -> DataFrame:
        same = reduce(lambda a, b: a & b, [F.col(f"l.`{a}`") == F.col(f"r.`{b}`") for a, b in self.on.items()])
        cells = {**self.group, **self.sums, **{f"_d_{n}": c for n, c in self.distinct.items()}, SIGN: sign}
        return left.alias("l").join(right.alias("r"), same).select(*[c.alias(n) for n, c in cells.items()])

    def _side(self, base: str, version: int, wanted: DataFrame | None = None, on: Mapping[str, str] = {}) -> DataFrame:
        """A side at a version, under the names of its newest one.

        Of rows that join nothing ``wanted``, whose columns ``on`` names by those of this side, some may
        be left out: where later commits hide older rows, the latter are looked up in it first.
        """
        chain = load(self.spark, base)
        head, newest, near = resolve(chain, version=version), resolve(chain), None
        have = {p for _, p, _ in head.columns}
        places = {newest.physical(n): theirs for n, theirs in on.items()}
        if wanted is not None and have.issuperset(places) and members(chain, head)[1]:
            keys = wanted.select(*[F.col(f"`{n}`").alias(f"_w{i}") for i, n in enumerate(places.values())])
            same = reduce(lambda a, b: a & b, [F.col(f"`{p}`") == F.col(f"_w{i}") for i, p in enumerate(places)])
            near = lambda rows: rows.join(F.broadcast(keys), same, "left_semi")
        return state_rows(self.spark, base, chain, head, near=near).select(
            *[(F.col(f"`{p}`") if p in have else F.lit(None)).cast(t).alias(n) for n, p, t in newest.columns])

    def _signed(self, base: str, v1: int, v2: int) -> tuple[DataFrame, DataFrame | None]:
        """What a side has lost and gained, under its newest names, and once more to look rows up in if that is little."""
        chain = load(self.spark, base)
        head, newest = resolve(chain, version=v2), resolve(chain)
        have = {p: n for n, p, _ in head.columns}
        rows = signed_changes(self.spark, base, v1, v2).select(
            *[(F.col(f"`{have[p]}`") if p in have else F.lit(None)).cast(t).alias(n) for n, p, t in newest.columns], SIGN)
        between, drops = logged_between(chain, v1, v2)
        if drops or any(c.kind == "base" for c in between) or sum(c.upserts + c.deletes for c in between) > FEW:
            return rows, None
        few = settled(rows)
        return F.broadcast(few), few

    def _delta(self, old: Versions, new: Versions) -> DataFrame:
        """Signed rows of the join between two pairs of versions."""
        if (old, new) not in self._deltas:
            parts = []
            if old[0] != new[0]:
                rows, few = self._signed(self.left, old[0], new[0])
                other = self._side(self.right, new[1], few, {r: l for l, r in self.on.items()})
                parts.append(self._join(rows, other, F.col(f"l.{SIGN}")))
            if old[1] != new[1]:
                rows, few = self._signed(self.right, old[1], new[1])
                parts.append(self._join(self._side(self.left, old[0], few, self.on), rows, F.col(f"r.{SIGN}")))
            self._deltas[old, new] = reduce(DataFrame.unionByName, parts)
        return self._deltas[old, new]

    def _whole(self, at: Versions) -> DataFrame:
        return self._join(self._side(self.left, at[0]), self._side(self.right, at[1]), F.lit(1))

    def _cells(self, old: Versions | None, new: Versions) -> DataFrame:
        """Net counts, sums and numbers of amounts per group and distinct values of the rows that a state, or all
        since an older one, adds to the join; computed once."""
        if (old, new) not in self._added_up:
            rows = self._whole(new) if old is None else self._delta(old, new)
            sign, numbers = F.col(SIGN), {"n": F.sum(SIGN)}
            # Casts in a column of their own, where a row is cast once.
            rows = rows.withColumns({f"_x_{s}": F.col(f"`{s}`").try_cast(self.exact) for s in self.sums})
            rows = rows.withColumns({
                f"_x_{s}": fitting(s, F.col(f"`{s}`"), F.col(f"`_x_{s}`"), self.exact) for s in self.sums})
            for s in self.sums:
                value = F.col(f"`_x_{s}`")
                numbers[s] = F.sum(F.when(sign < 0, -value).otherwise(value))
                numbers[held(s)] = F.coalesce(F.sum(F.when(F.col(f"`{s}`").isNotNull(), sign)), F.lit(0))
            per = [*self.group, *[f"_d_{n}" for n in self.distinct]]
            self._added_up[old, new] = settled(
                rows.groupBy(*[f"`{p}`" for p in per]).agg(*[c.alias(n) for n, c in numbers.items()]))
        return self._added_up[old, new]

    def _per_group(self, cells: DataFrame) -> DataFrame:
        names = ["n", *self.sums, *map(held, self.sums)]
        return cells.groupBy(*[f"`{g}`" for g in self.group]).agg(
            *[F.sum(f"`{n}`").cast(cells.schema[n].dataType).alias(n) for n in names])

    def _alive(self, at: Versions) -> bool:
        return all(
            v in {c.version for c in live(load(self.spark, base))} for base, v in zip((self.left, self.right), at))

    # --- values per group ----------------------------------------------------------------

    def _refs(self, name: str) -> str:
        return f"{self.path}/values-{name}"

    def _counted(self, name: str, cells: DataFrame) -> DataFrame:
        """Rows of the join per group and value, under a key that tells them apart with NULL groups too."""
        value, groups = F.col(f"`_d_{name}`"), [F.col(f"`{g}`") for g in self.group]
        key = F.to_json(F.struct(*groups, F.col(VALUE)), {"ignoreNullFields": "false"})
        rows = cells.where(value.isNotNull()).select(*groups, value.alias(VALUE), F.col("n").alias(REFS))
        if len(self.distinct) > 1:  # cells of one distinct column are one per group and value
            rows = rows.groupBy(*groups, VALUE).agg(F.sum(REFS).alias(REFS))
        return rows.where(F.col(REFS) != 0).select(key.alias(KEY), *groups, VALUE, REFS, F.lit(0).cast("long").alias(WAS))

    def _advance(self, name: str, to: Versions) -> int:
        """Bring the value counts of a distinct column to a pair of versions; returns theirs."""
        base = self._refs(name)
        chain = load(self.spark, base)
        stands = next((c.writer for c in reversed(chain) if c.writer), None)
        at = tuple(map(int, stands.split(":"))) if stands else None
        writer = f"{to[0]}:{to[1]}"
        if at == to:
            return chain[-1].version
        if at is None or not self._alive(at):
            return dml.create_or_replace(self._counted(name, self._cells(None, to)), base, [KEY], writer=writer).version
        total = F.col(f"t.{REFS}") + F.col(f"s.{REFS}")
        cells = {c: F.col(f"s.`{c}`") for c in (*self.group, VALUE, REFS, WAS)}
        return dml.merge(
            self.spark, base, self._counted(name, self._cells(at, to)), [KEY],
            matched_update={REFS: total, WAS: F.col(f"t.{REFS}")}, matched_delete=total <= 0, insert=cells, writer=writer,
        ).version

    def _values_moved(self, name: str, v1: int, v2: int) -> DataFrame:
        """How many values each group has gained, less those it has lost.

        One merge tells by itself: the rows it wrote hold what a value counted before, and which are gone.
        """
        base = self._refs(name)
        chain = load(self.spark, base)
        between, head = logged_between(chain, v1, v2)[0], resolve(chain, version=v2)
        if [c.operation for c in between] == ["merge"] and WAS in head.schema.names:
            new = (F.col(OP) == UPSERT) & (F.col(WAS) == 0)
            moved = scan(self.spark, base, between, head.physical_schema).where(new | (F.col(OP) != UPSERT)).select(
                *[F.col(f"`{g}`") for g in self.group], F.when(new, 1).otherwise(-1).alias(SIGN))
        else:
            found = changes(self.spark, base, v1, v2)
            moved = found.where("change <> 'update'").select(
                *[F.coalesce(F.col(f"after.`{g}`"), F.col(f"before.`{g}`")).alias(g) for g in self.group],
                F.when(F.col("change") == "insert", 1).otherwise(-1).alias(SIGN))
        return moved.groupBy(*[f"`{g}`" for g in self.group]).agg(F.sum(SIGN).alias(name))

    # --- the stored rows -----------------------------------------------------------------

    def _at(self) -> _At | None:
        try:
            newest = self.spark.read.schema(_POINTER).parquet(f"{self.path}/versions").orderBy(F.desc("seq")).first()
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        return newest and _At((newest.left, newest.right), newest.refs, newest.data, newest.seq)

    def refresh(self) -> DataFrame:
        """Bring the stored rows to the current versions of both sides and return them."""
        self._deltas: dict[tuple[Versions, Versions], DataFrame] = {}
        self._added_up: dict[tuple[Versions | None, Versions], DataFrame] = {}
        to = tuple(resolve(load(self.spark, base)).version for base in (self.left, self.right))
        at = self._at()
        if at and at.versions == to:
            return self.read()
        refs = {name: self._advance(name, to) for name in self.distinct}
        known = at and all(
            v in {c.version for c in live(load(self.spark, self._refs(name)))} for name, v in at.refs.items())
        if known and self._alive(at.versions):
            parts = [
                self._stored(at), self._per_group(self._cells(at.versions, to)),
                *[self._values_moved(n, at.refs[n], v) for n, v in refs.items() if v != at.refs[n]]]
        else:
            parts = [self._per_group(self._cells(None, to)), *[
                read_version(self.spark, self._refs(n), version=v).groupBy(*self.group).agg(F.count("*").alias(n))
                for n, v in refs.items()]]
        data = f"at-{to[0]:08d}-{to[1]:08d}-{uuid.uuid4().hex[:12]}"
        self._added(parts).write.parquet(f"{self.path}/{data}")
        pointer = [(at.seq + 1 if at else 1, *to, refs, data)]
        self.spark.createDataFrame(pointer, _POINTER).coalesce(1).write.mode("append").parquet(f"{self.path}/versions")
        return self.read()

    def _added(self, parts: list[DataFrame]) -> DataFrame:
        """All parts added up per group; a group without rows is gone, a sum without amounts NULL."""
        every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        numbers = ["n", *map(held, self.sums), *self.distinct]
        added = every.groupBy(*self.group).agg(
            *[F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n) for n in numbers if n in every.columns],
            *[F.sum(n).cast(parts[0].schema[n].dataType).alias(n) for n in self.sums])
        missing = {n: F.lit(0).cast("long") for n in self.distinct if n not in every.columns}
        return added.withColumns(missing).where("n > 0").select(
            *self.group, "n", *[F.when(F.col(held(s)) > 0, F.col(s)).alias(s) for s in self.sums], *map(held, self.sums), *self.distinct)

    def _stored(self, at: _At) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{at.data}")

    def read(self) -> DataFrame:
        return self._stored(self._at()).drop(*map(held, self.sums))
