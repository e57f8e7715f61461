"""Merkle manifest of a data set: leaves, a tree per group, a tree over the groups, proofs.

A leaf is the checksum of a row's fields. The leaves of a group are numbered in their order by a
range sort, counts per task and running sums of these, never by one task. Then level by level

* every node is joined with its siblings, whose indices are computed from its own: index XOR 1
  in a binary tree, else the other slots of its run by their offsets;
* the nodes in slot zero, which now hold their whole run, emit the parents.

A level is written before the next one starts, so a lost executor costs one level, and each has
a fraction of the nodes of the one before. Proofs run the other way: a node's path is its own
siblings and the path of its parent. Levels are taken in segments, so that the long upper paths are
joined once per segment and not once per level. A join key names one node, so no key is hot.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from siltlake.llm.common import saved

#: The fields of a document's leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels whose siblings are gathered before a path is joined to the levels above.
SEGMENT = 8

_STEP = "struct<slot:bigint,others:array<struct<slot:bigint,hash:binary>>>"


def field_text(value: Column) -> Column:
    """``-`` for null, else byte count, colon and value, so that no two rows share a text."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(fields: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field_text, fields)), 256))


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _join(hashes: Column) -> Column:
    """The checksum of digests in a row, as hex text."""
    return F.unhex(F.sha2(F.array_join(F.transform(hashes, _hex), ""), 256))


def _run(slot: Column, own: Column, others: Column) -> Column:
    """The digests of a run from left to right: a node's own among its siblings."""
    left = F.filter(others, lambda o: o["slot"] < slot)
    right = F.filter(others, lambda o: o["slot"] > slot)
    hashes = lambda run: F.transform(run, lambda o: o["hash"])
    return F.concat(hashes(left), F.array(own), hashes(right))


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``idx``, the place in the group from 0, and ``n``, the group's size.

    Nulls come first. Rows must have a column ``row`` that differs in all of them: it goes last in
    the order, and spreads rows that agree in everything else over tasks.
    """
    keys = [F.col(f"`{c}`").asc_nulls_first() for c in (group, *order, "row")]
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    placed = saved(
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumns({"part": F.spark_partition_id(), "place": place}), "merkle-sorted")
    parts = placed.groupBy(group, "part").agg(F.min("place").alias("first"), F.count("*").alias("held"))
    # A row per group and task that holds some of it; a group's rows here are no more than the tasks.
    whole = Window.partitionBy(group)
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        F.col(group).alias("g"), F.col("part").alias("p"), F.col("first"), F.sum("held").over(whole).alias("n"),
        F.coalesce(F.sum("held").over(before), F.lit(0)).alias("offset"))
    return placed.join(parts, placed[group].eqNullSafe(parts["g"]) & (placed["part"] == parts["p"])).select(
        *rows.columns, (F.col("place") - F.col("first") + F.col("offset")).alias("idx"), "n")


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """``nodes(tree, idx, n, hash, ...)`` with ``slot`` and ``others``, the rest of each node's run by slot."""
    known = nodes.where("n > 1").select(
        F.col("tree").alias("t"), F.col("idx").alias("i"), F.col("hash").alias("h"))
    out = nodes.withColumn("slot", F.col("idx") % arity)
    for offset in range(1, arity):
        if arity == 2:
            sibling = F.col("idx").bitwiseXOR(F.lit(1))
        else:
            sibling = F.col("idx") - F.col("slot") + (F.col("slot") + offset) % arity
        other = known.select(*[F.col(c).alias(f"{c}{offset}") for c in known.columns])
        out = out.withColumn("at", F.when(F.col("n") > 1, sibling)).join(
            other, F.col("tree").eqNullSafe(F.col(f"t{offset}")) & (F.col("at") == F.col(f"i{offset}")), "left")
    found = F.array(*[
        F.when(F.col(f"h{k}").isNotNull(), F.struct((F.col(f"i{k}") % arity).alias("slot"), F.col(f"h{k}").alias("hash")))
        for k in range(1, arity)])
    return out.select(*nodes.columns, "slot", F.array_sort(F.array_compact(found)).alias("others"))


@dataclass
class Tree:
    """Written levels from the leaves up, and the root of each tree with the level it stands on."""

    levels: list[DataFrame]
    roots: DataFrame  # tree, hash, height
    arity: int


def build(leaves: DataFrame, arity: int = 2) -> Tree:
    """All levels over ``leaves(tree, idx, n, hash, ...)``; a tree ends where one node is left."""
    if arity < 2:
        raise ValueError("a run has two nodes at least")
    most = leaves.agg(F.max("n")).first()[0] or 0
    levels, nodes = [], leaves
    while True:
        level = saved(with_siblings(nodes, arity), f"merkle-level{len(levels)}")
        levels.append(level)
        if most <= 1:
            break
        most = -(-most // arity)
        nodes = level.where("n > 1 and slot = 0").select(
            "tree", F.expr(f"idx div {arity}").alias("idx"), F.expr(f"(n + {arity - 1}) div {arity}").alias("n"),
            _join(_run(F.col("slot"), F.col("hash"), F.col("others"))).alias("hash"))
    tops = [
        level.where("n = 1").select("tree", "hash", F.lit(height).cast("long").alias("height"))
        for height, level in enumerate(levels)]
    return Tree(levels, reduce(DataFrame.unionByName, tops), arity)


def paths(tree: Tree, heads: DataFrame) -> DataFrame:
    """Every leaf with the steps to its root, continued by those of ``heads(tree, path, ...)``.

    ``heads`` has a row per tree; its other columns go to every leaf of the tree.
    """
    carried = [c for c in heads.columns if c not in ("tree", "path")]
    heads = heads.join(tree.roots.select(F.col("tree").alias("t"), "height"), F.col("tree").eqNullSafe(F.col("t"))).drop("t")
    heads = saved(heads, "merkle-heads")
    above = None
    for bottom in reversed(range(0, len(tree.levels), SEGMENT)):
        levels = tree.levels[bottom:bottom + SEGMENT]
        chain = None
        for level in reversed(levels):
            step = F.when(F.col("n") > 1, F.array(F.struct("slot", "others"))).otherwise(F.array().cast(f"array<{_STEP}>"))
            rows = level.withColumn("path", step).drop("slot", "others")
            if chain is not None:
                up = chain.select(F.col("tree").alias("t"), F.col("idx").alias("i"), F.col("path").alias("rest"))
                rows = rows.join(up, F.col("tree").eqNullSafe(F.col("t")) & (F.expr(f"idx div {tree.arity}") == F.col("i")), "left")
                rows = rows.withColumn("path", F.when(F.col("rest").isNull(), F.col("path")).otherwise(F.concat("path", "rest"))).drop("t", "i", "rest")
            chain = rows
        # Roots inside this segment go on with their head; all other nodes with the segment above.
        ends = heads.where(f"height >= {bottom} and height < {bottom + SEGMENT}").select(
            F.col("tree").alias("t"), F.lit(0).cast("long").alias("i"), F.col("path").alias("rest"), *carried)
        if above is not None:
            ends = ends.unionByName(above.select(F.col("tree").alias("t"), F.col("idx").alias("i"), F.col("path").alias("rest"), *carried))
        run = tree.arity ** SEGMENT
        above = chain.join(ends, F.col("tree").eqNullSafe(F.col("t")) & (F.expr(f"idx div {run}") == F.col("i")))
        above = above.withColumn("path", F.concat("path", "rest")).drop("t", "i", "rest")
        if bottom:
            above = saved(above, "merkle-paths")
    return above


def folded(start: Column, path: Column) -> Column:
    """The root that ``start`` leads to along a path of siblings."""
    return F.aggregate(path, start, lambda own, step: _join(_run(step["slot"], own, step["others"])))


def manifest(
    docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "lang", order: Sequence[str] = ("doc_id",), arity: int = 2,
    changed: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, leaf, subroot, root, proof, folded_root, verified``.

    Leaves of a group are ordered by ``order``, null first, and where these agree by their digest;
    groups by name, null first, bytewise. Every run of ``arity`` nodes (the last may be shorter)
    becomes one until one is left, first in each group, then over the groups. ``proof`` are the
    digests of a leaf's siblings up to the root. ``changed`` names fields whose value is another
    one when the proof is checked: ``folded_root`` is computed from these and the original proof, and
    ``verified`` tells whether it is the root.

    Nulls in any field are ``-``, which no value is. Empty and long texts are values like others.
    Rows repeated in full are leaves of their own; an empty table gives an empty result, and
    columns that are no field are ignored. ``doc_id`` is the first of ``order``.
    """
    claimed = {**{f: F.col(f"`{f}`") for f in fields}, **(changed or {})}
    leaves = docs.select(
        F.col(f"`{group}`").cast("string").alias("tree"), *[F.col(f"`{o}`").alias(f"o{i}") for i, o in enumerate(order)],
        F.col(f"`{order[0]}`").alias("doc_id"), leaf([F.col(f"`{f}`") for f in fields]).alias("hash"),
        leaf([claimed[f] for f in fields]).alias("claimed"), F.monotonically_increasing_id().alias("row"))
    leaves = saved(leaves.withColumn("claimed", F.when(F.col("claimed") != F.col("hash"), F.col("claimed"))), "merkle-leaves")
    ranks = [f"o{i}" for i in range(len(order))]
    groups = build(numbered(leaves, "tree", [*ranks, "hash"]).drop("row", *ranks), arity)
    subroots = groups.roots.select(
        F.lit(0).alias("all"), F.col("tree").alias("name"), "hash", F.xxhash64("tree").alias("row"))
    over = build(numbered(subroots, "all", ["name"]).drop("row").withColumnRenamed("all", "tree"), arity)
    root = over.roots.select(
        "tree", F.array().cast(f"array<{_STEP}>").alias("path"), F.col("hash").alias("root"))
    heads = paths(over, root).select(
        F.col("name").alias("tree"), "path", F.col("hash").alias("subroot"), "root")
    found = paths(groups, heads).withColumn("folded", folded(F.coalesce("claimed", "hash"), F.col("path")))
    proof = F.flatten(F.transform("path", lambda s: F.transform(s["others"], lambda o: _hex(o["hash"]))))
    return found.select(
        "doc_id", *[_hex(F.col(c)).alias(name) for c, name in (("hash", "leaf"), ("subroot", "subroot"), ("root", "root"))],
        proof.alias("proof"), _hex(F.col("folded")).alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


def digest(rows: DataFrame) -> DataFrame:
    """The manifest with a checksum in place of each proof."""
    return rows.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("proof", ""), 256).alias("proof_sha256"), "folded_root", "verified")
