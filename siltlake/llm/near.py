"""From banded signatures to verified links: shared by paragraph and document deduplication.

Members of a bucket are not paired with each other. Every bucket names a leader, the member that
meets most others in all its buckets, and only pairs of a member with a leader are verified.
Members take the label of the greatest leader they are linked to, and a bucket whose members all
have one label is finished; else its leader, whose pairs there are all tested, leaves it. In the
next round every member of a bucket of at most ``SLOTS`` leads; in a larger one the labels are
dealt to ``SLOTS`` slots, each with a leader of its own. What is left then is paired.

From the second round on, members of larger buckets are bounded before they are paired
(``reach``): two texts of different labels share no more than the shingles that each has in common
with any text of another label. Texts that cannot be alike to any other by that leave, and of the
others only pairs are made that their bounds allow; at last in the least of the buckets both are in. The bound is exact: a pair that shares
a bucket stays untested only if it is in one class or cannot be similar enough.
"""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltlake.llm.common import Saved
from siltlake.llm.text import counted, mix64, shingles_of, words_of

#: Leaders of a bucket in the second round.
SLOTS = 8
#: Against rounding, where whole counts are compared with a product.
SLACK = 1e-6
#: Rows of texts handed to Python at a time; pairs of long texts would fill its memory.
PAIR_BATCH = 500

Counts = tuple[np.ndarray, np.ndarray]


@contextmanager
def batches_of(spark: SparkSession, rows: int):
    """Arrow batches of at most ``rows`` rows for what runs inside."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def weighted_jaccard(a: Counts, b: Counts) -> float:
    """Sum of the lesser over sum of the greater counts; ascending distinct items."""
    _, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = float(np.minimum(a[1][ia], b[1][ib]).sum())
    total = float(a[1].sum() + b[1].sum()) - low
    return low / total if total else 0.0


def jaccard(a: Counts, b: Counts) -> float:
    """Shared over all distinct items."""
    both = len(np.intersect1d(a[0], b[0], assume_unique=True))
    total = len(a[0]) + len(b[0]) - both
    return both / total if total else 0.0


def shingle_counts(column: pa.Array, size: int = 5) -> list[Counts]:
    out = []
    for low, high, words in words_of(column):
        items, first = shingles_of(words, size)
        items, counts, first = counted(items, first)
        out += [(items[a:b], counts[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
    return out


def bands_of(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit bucket per band of ``rows`` coordinates; ``signature`` has a row per text."""
    n, k = signature.shape
    key = np.zeros((n, k // rows), np.uint64)
    for r in range(rows):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + signature[:, r::rows][:, :k // rows])
    return mix64(key + np.arange(k // rows, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)


def sketch_of(signature: np.ndarray) -> pa.Array:
    """A byte per coordinate, to tell unlike texts apart without reading them."""
    return pa.array([row.tobytes() for row in mix64(signature).astype(np.uint8)], pa.binary())


def sketch_rows(column: pa.Array) -> np.ndarray:
    """The sketches of an Arrow column, a row each; all are of one length."""
    column = column.cast(pa.large_binary())
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[at[0]:at[-1]].reshape(len(column), -1)


def enough(coordinates: int, least: float) -> int:
    """Coordinates that a pair of similarity ``least`` shares but for a chance of about 2e-5."""
    return int(coordinates * least - 4.2 * (coordinates * least * (1 - least)) ** 0.5)


def members(signed: DataFrame, name: str) -> Saved:
    """``(bucket, id, others)`` of the buckets with more than one id, from ``signed(id, keys, sketch)``, ids once.

    Intermediates are written where a join follows: Spark splits hot buckets of plain reads.
    """
    rows = signed.select(F.explode("keys").alias("bucket"), "id")
    shared = Saved(rows.groupBy("bucket").agg((F.count("*") - 1).alias("others")).where("others > 0"), name)
    out = Saved(rows.join(shared.df, "bucket"), name)
    shared.drop()
    return out


def labelled(found: DataFrame, name: str) -> Saved:
    """``(node, label)``: of each linked node the greatest leader it was verified with, then that
    leader's own. Nodes of one label are in one class; a class may still have several labels."""
    tops = found.select(F.col("a").alias("node"), "head").union(found.select(F.col("b").alias("node"), "head"))
    one = Saved(tops.groupBy("node").agg(F.max("head").alias("head")).select("node", F.col("head.id").alias("label")), name)
    two = Saved(one.df.join(one.df.select(F.col("node").alias("label"), F.col("label").alias("next")), "label").select(
        "node", F.col("next").alias("label")), name)
    one.drop()
    return two


def reach(rows: DataFrame, texts: DataFrame, weighted: bool, least: float, size: int, name: str) -> Saved:
    """``(id, weight, common)`` of those of ``rows(id, class)``, ids once, that may be alike to one of another class.

    ``weight`` counts the shingles of a text and ``common`` those of them that a text of another
    class has as well, which is the most that two texts of different classes can share.
    """
    spark = texts.sparkSession

    def split(batches):
        for batch in batches:
            counts = shingle_counts(batch.column(2), size)
            if counts:
                each = pa.array(np.repeat(np.arange(len(counts)), [len(items) for items, _ in counts]))
                n = np.concatenate([times if weighted else np.ones_like(times) for _, times in counts])
                items = np.concatenate([items for items, _ in counts])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(each), batch.column(1).take(each), pa.array(items.view(np.int64)), pa.array(n.astype(np.int64))],
                    names=["id", "class", "shingle", "n"])

    with batches_of(spark, PAIR_BATCH):
        pieces = Saved(rows.join(texts, "id").select("id", "class", "text").mapInArrow(split, "id long, class long, shingle long, n long"), name)
    # Written before it is joined: Spark can then split a shingle that many texts have.
    shared = Saved(pieces.df.groupBy("shingle").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo < hi").select(
        "shingle", F.lit(True).alias("met")), name)
    out = Saved(
        pieces.df.join(shared.df, "shingle", "left").groupBy("id")
        .agg(F.sum("n").alias("weight"), F.sum(F.when(F.col("met"), F.col("n")).otherwise(0)).alias("common"))
        .where(F.col("common") >= least * F.col("weight") - SLACK), name)
    shared.drop()
    pieces.drop()
    return out


def links(
    buckets: Saved, sketches: DataFrame, texts: DataFrame, weighted: bool = False, least: float = 0.8, size: int = 5, name: str = "near",
) -> DataFrame:
    """``(a, b)`` verified links whose components are those of all pairs that share a bucket and are
    at least ``least`` alike. ``sketches(id, sketch)`` and ``texts(id, text)`` hold every id of
    ``buckets`` once. Shingles count as often as they occur if ``weighted``, else once. Pairs whose
    sketches share too few coordinates are not read any further."""
    spark = texts.sparkSession
    similarity = weighted_jaccard if weighted else jaccard

    def each_once(ids: pa.Array, column: pa.Array) -> list[Counts]:
        _, first, back = np.unique(ids.to_numpy(), return_index=True, return_inverse=True)
        counts = shingle_counts(column.take(pa.array(first)), size)
        return [counts[i] for i in back]

    def close(batches):
        for batch in batches:
            if batch.num_rows:
                one, two = (sketch_rows(batch.column(i)) for i in (3, 4))
                yield batch.select([0, 1, 2]).filter(pa.array((one == two).sum(axis=1) >= enough(one.shape[1], least)))

    def alike(batches):
        for batch in batches:
            own, other = (each_once(batch.column(i), batch.column(i + 3)) for i in (0, 1))
            yield batch.select([0, 1, 2]).filter(pa.array(
                [similarity(x, y) >= least - 1e-12 for x, y in zip(own, other, strict=True)], pa.bool_()))

    kind = "a long, b long, head struct<degree: long, id: long>"

    def verified(pairs: DataFrame) -> DataFrame:
        """Links of ``pairs(a, b, head, sa, sb)``, each with its greatest ``head``."""
        likely = Saved(pairs.mapInArrow(close, kind).groupBy("a", "b").agg(F.max("head").alias("head")), name)
        left = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
        right = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
        with batches_of(spark, PAIR_BATCH):
            out = Saved(likely.df.join(left, "a").join(right, "b").select("a", "b", "head", "ta", "tb").mapInArrow(alike, kind), name).df
        likely.drop()
        return out

    degree = Saved(buckets.df.groupBy("id").agg(F.sum("others").alias("degree")).join(sketches.select("id", "sketch"), "id"), name)
    rows = Saved(buckets.df.select("bucket", "id").join(degree.df, "id"), name)
    degree.drop()
    # First round: one leader per bucket.
    first = F.max(F.struct("degree", "id")).alias("head")
    led = Saved(rows.df.groupBy("bucket").agg(first, F.max_by("sketch", F.struct("degree", "id")).alias("head_sketch")), name)
    found = verified(rows.df.join(led.df, "bucket").where("id != head.id").select(
        F.least("id", "head.id").alias("a"), F.greatest("id", "head.id").alias("b"), "head", "sketch", "head_sketch"))
    rest = Saved(rows.df.join(led.df.select("bucket", F.col("head.id").alias("id")), ["bucket", "id"], "left_anti"), name)
    rows.drop()
    led.drop()
    labels = labelled(found, name)

    def still_open(rows: Saved, labels: Saved) -> Saved:
        """Rows of buckets that hold several classes, with ``class`` and the bucket's size ``n``."""
        at = rows.df.join(labels.df.select(F.col("node").alias("id"), "label"), "id", "left").select(
            "bucket", "id", "degree", "sketch", F.coalesce("label", "id").alias("class"))
        several = at.groupBy("bucket").agg(F.min("class").alias("lo"), F.max("class").alias("hi"), F.count("*").alias("n")).where("lo < hi").select("bucket", "n")
        out = Saved(at.join(several, "bucket"), name)
        rows.drop()
        labels.drop()
        return out

    def may(one: str, other: str) -> Column:
        """Whether the bounds of two texts allow them to be alike."""
        return (1 + least) * F.least(one.format("common"), other.format("common")) >= least * (
            F.col(one.format("weight")) + F.col(other.format("weight"))) - SLACK

    # Second round: all members of small buckets lead, in large ones one per slot.
    rows = still_open(rest, labels)
    large = rows.df.where(F.col("n") > SLOTS)
    bounds = reach(large.groupBy("id").agg(F.first("class").alias("class")), texts, weighted, least, size, name)
    large = Saved(large.join(bounds.df, "id"), name)
    bounds.drop()
    slot = F.pmod(F.xxhash64("class"), F.lit(SLOTS)).alias("slot")
    led = Saved(large.df.groupBy("bucket", slot).agg(
        first, *[F.max_by(c, F.struct("degree", "id")).alias(f"head_{c}") for c in ("class", "sketch", "weight", "common")]).drop("slot"), name)
    small = rows.df.where(F.col("n") <= SLOTS)
    heads = small.select(
        "bucket", F.struct("degree", "id").alias("head"), F.col("class").alias("head_class"), F.col("sketch").alias("head_sketch"))
    met = large.df.join(led.df, "bucket").where("class != head_class").where(may("{}", "head_{}"))
    met = met.select("id", "head", "sketch", "head_sketch").union(
        small.join(heads, "bucket").where("class != head_class and id < head.id").select("id", "head", "sketch", "head_sketch"))
    found = found.union(verified(met.select(
        F.least("id", "head.id").alias("a"), F.greatest("id", "head.id").alias("b"), "head", "sketch", "head_sketch")))
    rest = Saved(large.df.select("bucket", "id", "degree", "sketch").join(
        led.df.select("bucket", F.col("head.id").alias("id")), ["bucket", "id"], "left_anti"), name)
    for done in (rows, large, led):
        done.drop()
    # What is left: pairs of different classes that may share enough, each in one bucket.
    rows = still_open(rest, labelled(found, name))
    bounds = reach(rows.df.groupBy("id").agg(F.first("class").alias("class")), texts, weighted, least, size, name)
    own = Saved(
        rows.df.join(bounds.df, "id").groupBy("id").agg(
            F.collect_set("bucket").alias("buckets"), *[F.first(c).alias(c) for c in ("degree", "sketch", "class", "weight", "common")]), name)
    bounds.drop()
    rows.drop()
    at = Saved(own.df.select(F.explode("buckets").alias("bucket"), "*"), name)
    own.drop()
    x = at.df.select("bucket", *[F.col(c).alias(f"{c}_a") for c in ("id", "class", "sketch", "weight", "common", "buckets")])
    y = at.df.select("bucket", "degree", *[F.col(c).alias(f"{c}_b") for c in ("id", "class", "sketch", "weight", "common", "buckets")])
    pairs = x.join(y, (x["bucket"] == y["bucket"]) & (F.col("id_a") < F.col("id_b")) & (F.col("class_a") != F.col("class_b")) & may("{}_a", "{}_b") & (
        F.array_min(F.array_intersect("buckets_a", "buckets_b")) == x["bucket"]))
    found = found.union(verified(pairs.select(
        F.col("id_a").alias("a"), F.col("id_b").alias("b"), F.struct("degree", F.col("id_b").alias("id")).alias("head"),
        F.col("sketch_a").alias("sa"), F.col("sketch_b").alias("sb"))))
    at.drop()
    return found.select("a", "b")
