"""Mixing sources to target weights by Poisson replication, with DataFrame functions only.

Each document is repeated n times, n drawn from a Poisson distribution whose mean is the
repetition rate of its source: target weight x corpus size / size of the source. The draw
inverts the distribution at a uniform number hashed from seed and document key, so it depends
on nothing but the document: no order, no partitioning, no retry changes it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from siltlake.llm.common import unused, without

#: Means above this are drawn as a sum of independent pieces, as exp(-mean) would vanish.
PIECE = 32.0
#: Beyond this many events a piece of mean 32 has less than 2**-60 of its mass.
EVENTS = 128


def _uniform(*parts: Column) -> Column:
    digits = F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(2**52))


def _order(*parts: Column) -> Column:
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("long")


def rates(docs: DataFrame, weights: Mapping[str, float], by: str = "source", text: str = "text", scale: float = 1.0) -> DataFrame:
    """``(group, size, rate)`` per named source, and one row with a null group for all others.

    At most ``len(weights) + 1`` rows, whatever the corpus holds.
    """
    if any(w < 0 for w in weights.values()) or sum(weights.values()) > 1 + 1e-9:
        raise ValueError("weights must not be negative nor exceed 1 together")
    group = F.when(F.col(by).isin(list(weights)), F.col(by)) if weights else F.lit(None).cast("string")
    rest = max(0.0, 1.0 - sum(weights.values()))
    target = F.coalesce(*[F.when(F.col("group") == k, F.lit(float(v))) for k, v in weights.items()], F.lit(rest))
    whole = W.partitionBy()
    return (
        docs.select(group.alias("group"), F.length(text).cast("long").alias("n"))
        .groupBy("group").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("size"))
        .withColumn("weight", target)
        .withColumn("weight", F.col("weight") / F.sum("weight").over(whole))
        .withColumn("rate", F.coalesce(F.when(
            F.col("size") > 0, F.col("weight") * F.sum("size").over(whole) / F.col("size") * F.lit(float(scale))), F.lit(1.0)))
        .select("group", "size", "rate")
    )


def _cdf(mean: Column) -> Column:
    """P(n <= k) for k = 0, 1, ...; the draw is the number of entries not above the uniform."""
    first = F.exp(-mean)
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(EVENTS)),
        F.struct(first.alias("p"), F.array(first).alias("c")),
        lambda s, k: F.struct(
            (s["p"] * mean / k).alias("p"),
            F.concat(s["c"], F.array(F.element_at(s["c"], -1) + s["p"] * mean / k)).alias("c")),
        lambda s: s["c"],
    )


def replicate(
    docs: DataFrame, weights: Mapping[str, float], by: str = "source", key: str = "doc_id", text: str = "text",
    scale: float = 1.0, seed: int = 0,
) -> DataFrame:
    """``docs`` repeated so that sources have their target shares of the characters, shuffled.

    ``weights`` names some sources' shares; all other sources, and rows without one, keep their
    proportions within what is left. The expected size is ``scale`` times the present one.
    Adds ``copy`` (from 1) and ``mix_order``, a hash of document and copy that deals rows over
    the partitions and orders them there: a global shuffle without a sampling pass.

    Defined results: weights of sources that are absent go to the present ones in proportion;
    a group whose texts are all null or empty keeps its rows at rate 1; rows with a null key
    share one draw, as do rows that repeat a key; an empty table gives an empty one; input
    columns called ``copy`` or ``mix_order`` are replaced. A hot source needs no care: sizes
    are summed before the shuffle and rates come as at most ``len(weights) + 1`` broadcast rows.
    """
    docs = without(docs, ("copy", "mix_order"))
    group, n, mean, pieces, cdf = (unused(docs, c) for c in ("_group", "_n", "_mean", "_pieces", "_cdf"))
    named = F.when(F.col(by).isin(list(weights)), F.col(by)) if weights else F.lit(None).cast("string")
    rate = F.col("rate")
    split = F.greatest(F.lit(1.0), F.ceil(rate / PIECE).cast("double"))
    table = rates(docs, weights, by, text, scale).select(
        F.col("group").alias(group), split.cast("int").alias(pieces), _cdf(rate / split).alias(cdf))
    source = docs.withColumn(mean, named)
    id_text = F.coalesce(F.col(key).cast("string"), F.lit("null"))

    def drawn(j: Column) -> Column:
        u = _uniform(F.lit(str(seed)), id_text, j.cast("string"))
        return F.size(F.filter(F.col(cdf), lambda c: c <= u))

    count = F.aggregate(F.sequence(F.lit(1), F.col(pieces)), F.lit(0), lambda s, j: s + drawn(j))
    kept = [F.col(f"`{c}`") for c in docs.columns]
    return (
        source.join(F.broadcast(table), F.col(mean).eqNullSafe(F.col(group)))
        .withColumn(n, count).where(F.col(n) > 0)
        .select(*kept, F.explode(F.sequence(F.lit(1), F.col(n))).alias("copy"))
        .withColumn("mix_order", _order(F.lit(f"{seed}:mix"), id_text, F.col("copy").cast("string")))
        .repartition("mix_order").sortWithinPartitions("mix_order")
    )
