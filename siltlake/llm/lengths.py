"""Token counts: an exact histogram of encoded lengths and what its suffix sums answer.

Texts are encoded whole by a public byte-level BPE vocabulary, given as a rank file. Only
``(length, documents)`` pairs leave a task. The suffix sums over lengths are taken in two
levels, within ranges of lengths and over the ranges, so no task gets the whole histogram.
"""

from __future__ import annotations

import base64

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Lengths per range: a histogram to a billion tokens has 2**20 ranges at most.
RANGE = 1024
#: Characters encoded at once; longer texts are cut before a space between words, where the
#: vocabulary's own splitting cuts as well, so that counts stay exact.
PIECE = 100_000

_encoders: dict[tuple[str, str], object] = {}


def encoder(path: str, pattern: str):
    """The encoder of a rank file, loaded once per worker."""
    import tiktoken

    if (path, pattern) not in _encoders:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _encoders[path, pattern] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path, pattern]


def pieces(text: str, size: int = PIECE):
    """Parts of at least ``size`` characters that end between a letter and a space before a letter."""
    low = 0
    while len(text) - low > size:
        cut = low + size
        while cut < len(text) - 1 and not (text[cut] == " " and text[cut - 1].isalpha() and text[cut + 1].isalpha()):
            cut += 1
        if cut >= len(text) - 1:
            break
        yield text[low:cut]
        low = cut
    yield text[low:]


def token_counts(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``(length, documents, nulls)`` of each task's rows; a null text has length 0."""

    def count(batches):
        encode = encoder(path, pattern).encode_ordinary
        seen: dict[int, int] = {}
        for batch in batches:
            column = batch.column(0)
            for value in column:
                body = value.as_py()
                n = sum(len(encode(p)) for p in pieces(body)) if body else 0
                seen[n] = seen.get(n, 0) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], names=["length", "documents"])

    return docs.select(text).mapInArrow(count, "length long, documents long")


def histogram(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``(length, documents, tokens)``, one row per length that occurs.

    Null and empty texts have length 0; repeated rows count each; an empty table gives an empty
    histogram; other columns are ignored. A length that a third of all documents share is one
    row per task before it is shuffled.
    """
    return (
        token_counts(docs, path, pattern, text).groupBy("length").agg(F.sum("documents").alias("documents"))
        .withColumn("tokens", F.col("length") * F.col("documents"))
    )


def suffix_sums(hist: DataFrame) -> DataFrame:
    """For every length L as a context limit: documents and tokens at or above it, the rank of L,
    and ``truncated_tokens``, the total if every document were cut to L tokens."""
    ranged = hist.withColumn("_range", F.floor(F.col("length") / RANGE))
    sums = ranged.groupBy("_range").agg(F.sum("documents").alias("_d"), F.sum("tokens").alias("_t"))
    after = W.orderBy(F.desc("_range")).rowsBetween(W.unboundedPreceding, -1)  # one row per range
    whole = W.partitionBy()
    above = sums.select(
        "_range", F.coalesce(F.sum("_d").over(after), F.lit(0)).alias("_da"), F.coalesce(F.sum("_t").over(after), F.lit(0)).alias("_ta"),
        F.sum("_d").over(whole).alias("total_documents"), F.sum("_t").over(whole).alias("total_tokens"))
    within = W.partitionBy("_range").orderBy(F.desc("length")).rowsBetween(W.unboundedPreceding, 0)
    return (
        ranged.join(above, "_range")
        .withColumn("documents_from", F.sum("documents").over(within) + F.col("_da"))
        .withColumn("tokens_from", F.sum("tokens").over(within) + F.col("_ta"))
        .withColumn("truncated_tokens", F.col("total_tokens") - F.col("tokens_from") + F.col("documents_from") * F.col("length"))
        .withColumn("documents_up_to", F.col("total_documents") - F.col("documents_from") + F.col("documents"))
        .withColumn("quantile", F.col("documents_up_to") / F.col("total_documents"))
        .drop("_range", "_da", "_ta")
    )


def truncated_total(sums: DataFrame, limit: int) -> DataFrame:
    """``(limit, documents, tokens)``: what any context limit, also one that no document has, leaves."""
    top = sums.agg(F.max("total_documents").alias("n"), F.max("total_tokens").alias("t"))
    longer = sums.where(F.col("length") > limit).agg(F.max("documents_from").alias("d"), F.max("tokens_from").alias("l"))
    return top.join(longer).select(
        F.lit(limit).cast("long").alias("limit"), F.coalesce("n", F.lit(0)).alias("documents"),
        (F.coalesce("t", F.lit(0)) - F.coalesce("l", F.lit(0)) + F.coalesce("d", F.lit(0)) * limit).alias("tokens"))


def quantiles(sums: DataFrame, at: list[float]) -> DataFrame:
    """``(q, length)``: the least length that a share ``q`` of all documents does not exceed."""
    asked = F.explode(F.array(*map(F.lit, map(float, at)))).alias("q")
    return sums.select("length", "quantile", asked).where("quantile >= q").groupBy("q").agg(F.min("length").alias("length"))
