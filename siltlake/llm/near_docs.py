"""Near-duplicate documents by DartMinHash over weighted word shingles.

A document is the set of its five-word shingles, each weighted by its count. Every shingle owns
an endless strip of weight; darts fall on it at random times, the hash of shingle, piece of the
strip and number of the dart giving time, place and coordinate, so all documents see the same
darts. A document keeps, of the darts that hit within a shingle's weight, the earliest per
coordinate. Two documents keep the same dart with the probability of their weighted Jaccard
similarity, and only about k log k darts are thrown however many shingles there are.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltlake.llm.common import Saved, components, may_be_in, saved, unused
from siltlake.llm.near import bands_of, links, members, sketch_of
from siltlake.llm.text import counted, mix64, shingles_of, words_of

#: 16 bands of 4 coordinates find a pair of similarity 0.8 with probability 0.9998.
BANDS, ROWS = 16, 4
SIMILAR = 0.8
SHINGLE = 5

_U = 1.0 / float(1 << 53)


def _unit(h: np.ndarray) -> np.ndarray:
    """Hashes as numbers in (0, 1]."""
    return ((h >> np.uint64(11)).astype(np.float64) + 1.0) * _U


def dart_signatures(items: np.ndarray, weights: np.ndarray, first: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """``k`` coordinates per text, as 64-bit names of darts; texts without items stay 0.

    Items are distinct within a text, weights positive. The strip of an item is cut at 0, 1, 2,
    4, ...; darts fall on a piece at a rate equal to its width and count if they hit below the
    weight. Darts are thrown until a time by which all coordinates are likely hit; texts that
    still miss one go on to twice that time, and again.
    """
    n = len(first) - 1
    out = np.zeros((n, k), np.uint64)
    size = np.diff(first)
    text = np.repeat(np.arange(n), size)
    total = np.bincount(text, weights=weights, minlength=n)
    pieces = np.where(weights > 1, 1 + np.ceil(np.log2(np.maximum(weights, 1.0))), 1).astype(np.int64)
    which = np.repeat(np.arange(len(items)), pieces)
    piece = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    width = np.where(piece > 0, 2.0 ** np.maximum(piece - 1, 0), 1.0)
    low = np.where(piece > 0, width, 0.0)
    base = mix64(items[which] + np.uint64(0x9E3779B97F4A7C15) * (piece.astype(np.uint64) + np.uint64(seed * 64 + 1)))
    reach, owner = weights[which], text[which]
    until = np.zeros(n)
    has = total > 0
    until[has] = k * (math.log(k) + 4.0) / total[has]
    todo = has.copy()
    while todo.any():
        live = np.flatnonzero(todo[owner])
        time = np.zeros(len(live))
        darts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        step = 0
        while len(live):
            dart = mix64(base[live] + np.uint64(0xD1342543DE82EF95 * (step + 1) % 2**64))
            time = time - np.log(_unit(dart)) / width[live]
            on = time <= until[owner[live]]
            live, time, dart = live[on], time[on], dart[on]
            place = mix64(dart ^ np.uint64(0xA0761D6478BD642F))
            hit = low[live] + _unit(place) * width[live] <= reach[live]
            slot = (mix64(place) % np.uint64(k)).astype(np.int64)
            darts.append((owner[live[hit]] * k + slot[hit], time[hit], dart[hit]))
            step += 1
        slot, when, dart = (np.concatenate([d[i] for d in darts]) for i in range(3))
        order = np.lexsort((dart, when, slot))
        slot, dart = slot[order], dart[order]
        head = np.flatnonzero(np.append(True, slot[1:] != slot[:-1])) if len(slot) else np.zeros(0, np.int64)
        out.reshape(-1)[slot[head]] = dart[head]
        filled = np.bincount(slot[head] // k, minlength=n) if len(head) else np.zeros(n, np.int64)
        todo &= filled < k
        until[todo] *= 2
    return out


def signed(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, shingle: int = SHINGLE) -> DataFrame:
    """``(id, keys, sketch)`` for ``docs(id, text)``: the buckets and the sketch of each text with words."""

    def sign(batches):
        for batch in batches:
            ids = batch.column(0)
            for low, high, words in words_of(batch.column(1)):
                items, counts, first = counted(*shingles_of(words, shingle))
                darts = dart_signatures(items, counts.astype(np.float64), first, bands * rows)
                keys, sketches = bands_of(darts, rows), sketch_of(darts)
                worded = np.flatnonzero(words.count > 0)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(low, high - low).take(pa.array(worded)), pa.array(list(keys[worded]), pa.list_(pa.int64())),
                     sketches.take(pa.array(worded))], names=["id", "keys", "sketch"])

    return docs.select("id", "text").mapInArrow(sign, "id long, keys array<long>, sketch binary")


def _has_words(text):
    """Whether a text has a word in the sense of the shingles."""
    return F.coalesce(F.regexp_like(text, F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]")), F.lit(False))


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similar: float = SIMILAR) -> DataFrame:
    """One row per document: ``doc_id, text_id, class_id, class_size, keep``.

    A class joins documents through links of weighted Jaccard similarity ``similar`` or more of
    five-word shingles; its id is its least ``doc_id``, whose rows have ``keep``. ``text_id`` is a
    64-bit hash of the text; equal texts share one, and are one text from there on.

    Texts that are null or have no word are in no class: ``class_id`` is their own id, and they
    are kept. A text of fewer than five words is one shingle. Null ids sort after all others and
    are kept only where the class has no other. Rows that repeat a document are each listed, with
    the same class and ``keep``. An empty table gives an empty one; other columns are ignored.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("id"), _has_words(F.col(text)).alias("worded"))
    ids = rows.where("worded")
    sigs = Saved(signed(ids).groupBy("id").agg(F.first("keys").alias("keys"), F.first("sketch").alias("sketch")), "darts")
    buckets = members(sigs.df, "darts")
    # The text of a colliding id comes from its least document, so that copies move no text.
    first = ids.groupBy("id").agg(F.min("doc_id").alias("first"))
    wanted = Saved(first.join(buckets.df.select("id").distinct(), "id", "left_semi").select(F.col("id").alias("wid"), "first"), "darts")
    # Only texts that may be wanted are shuffled.
    likely = may_be_in(ids, F.xxhash64("id", "doc_id"), wanted.df.select(F.xxhash64("wid", "first")), "likely").where("likely")
    texts = Saved(
        likely.join(wanted.df, (F.col("id") == F.col("wid")) & F.col("doc_id").eqNullSafe(F.col("first")))
        .select("id", "text").groupBy("id").agg(F.first("text").alias("text")), "darts")
    wanted.drop()
    comp = saved(components(links(buckets, sigs.df, texts.df, True, similar, SHINGLE, "darts"), "darts"), "darts")
    for done in (sigs, texts, buckets):
        done.drop()
    sized = ids.groupBy("id").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    rooted = sized.join(comp.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    rooted = saved(rooted, "darts")
    # Written before they are joined: Spark can then split a class or text that many rows share.
    whole = saved(rooted.groupBy("root").agg(F.min("least").alias("class_id"), F.sum("n").alias("class_size")), "darts")
    known = saved(rooted.join(whole, "root").select(F.col("id").alias("kid"), "class_id", "class_size"), "darts")
    listed = rows.select("doc_id", F.col("id").alias("text_id"), "worded")
    return listed.join(known, (F.col("text_id") == F.col("kid")) & F.col("worded"), "left").select(
        "doc_id", "text_id", F.when(F.col("worded"), F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"),
        (~F.col("worded") | F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("keep"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each class, all columns kept.

    Of rows that repeat the kept id, the one with the least text hash stays; of full repeats, one.
    """
    found = saved(classes(docs), "classes")
    grouped = found.where("class_size > 1")
    kept = grouped.where("keep").groupBy("class_id").agg(F.min("text_id").alias("t"), F.count("*").alias("rows"))
    kept = saved(kept.withColumnRenamed("class_id", "c"), "classes")
    judged = saved(grouped.join(kept, F.col("class_id").eqNullSafe(F.col("c"))).select(
        "doc_id", "text_id", (F.col("keep") & (F.col("text_id") == F.col("t"))).alias("stays"), "rows"), "classes")
    # Rows that go, or stay once of several; all others need no join.
    verdicts = saved(judged.where("not stays or rows > 1").select("doc_id", "text_id", "stays").distinct(), "classes")
    id_, text_, worded = (unused(docs, c) for c in ("_id", "_text_id", "_worded"))
    marked = docs.withColumns({id_: F.col("doc_id"), text_: F.xxhash64("text"), worded: _has_words(F.col("text"))})
    judge_id, judge_text, stays, likely = (unused(marked, c) for c in ("_judge_id", "_judge_text", "_stays", "_likely"))
    told = may_be_in(marked, F.xxhash64(text_, id_), verdicts.select(F.xxhash64("text_id", "doc_id")), likely)
    likely_too = F.col(worded) & F.col(likely)
    on = (F.col(text_) == F.col(judge_text)) & F.col(id_).eqNullSafe(F.col(judge_id))
    met = told.where(likely_too).join(verdicts.toDF(judge_id, judge_text, stays), on, "left")
    repeats = met.where(F.col(stays)).dropDuplicates([id_, text_])
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return told.where(~likely_too).select(*columns).union(met.where(F.col(stays).isNull()).select(*columns)).union(repeats.select(*columns))
