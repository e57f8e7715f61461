"""Substring dedup: paragraphs by MinHash banding, verified, clustered by components.

A paragraph is a line of five words or more. Equal lines share a hash; distinct ones get a
MinHash signature over five-word shingles, and lines that meet in a band are verified by exact
Jaccard similarity and joined into classes. Passages that repeat across documents need not
begin or end where lines do: sentences inside a line are hashed as well, and neighbouring
sentences that repeat make one span. Only spans of ``min_words`` or more are reported, so licence lines
and phrases stay.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from siltlake.llm.common import Saved, components, saved
from siltlake.llm.near import bands_of, links, members, sketch_of
from siltlake.llm.text import Words, mix64, shingles_of, words_of

#: 10 bands of 3 minima find a pair of similarity 0.8 with probability 0.9992, of 0.9 with 1 - 5e-6.
BANDS, ROWS = 10, 3
SIMILAR = 0.8
SHINGLE = 5
#: A passage is reported from this many words; sentences shorter than this many only bridge.
MIN_WORDS, MIN_SENTENCE = 20, 5

_A = np.random.Generator(np.random.PCG64(77)).integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)
PIECES = "doc_id {kind}, th long, starts array<int>, ends array<int>, words array<int>, lines array<boolean>, hashes array<long>"


def minhash(items: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Signatures of non-empty item runs ``first[i]:first[i + 1]``."""
    out = np.empty((len(first) - 1, len(_A)), np.uint64)
    for j, a in enumerate(_A):
        h = (items ^ a) * np.uint64(0x9E3779B97F4A7C15)
        out[:, j] = np.minimum.reduceat(h ^ (h >> np.uint64(29)), first[:-1]) if len(items) else 0
    return out


def cut(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Where a line begins, and where a sentence or line begins, as flags per word."""
    data, n = words.data, len(words.hashes)
    line, sentence = np.zeros(n, bool), np.zeros(n, bool)
    if n:
        feeds = np.append(0, np.cumsum(data == 10))
        stops = np.append(0, np.cumsum((data == 46) | (data == 33) | (data == 63)))
        line[1:] = feeds[words.starts[1:]] != feeds[words.ends[:-1]]
        line[words.first[:-1][words.count > 0]] = True
        sentence[1:] = stops[words.starts[1:]] != stops[words.ends[:-1]]
    return line, line | sentence


def _pieces(docs: DataFrame) -> DataFrame:
    """Per document, its lines and, inside lines that have several, its sentences."""

    def split(batches):
        for batch in batches:
            for low, high, words in words_of(batch.column(2)):
                line, sentence = cut(words)
                heads = np.flatnonzero(line)
                inner = np.flatnonzero(sentence)
                tails, inner_tails = np.append(heads[1:], len(line)), np.append(inner[1:], len(line))
                several = ~(line[inner] & np.isin(inner_tails, tails))
                keep_line = tails - heads >= SHINGLE
                keep_inner = several & (inner_tails - inner >= MIN_SENTENCE)
                first = np.concatenate([heads[keep_line], inner[keep_inner]])
                last = np.concatenate([tails[keep_line], inner_tails[keep_inner]])
                is_line = np.arange(len(first)) < keep_line.sum()
                order = np.argsort(first, kind="stable")
                first, last, is_line = first[order], last[order], is_line[order]
                # Order-sensitive hash of a run of words, from prefix sums of h[i] * step**i.
                n = len(line)
                step = np.uint64(0x9E3779B97F4A7C15)
                hashes = np.zeros(len(first), np.uint64)
                if n:
                    size = last - first
                    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
                    if len(at):
                        powers = np.cumprod(np.full(int(size.max()), step), dtype=np.uint64)
                        hashes = mix64(np.add.reduceat(words.hashes[np.repeat(first, size) + at] * powers[at], np.cumsum(size) - size))
                points = np.append(0, np.cumsum((words.data & 0xC0) != 0x80))
                owner = np.searchsorted(words.first, first, side="right") - 1
                origin = points[words.texts[:-1]][owner] if len(first) else first
                start, end = points[words.starts[first]] - origin, points[words.ends[last - 1]] - origin
                offsets = pa.array(np.searchsorted(owner, np.arange(high - low + 1)), pa.int32())
                as_list = lambda v, t: pa.ListArray.from_arrays(offsets, pa.array(v, t))  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(low, high - low), batch.column(1).slice(low, high - low), as_list(start.astype(np.int32), pa.int32()),
                    as_list(end.astype(np.int32), pa.int32()), as_list((last - first).astype(np.int32), pa.int32()),
                    as_list(is_line, pa.bool_()), as_list(hashes.view(np.int64), pa.int64())],
                    names=["doc_id", "th", "starts", "ends", "words", "lines", "hashes"])

    return docs.mapInArrow(split, PIECES.format(kind=docs.schema["doc_id"].dataType.simpleString()))


def _signed(docs: DataFrame) -> DataFrame:
    """``(id, keys, sketch)`` of every line occurrence."""

    def sign(batches):
        for batch in batches:
            for _, _, words in words_of(batch.column(0)):
                line, _ = cut(words)
                heads = np.flatnonzero(line)
                size = np.append(heads[1:], len(line)) - heads
                heads, size = heads[size >= SHINGLE], size[size >= SHINGLE]
                if not len(heads):
                    continue
                step = np.uint64(0x9E3779B97F4A7C15)
                at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
                powers = np.cumprod(np.full(int(size.max()), step), dtype=np.uint64)
                own = words.hashes[np.repeat(heads, size) + at]
                ids = mix64(np.add.reduceat(own * powers[at], np.cumsum(size) - size))
                # The same line is signed once per slice.
                ids, where = np.unique(ids, return_index=True)
                heads, size = heads[where], size[where]
                at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
                lines = Words(words.hashes[np.repeat(heads, size) + at], np.append(0, np.cumsum(size)), at, at, words.data, at)
                signature = minhash(*shingles_of(lines, SHINGLE))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids.view(np.int64)), pa.array(list(bands_of(signature, ROWS)), pa.list_(pa.int64())), sketch_of(signature)],
                    names=["id", "keys", "sketch"])

    return docs.select("text").mapInArrow(sign, "id long, keys array<long>, sketch binary")


def _line_classes(docs: DataFrame, pieces: DataFrame, similar: float) -> DataFrame:
    """``(id, root)`` of lines that have a near duplicate that is not equal."""
    sigs = Saved(_signed(docs).groupBy("id").agg(F.first("keys").alias("keys"), F.first("sketch").alias("sketch")), "paragraphs")
    buckets = members(sigs.df, "paragraphs")
    wanted = Saved(buckets.df.select(F.col("id").alias("wid")).distinct(), "paragraphs")
    one = pieces.select("doc_id", "th", F.explode(F.arrays_zip("hashes", "starts", "ends", "lines")).alias("p")).where("p.lines").select(
        F.col("p.hashes").alias("id"), F.struct("doc_id", "th", F.col("p.starts").alias("start"), F.col("p.ends").alias("end")).alias("at"))
    place = one.groupBy("id").agg(F.min("at").alias("at")).join(wanted.df, F.col("id") == F.col("wid")).select(
        "id", F.col("at.doc_id").alias("d"), F.col("at.th").alias("t"), F.col("at.start").alias("start"), F.col("at.end").alias("end"))
    per_doc = Saved(place.groupBy("d", "t").agg(F.collect_list(F.struct("id", "start", "end")).alias("wanted")), "paragraphs")
    texts = Saved(
        docs.join(per_doc.df, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")))
        .select("text", F.explode("wanted").alias("w"))
        .select(F.col("w.id").alias("id"), F.substring("text", F.col("w.start") + 1, F.col("w.end") - F.col("w.start")).alias("text"))
        .groupBy("id").agg(F.first("text").alias("text")), "paragraphs")
    found = saved(components(links(buckets, sigs.df, texts.df, False, similar, SHINGLE, "paragraphs"), "paragraphs"), "paragraphs")
    for done in (sigs, buckets, wanted, per_doc, texts):
        done.drop()
    return found


def duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similar: float = SIMILAR, min_words: int = MIN_WORDS,
) -> DataFrame:
    """``(doc_id, start, end, n_words, class_id, first_doc_id, removed)``, one row per repeated passage.

    Spans are code points, end exclusive. A line belongs to the class of its near duplicates,
    named by the least line hash of the class; a run of repeated sentences to that of its first
    sentence. The occurrence first by document id, then text and place, is not ``removed``, all
    others are; of a run of sentences only the occurrences after their first are listed as removed.
    Repeats within one document count. Spans of one document may overlap where a repeated line
    holds repeated sentences; the line is listed then.

    Null and empty texts and texts of short lines give no rows; a null id sorts first; rows that
    repeat a document repeat its passages, which are then duplicates of each other; an empty table
    gives an empty one; other columns are ignored. A hash is 64 bits, of the line's words.
    """
    keyed = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("th"), F.col(text).alias("text")).where("text is not null")
    pieces = saved(_pieces(keyed), "paragraphs")
    classes = _line_classes(keyed, pieces, similar)
    one = _numbered(pieces).select("doc_id", "th", "copy", F.explode(F.arrays_zip("hashes", "starts", "ends", "words", "lines")).alias("p")).select(
        F.col("p.hashes").alias("id"), "doc_id", "th", "copy", F.col("p.starts").alias("start"), F.col("p.ends").alias("end"),
        F.col("p.words").alias("n_words"), F.col("p.lines").alias("line"))
    place = F.struct("doc_id", "th", "start")
    # Per distinct piece: where it is first, and how often it occurs; then per class.
    each = one.groupBy("id").agg(F.min(place).alias("first"), F.count("*").alias("n"), F.max("line").alias("line"))
    each = each.join(classes.withColumnRenamed("node", "id"), "id", "left").where("n > 1 or root is not null").withColumn("root", F.coalesce("root", "id"))
    each = saved(each, "paragraphs")
    whole = saved(each.groupBy("root").agg(F.min("first").alias("first"), F.sum("n").alias("n")).where("n > 1"), "paragraphs")
    known = saved(each.select("id", "root").join(whole, "root").select("id", "root", "first"), "paragraphs")
    hit = saved(one.join(known, "id"), "paragraphs")
    hit = hit.withColumn("is_first", (F.col("first.doc_id").eqNullSafe(F.col("doc_id"))) & (F.col("first.th") == F.col("th")) & (F.col("first.start") == F.col("start"))
                         & (F.col("copy") == 1))
    lines = hit.where(F.col("line") & (F.col("n_words") >= min_words))
    return _spans(hit.where(~F.col("line") | (F.col("n_words") < min_words)), lines, min_words)


def _numbered(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``copy``, which counts the rows that repeat id and text from one."""
    repeats = saved(pieces.groupBy("doc_id", "th").agg(F.count("*").alias("n")).where("n > 1").select(
        F.col("doc_id").alias("d"), F.col("th").alias("t"), "n"), "paragraphs")
    on = pieces["doc_id"].eqNullSafe(repeats["d"]) & (pieces["th"] == repeats["t"])
    body = [c for c in pieces.columns if c not in ("doc_id", "th")]
    again = pieces.join(repeats, on).groupBy("doc_id", "th").agg(F.max("n").alias("n"), *[F.first(c).alias(c) for c in body])
    return pieces.join(repeats, on, "left_anti").withColumn("copy", F.lit(1).cast("long")).unionByName(
        again.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).drop("n"))


def _spans(small: DataFrame, lines: DataFrame, min_words: int) -> DataFrame:
    """Long lines as they are, and runs of smaller pieces that lie close together."""
    # Within a document pieces are few; rows that repeat a document are told apart by their copy.
    doc = W.partitionBy("doc_id", "th", "copy", "is_first").orderBy("start", F.desc("end"))
    once = small.groupBy("doc_id", "th", "copy", "start", "end", "is_first").agg(
        F.first("n_words").alias("n_words"), F.min("root").alias("root"), F.min("first.doc_id").alias("first_doc_id"))
    before = F.max("end").over(doc.rowsBetween(W.unboundedPreceding, -1))
    run = once.withColumn("fresh", F.coalesce(F.col("start") - before > _BRIDGE, F.lit(True)).cast("int")).withColumn(
        "covered", F.coalesce(F.col("end") <= before, F.lit(False)))
    runs = (
        run.withColumn("run", F.sum("fresh").over(doc)).where(~F.col("covered")).groupBy("doc_id", "th", "copy", "is_first", "run")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n_words").alias("n_words"),
             F.min_by("root", "start").alias("class_id"), F.min_by("first_doc_id", "start").alias("first_doc_id"))
        .where(F.col("n_words") >= min_words)
    )
    # A run inside a listed line says nothing new; lines are joined per document.
    own = lines.groupBy("doc_id", "th", "copy").agg(F.collect_set(F.struct("start", "end")).alias("own"))
    inside = F.exists(F.coalesce("own", F.array().cast("array<struct<start:int,end:int>>")), lambda x: (x["start"] <= F.col("start")) & (x["end"] >= F.col("end")))
    on = runs["doc_id"].eqNullSafe(own["doc_id"]) & (runs["th"] == own["th"]) & (runs["copy"] == own["copy"])
    runs = runs.join(own, on, "left").where(~inside).select(
        runs["doc_id"], "start", "end", F.col("n_words").cast("int").alias("n_words"), "class_id", "first_doc_id", (~F.col("is_first")).alias("removed"))
    return lines.select(
        "doc_id", "start", "end", "n_words", F.col("root").alias("class_id"), F.col("first.doc_id").alias("first_doc_id"),
        (~F.col("is_first")).alias("removed")).union(runs)


#: Code points between two repeated sentences that are bridged: a short sentence or two.
_BRIDGE = 60
