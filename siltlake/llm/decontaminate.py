"""Benchmark decontamination as a prefix-filtered set join.

An item's windows are its runs of 13 words. A document contains a window only if it contains
all its words, so one word is a necessary prefix: words are ordered by rarity, counted over the
whole corpus, and only the rarest of each window is looked up. A hit fixes where the window
would lie; it must lie inside the document (positional and length bound) and is then compared
word by word. Documents are read, never shuffled; the benchmark goes to them in blocks of a
bounded number of words, and results of several blocks are merged per document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltlake.llm.common import row_key, saved, unused
from siltlake.llm.text import words_of

WINDOW = 13
#: Item words per block, which bounds what is broadcast: 8 bytes a word and 13 per window.
BLOCK_WORDS = 1_000_000

HITS = "row string, n_words long, starts array<long>, ends array<long>, items array<string>"


class Windows:
    """The windows of one block of items, and the word that each is looked up by."""

    def __init__(self, items: list[tuple[str | None, np.ndarray]], width: int):
        found: dict[bytes, int] = {}
        self.items: list[list[str]] = []
        self.words: list[np.ndarray] = []
        for item, hashes in items:
            last = max(len(hashes) - width, 0)
            for at in range(last + 1 if len(hashes) else 0):
                window = hashes[at:at + width]
                no = found.setdefault(window.tobytes(), len(self.words))
                if no == len(self.words):
                    self.words.append(window)
                    self.items.append([])
                if item is not None and item not in self.items[no]:
                    self.items[no].append(item)
        self.vocabulary = np.unique(np.concatenate(self.words)) if self.words else np.zeros(0, np.uint64)

    def index(self, frequency: np.ndarray) -> Windows:
        """Choose prefixes; ``frequency`` is that of each word of the vocabulary in the corpus."""
        n = np.array([len(w) for w in self.words], np.int64)
        first = np.concatenate([[0], np.cumsum(n)])
        flat = np.concatenate(self.words) if len(n) else np.zeros(0, np.uint64)
        rarity = frequency[np.searchsorted(self.vocabulary, flat)]
        at = np.array([int(np.argmin(rarity[a:b])) for a, b in zip(first[:-1], first[1:], strict=True)], np.int64)
        prefix = flat[first[:-1] + at]
        order = np.argsort(prefix, kind="stable")
        self.flat, self.first, self.length, self.at, self.order = flat, first, n, at, order
        self.prefix, self.prefix_from = np.unique(prefix[order], return_index=True)
        self.prefix_to = np.append(self.prefix_from[1:], len(order))
        self.words = []
        return self

    def occurrences(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(text, start word, window)`` of every occurrence in texts with these word hashes."""
        none = np.zeros(0, np.int64)
        if not len(self.prefix) or not len(hashes):
            return none, none, none
        spot = np.searchsorted(self.prefix, hashes)
        spot[spot == len(self.prefix)] = 0
        pos = np.flatnonzero(self.prefix[spot] == hashes)
        spot = spot[pos]
        many = (self.prefix_to - self.prefix_from)[spot]
        slot = np.repeat(self.prefix_from[spot] - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
        pos, window = np.repeat(pos, many), self.order[slot]
        text = np.searchsorted(first, pos, side="right") - 1
        start, length = pos - self.at[window], self.length[window]
        inside = (start >= first[text]) & (start + length <= first[text + 1])
        text, start, window, length = text[inside], start[inside], window[inside], length[inside]
        for k in range(int(length.max(initial=0))):
            same = (k >= length) | (hashes[np.minimum(start + k, len(hashes) - 1)]
                                    == self.flat[np.minimum(self.first[window] + k, len(self.flat) - 1)])
            if not same.all():
                text, start, window, length = text[same], start[same], window[same], length[same]
        return text, start, window


def _blocks(items: DataFrame, item_id: str, text: str, width: int, block_words: int) -> Iterator[Windows]:
    """Windows of all items, block by block; the driver holds one block at a time."""
    rows = items.select(F.col(item_id).cast("string").alias("id"), F.col(text).alias("text")).where("text is not null")
    block, words = [], 0
    for row in rows.toLocalIterator():
        for _, _, found in words_of(pa.array([row["text"]], pa.string())):
            block.append((row["id"], found.hashes.copy()))
            words += len(found.hashes)
        if words >= block_words:
            yield Windows(block, width)
            block, words = [], 0
    yield Windows(block, width)


def _frequency(docs: DataFrame, text: str, windows: Windows) -> np.ndarray:
    """How often each word of the block occurs in the corpus."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(windows.vocabulary)

    def count(batches):
        words = vocabulary.value
        total = np.zeros(len(words), np.int64)
        for batch in batches:
            for _, _, found in words_of(batch.column(0)):
                spot = np.searchsorted(words, found.hashes)
                spot[spot == len(words)] = 0
                total += np.bincount(spot[words[spot] == found.hashes], minlength=len(words)) if len(words) else 0
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "n"])

    counts = docs.select(text).mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(len(windows.vocabulary), np.int64)
    for row in counts:  # one per word of the block at most
        out[row["at"]] = row["n"]
    return out


def _hits(docs: DataFrame, windows: Windows) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(windows)

    def search(batches):
        index = shared.value
        for batch in batches:
            ids, keys = batch.column(0), batch.column(1)
            for low, high, found in words_of(batch.column(2)):
                text, start, window = index.occurrences(found.hashes, found.first)
                order = np.lexsort((start, text))
                text, start, window = text[order], start[order], window[order]
                bound = np.searchsorted(text, np.arange(high - low + 1))
                starts, ends, items = [], [], []
                for i in range(high - low):
                    a, b = bound[i], bound[i + 1]
                    if a == b:
                        starts.append([]), ends.append([]), items.append([])
                        continue
                    s = start[a:b] - found.first[i]
                    e = s + index.length[window[a:b]]
                    reach = np.maximum.accumulate(e)
                    head = np.append(True, s[1:] > reach[:-1])  # spans that meet become one
                    starts.append(s[head]), ends.append(np.append(reach[:-1][head[1:]], reach[-1]))
                    items.append(sorted({x for w in set(window[a:b].tolist()) for x in index.items[w]}))
                yield pa.RecordBatch.from_arrays([
                    ids.slice(low, high - low), keys.slice(low, high - low), pa.array(found.count), pa.array(starts, pa.list_(pa.int64())),
                    pa.array(ends, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))],
                    names=["doc_id", "row", "n_words", "starts", "ends", "items"])

    return docs.mapInArrow(search, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {HITS}")


def contaminated(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", width: int = WINDOW, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document: ``doc_id, row, n_words, starts, ends, items``.

    ``row`` is :func:`~siltlake.llm.common.row_key`; the spans of words that lie in an occurrence
    of a window are disjoint and ascending, and ``items`` are the ids, as sorted strings, of the
    items with one. A document counts as often as its row is repeated.

    Null and empty texts have no words and no hits; items without words or text have no
    windows; those without an id hit like others but are not named; an item shorter than ``width`` words is one window; items that share a window are
    all named; empty tables give no hits or no rows; other columns are ignored. What is broadcast
    is one block of at most ``block_words`` words and one item; a larger benchmark takes more
    blocks, each a pass over the documents, and their spans are merged per document.
    """
    keyed = docs.select(F.col(doc_id).alias("doc_id"), row_key(F.col(doc_id), F.col(text)).alias("row"), F.col(text).alias("text"))
    found = []
    for windows in _blocks(items, item_id, item_text, width, block_words):
        found.append(_hits(keyed, windows.index(_frequency(keyed, "text", windows))))
    if len(found) == 1:
        return found[0]
    parts = [saved(f, "windows") for f in found]
    # Only documents with hits are regrouped, and as many rows as the table repeats stay.
    every = parts[0]
    for part in parts[1:]:
        every = every.union(part)
    spans = every.where(F.size("starts") > 0).select("row", F.explode(F.arrays_zip("starts", "ends")).alias("s")).groupBy("row").agg(
        F.array_sort(F.collect_set("s")).alias("s"))
    names = every.select("row", F.explode("items").alias("item")).groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    joined = F.aggregate(
        "s", F.expr("cast(array() as array<struct<starts:bigint,ends:bigint>>)"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (x["starts"] <= F.element_at(done, -1)["ends"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
                F.element_at(done, -1)["starts"].alias("starts"),
                F.greatest(F.element_at(done, -1)["ends"], x["ends"]).alias("ends")))),
        ).otherwise(F.concat(done, F.array(x))))
    merged = spans.join(names, "row", "left").select("row", joined.alias("s"), "items")
    return parts[0].select("doc_id", "row", "n_words").join(merged, "row", "left").select(
        "doc_id", "row", "n_words", F.coalesce(F.col("s")["starts"], F.array().cast("array<long>")).alias("starts"),
        F.coalesce(F.col("s")["ends"], F.array().cast("array<long>")).alias("ends"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def judged(hits: DataFrame) -> DataFrame:
    """Adds ``n_hit``, ``n_items``, ``items_sha256`` and ``contaminated``: a twentieth of the words hit."""
    n_hit = F.aggregate(F.zip_with("starts", "ends", lambda s, e: e - s), F.lit(0).cast("long"), lambda a, x: a + x)
    return (
        hits.withColumn("n_hit", n_hit).withColumn("n_items", F.size("items").cast("long"))
        .withColumn("items_sha256", F.sha2(F.concat_ws(",", "items"), 256))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words")))
    )


def clean_rows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the contaminated ones, every column kept."""
    row = unused(docs, "_row")
    hit = saved(judged(contaminated(docs, items)).where("contaminated").select(F.col("row").alias(row)).distinct(), "windows")
    keyed = docs.withColumn(unused(docs, "_key"), row_key(F.col("doc_id"), F.col("text")))
    return keyed.join(hit, F.col(unused(docs, "_key")) == F.col(row), "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def brute(text: str | None, items: list[tuple[str, str]], width: int = WINDOW) -> tuple[int, int, str]:
    """``(n_words, n_hit, items_sha256)`` of one text by the definition, for tests."""
    import re

    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(lower))
    words, hit, names = cut(text), set(), set()
    for item, body in items:
        own = cut(body)
        for at in range(max(len(own) - width, 0) + 1 if own else 0):
            window = own[at:at + width]
            for i in range(len(words) - len(window) + 1):
                if words[i:i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    names.add(item)
    return len(words), len(hit), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
