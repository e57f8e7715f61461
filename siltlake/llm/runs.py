r"""Periodic runs of words, by recursive frequency splitting and a lag scan of what survives.

A run is a stretch with smallest period q of at least ``LEAST`` words and ``POWER`` periods that
no neighbour extends, so each of its words occurs ``POWER`` times in it. A word that occurs less
often within a segment belongs to no run there and splits it; the parts are shorter, more of
their words are rare, and so on until no word is. All texts of a slice are split at once: a
round is one sort of (segment, word) pairs. Prose is gone after a few rounds.

A surviving segment is scanned lag by lag. A run of period q and four periods holds three windows
of q words in a row that begin at multiples of q and are equal, so lag q costs length / q window
hashes and all lags of a segment length * log(length). Hashes only propose: candidates
are compared word by word. What lies within a run of a smaller period is no run of this one.

Everything is decided inside one text, so nothing is shuffled; a task holds one slice of texts,
a longer text goes alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltlake.llm.common import unused

#: A run has as many words at least, and as many periods.
LEAST, POWER = 6, 4
#: Bytes of text that are expanded to arrays at a time.
SLICE = 1 << 20
#: Words between which a period of a run stands: ASCII white space.
SPACE = r"[\x20\x09-\x0D]+"

_ODD = np.uint64(0x9E3779B97F4A7C15)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, and the place of each text's first word (one more at the end)."""
    lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null("")).cast(pa.large_list(pa.large_string()))
    words, first = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    filled = pc.greater(pc.binary_length(words), 0)  # white space at an end leaves an empty word
    before = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False))])
    return words.filter(filled), before[first]


def split(words: np.ndarray, segments: np.ndarray, power: int = POWER, least: int = LEAST) -> np.ndarray:
    """Places that survive the splitting, ascending; neighbours in a segment are consecutive places.

    ``segments`` ascend and name the text of each word. Two surviving places belong to one
    segment if they are consecutive numbers and stand in one text.
    """
    at = np.arange(len(words))
    segment = segments
    while len(at):
        order = np.lexsort((words[at], segment))
        new = np.ones(len(at), bool)
        w, s = words[at][order], segment[order]
        new[1:] = (w[1:] != w[:-1]) | (s[1:] != s[:-1])
        starts = np.flatnonzero(new)
        counts = np.diff(np.append(starts, len(at)))
        often = np.empty(len(at), bool)
        often[order] = np.repeat(counts >= power, counts)
        kept, texts = at[often], segments[at[often]]
        cut = np.ones(len(kept), bool)
        cut[1:] = (np.diff(kept) > 1) | (texts[1:] != texts[:-1])
        number = np.cumsum(cut) - 1
        long = np.bincount(number, minlength=1)[number] >= least if len(kept) else cut
        if len(kept) == len(at) and long.all():
            break
        at, segment = kept[long], number[long]
    return at


def lag_scan(words: np.ndarray, power: int = POWER, least: int = LEAST) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs of one segment, by start, then period; ``power`` is 3 or more."""
    n = len(words)
    powers = np.cumprod(np.full(n + 1, _ODD), dtype=np.uint64)
    with np.errstate(over="ignore"):
        sums = np.concatenate([[np.uint64(0)], np.cumsum((words.astype(np.uint64) + np.uint64(1)) * powers[1:])])
    covered = np.zeros(n, np.int64)  # how far the run of a smaller period at a place reaches
    found = []
    for q in range(1, n // power + 1):
        anchors = np.arange(0, n - q + 1, q)
        # The sums of equal windows differ by the power that stands for their distance.
        window = sums[anchors + q] - sums[anchors]
        same = window[1:] == window[:-1] * powers[q - 1]
        run = same.copy()
        for k in range(1, power - 2):
            run = run[:-1] & same[k:]
        hits = anchors[:len(run)][run]
        for a in hits[covered[hits] < hits + (power - 1) * q]:  # the rest is within a run of a smaller period
            if covered[a] >= a + (power - 1) * q:
                continue  # the run that the last hit found
            start, end = _extended(words, int(a), q)
            if end - start >= max(least, power * q):
                found.append((start, end - start, q))
                covered[start:end] = np.maximum(covered[start:end], end)
    return sorted(found, key=lambda r: (r[0], r[2]))


def _extended(words: np.ndarray, at: int, q: int) -> tuple[int, int]:
    """The stretch around ``at`` where words ``q`` apart are equal, looked for in doubling steps."""
    n, right, step = len(words), at, 64
    while right + q < n:
        high = min(right + step, n - q)
        differs = np.flatnonzero(words[right:high] != words[right + q:high + q])
        if len(differs):
            right += int(differs[0])
            break
        right, step = high, step * 2
    left, step = at, 64
    while left > 0:
        low = max(0, left - step)
        differs = np.flatnonzero(words[low:left] != words[low + q:left + q])
        if len(differs):
            left = low + int(differs[-1]) + 1
            break
        left, step = low, step * 2
    return left, right + q


def runs_of(words: np.ndarray, first: np.ndarray, power: int = POWER, least: int = LEAST) -> list[tuple[int, int, int, int]]:
    """``(text, start, length, period)`` of all runs of a slice, in order."""
    texts = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = split(words, texts, power, least)
    out = []
    for part in np.split(at, np.flatnonzero((np.diff(at) > 1) | (np.diff(texts[at]) > 0)) + 1) if len(at) else []:
        text = int(texts[part[0]])
        base = int(part[0] - first[text])
        out.extend((text, base + s, n, q) for s, n, q in lag_scan(words[part], power, least))
    return out


RUN = T.StructType().add("start", "long").add("length", "long").add("period", "long")
_ARROW_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    low = 0
    while low < len(texts):
        held = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, held + SLICE, side="right")))
        yield low, high
        low = high


def _found(texts: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Word counts, runs and collapsed texts of a slice."""
    words, first = words_of(texts)
    ids = words.dictionary_encode().indices.to_numpy() if len(words) else np.zeros(0, np.int64)
    hits = runs_of(ids, first)
    kept = np.ones(len(ids), bool)
    for text, start, length, period in hits:
        kept[first[text] + start + period:first[text] + start + length] = False
    left = np.concatenate([[0], np.cumsum(kept)])[first]
    lists = pa.ListArray.from_arrays(pa.array(left, pa.int32()), words.filter(pa.array(kept)))
    owner = np.array([h[0] for h in hits], np.int64)
    offsets = pa.array(np.searchsorted(owner, np.arange(len(first))), pa.int32())
    fields = [pa.array([h[i] for h in hits], pa.int64()) for i in (1, 2, 3)]
    runs = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(fields, fields=list(_ARROW_RUN)))
    return pa.array(np.diff(first), pa.int64()), runs, pc.binary_join(lists, pa.scalar(" ", words.type)).cast(pa.string())


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` and ``collapsed`` in place of columns of these names.

    ``runs`` are ``(start, length, period)`` in words, by start, then period; ``collapsed`` is the
    text with the words of each run after its first period left out, joined by one space.
    Words are parted by ASCII white space and compared byte by byte.

    Null, empty and blank texts have no words, no runs and an empty ``collapsed``; a text of any
    length is read whole. Rows that repeat get the same result each, and an empty table gives an empty one.
    """
    added = ("n_words", "runs", "collapsed")
    kept = [c for c in docs.columns if c.lower() not in added]
    place = unused(docs, "_searched")
    rows = docs.select(F.col(f"`{text}`").cast("string").alias(place), *[F.col(f"`{c}`") for c in kept])
    schema = T.StructType([*rows.select(*[F.col(f"`{c}`") for c in kept]).schema.fields, T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in _slices(batch.column(0)):
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], *_found(part.column(0))], names=[*kept, *added])

    return rows.mapInArrow(search, schema)


def digest(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The runs of each document as checksums and the one of greatest exponent."""
    better = lambda a, b: a["length"] * b["period"] > b["length"] * a["period"]
    best = F.aggregate("runs", F.lit(None).cast(RUN), lambda top, run: F.when(top.isNull() | better(run, top), run).otherwise(top))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.select(
        F.col(doc_id).alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def planted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` where a tenth, named by the checksum of the id, repeats a part of its words to the end.

    With h the CRC-32 of the decimal id, g = h div 10 and n words: where 10 divides h, from word
    a = g mod n on the text repeats its next p = 1 + (n - a) div (3 + g mod 8) words.
    """
    h = F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary"))
    over = lambda a, b: ((a - a % b) / b).cast("long")
    g = over(h, 10)
    words = F.filter(F.split(F.col(f"`{text}`"), SPACE, -1), lambda w: w != "")

    def repeated(ws: Column) -> Column:
        n = F.size(ws)
        a = g % F.greatest(n, F.lit(1))
        p = over(n - a, 3 + g % 8) + 1
        spot = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        return F.when(n > 0, F.array_join(F.transform(ws, lambda _, i: F.get(ws, spot(i).cast("int"))), " "))

    # Inside a lambda the words are a variable: the text is split once, not once per word.
    again = F.element_at(F.transform(F.array(words), repeated), 1)
    return docs.withColumn(text, F.when(h % 10 == 0, F.coalesce(again, F.col(f"`{text}`"))).otherwise(F.col(f"`{text}`")))
