"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

Terms are words and their leading 4, 5 and 6 letters. A test of each term against the label
over the learning rows keeps those that carry the label; document frequencies of the kept terms
are then counted over the whole corpus. Examples are indexed by term in blocks with the greatest
weight of each term per block: a search adds up these maxima, visits blocks from the most
promising down and stops when no block can reach the k-th nearest found, which is exact. The
nearest vote by similarity, weighted back to the classes' true sizes and smoothed by the prior.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltlake.llm.common import saved, unused, without

#: Learning rows per class, about: of a larger class a share is drawn by a hash of the id.
PER_CLASS = 10_000
#: Terms kept at most, those with the strongest association first.
MAX_TERMS = 5_000
#: Least G-squared of a term: a chance of about 1e-7 for a term that says nothing.
G2 = 28.0
NEAREST = 15
BLOCK = 64
#: Texts that are searched for together.
TOGETHER = 64
WORD = re.compile(r"[^\W\d_]+")


def terms_of(word: str) -> list[str]:
    """The terms that a word stands for; a star marks leading letters."""
    return [word, *(f"{word[:n]}*" for n in (4, 5, 6) if len(word) >= n)]


_LETTERS = "".join(chr(c) if chr(c).isalpha() else " " for c in range(128))


def words(text: str | None) -> list[str]:
    """The runs of letters of a text, lower-cased, in order."""
    text = (text or "").lower()
    return text.translate(_LETTERS).split() if text.isascii() else WORD.findall(text)


class TermCounter:
    """Term counts of texts over a fixed vocabulary."""

    def __init__(self, vocabulary: dict[str, int]):
        self.words = {t: i for t, i in vocabulary.items() if not t.endswith("*")}
        self.begun = [{t[:-1]: i for t, i in vocabulary.items() if t.endswith("*") and len(t) == n + 1} for n in (4, 5, 6)]
        self.heads = {t.rstrip("*")[:4] for t in vocabulary}  # most words begin like no term

    def __call__(self, text: str | None) -> dict[int, int]:
        out: dict[int, int] = {}
        heads, whole, (four, five, six) = self.heads, self.words, self.begun
        for word in words(text):
            head = word[:4]
            if head in heads:
                for i in (whole.get(word), four.get(head), five.get(word[:5]), six.get(word[:6])):
                    if i is not None:
                        out[i] = out.get(i, 0) + 1
        return out


@dataclass
class Index:
    """Distinct example vectors in blocks, inverted by term."""

    idf: np.ndarray
    vocabulary: dict[str, int]
    prior: float
    weight: np.ndarray = field(default=None)  # per distinct vector: examples by label, weighted
    votes: np.ndarray = field(default=None)
    members: np.ndarray = field(default=None)
    ids: list = field(default=None)
    postings: dict = field(default=None)
    blocks: int = 0
    most: np.ndarray = field(default=None)
    rows: np.ndarray = field(default=None)
    row_of: dict = field(default=None)

    def vector(self, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        ids = np.array(sorted(counts), np.int64)
        w = np.array([1.0 + math.log(counts[i]) for i in ids]) * self.idf[ids] if len(ids) else np.zeros(0)
        norm = math.sqrt(float(w @ w))
        return ids, w / norm if norm else w

    def build(self, examples: list[tuple[int, dict[int, int], int, float]]) -> Index:
        """``examples``: id, term counts, label, weight; those without a term say no more than the prior."""
        grouped: dict[tuple, list] = {}
        for doc, counts, label, weight in examples:
            if counts:
                grouped.setdefault(tuple(sorted(counts.items())), []).append((doc, label, weight))
        keys = sorted(grouped)  # alike vectors share blocks
        self.members = np.array([len(grouped[k]) for k in keys], np.int64)
        self.weight = np.array([sum(w for _, _, w in grouped[k]) for k in keys])
        self.votes = np.array([sum(w for _, y, w in grouped[k] if y) for k in keys])
        self.ids = [min(((-1 if d is None else d), y) for d, y, _ in grouped[k]) for k in keys]
        self.blocks = -(-len(keys) // BLOCK)
        raw: dict[int, tuple[list, list]] = {}
        for at, key in enumerate(keys):
            for i, w in zip(*self.vector(dict(key)), strict=True):
                raw.setdefault(int(i), ([], []))[0].append(at)
                raw[int(i)][1].append(w)
        self.postings = {}
        for i, (at, w) in raw.items():
            at, w = np.array(at), np.array(w)
            block, head = np.unique(at // BLOCK, return_index=True)
            self.postings[i] = (block, np.maximum.reduceat(w, head), at, w)
        return self

    def nearest(self, counts: dict[int, int], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct vectors that hold the ``k`` nearest examples, all at the k-th similarity, and their cosines."""
        return self.search([counts], k)[0]

    def spread(self) -> None:
        """Lay the index out for products: the greatest weight per term and block, and long lists as rows. Not sent with it."""
        if self.most is None:
            n = len(self.members)
            self.most = np.zeros((len(self.idf), self.blocks))
            for i, (block, most, _, _) in self.postings.items():
                self.most[i, block] = most
            long = [i for i, (_, _, at, _) in self.postings.items() if len(at) > n // 8]
            self.row_of, self.rows = {i: r for r, i in enumerate(long)}, np.zeros((len(long), n))
            for r, i in enumerate(long):
                self.rows[r, self.postings[i][2]] = self.postings[i][3]

    def search(self, batch: list[dict[int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` for several texts at once.

        The blocks are taken in two parts, the one that promises more to the batch first. A text
        leaves the second part out unless the upper bound of some block there reaches its k-th similarity.
        """
        self.spread()
        vectors = [self.vector(counts) for counts in batch]
        asked = np.zeros((len(batch), len(self.idf)))
        for j, (ids, w) in enumerate(vectors):
            asked[j, ids] = w
        bound = asked @ self.most
        weights = asked[:, list(self.row_of)]
        short = [
            [(self.postings[int(i)], q) for i, q in zip(ids, w, strict=True) if int(i) in self.postings and int(i) not in self.row_of]
            for ids, w in vectors]
        cosine, half = np.zeros((len(batch), len(self.members))), self.blocks // 2
        parts = [(0, half), (half, self.blocks)]
        kth = np.zeros(len(batch))
        for low, high in sorted(parts, key=lambda p: -bound[:, p[0]:p[1]].sum()):
            best = bound[:, low:high].max(axis=1, initial=0.0)
            need = np.flatnonzero((best > 0) & (best >= kth - 1e-12))
            first, last = low * BLOCK, min(high * BLOCK, len(self.members))
            if not len(need) or first >= last:
                continue
            scored = weights[need] @ self.rows[:, first:last]
            for j, own in zip(need, scored):
                for (_, _, at, weight), q in short[j]:
                    a, b = np.searchsorted(at, (first, last))
                    own[at[a:b] - first] += q * weight[a:b]
                cosine[j, first:last] = own
                kth[j] = self._kth(cosine[j], k)
        out = []
        for row, least in zip(cosine, kth):
            found = np.flatnonzero((row > 0) & (row >= least - 1e-12))
            found = found[np.lexsort((found, -row[found]))]
            out.append((found, row[found]))
        return out

    def _kth(self, cosine: np.ndarray, k: int) -> float:
        """The similarity of the k-th example; 0 if there are fewer. It is held by one of the k nearest vectors."""
        n = len(cosine)
        top = np.argpartition(cosine, n - k)[n - k:] if k < n else np.arange(n)
        top = top[np.argsort(-cosine[top], kind="stable")]
        at = int(np.searchsorted(np.cumsum(self.members[top]), k))
        return float(cosine[top[at]]) if at < len(top) else 0.0

    def scores(self, batch: list[dict[int, int]], k: int) -> list[tuple[float, list[dict]]]:
        """Score and evidence of each text."""
        if not self.blocks:
            return [self._voted(np.zeros(0, np.int64), np.zeros(0), k) for _ in batch]
        return [self._voted(found, cosine, k) for found, cosine in self.search(batch, k)]

    def _voted(self, found: np.ndarray, cosine: np.ndarray, k: int) -> tuple[float, list[dict]]:
        # Examples beyond the k-th stand in for each other: the group at the boundary counts in part.
        share = np.minimum(1.0, k / max(1, int(self.members[found].sum()))) if len(found) else 1.0
        yes, all_ = float((cosine * self.votes[found]).sum() * share), float((cosine * self.weight[found]).sum() * share)
        evidence = [{"doc_id": self.ids[i][0], "label": self.ids[i][1], "similarity": float(min(1.0, c))} for i, c in zip(found[:3], cosine[:3], strict=True)]
        return min(1.0, max(0.0, (yes + self.prior) / (all_ + 1.0))), evidence


def fit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
    per_class: int = PER_CLASS, max_terms: int = MAX_TERMS, seed: int = 5,
) -> Index:
    """Learn from the documents that ``labels(doc_id, label)`` marks 0 or 1.

    Labels are counted in full; of a class with more than ``per_class`` rows about that many are
    used, by a hash of the id, and weighted back. Rows that repeat id and text are one example;
    where ids repeat with other texts and a class still has more than twice ``per_class`` rows,
    about that many are used, by a hash of id and text, and weighted back too. That bounds what
    the driver builds and broadcasts. Ids with conflicting labels count as 1; null ids and labels are no examples.
    Without labels the prior is one half and there are no examples.
    """
    marked = (
        labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_y")).where("_id is not null and _y is not null")
        .groupBy("_id").agg((F.max("_y") > 0).cast("int").alias("_y"))
    )
    sizes = {r["_y"]: r["n"] for r in marked.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    share = {y: min(1.0, per_class / n) for y, n in sizes.items()}
    draw = F.pmod(F.xxhash64(F.col("_id").cast("string"), F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    wanted = F.when(F.col("_y") == 1, F.lit(share.get(1, 1.0))).otherwise(F.lit(share.get(0, 1.0)))
    chosen = F.broadcast(marked.where(draw < wanted))  # about 2 x per_class rows
    every = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_t")).join(chosen, "_id")
    each = saved(every.groupBy("_id", "_y", F.xxhash64("_t").alias("_h")).agg(F.first("_t").alias("_t")), "toxicity")
    part_of = {r["_y"]: min(1.0, 2 * per_class / r["n"]) for r in each.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    again = F.pmod(F.xxhash64(F.col("_id").cast("string"), "_h", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    learning = each.where(again < F.when(F.col("_y") == 1, F.lit(part_of.get(1, 1.0))).otherwise(F.lit(part_of.get(0, 1.0)))).select("_id", "_y", "_t")

    def count(batches):
        seen: dict[str, list[int]] = {}
        size = [0, 0]
        for batch in batches:
            for y, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                size[y] += 1
                for term in {x for w in set(words(t)) for x in terms_of(w)}:
                    seen.setdefault(term, [0, 0])[y] += 1
        seen[""] = size  # the number of rows
        yield pa.RecordBatch.from_arrays([
            pa.array(list(seen), pa.string()), pa.array([v[0] for v in seen.values()], pa.int64()),
            pa.array([v[1] for v in seen.values()], pa.int64())], names=["term", "n0", "n1"])

    terms = learning.select("_y", "_t").mapInArrow(count, "term string, n0 long, n1 long").groupBy("term").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    rows = terms.where("term = ''").collect()
    n0, n1 = (rows[0]["n0"], rows[0]["n1"]) if rows else (0, 0)

    def part(seen, of):  # 2 n ln(n / expected), the share of one cell in G-squared
        expected = (F.col("n0") + F.col("n1")) * of / max(1, n0 + n1)
        return F.when(seen > 0, 2 * seen * F.log(seen / expected)).otherwise(0.0)

    absent = lambda seen, of: F.when(of - seen > 0, 2 * (of - seen) * F.log(
        (of - seen) * max(1, n0 + n1) / (F.lit(n0 + n1) - F.col("n0") - F.col("n1")) / of)).otherwise(0.0)
    g2 = part(F.col("n0"), F.lit(n0)) + part(F.col("n1"), F.lit(n1)) + absent(F.col("n0"), F.lit(n0)) + absent(F.col("n1"), F.lit(n1))
    kept = (
        terms.where("term != '' and n0 + n1 >= 5").withColumn("g2", g2).where(F.col("g2") >= G2)
        .orderBy(F.desc("g2"), "term").limit(max_terms).collect()
    ) if n0 and n1 else []
    vocabulary = {r["term"]: i for i, r in enumerate(kept)}
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def frequency(batches):
        counts = TermCounter(shared.value)
        total = np.zeros(len(shared.value) + 1, np.int64)
        for batch in batches:
            for value in batch.column(0):
                for i in counts(value.as_py()):
                    total[i] += 1
            total[-1] += batch.num_rows
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["term", "n"])

    df = np.zeros(len(vocabulary) + 1)
    for r in docs.select(text).mapInArrow(frequency, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        df[r["term"]] = r["n"]  # one row per term and one for all documents
    idf = np.log((1.0 + df[-1]) / (1.0 + df[:-1])) + 1.0

    def vectors(batches):
        counts = TermCounter(shared.value)
        for batch in batches:
            found = [counts(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([list(f) for f in found], pa.list_(pa.int64())),
                pa.array([list(f.values()) for f in found], pa.list_(pa.int64()))], names=["_id", "_y", "ids", "tf"])

    kind = learning.schema["_id"].dataType.simpleString()
    examples = learning.mapInArrow(vectors, f"_id {kind}, _y int, ids array<long>, tf array<long>").collect()  # the bounded sample
    index = Index(idf, vocabulary, sizes.get(1, 0) / total if total else 0.5)
    return index.build([(r["_id"], dict(zip(r["ids"], r["tf"], strict=True)), r["_y"], 1.0 / share[r["_y"]] / part_of[r["_y"]]) for r in examples])


def score(docs: DataFrame, index: Index, text: str = "text", k: int = NEAREST) -> DataFrame:
    """``docs`` with ``score``, the share of toxic among the nearest, and ``evidence``, the three nearest.

    Null and empty texts, and texts without a term, get the prior and no evidence. Ties at the
    k-th similarity all vote. Texts are used whole; input columns called like the outputs are
    replaced; an empty table gives an empty one. Rows never leave their task.
    """
    docs = without(docs, ("score", "evidence"))
    body = unused(docs, "_body")
    shared = docs.sparkSession.sparkContext.broadcast(index)
    added = "score double, evidence array<struct<doc_id:bigint,label:int,similarity:double>>"
    schema = StructType([*docs.schema.fields, *StructType.fromDDL(added).fields])
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("label", pa.int32()), ("similarity", pa.float64())]))

    def vote(batches):
        known = shared.value
        counts = TermCounter(known.vocabulary)
        for batch in batches:
            out = []
            for low in range(0, batch.num_rows, TOGETHER):
                texts = batch.column(batch.num_columns - 1).slice(low, TOGETHER).to_pylist()
                keys = [tuple(sorted(counts(t).items())) for t in texts]
                new = list(dict.fromkeys(keys))  # copies are searched for once
                voted = dict(zip(new, known.scores([dict(key) for key in new], k), strict=True))
                out += [voted[key] for key in keys]
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:-1], pa.array([s for s, _ in out], pa.float64()), pa.array([e for _, e in out], kind)],
                names=schema.names)

    return docs.withColumn(body, F.col(text)).mapInArrow(vote, schema)


def accepted(docs: DataFrame, index: Index, limit: float, text: str = "text") -> DataFrame:
    """``docs`` whose score stays below ``limit``, with the columns they came with."""
    body, place = unused(docs, "_text"), unused(docs, "_place")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(place), F.col(text).alias(body))
    return score(packed, index, body).where(F.col("score") < limit).select(f"{place}.*")
