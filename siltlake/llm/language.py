"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from a seed and the letter alone. A
trigram binds its letters by position: the first permuted twice, the second once, the third as
it is, multiplied. A text bundles (adds) the vectors of its trigrams, a language those of its
learning texts, and a text gets the language whose vector has the greatest cosine with its own.
Bundling is linear, so texts are reduced to trigram counts first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltlake.llm.common import unused, without

DIM = 1024
SEED = 97
#: Learning documents of a language, about: of languages with more, a share is drawn by hash.
PER_LANGUAGE = 20_000
#: A model has a vector per language; more languages than this are refused, not dropped.
MAX_LANGUAGES = 4096
UNKNOWN = "und"
SLICE = 1 << 20

_tables: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """The lower-case code point of every letter, 0 for all else."""
    if not _tables:
        table = np.zeros(0x110000, np.int64)
        for c in range(0x110000):
            char = chr(c)
            if char.isalpha():
                low = char.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _tables.append(table)
    return _tables[0]


def trigrams(texts: list[str]) -> Iterator[np.ndarray]:
    """The trigrams of each text as integers, ascending; words are set off by one gap each."""
    low = 0
    while low < len(texts):
        high, size = low, 0
        while high < len(texts) and (high == low or size + len(texts[high]) <= SLICE):
            size += len(texts[high])
            high += 1
        codes = np.frombuffer("\n".join(["", *texts[low:high], ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum([len(t) + 1 for t in texts[low:high]])
        codes = _letters()[codes]
        letter = codes > 0
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        keep[:-1] |= letter[1:] & ~letter[:-1] & (np.append(True, ~letter[:-1])[:-1])
        place = np.flatnonzero(keep)
        seq = codes[place]
        grams = (seq[:-2] << 42) | (seq[1:-1] << 21) | seq[2:]
        bounds = np.searchsorted(place, np.append(0, ends))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            own = grams[a:max(a, b - 1)]
            # A trigram is a text's own if its middle letter is; gaps in the middle say nothing new.
            yield np.sort(own[(own >> 21) & 0x1FFFFF > 0])
        low = high


class Vectors:
    """Trigram vectors as they are needed; forgotten together when there are too many."""

    LIMIT = 20_000

    def __init__(self, dim: int, seed: int):
        self.dim, self.seed = dim, seed
        self.letters: dict[int, int] = {}
        self.placed = np.zeros((3, 0, dim), np.float32)  # every letter's vector at each place of a trigram
        self.rows = np.zeros((0, dim), np.float32)
        self.clear()

    def clear(self) -> None:
        self.keys, self.at = np.zeros(0, np.int64), np.zeros(0, np.int64)  # ascending trigrams and their rows

    def _letter(self, code: int) -> np.ndarray:
        draw = np.random.Generator(np.random.Philox(key=[self.seed, code]))
        return (draw.integers(0, 2, self.dim) * 2 - 1).astype(np.float32)

    def _bind(self, grams: np.ndarray) -> np.ndarray:
        codes = [grams >> 42, (grams >> 21) & 0x1FFFFF, grams & 0x1FFFFF]
        new = [int(c) for c in np.unique(np.concatenate(codes)) if int(c) not in self.letters]
        if new:
            self.letters |= {c: len(self.letters) + i for i, c in enumerate(new)}
            drawn = np.stack([self._letter(c) for c in new])
            self.placed = np.concatenate([self.placed, np.stack([np.roll(drawn, k, axis=1) for k in (2, 1, 0)])], axis=1)
        first, second, third = (self.placed[k][[self.letters[int(c)] for c in codes[k]]] for k in range(3))
        return first * second * third

    def _known(self, grams: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(grams), bool)
        return self.keys[np.minimum(np.searchsorted(self.keys, grams), len(self.keys) - 1)] == grams

    def _learn(self, new: np.ndarray) -> None:
        low, high = len(self.keys), len(self.keys) + len(new)
        if high > len(self.rows):
            more = np.zeros((max(high, min(self.LIMIT, 2 * len(self.rows))) - len(self.rows), self.dim), np.float32)
            self.rows = np.concatenate([self.rows, more])
        self.rows[low:high] = self._bind(new)
        keys, at = np.append(self.keys, new), np.append(self.at, np.arange(low, high))
        order = np.argsort(keys)
        self.keys, self.at = keys[order], at[order]

    def bundle(self, grams: np.ndarray) -> np.ndarray:
        """The sum of the vectors of ascending ``grams``."""
        if not len(grams):
            return np.zeros(self.dim, np.float32)
        head = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
        counts = np.diff(np.append(head, len(grams))).astype(np.float32)
        distinct = grams[head]
        total = np.zeros(self.dim, np.float32)
        for low in range(0, len(distinct), self.LIMIT):
            part = distinct[low:low + self.LIMIT]
            new = part[~self._known(part)]
            if len(new):
                if len(self.keys) + len(new) > self.LIMIT:
                    self.clear()
                    new = part
                self._learn(new)
            total += counts[low:low + self.LIMIT] @ self.rows[self.at[np.searchsorted(self.keys, part)]]
        return total


_vectors: dict[tuple[int, int], Vectors] = {}


def vectors_of(dim: int, seed: int) -> Vectors:
    """The vectors of this process, which its tasks share one after the other."""
    return _vectors.setdefault((dim, seed), Vectors(dim, seed))


@dataclass
class Model:
    languages: list[str]
    prototypes: np.ndarray  # unit vectors, one row per language
    dim: int
    seed: int


def fit(
    docs: DataFrame, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE, dim: int = DIM, seed: int = SEED,
) -> Model:
    """Bundle the learning documents of each language.

    Rows without text or language are no examples. All languages are counted over the whole
    table; a language with more than ``per_language`` documents is learnt from about that many,
    chosen by a hash of the text, so identical texts stand or fall together. An empty table
    gives a model without languages.
    """
    rows = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where("text is not null and lang is not null")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return Model([], np.zeros((0, dim), np.float32), dim, seed)
    share = F.create_map(*[F.lit(v) for r in sizes for v in (r["lang"], min(1.0, per_language / r["n"]))])
    draw = F.pmod(F.xxhash64(F.col("text"), F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    chosen = rows.where(draw < share[F.col("lang")])

    def bundle(batches):
        vectors, sums = vectors_of(dim, seed), {}
        for batch in batches:
            names = batch.column(1).to_pylist()
            by: dict[str, list[np.ndarray]] = {}
            for name, grams in zip(names, trigrams(batch.column(0).to_pylist()), strict=True):
                by.setdefault(name, []).append(grams)
                if sum(map(len, by[name])) > SLICE:
                    sums[name] = sums.get(name, 0) + vectors.bundle(np.sort(np.concatenate(by.pop(name)))).astype(np.float64)
            for name, grams in by.items():
                sums[name] = sums.get(name, 0) + vectors.bundle(np.sort(np.concatenate(grams))).astype(np.float64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.list_(pa.float64()))], names=["lang", "v"])

    parts = chosen.mapInArrow(bundle, "lang string, v array<double>")
    sums = (
        parts.select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
        .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("v")).collect()
    )  # one vector per language
    sums = sorted(sums, key=lambda r: r["lang"])
    matrix = np.array([[x["x"] for x in r["v"]] for r in sums]).reshape(len(sums), dim)
    norm = np.linalg.norm(matrix, axis=1, keepdims=True)
    return Model([r["lang"] for r in sums], (matrix / np.where(norm > 0, norm, 1)).astype(np.float32), dim, seed)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the cosine clipped to 0 to 1.

    Null texts, texts without a letter, and all texts under a model without languages get
    ``und`` and 0. Of equal cosines the first language by name wins. Texts are used whole; input
    columns called like the two outputs are replaced; an empty table gives an empty one.
    """
    docs = without(docs, ("lang_pred", "score"))
    body = unused(docs, "_body")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.schema.add("lang_pred", "string").add("score", "double")

    def classify(batches):
        known = shared.value
        vectors = vectors_of(known.dim, known.seed)
        for batch in batches:
            names, scores = [], []
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            for grams in trigrams(texts):
                vector = vectors.bundle(grams)
                norm = float(np.linalg.norm(vector))
                if not norm or not known.languages:
                    names.append(UNKNOWN), scores.append(0.0)
                    continue
                cosine = known.prototypes @ vector / norm
                best = int(np.argmax(cosine))
                names.append(known.languages[best]), scores.append(float(min(1.0, max(0.0, cosine[best]))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=schema.names)

    return docs.withColumn(body, F.col(text)).mapInArrow(classify, schema)


def fold(doc_id: Column, folds: int, held_out: int) -> Column:
    """Whether a document belongs to the held-out fold."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds)) == held_out, F.lit(False))
