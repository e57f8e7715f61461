"""Words of many texts at once: numpy over the bytes of an Arrow batch.

A word is a run of ``[0-9a-z]`` (A-Z lower-cased) and of characters above U+007F, whose UTF-8
bytes are all above 0x7F, so that bytes can be classed alone. Words become 64-bit hashes; equal
words have equal hashes, different ones differ but for a chance of 2**-64 per pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are expanded to arrays at a time; a longer text goes alone.
SLICE = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_BYTE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Hashes of all words of a slice of texts; text i has words ``first[i]:first[i + 1]``."""

    hashes: np.ndarray
    first: np.ndarray
    starts: np.ndarray  # byte offsets in ``data``
    ends: np.ndarray
    data: np.ndarray  # the bytes of all texts
    texts: np.ndarray  # byte offsets of the texts in ``data``

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def _hashed(data: np.ndarray, texts: np.ndarray) -> Words:
    is_word = _WORD[data]
    edge = is_word.copy()
    edge[1:] &= ~is_word[:-1]
    inner = texts[(texts > 0) & (texts < len(data))]
    edge[inner] |= is_word[inner]  # a word ends with its text
    starts = np.flatnonzero(edge)
    letters = np.flatnonzero(is_word)
    if not len(starts):
        return Words(np.zeros(0, np.uint64), np.zeros(len(texts), np.int64), starts, starts, data, texts)
    head = np.searchsorted(letters, starts)
    length = np.diff(np.append(head, len(letters)))
    at = np.arange(len(letters)) - np.repeat(head, length)
    powers = np.cumprod(np.full(int(length.max()), _STEP), dtype=np.uint64)
    sums = np.add.reduceat(_BYTE[_LOWER[data[letters]]] * powers[at], head)
    return Words(mix64(sums + length.astype(np.uint64)), np.searchsorted(starts, texts), starts, starts + length, data, texts)


def words_of(column: pa.Array) -> Iterator[tuple[int, int, Words]]:
    """``(from, to, words)`` for slices of an Arrow string column; nulls have no words."""
    if not len(column):
        return
    data, offsets = _bytes_of(column)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + SLICE, side="right")) - 1)
        yield low, high, _hashed(data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low])
        low = high


def shingles_of(words: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, first)`` of the word n-grams of each text; a shorter text, not empty, is one."""
    h, n = words.hashes, words.count
    many = np.where(n >= size, n - size + 1, (n > 0).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(many)])
    start = np.repeat(words.first[:-1] - first[:-1], many) + np.arange(first[-1])
    width = np.repeat(np.minimum(n, size), many)
    out = np.zeros(len(start), np.uint64)
    for k in range(size):
        on = width > k
        part = out[on] if not on.all() else out
        part = mix64(part * _STEP + h[(start[on] if not on.all() else start) + k])
        if on.all():
            out = part
        else:
            out[on] = part
    return out, first


def counted(items: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct items of each text with their counts: ``(items, counts, first)``, items ascending."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((items, owner))
    items, owner = items[order], owner[order]
    new = np.ones(len(items), bool)
    new[1:] = (items[1:] != items[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return items[at], np.diff(np.append(at, len(items))), np.searchsorted(owner[at], np.arange(len(first)))


def code_points(words: Words, byte_offsets: np.ndarray, text: int) -> np.ndarray:
    """Byte offsets within text ``text`` (absolute in ``data``) as code point offsets."""
    lead = (words.data[words.texts[text]:words.texts[text + 1]] & 0xC0) != 0x80
    return np.concatenate([[0], np.cumsum(lead)])[byte_offsets - words.texts[text]]
