"""Periodic runs against a scan of all periods, on texts of few words and on the given table."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from siltlake.llm import runs
from siltlake.llm.common import read
from siltlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, runs string, n_words int, `_searched` string"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1, "y") for i, t in enumerate(texts)], DOC)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(w, least=6, power=4):
    """All maximal stretches of every period, without those that have a smaller one."""
    out, n = {}, len(w)
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, power * q):
                out.setdefault((i, length), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in out.items())


def collapsed(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def check(spark, texts):
    got = sorted(runs.find(frame(spark, texts)).collect(), key=lambda r: r["doc_id"])
    assert len(got) == len(texts)
    for text, row in zip(texts, got):
        w = words(text)
        want = brute(w)
        assert [tuple(r) for r in row["runs"]] == want, text
        assert row["n_words"] == len(w) and row["collapsed"] == collapsed(w, want)
        assert row["text"] == text and row["_searched"] == "y"


def test_few_words(spark):
    dice = random.Random(1)
    texts = []
    for i in range(3000):
        kinds = "abc"[:dice.randrange(1, 4)]
        text = dice.choices(kinds, k=dice.randrange(40))
        for _ in range(dice.randrange(3)):
            at = dice.randrange(len(text) + 1)
            text[at:at] = dice.choices(kinds + "xyz", k=dice.randrange(1, 6)) * dice.randrange(1, 9)
        texts.append(dice.choice([" ", "\n", "\t\x0b \r\x0c"]).join(text))
    check(spark, texts)


def test_runs_within_runs_and_side_by_side(spark):
    a = ("a a a a a a b " * 5 + "c ") * 6
    check(spark, [a, "x " * 50 + "y " * 50, "x y " * 9 + "x " * 9, ("p q r " * 4 + "s ") * 4 + "p q r", "a b c d " * 3 + "a b c", "a " * 5, "a " * 6])


def test_odd_texts(spark):
    check(spark, [None, "", " \n", "é é é é é é", "é é " * 6, "\x1c \x1c \x1c \x1c \x1c \x1c", "  a a a a a a  ", "same text same", "same text same"])
    assert runs.find(frame(spark, ["a"]).limit(0)).collect() == []


def test_very_long_texts(spark):
    dice = random.Random(2)
    prose = [f"w{min(dice.randrange(4000), dice.randrange(4000))}" for _ in range(400_000)]
    prose[1000:1000] = ["u", "v", "w"] * 2000
    prose[300_000:300_000] = [f"z{i}" for i in range(5000)] * 4
    got = {r["doc_id"]: r for r in runs.find(frame(spark, [" ".join(prose), "one " * 1_000_000, "a b"])).collect()}
    assert {tuple(r) for r in got[0]["runs"]} == {(1000, 6000, 3), (300_000, 20_000, 5000)}
    assert [tuple(r) for r in got[1]["runs"]] == [(0, 1_000_000, 1)] and got[1]["collapsed"] == "one"
    assert got[2]["runs"] == []


@pytest.mark.parametrize("kinds", [1, 2, 3])
def test_lag_scan_of_long_segments(kinds):
    dice = random.Random(kinds)
    w = [dice.randrange(kinds) for _ in range(300)]
    w[100:100] = w[10:37] * 5
    assert runs.lag_scan(np.array(w)) == brute(w)


def test_splitting_leaves_prose_empty():
    w = np.array([i % 97 for i in range(300)] + [5] * 6 + list(range(200, 230)))
    at = runs.split(w, np.zeros(len(w), np.int64))
    assert set(range(300, 306)) <= set(at.tolist())
    assert not len(runs.split(np.arange(50) % 17, np.zeros(50, np.int64)))


def test_slices_cover_every_text(monkeypatch):
    monkeypatch.setattr(runs, "SLICE", 10)
    texts = pa.array(["a" * 4, None, "b" * 30, "", "c" * 9, "d"])
    assert [x for low, high in runs._slices(texts) for x in range(low, high)] == list(range(6))


def planted(doc_id, text):
    h, w = zlib.crc32(str(doc_id).encode()), words(text)
    if h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]


def test_query_brute(spark):
    """The registered query over its whole table, by the wording of its contract."""
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r["doc_id"]: r for r in QUERIES["op12_runs"](spark, SF).collect()}
    docs = read(spark, SF, "documents").collect()
    assert len(got) == len(docs)
    with_runs = 0
    for d in docs:
        w = planted(d["doc_id"], d["text"])
        found = brute(w)
        row = got[d["doc_id"]]
        best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
        assert (row["n_runs"], row["start"], row["length"], row["period"]) == (len(found), *best)
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if found else None)
        assert row["runs_sha256"] == sha("".join(f"{s},{n},{q}\n" for s, n, q in found))
        assert row["collapsed_sha256"] == sha(collapsed(w, found))
        with_runs += bool(found)
    assert with_runs > 5


def test_digest_of_rows_without_text(spark):
    empty = hashlib.sha256(b"").hexdigest()
    rows = spark.createDataFrame([(None, None), (10, ""), (10, "")], "doc_id long, text string")
    for r in runs.digest(runs.find(runs.planted(rows))).collect():
        assert tuple(r)[1:] == (0, None, None, None, None, empty, empty)


def test_greatest_exponent_wins_and_ties_go_to_the_first(spark):
    row = runs.digest(runs.find(frame(spark, ["a b " * 4 + "z " + "c d " * 4 + "y " + "e " * 6]))).first()
    assert (row["n_runs"], row["start"], row["length"], row["period"], row["exponent_milli"]) == (3, 18, 6, 1, 6000)
    row = runs.digest(runs.find(frame(spark, ["a b " * 4 + "z " + "c d " * 4]))).first()
    assert (row["n_runs"], row["start"], row["exponent_milli"]) == (2, 0, 4000)
