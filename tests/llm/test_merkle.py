"""Merkle manifests: against SQL and against a tree built in Python, for several arities and odd rows."""

import hashlib

import pytest
from pyspark.sql import functions as F

from oracle import compare, connect
from siltlake.llm import merkle
from siltlake.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, source string, lang string, n_chars long, text string, hash string, idx long, `row` string, tree int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 7, "y", 1) for r in rows], DOC)


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(hashes, arity):
    """The root, and each leaf's runs as (own slot, digests of the run)."""
    steps, at = [[] for _ in hashes], list(range(len(hashes)))
    while len(hashes) > 1:
        runs = [hashes[i:i + arity] for i in range(0, len(hashes), arity)]
        for k, i in enumerate(at):
            steps[k].append((i % arity, runs[i // arity]))
        hashes, at = [sha(*r) for r in runs], [i // arity for i in at]
    return hashes[0], steps


def brute(rows, arity, longer=()):
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append(r)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    for lang in langs:
        by_lang[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    subs = {lang: tree([leaf(r) for r in by_lang[lang]], arity) for lang in langs}
    root, tops = tree([subs[lang][0] for lang in langs], arity)
    out = []
    for lang, top in zip(langs, tops):
        for r, steps in zip(by_lang[lang], subs[lang][1]):
            path = steps + top
            own = leaf((*r[:3], r[3] + 1, r[4])) if r[0] in longer and r[3] is not None else leaf(r)
            for slot, run in path:
                own = sha(*run[:slot], own, *run[slot + 1:])
            proof = [h for slot, run in path for i, h in enumerate(run) if i != slot]
            out.append((r[0], leaf(r), subs[lang][0], root, tuple(proof), own, own == root))
    return sorted(out, key=str)


def got(df):
    return sorted(((r["doc_id"], r["leaf"], r["subroot"], r["root"], tuple(r["proof"]), r["folded_root"], r["verified"])
                   for r in df.collect()), key=str)


def test_matches_sql(spark):
    compare(QUERIES["op11_manifest"](spark, SF), connect(SF), ORACLES["op11_manifest"])


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_brute(spark, arity):
    rows = [(i, "s", ["en", "de", None, "é"][i % 7 % 4], i, f"text {i}") for i in range(61)] + [(99, None, "fr", None, None)]
    longer = [r[0] for r in rows if r[0] % 5 == 0] + [99]
    more = F.when(F.col("doc_id").isin(longer), F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    found = got(merkle.manifest(frame(spark, rows), arity=arity, changed={"n_chars": more}))
    assert found == brute(rows, arity, longer)
    assert {r[0] for r in found if not r[-1]} == {i for i in longer if i != 99}


def test_more_levels_than_a_segment(spark, monkeypatch):
    monkeypatch.setattr(merkle, "SEGMENT", 2)
    rows = [(i, "s", "en" if i < 77 else f"l{i % 6}", i, "x") for i in range(110)]
    assert got(merkle.manifest(frame(spark, rows))) == brute(rows, 2)


def test_odd_rows(spark):
    long = "wörd " * 100_000
    rows = [
        (None, None, None, None, None), (None, "s", "en", 1, ""), (1, "-", "en", 0, "-"), (1, "-", "en", 0, "-"), (1, "-", "en", 0, "other"),
        (2, "", "", 0, long), (3, "1:2", "en", None, "3:4"), (-5, "s", "EN", 5, "a")]
    assert got(merkle.manifest(frame(spark, rows))) == brute(rows, 2)


def test_a_row_that_repeats_over_a_third_of_the_table(spark):
    rows = [(5, "s", "en", 1, "same")] * 40 + [(i, "s", "en", 1, "t") for i in range(60)]
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    try:
        assert got(merkle.manifest(frame(spark, rows).repartition(8))) == brute(rows, 2)
        placed = merkle.numbered(frame(spark, rows).select("lang", "doc_id").withColumn("row", F.monotonically_increasing_id()), "lang", ["doc_id"])
        assert sorted(r["idx"] for r in placed.collect()) == list(range(100))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_empty_table_and_one_row(spark):
    rows = [(1, "s", "en", 1, "x")]
    assert merkle.manifest(frame(spark, rows).limit(0)).collect() == []
    assert got(merkle.manifest(frame(spark, rows))) == brute(rows, 2)


def test_arity_of_one_is_refused(spark):
    with pytest.raises(ValueError):
        merkle.manifest(frame(spark, [(1, "s", "en", 1, "x")]), arity=1)
