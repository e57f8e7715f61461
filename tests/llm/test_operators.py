"""The corpus operators against SQL or brute force, and on rows that are out of the ordinary."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline

from oracle import compare, connect
from siltlake.llm import decontaminate, language, lengths, mixing, near_docs, neighbours, paragraphs, personal, secret_scan, toxicity
from siltlake.llm.common import read
from siltlake.llm.near_docs import dart_signatures
from siltlake.llm.queries import ORACLES, PATTERN, QUERIES, RANKS, WEIGHTS
from siltlake.llm.text import mix64, shingles_of, words_of

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long, copy string, `_row` string, score string"
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORDS.findall((text or "").translate(LOWER))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing column names."""
    long = " ".join(f"word{i}" for i in range(20_000))
    rows = [
        (1, None, None, None, None), (2, "", "en", "src0", 0), (None, "some text of a nameless document here", "en", "src1", 9),
        (3, "!!! ... ???", "en", "src0", 3), (4, long, "de", "src0", len(long)), (5, "token = \"abcdefgh\" Zażółć ", "pl", "src2", 5),
        (6, "the same text of more than five words", "en", "src9", 7), (6, "the same text of more than five words", "en", "src9", 7),
        (7, "the same text of more than five words", None, "src9", None), (8, "mail a@b.co or 10.0.0.1", "en", None, 1)]
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], DOC)


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    compare(QUERIES[name](spark, SF), connect(SF), ORACLES[name])


def test_word_hashes_are_those_of_words():
    texts = ["Ab c-d", None, "", "é9 X", "ab"]
    found = [w.hashes for _, _, w in words_of(pa.array(texts))][0]
    _, _, w = next(words_of(pa.array(texts)))
    assert w.count.tolist() == [len(words(t)) for t in texts]
    assert found[0] == found[-1] and len(set(found.tolist())) == 5
    assert np.diff(shingles_of(w)[1]).tolist() == [1, 0, 0, 1, 1]


def test_darts_agree_as_often_as_weights_do():
    a, b = {i: 1.0 + i % 3 for i in range(60)}, {i: 1.0 + i % 2 for i in range(20, 90)}
    items = mix64(np.array([*a, *b], np.uint64))
    sig = dart_signatures(items, np.array([*a.values(), *b.values()]), np.array([0, len(a), len(a) + len(b)]), 2000)
    true = sum(min(a[i], b[i]) for i in a if i in b) / sum(max(a.get(i, 0), b.get(i, 0)) for i in {*a, *b})
    assert abs((sig[0] == sig[1]).mean() - true) < 0.05


def test_near_documents_brute(spark):
    docs = {r["doc_id"]: r["text"] for r in read(spark, SF, "documents").collect()}
    bags = {}
    for d, t in docs.items():
        w = words(t)
        bags[d] = Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else None
    root = {d: d for d in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in docs:
        for b in docs:
            if a < b and bags[a] and bags[b]:
                both = sum((bags[a] & bags[b]).values())
                if both >= 0.8 * (sum(bags[a].values()) + sum(bags[b].values()) - both):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    got = {r["doc_id"]: r["class_id"] for r in QUERIES["op2_near_documents"](spark, SF).collect()}
    assert got == {d: find(d) for d in docs}


def test_near_documents_odd(odd, none):
    got = [(r["doc_id"], r["class_id"], r["keep"]) for r in near_docs.classes(odd).collect()]
    assert len(got) == 10 and (7, 6, False) in got and got.count((6, 6, True)) == 2 and (1, 1, True) in got and (2, 2, True) in got
    kept = near_docs.one_of_each(odd)
    assert kept.columns == odd.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 6, 8]
    assert near_docs.classes(none).count() == 0


def test_passages(spark, odd, none):
    passage = " ".join(f"Alpha{i} beta gamma{i} delta epsilon zeta{i} eta." for i in range(9))
    rows = [(1, f"Own start one two. {passage} Own end."), (2, f"Another opening sentence here. {passage}\nTail line."),
            (3, "Nothing that any other document says at all, in a line of its own.")]
    got = paragraphs.duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in got} == {1, 2} and {r["doc_id"] for r in got if r["removed"]} == {2}
    line = " ".join(f"w{i}" for i in range(80))
    near = line.replace("w40", "other")
    got = paragraphs.duplicates(spark.createDataFrame([(1, line), (2, f"{near}\nx"), (3, None)], "doc_id long, text string")).collect()
    assert [(r["doc_id"], r["start"], r["end"], r["removed"]) for r in sorted(got)] == [(1, 0, len(line), False), (2, 0, len(near), True)]
    assert len({r["class_id"] for r in got}) == 1
    assert paragraphs.duplicates(odd).where("n_words < 20").count() == 0 and paragraphs.duplicates(none).count() == 0


def test_passages_of_repeated_rows(spark):
    line = " ".join(f"w{i}" for i in range(80))
    short = "\n".join(" ".join(f"s{k}x{i}" for i in range(12)) for k in range(2))  # two lines that only make a passage together
    rows = [(1, line)] * 3 + [(None, short)] * 2 + [(3, "nothing that repeats in this line")]
    got = paragraphs.duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["start"], r["end"], r["removed"]) for r in got) == [
        (0, 0, len(short), False), (0, 0, len(short), True), (1, 0, len(line), False), (1, 0, len(line), True), (1, 0, len(line), True)]


def test_neighbours_brute(spark):
    rows = sorted((r["vec_id"], r["embedding"]) for r in read(spark, SF, "embeddings").collect())
    ids, v = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    got = {}
    for r in QUERIES["op3_neighbours"](spark, SF).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    hits = 0
    for q in ids[ids % 20 == 0]:
        s = v @ v[ids == q][0]
        want = [i for _, i in sorted((-x, i) for x, i in zip(s, ids) if i != q)][:20]
        hits += len(set(want) & {i for _, i in got[q]})
        assert [n for n, _ in sorted(got[q])] == list(range(1, 21))
    assert hits >= 0.9 * 20 * len(got)


def test_neighbours_of_unequal_lengths(spark):
    g = np.random.default_rng(3)
    plain, spread = g.normal(size=(3000, 3)), g.normal(size=(3000, 8)) * np.exp(g.normal(size=(3000, 1)))
    plain[-1] = 1e5  # one long vector makes all others look equally far
    for v in (plain, spread):
        rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
        got = {}
        for r in neighbours.nearest(rows, F.col("vec_id") % 20 == 0).collect():
            got.setdefault(r["query_id"], set()).add(r["vec_id"])
        for q in range(0, len(v), 20):
            s = v @ v[q]
            s[q] = -np.inf
            assert got[q] == set(np.argsort(-s)[:20].tolist())


def test_neighbours_odd(spark):
    rows = [(0, [1.0, 0.0], "a"), (1, [1.0, 0.0], "a"), (2, [0.5, 1.0], "a"), (3, [0.0, 0.0], "a"), (4, None, "a"), (5, [1.0, None], "a"),
            (6, [float("nan"), 1.0], "a"), (None, [1.0, 1.0], "a"), (1, [1.0, 0.0], "a"), (7, [float("inf"), 1.0], "a"), (8, [1.0], "a"), (9, [], "a")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    got = neighbours.nearest(df, F.col("vec_id") % 20 == 0, factor=1.0, shard_rows=2, block_rows=1).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == [(0, 1, 1, 1.0), (0, 2, 2, 0.5)]
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_neighbours_of_repeated_ids(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (0, [0.0, 1.0]), (1, [0.1, 0.2]), (1, [3.0, 4.0]), (2, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, F.col("vec_id") == 0, k=2, factor=1.0, shard_rows=2, block_rows=1).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == [
        (0, 1, 1, 3.0), (0, 1, 1, 4.0), (0, 2, 2, 1.0), (0, 2, 2, 2.0)]


def test_contamination_by_items_without_id(spark):
    text = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame([(1, text), (2, "the second text"), (3, "another one")], "doc_id long, text string")
    items = spark.createDataFrame([(None, text), (5, "second text")], "item_id long, text string")
    for size in (1_000_000, 1):
        got = decontaminate.judged(decontaminate.contaminated(docs, items, block_words=size)).collect()
        assert sorted((r["doc_id"], r["n_hit"], r["items"], r["contaminated"]) for r in got) == [
            (1, 20, [], True), (2, 2, ["5"], True), (3, 0, [], False)]
    assert [r["doc_id"] for r in decontaminate.clean_rows(docs, items).collect()] == [3]


def test_contamination_brute(spark, odd, none):
    docs, items = read(spark, SF, "documents"), read(spark, SF, "benchmark")
    pairs = [(str(r["item_id"]), r["text"]) for r in items.collect()]
    want = {r["doc_id"]: decontaminate.brute(r["text"], pairs) for r in docs.collect()}
    for size in (1_000_000, 200):  # one block and several
        got = decontaminate.judged(decontaminate.contaminated(docs, items, block_words=size)).collect()
        assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["items_sha256"]) for r in got} == want
    few = spark.createDataFrame([(1, "same text of"), (2, None), (3, "!"), (None, "x")], "item_id long, text string")
    got = {(r["doc_id"], r["n_hit"], r["contaminated"]) for r in decontaminate.judged(decontaminate.contaminated(odd, few)).collect()}
    assert (6, 3, True) in got and (1, 0, False) in got and len(got) == 9
    assert decontaminate.clean_rows(odd, few).columns == odd.columns and decontaminate.clean_rows(odd, few.limit(0)).count() == 10
    assert decontaminate.contaminated(none, few).count() == 0


def test_secrets_odd(odd, none):
    got = {r["doc_id"]: r for r in secret_scan.digest(secret_scan.scan(odd)).collect()}
    assert got[5]["spans"] == "assign:0:17" and got[1]["spans"] == "" and len(got) == 9
    clean = {r["doc_id"]: r["text"] for r in secret_scan.redacted(odd).collect()}
    assert clean[5].startswith("[SECRET]\" Za") and clean[1] is None and secret_scan.redacted(odd).count() == 10
    assert secret_scan.scan(none).count() == 0


def test_mixing_odd(odd, none):
    got = mixing.replicate(odd, WEIGHTS, seed=1)
    assert got.columns[-2:] == ["copy", "mix_order"] and mixing.replicate(none, WEIGHTS).count() == 0
    many = mixing.replicate(odd.where("doc_id = 4"), {"src0": 1.0}, scale=100.0).count()
    assert 60 < many < 140  # one draw of mean 100, in pieces
    assert mixing.replicate(odd, {}).count() >= 0


def test_lengths_brute(spark, odd, none):
    encode = lengths.encoder(RANKS, PATTERN).encode_ordinary
    own = sorted(len(encode(r["text"] or "")) for r in odd.collect())
    sums = lengths.suffix_sums(lengths.histogram(odd, RANKS, PATTERN))
    for r in sums.collect():
        n = r["length"]
        assert r["documents_from"] == sum(x >= n for x in own) and r["tokens_from"] == sum(x for x in own if x >= n)
        assert r["truncated_tokens"] == sum(min(x, n) for x in own) and r["documents"] == own.count(n)
    assert lengths.truncated_total(sums, 6).first()["tokens"] == sum(min(x, 6) for x in own)
    assert lengths.quantiles(sums, [0.5]).first()["length"] == own[4]
    assert lengths.suffix_sums(lengths.histogram(none, RANKS, PATTERN)).count() == 0
    assert QUERIES["op9_token_lengths"](spark, SF).agg(F.sum("documents")).first()[0] == 200


def test_language(spark, odd, none):
    got = QUERIES["op6_language"](spark, SF).join(read(spark, SF, "documents").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in got) >= 0.95 * len(got)
    model = language.fit(odd)
    seen = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(odd, model).collect()}
    assert seen[1] == seen[2] == seen[3] == ("und", 0.0) and seen[6][0] == "en"
    assert language.predict(none, model).count() == 0 and language.fit(none).languages == []
    assert {r["lang_pred"] for r in language.predict(odd, language.fit(none)).collect()} == {"und"}


def test_trigrams_do_not_depend_on_place():
    for text in ("a", "word", " a", "1 b c", "é"):
        alone, later = next(language.trigrams([text])), list(language.trigrams(["other", text]))[1]
        assert len(alone) and alone.tolist() == later.tolist()


def test_toxicity(spark, odd, none):
    rows = [(i, f"plain words number{i} " + ("awful" if i % 4 == 0 else "nice")) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    index = toxicity.fit(docs, labels.where("doc_id % 3 != 1"))
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, index).collect()}
    assert all((s >= 0.7) == (d % 4 == 0) for d, s in got.items())
    # The blocks find what all examples do.
    counts = [{int(i): int(n) for i, n in zip(np.random.default_rng(s).integers(0, 30, 4), (1, 2, 3, 4))} for s in range(300)]
    big = toxicity.Index(np.linspace(1, 3, 30), {}, 0.1).build([(i, c, i % 2, 1.0) for i, c in enumerate(counts)])
    for q in counts[:40]:
        _, cosine = big.nearest(q, 15)
        ids, w = big.vector(q)
        every = []
        for c in counts:
            ids2, w2 = big.vector(c)
            every.append(sum(x * y for i, x in zip(ids, w) for j, y in zip(ids2, w2) if i == j))
        assert abs(cosine[-1] - sorted(every)[-15]) < 1e-9
    seen = {r["doc_id"]: r for r in toxicity.score(odd, index).collect()}
    assert seen[1]["score"] == seen[2]["score"] == pytest.approx(index.prior) and toxicity.score(none, index).count() == 0
    assert toxicity.accepted(odd, toxicity.fit(odd, labels.limit(0)), 0.7).columns == odd.columns


def test_toxicity_learns_from_bounded_rows(spark):
    rows = [(i, f"plain words number{i} " + ("awful" if i % 4 == 0 else "nice")) for i in range(200)]
    kind = "doc_id long, text string"
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int")
    once = toxicity.fit(spark.createDataFrame(rows, kind), labels)
    repeated = toxicity.fit(spark.createDataFrame(rows + [rows[0]] * 300, kind), labels)
    assert repeated.members.sum() == once.members.sum() == 200 and repeated.votes.sum() == once.votes.sum() == 50
    many = toxicity.fit(spark.createDataFrame(rows + [(0, f"awful text {i}") for i in range(3000)], kind), labels, per_class=100)
    assert many.members.sum() < 500 and abs(many.votes.sum() - 3050) < 800


def test_personal(spark, odd, none):
    base = {r["doc_id"]: r for r in personal.digest(personal.scan(odd)).collect()}
    assert base[8]["spans"] == "email:5:11,ip:15:23" and base[1]["spans"] == "" and personal.scan(none).count() == 0
    rows = [(i, f"filler text customer reference u{i}@mail.org and more") for i in range(8)] + [(99, "customer reference QX-77812 stays"), (100, "room 77812a here")]
    got = {r["doc_id"]: r for r in personal.digest(personal.scan(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert got[99]["spans"] == "context:19:27" and got[100]["spans"] == "" and got[0]["n_email"] == 1
    assert personal.base_spans("@" * 50 + "1.2.3.4.5.6.7.8 " + "9" * 5000)[0][1:] == (1, 57)


def test_personal_reaches_what_only_discoveries_point_to(spark):
    texts = [f"customer reference u{i}@mail.org" for i in range(12)] + [f"customer reference QX-1000{i}" for i in range(9)]
    texts += [f"ticket QX-1000{i}" for i in range(9)] + ["ticket ZT-50005"]  # two hops: no seed follows "ticket"
    chain = ["alpha", "bravo", "delta", "gamma", "omega", "sigma"]
    texts += [f"ref alpha s{i}@mail.org" for i in range(3)]
    texts += [f"ref {w} CH-{k + d}000{i}" for k, w in enumerate(chain) for d in ((1,) if k == 0 else (0, 1)) for i in range(3)]
    texts += [f"lone XX-2000{i}" for i in range(5)]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r["n_context"] for r in personal.digest(personal.scan(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert {t for i, t in rows if got[i]} == {t for t in texts if "@" not in t and not t.startswith("lone")}


def test_personal_counts_in_one_pass(spark):
    texts = ["One two, one TWO three", None, "", "two three one two", "zwölf two"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    wanted = spark.createDataFrame([(p,) for p in ("two", "one two", "zwölf two", "absent", "three one")], "pattern string")
    got = personal.occurrences(docs, wanted.union(spark.range(250_000).select(F.concat(F.lit("x"), "id"))))
    assert {r["pattern"]: r["total"] for r in got.collect()} == {"two": 5, "one two": 3, "zwölf two": 1, "three one": 1}
    assert got._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    alone = personal.occurrences(docs, wanted.where("pattern = 'three one'"), flush=1)
    assert {r["pattern"]: r["total"] for r in alone.collect()} == {"three one": 1}


def test_pipeline(spark, tmp_path, odd):
    docs = read(spark, SF, "documents")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "mixing"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    index = toxicity.fit(docs, labels.where(~language.fold(F.col("doc_id"), 3, 1)))
    kept = corpus_pipeline.drop_toxic(spark, docs, SF)
    assert kept.columns == columns
    assert {r[0] for r in kept.select("doc_id").collect()} == {r["doc_id"] for r in toxicity.score(docs, index).collect() if r["score"] < 0.7}
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == [*columns, "copy", "mix_order"] and 100 < out.count() < 400
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, SF).count() >= 5 or stage is corpus_pipeline.mix_sources
        assert stage(spark, odd.limit(0), SF).count() == 0
