"""Near duplicates in one large group of edits: classes against all pairs, bounds against all links."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siltlake.llm import near_docs, near, paragraphs


def edits(count, words, most, seed):
    """Texts made from one by replacing up to ``most`` of its words, and one that has nothing in common."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    out = []
    for _ in range(count):
        text = list(base)
        for at in rng.sample(range(words), rng.randint(0, most)):
            text[at] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(text))
    return sorted({*out, " ".join(f"z{i}" for i in range(words))})


def brute(texts, similarity):
    """The least index that each text is linked to, over all pairs of 0.8 or more, and the links."""
    counts = near.shingle_counts(pa.array(texts))
    root, links = list(range(len(texts))), []

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(counts):
        for j in range(i):
            if similarity(a, counts[j]) >= 0.8 - 1e-12:
                links.append((j, i))
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [find(i) for i in range(len(texts))], links


@pytest.mark.parametrize("seed, words, most", [(1, 120, 8), (2, 60, 3)])
def test_classes_of_a_large_group(spark, seed, words, most):
    texts = edits(260, words, most, seed)
    want, _ = brute(texts, near.weighted_jaccard)
    assert 5 < len(set(want)) < 200
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in near_docs.classes(docs).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_paragraph_classes_of_a_large_group(spark):
    texts = edits(200, 120, 8, 3)
    want, _ = brute(texts, near.jaccard)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in paragraphs.duplicates(docs).collect():
        got.setdefault(r["class_id"], set()).add(r["doc_id"])
    groups = {}
    for i, c in enumerate(want):
        groups.setdefault(c, set()).add(i)
    assert sorted(map(sorted, got.values())) == sorted(sorted(g) for g in groups.values() if len(g) > 1)


@pytest.mark.parametrize("weighted", [True, False])
def test_bounds_lose_no_link(spark, weighted):
    """Links between classes survive the bound; texts of one class only, and unlike ones, do not."""
    texts = edits(150, 80, 5, 4) + ["echo echo echo echo echo echo echo echo tail"]
    _, links = brute(texts, near.weighted_jaccard if weighted else near.jaccard)
    rows = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "id long, class long, text string")
    found = near.reach(rows.select("id", "class"), rows.select("id", "text"), weighted, 0.8, 5, "bound")
    got = {r["id"]: (r["weight"], r["common"]) for r in found.df.collect()}
    assert links and all(i in got and j in got for i, j in links)
    assert all(1.8 * min(got[i][1], got[j][1]) >= 0.8 * (got[i][0] + got[j][0]) - 1e-6 for i, j in links)
    assert len(texts) - 1 not in got and len(got) < len(texts)
    same = near.reach(rows.select("id", F.lit(0).cast("long").alias("class")), rows.select("id", "text"), weighted, 0.8, 5, "bound")
    assert same.df.count() == 0
    none = near.reach(rows.select("id", "class").limit(0), rows.select("id", "text"), weighted, 0.8, 5, "bound")
    assert none.df.count() == 0


def shuffled(plan):
    """Bytes that the exchanges of an executed plan held."""
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        return shuffled(plan.executedPlan())
    if "QueryStage" in name:
        return shuffled(plan.plan())
    kids = plan.children()
    return (plan.metrics().apply("dataSize").value() if name == "Exchange" else 0) + sum(shuffled(kids.apply(i)) for i in range(kids.size()))


def test_texts_that_stay_are_not_shuffled(spark):
    texts = [" ".join(f"w{i}x{j}" for j in range(400)) for i in range(300)]
    rows = [*enumerate(texts), (300, texts[7]), (7, texts[7]), (None, texts[8]), (301, None), (302, "...")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")  # as if the sides were too large
    try:
        kept = near_docs.one_of_each(docs)
        got = kept.collect()
        assert shuffled(kept._jdf.queryExecution().executedPlan()) < 0.2 * sum(len(t or "") for _, t in rows)
    finally:
        spark.conf.set(limit, before)
    assert sorted((r["doc_id"], r["text"] or "") for r in got) == sorted([*enumerate(texts), (301, ""), (302, "...")])
