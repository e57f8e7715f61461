"""Language profiles against bundling every trigram by itself, over the given table."""

import numpy as np
from pyspark.sql import functions as F

from siltlake.llm import language
from siltlake.llm.common import read

SF = "/root/testdata/sf0.001"
DIM, SEED = 64, 3


def letter(code):
    return np.random.Generator(np.random.Philox(key=[SEED, code])).integers(0, 2, DIM) * 2.0 - 1


def bundle(text):
    """The sum over all trigrams with a letter in the middle; a run of other characters is one gap."""
    codes = [0]
    for c in text or "":
        code = (ord(c.lower()) if len(c.lower()) == 1 else ord(c)) if c.isalpha() else 0
        if code or codes[-1]:
            codes.append(code)
    codes, total = [*codes, 0], np.zeros(DIM)
    for a, b, c in zip(codes, codes[1:], codes[2:]):
        if b:
            total += np.roll(letter(a), 2) * np.roll(letter(b), 1) * letter(c)
    return total


def test_predictions_are_those_of_plain_bundles(spark):
    docs = read(spark, SF, "documents").where(F.length("text") < 600)
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()]
    rows += [(-1, None, "en"), (-2, "", "de"), (-3, "ß Ａ İ a-b  c", None), (-4, "12 !", "fr"), (-5, "x", "en"), (-5, "x", "en")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learn = {}
    for _, text, lang in rows:
        if text is not None and lang is not None:
            learn[lang] = learn.get(lang, 0) + bundle(text)
    names = sorted(learn)
    unit = np.array([learn[n] / (np.linalg.norm(learn[n]) or 1) for n in names])
    got = {(r["doc_id"], r["text"]): r for r in language.predict(table, language.fit(table, dim=DIM, seed=SEED)).collect()}
    for doc, text, _ in rows:
        own = bundle(text)
        row = got[doc, text]
        if not own.any():
            assert (row["lang_pred"], row["score"]) == ("und", 0.0)
            continue
        cosine = unit @ own / np.linalg.norm(own)
        best = cosine.max()
        assert abs(row["score"] - max(0.0, best)) < 1e-5
        assert cosine[names.index(row["lang_pred"])] > best - 1e-5
