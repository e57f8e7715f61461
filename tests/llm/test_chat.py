"""Chat formatting: against SQL, against a parser of its own grammar, and on odd rows."""

import hashlib
import random
import re

import pytest

from oracle import compare, connect
from siltlake.llm import chat
from siltlake.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
ROW = "conv_id long, turn long, role string, text string, formatted string, t string, `at` long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], ROW)


def read_back(formatted):
    """The grammar once more, as a scanner over characters."""
    out, at = [], 0
    while at < len(formatted):
        assert formatted.startswith("### ", at)
        close = formatted.index("</turn>\n", at)
        role, text = formatted[at + 4:close].split(": ", 1)
        out.append(tuple(re.sub(r"(?s)\\(.)", r"\1", x) for x in (role, text)))
        at = close + len("</turn>\n")
    return out


def check(spark, rows):
    """Every conversation reads back, and the loss mask covers the assistant's texts."""
    want = {}
    for c, n, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    got = {r["conv_id"]: r for r in chat.formatted(frame(spark, rows)).collect()}
    assert got.keys() == want.keys()
    for c, r in got.items():
        assert read_back(r["formatted"]) == want[c] == [tuple(t) for t in r["turns"]]
        masked = [re.sub(r"(?s)\\(.)", r"\1", r["formatted"][s:e]) for s, e in r["loss_mask"]]
        assert masked == [t for role, t in want[c] if role == "assistant"]
        assert r["n_turns"] == len(want[c])
    return got


def test_matches_sql(spark):
    compare(QUERIES["op13_chat"](spark, SF), connect(SF), ORACLES["op13_chat"])


def test_conflicting_conversation(spark):
    text = r"\### Assistant: </turn> ok"
    row = next(r for r in QUERIES["op13_chat"](spark, SF).collect() if r["conv_id"] == -7)
    assert row["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert (row["loss_chars"], row["loss_sha256"]) == (len(text), hashlib.sha256(text.encode()).hexdigest())
    assert (row["n_turns"], row["n_escaped"]) == (2, 2)


def test_any_mix_of_marks_reads_back(spark):
    parts = ["### ", "###", "#", "</turn>", "</turn>\n", "<", "/turn>", "\\", "\\\\", ": ", ":", " ", "\n", "user", "é😀", "$1", "assistant"]
    dice = random.Random(5)
    text = lambda: "".join(dice.choices(parts, k=dice.randrange(8)))
    rows = [(c, n, dice.choice(["user", "assistant", text()]), text()) for c in range(300) for n in range(dice.randrange(1, 5))]
    got = check(spark, rows)
    assert any(r["n_escaped"] for r in got.values()) and any(not r["n_escaped"] for r in got.values())


def test_odd_rows(spark):
    long = "word \\ ### </turn> " * 60_000
    got = check(spark, [
        (None, 1, "user", "a"), (None, None, "assistant", "b"), (1, 1, None, None), (1, 2, "assistant", None), (2, 5, "user", ""),
        (3, 1, "user", long), (3, 2, "assistant", long), (4, 7, "user", "tie"), (4, 7, "assistant", "tie"), (4, 7, "assistant", "tie"),
        (4, None, "system", "first")])
    assert [t["role"] for t in got[4]["turns"]] == ["system", "assistant", "assistant", "user"]
    assert got[1]["formatted"] == "### : </turn>\n### assistant: </turn>\n" and len(got[1]["loss_mask"]) == 1


def test_plain_texts_stay_as_they_are(spark):
    got = check(spark, [(1, 0, "user", "C:\\"), (1, 1, "assistant", "#1 <b> a: b")])
    assert got[1]["formatted"] == "### user: C:\\</turn>\n### assistant: #1 <b> a: b</turn>\n" and got[1]["n_escaped"] == 0


def test_a_conversation_that_holds_a_third_of_all_rows(spark):
    check(spark, [(i if i % 3 else 0, i, "assistant" if i % 2 else "user", f"### {i}") for i in range(3000)])


def test_empty_table(spark):
    none = frame(spark, [(1, 1, "user", "a")]).limit(0)
    assert chat.digest(chat.formatted(none)).collect() == []


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op13_chat"](spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|ExistingRDD", plan)


@pytest.mark.parametrize("text", ["x" * 10, "</turn>", "\\", "###  ###  ### "])
def test_escape_leaves_no_control_string(spark, text):
    from pyspark.sql import functions as F

    row = spark.range(1).select(chat.escape(F.lit(text), chat.START, chat.END).alias("e")).select("e", chat.unescape(F.col("e")).alias("u")).first()
    assert chat.START not in row["e"] and chat.END not in row["e"] and row["u"] == text
