"""Personal data by bootstrapped contextual extraction.

Seeds are e-mail and IP addresses, card and phone numbers found by their form. The one or two
words before them are patterns. A pattern is trusted by the share of its occurrences, in the
whole corpus and before any word at all, that precede a known identifier; what trusted patterns
precede becomes known in turn, and so on over the graph of patterns and values until nothing
new is known. Identifier-like tokens that end up known are reported beside the seeds.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltlake.llm.common import Saved, row_key, saved

KINDS = ("email", "ip", "card", "phone", "context")
#: A pattern needs this share of known identifiers, and this many different ones.
TRUST, SUPPORT = 0.5, 3
#: Bits of the filter that rules out most unwanted patterns, and patterns that a task counts before it hands them on.
BITS, FLUSH = 1 << 22, 200_000

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_TOKEN = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789@._+#-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
# A start inside a run of digits never matches where the run's own start does not.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@][A-Za-z0-9@._+#-]*+")
_WORD = re.compile(r"[^\W\d_]+")
#: Code points before an identifier in which its pattern's words are looked for.
_BEFORE = 60


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the seeds; linear in the text whatever it holds."""
    out, done, last = [], 0, 0
    at = text.find("@")
    while at >= 0:
        low = max(done, last)
        start = low + len(text[low:at].rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, 0, domain.end()))
            done = domain.end()
        last = at + 1
        at = text.find("@", max(last, done))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def tokens(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Identifier-like tokens beside ``taken``: five characters or more with three digits or an at sign."""
    out, done, k = [], 0, 0
    ends = sorted((s, e) for s, _, e in taken)
    for m in _MARK.finditer(text):
        if m.start() < done:
            continue
        start = done + len(text[done:m.start()].rstrip(_TOKEN))
        done = m.end()
        body = text[start:done]
        cut = len(body) - len(body.lstrip("._+#-"))
        body = body.strip("._+#-")
        start, end = start + cut, start + cut + len(body)
        if len(body) < 5 or ("@" not in body and sum(c.isdigit() for c in body) < 3):
            continue
        while k < len(ends) and ends[k][1] <= start:
            k += 1
        if any(s < end and start < e for s, e in ends[k:k + 4]):
            continue
        out.append((start, end))
    return out


def patterns(text: str, start: int) -> list[str]:
    """The one and the two words before a place."""
    words = _WORD.findall(text[max(0, start - _BEFORE):start].lower())[-2:]
    return [words[-1], " ".join(words)] if len(words) == 2 else words


FOUND = "array<struct<start:int,kind:int,end:int,value:string,patterns:array<string>>>"


def extracted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, row, found)`` per document: seeds, and tokens as kind 4, with hashed values and patterns."""
    kind = pa.list_(pa.struct([
        ("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("value", pa.string()), ("patterns", pa.list_(pa.string()))]))

    def find(batches):
        for batch in batches:
            out = []
            for value in batch.column(2):
                body = value.as_py() or ""
                seeds = base_spans(body)
                spans = seeds + [(s, 4, e) for s, e in tokens(body, seeds)]
                out.append([{
                    "start": s, "kind": k, "end": e, "value": hashlib.md5(body[s:e].lower().encode()).hexdigest(),
                    "patterns": patterns(body, s)} for s, k, e in spans])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, kind)], names=["doc_id", "row", "found"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), row_key(F.col(doc_id), F.col(text)).alias("row"), F.col(text).alias("text"))
    return rows.mapInArrow(find, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, row string, found {FOUND}")


def occurrences(docs: DataFrame, wanted: DataFrame, text: str = "text", flush: int = FLUSH) -> DataFrame:
    """``(pattern, total)``: how often each wanted pattern's words stand in the corpus, before anything.

    One pass over the documents, however many patterns are wanted. Tasks count what passes a
    filter of ``BITS`` bits, which drops no wanted pattern; a join drops the others that pass.
    """
    # A pair is looked at when its last word passes.
    slots = wanted.select(F.explode(F.array("pattern", F.substring_index("pattern", " ", -1))).alias("p")).select(
        F.pmod(F.crc32("p"), F.lit(BITS)).alias("slot"))
    bits = np.zeros(BITS // 32, "<u4")
    for r in slots.groupBy(F.expr("slot div 32").alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(slot % 32 as int)))").alias("on")).collect():
        bits[r["at"]] = r["on"]  # BITS / 32 rows at most
    shared = docs.sparkSession.sparkContext.broadcast(bits.tobytes())

    def count(batches):
        known, total, seen = shared.value, Counter(), {}

        def passes(pattern: str) -> bool:
            slot = zlib.crc32(pattern.encode()) % BITS
            return bool(known[slot >> 3] >> (slot & 7) & 1)

        def counted() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["pattern", "total"])

        for batch in batches:
            for value in batch.column(0):
                words = _WORD.findall((value.as_py() or "").lower())
                if len(seen) > flush:
                    seen.clear()
                for word, n in Counter(words).items():
                    if word not in seen:
                        seen[word] = passes(word)
                    if seen[word]:
                        total[word] += n
                for pair, n in Counter(f"{a} {b}" for a, b in zip(words, words[1:]) if seen[b]).items():  # noqa: B905
                    if passes(pair):
                        total[pair] += n
                if len(total) > flush:
                    yield counted()
                    total.clear()
        yield counted()

    every = docs.select(text).mapInArrow(count, "pattern string, total long").groupBy("pattern").agg(F.sum("total").alias("total"))
    return every.join(wanted.select("pattern"), "pattern", "left_semi")


def bootstrap(edges: DataFrame, totals: DataFrame, trust: float = TRUST, support: int = SUPPORT) -> DataFrame:
    """``value`` of what trusted patterns discover, from ``edges(pattern, value, seed, n)``.

    What is known only grows, so a round that leaves its number unchanged is the last.
    """
    edges = Saved(edges.join(totals, "pattern"), "personal")
    known = saved(edges.df.where("seed").select("value").distinct(), "personal")
    seeds, size = known, known.count()
    while True:
        # The share of a pattern's places that hold something known; hot patterns are summed first.
        trusted = saved(
            edges.df.join(known, "value").groupBy("pattern").agg(
                F.sum("n").alias("hits"), F.count("*").alias("values"), F.max("total").alias("total"))
            .where((F.col("values") >= support) & (F.col("hits") >= trust * F.col("total"))).select("pattern"), "personal")
        more = edges.df.where("not seed").join(trusted, "pattern", "left_semi").select("value")
        known = saved(seeds.union(more).distinct(), "personal")
        before, size = size, known.count()
        if size == before:
            return known.join(seeds, "value", "left_anti")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, base, added``, arrays of ``(start, kind, end)`` in order.

    ``base`` are the seeds, ``added`` the discovered identifiers, by all their occurrences. Null
    text counts as empty; documents without a span have empty arrays; rows that repeat id and text
    get the same spans; an empty table gives an empty one; other columns are ignored. Values only
    travel as digests.
    """
    found = saved(extracted(docs, doc_id, text), "personal")
    one = found.select("row", F.explode("found").alias("f"))
    edges = saved(
        one.select(F.explode("f.patterns").alias("pattern"), F.col("f.value").alias("value"), (F.col("f.kind") < 4).alias("seed"))
        .groupBy("pattern", "value").agg(F.max("seed").alias("seed"), F.count("*").alias("n")), "personal")
    # Fewer values can never be trusted; a pattern without a seed may be, by values that others discover.
    wanted = edges.groupBy("pattern").agg(F.count("*").alias("values")).where(F.col("values") >= SUPPORT)
    totals = saved(occurrences(docs, wanted.select("pattern"), text), "personal")
    new = bootstrap(edges, totals)
    hits = saved(one.where("f.kind = 4").select("row", F.col("f.value").alias("value"), F.col("f.start").alias("start"), F.col("f.end").alias("end")), "personal")
    added = hits.join(new, "value", "left_semi").groupBy("row").agg(
        F.array_sort(F.collect_set(F.struct("start", F.lit(4).alias("kind"), "end"))).alias("added"))
    bare = lambda a: F.transform(a, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))
    return found.join(added, "row", "left").select(
        "doc_id", bare(F.filter("found", lambda x: x["kind"] < 4)).alias("base"),
        F.coalesce("added", F.array().cast("array<struct<start:int,kind:int,end:int>>")).alias("added"))


def listed(spans: Column) -> Column:
    name = lambda x: F.element_at(F.array(*map(F.lit, KINDS)), x["kind"] + 1)
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", name(x), x["start"], x["end"])))


def digest(scanned: DataFrame) -> DataFrame:
    """The scan as counts, a checksum of the base spans and one string of all spans."""
    count = lambda i: F.size(F.filter("base", lambda x: x["kind"] == i)).cast("long")
    return scanned.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:4])], F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.array_sort(F.concat("base", "added"))).alias("spans"), F.size("added").cast("long").alias("n_context"))
