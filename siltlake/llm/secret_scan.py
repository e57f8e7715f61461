"""Secret scan with corpus-wide ownership frequency, with DataFrame functions only.

Texts are searched for assignments, access keys and hex runs, and for other long mixed tokens
as candidates. Every candidate value is then counted over the corpus by distinct owners and
repositories: a value that many owners have is an example copied around, one that a single
owner has looks live. Base spans are always reported, mixed tokens only when they look live.

Positions come from Spark's own functions: the gaps that ``split`` leaves and the matches that
``regexp_extract_all`` finds alternate, so their lengths add up to code point offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltlake.llm.common import row_key, saved, unused

#: The patterns of the base kinds, in the order in which spans are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # greedy runs of at least 24 are the runs that a plain + finds and keeps
MIXED = r"[A-Za-z0-9+/_=-]{20,}"

KINDS = ("assign", "access", "hex", "mixed")
SPAN = "array<struct<start:int,kind_no:int,end:int,value:string>>"


def _spans(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """Leftmost non-overlapping matches whose value has ``least`` characters; others are dropped."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.arrays_zip(
        matches.alias("m"), F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("v"),
        F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches)).alias("g"))
    start = lambda s, x: s["at"] + F.length(x["g"])
    found = F.aggregate(
        parts, F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out")),
        lambda s, x: F.struct(
            (start(s, x) + F.length(x["m"])).alias("at"),
            F.concat(s["out"], F.array(F.struct(
                start(s, x).alias("start"), F.lit(KINDS.index(kind)).alias("kind_no"),
                (start(s, x) + F.length(x["m"])).alias("end"), x["v"].alias("value")))).alias("out")),
        lambda s: s["out"])
    return F.when(F.regexp_like(text, F.lit(pattern)), F.filter(found, lambda x: F.length(x["value"]) >= least)).otherwise(
        F.array().cast(SPAN))


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source") -> DataFrame:
    """``(doc_id, row, owner, base, mixed)`` per document: base spans, and mixed tokens beside them.

    A mixed token has digits, capitals and small letters, and meets no base span.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    base = F.concat(
        _spans(F.col("body"), "assign", ASSIGN, 2, 6), _spans(F.col("body"), "access", ACCESS, 0, 20),
        _spans(F.col("body"), "hex", HEX, 0, 24))
    apart = lambda x: ~F.exists(F.col("base"), lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))
    mixed = F.filter(
        _spans(F.col("body"), "mixed", MIXED, 0, 20),
        lambda x: x["value"].rlike("[0-9]") & x["value"].rlike("[A-Z]") & x["value"].rlike("[a-z]") & apart(x))
    # Values leave the text as digests: nothing that follows carries a secret.
    hidden = lambda a: F.transform(a, lambda x: F.struct(
        x["start"].alias("start"), x["kind_no"].alias("kind_no"), x["end"].alias("end"), F.md5(x["value"]).alias("value")))
    return (
        docs.select(
            F.col(doc_id).alias("doc_id"), row_key(F.col(doc_id), F.col(text)).alias("row"),
            F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"), body.alias("body"))
        .withColumn("base", base).withColumn("mixed", mixed)
        .select("doc_id", "row", "owner", hidden(F.col("base")).alias("base"), hidden(F.col("mixed")).alias("mixed"))
    )


def ownership(found: DataFrame) -> DataFrame:
    """``(value, owners, repositories)`` of every candidate; a document is a repository of its owner.

    Three aggregates, each combined before its shuffle and on a wider key than the next, so a
    value that a third of all documents share is spread until only counts are left.
    """
    return (
        found.select("row", "owner", F.explode(F.concat("base", "mixed")).alias("s"))
        .groupBy(F.col("s.value").alias("value"), "owner", "row").agg(F.lit(1).alias("one"))
        .groupBy("value", "owner").agg(F.count("*").alias("n"))
        .groupBy("value").agg(F.count("*").alias("owners"), F.sum("n").alias("repositories"))
    )


def scan(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source", max_owners: int = 1,
) -> DataFrame:
    """One row per document: ``doc_id, row, base, added, n_live, n_example``.

    ``base`` and ``added`` are arrays of ``(start, kind_no, end, kind)`` in order; a value held by
    at most ``max_owners`` owners counts as live, any other as an example. ``added`` are the live
    mixed tokens. Null text counts as empty, a null owner is one more owner, and documents
    without a span have empty arrays; rows that repeat id and text get the same spans each.
    An empty table gives an empty one, and columns beyond the named ones are ignored.
    """
    found = saved(candidates(docs, doc_id, text, owner), "secrets")
    spans = found.select("row", F.explode(F.concat("base", "mixed")).alias("s"))
    judged = (
        spans.join(ownership(found), spans["s.value"] == F.col("value"))
        .select("row", F.col("s.start").alias("start"), F.col("s.kind_no").alias("kind_no"), F.col("s.end").alias("end"),
                (F.col("owners") <= max_owners).alias("live"))
        .groupBy("row").agg(F.collect_set(F.struct("start", "kind_no", "end", "live")).alias("judged"))
    )
    mixed_no = KINDS.index("mixed")
    named = lambda a: F.array_sort(F.transform(a, lambda x: F.struct(
        x["start"].alias("start"), x["kind_no"].alias("kind_no"), x["end"].alias("end"),
        F.element_at(F.array(*map(F.lit, KINDS)), x["kind_no"] + 1).alias("kind"))))
    all_judged = F.coalesce(F.col("judged"), F.array().cast("array<struct<start:int,kind_no:int,end:int,live:boolean>>"))
    return found.join(judged, "row", "left").select(
        "doc_id", "row", named(F.col("base")).alias("base"),
        named(F.filter(all_judged, lambda x: (x["kind_no"] == mixed_no) & x["live"])).alias("added"),
        F.size(F.filter(all_judged, lambda x: x["live"])).cast("long").alias("n_live"),
        F.size(F.filter(all_judged, lambda x: ~x["live"] & (x["kind_no"] != mixed_no))).cast("long").alias("n_example"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])))


def digest(scanned: DataFrame) -> DataFrame:
    """The scan as counts, a checksum of the base spans and one string of all spans."""
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return scanned.select(
        "doc_id", *[count(k) for k in KINDS[:3]], F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.array_sort(F.concat("base", "added"))).alias("spans"), "n_live", "n_example")


def redacted(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with ``mark`` in place of every base and added span, and ``n_chars`` of the new text.

    Spans that overlap become one mark. Documents without a span stay as they are, null texts
    too; all rows and columns are kept.
    """
    row, spans = unused(docs, "_row"), unused(docs, "_spans")
    hits = scan(docs).select(F.col("row").alias(row), F.array_sort(F.concat("base", "added")).alias(spans)).where(F.size(spans) > 0)
    hits = saved(hits.dropDuplicates([row]), "secrets")
    text = F.col("text")
    clean = F.aggregate(
        spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda s, x: F.struct(
            F.greatest(s["at"], x["end"]).alias("at"),
            F.when(x["start"] < s["at"], s["out"]).otherwise(
                F.concat(s["out"], F.substring(text, s["at"] + 1, x["start"] - s["at"]), F.lit(mark))).alias("out")),
        lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    found = F.col(spans).isNotNull()
    columns = {"text": F.when(found, clean).otherwise(text)}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(found, F.length(clean).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    keyed = docs.withColumn(row, row_key(F.col("doc_id"), text)).join(hits, row, "left")
    return keyed.select(*[columns.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
