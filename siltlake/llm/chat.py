r"""Chat formatting that is proven by reading it back, with DataFrame functions only.

The grammar of a formatted conversation is

    conversation = turn*        turn = "### " role ": " text "</turn>\n"

A deterministic parser cuts at every ``### ``, ends each piece at its first ``</turn>``, parts role
and text at the first ``: ``, and drops one backslash before any character. A turn is rendered as
it stands, parsed, and compared with its source; where the parser finds something else, the
control strings and backslashes in it are escaped. The rendered conversation is then parsed as a
whole, and the job fails unless that gives back all turns: what is returned has been read back.

Turns are rendered row by row; only finished pieces meet in their conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

START, AFTER_ROLE, END = "### ", ": ", "</turn>"
CLOSE = f"{END}\n"
LOSS_ROLE = "assistant"


def escape(value: Column, *controls: str) -> Column:
    r"""A backslash before every backslash and inside every control string.

    ``### `` becomes ``#\## ``, ``</turn>`` ``<\/turn>`` and ``: `` ``:\ ``, so that no control string
    is left; ``unescape`` gives the value back.
    """
    out = F.replace(value, F.lit("\\"), F.lit("\\\\"))
    for control in controls:
        out = F.replace(out, F.lit(control), F.lit(f"{control[0]}\\{control[1:]}"))
    return out


def unescape(value: Column) -> Column:
    return F.regexp_replace(value, r"(?s)\\(.)", "$1")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit(AFTER_ROLE), text, F.lit(CLOSE))


def parse(formatted: Column) -> Column:
    """``array<struct<role, text>>`` of a formatted string, by the grammar alone."""
    pieces = F.filter(F.split(formatted, START, -1), lambda _, i: i > 0)  # nothing stands before the first mark
    bodies = F.transform(pieces, lambda p: F.substring_index(p, END, 1))
    role = lambda b: F.substring_index(b, AFTER_ROLE, 1)
    text = lambda b: F.substring(b, F.length(role(b)) + len(AFTER_ROLE) + 1, F.length(b))
    return F.transform(bodies, lambda b: F.struct(unescape(role(b)).alias("role"), unescape(text(b)).alias("text")))


READ = "struct<formatted:string,turns:array<struct<role:string,text:string>>>"


def _with(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is named."""
    return F.element_at(F.transform(F.array(value), use), 1)


def turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv_id, turn, role, text, role_out, text_out, escaped)``: each row rendered and read back.

    A null role or text is empty. ``escaped`` tells whether the plain turn did not survive.
    """
    source = rows.select(
        F.col(f"`{conv}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    itself = F.array(F.struct("role", "text"))
    kept = source.withColumn("escaped", parse(render(F.col("role"), F.col("text"))) != itself)
    return kept.select(
        "*", F.when(F.col("escaped"), escape(F.col("role"), START, END, AFTER_ROLE)).otherwise(F.col("role")).alias("role_out"),
        F.when(F.col("escaped"), escape(F.col("text"), START, END)).otherwise(F.col("text")).alias("text_out"))


def formatted(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id, formatted, n_turns, n_escaped, loss_mask, turns``.

    ``turns`` are the turns as parsed from ``formatted``; the job fails if they are not those of
    the source. ``loss_mask`` holds the spans ``(start, end)`` of ``formatted`` in code points, end
    exclusive, that are texts of the assistant, empty ones too.

    Turns go in the order of ``turn``, null first; rows that share one go by role and text, and
    rows repeated in full stay, as turns of their own. Null conversation ids are one conversation.
    A null role or text is empty, an empty table gives an empty one, and other columns are
    ignored. A conversation is one value, so its turns meet in one row; of a conversation that
    holds much of the table, the pieces are sorted with spill and joined once.
    """
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    upto = Window.partitionBy("conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chars = F.length(render(F.col("role_out"), F.col("text_out"))).cast("long")
    placed = turns(rows, conv, turn, role, text).withColumns({
        # Names the place of a turn, so that pieces need no sort by their texts once they meet.
        "at": F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)),
        "stop": F.sum(chars).over(upto)})
    met = placed.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("at", "stop", "role", "text", "role_out", "text_out", "escaped"))).alias("t"))
    source = F.transform("t", lambda t: F.struct(t["role"], t["text"]))
    whole = F.array_join(F.transform("t", lambda t: render(t["role_out"], t["text_out"])), "")
    differs = F.raise_error(F.lit("a conversation does not read back as it was")).cast(READ)
    # Inside a lambda a value is a variable: the text is put together once and parsed once.
    read = _with(whole, lambda text: _with(parse(text), lambda back: F.when(
        back == source, F.struct(text.alias("formatted"), back.alias("turns"))).otherwise(differs)))
    spans = F.transform(F.filter("t", lambda t: t["role"] == LOSS_ROLE), lambda t: F.struct(
        (t["stop"] - len(CLOSE) - F.length(t["text_out"])).alias("start"), (t["stop"] - len(CLOSE)).alias("end")))
    out = met.select("conv_id", "t", read.alias("read"))
    return out.select(
        "conv_id", "read.formatted", F.size("t").cast("long").alias("n_turns"),
        F.size(F.filter("t", lambda t: t["escaped"])).cast("long").alias("n_escaped"), spans.alias("loss_mask"), "read.turns")


def digest(conversations: DataFrame) -> DataFrame:
    """The formatted conversations as counts and checksums of what was read back from them."""
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == LOSS_ROLE), lambda t: t["text"]), "")
    every = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return conversations.select(
        "conv_id", "n_turns", F.sha2(every, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"), "n_escaped")
