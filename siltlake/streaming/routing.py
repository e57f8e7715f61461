"""Messages to rows: typed fields, the table each message belongs to, and why it may not."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltlake.functions.envelope import parse
from siltlake.streaming.config import Config, required_of, schema_of, table_of, topic_of

#: Where a message goes that no table takes, and one whose table is switched off for now.
DEAD_LETTERS, PARKED = "dead_letters", "parked"


def decode(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Message bytes to the typed fields of ``data``, one row per message."""
    return df.select(parse(F.col("value"), schema).alias("e")).select("e.data.*")


def log_type_of(value: Column) -> Column:
    """The message's log type; only the header is materialised."""
    return F.from_json(value.cast("string"), "_log_type string")["_log_type"]


def _missing(e: Column, cfg: Config) -> Column:
    """What a parsed message of this type lacks: its data or the first required field."""
    return F.coalesce(
        F.when(e["data"].isNull(), "missing data"),
        *[F.when(e["data"][n].isNull(), F.lit(f"missing {n}")) for n in required_of(cfg)],
        F.lit(None).cast("string"),
    )


def complete(cfg: Config) -> Column:
    """Whether a message is of the config's type and lacks nothing."""
    mine = log_type_of(F.col("value")) == cfg["log_type"]
    return mine & F.exists(F.array(parse(F.col("value"), schema_of(cfg))), lambda e: _missing(e, cfg).isNull())


# A predicate on the fields of a parsed message would be pushed below the parse, which then
# runs once per field. Inside a lambda the parsed message is a variable: it is computed once.


def route_one(df: DataFrame, cfg: Config, stamped: bool = False) -> DataFrame:
    """The complete messages of one log type, as rows of its table.

    ``stamped`` adds ``_ingestion_timestamp`` and ``_ingestion_date``, fixed per micro-batch.
    """
    parsed = F.array(parse(F.col("value"), schema_of(cfg)))
    rows = (
        df.where(log_type_of(F.col("value")) == cfg["log_type"])
        .select(F.inline(F.filter(parsed, lambda e: _missing(e, cfg).isNull())))
        .select("data.*")
    )
    if stamped:
        rows = rows.withColumns(
            {"_ingestion_timestamp": F.current_timestamp(), "_ingestion_date": F.current_date()}
        )
    return rows


def route(df: DataFrame, cfgs: Iterable[Config]) -> dict[str, DataFrame]:
    """The rows of each table from the messages of a shared topic."""
    return {table_of(c): route_one(df, c) for c in cfgs}


def dead_letters(df: DataFrame, cfgs: Sequence[Config], parked: Iterable[str] = ()) -> DataFrame:
    """Messages of a topic that no table takes: ``(value, reason, topic)``.

    Together with ``route`` this is a partition of the input: every message goes to exactly
    one place. Those of the ``parked`` types, whose configs are disabled, wait in the topic:
    once enabled, a config reads it from the start.
    """
    text = F.col("value").cast("string")

    def reason(log_type: Column) -> Column:
        out = F.when(text.isNull() | (text == ""), "empty").when(log_type.isNull(), "no envelope")
        for c in cfgs:
            # Only messages of this type are parsed under its schema.
            parsed = F.array(parse(F.col("value"), schema_of(c)))
            lacks = F.element_at(F.transform(parsed, lambda e: _missing(e, c)), 1)
            out = out.when(log_type == c["log_type"], lacks)
        for name in parked:
            out = out.when(log_type == name, F.lit(None).cast("string"))
        return out.otherwise(F.concat(F.lit("unknown type "), log_type))

    letter = F.transform(
        F.array(log_type_of(F.col("value"))), lambda t: F.struct(text.alias("value"), reason(t).alias("reason"))
    )
    return (
        df.select(F.inline(F.filter(letter, lambda r: r["reason"].isNotNull())))
        .withColumn("topic", F.lit(topic_of(cfgs[0])))
    )


#: What a topic without a running config is parsed under.
NO_FIELDS = [(T.StructType().add("_", "string"), [])]

# --- all tables of a topic in one pass ----------------------------------------------------


def merged_schemas(cfgs: Sequence[Config]) -> list[tuple[T.StructType, list[Config]]]:
    """Schemas that hold the fields of several configs, with the configs of each.

    A config joins the first schema that gives none of its fields another type or spelling;
    configs that agree on what they share, which is the rule, have one schema for all.
    """
    out: list[tuple[dict[str, T.StructField], list[Config]]] = []
    for cfg in cfgs:
        own = {f.name.lower(): f for f in schema_of(cfg).fields}
        for fields, members in out:
            if all((fields[n].name, fields[n].dataType) == (f.name, f.dataType) for n, f in own.items() if n in fields):
                fields.update(own)
                members.append(cfg)
                break
        else:
            out.append((own, [cfg]))
    return [(T.StructType(list(fields.values())), members) for fields, members in out]


def destination(cfg: Config) -> str:
    return f"log_{cfg['log_type']}"


def fan_out(df: DataFrame, cfgs: Sequence[Config], parked: Iterable[str] = ()) -> DataFrame:
    """Every message of a topic once, with its destination: ``(_to, value, reason, log_type, e0, e1, ...)``.

    ``_to`` names a config's log type, ``dead_letters`` or ``parked``; ``e0`` and so on hold the
    fields under each merged schema, ``value`` only what no table takes. A message is parsed once
    under the first merged schema, and once more only if its type belongs to another one. The
    outcome is that of ``route`` and ``dead_letters``.
    """
    groups = merged_schemas(cfgs) or NO_FIELDS
    text = F.col("value").cast("string")
    parked = list(parked)

    def placed(parsed: Sequence[Column]) -> Column:
        log_type = parsed[0]["_log_type"]
        reason = F.when(text.isNull() | (text == ""), "empty").when(log_type.isNull(), "no envelope")
        table = F.lit(None).cast("string")
        for (_, members), e in zip(groups, parsed):
            for c in members:
                reason = reason.when(log_type == c["log_type"], _missing(e, c))
                table = F.when(log_type == c["log_type"], destination(c)).otherwise(table)
        if parked:
            reason = reason.when(log_type.isin(*parked), F.lit(None).cast("string"))
            table = F.when(log_type.isin(*parked), PARKED).otherwise(table)
        reason = reason.otherwise(F.concat(F.lit("unknown type "), log_type))
        taken = reason.isNull() & (table != PARKED)
        return F.struct(
            F.when(reason.isNull(), table).otherwise(DEAD_LETTERS).alias("_to"),
            F.when(taken, F.lit(None).cast("string")).otherwise(text).alias("value"), reason.alias("reason"),
            log_type.alias("log_type"),
            *[F.when(taken, e["data"]).alias(f"e{i}") for i, e in enumerate(parsed)])

    def among(first: Column) -> Column:
        # A later schema is only tried on messages of its own types.
        later = [
            F.when(first["_log_type"].isin(*[c["log_type"] for c in members]), parse(F.col("value"), schema))
            for schema, members in groups[1:]]
        return _bound(later, lambda rest: placed([first, *rest]))

    # Inside a lambda the parsed message is a variable: it is computed once, however often it is used.
    return df.select(F.inline(F.transform(F.array(parse(F.col("value"), groups[0][0])), among)))


def _bound(values: Sequence[Column], use) -> Column:
    """``use(values)`` with each value computed once."""
    if not values:
        return use([])
    return F.element_at(F.transform(F.array(values[0]), lambda v: _bound(values[1:], lambda rest: use([v, *rest]))), 1)


def rows_of(routed: DataFrame, cfg: Config, cfgs: Sequence[Config]) -> DataFrame:
    """The rows of one config's table from ``fan_out`` over ``cfgs``."""
    at = next(i for i, (_, members) in enumerate(merged_schemas(cfgs)) if cfg in members)
    mine = routed.where(F.col("_to") == destination(cfg))
    return mine.select(*[F.col(f"e{at}.`{n}`").alias(n) for n in schema_of(cfg).names])


def schema_of_routed(cfgs: Sequence[Config]) -> T.StructType:
    """The columns of ``fan_out``, for reading them back."""
    out = T.StructType([T.StructField(n, T.StringType()) for n in ("_to", "value", "reason", "log_type")])
    for i, (schema, _) in enumerate(merged_schemas(cfgs) or NO_FIELDS):
        out = out.add(f"e{i}", schema)
    return out
