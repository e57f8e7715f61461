"""The JSON envelope log messages travel in, and scalar helpers around it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The envelope's metadata fields, and the timestamp format with microseconds
# (to_json alone would cut them to milliseconds).
HEADER = ("_log_type", "_log_class", "_version")
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def envelope_schema(data: T.StructType) -> T.StructType:
    return T.StructType([*[T.StructField(h, T.StringType()) for h in HEADER], T.StructField("data", data)])


def envelope(log_type: str, log_class: str, version: str, data: Column) -> Column:
    """JSON text of one message; NULL fields of ``data`` are left out."""
    header = [F.lit(v).alias(h) for h, v in zip(HEADER, (log_type, log_class, version))]
    return F.to_json(
        F.struct(*header, data.alias("data")),
        {"timestampFormat": ISO_MICROS, "timestampNTZFormat": ISO_MICROS},
    )


def parse(value: Column, data: T.StructType) -> Column:
    """The envelope as a struct. Text that is no JSON gives a struct of NULLs, a field of
    the wrong type a NULL, and no text at all a NULL struct."""
    return F.from_json(value.cast("string"), envelope_schema(data))


def month_of(ts: Column) -> Column:
    """First instant of the month, without a detour through a session time zone."""
    return F.trunc(ts.cast("date"), "month").cast("timestamp_ntz")


def full_name(first: Column, last: Column) -> Column:
    """NULL if either part is."""
    return F.concat(first, F.lit(" "), last)


def money_sum(amount: Column) -> Column:
    return F.round(F.sum(amount), 2)


def money_avg(amount: Column) -> Column:
    """The average, rounded far below a cent so that the order of addition cannot show."""
    return F.round(F.avg(amount), 6)
