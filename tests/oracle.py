"""Compare a Spark result with DuckDB's: names, row count and values in any order."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, dict):
        return sorted(v.items())
    return repr(v)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([names[i] for i in order]), sorted([tuple(str(cell(r[i])) for i in order) for r in data])


def compare(spark_df, con, sql: str) -> None:
    got = rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    want = rows([d[0] for d in cur.description], cur.fetchall())
    assert got[0] == want[0], f"columns {got[0]} != {want[0]}"
    assert len(got[1]) == len(want[1]), f"{len(got[1])} rows != {len(want[1])}"
    diff = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    assert not diff, f"{len(diff)} rows differ, first {diff[0]}"
