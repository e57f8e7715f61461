"""Components against union-find, on chains, stars and shared neighbours; the bitmap before joins."""

import random

import pytest
from pyspark.sql import functions as F

from siltlake.llm.common import components, may_be_in


def brute(links):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


@pytest.mark.parametrize("links", [
    [], [(3, 1), (3, 2)], [(i, i + 1) for i in range(30)], [(9, i) for i in range(9)],
    [tuple(random.Random(i).sample(range(60), 2)) for i in range(40)]])
def test_components(spark, links):
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in got} == brute(links)
    assert len(got) == len({r["node"] for r in got})


def test_components_ignore_loops_and_nulls(spark):
    assert components(spark.createDataFrame([(1, 1), (None, 2), (5, 4), (4, 5)], "a long, b long")).count() == 2


@pytest.mark.parametrize("most", [1 << 28, 1 << 15])
def test_bitmap_misses_nothing(spark, most):
    rows = spark.range(40_000).select("id", F.xxhash64("id").alias("h"), F.lit(1).alias("flag_chunk"))
    wanted = rows.where("id % 8 = 0").select("h")
    got = may_be_in(rows, F.col("h"), wanted, "flag", most)
    assert got.columns == [*rows.columns, "flag"]
    right, other = got.agg(F.count_if((F.col("id") % 8 == 0) & F.col("flag")), F.count_if((F.col("id") % 8 != 0) & F.col("flag"))).first()
    assert right == 5000 and other < 35_000 * (0.09 if most > 1 << 15 else 0.2)
    assert may_be_in(rows, F.col("h"), wanted.limit(0), "flag").where("flag").count() == 0
