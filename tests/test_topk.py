"""Top-k reports are one lazy plan: building one runs no job, and ties and gaps are as joined."""

import pytest
from pyspark.sql import functions as F

from conftest import SF
from siltlake.plans import analytics, star


def test_building_runs_no_job(spark):
    customers, products = star.customers(spark, SF), star.products(spark, SF)
    heads, sales = star.orders(spark, SF), star.sales(spark, SF)
    spark.sparkContext.setJobGroup("building", "top-k")
    expand = lambda rows: rows.join(sales.drop("total_amount"), "order_id")
    analytics.top_customers(customers, heads)
    analytics.top_customers_named(customers, heads)
    analytics.top_customers_valued(customers, heads)
    analytics.product_popularity(products, sales)
    analytics.latest_orders(customers, products, heads, "F", expand=expand)
    analytics.largest_orders(customers, products, heads, expand=expand)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("case", ["distinct", "tied", "dangling", "few", "nulls"])
def test_top_customers(spark, case):
    orders = spark.range(300).select(
        F.col("id").alias("order_id"), (F.col("id") % 70).alias("customer_id"), F.col("id").cast("double").alias("total_amount"))
    if case == "tied":
        orders = orders.withColumn("total_amount", F.lit(1.0))
    if case == "few":
        orders = orders.where("order_id < 4")
    if case == "nulls":
        orders = orders.withColumn("total_amount", F.when(F.col("order_id") % 2 == 0, F.col("total_amount")))
    known = 60 if case == "dangling" else 70
    customers = spark.range(known).select(F.col("id").alias("customer_id"), *[F.lit(c).alias(c) for c in ("first_name", "last_name", "city", "state")])
    sums = {}
    for r in orders.collect():
        if r["customer_id"] < known:
            sums.setdefault(r["customer_id"], []).append(r["total_amount"])
    total = {c: (sum(x for x in v if x is not None) if any(x is not None for x in v) else None) for c, v in sums.items()}
    want = sorted(total.items(), key=lambda x: (x[1] is None, -(x[1] or 0), x[0]))[:10]
    got = analytics.top_customers(customers, orders).collect()
    assert [(r["customer_id"], r["total_spent"]) for r in got] == want
