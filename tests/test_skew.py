"""A key that holds a third of all rows: split by the join, added up before shuffles."""

import pytest
from pyspark.sql import functions as F

from siltlake.plans import analytics

CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def hot(spark):
    """Customers, products and orders; a third of the orders name product 1 and customer 1."""
    before = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    key = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 1000 + 1)
    orders = spark.range(0, 120000, 1, 8).select(
        F.col("id").alias("order_id"), key.alias("customer_id"), key.alias("product_id"), F.lit(1).alias("quantity"),
        (F.col("id") % 100).cast("double").alias("total_amount"),
    )
    products = spark.range(1, 1001).select(F.col("id").alias("product_id"), (F.col("id") % 4).cast("string").alias("category"))
    customers = spark.range(1, 1001).select(F.col("id").alias("customer_id"), (F.col("id") % 5).cast("string").alias("state"))
    yield customers, products, orders
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_join_splits_a_hot_product(hot):
    _, products, orders = hot
    rows, plan = run(analytics.category_reach(products, orders))
    assert "SortMergeJoin(skew=true)" in plan
    assert sum(r.total_orders for r in rows) == 120000
    assert {r.category: r.unique_customers for r in rows} == {"0": 250, "1": 250, "2": 250, "3": 250}


def test_hot_customer_is_added_up_before_the_join(hot):
    customers, _, orders = hot
    rows, plan = run(analytics.revenue_by_state(customers, orders))
    assert sum(r.order_count for r in rows) == 120000 and sum(r.customer_count for r in rows) == 1000
    # One row per task and customer is shuffled, so there is no skew left to split.
    assert "skew=true" not in plan and plan.rindex("partial_sum(total_amount") > plan.rindex("SortMergeJoin")
