"""Generators, sinks, conformance, quality and plan shapes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF
from siltlake.operators import quality
from siltlake.plans import analytics, star
from siltlake.sinks import parquet as sinks
from siltlake.sources import generate as gen
from siltlake.sources.tables import conform, read_csv, split_corrupt, violations


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    """The generated tables, loaded as the analytics read them."""
    folder = tmp_path_factory.mktemp("shop")
    customers = sinks.write_table(gen.gen_customers(spark, 1000), str(folder / "customers"))
    products = sinks.write_table(gen.gen_products(spark, 100), str(folder / "products"))
    orders = sinks.write_table(
        gen.gen_orders(spark, 5000, customers, products), str(folder / "orders"), partition_by=["status"]
    )
    return customers, products, orders


def test_generated_rows(spark, shop):
    customers, products, orders = shop
    assert (customers.count(), products.count(), orders.count()) == (1000, 100, 5000)
    for df, key in ((customers, "customer_id"), (products, "product_id"), (orders, "order_id")):
        assert df.agg(F.count_distinct(key), F.min(key), F.max(key)).first() == (df.count(), 1, df.count())
    assert customers.groupBy("city").agg(F.count_distinct("state").alias("n")).where("n > 1").count() == 0
    assert customers.where(
        F.col("email") != F.concat(F.lower("first_name"), F.lit("."), F.lower("last_name"), "customer_id", F.lit("@example.com"))
    ).count() == 0
    assert orders.join(customers, "customer_id", "left_anti").count() == 0
    joined = orders.join(products, "product_id")
    assert joined.where(F.round(F.col("price") * F.col("quantity"), 2) != F.col("total_amount")).count() == 0
    low, high, first, last = orders.agg(
        F.min("quantity"), F.max("quantity"), F.min("order_date"), F.max("order_date")
    ).first()
    assert (low, high) == (1, 5)
    assert first >= dt.datetime(2023, 1, 1) and last <= dt.datetime(2024, 11, 24)
    assert {r.status for r in orders.select("status").distinct().collect()} == set(gen.STATUSES)
    assert products.where(~F.col("price").between(9.99, 999.99)).count() == 0


def test_draws_are_spread_evenly(spark):
    counts = [r["count"] for r in gen.gen_customers(spark, 20000).groupBy("city").count().collect()]
    assert len(counts) == 10 and sum((c - 2000) ** 2 / 2000 for c in counts) < 30


def test_partitioning_does_not_change_the_rows(spark):
    ids = spark.range(1, 501)
    a = gen.customers_for(ids.repartition(1), 7).orderBy("customer_id").collect()
    b = gen.customers_for(ids.repartition(6), 7).orderBy("customer_id").collect()
    assert a == b and a != gen.customers_for(ids, 8).orderBy("customer_id").collect()


def test_orders_need_dense_keys(spark):
    customers = spark.createDataFrame([(1,), (5,)], "customer_id long")
    with pytest.raises(ValueError, match="dense"):
        gen.gen_orders(spark, 10, customers, gen.gen_products(spark, 5))


def test_every_question_runs_on_the_generated_shop(shop):
    c, p, o = shop
    n = {
        analytics.status_summary(o): 4, analytics.status_by_revenue(o): 4, analytics.status_averages(o): 4,
        analytics.status_metrics(o): 4, analytics.top_customers(c, o): 10, analytics.top_customers_named(c, o): 10,
        analytics.top_customers_valued(c, o): 10, analytics.customers_by_state(c): 6, analytics.products_by_category(p): 8,
        analytics.category_prices(p): 8, analytics.revenue_by_category(p, o): 8, analytics.category_reach(p, o): 8,
        analytics.revenue_by_state(c, o): 6, analytics.latest_orders(c, p, o, "delivered"): 20,
        analytics.largest_orders(c, p, o): 10, analytics.product_popularity(p, o): 20, analytics.orders_by_month(o): 23,
        analytics.orders_by_month_status(o): 92, analytics.products_of_category(p, "Books"): 5,
        analytics.customers_of_state(c, "TX"): 10,
    }
    for df, rows in n.items():
        assert df.count() == rows


def test_status_filter_prunes_partitions(shop):
    plan = plan_of(analytics.orders_with_status(shop[2], "delivered"))
    assert "status" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_hidden_day_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "days")
    sinks.write_by_day(spark.read.parquet(f"{SF}/events.parquet"), path, "ts")
    plan = plan_of(sinks.read_between(spark, path, "ts", "2024-01-03", "2024-01-04"))
    assert "_day" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_plans(spark):
    customers, orders = star.customers(spark, SF), star.orders(spark, SF)
    assert "TakeOrderedAndProject" in plan_of(sinks.preview(customers, ["customer_id"]))
    # Orders are added up before they meet the customers: the plan prints joins first.
    plan = plan_of(analytics.revenue_by_state(customers, orders))
    assert plan.rindex("partial_sum(total_amount") > plan.rindex("Join")
    pending = orders.where("status = 'P'").select("order_id")
    assert "EqualTo(o_orderstatus,P)" in plan_of(pending) and "o_totalprice" not in plan_of(pending)


def test_partitioned_write_splits_a_hot_value(spark, tmp_path):
    # Incompressible rows, 90 % of them in one partition.
    rows = spark.range(0, 200000, 1, 8).select(
        F.when(F.col("id") % 10 > 0, "hot").otherwise("cold").alias("p"), F.sha2(F.col("id").cast("string"), 256).alias("x")
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        sinks.write_table(rows, str(tmp_path / "t"), partition_by=["p"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t" / "p=hot").glob("*.parquet"))) > 3
    assert len(list((tmp_path / "t" / "p=cold").glob("*.parquet"))) < 8


def test_sorted_write_orders_rows_in_files(spark, tmp_path):
    df = spark.range(0, 1000, 1, 4).select((1000 - F.col("id")).alias("k"), (F.col("id") % 2).alias("p"))
    sinks.write_table(df, str(tmp_path / "t"), partition_by=["p"], sort_by=["k"])
    files = list((tmp_path / "t").rglob("*.parquet"))
    for f in files:
        keys = [r.k for r in spark.read.parquet(str(f)).coalesce(1).collect()]
        assert keys == sorted(keys)


def test_partition_values_keep_their_type(spark, tmp_path):
    df = spark.createDataFrame([(1, "007"), (2, None)], "id long, code string")
    back = sinks.write_table(df, str(tmp_path / "t"), partition_by=["code"])
    assert sorted(back.collect(), key=lambda r: r.id) == df.collect()


def test_conform(spark):
    schema = T.StructType([T.StructField("b", T.IntegerType(), False), T.StructField("a", T.StringType())])
    df = spark.createDataFrame([("1", 2, "x"), ("3", None, "y")], "a string, b long, c string")
    assert conform(df.where("b IS NOT NULL"), schema).collect() == [(2, "1")]
    with pytest.raises(Exception, match="NULL in non-null column b"):
        conform(df, schema).collect()
    with pytest.raises(ValueError, match="missing"):
        conform(df.drop("b"), schema)
    counted = {r.column: (r.nulls, r.misfits) for r in violations(df.withColumn("b", F.col("c")), schema).collect()}
    assert counted == {"b": (0, 2), "a": (0, 0)}


def test_reconcile_counts_copies(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k int, v string")
    b = spark.createDataFrame([(1, None), (3, "y")], "k int, v string")
    found = {(r.k, r.side, r.copies) for r in quality.reconcile(a, b).collect()}
    assert found == {(1, "left", 1), (2, "left", 1), (3, "right", 1)}
    assert quality.reconcile(a, a).count() == 0


def test_quality_rules(spark):
    df = spark.createDataFrame([(1, 5), (1, None), (2, 50), (None, 1)], "k int, v int")
    target = spark.createDataFrame([(1,)], "k int")
    assert [tuple(r) for r in quality.check(df, [("v small", F.col("v") < 10), ("k known", F.col("k").isNotNull())]).collect()] == [
        ("v small", 2), ("k known", 1),
    ]
    assert quality.check_unique(df, "u", ["k"]).first().failed_rows == 1
    assert quality.check_reference(df, "r", "k", target, "k").first().failed_rows == 1


def test_profile_modes_agree_on_small_tables(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "a")], "k int, v string")

    exact, sketch = (sorted(quality.profile(df, "t", e).collect(), key=lambda r: r["column"]) for e in (True, False))
    assert exact == sketch
    assert [tuple(r)[3:] for r in exact] == [(3, 0, 2), (3, 1, 1)]


def test_csv_dead_letters(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("1,a\nx,b\n3,\n")
    good, bad = split_corrupt(read_csv(spark, str(path), T.StructType().add("k", "integer").add("v", "string")), ["v"])
    assert [tuple(r) for r in good.collect()] == [(1, "a")]
    assert {tuple(r) for r in bad.collect()} == {("x,b", "malformed"), ('{"k":3}', "missing v")}


def test_values_that_a_cast_would_change_are_refused(spark, tmp_path):
    df = spark.sql("SELECT 3.7D AS x UNION ALL SELECT 4D")
    schema = T.StructType([T.StructField("x", T.IntegerType())])
    assert [r.misfits for r in violations(df, schema).collect()] == [1]
    with pytest.raises(Exception, match="value of x changes"):
        conform(df, schema).collect()
    assert conform(df.where("x = 4"), schema).first().x == 4
    with pytest.raises(Exception, match="empty text in partition column"):
        sinks.write_table(spark.sql("SELECT 1 AS a, '' AS b"), str(tmp_path / "t"), partition_by=["b"])


def test_dimension_ids_must_be_distinct(spark):
    twice = spark.sql("SELECT explode(array(1L, 1L, 3L)) AS product_id, 2D AS price")
    with pytest.raises(ValueError, match="dense"):
        gen.gen_orders(spark, 10, gen.gen_customers(spark, 5), twice)
