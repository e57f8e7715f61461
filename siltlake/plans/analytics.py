"""The analytics questions over customers, products and orders.

Inputs use the e-commerce column names: customers ``(customer_id, first_name, last_name,
city, state)``, products ``(product_id, name, category, price)`` and orders ``(order_id,
customer_id, product_id, quantity, total_amount, status, order_date)``; extra columns are
pruned. Joins follow a pre-aggregation on the join key wherever the question allows it, so
a key with many orders is summed up before it is shuffled. Top-k reports are one lazy plan each: a
subquery over the sort column finds the k-th value, and only rows that reach it meet the wide
tables. Join strategies are left to Spark, which knows the
sizes at run time. Ties are broken by further columns to make results definite.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltlake.functions.envelope import full_name, money_avg, money_sum, month_of

Expand = Callable[[DataFrame], DataFrame]


def status_summary(orders: DataFrame) -> DataFrame:
    """Order count and revenue by status, most orders first."""
    return (
        orders.groupBy("status")
        .agg(F.count("*").alias("order_count"), money_sum(F.col("total_amount")).alias("total_revenue"))
        .orderBy(F.desc("order_count"), "status")
    )


def status_by_revenue(orders: DataFrame) -> DataFrame:
    """The same, highest revenue first."""
    return (
        orders.groupBy("status")
        .agg(F.count("*").alias("order_count"), money_sum(F.col("total_amount")).alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "status")
    )


def status_averages(orders: DataFrame) -> DataFrame:
    """Count, revenue and average order value by status."""
    amount = F.col("total_amount")
    return orders.groupBy("status").agg(
        F.count("*").alias("order_count"), money_sum(amount).alias("total_revenue"),
        money_avg(amount).alias("avg_order_value"),
    )


def status_metrics(orders: DataFrame) -> DataFrame:
    """Count, revenue, average, first and last order by status."""
    amount = F.col("total_amount")
    return orders.groupBy("status").agg(
        F.count("*").alias("order_count"), money_sum(amount).alias("total_revenue"),
        money_avg(amount).alias("avg_order_value"),
        F.min("order_date").alias("first_order"), F.max("order_date").alias("last_order"),
    )


def _spend(orders: DataFrame) -> DataFrame:
    """Orders and amount per customer; sums stay unrounded until the end."""
    return orders.groupBy("customer_id").agg(
        F.count("order_id").alias("n"), F.sum("total_amount").alias("amount"),
        money_avg(F.col("total_amount")).alias("average"),
    )


def _top_spenders(customers: DataFrame, orders: DataFrame, k: int) -> DataFrame:
    """The ``k`` customers with the highest revenue, with ``n``, ``average`` and ``spent``."""
    spend = _spend(orders).withColumn("spent", F.round("amount", 2))

    return spend.join(customers, "customer_id").orderBy(F.desc("spent"), "customer_id").limit(k)


def top_customers(customers: DataFrame, orders: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` customers with the highest revenue."""
    return _top_spenders(customers, orders, k).select(
        "customer_id", "first_name", "last_name", "city",
        F.col("n").alias("order_count"), F.col("spent").alias("total_spent"),
    )


def top_customers_named(customers: DataFrame, orders: DataFrame, k: int = 10) -> DataFrame:
    """The same with the full name in one column."""
    return _top_spenders(customers, orders, k).select(
        full_name(F.col("first_name"), F.col("last_name")).alias("customer"), "city",
        F.col("n").alias("num_orders"), F.col("spent").alias("total_spent"),
    )


def top_customers_valued(customers: DataFrame, orders: DataFrame, k: int = 10) -> DataFrame:
    """The same with state and average order value."""
    return _top_spenders(customers, orders, k).select(
        "first_name", "last_name", "city", "state", F.col("n").alias("order_count"),
        F.col("spent").alias("total_spent"), F.col("average").alias("avg_order_value"),
    )


def customers_by_state(customers: DataFrame) -> DataFrame:
    return (
        customers.groupBy("state").agg(F.count("*").alias("customer_count"))
        .orderBy(F.desc("customer_count"), "state")
    )


def products_by_category(products: DataFrame) -> DataFrame:
    """Product count and average price, most products first."""
    return (
        products.groupBy("category")
        .agg(F.count("*").alias("product_count"), money_avg(F.col("price")).alias("avg_price"))
        .orderBy(F.desc("product_count"), "category")
    )


def category_prices(products: DataFrame) -> DataFrame:
    """Product count, average, lowest and highest price, dearest category first."""
    price = F.col("price")
    return (
        products.groupBy("category")
        .agg(
            F.count("*").alias("product_count"), money_avg(price).alias("avg_price"),
            F.min(price).alias("min_price"), F.max(price).alias("max_price"),
        )
        .orderBy(F.desc("avg_price"), "category")
    )


def revenue_by_category(products: DataFrame, orders: DataFrame) -> DataFrame:
    sold = orders.groupBy("product_id").agg(
        F.count("order_id").alias("n"), F.sum("total_amount").alias("amount")
    )
    return (
        products.join(sold, "product_id").groupBy("category")
        .agg(F.sum("n").alias("order_count"), money_sum(F.col("amount")).alias("revenue"))
        .orderBy(F.desc("revenue"), "category")
    )


def category_reach(products: DataFrame, orders: DataFrame) -> DataFrame:
    """Revenue and unique customers by category.

    Products and customers pair up too rarely for a pre-aggregation to pay, so orders meet
    their product first; then a row per category and customer makes counting customers
    counting rows.
    """
    return (
        orders.join(products, "product_id").groupBy("category", "customer_id")
        .agg(F.count("order_id").alias("n"), F.sum("total_amount").alias("amount"))
        .groupBy("category")
        .agg(
            F.count("customer_id").alias("unique_customers"), F.sum("n").alias("total_orders"),
            money_sum(F.col("amount")).alias("revenue"),
        )
        .orderBy(F.desc("revenue"), "category")
    )


def revenue_by_state(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Revenue and unique buyers by state; after the pre-aggregation a row is a buyer."""
    return (
        customers.join(_spend(orders), "customer_id").groupBy("state")
        .agg(
            F.count("customer_id").alias("customer_count"), F.sum("n").alias("order_count"),
            money_sum(F.col("amount")).alias("total_revenue"),
        )
        .orderBy(F.desc("total_revenue"), "state")
    )


def _reaches(rows: DataFrame, sort: str, k: int, *keys: tuple[str, DataFrame]) -> Column:
    """Whether a row's sort value is one of the ``k`` greatest among rows that meet all ``keys``; ties are.

    Only the sort and key columns are read for it. With fewer than ``k`` values every row does.
    """
    for key, table in keys:
        rows = rows.join(table.select(key), key, "left_semi")
    top = rows.select(sort).orderBy(F.desc(sort)).limit(k)
    least = top.agg(F.when(F.count(sort) == k, F.min(sort)).alias("least")).scalar()
    return least.isNull() | (F.col(sort) >= least)


def latest_orders(
    customers: DataFrame, products: DataFrame, orders: DataFrame, status: str, k: int = 20, expand: Expand | None = None
) -> DataFrame:
    """The ``k`` latest orders of a status with customer and product names.

    ``expand`` turns order rows into rows that have product and quantity, where ``orders``
    alone does not.
    """

    expand = expand or (lambda rows: rows)
    rows = orders.where(F.col("status") == status)
    keys = (("customer_id", customers), ("product_id", products))
    return (
        expand(rows.where(_reaches(expand(rows), "order_date", k, *keys)))
        .join(customers, "customer_id").join(products, "product_id")
        .select(
            full_name(F.col("first_name"), F.col("last_name")).alias("customer_name"),
            F.col("name").alias("product_name"), "quantity", "total_amount", "status", "order_date",
        )
        .orderBy(F.desc("order_date"), "customer_name", "product_name", "quantity", "total_amount")
        .limit(k)
    )


def largest_orders(
    customers: DataFrame, products: DataFrame, orders: DataFrame, k: int = 10, expand: Expand | None = None
) -> DataFrame:
    """The ``k`` largest orders with customer and product names; ``expand`` adds what
    ``orders`` alone does not have."""

    expand = expand or (lambda rows: rows)
    keys = (("customer_id", customers), ("product_id", products))
    return (
        expand(orders.where(_reaches(expand(orders), "total_amount", k, *keys)))
        .join(customers, "customer_id").join(products, "product_id")
        .select(
            full_name(F.col("first_name"), F.col("last_name")).alias("customer"),
            F.col("name").alias("product"), "total_amount",
        )
        .orderBy(F.desc("total_amount"), "customer", "product").limit(k)
    )


def product_popularity(products: DataFrame, orders: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` products with the highest revenue."""
    sold = orders.groupBy("product_id").agg(
        F.count("order_id").alias("n"), F.sum("quantity").alias("quantity"),
        F.round(F.sum("total_amount"), 2).alias("amount"),
    )

    return (
        sold.join(products, "product_id").orderBy(F.desc("amount"), "product_id").limit(k)
        .select(
            "category", "name", F.col("n").alias("times_ordered"),
            F.col("quantity").alias("total_quantity"), F.col("amount").alias("total_revenue"),
        )
    )


def orders_by_month(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy(month_of(F.col("order_date")).alias("order_month"))
        .agg(F.count("*").alias("order_count"), money_sum(F.col("total_amount")).alias("monthly_revenue"))
        .orderBy("order_month")
    )


def orders_by_month_status(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy(month_of(F.col("order_date")).alias("month"), "status")
        .agg(F.count("*").alias("order_count"), money_sum(F.col("total_amount")).alias("revenue"))
        .orderBy(F.desc("month"), "status")
    )


def orders_with_status(orders: DataFrame, status: str) -> DataFrame:
    """One status; on a table partitioned by it, one directory."""
    return orders.where(F.col("status") == status)


def products_of_category(products: DataFrame, category: str, k: int = 5) -> DataFrame:
    return products.where(F.col("category") == category).orderBy("product_id").limit(k)


def customers_of_state(customers: DataFrame, state: str, k: int = 10) -> DataFrame:
    return (
        customers.where(F.col("state") == state).orderBy("customer_id").limit(k)
        .select("first_name", "last_name", "city", "state")
    )
