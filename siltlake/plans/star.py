"""The star schema seen as customers, products and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltlake.sources.tables import read_table


def customers(spark: SparkSession, base: str) -> DataFrame:
    """A customer's place is the nation: ``city`` and ``state`` are its name."""
    nation = read_table(spark, "nation", base)
    return (
        read_table(spark, "customer", base)
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("first_name"),
            F.col("c_mktsegment").alias("last_name"), F.col("n_name").alias("city"),
            F.col("n_name").alias("state"),
        )
    )


def products(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, "part", base).select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"),
        F.col("p_type").alias("category"), F.col("p_retailprice").alias("price"),
    )


def orders(spark: SparkSession, base: str) -> DataFrame:
    """Order headers: no product or quantity."""
    return read_table(spark, "orders", base).select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("total_amount"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("order_date"),
    )


def sales(spark: SparkSession, base: str) -> DataFrame:
    """Order lines without their header; a line counts as an order of one product."""
    return read_table(spark, "lineitem", base).select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("total_amount"),
    )


def order_lines(spark: SparkSession, base: str) -> DataFrame:
    """Order lines with customer, status and date of their header."""
    return sales(spark, base).join(orders(spark, base).drop("total_amount"), "order_id")
