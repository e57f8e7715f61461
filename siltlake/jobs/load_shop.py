"""Generate the e-commerce tables, load them and print a report.

    spark-submit -m siltlake.jobs.load_shop --out /lake/shop [--versioned] [--orders 5000]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from siltlake.operators import changelog, dml
from siltlake.plans import analytics
from siltlake.session import build_session
from siltlake.sinks.parquet import preview, write_table
from siltlake.sources.generate import gen_customers, gen_orders, gen_products

# Table, key and partitioning, in the order of their references.
TABLES = {"customers": ("customer_id", ()), "products": ("product_id", ()), "orders": ("order_id", ("status",))}


def load(
    spark: SparkSession, out: str, customers: int = 1000, products: int = 100, orders: int = 5000, seed: int = 42,
    versioned: bool = False,
) -> dict[str, DataFrame]:
    """Write the three tables below ``out``, as plain or as versioned tables, and scan them."""

    def store(name: str, rows: DataFrame) -> DataFrame:
        key, partition_by = TABLES[name]
        if not versioned:
            return write_table(rows, f"{out}/{name}", partition_by=partition_by)
        dml.create_or_replace(rows, f"{out}/{name}", [key], partition_by)
        return changelog.read_version(spark, f"{out}/{name}")

    # Orders draw their keys and prices from the stored tables.
    tables = {
        "customers": store("customers", gen_customers(spark, customers, seed)),
        "products": store("products", gen_products(spark, products, seed)),
    }
    tables["orders"] = store("orders", gen_orders(spark, orders, tables["customers"], tables["products"], seed))
    return tables


def report(tables: dict[str, DataFrame]) -> None:
    for name, (key, _) in TABLES.items():
        print(f"{name}, first 10")
        preview(tables[name], [key]).show(truncate=False)
    print("orders by status")
    analytics.status_summary(tables["orders"]).show()
    print("top customers by revenue")
    analytics.top_customers(tables["customers"], tables["orders"]).show(truncate=False)


def main() -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--out", required=True)
    args.add_argument("--customers", type=int, default=1000)
    args.add_argument("--products", type=int, default=100)
    args.add_argument("--orders", type=int, default=5000)
    args.add_argument("--seed", type=int, default=42)
    args.add_argument("--versioned", action="store_true")
    given = args.parse_args()
    spark = build_session("load-shop")
    report(load(spark, given.out, given.customers, given.products, given.orders, given.seed, given.versioned))
    spark.stop()


if __name__ == "__main__":
    main()
