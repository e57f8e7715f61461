"""Seeded e-commerce tables, generated on the executors.

Every attribute is drawn from an MD5 digest of ``seed:kind:id``, so a row depends on
nothing but its id and the seed: not on the partition count, a retry or the engine
(the same draws can be written in any SQL dialect with an ``md5`` function).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The word lists, price range, quantities, statuses and dates of the data set.
FIRST_NAMES = (
    "John", "Jane", "Bob", "Alice", "Charlie", "Diana", "Eve", "Frank", "Grace", "Henry",
)
LAST_NAMES = (
    "Smith", "Johnson", "Williams", "Brown", "Jones",
    "Garcia", "Miller", "Davis", "Rodriguez", "Martinez",
)
PLACES = (
    ("New York", "NY"), ("Los Angeles", "CA"), ("Chicago", "IL"), ("Houston", "TX"),
    ("Phoenix", "AZ"), ("Philadelphia", "PA"), ("San Antonio", "TX"), ("San Diego", "CA"),
    ("Dallas", "TX"), ("San Jose", "CA"),
)
PRODUCTS = {
    "Electronics": ("Laptop", "Smartphone", "Tablet", "Headphones", "Smart Watch"),
    "Clothing": ("T-Shirt", "Jeans", "Jacket", "Sneakers", "Dress"),
    "Home & Garden": ("Coffee Maker", "Lamp", "Plant Pot", "Pillow", "Rug"),
    "Sports": ("Basketball", "Tennis Racket", "Yoga Mat", "Dumbbells", "Running Shoes"),
    "Books": ("Novel", "Cookbook", "Biography", "Self-Help", "Mystery"),
    "Toys": ("Action Figure", "Board Game", "Puzzle", "Doll", "Building Blocks"),
    "Food": ("Coffee Beans", "Chocolate", "Snack Mix", "Pasta", "Olive Oil"),
    "Health": ("Vitamins", "Protein Powder", "Face Cream", "Shampoo", "Toothpaste"),
}
MODIFIERS = ("Pro", "Premium", "Classic", "Deluxe", "Standard")
STATUSES = ("pending", "shipped", "delivered", "cancelled")
MIN_CENTS, MAX_CENTS = 999, 99999
FIRST_DAY, DAYS = "2023-01-01", 694
MAX_QUANTITY = 5


def _digest(kind: str, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(kind), F.col("id").cast("string")))


def _draw(digest: str, start: int, length: int, bound: Column | int) -> Column:
    """0..bound-1 from ``length`` hex digits of the digest column."""
    number = F.conv(F.substring(digest, start, length), 16, 10).cast("long")
    return F.pmod(number, F.lit(bound) if isinstance(bound, int) else bound)


def _pick(words: Sequence[str], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, words)), (index + 1).cast("int"))


def customers_for(ids: DataFrame, seed: int, first_names: Sequence[str] = FIRST_NAMES) -> DataFrame:
    """Customer rows for a column of ``id``s."""
    drawn = ids.select("id", _digest("customer", seed).alias("h")).select(
        F.col("id").alias("customer_id"),
        _pick(first_names, _draw("h", 1, 8, len(first_names))).alias("first_name"),
        _pick(LAST_NAMES, _draw("h", 9, 8, len(LAST_NAMES))).alias("last_name"),
        _draw("h", 17, 8, len(PLACES)).alias("place"),
    )
    email = F.concat(
        F.lower("first_name"), F.lit("."), F.lower("last_name"),
        F.col("customer_id").cast("string"), F.lit("@example.com"),
    )
    return drawn.select(
        "customer_id", "first_name", "last_name", email.alias("email"),
        _pick([c for c, _ in PLACES], F.col("place")).alias("city"),
        _pick([s for _, s in PLACES], F.col("place")).alias("state"),
    )


def products_for(ids: DataFrame, seed: int) -> DataFrame:
    """Product rows for a column of ``id``s."""
    names = F.create_map(*[
        x for c, words in PRODUCTS.items() for x in (F.lit(c), F.array(*map(F.lit, words)))
    ])
    drawn = ids.select("id", _digest("product", seed).alias("h")).select(
        F.col("id").alias("product_id"),
        _pick(list(PRODUCTS), _draw("h", 1, 8, len(PRODUCTS))).alias("category"),
        (_draw("h", 9, 8, 5) + 1).cast("int").alias("nth"),
        _pick(MODIFIERS, _draw("h", 17, 8, len(MODIFIERS))).alias("modifier"),
        _draw("h", 25, 8, MAX_CENTS - MIN_CENTS + 1).alias("cents"),
    )
    return drawn.select(
        "product_id",
        F.concat_ws(" ", F.element_at(names[F.col("category")], F.col("nth")), "modifier").alias("name"),
        "category",
        ((F.col("cents") + MIN_CENTS) / F.lit(100.0)).alias("price"),
    )


def orders_for(ids: DataFrame, customers: DataFrame, products: DataFrame, seed: int) -> DataFrame:
    """Order rows for a column of ``id``s, with keys drawn from both dimension tables.

    The dimensions must have the dense ids 1..n that the generators give; the price comes
    from a join whose strategy Spark picks by size, so products may be large.
    """
    n_customers = _dense(customers, "customer_id")
    n_products = _dense(products, "product_id")
    drawn = ids.select(
        "id", _digest("order", seed).alias("h"), _digest("order-keys", seed).alias("k")
    ).select(
        F.col("id").alias("order_id"),
        (_draw("k", 1, 15, n_customers) + 1).alias("customer_id"),
        (_draw("k", 17, 15, n_products) + 1).alias("product_id"),
        (_draw("h", 1, 8, MAX_QUANTITY) + 1).cast("int").alias("quantity"),
        _pick(STATUSES, _draw("h", 9, 8, len(STATUSES))).alias("status"),
        F.date_add(F.lit(FIRST_DAY).cast("date"), _draw("h", 17, 8, DAYS).cast("int"))
        .cast("timestamp_ntz").alias("order_date"),
    )
    return drawn.join(products.select("product_id", "price"), "product_id").select(
        "order_id", "customer_id", "product_id", "quantity",
        F.round(F.col("price") * F.col("quantity"), 2).alias("total_amount"),
        "status", "order_date",
    )


def _dense(df: DataFrame, key: str) -> int:
    n, distinct, low, high = df.agg(F.count(key), F.count_distinct(key), F.min(key), F.max(key)).first()
    if n == 0 or low != 1 or high != n or distinct != n:
        raise ValueError(f"{key} must be the dense ids 1..n, got {n} ids in {low}..{high}")
    return n


def _ids(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(1, n + 1)


def gen_customers(
    spark: SparkSession, n: int = 1000, seed: int = 42, first_names: Sequence[str] = FIRST_NAMES
) -> DataFrame:
    return customers_for(_ids(spark, n), seed, first_names)


def gen_products(spark: SparkSession, n: int = 100, seed: int = 42) -> DataFrame:
    return products_for(_ids(spark, n), seed)


def gen_orders(
    spark: SparkSession, n: int, customers: DataFrame, products: DataFrame, seed: int = 42
) -> DataFrame:
    return orders_for(_ids(spark, n), customers, products, seed)
