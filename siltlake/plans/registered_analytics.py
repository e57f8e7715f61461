"""Registered queries: scans, scalar functions and the analytics questions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltlake.functions.envelope import envelope
from siltlake.functions.sizing import settled
from siltlake.operators.profiles import ProfileStore, discover
from siltlake.operators.quality import describe_tables, row_counts
from siltlake.plans import analytics as a
from siltlake.plans import star
from siltlake.plans.registry import register
from siltlake.session import scratch
from siltlake.sinks.parquet import preview
from siltlake.sources.tables import STAR_TABLES, read_table, register_views

CUSTOMERS = """(SELECT c_custkey AS customer_id, c_name AS first_name, c_mktsegment AS last_name,
    n_name AS city, n_name AS state FROM customer JOIN nation ON c_nationkey = n_nationkey)"""
PRODUCTS = """(SELECT p_partkey AS product_id, p_name AS name, p_type AS category,
    p_retailprice AS price FROM part)"""
ORDERS = """(SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS total_amount,
    o_orderstatus AS status, o_orderdate AS order_date FROM orders)"""
LINES = """(SELECT l_orderkey AS order_id, o_custkey AS customer_id, l_partkey AS product_id,
    l_quantity AS quantity, l_extendedprice AS total_amount, o_orderstatus AS status,
    o_orderdate AS order_date FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

# --- scans -----------------------------------------------------------------------------


@register("SELECT * FROM supplier")
def table_scan(spark, sf):
    return read_table(spark, "supplier", sf)


@register("""SELECT r_name, count(*) AS suppliers, round(sum(s_acctbal), 2) AS balance
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY r_name""")
def star_views(spark, sf):
    register_views(spark, sf)
    return spark.sql(
        """SELECT r_name, count(*) AS suppliers, round(sum(s_acctbal), 2) AS balance
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey GROUP BY r_name"""
    )


@register("SELECT c_custkey, c_name, c_mktsegment FROM customer ORDER BY c_custkey LIMIT 10")
def preview_rows(spark, sf):
    return preview(read_table(spark, "customer", sf).select("c_custkey", "c_name", "c_mktsegment"), ["c_custkey"])


# Column types of the star schema under Spark's names.
_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz"}
_COLUMNS = {
    "region": "r_regionkey INTEGER, r_name VARCHAR",
    "nation": "n_nationkey INTEGER, n_name VARCHAR, n_regionkey INTEGER",
    "customer": "c_custkey BIGINT, c_name VARCHAR, c_nationkey INTEGER, c_acctbal DOUBLE, c_mktsegment VARCHAR",
    "supplier": "s_suppkey BIGINT, s_name VARCHAR, s_nationkey INTEGER, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name VARCHAR, p_brand VARCHAR, p_type VARCHAR, p_size INTEGER, "
    "p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus VARCHAR, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP, o_orderpriority VARCHAR",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INTEGER, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag VARCHAR, "
    "l_linestatus VARCHAR, l_shipdate TIMESTAMP",
    "events": "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type VARCHAR, value DOUBLE, props VARCHAR",
}


def _profile_sql():
    parts = []
    for table in STAR_TABLES:
        for column in _COLUMNS[table].split(", "):
            name, kind = column.split(" ")
            parts.append(
                f"""SELECT '{table}' AS "table", '{name}' AS "column", '{_TYPES[kind]}' AS "type",
                count(*) AS "rows", count(*) - count({name}) AS nulls,
                count(DISTINCT {name}) AS "distinct" FROM {table}"""
            )
    return " UNION ALL ".join(parts)


#: The other given tables, which no view is registered for.
_OTHER_COLUMNS = {
    "documents": "doc_id text lang source n_chars", "embeddings": "vec_id embedding label", "pages": "page_id url html",
    "benchmark": "item_id text", "labels": "doc_id quality toxic", "conversations": "conv_id turn role text",
}


def _discovered_sql():
    columns = {t: [c.split(" ")[0] for c in cs.split(", ")] for t, cs in _COLUMNS.items()}
    columns |= {t: cs.split(" ") for t, cs in _OTHER_COLUMNS.items()}
    return " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", '{c}' AS "column", count(*) AS "rows", count(*) - count({c}) AS nulls, true AS close FROM {t}"""
        for t, cs in columns.items() for c in cs)


@register(_discovered_sql())
def discovered_profiles(spark, sf):
    """Every table of the folder, found by listing: stored sketches, whose distinct counts are compared with exact ones."""
    store = ProfileStore(spark, scratch(spark, "profiles"))
    store.update(sf)
    # Table by table: one plan that groups every column of all tables is more than a small driver holds.
    parts = [settled(describe_tables(spark, sf, [t]).select("table", "column", F.col("distinct").alias("exact"))) for t in discover(spark, sf)]
    exact = reduce(DataFrame.unionByName, parts)
    close = F.abs(F.col("distinct") - F.col("exact")) <= F.greatest(F.lit(1), F.col("exact") * 0.05)
    return store.profile(sf).join(exact, ["table", "column"]).select("table", "column", "rows", "nulls", close.alias("close"))


@register(_profile_sql())
def table_profiles(spark, sf):
    return describe_tables(spark, sf)


@register(" UNION ALL ".join(f"""SELECT '{t}' AS "table", count(*) AS "rows" FROM {t}""" for t in STAR_TABLES))
def table_row_counts(spark, sf):
    return row_counts({t: read_table(spark, t, sf) for t in STAR_TABLES})


# --- scalar functions ------------------------------------------------------------------


@register("""SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders
    WHERE o_orderstatus = 'P' AND o_orderdate < DATE '1998-01-01'""")
def old_pending_orders(spark, sf):
    return (
        read_table(spark, "orders", sf)
        .where((F.col("o_orderstatus") == "P") & (F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")))
        .select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    )


@register("SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring%'")
def name_pattern(spark, sf):
    return read_table(spark, "part", sf).where(F.col("p_name").like("%ring%")).select("p_partkey", "p_name")


@register("""SELECT c_custkey, lower(c_mktsegment) || '.' || lower(n_name) || c_custkey || '@example.com' AS email
    FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def customer_emails(spark, sf):
    return star.customers(spark, sf).select(
        F.col("customer_id").alias("c_custkey"),
        F.format_string(
            "%s.%s%d@example.com", F.lower("last_name"), F.lower("city"), F.col("customer_id")
        ).alias("email"),
    )


@register("""SELECT l_orderkey, l_linenumber, l_quantity * l_extendedprice AS gross,
    l_extendedprice * 1.1::DOUBLE AS raised FROM lineitem""")
def line_arithmetic(spark, sf):
    return read_table(spark, "lineitem", sf).select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity") * F.col("l_extendedprice")).alias("gross"),
        (F.col("l_extendedprice") * F.lit(1.1)).alias("raised"),
    )


@register("""SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) + 30 AS due,
    date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS days_to_ship
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def shipping_days(spark, sf):
    lines = read_table(spark, "lineitem", sf).select("l_orderkey", "l_linenumber", "l_shipdate")
    orders = read_table(spark, "orders", sf).select("o_orderkey", "o_orderdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", F.date_add("l_shipdate", 30).alias("due"),
        F.datediff("l_shipdate", "o_orderdate").cast("long").alias("days_to_ship"),
    )


@register("SELECT event_id, event_type || ' ' || props AS text FROM events")
def bytes_to_text(spark, sf):
    raw = read_table(spark, "events", sf).select(
        "event_id", F.encode(F.concat_ws(" ", "event_type", "props"), "UTF-8").alias("value")
    )
    return raw.select("event_id", F.col("value").cast("string").alias("text"))


def _event_json():
    return F.to_json(F.struct("event_id", "event_type", F.struct("user_id", "value").alias("data")))


@register("SELECT event_id, event_type, user_id, value FROM events")
def json_to_struct(spark, sf):
    schema = "event_id long, event_type string, data struct<user_id: long, value: double>"
    text = read_table(spark, "events", sf).select(_event_json().alias("json"))
    return (
        text.select(F.from_json("json", schema).alias("e"))
        .select("e.event_id", "e.event_type", "e.data.user_id", "e.data.value")
    )


@register("SELECT user_id, value FROM events")
def struct_expansion(spark, sf):
    schema = "event_id long, event_type string, data struct<user_id: long, value: double>"
    return read_table(spark, "events", sf).select(F.from_json(_event_json(), schema).alias("e")).select("e.data.*")


@register("""SELECT event_id, CASE WHEN event_type <> 'error' THEN ts END AS ts FROM events""")
def timestamp_text(spark, sf):
    """ISO text back to timestamps; text that is none (here that of errors) becomes NULL."""
    text = F.when(F.col("event_type") == "error", F.lit("not a time")).otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )
    return read_table(spark, "events", sf).select(
        "event_id", text.try_cast("timestamp_ntz").alias("ts")
    )


@register("""SELECT event_id, '{"_log_type":"user_events","_log_class":"UserEvents","_version":"1.0.0","data":{"timestamp":"'
    || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z","user_id":"' || user_id || '","event_type":"' || event_type || '"}}'
    AS message FROM events""")
def envelope_messages(spark, sf):
    data = F.struct(
        F.col("ts").alias("timestamp"), F.col("user_id").cast("string").alias("user_id"), "event_type"
    )
    return read_table(spark, "events", sf).select(
        "event_id", envelope("user_events", "UserEvents", "1.0.0", data).alias("message")
    )


@register("""SELECT event_id, json_extract_string(props, '$.k') AS k,
    CAST(json_extract_string(props, '$.missing') AS VARCHAR) AS missing FROM events""")
def map_lookup(spark, sf):
    props = F.from_json("props", "map<string,string>")
    return read_table(spark, "events", sf).select("event_id", props.alias("m")).select(
        "event_id", F.try_element_at("m", F.lit("k")).alias("k"),
        F.try_element_at("m", F.lit("missing")).alias("missing"),
    )


# --- analytics questions ---------------------------------------------------------------


@register(f"""SELECT status, count(*) AS order_count, round(sum(total_amount), 2) AS total_revenue
    FROM {ORDERS} GROUP BY status ORDER BY order_count DESC, status""")
def status_summary(spark, sf):
    return a.status_summary(star.orders(spark, sf))


@register(f"""SELECT status, count(*) AS order_count, round(sum(total_amount), 2) AS total_revenue
    FROM {ORDERS} GROUP BY status ORDER BY total_revenue DESC, status""")
def status_by_revenue(spark, sf):
    return a.status_by_revenue(star.orders(spark, sf))


@register(f"""SELECT status, count(*) AS order_count, round(sum(total_amount), 2) AS total_revenue,
    round(avg(total_amount), 6) AS avg_order_value FROM {ORDERS} GROUP BY status""")
def status_averages(spark, sf):
    return a.status_averages(star.orders(spark, sf))


@register(f"""SELECT status, count(*) AS order_count, round(sum(total_amount), 2) AS total_revenue,
    round(avg(total_amount), 6) AS avg_order_value,
    min(order_date) AS first_order, max(order_date) AS last_order FROM {ORDERS} GROUP BY status""")
def status_metrics(spark, sf):
    return a.status_metrics(star.orders(spark, sf))


@register(f"""SELECT c.customer_id, first_name, last_name, city, count(order_id) AS order_count,
    round(sum(total_amount), 2) AS total_spent
    FROM {CUSTOMERS} c JOIN {ORDERS} o ON c.customer_id = o.customer_id
    GROUP BY c.customer_id, first_name, last_name, city
    ORDER BY total_spent DESC, c.customer_id LIMIT 10""")
def top_customers(spark, sf):
    return a.top_customers(star.customers(spark, sf), star.orders(spark, sf))


@register(f"""SELECT first_name || ' ' || last_name AS customer, city, count(order_id) AS num_orders,
    round(sum(total_amount), 2) AS total_spent
    FROM {CUSTOMERS} c JOIN {ORDERS} o ON c.customer_id = o.customer_id
    GROUP BY c.customer_id, first_name, last_name, city
    ORDER BY total_spent DESC, c.customer_id LIMIT 10""")
def top_customers_named(spark, sf):
    return a.top_customers_named(star.customers(spark, sf), star.orders(spark, sf))


@register(f"""SELECT first_name, last_name, city, state, count(order_id) AS order_count,
    round(sum(total_amount), 2) AS total_spent,
    round(avg(total_amount), 6) AS avg_order_value
    FROM {CUSTOMERS} c JOIN {ORDERS} o ON c.customer_id = o.customer_id
    GROUP BY c.customer_id, first_name, last_name, city, state
    ORDER BY total_spent DESC, c.customer_id LIMIT 10""")
def top_customers_valued(spark, sf):
    return a.top_customers_valued(star.customers(spark, sf), star.orders(spark, sf))


@register(f"SELECT state, count(*) AS customer_count FROM {CUSTOMERS} GROUP BY state ORDER BY 2 DESC, 1")
def customers_by_state(spark, sf):
    return a.customers_by_state(star.customers(spark, sf))


@register(f"""SELECT category, count(*) AS product_count, round(avg(price), 6) AS avg_price
    FROM {PRODUCTS} GROUP BY category ORDER BY 2 DESC, 1""")
def products_by_category(spark, sf):
    return a.products_by_category(star.products(spark, sf))


@register(f"""SELECT category, count(*) AS product_count, round(avg(price), 6) AS avg_price,
    min(price) AS min_price, max(price) AS max_price FROM {PRODUCTS} GROUP BY category ORDER BY 3 DESC, 1""")
def category_prices(spark, sf):
    return a.category_prices(star.products(spark, sf))


@register(f"""SELECT category, count(order_id) AS order_count, round(sum(total_amount), 2) AS revenue
    FROM {PRODUCTS} p JOIN {LINES} o ON p.product_id = o.product_id GROUP BY category ORDER BY 3 DESC, 1""")
def revenue_by_category(spark, sf):
    return a.revenue_by_category(star.products(spark, sf), star.sales(spark, sf))


@register(f"""SELECT category, count(DISTINCT customer_id) AS unique_customers,
    count(order_id) AS total_orders, round(sum(total_amount), 2) AS revenue
    FROM {PRODUCTS} p JOIN {LINES} o ON p.product_id = o.product_id GROUP BY category ORDER BY 4 DESC, 1""")
def category_reach(spark, sf):
    return a.category_reach(star.products(spark, sf), star.order_lines(spark, sf))


@register(f"""SELECT state, count(DISTINCT o.customer_id) AS customer_count, count(order_id) AS order_count,
    round(sum(total_amount), 2) AS total_revenue
    FROM {CUSTOMERS} c JOIN {ORDERS} o ON c.customer_id = o.customer_id GROUP BY state ORDER BY 4 DESC, 1""")
def revenue_by_state(spark, sf):
    return a.revenue_by_state(star.customers(spark, sf), star.orders(spark, sf))


@register(f"""SELECT first_name || ' ' || last_name AS customer_name, name AS product_name, quantity,
    total_amount, status, order_date
    FROM {LINES} o JOIN {CUSTOMERS} c ON o.customer_id = c.customer_id
    JOIN {PRODUCTS} p ON o.product_id = p.product_id WHERE status = 'F'
    ORDER BY order_date DESC, customer_name, product_name, quantity, total_amount LIMIT 20""")
def latest_delivered_orders(spark, sf):
    return a.latest_orders(
        star.customers(spark, sf), star.products(spark, sf), star.orders(spark, sf), "F",
        expand=lambda headers: star.sales(spark, sf).join(headers.drop("total_amount"), "order_id"),
    )


@register(f"""SELECT first_name || ' ' || last_name AS customer, name AS product, total_amount
    FROM {LINES} o JOIN {CUSTOMERS} c ON o.customer_id = c.customer_id
    JOIN {PRODUCTS} p ON o.product_id = p.product_id
    ORDER BY total_amount DESC, customer, product LIMIT 10""")
def largest_orders(spark, sf):
    return a.largest_orders(
        star.customers(spark, sf), star.products(spark, sf), star.sales(spark, sf),
        expand=lambda lines: lines.join(star.orders(spark, sf).drop("total_amount"), "order_id"),
    )


@register(f"""SELECT category, name, count(order_id) AS times_ordered, sum(quantity) AS total_quantity,
    round(sum(total_amount), 2) AS total_revenue
    FROM {PRODUCTS} p JOIN {LINES} o ON p.product_id = o.product_id
    GROUP BY p.product_id, category, name ORDER BY total_revenue DESC, p.product_id LIMIT 20""")
def product_popularity(spark, sf):
    return a.product_popularity(star.products(spark, sf), star.sales(spark, sf))


@register(f"""SELECT date_trunc('month', order_date) AS order_month, count(*) AS order_count,
    round(sum(total_amount), 2) AS monthly_revenue FROM {ORDERS} GROUP BY 1 ORDER BY 1""")
def orders_by_month(spark, sf):
    return a.orders_by_month(star.orders(spark, sf))


@register(f"""SELECT date_trunc('month', order_date) AS "month", status, count(*) AS order_count,
    round(sum(total_amount), 2) AS revenue FROM {ORDERS} GROUP BY 1, 2 ORDER BY 1 DESC, 2""")
def orders_by_month_status(spark, sf):
    return a.orders_by_month_status(star.orders(spark, sf))


@register(f"SELECT * FROM {PRODUCTS} WHERE category = 'ECONOMY' ORDER BY product_id LIMIT 5")
def products_of_category(spark, sf):
    return a.products_of_category(star.products(spark, sf), "ECONOMY")


@register(f"""SELECT first_name, last_name, city, state FROM {CUSTOMERS} WHERE state = 'NATION_3'
    ORDER BY customer_id LIMIT 10""")
def customers_of_state(spark, sf):
    return a.customers_of_state(star.customers(spark, sf), "NATION_3")
