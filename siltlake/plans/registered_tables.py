"""Registered queries: generators, sinks, versioned tables, maintenance and quality."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltlake.operators import cdc, dml, feed, maintenance, quality
from siltlake.operators import changelog as log
from siltlake.operators.views import MaintainedJoin
from siltlake.plans import analytics
from siltlake.plans.registry import register
from siltlake.session import scratch
from siltlake.sinks import parquet as sinks
from siltlake.sources import generate as gen
from siltlake.sources.tables import conform, read_csv, read_json, read_table, split_corrupt, violations

# --- generators: ids come from the given tables -----------------------------------------

SEED = 42


def _sql_list(words):
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def _sql_draw(digest, start, length, bound):
    return f"(('0x' || substr({digest}, {start}, {length}))::BIGINT % {bound})"


def _sql_pick(words, digest, start):
    return f"({_sql_list(words)})[{_sql_draw(digest, start, 8, len(words))} + 1]"


_CUSTOMER_SQL = f"""(SELECT id AS customer_id, first_name, last_name,
    lower(first_name) || '.' || lower(last_name) || id || '@example.com' AS email, city, state FROM (
    SELECT id, {_sql_pick(gen.FIRST_NAMES, 'h', 1)} AS first_name, {_sql_pick(gen.LAST_NAMES, 'h', 9)} AS last_name,
    {_sql_pick([c for c, _ in gen.PLACES], 'h', 17)} AS city, {_sql_pick([s for _, s in gen.PLACES], 'h', 17)} AS state
    FROM (SELECT c_custkey + 1 AS id, md5('{SEED}:customer:' || (c_custkey + 1)) AS h FROM customer)))"""

_WORDS = [w for words in gen.PRODUCTS.values() for w in words]
_PRODUCT_SQL = f"""(SELECT id AS product_id,
    ({_sql_list(_WORDS)})[{_sql_draw('h', 1, 8, 8)} * 5 + {_sql_draw('h', 9, 8, 5)} + 1] || ' ' ||
    {_sql_pick(gen.MODIFIERS, 'h', 17)} AS name, {_sql_pick(list(gen.PRODUCTS), 'h', 1)} AS category,
    ({_sql_draw('h', 25, 8, gen.MAX_CENTS - gen.MIN_CENTS + 1)} + {gen.MIN_CENTS}) / 100.0::DOUBLE AS price
    FROM (SELECT p_partkey + 1 AS id, md5('{SEED}:product:' || (p_partkey + 1)) AS h FROM part))"""

_ORDER_SQL = f"""(SELECT order_id, customer_id, o.product_id, quantity, round(price * quantity, 2) AS total_amount,
    status, order_date FROM (
    SELECT id AS order_id, {_sql_draw('k', 1, 15, '(SELECT count(*) FROM customer)')} + 1 AS customer_id,
    {_sql_draw('k', 17, 15, '(SELECT count(*) FROM part)')} + 1 AS product_id,
    CAST({_sql_draw('h', 1, 8, gen.MAX_QUANTITY)} + 1 AS INTEGER) AS quantity, {_sql_pick(gen.STATUSES, 'h', 9)} AS status,
    CAST(DATE '{gen.FIRST_DAY}' + CAST({_sql_draw('h', 17, 8, gen.DAYS)} AS INTEGER) AS TIMESTAMP) AS order_date
    FROM (SELECT o_orderkey + 1 AS id, md5('{SEED}:order:' || (o_orderkey + 1)) AS h,
          md5('{SEED}:order-keys:' || (o_orderkey + 1)) AS k FROM orders)) o
    JOIN {_PRODUCT_SQL} p ON o.product_id = p.product_id)"""


def _ids(spark, sf, table, key):
    return read_table(spark, table, sf).select((F.col(key) + 1).alias("id"))


@register(f"SELECT * FROM {_CUSTOMER_SQL}")
def generated_customers(spark, sf):
    return gen.customers_for(_ids(spark, sf, "customer", "c_custkey"), SEED)


@register(f"SELECT * FROM {_PRODUCT_SQL}")
def generated_products(spark, sf):
    return gen.products_for(_ids(spark, sf, "part", "p_partkey"), SEED)


@register(f"SELECT * FROM {_ORDER_SQL}")
def generated_orders(spark, sf):
    return gen.orders_for(
        _ids(spark, sf, "orders", "o_orderkey"), generated_customers(spark, sf), generated_products(spark, sf), SEED
    )


@register(f"""SELECT status, count(*) AS order_count, round(sum(total_amount), 2) AS total_revenue
    FROM {_ORDER_SQL} GROUP BY status""")
def generated_load_report(spark, sf):
    """Generate, load partitioned by status, and report from the loaded table."""
    orders = sinks.write_table(generated_orders(spark, sf), scratch(spark, "load"), partition_by=["status"])
    return analytics.status_summary(orders)


@register("""SELECT l_orderkey, CAST(l_partkey AS INTEGER) AS l_partkey, CAST(l_quantity AS INTEGER) AS l_quantity,
    CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem""")
def conformed_lines(spark, sf):
    """Lines as text, conformed to declared non-null types."""
    schema = T.StructType([
        T.StructField("l_orderkey", T.LongType(), False), T.StructField("l_partkey", T.IntegerType(), False),
        T.StructField("l_quantity", T.IntegerType(), False), T.StructField("l_shipdate", T.DateType(), False),
    ])
    text = read_table(spark, "lineitem", sf).select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate"),
        F.col("l_quantity").cast("int").cast("string").alias("l_quantity"),
        F.col("l_partkey").cast("string").alias("l_partkey"), F.col("l_orderkey").cast("string").alias("l_orderkey"),
    )
    return conform(text, schema)


@register("""SELECT 'event_id' AS "column", 0 AS nulls, 0 AS misfits UNION ALL
    SELECT 'value', count(*) FILTER (WHERE event_type = 'error'), 0 FROM events UNION ALL
    SELECT 'props', 0, count(*) FROM events""")
def conform_violations(spark, sf):
    """Counted violations: the value of errors is blanked, and JSON text is no number."""
    schema = T.StructType([
        T.StructField("event_id", T.LongType(), False), T.StructField("value", T.DoubleType(), False),
        T.StructField("props", T.IntegerType(), False),
    ])
    rows = read_table(spark, "events", sf).withColumn(
        "value", F.when(F.col("event_type") != "error", F.col("value"))
    )
    return violations(rows, schema)


# --- sinks -----------------------------------------------------------------------------


@register("SELECT * FROM customer")
def overwritten_table(spark, sf):
    path = scratch(spark, "overwrite")
    sinks.write_table(read_table(spark, "customer", sf).withColumn("c_custkey", -F.col("c_custkey")), path)
    return sinks.write_table(read_table(spark, "customer", sf), path)


@register("SELECT * FROM orders")
def partitioned_table(spark, sf):
    return sinks.write_table(read_table(spark, "orders", sf), scratch(spark, "partitioned"), partition_by=["o_orderstatus"])


@register("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def orders_of_partition(spark, sf):
    """A filter on the partition column reads one directory."""
    path = scratch(spark, "pruned")
    sinks.write_table(read_table(spark, "orders", sf), path, partition_by=["o_orderstatus"])
    return spark.read.parquet(path).where(F.col("o_orderstatus") == "F").select(
        "o_orderkey", "o_orderstatus", "o_totalprice"
    )


@register("SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-10 06:00:00' AND ts < TIMESTAMP '2024-01-15 00:00:00'")
def events_between(spark, sf):
    """A filter on a timestamp of a table partitioned by a derived day."""
    path = scratch(spark, "byday")
    sinks.write_by_day(read_table(spark, "events", sf), path, "ts")
    return sinks.read_between(spark, path, "ts", "2024-01-10 06:00:00", "2024-01-15 00:00:00")


@register("SELECT * FROM orders")
def appended_table(spark, sf):
    """A first load and an incremental one."""
    orders, path = read_table(spark, "orders", sf), scratch(spark, "append")
    late = F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")
    sinks.write_table(orders.where(~late), path)
    return sinks.write_table(orders.where(late), path, mode="append")


@register("SELECT * FROM part")
def sorted_table(spark, sf):
    return sinks.write_table(
        read_table(spark, "part", sf), scratch(spark, "sorted"), partition_by=["p_brand"], sort_by=["p_type", "p_partkey"]
    )


@register("""SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part""")
def table_from_query(spark, sf):
    """CREATE TABLE AS SELECT with another partitioning, read back by name."""
    name = f"ctas_{uuid.uuid4().hex[:12]}"
    return sinks.ctas(read_table(spark, "part", sf), name, scratch(spark, name), ["p_type"])


@register("""SELECT * FROM (SELECT 'rows' AS what, count(*) AS n FROM customer
    UNION ALL SELECT 'differences', 0)""")
def dual_written(spark, sf):
    """The same rows as a Parquet and a versioned table: rows and differences between them."""
    path, base = scratch(spark, "dual-plain"), scratch(spark, "dual-versioned")
    dml.dual_write(read_table(spark, "customer", sf), path, base, ["c_custkey"])
    plain, versioned = spark.read.parquet(path), log.read_version(spark, base)
    found = plain.agg(F.count("*").alias("n")).select(F.lit("rows").alias("what"), "n")
    return found.unionByName(
        quality.reconcile(plain, versioned).agg(F.count("*").alias("n")).select(F.lit("differences").alias("what"), "n")
    )


@register("""SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, 'left' AS side, 1 AS copies
    FROM part WHERE p_type = 'ECONOMY'
    UNION ALL
    SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice * 1.1::DOUBLE, 'right', 1 FROM part WHERE p_type = 'ECONOMY'""")
def reconciled_tables(spark, sf):
    """Plain files against the versioned table in all columns, after a price change in the latter."""
    base = _parts(spark, sf)
    _raise_economy(spark, base)
    return quality.reconcile_digests(read_table(spark, "part", sf), log.read_version(spark, base))


@register("""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, 'right' AS side, 1 AS copies
    FROM orders WHERE o_orderkey % 1000 = 7
    UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, 'left', 1
    FROM orders WHERE o_orderkey % 1000 = 13
    UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, NULL, 'right', 1
    FROM orders WHERE o_orderkey % 1000 = 13 AND o_orderpriority IS NOT NULL""")
def reconciled_digests(spark, sf):
    """Orders against a copy in which some rows are repeated and some have lost their priority, in buckets of checksums."""
    orders = read_table(spark, "orders", sf)
    faulty = F.when(F.col("o_orderkey") % 1000 != 13, F.col("o_orderpriority"))
    copy = orders.withColumn("o_orderpriority", faulty).unionByName(orders.where(F.col("o_orderkey") % 1000 == 7))
    path = scratch(spark, "copy")
    return quality.reconcile_digests(orders, sinks.write_table(copy, path), fan=256, leaf_rows=10)


# --- versioned tables ------------------------------------------------------------------

# Commit times of the scripted tables below.
AT = [dt.datetime(2024, 1, d, 12) for d in range(1, 10)]


def _parts(spark, sf, **kw) -> str:
    base = scratch(spark, "part")
    dml.create_or_replace(read_table(spark, "part", sf), base, ["p_partkey"], at=AT[0], **kw)
    return base


def _raise_economy(spark, base):
    dml.update(spark, base, F.col("p_type") == "ECONOMY", {"p_retailprice": F.col("p_retailprice") * F.lit(1.1)}, at=AT[1])


def _drop_rings(spark, base):
    dml.delete(spark, base, F.col("p_name").like("%ring%"), at=AT[2])


def _three_versions(spark, sf) -> str:
    base = _parts(spark, sf)
    _raise_economy(spark, base)
    _drop_rings(spark, base)
    return base


_RAISED = """SELECT p_partkey, p_name, p_brand, p_type, p_size,
    CASE WHEN p_type = 'ECONOMY' THEN p_retailprice * 1.1::DOUBLE ELSE p_retailprice END AS p_retailprice FROM part"""
_KEPT = f"{_RAISED} WHERE p_name NOT LIKE '%ring%'"


@register(_KEPT)
def current_version(spark, sf):
    return log.read_version(spark, _three_versions(spark, sf))


@register(_RAISED)
def version_by_number(spark, sf):
    return log.read_version(spark, _three_versions(spark, sf), version=2)


@register("SELECT * FROM part")
def version_by_time(spark, sf):
    return log.read_version(spark, _three_versions(spark, sf), as_of=dt.datetime(2024, 1, 2, 11, 59))


_SNAPSHOTS = """SELECT 1::BIGINT AS snapshot_id, NULL::BIGINT AS parent_id, TIMESTAMP '2024-01-01 12:00:00' AS committed_at,
    'create' AS operation, count(*) AS upserts, 0::BIGINT AS deletes FROM part
    UNION ALL SELECT 2, 1, TIMESTAMP '2024-01-02 12:00:00', 'update', count(*), 0 FROM part WHERE p_type = 'ECONOMY'
    UNION ALL SELECT 3, 2, TIMESTAMP '2024-01-03 12:00:00', 'delete', 0, count(*) FROM part WHERE p_name LIKE '%ring%'"""


@register(_SNAPSHOTS)
def table_snapshots(spark, sf):
    return log.snapshots(spark, _three_versions(spark, sf))


@register(f"""SELECT committed_at AS made_current_at, snapshot_id, parent_id, true AS is_current_ancestor
    FROM ({_SNAPSHOTS})""")
def table_history(spark, sf):
    return log.history(spark, _three_versions(spark, sf))


def _orders_by_status(spark, sf) -> str:
    base = scratch(spark, "orders")
    dml.create_or_replace(read_table(spark, "orders", sf), base, ["o_orderkey"], ["o_orderstatus"], at=AT[0])
    return base


_OLD_PENDING = "o_orderstatus = 'P' AND o_orderdate < DATE '1998-01-01'"
_CANCELLED = f"""SELECT o_orderkey, o_custkey, CASE WHEN {_OLD_PENDING} THEN 'C' ELSE o_orderstatus END AS o_orderstatus,
    o_totalprice, o_orderdate, o_orderpriority FROM orders"""


def _cancel_old(spark, base):
    dml.update(
        spark, base,
        (F.col("o_orderstatus") == "P") & (F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")),
        {"o_orderstatus": F.lit("C")}, at=AT[1],
    )


@register(f'SELECT o_orderstatus, count(*) AS "rows" FROM ({_CANCELLED}) GROUP BY 1')
def table_partitions(spark, sf):
    base = _orders_by_status(spark, sf)
    _cancel_old(spark, base)
    return log.partitions(spark, base, "o_orderstatus").select("o_orderstatus", "rows")


@register("""SELECT 1::BIGINT AS version, count(*) AS "rows" FROM part
    UNION ALL SELECT 2, count(*) FROM part WHERE p_type = 'ECONOMY'
    UNION ALL SELECT 3, count(*) FROM part WHERE p_name LIKE '%ring%'""")
def table_files(spark, sf):
    """Log rows of the data files, added up per version (paths and sizes vary)."""
    listing = log.files(spark, _three_versions(spark, sf)).where(F.col("file_bytes") > 0)
    return listing.groupBy("version").agg(F.sum("rows").alias("rows"))


@register(_RAISED)
def updated_rows(spark, sf):
    base = _parts(spark, sf)
    _raise_economy(spark, base)
    return log.read_version(spark, base)


@register(_CANCELLED)
def updated_by_date(spark, sf):
    """An update that moves rows to another partition."""
    base = _orders_by_status(spark, sf)
    _cancel_old(spark, base)
    return log.read_version(spark, base)


@register("SELECT * FROM part WHERE p_name NOT LIKE '%ring%'")
def deleted_rows(spark, sf):
    base = _parts(spark, sf)
    _drop_rings(spark, base)
    return log.read_version(spark, base)


@register("SELECT *, CASE WHEN p_type = 'SMALL' THEN p_size * 10 END AS stock FROM part")
def added_column(spark, sf):
    base = _parts(spark, sf)
    dml.add_column(spark, base, "stock", "int", at=AT[1])
    dml.update(spark, base, F.col("p_type") == "SMALL", {"stock": F.col("p_size") * 10}, at=AT[2])
    return log.read_version(spark, base)


@register("""SELECT p_partkey, p_name, p_brand, p_type, p_size,
    CASE WHEN p_type = 'SMALL' THEN p_retailprice + 1 ELSE p_retailprice END AS price FROM part""")
def renamed_column(spark, sf):
    base = _parts(spark, sf)
    dml.rename_column(spark, base, "p_retailprice", "price", at=AT[1])
    dml.update(spark, base, F.col("p_type") == "SMALL", {"price": F.col("price") + 1}, at=AT[2])
    return log.read_version(spark, base)


@register("""SELECT p_partkey, p_name, p_brand, p_type, p_retailprice,
    CASE WHEN p_type = 'LARGE' THEN 'big' END AS p_size FROM part""")
def dropped_column(spark, sf):
    """A dropped column comes back under the same name, another type and no old values."""
    base = _parts(spark, sf)
    dml.drop_column(spark, base, "p_size", at=AT[1])
    dml.add_column(spark, base, "p_size", "string", at=AT[2])
    dml.update(spark, base, F.col("p_type") == "LARGE", {"p_size": F.lit("big")}, at=AT[3])
    return log.read_version(spark, base)


@register("SELECT p_partkey, p_name, p_retailprice * 2 AS doubled FROM part WHERE p_type = 'PROMO'")
def replaced_table(spark, sf):
    base = _three_versions(spark, sf)
    new = read_table(spark, "part", sf).where(F.col("p_type") == "PROMO").select(
        "p_partkey", "p_name", (F.col("p_retailprice") * 2).alias("doubled")
    )
    dml.create_or_replace(new, base, ["p_partkey"], at=AT[3])
    return log.read_version(spark, base)


@register("SELECT * FROM orders WHERE o_orderstatus = 'F'")
def replaced_partitioned_table(spark, sf):
    """A partitioned versioned table, read with a filter that prunes directories."""
    base = scratch(spark, "orders")
    old = read_table(spark, "orders", sf).withColumn("o_orderkey", -F.col("o_orderkey"))
    dml.create_or_replace(old, base, ["o_orderkey"], at=AT[0])
    dml.create_or_replace(read_table(spark, "orders", sf), base, ["o_orderkey"], ["o_orderstatus"], at=AT[1])
    return log.read_version(spark, base).where(F.col("o_orderstatus") == "F")


@register("""SELECT o_orderkey, o_custkey, o_orderstatus,
    CASE WHEN o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '2000-01-01' THEN 0 ELSE o_totalprice END AS o_totalprice,
    o_orderdate, o_orderpriority FROM orders""")
def appended_versions(spark, sf):
    """An append of new keys, then one that repeats keys and replaces their rows."""
    orders, base = read_table(spark, "orders", sf), scratch(spark, "orders")
    late = F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")
    dml.create_or_replace(orders.where(~late), base, ["o_orderkey"], at=AT[0])
    dml.append(orders.where(late), base, at=AT[1])
    dml.append(orders.where(~late & (F.col("o_orderstatus") == "F")).withColumn("o_totalprice", F.lit(0.0)), base, at=AT[2])
    return log.read_version(spark, base)


@register(_RAISED)
def adopted_table(spark, sf):
    """Existing files become version 1 where they lie, and take an update."""
    base = scratch(spark, "adopted")
    dml.adopt(spark, f"{sf}/part.parquet", base, ["p_partkey"], at=AT[0])
    _raise_economy(spark, base)
    return log.read_version(spark, base)


@register("""SELECT event_id, ts, user_id, event_type, value, props FROM events
    WHERE ts >= TIMESTAMP '2024-01-10 06:00:00' AND ts < TIMESTAMP '2024-01-15 00:00:00' AND event_type <> 'view'
    UNION ALL SELECT event_id, ts + INTERVAL 5 DAY, user_id, event_type, value, props FROM events
    WHERE event_type = 'view' AND ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-10 00:00:00'""")
def hidden_partitions(spark, sf):
    """A range of a timestamp of a versioned table, partitioned by its day, after views have moved five days on."""
    base = scratch(spark, "events")
    dml.create_or_replace(read_table(spark, "events", sf), base, ["event_id"], ["day(ts)"], at=AT[0])
    dml.update(spark, base, "event_type = 'view'", {"ts": F.col("ts") + F.expr("interval 5 days")}, at=AT[1])
    return log.read_version(spark, base, between={"ts": (dt.datetime(2024, 1, 10, 6), dt.datetime(2024, 1, 15))})


@register("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey = 7")
def hidden_buckets(spark, sf):
    """One customer's orders from a table in 16 buckets of customers."""
    base = scratch(spark, "orders")
    dml.create_or_replace(read_table(spark, "orders", sf), base, ["o_orderkey"], ["bucket(16, o_custkey)"], at=AT[0])
    return log.read_version(spark, base, equal={"o_custkey": 7}).select("o_orderkey", "o_custkey", "o_totalprice")


# --- maintenance -----------------------------------------------------------------------


@register(_KEPT)
def expired_table(spark, sf):
    base = _three_versions(spark, sf)
    maintenance.expire(spark, base, dt.datetime(2024, 1, 3))
    return log.read_version(spark, base)


@register(f"SELECT * FROM ({_SNAPSHOTS}) WHERE snapshot_id >= 2")
def snapshots_after_expiry(spark, sf):
    base = _three_versions(spark, sf)
    maintenance.expire(spark, base, dt.datetime(2024, 1, 2))
    return log.snapshots(spark, base)


@register("""SELECT 'left by a failed attempt' AS what, count(*) AS n FROM part WHERE p_type = 'PROMO'
    UNION ALL SELECT 'table', count(*) FROM part""")
def orphan_rows(spark, sf):
    """Log rows in orphan files, found by listing, and the rows of the table."""
    base = _parts(spark, sf)
    chain = log.load(spark, base)
    lost = read_table(spark, "part", sf).where(F.col("p_type") == "PROMO")
    log.write_log(log.upserts(lost, chain[-1]), base, 2, ())
    found = maintenance.orphans(spark, base, log.now() + dt.timedelta(days=1)).select("directory").distinct()
    directories = [r.directory for r in found.collect()]  # one name per failed attempt
    rows = spark.read.schema(chain[-1].physical_schema).parquet(*[f"{base}/log/{d}" for d in directories])
    return quality.row_counts({"left by a failed attempt": rows, "table": log.read_version(spark, base)}).select(
        F.col("table").alias("what"), F.col("rows").alias("n")
    )


@register(_KEPT)
def rewritten_table(spark, sf):
    base = _three_versions(spark, sf)
    maintenance.rewrite(spark, base, target_mb=64, sort_by=["p_type"], at=AT[3])
    return log.read_version(spark, base)


@register("SELECT * FROM events WHERE CAST(ts AS DATE) > (SELECT max(CAST(ts AS DATE)) FROM events) - 7")
def retained_events(spark, sf):
    path = scratch(spark, "retain")
    sinks.write_by_day(read_table(spark, "events", sf), path, "ts")
    days = spark.read.parquet(path)
    return maintenance.retain(days, "_day", 7, days.agg(F.max("_day")).scalar()).drop("_day")


_MONTHS = "SELECT *, CAST(date_trunc('month', o_orderdate) AS DATE) AS o_month FROM orders"
_LATE = f"SELECT * FROM ({_MONTHS}) WHERE o_month > (SELECT max(o_month) FROM ({_MONTHS})) - 730"


@register(f"""SELECT 1::BIGINT AS version, count(*) AS n, min(o_month) AS oldest FROM ({_MONTHS})
    UNION ALL SELECT 3, count(*), min(o_month) FROM ({_LATE}) WHERE NOT (o_orderstatus = 'O' AND o_orderpriority = '5-LOW')""")
def retention_applied(spark, sf):
    """Orders of the last two years: the months before are gone from the version that applied it, not from earlier ones."""
    base = scratch(spark, "orders")
    months = F.trunc(F.col("o_orderdate").cast("date"), "month")
    dml.create_or_replace(read_table(spark, "orders", sf).withColumn("o_month", months), base, ["o_orderkey"], ["o_month"], at=AT[0])
    dml.delete(spark, base, "o_orderstatus = 'O' AND o_orderpriority = '5-LOW'", at=AT[1])
    maintenance.apply_retention(spark, base, "o_month", 730, at=AT[2])
    parts = [
        log.read_version(spark, base, version=v).agg(F.count("*").alias("n"), F.min("o_month").alias("oldest"))
        .select(F.lit(v).cast("long").alias("version"), "n", "oldest") for v in (1, 3)]
    return parts[0].unionByName(parts[1])


@register(f"SELECT * FROM ({_LATE})")
def expired_retention(spark, sf):
    """The same without the delete, after the older versions and the files of the dropped months are removed."""
    base = scratch(spark, "orders")
    months = F.trunc(F.col("o_orderdate").cast("date"), "month")
    dml.create_or_replace(read_table(spark, "orders", sf).withColumn("o_month", months), base, ["o_orderkey"], ["o_month"], at=AT[0])
    maintenance.apply_retention(spark, base, "o_month", 730, at=AT[1])
    maintenance.expire(spark, base, AT[1])
    return log.read_version(spark, base)


#: Rows of a file, about, in the first load of ``rewritten_small_files``.
ROWS_A_FILE = 500_000


@register("""SELECT 'rows' AS what, count(*) AS n FROM orders UNION ALL SELECT 'order keys', sum(o_orderkey)::BIGINT FROM orders
    UNION ALL SELECT 'directories', 2 UNION ALL SELECT 'directories kept', 1""")
def rewritten_small_files(spark, sf):
    """A first load of files of a good size and four small appends, which are put together; the load stays where it is."""
    orders, base = read_table(spark, "orders", sf), scratch(spark, "orders")
    lot = F.col("o_orderkey") % 20
    # Files hold so many rows, however large the table: a task never writes or sorts all of it.
    n = max(1, -(-orders.count() // ROWS_A_FILE))
    spread = lambda rows: rows.repartition(n, "o_orderkey") if n > 1 else rows.coalesce(1)
    dml.create_or_replace(spread(orders.where(lot >= 4)), base, ["o_orderkey"], at=AT[0])
    for i in range(4):
        dml.append(spread(orders.where(lot == i)), base, at=AT[i + 1])
    size = log.files(spark, base).agg(F.max("file_bytes")).first()[0]
    first = log.load(spark, base)[0].data
    maintenance.rewrite(spark, base, target_mb=size / 1024 / 1024, at=AT[5])
    chain = log.load(spark, base)
    now = [c.data for c in log.members(chain, chain[-1])[0]]
    rows = log.read_version(spark, base).agg(F.count("*").alias("rows"), F.sum("o_orderkey").alias("order keys"))
    cells = {"rows": F.col("rows"), "order keys": F.col("order keys"), "directories": F.lit(len(now)), "directories kept": F.lit(now.count(first))}
    return rows.select(F.inline(F.array(*[F.struct(F.lit(k).alias("what"), v.cast("long").alias("n")) for k, v in cells.items()])))


# --- merge, changes, quality, maintained aggregates, text files -------------------------

_SPEND = """(SELECT o_custkey, round(sum(o_totalprice), 2) AS spend FROM orders
    WHERE o_orderdate >= TIMESTAMP '2001-01-01' GROUP BY o_custkey
    UNION ALL SELECT -1 - s_suppkey, s_acctbal FROM supplier)"""


@register(f"""SELECT c_custkey, c_name, c_nationkey,
    CASE WHEN spend IS NULL THEN c_acctbal ELSE c_acctbal + spend END AS c_acctbal, c_mktsegment
    FROM customer LEFT JOIN {_SPEND} ON c_custkey = o_custkey
    WHERE NOT (spend IS NOT NULL AND c_mktsegment = 'MACHINERY')
    UNION ALL SELECT -1 - s_suppkey, 'new', NULL, s_acctbal, NULL FROM supplier""")
def merged_table(spark, sf):
    """Recent spend merged into customers: MACHINERY customers leave, others are credited,
    unknown ones (here negated supplier keys) are inserted."""
    base = scratch(spark, "customer")
    dml.create_or_replace(read_table(spark, "customer", sf), base, ["c_custkey"], at=AT[0])
    spend = (
        read_table(spark, "orders", sf).where(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
        .groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.round(F.sum("o_totalprice"), 2).alias("spend"))
    )
    unknown = read_table(spark, "supplier", sf).select(
        (-1 - F.col("s_suppkey")).alias("c_custkey"), F.col("s_acctbal").alias("spend")
    )
    dml.merge(
        spark, base, spend.unionByName(unknown), ["c_custkey"],
        matched_update={"c_acctbal": F.col("t.c_acctbal") + F.col("s.spend")},
        matched_delete=F.col("t.c_mktsegment") == "MACHINERY",
        insert={"c_name": F.lit("new"), "c_acctbal": F.col("s.spend")}, at=AT[1],
    )
    return log.read_version(spark, base)


@register("""SELECT CASE WHEN p_name LIKE '%ring%' THEN 'delete' ELSE 'update' END AS change, p_partkey,
    p_retailprice AS old_price,
    CASE WHEN p_name NOT LIKE '%ring%' THEN p_retailprice * 1.1::DOUBLE END AS new_price
    FROM part WHERE p_name LIKE '%ring%' OR p_type = 'ECONOMY'
    UNION ALL SELECT 'insert', -1 - s_suppkey, NULL, s_acctbal FROM supplier""")
def changed_rows(spark, sf):
    """Changes from version 1 to 4: an update, a delete and an append."""
    base = _three_versions(spark, sf)
    extra = read_table(spark, "supplier", sf).select(
        (-1 - F.col("s_suppkey")).alias("p_partkey"), F.col("s_acctbal").alias("p_retailprice")
    )
    dml.append(extra, base, at=AT[3])
    return cdc.changes(spark, base, 1, 4).select(
        "change", F.coalesce("after.p_partkey", "before.p_partkey").alias("p_partkey"),
        F.col("before.p_retailprice").alias("old_price"), F.col("after.p_retailprice").alias("new_price"),
    )


@register("""SELECT 'update' AS change, p_partkey, CAST(NULL AS VARCHAR) AS old_stock, CAST(p_size AS VARCHAR) AS new_stock
    FROM part WHERE p_type = 'ECONOMY' AND p_size IS NOT NULL""")
def changed_rows_of_added_column(spark, sf):
    """The only difference of these rows is a value in a column that the older version lacks."""
    base = _parts(spark, sf)
    dml.add_column(spark, base, "stock", "string", at=AT[1])
    dml.update(spark, base, F.col("p_type") == "ECONOMY", {"stock": F.col("p_size").cast("string")}, at=AT[2])
    return cdc.changes(spark, base, 1, 3, as_newest=True).select(
        "change", "after.p_partkey", F.col("before.stock").alias("old_stock"), F.col("after.stock").alias("new_stock")
    )


@register(_KEPT)
def replicated_table(spark, sf):
    """A replica fed by a cursor, which is started anew for every step; versions are rewritten and expired in between."""
    base, replica = _parts(spark, sf), scratch(spark, "replica")
    dml.create_or_replace(log.read_version(spark, base), replica, ["p_partkey"])
    checkpoint, handle = scratch(spark, "ckpt"), feed.replicate(spark, replica, ["p_partkey"])
    feed.Cursor(spark, base, "replica").open()
    steps = (lambda: _raise_economy(spark, base), lambda: maintenance.rewrite(spark, base, at=AT[1]), lambda: _drop_rings(spark, base))
    for step in steps:
        step()
        maintenance.expire(spark, base, AT[8])
        feed.follow(feed.Cursor(spark, base, "replica"), handle, checkpoint).awaitTermination()
    return log.read_version(spark, replica)


@register("""SELECT 'quantity in range' AS rule, count(*) FILTER (WHERE NOT (l_quantity BETWEEN 1 AND 40)) AS failed_rows
    FROM lineitem
    UNION ALL SELECT 'ship date known', count(*) FILTER (WHERE l_shipdate IS NULL) FROM lineitem
    UNION ALL SELECT 'line numbers unique', count(*) - (SELECT count(*) FROM
        (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) FROM lineitem
    UNION ALL SELECT 'order is open', count(*) FROM lineitem ANTI JOIN
        (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O') ON l_orderkey = o_orderkey""")
def quality_report(spark, sf):
    """Row, uniqueness and reference rules over lineitem; some are meant to fail."""
    lines, orders = read_table(spark, "lineitem", sf), read_table(spark, "orders", sf)
    rules = [
        ("quantity in range", F.col("l_quantity").between(1, 40)), ("ship date known", F.col("l_shipdate").isNotNull()),
    ]
    return (
        quality.check(lines, rules)
        .unionByName(quality.check_unique(lines, "line numbers unique", ["l_orderkey", "l_linenumber"]))
        .unionByName(quality.check_reference(
            lines, "order is open", "l_orderkey", orders.where(F.col("o_orderstatus") == "O"), "o_orderkey"
        ))
    )


def _monthly(spark, base) -> cdc.MaintainedAggregate:
    group = {
        "order_month": F.trunc(F.col("o_orderdate").cast("date"), "month"), "o_orderstatus": F.col("o_orderstatus"),
    }
    return cdc.MaintainedAggregate(
        spark, base, scratch(spark, "monthly"), group, {"revenue": F.col("o_totalprice")}, exact="decimal(18,2)"
    )


@register(f"""SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month, o_orderstatus, count(*) AS n,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS revenue
    FROM ({_CANCELLED}) WHERE o_orderpriority <> '5-LOW' GROUP BY 1, 2""")
def maintained_monthly_revenue(spark, sf):
    """Built at version 1 and refreshed from the changes of an update and a delete."""
    base = _orders_by_status(spark, sf)
    view = _monthly(spark, base)
    view.refresh()
    _cancel_old(spark, base)
    dml.delete(spark, base, F.col("o_orderpriority") == "5-LOW", at=AT[2])
    return view.refresh().withColumn("revenue", F.col("revenue").cast("double"))


@register("""SELECT p_type, count(*) AS n, round(sum(CASE WHEN p_type = 'ECONOMY' THEN p_retailprice * 1.1::DOUBLE
    ELSE p_retailprice END), 4) AS value FROM part GROUP BY 1""")
def maintained_part_value(spark, sf):
    """Amounts that an update leaves with more than two digits add up as they are."""
    base = _parts(spark, sf)
    view = cdc.MaintainedAggregate(
        spark, base, scratch(spark, "value"), {"p_type": F.col("p_type")}, {"value": F.col("p_retailprice")}
    )
    view.refresh()
    dml.update(spark, base, "p_type = 'ECONOMY'", {"p_retailprice": F.col("p_retailprice") * 1.1}, at=AT[1])
    return view.refresh().withColumn("value", F.round(F.col("value").cast("double"), 4))


@register(f"""SELECT o_orderstatus, count(*) AS n, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order
    FROM ({_CANCELLED}) WHERE NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'C') GROUP BY 1""")
def maintained_order_dates(spark, sf):
    """First and last order per status: groups that lost one are computed anew."""
    base = _orders_by_status(spark, sf)
    view = cdc.MaintainedAggregate(
        spark, base, scratch(spark, "dates"), {"o_orderstatus": F.col("o_orderstatus")},
        lows={"first_order": F.col("o_orderdate")}, highs={"last_order": F.col("o_orderdate")},
    )
    view.refresh()
    _cancel_old(spark, base)
    view.refresh()
    dml.delete(spark, base, (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "C"), at=AT[2])
    return view.refresh()


_SALES = """(SELECT l_orderkey AS order_id, l_partkey AS product_id, o_custkey AS customer_id, round(sum(l_extendedprice), 2) AS amount
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)"""
_MOVED = "CASE WHEN p_type = 'ECONOMY' AND p_size % 2 = 0 THEN 'SMALL' ELSE p_type END"


@register(f"""SELECT {_MOVED} AS category, count(*) AS n, CAST(sum(CAST(amount AS DECIMAL(18, 2))) AS DOUBLE) AS revenue,
    count(DISTINCT customer_id) AS unique_customers FROM {_SALES} JOIN part ON product_id = p_partkey
    WHERE p_name NOT LIKE '%ring%' AND customer_id % 3 <> 1 GROUP BY 1""")
def maintained_category_reach(spark, sf):
    """Revenue and customers by category, kept over a join: products move and go, customers' sales are deleted."""
    lines, orders = read_table(spark, "lineitem", sf), read_table(spark, "orders", sf)
    sales = (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .groupBy(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"), F.col("o_custkey").alias("customer_id"))
        .agg(F.round(F.sum("l_extendedprice"), 2).alias("amount"))
    )
    left, right = scratch(spark, "sales"), _parts(spark, sf)
    dml.create_or_replace(sales, left, ["order_id", "product_id"], at=AT[0])
    view = MaintainedJoin(
        spark, left, right, scratch(spark, "reach"), {"product_id": "p_partkey"}, {"category": F.col("r.p_type")},
        {"revenue": F.col("l.amount")}, {"unique_customers": F.col("l.customer_id")}, "decimal(18,2)",
    )
    view.refresh()
    dml.update(spark, right, "p_type = 'ECONOMY' AND p_size % 2 = 0", {"p_type": F.lit("SMALL")}, at=AT[1])
    dml.delete(spark, left, "customer_id % 3 = 1", at=AT[1])
    view.refresh()
    _drop_rings(spark, right)
    return view.refresh().withColumn("revenue", F.col("revenue").cast("double"))


@register("""SELECT n_name AS state, count(*) AS order_count, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total_revenue,
    count(DISTINCT o_custkey) AS customer_count FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON n_nationkey =
      CASE WHEN c_custkey % 10 = 3 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END
    WHERE o_orderstatus <> 'P' GROUP BY 1""")
def maintained_state_revenue(spark, sf):
    """Revenue and buyers by state, kept over a join: a tenth of the customers move, pending orders are cancelled."""
    customers = read_table(spark, "customer", sf).select("c_custkey", "c_nationkey")
    nations = read_table(spark, "nation", sf).select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("state"))
    left, right = _orders_by_status(spark, sf), scratch(spark, "customer")
    dml.create_or_replace(customers.join(nations, "c_nationkey"), right, ["c_custkey"], at=AT[0])
    view = MaintainedJoin(
        spark, left, right, scratch(spark, "states"), {"o_custkey": "c_custkey"}, {"state": F.col("r.state")},
        {"total_revenue": F.col("l.o_totalprice")}, {"customer_count": F.col("r.c_custkey")}, "decimal(18,2)",
    )
    view.refresh()
    moved = customers.where("c_custkey % 10 = 3").select("c_custkey", ((F.col("c_nationkey") + 1) % 25).alias("c_nationkey"))
    dml.merge(
        spark, right, moved.join(nations, "c_nationkey"), ["c_custkey"],
        matched_update={"state": F.col("s.state"), "c_nationkey": F.col("s.c_nationkey")}, at=AT[1],
    )
    dml.delete(spark, left, "o_orderstatus = 'P'", at=AT[1])
    rows = view.refresh()
    return rows.select("state", F.col("n").alias("order_count"), F.col("total_revenue").cast("double").alias("total_revenue"), "customer_count")


_TEXT_SCHEMA = (
    T.StructType().add("o_orderkey", "long").add("o_custkey", "long").add("o_orderstatus", "string")
    .add("o_totalprice", "double").add("o_orderpriority", "string")
)
_TEXT_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
    WHERE o_orderstatus <> 'P'"""


def _text_rows(spark, sf) -> DataFrame:
    return read_table(spark, "orders", sf).select(*_TEXT_SCHEMA.names)


@register(_TEXT_SQL)
def csv_rows(spark, sf):
    """Orders through CSV; pending ones are written with a price that is no number."""
    path = scratch(spark, "csv")
    price = F.when(F.col("o_orderstatus") == "P", "unpriced").otherwise(F.col("o_totalprice").cast("string"))
    _text_rows(spark, sf).withColumn("o_totalprice", price).write.option("header", "true").csv(path)
    return split_corrupt(read_csv(spark, path, _TEXT_SCHEMA, header="true"))[0]


@register("""SELECT 'malformed' AS reason, count(*) AS n FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT 'missing o_custkey', count(*) FROM orders WHERE o_orderstatus = 'O'""")
def json_dead_letters(spark, sf):
    """Orders through JSON lines: pending ones cut short, open ones without their customer."""
    path = scratch(spark, "json")
    rows = _text_rows(spark, sf).withColumn("o_custkey", F.when(F.col("o_orderstatus") != "O", F.col("o_custkey")))
    text = F.to_json(F.struct(*_TEXT_SCHEMA.names))
    rows.select(
        F.when(F.col("o_orderstatus") == "P", F.rtrim(text, F.lit("}"))).otherwise(text).alias("value")
    ).write.text(path)
    bad = split_corrupt(read_json(spark, path, _TEXT_SCHEMA), ["o_custkey"])[1]
    return bad.groupBy("reason").agg(F.count("*").alias("n"))


@register(_TEXT_SQL.replace("WHERE o_orderstatus <> 'P'", ""))
def json_rows(spark, sf):
    path = scratch(spark, "json")
    _text_rows(spark, sf).write.json(path)
    return split_corrupt(read_json(spark, path, _TEXT_SCHEMA))[0]
