"""Stand-in inputs: the driver's TPC-H-ish tables mapped onto the retail
inputs (orders, items, payments, customers, products, translation, sellers,
run log), with dirt injected by arithmetic on keys.

Each input exists twice: as a DataFrame built from the parquet scan (so
Catalyst prunes columns and pushes filters into the scan), and as SQL text
in the common subset of Spark SQL and DuckDB for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martline import schemas
from martline.session import table_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, with the schema that its files have now."""
    return spark.read.parquet(table_path(sf_dir, name))


_read = read_table


def _secs(n) -> F.Column:
    return F.make_dt_interval(secs=n)


def _days(n) -> F.Column:
    return F.make_dt_interval(days=n)


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    k, st, d = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderdate")
    sec = (k * 7919) % 86400
    return o.select(
        F.when(k % 101 != 0, k.cast("string")).alias("order_id"),
        F.when(k % 103 != 0, F.col("o_custkey").cast("string")).alias("customer_id"),
        F.when(st == "F", "delivered").when(st == "O", "shipped")
         .otherwise("processing").alias("order_status"),
        (d + _secs(sec)).alias("order_purchase_timestamp"),
        (d + _secs(sec + 900)).alias("order_approved_at"),
        F.when(st.isin("F", "O"), d + _days(1 + k % 5)).alias("order_delivered_carrier_date"),
        F.when(st == "F", d + _days(3 + k % 40)).alias("order_delivered_customer_date"),
        (d + _days(F.lit(20))).alias("order_estimated_delivery_date"),
    )


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem")
    pk = F.col("l_partkey")
    return li.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        pk.cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.when(pk % 97 == 0, -F.col("l_extendedprice"))
         .otherwise(F.col("l_extendedprice")).alias("price"),
        F.when(pk % 89 != 0, F.col("l_quantity")).alias("freight_value"),
    )


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem")
    rf = F.col("l_returnflag")
    k = F.col("l_orderkey")
    return li.select(
        F.when(k % 10 != 0, k.cast("string")).alias("order_id"),  # lost references: unpaid orders
        F.col("l_linenumber").alias("payment_sequential"),
        F.when(rf == "A", "credit_card").when(rf == "N", "boleto")
         .otherwise("voucher").alias("payment_type"),
        (F.col("l_partkey") % 12).cast("int").alias("payment_installments"),
        F.when(F.col("l_suppkey") % 53 == 0, -F.col("l_extendedprice"))
         .otherwise(F.col("l_extendedprice")).alias("payment_value"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    n = _read(spark, sf_dir, "nation")
    ck = F.col("c_custkey")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.concat(F.lit("  "), ck.cast("string"), F.lit(" ")).alias("customer_id"),
        (ck % 1200).cast("string").alias("customer_unique_id"),
        (1000 + ck % 90000).cast("int").alias("customer_zip_code_prefix"),
        F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" do sul  ")).alias("customer_city"),
        F.concat(F.lit(" "), F.lower("n_name")).alias("customer_state"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part")
    pk, size = F.col("p_partkey"), F.col("p_size")
    return p.select(
        pk.cast("string").alias("product_id"),
        F.when(pk % 17 != 0, F.concat(F.lit(" "), F.lower("p_type"))).alias("product_category_name"),
        F.length("p_name").cast("int").alias("product_name_lenght"),
        (F.length("p_name") * 10).cast("int").alias("product_description_lenght"),
        (pk % 6).cast("int").alias("product_photos_qty"),
        (size * 100).alias("product_weight_g"),
        size.alias("product_length_cm"),
        (size + 1).alias("product_height_cm"),
        (size + 2).alias("product_width_cm"),
    )


# The stand-in category translation table (Portuguese name ->
# English name), including a padded key and a padded value.
TRANSLATION_ROWS = [
    ("economy", "cheap"),
    ("large", "big_goods"),
    ("promo", "on_sale "),
    (" small", "little_goods"),
]


def raw_translation(spark: SparkSession, sf_dir: str | None = None) -> DataFrame:
    return spark.createDataFrame(TRANSLATION_ROWS, schemas.TRANSLATION)


def raw_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _read(spark, sf_dir, "supplier")
    n = _read(spark, sf_dir, "nation")
    return s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.col("s_suppkey").cast("string").alias("seller_id"),
        (1000 + F.col("s_suppkey")).cast("int").alias("seller_zip_code_prefix"),
        F.concat(F.lit(" porto de "), F.lower("n_name"), F.lit(" ")).alias("seller_city"),
        F.concat(F.lower("n_name"), F.lit(" ")).alias("seller_state"),
    )


def raw_runlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").cast("string").alias("run_id"),
        F.concat(F.col("event_type"), F.lit("_"), F.col("event_id").cast("string")).alias("task_id"),
        F.col("ts").alias("start_date"),
        (F.col("ts") + _secs(F.floor("value").cast("int"))).alias("end_date"),
        F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("state"),
    )


RAW = {
    "orders": raw_orders,
    "items": raw_items,
    "payments": raw_payments,
    "customers": raw_customers,
    "products": raw_products,
    "translation": raw_translation,
    "sellers": raw_sellers,
    "runlog": raw_runlog,
}


# --- the same inputs as SQL text (DuckDB oracle) --------------------------------

SQL = {
    "orders": """
SELECT CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS order_id,
       CASE WHEN o_orderkey % 103 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
       CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'processing' END AS order_status,
       o_orderdate + (o_orderkey * 7919 % 86400) * INTERVAL '1' SECOND AS order_purchase_timestamp,
       o_orderdate + (o_orderkey * 7919 % 86400 + 900) * INTERVAL '1' SECOND AS order_approved_at,
       CASE WHEN o_orderstatus IN ('F', 'O') THEN o_orderdate + (1 + o_orderkey % 5) * INTERVAL '1' DAY END AS order_delivered_carrier_date,
       CASE WHEN o_orderstatus = 'F' THEN o_orderdate + (3 + o_orderkey % 40) * INTERVAL '1' DAY END AS order_delivered_customer_date,
       o_orderdate + 20 * INTERVAL '1' DAY AS order_estimated_delivery_date
FROM orders""",
    "items": """
SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
       l_linenumber AS order_item_id,
       CAST(l_partkey AS VARCHAR) AS product_id,
       CAST(l_suppkey AS VARCHAR) AS seller_id,
       l_shipdate AS shipping_limit_date,
       CASE WHEN l_partkey % 97 = 0 THEN -l_extendedprice ELSE l_extendedprice END AS price,
       CASE WHEN l_partkey % 89 = 0 THEN NULL ELSE l_quantity END AS freight_value
FROM lineitem""",
    "payments": """
SELECT CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE CAST(l_orderkey AS VARCHAR) END AS order_id,
       l_linenumber AS payment_sequential,
       CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto' ELSE 'voucher' END AS payment_type,
       CAST(l_partkey % 12 AS INT) AS payment_installments,
       CASE WHEN l_suppkey % 53 = 0 THEN -l_extendedprice ELSE l_extendedprice END AS payment_value
FROM lineitem""",
    "customers": """
SELECT '  ' || CAST(c_custkey AS VARCHAR) || ' ' AS customer_id,
       CAST(c_custkey % 1200 AS VARCHAR) AS customer_unique_id,
       CAST(1000 + c_custkey % 90000 AS INT) AS customer_zip_code_prefix,
       ' ' || lower(c_mktsegment) || ' do sul  ' AS customer_city,
       ' ' || lower(n_name) AS customer_state
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "products": """
SELECT CAST(p_partkey AS VARCHAR) AS product_id,
       CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE ' ' || lower(p_type) END AS product_category_name,
       CAST(length(p_name) AS INT) AS product_name_lenght,
       CAST(length(p_name) * 10 AS INT) AS product_description_lenght,
       CAST(p_partkey % 6 AS INT) AS product_photos_qty,
       p_size * 100 AS product_weight_g,
       p_size AS product_length_cm,
       p_size + 1 AS product_height_cm,
       p_size + 2 AS product_width_cm
FROM part""",
    "translation": """
SELECT * FROM (VALUES ('economy', 'cheap'), ('large', 'big_goods'), ('promo', 'on_sale '), (' small', 'little_goods'))
AS t(product_category_name, product_category_name_english)""",
    "sellers": """
SELECT CAST(s_suppkey AS VARCHAR) AS seller_id,
       CAST(1000 + s_suppkey AS INT) AS seller_zip_code_prefix,
       ' porto de ' || lower(n_name) || ' ' AS seller_city,
       lower(n_name) || ' ' AS seller_state
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "runlog": """
SELECT CAST(user_id AS VARCHAR) AS run_id,
       event_type || '_' || CAST(event_id AS VARCHAR) AS task_id,
       ts AS start_date,
       ts + CAST(floor(value) AS INT) * INTERVAL '1' SECOND AS end_date,
       CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS state
FROM events""",
}
