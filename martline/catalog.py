"""Registered queries: ``QUERIES[name](spark, sf_dir) -> DataFrame`` and the
matching DuckDB oracle text ``ORACLE[name]``. Column names are aliased alike
on both sides; summed money is rounded to cents on both sides (double sums
depend on the order of addition)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martline import oracle, schemas
from martline.functions.text import clean_text, code_text, composite_key, title_text
from martline.functions.time import calendar_days
from martline.operators.dedup import first_per_key
from martline.operators.dense_key import dense_key
from martline.operators.incremental_key import KeyStore
from martline.operators.filters import dropna_subset, filter_non_negative, filter_not_null
from martline.operators.sample import sample_head
from martline.plans import (
    clean,
    copartitioned,
    dims,
    facts,
    maintained,
    quality,
    quality_state,
    rfm,
    runlog,
    stage,
    unvalidated,
)
from martline.plans import warehouse as wh
from martline.session import scratch_path, written
from martline.sources import files, fixtures, infer, jdbc
from martline.sources.bucketed import buckets_for
from martline.streaming import replay
from martline.streaming import upsert as _upsert
from martline.streaming import watermark
from martline.streaming.sources import file_stream, message_file_stream, message_files, write_messages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def cents(*cols: str, digits: int = 2):
    return {c: F.round(F.col(c), digits) for c in cols}


# ---- composite data products ---------------------------------------------------

@register("payments_agg", oracle.sql(
    "SELECT order_id, round(total_payment_value, 2) AS total_payment_value, payment_count, "
    "max_installments FROM payments_agg", "payments_agg"))
def q_payments_agg(spark, sf_dir):
    return wh.payments_agg(spark, sf_dir).withColumns(cents("total_payment_value"))


for _e in ["orders", "items", "payments"]:
    register(f"clean_{_e}", oracle.sql(f"SELECT * FROM clean_{_e}", f"clean_{_e}"))(
        lambda spark, sf_dir, e=_e: wh.cleaned(spark, sf_dir, e))
    # Full consumer path: producer cleaning -> JSON messages -> parse ->
    # consumer rules -> one row per key.
    register(f"stage_{_e}", oracle.sql(f"SELECT * FROM staged_{_e}", f"staged_{_e}"))(
        lambda spark, sf_dir, e=_e: stage.from_messages(
            e, stage.encode(e, wh.cleaned(spark, sf_dir, e))))


@register("dim_customer", oracle.sql("SELECT * FROM dim_customer", "dim_customer"))
def q_dim_customer(spark, sf_dir):
    return wh.dim_customer(spark, sf_dir)


@register("dim_product", oracle.sql("SELECT * FROM dim_product", "dim_product"))
def q_dim_product(spark, sf_dir):
    return wh.dim_product(spark, sf_dir)


@register("dim_seller", oracle.sql("SELECT * FROM dim_seller", "dim_seller"))
def q_dim_seller(spark, sf_dir):
    return wh.dim_seller(spark, sf_dir)


@register("fact_sales", oracle.sql("SELECT * FROM fact_sales", "fact_sales"))
def q_fact_sales(spark, sf_dir):
    return wh.fact_sales(spark, sf_dir)


@register("fact_sales_enriched", oracle.sql(
    "SELECT * REPLACE (round(total_payment_value, 2) AS total_payment_value, "
    "round(avg_payment_value, 4) AS avg_payment_value) FROM fact_sales_enriched",
    "fact_sales_enriched"))
def q_fact_sales_enriched(spark, sf_dir):
    # An average of cents can sit exactly on a half cent, where the last bit
    # of an order-dependent sum decides the rounding: compare it at 4 digits.
    return (wh.fact_sales(spark, sf_dir, enriched=True)
            .withColumns(cents("total_payment_value"))
            .withColumns(cents("avg_payment_value", digits=4)))


@register("fact_sales_copartitioned", ORACLE["fact_sales_enriched"])
def q_fact_sales_copartitioned(spark, sf_dir):
    """The enriched fact from order tables bucketed alike: the joins on the
    order read the buckets as they lie."""
    bounds = wh.input_bounds(spark, sf_dir)
    tables = copartitioned.OrderTables.stage(
        spark, scratch_path(spark, "order-tables"), *(wh.staged(spark, sf_dir, e) for e in ("orders", "items", "payments")),
        dims=(wh.dim_customer(spark, sf_dir, bounds), wh.dim_product(spark, sf_dir, bounds), wh.dim_seller(spark, sf_dir, bounds)),
        buckets=buckets_for(bounds["items"], 16))
    fact = copartitioned.sales(tables, size_hint=bounds["items"],
                               sample_src=wh.raw(spark, sf_dir, "items").select("order_id", "order_item_id"))
    return fact.withColumns(cents("total_payment_value")).withColumns(cents("avg_payment_value", digits=4))


@register("payments_agg_maintained", ORACLE["payments_agg"])
def q_payments_agg_maintained(spark, sf_dir):
    """Payment totals kept up over changes. Before: no vouchers yet, the boletos
    with other values, the card payments twice. Then the vouchers come, the
    boletos are corrected, the second card payments go; many maxima with them."""
    now = written(wh.staged(spark, sf_dir, "payments"), "payments-now")
    boletos, cards = (now.where(F.col("payment_type") == t) for t in ("boleto", "credit_card"))
    wrong = boletos.withColumns({"payment_value": F.col("payment_value") + 10, "payment_installments": F.col("payment_installments") + 20})
    twice = cards.withColumn("payment_installments", F.col("payment_installments") + 30)
    before = wrong.unionByName(cards).unionByName(twice)
    totals = maintained.PaymentTotals(spark, scratch_path(spark, "payment-totals"), buckets=8)
    totals.apply(maintained.signed(before, 1), before, 1)
    changes = [(now.where(F.col("payment_type") == "voucher"), 1), (wrong, -1), (boletos, 1), (twice, -1)]
    signed = [maintained.signed(df, sign) for df, sign in changes]
    totals.apply(signed[0].unionByName(signed[1]).unionByName(signed[2]).unionByName(signed[3]), now, 2)
    return totals.totals().withColumns(cents("total_payment_value"))


# ---- quality ---------------------------------------------------------------------

_QC_BODY = """
SELECT c.check_name AS "check", c.result, CAST(0 AS BIGINT) AS expected, c.result = 0 AS passed
FROM ({rows}) c"""


def _qc_sql(table: str, checks: list[tuple[str, str]]) -> str:
    rows = " UNION ALL ".join(f"SELECT '{n}' AS check_name, CAST(({q}) AS BIGINT) AS result"
                              for n, q in checks)
    return _QC_BODY.format(rows=rows)


def _dup_sql(table: str, cols: str) -> str:
    return (f"SELECT count(*) FROM (SELECT {cols} FROM {table} GROUP BY {cols} "
            f"HAVING count(*) > 1) t")


@register("quality_fact_sales", oracle.sql(_qc_sql("fact_sales", [
    ("null_customer_key_count", "SELECT count(*) FROM fact_sales WHERE customer_key IS NULL"),
    ("null_product_key_count", "SELECT count(*) FROM fact_sales WHERE product_key IS NULL"),
    ("null_seller_key_count", "SELECT count(*) FROM fact_sales WHERE seller_key IS NULL"),
    ("duplicate_order_item_rows", _dup_sql("fact_sales", "order_id, order_item_id")),
    ("negative_gross_sales_rows", "SELECT count(*) FROM fact_sales WHERE gross_sales_value < 0"),
    ("negative_freight_rows", "SELECT count(*) FROM fact_sales WHERE freight_value < 0"),
]), "fact_sales"))
def q_quality_fact_sales(spark, sf_dir):
    return quality.run(wh.fact_sales(spark, sf_dir), quality.fact_sales_checks())


@register("quality_fact_sales_enriched", oracle.sql(_qc_sql("fact_sales_enriched", [
    ("negative_payment_rows",
     "SELECT count(*) FROM fact_sales_enriched WHERE total_payment_value < 0"),
    ("duplicate_order_item_rows", _dup_sql("fact_sales_enriched", "order_id, order_item_id")),
    ("mismatched_payment_count",
     "SELECT count(*) FROM fact_sales_enriched WHERE payment_count < 0"),
]), "fact_sales_enriched"))
def q_quality_fact_sales_enriched(spark, sf_dir):
    return quality.run(wh.fact_sales(spark, sf_dir, enriched=True),
                       quality.fact_sales_enriched_checks())


_DIRTY_ITEMS = ("SELECT *, 1 AS delivery FROM raw_items UNION ALL SELECT *, 2 FROM raw_items "
                f"WHERE shipping_limit_date >= TIMESTAMP '{unvalidated.DELIVERED_TWICE_FROM}'")
oracle._def("dirty_fact", ["raw_items", "raw_orders", "raw_payments", "dim_customer", "dim_product", "dim_seller"], f"""
SELECT i.order_id, i.order_item_id, o.customer_id, i.product_id, i.seller_id,
       c.customer_key, p.product_key, s.seller_key, i.price + i.freight_value AS gross_sales_value,
       i.freight_value * sign(i.price) AS freight_value, t.total_payment_value, t.payment_count
FROM ({_DIRTY_ITEMS}) i JOIN raw_orders o ON i.order_id = o.order_id
LEFT JOIN (SELECT order_id, sum(payment_value) AS total_payment_value, sum(sign(payment_value)) AS payment_count
           FROM raw_payments GROUP BY order_id) t ON i.order_id = t.order_id
LEFT JOIN dim_customer c ON o.customer_id = c.customer_id
LEFT JOIN dim_product p ON i.product_id = p.product_id AND p.product_category_name IS NOT NULL
LEFT JOIN dim_seller s ON i.seller_id = s.seller_id AND s.seller_state <> '{unvalidated.LOST_SELLERS_STATE}'""")

_DIRTY_SQL = oracle.sql(_qc_sql("dirty_fact", [
    *((f"null_{d}_key_count", f"SELECT count(*) FROM dirty_fact WHERE {d}_key IS NULL")
      for d in ("customer", "product", "seller")),
    ("negative_gross_sales_rows", "SELECT count(*) FROM dirty_fact WHERE gross_sales_value < 0"),
    ("negative_freight_rows", "SELECT count(*) FROM dirty_fact WHERE freight_value < 0"),
    ("negative_payment_rows", "SELECT count(*) FROM dirty_fact WHERE total_payment_value < 0"),
    ("mismatched_payment_count", "SELECT count(*) FROM dirty_fact WHERE payment_count < 0"),
    *((f"duplicate_{n}_rows", _dup_sql("dirty_fact", cols)) for n, cols in (
        ("order_item", "order_id, order_item_id"), ("order", "order_id"),
        ("customer_product", "customer_id, product_id"), ("order_seller", "order_id, seller_id"))),
]), "dirty_fact")


@register("quality_unvalidated_fact", _DIRTY_SQL)
def q_quality_unvalidated_fact(spark, sf_dir):
    """The checks of both facts and four key sets, in one scan of the facts as
    they would be without the cleaning rules: every check fails."""
    first, again = unvalidated.deliveries(spark, sf_dir)
    return quality.run(unvalidated.fact(spark, sf_dir, first.unionByName(again)), unvalidated.checks())


@register("quality_over_loads", _DIRTY_SQL)
def q_quality_over_loads(spark, sf_dir):
    """The same from the merged states of two loads, each read once. The
    duplicates lie across the loads."""
    checks = unvalidated.checks()
    sets = sum(kind == "duplicate_keys" for _, kind, _ in checks)  # a row of state for each key of each set
    state = quality_state.QualityState(spark, scratch_path(spark, "quality-state"), checks,
                                       buckets=buckets_for(sets * wh.input_bounds(spark, sf_dir, "items")["items"], 8))
    for load, items in enumerate(unvalidated.deliveries(spark, sf_dir), 1):
        state.add(unvalidated.fact(spark, sf_dir, items), load)
    return state.results()


# ---- filters, dedup, projections, scalars --------------------------------------------

@register("filter_not_null", oracle.sql(
    "SELECT * FROM raw_orders WHERE order_id IS NOT NULL AND customer_id IS NOT NULL",
    "raw_orders"))
def q_filter_not_null(spark, sf_dir):
    return filter_not_null(wh.raw(spark, sf_dir, "orders"), ["order_id", "customer_id"])


@register("filter_non_negative", oracle.sql(
    "SELECT * FROM raw_items WHERE price >= 0 AND freight_value >= 0", "raw_items"))
def q_filter_non_negative(spark, sf_dir):
    return filter_non_negative(wh.raw(spark, sf_dir, "items"), ["price", "freight_value"])


@register("dropna_subset", oracle.sql(
    "SELECT * FROM raw_items WHERE order_id IS NOT NULL AND order_item_id IS NOT NULL AND "
    "product_id IS NOT NULL AND seller_id IS NOT NULL AND price IS NOT NULL AND "
    "freight_value IS NOT NULL", "raw_items"))
def q_dropna_subset(spark, sf_dir):
    return dropna_subset(wh.raw(spark, sf_dir, "items"), clean.ITEMS_REQUIRED)


_ITEM_RULE_SQL = [
    ("order_id_is_null", "order_id IS NULL"),
    ("order_item_id_is_null", "order_item_id IS NULL"),
    ("product_id_is_null", "product_id IS NULL"),
    ("seller_id_is_null", "seller_id IS NULL"),
    ("price_is_null", "price IS NULL"),
    ("freight_value_is_null", "freight_value IS NULL"),
    ("price_negative_or_null", "price IS NULL OR price < 0"),
    ("freight_value_negative_or_null", "freight_value IS NULL OR freight_value < 0"),
]


@register("stage_rejects", oracle.sql(
    "SELECT * FROM (SELECT *, concat_ws(',', "
    + ", ".join(f"CASE WHEN {p} THEN '{n}' END" for n, p in _ITEM_RULE_SQL)
    + ") AS reject_reasons FROM raw_items) r WHERE reject_reasons <> ''", "raw_items"))
def q_stage_rejects(spark, sf_dir):
    rej = stage.reject_rows("items", wh.raw(spark, sf_dir, "items"))
    return rej.withColumn("reject_reasons", F.concat_ws(",", "reject_reasons"))


_ORDER_RULE_SQL = [("order_id_is_null", "order_id IS NULL"),
                   ("customer_id_is_null", "customer_id IS NULL")]
_PAYMENT_RULE_SQL = [
    ("order_id_is_null", "order_id IS NULL"),
    ("payment_sequential_is_null", "payment_sequential IS NULL"),
    ("payment_value_negative_or_null", "payment_value IS NULL OR payment_value < 0"),
    ("payment_installments_negative_or_null",
     "payment_installments IS NULL OR payment_installments < 0"),
]

for _e, _rules in [("orders", _ORDER_RULE_SQL), ("payments", _PAYMENT_RULE_SQL)]:
    register(f"stage_rejects_{_e}", oracle.sql(
        "SELECT * FROM (SELECT *, concat_ws(',', "
        + ", ".join(f"CASE WHEN {p} THEN '{n}' END" for n, p in _rules)
        + f") AS reject_reasons FROM raw_{_e}) r WHERE reject_reasons <> ''", f"raw_{_e}"))(
        lambda spark, sf_dir, e=_e: stage.reject_rows(e, wh.raw(spark, sf_dir, e))
        .withColumn("reject_reasons", F.concat_ws(",", "reject_reasons")))


@register("dedup_items", oracle.sql("""
SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date, price, freight_value
FROM (SELECT *, row_number() OVER (PARTITION BY order_id, order_item_id ORDER BY product_id NULLS LAST,
        seller_id NULLS LAST, shipping_limit_date NULLS LAST, price NULLS LAST,
        freight_value NULLS LAST) AS rn FROM raw_items) x
WHERE rn = 1""", "raw_items"))
def q_dedup_items(spark, sf_dir):
    return first_per_key(wh.raw(spark, sf_dir, "items"), schemas.KEYS["items"],
                         clean.ITEMS_TIEBREAK)


@register("project_products", oracle.sql(
    "SELECT trim(product_id) AS product_id, CAST(product_name_lenght AS INT) AS product_name_length, "
    "CAST(product_description_lenght AS INT) AS product_description_length FROM raw_products",
    "raw_products"))
def q_project_products(spark, sf_dir):
    p = wh.raw(spark, sf_dir, "products")
    return p.select(clean_text("product_id").alias("product_id"),
                    F.col("product_name_lenght").cast("int").alias("product_name_length"),
                    F.col("product_description_lenght").cast("int")
                    .alias("product_description_length"))


@register("try_cast_nulls", oracle.sql(
    "SELECT order_id, TRY_CAST(order_id AS INTEGER) AS order_id_int, "
    "TRY_CAST(order_status AS INTEGER) AS order_status_int, "
    "TRY_CAST(order_status AS DOUBLE) AS order_status_double FROM raw_orders", "raw_orders"))
def q_try_cast_nulls(spark, sf_dir):
    o = wh.raw(spark, sf_dir, "orders")
    return o.select("order_id", F.col("order_id").try_cast("int").alias("order_id_int"),
                    F.col("order_status").try_cast("int").alias("order_status_int"),
                    F.col("order_status").try_cast("double").alias("order_status_double"))


@register("scalar_strings", oracle.sql(
    f"SELECT trim(customer_id) AS customer_id, {oracle.initcap('trim(customer_city)')} AS customer_city, "
    "upper(trim(customer_state)) AS customer_state FROM raw_customers", "raw_customers"))
def q_scalar_strings(spark, sf_dir):
    c = wh.raw(spark, sf_dir, "customers")
    return c.select(clean_text("customer_id").alias("customer_id"),
                    title_text("customer_city").alias("customer_city"),
                    code_text("customer_state").alias("customer_state"))


@register("composite_key", oracle.sql(
    "SELECT order_id, customer_id, order_id || '_' || customer_id AS message_key FROM raw_orders",
    "raw_orders"))
def q_composite_key(spark, sf_dir):
    o = wh.raw(spark, sf_dir, "orders")
    return o.select("order_id", "customer_id",
                    composite_key("order_id", "customer_id").alias("message_key"))


@register("delivery_metrics", oracle.sql("""
SELECT order_id,
       CAST(date_diff('day', order_purchase_timestamp, order_delivered_customer_date) AS INT) AS delivery_days,
       CAST(date_diff('day', order_purchase_timestamp, order_estimated_delivery_date) AS INT) AS estimated_delivery_days,
       CASE WHEN order_delivered_customer_date > order_estimated_delivery_date THEN 1 ELSE 0 END AS is_delayed
FROM staged_orders""", "staged_orders"))
def q_delivery_metrics(spark, sf_dir):
    o = wh.staged(spark, sf_dir, "orders")
    return o.select(
        "order_id",
        calendar_days("order_delivered_customer_date", "order_purchase_timestamp").alias("delivery_days"),
        calendar_days("order_estimated_delivery_date", "order_purchase_timestamp")
        .alias("estimated_delivery_days"),
        F.when(F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date"), 1)
        .otherwise(0).alias("is_delayed"))


# ---- joins ---------------------------------------------------------------------------

@register("join_items_orders", oracle.sql(
    "SELECT i.*, o.customer_id, o.order_status, o.order_purchase_timestamp, o.order_approved_at, "
    "o.order_delivered_carrier_date, o.order_delivered_customer_date, o.order_estimated_delivery_date "
    "FROM staged_items i JOIN staged_orders o ON i.order_id = o.order_id",
    "staged_items", "staged_orders"))
def q_join_items_orders(spark, sf_dir):
    return wh.staged(spark, sf_dir, "items").join(wh.staged(spark, sf_dir, "orders"), "order_id")


@register("join_dim_keys", oracle.sql(
    "SELECT i.order_id, i.order_item_id, dc.customer_key, dp.product_key, ds.seller_key "
    "FROM staged_items i JOIN staged_orders o ON i.order_id = o.order_id "
    "LEFT JOIN dim_customer dc ON o.customer_id = dc.customer_id "
    "LEFT JOIN dim_product dp ON i.product_id = dp.product_id "
    "LEFT JOIN dim_seller ds ON i.seller_id = ds.seller_id",
    "staged_items", "staged_orders", "dim_customer", "dim_product", "dim_seller"))
def q_join_dim_keys(spark, sf_dir):
    i = wh.staged(spark, sf_dir, "items").select("order_id", "order_item_id", "product_id", "seller_id")
    o = wh.staged(spark, sf_dir, "orders").select("order_id", "customer_id")
    return (i.join(o, "order_id")
            .join(wh.dim_customer(spark, sf_dir).select("customer_key", "customer_id"), "customer_id", "left")
            .join(wh.dim_product(spark, sf_dir).select("product_key", "product_id"), "product_id", "left")
            .join(wh.dim_seller(spark, sf_dir).select("seller_key", "seller_id"), "seller_id", "left")
            .select("order_id", "order_item_id", "customer_key", "product_key", "seller_key"))


@register("join_translation", oracle.sql(
    "SELECT trim(p.product_id) AS product_id, trim(p.product_category_name) AS product_category_name_pt, "
    "coalesce(t.en, trim(p.product_category_name)) AS product_category_name "
    "FROM raw_products p LEFT JOIN translation t ON trim(p.product_category_name) = t.pt",
    "raw_products", "translation"))
def q_join_translation(spark, sf_dir):
    from martline.operators.joins import bounded_broadcast
    p = wh.raw(spark, sf_dir, "products").select(
        clean_text("product_id").alias("product_id"),
        clean_text("product_category_name").alias("product_category_name_pt"))
    t = bounded_broadcast(dims.translation(wh.raw(spark, sf_dir, "translation")),
                          dims.TRANSLATION_BROADCAST_MAX_ROWS)
    return (p.join(t, "product_category_name_pt", "left")
            .select("product_id", "product_category_name_pt",
                    F.coalesce("product_category_name_en", "product_category_name_pt")
                    .alias("product_category_name")))


# ---- aggregates, windows, sort ---------------------------------------------------------

@register("row_counts", oracle.sql(
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}"
        for n in ["raw_orders", "raw_items", "raw_payments",
                  "staged_orders", "staged_items", "staged_payments"]) + ") t",
    "raw_orders", "raw_items", "raw_payments", "staged_orders", "staged_items", "staged_payments"))
def q_row_counts(spark, sf_dir):
    frames = {f"raw_{e}": wh.raw(spark, sf_dir, e) for e in ["orders", "items", "payments"]}
    frames.update({f"staged_{e}": wh.staged(spark, sf_dir, e) for e in ["orders", "items", "payments"]})
    return quality.reconcile(frames).withColumnRenamed("stage", "table_name")


@register("dup_keys", oracle.sql(
    "SELECT 'raw_items' AS table_name, (" + _dup_sql("raw_items", "order_id, order_item_id")
    + ") AS duplicate_keys UNION ALL SELECT 'raw_payments', ("
    + _dup_sql("raw_payments", "order_id, payment_sequential") + ")",
    "raw_items", "raw_payments"))
def q_dup_keys(spark, sf_dir):
    out = None
    for e in ["items", "payments"]:
        d = (wh.raw(spark, sf_dir, e).groupBy(*schemas.KEYS[e]).count()
             .agg(F.count_if(F.col("count") > 1).alias("duplicate_keys"))
             .select(F.lit(f"raw_{e}").alias("table_name"), "duplicate_keys"))
        out = d if out is None else out.unionByName(d)
    return out


@register("dense_key_single", oracle.sql(
    "SELECT CAST(row_number() OVER (ORDER BY order_id) AS INT) AS order_key, order_id, customer_id "
    "FROM staged_orders", "staged_orders"))
def q_dense_key_single(spark, sf_dir):
    raw = wh.raw(spark, sf_dir, "orders")
    o = wh.staged(spark, sf_dir, "orders").select("order_id", "customer_id")
    return dense_key(o, ["order_id"], "order_key", size_hint=raw.count(),
                     sample_src=raw.select("order_id"))


@register("dense_key_composite", oracle.sql(
    "SELECT CAST(row_number() OVER (ORDER BY order_id, order_item_id) AS INT) AS item_key, "
    "order_id, order_item_id FROM staged_items", "staged_items"))
def q_dense_key_composite(spark, sf_dir):
    raw = wh.raw(spark, sf_dir, "items")
    i = wh.staged(spark, sf_dir, "items").select("order_id", "order_item_id")
    return dense_key(i, ["order_id", "order_item_id"], "item_key", size_hint=raw.count(),
                     sample_src=raw.select("order_id", "order_item_id"))


def _two_loads(spark, rows, keys, first, name, **opts):
    """Keys after a load of the rows where ``first`` and a load of all rows."""
    rows = written(rows.select(*keys, F.coalesce(first, F.lit(False)).alias("_first")), "key-loads")
    store = KeyStore(spark, scratch_path(spark, "key-store"), rows.select(*keys).schema, name, buckets=8, **opts)
    store.load(rows.where("_first"))
    return store.load(rows).drop("load")


def _two_loads_sql(table: str, keys: str, name: str, first: str) -> str:
    """Keys of the first load's rows, then of the others, from there on."""
    return (f"SELECT {keys}, CAST(row_number() OVER (ORDER BY CASE WHEN {first} THEN 0 ELSE 1 END, {keys}) AS BIGINT) "
            f"AS {name} FROM {table}")


@register("dense_key_second_load", oracle.sql(
    _two_loads_sql("staged_orders", "order_id", "order_key", "coalesce(order_status = 'delivered', false)"), "staged_orders"))
def q_dense_key_second_load(spark, sf_dir):
    """Persistent order keys: the delivered orders are loaded, then all orders;
    the second load keys the others only, from the highest key on."""
    orders = wh.staged(spark, sf_dir, "orders")
    return _two_loads(spark, orders, ["order_id"], F.col("order_status") == "delivered", "order_key")


_EARLY = "1998-06-01"


@register("dense_key_second_load_items", oracle.sql(
    _two_loads_sql("staged_items", "order_id, order_item_id", "item_key",
                   f"coalesce(shipping_limit_date < TIMESTAMP '{_EARLY}', false)"), "staged_items"))
def q_dense_key_second_load_items(spark, sf_dir):
    """Persistent keys over two columns: the items shipped early, then all; the
    new boundaries of the second load are taken as the first are too coarse."""
    early = F.col("shipping_limit_date") < F.lit(_EARLY).cast("timestamp_ntz")
    return _two_loads(spark, wh.staged(spark, sf_dir, "items"), ["order_id", "order_item_id"], early, "item_key",
                      rows_per_bucket=1 << 14)


@register("sample_head", oracle.sql(
    f"SELECT * FROM clean_orders ORDER BY order_purchase_timestamp NULLS LAST, order_id NULLS LAST, "
    f"customer_id NULLS LAST, order_status NULLS LAST, order_approved_at NULLS LAST, "
    f"order_delivered_carrier_date NULLS LAST, order_delivered_customer_date NULLS LAST, "
    f"order_estimated_delivery_date NULLS LAST LIMIT 100", "clean_orders"))
def q_sample_head(spark, sf_dir):
    return sample_head(wh.cleaned(spark, sf_dir, "orders"), clean.SEND_ORDER["orders"], 100)


# ---- streaming -------------------------------------------------------------------------


# Full scenario: even keys, odd keys, replay, replay with updates, malformed;
# the consumer restarts from its checkpoint after each batch.
_ALL_STEPS = [[0], [1], [2], [3], [4]]

for _e in ["orders", "items", "payments"]:
    register(f"upsert_{_e}", oracle.sql(f"SELECT * FROM staged_{_e}", f"staged_{_e}"))(
        lambda spark, sf_dir, e=_e: replay.run_scenario(spark, sf_dir, e, "first", _ALL_STEPS))


_SHIPPED = ("SELECT * REPLACE (CASE WHEN order_status = 'shipped' THEN 'delivered' ELSE order_status END "
            "AS order_status) FROM staged_orders")
for _e, _sql in (("orders", _SHIPPED),
                 ("items", "SELECT * REPLACE (price + 1.0 AS price) FROM staged_items"),
                 ("payments", "SELECT * REPLACE (payment_value + 1.0 AS payment_value) FROM staged_payments")):
    register(f"upsert_{_e}_last", oracle.sql(_sql, f"staged_{_e}"))(
        lambda spark, sf_dir, e=_e: replay.run_scenario(spark, sf_dir, e, "last", _ALL_STEPS))


def _both_policies(spark, sf_dir, steps, **how):
    """Orders staged under both policies, told apart by ``policy``."""
    return (replay.run_scenario(spark, sf_dir, "orders", "first", steps, **how)
            .select(F.lit("first").alias("policy"), "order_id", "order_status")
            .unionByName(replay.run_scenario(spark, sf_dir, "orders", "last", steps, **how)
                         .select(F.lit("last").alias("policy"), "order_id", "order_status")))


_BOTH_SQL = oracle.sql(
    "SELECT 'first' AS policy, order_id, order_status FROM staged_orders UNION ALL "
    f"SELECT 'last', order_id, order_status FROM ({_SHIPPED}) u", "staged_orders")


@register("upsert_update_in_batch", _BOTH_SQL)
def q_upsert_update_in_batch(spark, sf_dir):
    """Originals and updates in one micro-batch, both policies."""
    return _both_policies(spark, sf_dir, [[2, 3]])


@register("upsert_lost_checkpoint", _BOTH_SQL)
def q_upsert_lost_checkpoint(spark, sf_dir):
    """A new checkpoint at every step: all messages are read again each time,
    and batch ids restart."""
    return _both_policies(spark, sf_dir, [[0], [1], [3]], lose_checkpoint=True)


@register("upsert_recreated_topic", _BOTH_SQL)
def q_upsert_recreated_topic(spark, sf_dir):
    """A new folder of messages at every step, where places start anew: the
    message time keeps the order."""
    return _both_policies(spark, sf_dir, [[2], [3]], recreate_topic=True)


@register("stream_rejects", oracle.sql(
    "SELECT reject_reasons, count(*) AS row_count FROM ("
    "SELECT 'order_id,customer_id' AS reject_reasons FROM clean_orders "
    "UNION ALL SELECT 'customer_id' FROM clean_orders) t GROUP BY 1", "clean_orders"))
def q_stream_rejects(spark, sf_dir):
    """Malformed messages kept in the reject stream, by the rules they break:
    truncated JSON lacks both keys, the other half lacks its customer."""
    root, bad, target = (scratch_path(spark, n) for n in ("topic-orders", "rejects", "staging"))
    replay.write_batches("orders", replay.cleaned_table(spark, sf_dir, "orders"), root, [0, 4])
    from martline.streaming import consumer
    consumer.drain("orders", message_file_stream(spark, root), target, scratch_path(spark, "ckpt"), rejects=bad)
    names = F.transform("reject_reasons", lambda r: F.regexp_extract(r, "[a-z_]+_id", 0))
    return (consumer.rejected(spark, target, bad).select(F.array_join(names, ",").alias("reject_reasons"))
            .groupBy("reject_reasons").agg(F.count(F.lit(1)).alias("row_count")))


@register("stream_replay_idempotent", oracle.sql(
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT 'staged_{e}' AS table_name, count(*) AS row_count FROM staged_{e}"
        for e in ["orders", "items", "payments"]) + ") t",
    "staged_orders", "staged_items", "staged_payments"))
def q_stream_replay_idempotent(spark, sf_dir):
    out = None
    for e in ["orders", "items", "payments"]:
        t = replay.run_scenario(spark, sf_dir, e, "last", [[0, 1], [2]])
        c = t.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(f"staged_{e}").alias("table_name"), "row_count")
        out = c if out is None else out.unionByName(c)
    return out


@register("stream_restart_exactly_once", oracle.sql("SELECT * FROM staged_orders", "staged_orders"))
def q_stream_restart_exactly_once(spark, sf_dir):
    """Drain, restart with nothing new, re-run batch 1's body as a retry of
    the same batch id, then a replay: the table must equal one clean load."""
    from martline.streaming import consumer, upsert
    root = scratch_path(spark, "topic-orders")
    target = scratch_path(spark, "staging-orders")
    ckpt = scratch_path(spark, "ckpt-orders")
    orders = replay.cleaned_table(spark, sf_dir, "orders")
    replay.write_batches("orders", orders, root, [0])
    consumer.drain("orders", message_file_stream(spark, root), target, ckpt)
    replay.write_batches("orders", orders, root, [1])
    consumer.drain("orders", message_file_stream(spark, root), target, ckpt)
    consumer.drain("orders", message_file_stream(spark, root), target, ckpt)
    # A foreachBatch retry: batch id 1 again with the same input rows.
    batch1 = message_files(spark, f"{root}/1-*")
    parsed = stage.validate("orders", consumer.parsed_stream("orders", batch1))
    upsert.write_batch(parsed, 1, target, schemas.KEYS["orders"],
                       stage.TABLE_SCHEMA["orders"].names, "first",
                       consumer._stream_id(spark, ckpt))
    replay.write_batches("orders", orders, root, [2])
    consumer.drain("orders", message_file_stream(spark, root), target, ckpt)
    return consumer.staged_table(spark, "orders", target).drop("kafka_ingested_at")


@register("stream_parse_orders", oracle.sql("SELECT * FROM staged_orders", "staged_orders"))
def q_stream_parse_orders(spark, sf_dir):
    """Bytes -> text -> struct -> columns, rules applied, malformed dropped;
    written by the exactly-once file sink."""
    root = scratch_path(spark, "topic-orders")
    replay.write_batches("orders", replay.cleaned_table(spark, sf_dir, "orders"), root, [0, 1, 4])
    out, ckpt = scratch_path(spark, "parsed-orders"), scratch_path(spark, "ckpt-parse")
    msgs = message_file_stream(spark, root).select(
        F.col("value").cast("binary").alias("value"))  # as the broker delivers it
    parsed = stage.validate("orders", stage.parse("orders", msgs))
    q = (parsed.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)


@register("stream_dedup_items", oracle.sql("SELECT * FROM staged_items", "staged_items"))
def q_stream_dedup_items(spark, sf_dir):
    """Stateful dedup across micro-batches and restarts: the first load,
    then a full replay; the replay never reaches the sink."""
    from martline.streaming import consumer
    root = scratch_path(spark, "topic-items")
    out, ckpt = scratch_path(spark, "dedup-items"), scratch_path(spark, "ckpt-dedup")
    items = replay.cleaned_table(spark, sf_dir, "items")
    for group in ([0, 1], [2]):
        replay.write_batches("items", items, root, group)
        stream = consumer.consumer_stream("items", message_file_stream(spark, root), "first")
        q = (stream.drop(*consumer.CARRY).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination()
    return spark.read.parquet(out)


# The delay of the bounded dedup, and the span after which its
# replay comes: the second replay meets expired state.
BOUNDED_DELAY = "1 second"
REPLAY_GAP_DAYS = 20_000


@register("stream_dedup_bounded_orders", oracle.sql(
    "SELECT * FROM staged_orders UNION ALL SELECT * REPLACE ("
    f"order_purchase_timestamp + {REPLAY_GAP_DAYS} * INTERVAL '1' DAY AS order_purchase_timestamp) "
    "FROM staged_orders", "staged_orders"))
def q_stream_dedup_bounded_orders(spark, sf_dir):
    """Dedup with bounded state: keys are remembered within the watermark on
    the purchase time only. All orders, then all of them again 20,000 days
    later, then those again. A marker message a day after the newest order
    follows each load: it moves the watermark past every key of the load, so
    the second load passes whole and all of the third is late. The markers
    aside, each row has one defined result."""
    from martline.streaming import consumer
    root = scratch_path(spark, "topic-orders")
    out, ckpt = scratch_path(spark, "dedup-bounded"), scratch_path(spark, "ckpt-bounded")
    clean_df = wh.cleaned(spark, sf_dir, "orders")
    time = "order_purchase_timestamp"
    later = clean_df.withColumn(time, F.col(time) + F.make_dt_interval(days=F.lit(REPLAY_GAP_DAYS)))

    def marker(df):
        newest = df.agg((F.max(time) + F.make_dt_interval(days=F.lit(1))).alias(time))
        columns = {"order_id": F.lit("marker"), "customer_id": F.lit("marker")}
        return newest.select(*[F.col(c) if c == time else columns.get(c, F.lit(None)).cast(df.schema[c].dataType).alias(c)
                               for c in df.columns])

    for i, df in enumerate((clean_df, marker(clean_df), later, marker(later), later)):
        write_messages(stage.encode("orders", df), f"{root}/{i}")
        stream = consumer.consumer_stream(
            "orders", message_file_stream(spark, root), "first",
            dedup_watermark=(time, BOUNDED_DELAY))
        q = (stream.drop(*consumer.CARRY).writeStream.format("parquet")
             .option("path", out).option("checkpointLocation", ckpt)
             .trigger(availableNow=True).start())
        q.awaitTermination()
    return spark.read.parquet(out).filter("order_id <> 'marker'")


@register("stream_file_source", oracle.sql("SELECT * FROM raw_payments", "raw_payments"))
def q_stream_file_source(spark, sf_dir):
    """CSV folder as a stream with a declared schema."""
    src = scratch_path(spark, "csv-payments")
    wh.raw(spark, sf_dir, "payments").write.mode("overwrite").option("header", True).csv(src)
    out, ckpt = scratch_path(spark, "csv-stream-out"), scratch_path(spark, "ckpt-csv")
    stream = file_stream(spark, src, schemas.PAYMENTS, "csv", header="true")
    q = (stream.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)


# ---- sources and sinks -------------------------------------------------------------------



@register("scan_csv_roundtrip", oracle.sql("SELECT * FROM raw_customers", "raw_customers"))
def q_scan_csv_roundtrip(spark, sf_dir):
    """Customers through CSV text and back with a declared schema; padded
    ids keep their spaces."""
    path = scratch_path(spark, "csv-customers")
    files.write_csv(wh.raw(spark, sf_dir, "customers"), path)
    return files.read_csv(spark, path, schemas.CUSTOMERS)


@register("scan_csv_inferred", oracle.sql(
    "SELECT CAST(seller_id AS INTEGER) AS seller_id, seller_zip_code_prefix, seller_city, "
    "seller_state FROM raw_sellers", "raw_sellers"))
def q_scan_csv_inferred(spark, sf_dir):
    """Sellers through CSV read back with inferred types, as the dimension
    loads did: numeric-looking ids come back as integers (an id like
    ``01409`` would lose its zero) — the reason the declared-schema read is
    the default."""
    path = scratch_path(spark, "csv-sellers")
    files.write_csv(wh.raw(spark, sf_dir, "sellers"), path)
    return files.read_csv(spark, path)


@register("scan_csv_lossless", oracle.sql(
    "SELECT lpad(seller_id, 6, '0') AS seller_id, seller_zip_code_prefix, seller_city, seller_state, "
    "CAST(seller_zip_code_prefix AS BIGINT) * 10000000 AS big, seller_zip_code_prefix / 4.0 AS part, "
    "DATE '2020-01-01' AS day FROM raw_sellers", "raw_sellers"))
def q_scan_csv_lossless(spark, sf_dir):
    """Sellers through CSV, types inferred without loss: ids with leading zeros
    stay text, the other columns get the narrowest type that says them."""
    path = scratch_path(spark, "csv-sellers")
    zip_ = F.col("seller_zip_code_prefix")
    files.write_csv(wh.raw(spark, sf_dir, "sellers").withColumns({
        "seller_id": F.lpad("seller_id", 6, "0"), "big": zip_.cast("long") * 10000000, "part": zip_ / 4,
        "day": F.lit("2020-01-01")}), path)
    return infer.read_csv_lossless(spark, path)


@register("scan_csv_strict", oracle.sql("SELECT * FROM raw_orders", "raw_orders"))
def q_scan_csv_strict(spark, sf_dir):
    """Orders through CSV, read back in FAILFAST mode (a value that does not
    fit the declared type fails the job instead of becoming NULL)."""
    path = scratch_path(spark, "csv-orders")
    files.write_csv(wh.raw(spark, sf_dir, "orders"), path)
    return files.read_csv(spark, path, schemas.ORDERS, strict=True)


@register("jdbc_roundtrip", oracle.sql("SELECT * FROM raw_sellers", "raw_sellers"))
def q_jdbc_roundtrip(spark, sf_dir):
    """Sellers appended to a relational table and read back in parallel
    partitions (MOD predicates). Embedded Derby: the database lives in this
    JVM only, so on a cluster point ``url`` at the warehouse database."""
    url = jdbc.derby_url(scratch_path(spark, "derby"))
    jdbc.write_table(wh.raw(spark, sf_dir, "sellers"), url, "SELLERS", jdbc.DERBY_PROPS,
                     mode="overwrite")
    back = jdbc.read_table(spark, url, "SELLERS", jdbc.DERBY_PROPS,
                           mod_column="\"seller_zip_code_prefix\"", num_partitions=4)
    return back


@register("overwrite_reload", oracle.sql("SELECT * FROM staged_orders", "staged_orders"))
def q_overwrite_reload(spark, sf_dir):
    """Write the staged orders twice with overwrite (the second replaces the
    first) and read back: equals one load."""
    path = scratch_path(spark, "orders-table")
    df = wh.staged(spark, sf_dir, "orders")
    files.overwrite_table(df, path)
    return files.overwrite_table(df, path)


@register("conform_schema", oracle.sql("SELECT * FROM raw_items", "raw_items"))
def q_conform_schema(spark, sf_dir):
    """Items as text with an extra column, conformed to the declared items
    schema: declared order and types, extra column dropped."""
    raw = wh.raw(spark, sf_dir, "items")
    text = raw.select(*[F.col(c).cast("string").alias(c) for c in reversed(raw.columns)],
                      F.lit("x").alias("unexpected"))
    return schemas.conform(text, schemas.ITEMS)


# The nine expected input folders and the driver table each one
# is derived from here (those of no table here are reported as missing).
INPUT_MANIFEST = [
    ("orders", "orders.parquet"),
    ("customers", "customer.parquet"),
    ("payments", "lineitem.parquet"),
    ("items", "lineitem.parquet"),
    ("geolocation", "geolocation.parquet"),
    ("order_review", "order_review.parquet"),
    ("products", "part.parquet"),
    ("sellers", "supplier.parquet"),
    ("product_category", "product_category.parquet"),
]
_HERE = {"orders", "customer", "lineitem", "part", "supplier"}


@register("manifest_missing", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{n}' AS input_name, '{f}' AS file_name, " + (
        f"true AS present, (SELECT count(*) FROM {f.removesuffix('.parquet')}) AS row_count"
        if f.removesuffix(".parquet") in _HERE else "false AS present, NULL AS row_count")
    for n, f in INPUT_MANIFEST) + ") t")
def q_manifest_missing(spark, sf_dir):
    """All expected inputs vs the files found (metadata), with the row count
    of every input that is present (one job over all present tables)."""
    expected = spark.createDataFrame(INPUT_MANIFEST, "input_name string, file_name string")
    status = files.missing_inputs(spark, sf_dir, expected)
    present = sorted({r.file_name for r in status.filter("present").select("file_name").collect()})
    counts = None
    for f in present:   # bounded by the manifest, not by the data
        c = fixtures.read_table(spark, sf_dir, f.removesuffix(".parquet")).select(
            F.lit(f).alias("file_name"))
        counts = c if counts is None else counts.unionByName(c)
    status = status.drop("file_bytes")     # sizes are not visible to SQL
    if counts is None:
        return status.withColumn("row_count", F.lit(None).cast("long"))
    return status.join(counts.groupBy("file_name").agg(F.count(F.lit(1)).alias("row_count")),
                       "file_name", "left")


@register("literal_rows", oracle.sql(
    "SELECT coalesce(t.en, trim(p.product_category_name)) AS product_category_name, "
    "count(*) AS products FROM raw_products p LEFT JOIN translation t "
    "ON trim(p.product_category_name) = t.pt GROUP BY 1", "raw_products", "translation"))
def q_literal_rows(spark, sf_dir):
    """Literal rows (the translation list) as a table, used on the products."""
    return (dims.product(wh.raw(spark, sf_dir, "products"), wh.raw(spark, sf_dir, "translation"))
            .groupBy("product_category_name").agg(F.count(F.lit(1)).alias("products")))


def _json_str(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN 'null' ELSE '\"' || {c} || '\"' END"


def _json_ts(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN 'null' ELSE '\"' || strftime({c}, '%Y-%m-%dT%H:%M:%S') || '\"' END"


def _json_num(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN 'null' ELSE CAST({c} AS VARCHAR) END"


def _json_sql(fields: list[tuple[str, str]]) -> str:
    parts = " || ',' || ".join(f"'\"{n}\":' || {f(n)}" for n, f in fields)
    return f"'{{' || {parts} || '}}'"


_MSG_FIELDS = {
    "orders": [("order_id", _json_str), ("customer_id", _json_str), ("order_status", _json_str)]
    + [(c, _json_ts) for c in schemas.ORDER_TS_COLS],
    "items": [("order_id", _json_str), ("order_item_id", _json_num), ("product_id", _json_str),
              ("seller_id", _json_str), ("shipping_limit_date", _json_ts), ("price", _json_num),
              ("freight_value", _json_num)],
    "payments": [("order_id", _json_str), ("payment_sequential", _json_num),
                 ("payment_type", _json_str), ("payment_installments", _json_num),
                 ("payment_value", _json_num)],
}
_MSG_KEY_SQL = {"orders": "order_id", "items": "order_id || '_' || CAST(order_item_id AS VARCHAR)",
                "payments": "order_id || '_' || CAST(payment_sequential AS VARCHAR)"}

for _e in ["orders", "items", "payments"]:
    register(f"encode_{_e}_json", oracle.sql(
        f"SELECT {_MSG_KEY_SQL[_e]} AS key, {_json_sql(_MSG_FIELDS[_e])} AS value FROM clean_{_e}",
        f"clean_{_e}"))(
        lambda spark, sf_dir, e=_e: stage.encode(e, wh.cleaned(spark, sf_dir, e)))


@register("stage_orders_batch", oracle.sql("SELECT * FROM staged_orders", "staged_orders"))
def q_stage_orders_batch(spark, sf_dir):
    """Batch staging from text: orders as CSV text (timestamps as ISO text)
    -> cast and parse -> not-null -> one row per order -> overwrite the
    staging table -> read back. The producer's cleaning runs first, as
    in the streamed path."""
    src = scratch_path(spark, "csv-orders-text")
    clean_df = wh.cleaned(spark, sf_dir, "orders")
    files.write_csv(clean_df.select(*[F.col(c).cast("string").alias(c) for c in clean_df.columns]),
                    src)
    text = files.read_csv(spark, src, schemas.ORDERS_MSG)
    return files.overwrite_table(stage.orders_batch(text), scratch_path(spark, "orders-batch"))


# ---- reconciliation, key checks, run log, RFM, event time -------------------------------



@register("reconcile_counts", oracle.sql(
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{e}' AS entity, (SELECT count(*) FROM raw_{e}) AS raw_count, "
        f"(SELECT count(*) FROM staged_{e}) AS valid_count, "
        f"(SELECT count(*) FROM staged_{e}) AS stored_count"
        for e in ["orders", "items", "payments"]) + ") t",
    "raw_orders", "raw_items", "raw_payments", "staged_orders", "staged_items", "staged_payments"))
def q_reconcile_counts(spark, sf_dir):
    """Raw vs valid vs stored counts per entity: raw and valid rows are counted
    by the pass that writes them, the stored ones by the files' footers."""
    rows = []
    for e in ["orders", "items", "payments"]:
        counts = quality.observed_write(
            wh.raw(spark, sf_dir, e), lambda raw, e=e: stage.validate(e, clean.CLEANERS[e](raw)).select(
                *stage.TABLE_SCHEMA[e].names), scratch_path(spark, f"reconcile-{e}"))
        rows.append((e, *counts))
    return spark.createDataFrame(rows, "entity string, raw_count long, valid_count long, stored_count long")


# (table, primary key, UNIQUE natural key) as declared in ``schemas``.
_KEY_TABLES = [(f"staged_{e}", schemas.KEYS[e], None) for e in ["orders", "items", "payments"]] + [
    (t, schemas.KEYS[t], schemas.NATURAL_KEYS.get(t))
    for t in ["dim_customer", "dim_product", "dim_seller", "fact_sales"]]


def _key_sql() -> str:
    parts = []
    for t, pk, nk in _KEY_TABLES:
        null = " OR ".join(f"{c} IS NULL" for c in pk)
        parts.append(f"SELECT '{t}' AS table_name, '{t}.pk_null' AS check_name, "
                     f"(SELECT count(*) FROM {t} WHERE {null}) AS result")
        parts.append(f"SELECT '{t}', '{t}.pk_duplicate', ({_dup_sql(t, ', '.join(pk))})")
        if nk:
            parts.append(f"SELECT '{t}', '{t}.natural_key_duplicate', ({_dup_sql(t, ', '.join(nk))})")
    return ("SELECT table_name, check_name AS \"check\", CAST(result AS BIGINT) AS result, "
            "CAST(0 AS BIGINT) AS expected, result = 0 AS passed FROM ("
            + " UNION ALL ".join(parts) + ") t")


@register("quality_keys", oracle.sql(_key_sql(), *[t for t, _, _ in _KEY_TABLES]))
def q_quality_keys(spark, sf_dir):
    """PRIMARY KEY (not null, unique) and UNIQUE natural keys of the staging
    and warehouse tables, as checks."""
    bounds = wh.input_bounds(spark, sf_dir)
    frames = {
        "staged_orders": wh.staged(spark, sf_dir, "orders"),
        "staged_items": wh.staged(spark, sf_dir, "items"),
        "dim_customer": wh.dim_customer(spark, sf_dir, bounds),
        "dim_product": wh.dim_product(spark, sf_dir, bounds),
        "dim_seller": wh.dim_seller(spark, sf_dir, bounds),
    }
    frames = {t: written(df, f"keys-{t}") for t, df in frames.items()}  # read by their checks and by the fact
    frames["staged_payments"] = wh.staged(spark, sf_dir, "payments")
    frames["fact_sales"] = facts.sales(
        frames["staged_orders"], frames["staged_items"], frames["dim_customer"], frames["dim_product"],
        frames["dim_seller"], size_hint=bounds["items"],
        sample_src=frames["staged_items"].select("order_id", "order_item_id"))
    out = None
    for t, pk, nk in _KEY_TABLES:
        r = quality.run(frames[t], quality.key_checks(t, pk, nk)).select(
            F.lit(t).alias("table_name"), "*")
        out = r if out is None else out.unionByName(r)
    return out


oracle._def("runlog_tasks", ["raw_runlog"], """
SELECT run_id, task_id, start_date, end_date, state,
       coalesce(CAST(round((epoch_us(end_date) - epoch_us(start_date)) / 1000000.0) AS INT), 0) AS secs
FROM raw_runlog""")
oracle._def("run_summary", ["runlog_tasks"], """
SELECT a.run_id, a.task_count, a.failed_tasks,
       CASE WHEN a.slowest_seconds > 0 THEN s.task_id ELSE '' END AS slowest_task,
       greatest(a.slowest_seconds, 0) AS slowest_seconds, a.total_seconds,
       printf('%02dm %02ds', CAST(floor(a.total_seconds / 60) AS INT),
              CAST(a.total_seconds % 60 AS INT)) AS duration_text
FROM (SELECT run_id, count(*) AS task_count, count(*) FILTER (WHERE state = 'failed') AS failed_tasks,
             max(secs) AS slowest_seconds,
             CAST(round((epoch_us(max(end_date)) - epoch_us(min(start_date))) / 1000000.0) AS INT)
               AS total_seconds
      FROM runlog_tasks GROUP BY run_id) a
JOIN (SELECT run_id, task_id FROM (
        SELECT run_id, task_id, row_number() OVER (PARTITION BY run_id
               ORDER BY secs DESC, start_date NULLS LAST, task_id) AS rn FROM runlog_tasks) x
      WHERE rn = 1) s ON a.run_id = s.run_id""")


@register("run_summary_latest", oracle.sql(
    "SELECT * FROM run_summary WHERE run_id = (SELECT run_id FROM raw_runlog GROUP BY run_id "
    "ORDER BY min(start_date) DESC NULLS LAST, run_id DESC LIMIT 1)", "run_summary", "raw_runlog"))
def q_run_summary_latest(spark, sf_dir):
    """The summary of the run that started last."""
    return runlog.summary(runlog.one_run(wh.raw(spark, sf_dir, "runlog")))


@register("run_summary", oracle.sql("SELECT * FROM run_summary", "run_summary"))
def q_run_summary(spark, sf_dir):
    return runlog.summary(wh.raw(spark, sf_dir, "runlog"))


_PASS = "CASE WHEN {} THEN 'PASS' ELSE 'FAIL' END"
_ROWS_OK = f"final_rows >= {runlog.MIN_ROWS}"
_TIME_OK = f"total_seconds <= {runlog.MAX_SECONDS}"
_STATE_OK = "failed_tasks = 0"


@register("row_count_gate", oracle.sql(
    f"SELECT run_id, final_rows, total_seconds, {_PASS.format(_ROWS_OK)} AS pass_rows, "
    f"{_PASS.format(_TIME_OK)} AS pass_runtime, {_PASS.format(_STATE_OK)} AS pass_state, "
    f"{_PASS.format(' AND '.join([_ROWS_OK, _TIME_OK, _STATE_OK]))} AS overall "
    "FROM run_summary, (SELECT count(*) AS final_rows FROM fact_sales_enriched) n",
    "run_summary", "fact_sales_enriched"))
def q_row_count_gate(spark, sf_dir):
    final_rows = wh.fact_rows(spark, sf_dir)
    return runlog.gates(runlog.summary(wh.raw(spark, sf_dir, "runlog")), final_rows)


_SEGMENT_SQL = "CASE " + " ".join(f"WHEN {rule} THEN '{name}'" for name, rule in rfm.SEGMENTS) \
    + f" ELSE '{rfm.OTHER_SEGMENT}' END"


@register("rfm_segments", oracle.sql(f"""
WITH m AS (
  SELECT o.customer_id,
         CAST(date_diff('day', max(o.order_purchase_timestamp),
              (SELECT max(order_purchase_timestamp) FROM staged_orders)) AS INT) AS recency_days,
         count(DISTINCT o.order_id) AS frequency,
         round(coalesce(sum(p.total_payment_value), 0.0), 2) AS monetary
  FROM staged_orders o LEFT JOIN payments_agg p ON o.order_id = p.order_id
  GROUP BY o.customer_id),
s AS (
  SELECT *, CAST(ntile(5) OVER (ORDER BY recency_days DESC, customer_id) AS INT) AS r_score,
            CAST(ntile(5) OVER (ORDER BY frequency, customer_id) AS INT) AS f_score,
            CAST(ntile(5) OVER (ORDER BY monetary, customer_id) AS INT) AS m_score
  FROM m)
SELECT *, {_SEGMENT_SQL} AS segment FROM s""", "staged_orders", "payments_agg"))
def q_rfm_segments(spark, sf_dir):
    return rfm.segments(wh.staged(spark, sf_dir, "orders"), wh.staged(spark, sf_dir, "payments"))


# The injected clock fault (tasks that ended within their first
# second carry a start time shifted by this many years) and the stream split.
CLOCK_FAULT_YEARS = 1968
SPLIT_DAY = 15


@register("stream_watermark_guard", oracle.sql(
    f"SELECT date_trunc('hour', start_date) AS window_start, state, count(*) AS row_count "
    f"FROM raw_runlog WHERE end_date <> start_date GROUP BY 1, 2", "raw_runlog"))
def q_stream_watermark_guard(spark, sf_dir):
    """Run-log events streamed in two batches (first half of the month,
    then the rest) with a 10-minute watermark and hourly counts per state.
    Implausible event times are dropped before the watermark; without the
    guard the first batch would push the watermark ~2000 years ahead and
    the whole second batch would be dropped as late."""
    events = wh.raw(spark, sf_dir, "runlog").withColumn(
        "event_time", F.when(F.col("end_date") == F.col("start_date"),
                             F.timestamp_add("YEAR", F.lit(CLOCK_FAULT_YEARS), "start_date"))
        .otherwise(F.col("start_date")))
    root = scratch_path(spark, "runlog-stream")
    target, ckpt = scratch_path(spark, "runlog-windows"), scratch_path(spark, "ckpt-runlog")
    first = F.dayofmonth("start_date") <= SPLIT_DAY
    for i, part in enumerate([events.filter(first), events.filter(~first)]):
        part.write.mode("overwrite").parquet(f"{root}/batch-{i:06d}")
        stream = spark.readStream.schema(events.schema).parquet(f"{root}/*")
        counts = watermark.windowed_counts(watermark.guard(stream, "event_time"), "event_time",
                                           "10 minutes", "1 hour", ["state"])
        q = (counts.writeStream.outputMode("update")
             .foreachBatch(lambda df, bid: _upsert.write_batch(
                 df.withColumns({"_time": F.lit("1970-01-01").cast("timestamp_ntz"),
                                 "_partition": F.lit(0), "_offset": F.lit(bid).cast("long")}),
                 bid, target, ["window_start", "state"], ["window_start", "state", "row_count"],
                 "last"))
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination()
    from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType
    schema = StructType([StructField("window_start", TimestampNTZType()),
                         StructField("state", StringType()), StructField("row_count", LongType())])
    return _upsert.read(spark, target, ["window_start", "state"], schema, "last") \
        .drop("kafka_ingested_at")
