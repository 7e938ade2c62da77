"""Sales fact (one row per order item) and the payment-enriched fact.

Plan shape: the orders, with their payments where asked for, are one written
table, a row an order, so items meet them in one ``order_id`` join with both
sides plain shuffles, which is what AQE's skew-join handling needs to split an
order that holds a third of all items. The joined base is written too where the
dense key needs more than one bucket: the key counts and ranks the table
instead of running the join again. The dimensions are looked up before that
join, the customer a row an order, product and seller on the narrow items, so no
wide row moves for them; a small dimension is broadcast. ``copartitioned`` has the same facts from
bucketed tables, without a shuffle at the join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline import schemas
from martline.functions.time import calendar_days
from martline.operators.dedup import first_per_key
from martline.operators.dense_key import boundaries, dense_key
from martline.operators.joins import bounded_broadcast
from martline.session import written

ORDER_COLS = ["order_id", "customer_id", "order_status", *schemas.ORDER_TS_COLS]
ITEM_COLS = ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date",
             "price", "freight_value"]


def payments_per_order(payments: DataFrame) -> DataFrame:
    """Per order: sum of payment values, number of payments, most
    installments. Partial aggregation runs before the shuffle."""
    return payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("total_payment_value"),
        F.count(F.lit(1)).alias("payment_count"),
        F.max("payment_installments").alias("max_installments"),
    )


def _payment_measures(df: DataFrame) -> DataFrame:
    """Zero-fill the left-joined payment measures; average guarded by count."""
    cnt = F.coalesce("payment_count", F.lit(0).cast("long"))
    total = F.coalesce("total_payment_value", F.lit(0.0))
    return df.withColumns({
        "total_payment_value": total,
        "payment_count": cnt,
        "max_installments": F.coalesce("max_installments", F.lit(0)),
        "avg_payment_value": F.when(cnt > 0, total / cnt).otherwise(F.lit(0.0)),
    })


def _derived(df: DataFrame) -> DataFrame:
    purchase = F.col("order_purchase_timestamp")
    return df.withColumns({
        "delivery_days": calendar_days("order_delivered_customer_date", purchase),
        "estimated_delivery_days": calendar_days("order_estimated_delivery_date", purchase),
        # NULL comparison falls to 0: undelivered orders are not delayed.
        "is_delayed": F.when(F.col("order_delivered_customer_date")
                             > F.col("order_estimated_delivery_date"), F.lit(1)).otherwise(F.lit(0)),
        "gross_sales_value": F.col("price") + F.col("freight_value"),
    })


#: A dimension with no more rows is broadcast to its look-up (an id and a key each).
BROADCAST_DIM = 500_000


def lookup(dim: DataFrame, key: str, natural: str) -> DataFrame:
    """A dimension's look-up table, written once and broadcast if it is small."""
    return bounded_broadcast(written(dim.select(key, natural), f"fact-{key}"), BROADCAST_DIM)


def with_order_keys(orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """A customer belongs to the order: looked up a row an order."""
    return orders.join(lookup(dim_customer, "customer_key", "customer_id"), "customer_id", "left")


def with_item_keys(items: DataFrame, dim_product: DataFrame, dim_seller: DataFrame) -> DataFrame:
    """Product and seller looked up on the items, before they carry their order."""
    return (items.join(lookup(dim_product, "product_key", "product_id"), "product_id", "left")
            .join(lookup(dim_seller, "seller_key", "seller_id"), "seller_id", "left"))


def _dim_keys(df: DataFrame, dim_customer: DataFrame, dim_product: DataFrame,
              dim_seller: DataFrame) -> DataFrame:
    return (df
            .join(dim_customer.select("customer_key", "customer_id"), "customer_id", "left")
            .join(dim_product.select("product_key", "product_id"), "product_id", "left")
            .join(dim_seller.select("seller_key", "seller_id"), "seller_id", "left"))


def sales(orders: DataFrame, items: DataFrame, dim_customer: DataFrame, dim_product: DataFrame,
          dim_seller: DataFrame, payments: DataFrame | None = None, *,
          dedup_inputs: bool = False, narrow_lookup: bool = False, **key_opts) -> DataFrame:
    """``fact_sales`` (22 columns), or ``fact_sales_enriched`` (26) when
    ``payments`` (staged payment rows) is given.

    ``dedup_inputs`` re-applies one-row-per-key to orders and items; staged
    tables are already unique by key, so it is off by default.

    ``narrow_lookup``: for dimensions too large to broadcast. The surrogate
    keys are looked up on a narrow projection (item key + the three natural
    keys), so the three dimension joins shuffle five columns instead of the
    wide fact, and the keys are joined back on ``(order_id, order_item_id)``:
    the wide rows move once instead of once per dimension."""
    o = orders.select(*ORDER_COLS)
    i = items.select(*ITEM_COLS)
    if dedup_inputs:
        o = first_per_key(o, ["order_id"])
        i = first_per_key(i, ["order_id", "order_item_id"])
    if payments is not None:
        # Both sides have an order once, so neither can be skewed.
        o = o.join(payments_per_order(payments), "order_id", "left")
    if not narrow_lookup:
        o, i = with_order_keys(o, dim_customer), with_item_keys(i, dim_product, dim_seller)
    base = i.join(written(o, "fact-orders", compression="zstd"), "order_id", "inner")
    if narrow_lookup:
        ids = ["order_id", "order_item_id"]
        narrow = _dim_keys(base.select(*ids, "customer_id", "product_id", "seller_id"),
                           dim_customer, dim_product, dim_seller)
        base = base.join(narrow.select(*ids, "customer_key", "product_key", "seller_key"), ids)
    return finished(base, enriched=payments is not None, **key_opts)


def finished(base: DataFrame, *, enriched: bool, **key_opts) -> DataFrame:
    """The fact from items joined with their orders (and payments) and the
    dimensions' keys. What follows from a row's other columns is added last:
    it is neither written nor exchanged."""
    order = ["order_id", "order_item_id"]
    bounds = boundaries(base.select(*order), order, **key_opts)
    if bounds:
        base = written(base, "fact-base", compression="zstd")
    fact = _derived(dense_key(base, order, "fact_sales_key", bounds=bounds))
    if enriched:
        fact = _payment_measures(fact)
    schema = schemas.FACT_SALES_ENRICHED if enriched else schemas.FACT_SALES
    return schemas.conform(fact, schema)


def enrich(fact_sales: DataFrame, payments: DataFrame) -> DataFrame:
    """``fact_sales_enriched`` from an existing ``fact_sales`` table. The
    payment totals repeat on every item row of an order, so summing
    ``total_payment_value`` over this table over-counts."""
    per_order = written(payments_per_order(payments), "order-payments")
    df = _payment_measures(fact_sales.join(per_order, "order_id", "left"))
    return schemas.conform(df, schemas.FACT_SALES_ENRICHED)
