"""Producer-side cleaning of the three streamed entities (before they are
published as messages): strict types, drop rows missing a required field,
reject negative amounts, then one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame

from martline import schemas
from martline.operators.dedup import first_per_key
from martline.operators.filters import dropna_subset, non_negative_rules, keep_valid

# Required fields, non-negative fields and the tie-break order
# that picks the surviving row of a duplicated key (first row wins).
ORDERS_REQUIRED = ["order_id", "customer_id", "order_status"]
ITEMS_REQUIRED = ["order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"]
ITEMS_NON_NEGATIVE = ["price", "freight_value"]
ITEMS_TIEBREAK = ["product_id", "seller_id", "shipping_limit_date", "price", "freight_value"]
PAYMENTS_REQUIRED = ["order_id", "payment_sequential", "payment_type", "payment_installments",
                     "payment_value"]
PAYMENTS_NON_NEGATIVE = ["payment_value", "payment_installments"]
PAYMENTS_TIEBREAK = ["payment_type", "payment_installments", "payment_value"]

# Publication order of the messages (ascending, NULLs last).
SEND_ORDER = {
    "orders": ["order_purchase_timestamp", "order_id"],
    "items": ["shipping_limit_date", "order_id", "order_item_id"],
    "payments": ["order_id", "payment_sequential"],
}


def orders(raw: DataFrame) -> DataFrame:
    df = dropna_subset(schemas.conform(raw, schemas.ORDERS), ORDERS_REQUIRED)
    return first_per_key(df, schemas.KEYS["orders"], schemas.ORDER_TS_COLS)


def order_items(raw: DataFrame) -> DataFrame:
    df = dropna_subset(schemas.conform(raw, schemas.ITEMS), ITEMS_REQUIRED)
    df = keep_valid(df, non_negative_rules(ITEMS_NON_NEGATIVE))
    return first_per_key(df, schemas.KEYS["items"], ITEMS_TIEBREAK)


def payments(raw: DataFrame) -> DataFrame:
    df = dropna_subset(schemas.conform(raw, schemas.PAYMENTS), PAYMENTS_REQUIRED)
    df = keep_valid(df, non_negative_rules(PAYMENTS_NON_NEGATIVE))
    return first_per_key(df, schemas.KEYS["payments"], PAYMENTS_TIEBREAK)


CLEANERS = {"orders": orders, "items": order_items, "payments": payments}
