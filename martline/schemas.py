"""Declared schemas: raw inputs, stream messages, staging and warehouse tables.

Every table the pipeline writes has a fixed schema; ``conform`` casts a
DataFrame to one (``try_cast`` so bad text becomes NULL under ANSI mode)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampNTZType)

# Timestamps carry no zone (as in the warehouse DDL), so NTZ throughout.
S, I, L, D, T = StringType(), IntegerType(), LongType(), DoubleType(), TimestampNTZType()


def _struct(*cols: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in cols])


ORDER_TS_COLS = [
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
]

ORDERS = _struct(("order_id", S), ("customer_id", S), ("order_status", S),
                 *[(c, T) for c in ORDER_TS_COLS])
ITEMS = _struct(("order_id", S), ("order_item_id", I), ("product_id", S), ("seller_id", S),
                ("shipping_limit_date", T), ("price", D), ("freight_value", D))
PAYMENTS = _struct(("order_id", S), ("payment_sequential", I), ("payment_type", S),
                   ("payment_installments", I), ("payment_value", D))
CUSTOMERS = _struct(("customer_id", S), ("customer_unique_id", S),
                    ("customer_zip_code_prefix", I), ("customer_city", S), ("customer_state", S))
PRODUCTS = _struct(("product_id", S), ("product_category_name", S),
                   ("product_name_lenght", I), ("product_description_lenght", I),
                   ("product_photos_qty", I), ("product_weight_g", I),
                   ("product_length_cm", I), ("product_height_cm", I), ("product_width_cm", I))
TRANSLATION = _struct(("product_category_name", S), ("product_category_name_english", S))
SELLERS = _struct(("seller_id", S), ("seller_zip_code_prefix", I), ("seller_city", S),
                  ("seller_state", S))
RUNLOG = _struct(("run_id", S), ("task_id", S), ("start_date", T), ("end_date", T), ("state", S))

# Message payloads: timestamps travel as ISO-8601 text (or JSON null).
ORDERS_MSG = _struct(("order_id", S), ("customer_id", S), ("order_status", S),
                     *[(c, S) for c in ORDER_TS_COLS])
ITEMS_MSG = _struct(("order_id", S), ("order_item_id", I), ("product_id", S), ("seller_id", S),
                    ("shipping_limit_date", S), ("price", D), ("freight_value", D))
PAYMENTS_MSG = PAYMENTS

# Warehouse tables.
DIM_CUSTOMER = _struct(("customer_key", L), ("customer_id", S), ("customer_unique_id", S),
                       ("customer_zip_code_prefix", I), ("customer_city", S), ("customer_state", S))
DIM_PRODUCT = _struct(("product_key", L), ("product_id", S), ("product_category_name_pt", S),
                      ("product_category_name", S), ("product_name_length", I),
                      ("product_description_length", I), ("product_photos_qty", I),
                      ("product_weight_g", I), ("product_length_cm", I),
                      ("product_height_cm", I), ("product_width_cm", I))
DIM_SELLER = _struct(("seller_key", L), ("seller_id", S), ("seller_zip_code_prefix", I),
                     ("seller_city", S), ("seller_state", S))
FACT_SALES = _struct(("fact_sales_key", L), ("order_id", S), ("order_item_id", I),
                     ("customer_key", L), ("product_key", L), ("seller_key", L),
                     ("customer_id", S), ("product_id", S), ("seller_id", S), ("order_status", S),
                     *[(c, T) for c in ORDER_TS_COLS], ("shipping_limit_date", T),
                     ("price", D), ("freight_value", D), ("gross_sales_value", D),
                     ("delivery_days", I), ("estimated_delivery_days", I), ("is_delayed", I))
FACT_SALES_ENRICHED = StructType(FACT_SALES.fields + _struct(
    ("total_payment_value", D), ("payment_count", L), ("max_installments", I),
    ("avg_payment_value", D)).fields)

# Primary keys of the staging and warehouse tables (from their DDL).
KEYS = {
    "orders": ["order_id"],
    "items": ["order_id", "order_item_id"],
    "payments": ["order_id", "payment_sequential"],
    "dim_customer": ["customer_key"],
    "dim_product": ["product_key"],
    "dim_seller": ["seller_key"],
    "fact_sales": ["fact_sales_key"],
}
# UNIQUE natural keys of the dimensions.
NATURAL_KEYS = {"dim_customer": ["customer_id"], "dim_product": ["product_id"],
                "dim_seller": ["seller_id"]}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: declared order, declared types, missing
    columns as typed NULL. Casts use try_cast, so bad text becomes NULL."""
    present = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name in present:
            c = df[f.name]
            if df.schema[f.name].dataType != f.dataType:
                c = c.try_cast(f.dataType)
        else:
            c = F.lit(None).cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(cols)
