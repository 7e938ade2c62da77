"""Consumer-side staging: messages -> typed rows -> consumer rules -> one row
per primary key. The same functions serve the batch path and each
micro-batch of the stream (see ``martline.streaming``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline import schemas
from martline.functions.json import decode_value, to_messages
from martline.functions.text import composite_key
from martline.functions.time import parse_ts
from martline.operators.dedup import first_per_key
from martline.operators.filters import Rule, keep_valid, non_negative_rules, not_null_rules, rejects

MESSAGE_SCHEMA = {"orders": schemas.ORDERS_MSG, "items": schemas.ITEMS_MSG,
                  "payments": schemas.PAYMENTS_MSG}
TABLE_SCHEMA = {"orders": schemas.ORDERS, "items": schemas.ITEMS, "payments": schemas.PAYMENTS}
TS_COLS = {"orders": schemas.ORDER_TS_COLS, "items": ["shipping_limit_date"], "payments": []}


def message_key(entity: str) -> Column:
    """Message key: ``order_id``, ``order_id_order_item_id`` or
    ``order_id_payment_sequential``."""
    if entity == "orders":
        return F.col("order_id")
    second = "order_item_id" if entity == "items" else "payment_sequential"
    return composite_key("order_id", second)


def encode(entity: str, clean_df: DataFrame) -> DataFrame:
    """Rows -> ``(key, value)`` JSON messages (what the producer publishes)."""
    return to_messages(clean_df, message_key(entity), TABLE_SCHEMA[entity].names)


# The consumer's validation rules per entity.
def rules(entity: str) -> list[Rule]:
    if entity == "orders":
        return not_null_rules(["order_id", "customer_id"])
    if entity == "items":
        return (not_null_rules(["order_id", "order_item_id", "product_id", "seller_id",
                                "price", "freight_value"])
                + non_negative_rules(["price", "freight_value"]))
    return (not_null_rules(["order_id", "payment_sequential"])
            + non_negative_rules(["payment_value", "payment_installments"]))


def parse(entity: str, messages: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """``(key, value[, carry…])`` -> typed columns. Malformed JSON gives an
    all-NULL row (later rejected by the rules); text timestamps that do not
    parse become NULL. The fields come from a generator, which no filter is
    pushed below: every rule would decode the text again."""
    carry = carry or []
    df = messages.select(*carry, F.inline(F.array(decode_value("value", MESSAGE_SCHEMA[entity]))))
    if TS_COLS[entity]:
        df = df.withColumns({c: parse_ts(c) for c in TS_COLS[entity]})
    return df


def validate(entity: str, parsed: DataFrame) -> DataFrame:
    return keep_valid(parsed, rules(entity))


def reject_rows(entity: str, parsed: DataFrame) -> DataFrame:
    """Rows the consumer would drop silently, with the failed rule names."""
    return rejects(parsed, rules(entity))


def stage(entity: str, parsed: DataFrame, order: list[str | Column] | None = None) -> DataFrame:
    """Consumer rules + one row per key. ``order`` is the arrival order
    (first wins); without one the remaining columns break ties."""
    valid = validate(entity, parsed)
    out = first_per_key(valid, schemas.KEYS[entity], order)
    return out.select(*TABLE_SCHEMA[entity].names)


def from_messages(entity: str, messages: DataFrame) -> DataFrame:
    """Batch form of the consumer: parse, validate, dedup."""
    return stage(entity, parse(entity, messages))


def orders_batch(raw_text: DataFrame) -> DataFrame:
    """Batch staging of orders read from text (CSV): cast, parse the
    timestamps, drop rows without ``order_id``/``customer_id``, one row per
    ``order_id``."""
    df = raw_text.select(
        F.col("order_id").cast("string").alias("order_id"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("order_status").cast("string").alias("order_status"),
        *[parse_ts(c).alias(c) for c in schemas.ORDER_TS_COLS])
    df = keep_valid(df, not_null_rules(["order_id", "customer_id"]))
    return first_per_key(df, ["order_id"], schemas.ORDER_TS_COLS)
