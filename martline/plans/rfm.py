"""Customer recency / frequency / monetary segments.

Per customer: ``recency_days`` = days from the last purchase to the latest
purchase in the data, ``frequency`` = orders (staged orders are unique), ``monetary`` = sum of
the customer's payments (from the payments table, not from the item-level
fact, where order totals repeat per item). Each measure gets a quintile
score 1..5 (5 = best: most recent, most frequent, highest spend), equal to
``ntile(5)`` over (measure, customer_id): the first customer of each tile is
found by radix histograms of all three measures (``multi_quantile``), and a
customer's score is the number of these that stand at or before it. The
measures are neither sorted nor exchanged for it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.functions.time import calendar_days
from martline.operators.multi_quantile import at_or_after, keys_at_ranks
from martline.plans.facts import payments_per_order
from martline.session import written

QUINTILES = 5


def tile_starts(n: int, tiles: int = QUINTILES) -> list[int]:
    """Ranks (from 1) of the first row of tiles 2, 3, … of ``ntile(tiles)``
    over ``n`` rows: the first ``n mod tiles`` tiles hold one row more."""
    q, m = divmod(n, tiles)
    return [t * q + min(t, m) + 1 for t in range(1, tiles)]


# Segment names by score rules, checked in this order.
SEGMENTS = [
    ("champions", "r_score >= 4 AND f_score >= 4 AND m_score >= 4"),
    ("loyal", "r_score >= 4 AND f_score >= 3"),
    ("recent", "r_score >= 4"),
    ("at_risk", "r_score <= 2 AND f_score >= 3"),
    ("lost", "r_score <= 1"),
]
OTHER_SEGMENT = "regular"


def _ts_literal(ts) -> Column:
    # Wall-clock text, so no zone conversion touches the literal.
    return F.lit(None if ts is None else ts.isoformat(sep=" ")).cast("timestamp_ntz")


def measures(orders: DataFrame, payments: DataFrame) -> DataFrame:
    latest = orders.agg(F.max("order_purchase_timestamp")).first()[0]
    per_order = orders.select("order_id", "customer_id", "order_purchase_timestamp").join(
        payments_per_order(payments).select("order_id", "total_payment_value"), "order_id", "left")
    return per_order.groupBy("customer_id").agg(
        calendar_days(_ts_literal(latest), F.max("order_purchase_timestamp")).alias("recency_days"),
        F.count("order_id").alias("frequency"),
        F.round(F.coalesce(F.sum("total_payment_value"), F.lit(0.0)), 2).alias("monetary"),
    )


def segments(orders: DataFrame, payments: DataFrame) -> DataFrame:
    m = written(measures(orders, payments), "rfm-measures")
    # A higher tile is a better score: fewer days, more orders, more money
    # (in cents, so that all are whole numbers).
    scores = {"r_score": -F.col("recency_days").cast("long"), "f_score": F.col("frequency"),
              "m_score": F.round(F.col("monetary") * 100).cast("long")}
    _, cuts = keys_at_ranks(m, scores, "customer_id", tile_starts)
    key = F.col("customer_id")
    scored = m.withColumns({
        name: sum((at_or_after(c, key, cut).cast("int") for cut in cuts[name] if cut is not None), F.lit(1))
        for name, c in scores.items()})
    seg = F.lit(OTHER_SEGMENT)
    for name, rule in reversed(SEGMENTS):
        seg = F.when(F.expr(rule), F.lit(name)).otherwise(seg)
    return scored.withColumn("segment", seg)
