"""The order tables bucketed alike, so that the facts join without a shuffle.

Items, orders and payments per order lie in one number of buckets by ``_part``:
the order's id, or, for an order with more than ``hot_rows`` items, the id and a
slot, one for each ``hot_rows`` items. The items of a hot order are spread over
its slots by their number, and its order and payment rows are in each. So a
bucket holds whole parts, a join on ``_part`` reads the buckets as they lie,
and no part is larger than ``hot_rows`` or so.

The shuffles are paid once, when a load is staged, not by every build."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from martline.operators.joins import bounded_broadcast
from martline.plans import facts
from martline.session import written
from martline.sources.bucketed import BucketedTable

PART = "_part"
#: Hot orders that may be broadcast to the items (an id and a number each).
BROADCAST_HOT = 100_000


class OrderTables:
    """Staged orders, items and payments under ``path``, in one load."""

    def __init__(self, spark: SparkSession, path: str, orders: StructType, items: StructType, payments: StructType, *,
                 buckets: int = 64, hot_rows: int = 1_000_000):
        self.hot_rows = hot_rows
        key = StructField(PART, StringType())
        table = lambda name, schema: BucketedTable(
            spark, f"{path.rstrip('/')}/{name}", StructType([key, *schema.fields]), [PART], buckets)
        self.orders, self.items, self.payments = table("orders", orders), table("items", items), table("payments", payments)

    @classmethod
    def stage(cls, spark: SparkSession, path: str, orders: DataFrame, items: DataFrame, payments: DataFrame,
              dims: tuple[DataFrame, DataFrame, DataFrame] | None = None, **opts) -> OrderTables:
        """Write the tables from staged rows; payments are totalled by order.
        With ``dims`` (customer, product, seller) the rows get their surrogate
        keys here, while they are narrow."""
        orders, items = orders.select(*facts.ORDER_COLS), items.select(*facts.ITEM_COLS)
        if dims:
            orders, items = facts.with_order_keys(orders, dims[0]), facts.with_item_keys(items, *dims[1:])
        totals = facts.payments_per_order(payments)
        self = cls(spark, path, orders.schema, items.schema, totals.schema, **opts)
        items = written(items, "staged-items", compression="zstd")
        hot = written(items.groupBy("order_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > self.hot_rows)
                      .select("order_id", F.ceil(F.col("n") / self.hot_rows).cast("int").alias("_slots")), "hot-orders")
        hot = bounded_broadcast(hot, BROADCAST_HOT)

        def part(slot: Column) -> Column:
            return F.when(F.col("_slots").isNull(), F.col("order_id")).otherwise(
                F.concat_ws("#", "order_id", slot.cast("string")))

        own = F.pmod(F.xxhash64("order_item_id", "product_id"), F.col("_slots"))
        self.items.write(items.join(hot, "order_id", "left").withColumn(PART, part(own)), 1)
        for table, rows in ((self.orders, orders), (self.payments, totals)):
            slots = F.sequence(F.lit(0), F.coalesce("_slots", F.lit(1)) - 1)
            table.write(rows.join(hot, "order_id", "left").withColumn("_slot", F.explode(slots))
                        .withColumn(PART, part(F.col("_slot"))), 1)
        return self

    def joined(self) -> DataFrame:
        """Items with their orders and payments: no exchange."""
        read = lambda t, *drop: t.read(1).drop("load", *drop)
        return (read(self.items).join(read(self.orders, "order_id"), PART)
                .join(read(self.payments, "order_id"), PART, "left").drop(PART))


def sales(tables: OrderTables, **key_opts) -> DataFrame:
    """``fact_sales_enriched`` from bucketed tables staged with their keys."""
    return facts.finished(tables.joined(), enriched=True, **key_opts)
