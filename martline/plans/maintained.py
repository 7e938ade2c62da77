"""Payment totals per order, kept up from changes instead of rebuilt.

A change is a payment with a sign: +1 for a row that came, -1 for one that
went; an update is one of each. Sums and counts take the signed changes as they
are (sums in cents, so nothing drifts). A maximum takes what came; where a row
went that had the maximum, the order's rows that are left are looked at again,
and only theirs.

Totals lie in a table bucketed by order, a load for each batch of changes with
the new totals of the orders that changed. The old totals are read where they
lie; the newest of an order counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from martline.session import written
from martline.sources.bucketed import BucketedTable

TOTALS = StructType([StructField("order_id", StringType()), StructField("total_cents", LongType()),
                     StructField("payment_count", LongType()), StructField("max_installments", IntegerType())])


class PaymentTotals:
    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.table = BucketedTable(spark, path, TOTALS, ["order_id"], buckets)

    def _current(self, up_to: int) -> DataFrame:
        """The newest totals of each order, with those of vanished orders."""
        newest = self.table.read(up_to).groupBy("order_id").agg(F.max_by(
            F.struct("total_cents", "payment_count", "max_installments"), "load").alias("t"))
        return newest.select("order_id", "t.*")

    def apply(self, changes: DataFrame, rows_left: DataFrame, load: int) -> None:
        """``changes``: sign, order_id, payment_value, payment_installments;
        ``rows_left``: the payments after them, read only where a maximum went
        (filtered by order, so on a table bucketed or clustered by order little
        is read). ``load`` counts from 1; the same load may be applied again."""
        cents = F.round(F.col("payment_value") * 100).cast("long")
        inst = F.col("payment_installments")
        delta = changes.groupBy("order_id").agg(
            F.sum(F.col("sign") * cents).alias("d_cents"), F.sum("sign").cast("long").alias("d_count"),
            F.max(F.when(F.col("sign") > 0, inst)).alias("came"), F.max(F.when(F.col("sign") < 0, inst)).alias("went"))
        # Dealt as the totals are; these are not dealt anew.
        delta = delta.repartition(self.table.buckets, "order_id")
        old = self._current(load - 1).withColumnsRenamed({c: f"o_{c}" for c in TOTALS.names[1:]})
        best = F.greatest("o_max_installments", "came")
        # Spark's greatest passes over nulls, so a missing side counts nothing.
        # What came may be what went, so its size is no proof.
        lost = F.col("went").isNotNull() & F.coalesce(F.col("went") >= best, F.lit(True))
        new = written(delta.join(old, "order_id", "left").select(
            "order_id", (F.coalesce("o_total_cents", F.lit(0)) + F.coalesce("d_cents", F.lit(0))).alias("total_cents"),
            (F.coalesce("o_payment_count", F.lit(0)) + F.col("d_count")).alias("payment_count"),
            best.cast("int").alias("max_installments"), lost.alias("lost")), "payment-totals")
        again = new.where("lost AND payment_count > 0").select("order_id")
        left = rows_left.join(again, "order_id", "left_semi").groupBy("order_id").agg(
            F.max("payment_installments").cast("int").alias("left_max"))
        self.table.write(new.join(left, "order_id", "left").withColumn(
            "max_installments", F.when(F.col("lost"), F.col("left_max")).otherwise(F.col("max_installments"))), load)

    def totals(self, up_to: int = 2**31 - 1) -> DataFrame:
        """As ``facts.payments_per_order`` over the payments that are left."""
        return self._current(up_to).where("payment_count > 0").select(
            "order_id", (F.col("total_cents") / 100).alias("total_payment_value"), "payment_count", "max_installments")


def signed(rows: DataFrame, sign: int) -> DataFrame:
    return rows.select(F.lit(sign).alias("sign"), "order_id", "payment_value", "payment_installments")
