"""The facts as they would be without the cleaning rules: what the quality
checks are there to find.

Orders and items go in as they came (negative prices, lost customers), items
of the last months are delivered twice, the dimensions lack the products
without a category and the sellers of one state, and a negative payment counts
as the reversal of one. Only the columns that checks read are kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martline.plans import dims, facts, quality
from martline.plans import warehouse as wh

#: From when on items came twice, and the state without sellers.
DELIVERED_TWICE_FROM = "2001-06-01"
LOST_SELLERS_STATE = "NATION_9"

KEYS = ["order_id", "order_item_id"]


def deliveries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Items in two deliveries: all of them, and the last months' again."""
    items = wh.raw(spark, sf_dir, "items")
    return items, items.where(F.col("shipping_limit_date") >= F.lit(DELIVERED_TWICE_FROM).cast("timestamp_ntz"))


def fact(spark: SparkSession, sf_dir: str, items: DataFrame) -> DataFrame:
    orders = wh.raw(spark, sf_dir, "orders").select("order_id", "customer_id")
    customers = dims.customer_rows(wh.raw(spark, sf_dir, "customers")).select("customer_id", F.lit(1).alias("customer_key"))
    products = (dims.product_rows(wh.raw(spark, sf_dir, "products"), wh.raw(spark, sf_dir, "translation"))
                .where("product_category_name IS NOT NULL").select("product_id", F.lit(1).alias("product_key")))
    sellers = (dims.seller_rows(wh.raw(spark, sf_dir, "sellers")).where(F.col("seller_state") != LOST_SELLERS_STATE)
               .select("seller_id", F.lit(1).alias("seller_key")))
    payments = wh.raw(spark, sf_dir, "payments").groupBy("order_id").agg(
        F.sum("payment_value").alias("total_payment_value"), F.sum(F.signum("payment_value")).cast("long").alias("payment_count"))
    items = items.select(*KEYS, "product_id", "seller_id",
                         (F.col("price") + F.col("freight_value")).alias("gross_sales_value"),
                         (F.col("freight_value") * F.signum("price")).alias("freight_value"))
    # Look-ups on either side of the one join on the order, as in ``facts``.
    orders = facts.with_order_keys(orders.join(payments, "order_id", "left"), customers)
    return (facts.with_item_keys(items, products, sellers).join(orders, "order_id")
            .select(*KEYS, "customer_id", "product_id", "seller_id", "customer_key", "product_key", "seller_key",
                    "gross_sales_value", "freight_value", "total_payment_value", "payment_count"))


def checks() -> list[quality.Check]:
    """The checks of both facts, and three key sets more."""
    both = {c[0]: c for c in quality.fact_sales_checks() + quality.fact_sales_enriched_checks()}
    return [*both.values(),
            quality.duplicate_keys("duplicate_order_rows", ["order_id"]),
            quality.duplicate_keys("duplicate_customer_product_rows", ["customer_id", "product_id"]),
            quality.duplicate_keys("duplicate_order_seller_rows", ["order_id", "seller_id"])]
