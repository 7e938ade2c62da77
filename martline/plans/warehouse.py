"""Batch assembly over the stand-in inputs: raw -> clean -> staged -> dims ->
facts. Each function returns a lazy DataFrame; nothing is written unless the
caller writes it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martline.plans import clean as clean_plans
from martline.plans import dims, facts, stage
from martline.sources import fixtures


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return fixtures.RAW[name](spark, sf_dir)


def cleaned(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return clean_plans.CLEANERS[entity](raw(spark, sf_dir, entity))


def staged(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """Staging table content in the batch path: producer cleaning, then the
    consumer's rules. Producer output is already one row per key, so the
    consumer's dedup would be a second shuffle for nothing and is skipped
    here (the streaming path keeps it)."""
    df = stage.validate(entity, cleaned(spark, sf_dir, entity))
    return df.select(*stage.TABLE_SCHEMA[entity].names)


# The driver table each entity is derived from: its row count bounds the
# entity's rows (the derivations only map or filter rows).
BASE_TABLE = {"customers": "customer", "products": "part", "sellers": "supplier",
              "items": "lineitem", "orders": "orders", "payments": "lineitem"}


def input_bounds(spark: SparkSession, sf_dir: str, *entities: str) -> dict[str, int]:
    """Row counts of the base tables of the named entities (all by default), in
    one job: a union of per-table counts that read no column."""
    tables = {t for e, t in BASE_TABLE.items() if not entities or e in entities}
    frames = [fixtures.read_table(spark, sf_dir, t).select(F.lit(t).alias("t"))
              for t in sorted(tables)]
    union = frames[0]
    for f in frames[1:]:
        union = union.unionByName(f)
    counts = {r.t: r["count"] for r in union.groupBy("t").count().collect()}
    return {e: counts.get(t, 0) for e, t in BASE_TABLE.items()}


def _bound(bounds: dict[str, int] | None, spark: SparkSession, sf_dir: str, entity: str,
           key_opts: dict) -> dict:
    """Dense-key options with the entity's input row count as the size bound
    (a dimension or fact never has more rows than its input), instead of a
    count of the whole derived plan."""
    if "size_hint" in key_opts:
        return key_opts
    bounds = bounds or input_bounds(spark, sf_dir, entity)
    return {"size_hint": bounds[entity], **key_opts}


def dim_customer(spark: SparkSession, sf_dir: str, bounds: dict | None = None,
                 **key_opts) -> DataFrame:
    return dims.customer(raw(spark, sf_dir, "customers"),
                         **_bound(bounds, spark, sf_dir, "customers", key_opts))


def dim_product(spark: SparkSession, sf_dir: str, bounds: dict | None = None,
                **key_opts) -> DataFrame:
    return dims.product(raw(spark, sf_dir, "products"), raw(spark, sf_dir, "translation"),
                        **_bound(bounds, spark, sf_dir, "products", key_opts))


def dim_seller(spark: SparkSession, sf_dir: str, bounds: dict | None = None,
               **key_opts) -> DataFrame:
    return dims.seller(raw(spark, sf_dir, "sellers"),
                       **_bound(bounds, spark, sf_dir, "sellers", key_opts))


def fact_sales(spark: SparkSession, sf_dir: str, enriched: bool = False, **key_opts) -> DataFrame:
    bounds = input_bounds(spark, sf_dir)
    return facts.sales(
        staged(spark, sf_dir, "orders"),
        staged(spark, sf_dir, "items"),
        dim_customer(spark, sf_dir, bounds, **key_opts),
        dim_product(spark, sf_dir, bounds, **key_opts),
        dim_seller(spark, sf_dir, bounds, **key_opts),
        staged(spark, sf_dir, "payments") if enriched else None,
        **_bound(bounds, spark, sf_dir, "items", {
            "sample_src": raw(spark, sf_dir, "items").select("order_id", "order_item_id"),
            **key_opts}))


def fact_rows(spark: SparkSession, sf_dir: str) -> int:
    """Rows of the fact, from the keys alone: its dimensions and payments are
    left-joined on unique keys and change no count."""
    items = staged(spark, sf_dir, "items").select("order_id")
    return items.join(staged(spark, sf_dir, "orders").select("order_id"), "order_id").count()


def payments_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.payments_per_order(staged(spark, sf_dir, "payments"))
