"""Dimensions: cleaned, one row per natural key, dense surrogate key ordered
by the natural key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline import schemas
from martline.functions.text import clean_text, code_text, title_text
from martline.operators.dedup import first_per_key
from martline.operators.dense_key import dense_key
from martline.operators.filters import filter_not_null
from martline.operators.joins import bounded_broadcast

# The category translation table is a lookup list (tens of rows in the real
# data); broadcast it only below this proven size.
TRANSLATION_BROADCAST_MAX_ROWS = 100_000


def _customer_fields(raw: DataFrame) -> DataFrame:
    df = raw.select(
        clean_text("customer_id").alias("customer_id"),
        clean_text("customer_unique_id").alias("customer_unique_id"),
        F.col("customer_zip_code_prefix").try_cast("int").alias("customer_zip_code_prefix"),
        title_text("customer_city").alias("customer_city"),
        code_text("customer_state").alias("customer_state"),
    )
    return filter_not_null(df, ["customer_id", "customer_unique_id"])


def customer_rows(raw: DataFrame) -> DataFrame:
    """The customers without their surrogate key."""
    return first_per_key(_customer_fields(raw), ["customer_id"])


def customer(raw: DataFrame, **key_opts) -> DataFrame:
    return dense_key(customer_rows(raw), ["customer_id"], "customer_key", sample_src=_customer_fields(raw),
                     **key_opts).select(
        *schemas.DIM_CUSTOMER.names)


def translation(raw: DataFrame) -> DataFrame:
    t = raw.select(
        clean_text("product_category_name").alias("product_category_name_pt"),
        clean_text("product_category_name_english").alias("product_category_name_en"),
    ).filter(F.col("product_category_name_pt").isNotNull())
    # One English name per Portuguese name, so the lookup cannot multiply rows.
    return first_per_key(t, ["product_category_name_pt"], ["product_category_name_en"])


def _product_fields(raw: DataFrame) -> DataFrame:
    p = raw.select(
        clean_text("product_id").alias("product_id"),
        clean_text("product_category_name").alias("product_category_name_pt"),
        F.col("product_name_lenght").try_cast("int").alias("product_name_length"),
        F.col("product_description_lenght").try_cast("int").alias("product_description_length"),
        *[F.col(c).try_cast("int").alias(c) for c in
          ["product_photos_qty", "product_weight_g", "product_length_cm",
           "product_height_cm", "product_width_cm"]],
    )
    return filter_not_null(p, ["product_id"])


def product_rows(raw: DataFrame, raw_translation: DataFrame) -> DataFrame:
    """The products without their surrogate key."""
    t = bounded_broadcast(translation(raw_translation), TRANSLATION_BROADCAST_MAX_ROWS,
                          bound_src=raw_translation)
    df = (_product_fields(raw).join(t, "product_category_name_pt", "left")
          .withColumn("product_category_name",
                      F.coalesce("product_category_name_en", "product_category_name_pt"))
          .drop("product_category_name_en"))
    return first_per_key(df, ["product_id"])


def product(raw: DataFrame, raw_translation: DataFrame, **key_opts) -> DataFrame:
    return dense_key(product_rows(raw, raw_translation), ["product_id"], "product_key",
                     sample_src=_product_fields(raw), **key_opts).select(
        *schemas.DIM_PRODUCT.names)


def _seller_fields(raw: DataFrame) -> DataFrame:
    df = raw.select(
        clean_text("seller_id").alias("seller_id"),
        F.col("seller_zip_code_prefix").try_cast("int").alias("seller_zip_code_prefix"),
        title_text("seller_city").alias("seller_city"),
        code_text("seller_state").alias("seller_state"),
    )
    return filter_not_null(df, ["seller_id"])


def seller_rows(raw: DataFrame) -> DataFrame:
    """The sellers without their surrogate key."""
    return first_per_key(_seller_fields(raw), ["seller_id"])


def seller(raw: DataFrame, **key_opts) -> DataFrame:
    return dense_key(seller_rows(raw), ["seller_id"], "seller_key", sample_src=_seller_fields(raw),
                     **key_opts).select(
        *schemas.DIM_SELLER.names)
