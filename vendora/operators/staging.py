"""Typed staging: cast, rename, trim.  No filter, join or dedup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(10,2)"
PAYMENT_MONEY = "decimal(12,2)"
TIMESTAMP = "timestamp_ntz"


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _lower(name: str) -> Column:
    return F.lower(F.trim(_text(name)))


def _upper(name: str) -> Column:
    return F.upper(F.trim(_text(name)))


def stg_customers(raw: DataFrame, load_ts: Column | None = None) -> DataFrame:
    """``load_ts`` is when the row was loaded or changed; default is now."""
    return raw.select(
        _text("customer_id").alias("customer_id"),
        _text("customer_unique_id").alias("customer_unique_id"),
        _text("customer_zip_code_prefix").alias("customer_zip_code"),
        _lower("customer_city").alias("customer_city"),
        _upper("customer_state").alias("customer_state"),
        (F.current_timestamp() if load_ts is None else load_ts).cast(TIMESTAMP).alias("updated_at"),
    )


def stg_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        _text("order_id").alias("order_id"),
        _text("customer_id").alias("customer_id"),
        _lower("order_status").alias("order_status"),
        F.col("order_purchase_timestamp").cast(TIMESTAMP).alias("order_purchased_at"),
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        _text("order_id").alias("order_id"),
        F.col("order_item_id").cast("int").alias("order_item_id"),
        _text("product_id").alias("product_id"),
        _text("seller_id").alias("seller_id"),
        F.col("price").cast(MONEY).alias("price"),
        F.col("freight_value").cast(MONEY).alias("freight_value"),
    )


def stg_products(raw: DataFrame) -> DataFrame:
    return raw.select(
        _text("product_id").alias("product_id"),
        _lower("product_category_name").alias("product_category"),
        F.col("product_weight_g").cast("int").alias("product_weight_g"),
        F.col("product_length_cm").cast("int").alias("product_length_cm"),
        F.col("product_height_cm").cast("int").alias("product_height_cm"),
    )


def stg_sellers(raw: DataFrame) -> DataFrame:
    return raw.select(
        _text("seller_id").alias("seller_id"),
        _text("seller_zip_code_prefix").alias("seller_zip_code_prefix"),
        _lower("seller_city").alias("seller_city"),
        _upper("seller_state").alias("seller_state"),
    )


def stg_order_payments(raw: DataFrame) -> DataFrame:
    return raw.select(
        _text("order_id").alias("order_id"),
        F.col("payment_sequential").cast("int").alias("payment_sequential"),
        _lower("payment_type").alias("payment_type"),
        F.col("payment_installments").cast("int").alias("payment_installments"),
        F.col("payment_value").cast(PAYMENT_MONEY).alias("payment_value"),
    )


def stg_order_reviews(raw: DataFrame) -> DataFrame:
    """The review id alone is shared between orders; the key names both."""
    return raw.select(
        F.concat(_text("review_id"), F.lit("-"), _text("order_id")).alias("review_key"),
        _text("review_id").alias("review_id"),
        _text("order_id").alias("order_id"),
        F.col("review_score").cast("int").alias("review_score"),
        _text("review_comment_title").alias("review_comment_title"),
        _text("review_comment_message").alias("review_comment_message"),
        F.col("review_creation_date").cast(TIMESTAMP).alias("review_created_at"),
        F.col("review_answer_timestamp").cast(TIMESTAMP).alias("review_answered_at"),
    )


def stg_geolocation(raw: DataFrame) -> DataFrame:
    return raw.select(
        _text("geolocation_zip_code_prefix").alias("zip_code_prefix"),
        F.col("geolocation_lat").cast("double").alias("latitude"),
        F.col("geolocation_lng").cast("double").alias("longitude"),
        _lower("geolocation_city").alias("geo_city"),
        _upper("geolocation_state").alias("geo_state"),
    )


def stg_category_translation(raw: DataFrame) -> DataFrame:
    return raw.select(
        _lower("product_category_name").alias("category_name_pt"),
        _lower("product_category_name_english").alias("category_name_en"),
    )


STAGING = {
    "customers": stg_customers,
    "orders": stg_orders,
    "order_items": stg_order_items,
    "products": stg_products,
    "sellers": stg_sellers,
    "order_payments": stg_order_payments,
    "order_reviews": stg_order_reviews,
    "geolocation": stg_geolocation,
    "category_translation": stg_category_translation,
}
