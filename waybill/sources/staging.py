"""Typed staging tables from the raw text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions.geo import centroids
from waybill.functions.text import has_text, pad_code
from waybill.operators.dedupe import first_per_key
from waybill.params import COUNTRY_BOX, Box

UNKNOWN_CATEGORY = "unknown"


def _as_ts(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz")


def _as_double(name: str) -> Column:
    return F.col(name).cast("double")


def _as_int(name: str) -> Column:
    """Whole number from text such as `3` or `3.0`; halves round away from zero."""
    text = F.col(name)
    # The second form is only evaluated for text that is not plainly an integer.
    return F.coalesce(text.try_cast("int"), F.round(text.cast("double"), 0).cast("int"))


def stage_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        "customer_id",
        "order_status",
        _as_ts("order_purchase_timestamp").alias("purchased_at"),
        _as_ts("order_approved_at").alias("approved_at"),
        _as_ts("order_delivered_carrier_date").alias("shipped_at"),
        _as_ts("order_delivered_customer_date").alias("delivered_at"),
        _as_ts("order_estimated_delivery_date").alias("estimated_at"),
    )


def stage_customers(raw: DataFrame) -> DataFrame:
    """One row per order-level customer id; `customer_unique_id` is the person."""
    return raw.select(
        "customer_id",
        "customer_unique_id",
        pad_code(F.col("customer_zip_code_prefix")).alias("customer_zip"),
        "customer_city",
        "customer_state",
    )


def stage_order_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        _as_int("order_item_id").alias("order_item_id"),
        "product_id",
        "seller_id",
        _as_double("price").alias("price"),
        _as_double("freight_value").alias("freight"),
    )


def stage_payments(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        "payment_type",
        _as_int("payment_installments").alias("installments"),
        _as_double("payment_value").alias("payment_value"),
    )


def latest_reviews(reviews: DataFrame) -> DataFrame:
    """The last answered review of each order; equal answer times go to the lowest review id."""
    newest_first = [
        F.col("review_answered_at").desc_nulls_last(),
        F.col("review_id").asc_nulls_last(),
    ]
    return first_per_key(reviews, ["order_id"], newest_first).select(
        "order_id", "review_score", "review_created_at", "review_answered_at", "has_comment"
    )


def stage_reviews(raw: DataFrame) -> DataFrame:
    return latest_reviews(
        raw.select(
            "review_id",
            "order_id",
            _as_int("review_score").alias("review_score"),
            _as_ts("review_creation_date").alias("review_created_at"),
            _as_ts("review_answer_timestamp").alias("review_answered_at"),
            has_text(F.col("review_comment_message")).alias("has_comment"),
        )
    )


def stage_products(raw: DataFrame, translation: DataFrame) -> DataFrame:
    """Category in English where a translation exists, else as given, else `unknown`."""
    english = translation.select(
        F.col("product_category_name").alias("native_name"),
        F.col("product_category_name_english").alias("english_name"),
    )
    return raw.join(
        english, raw["product_category_name"] == english["native_name"], "left"
    ).select(
        "product_id",
        F.coalesce("english_name", "product_category_name", F.lit(UNKNOWN_CATEGORY)).alias(
            "category"
        ),
        F.col("product_weight_g").try_cast("double").alias("weight_g"),
    )


def stage_sellers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "seller_id",
        pad_code(F.col("seller_zip_code_prefix")).alias("seller_zip"),
        "seller_city",
        "seller_state",
    )


def stage_zip_geo(raw: DataFrame, box: Box = COUNTRY_BOX) -> DataFrame:
    """One mean point per zip prefix, bad geocodes left out."""
    points = raw.select(
        pad_code(F.col("geolocation_zip_code_prefix")).alias("zip"),
        _as_double("geolocation_lat").alias("point_lat"),
        _as_double("geolocation_lng").alias("point_lng"),
    )
    return centroids(points, "zip", "point_lat", "point_lng", box)


def stage_all(raw: dict[str, DataFrame], box: Box = COUNTRY_BOX) -> dict[str, DataFrame]:
    return {
        "stg_orders": stage_orders(raw["orders"]),
        "stg_customers": stage_customers(raw["customers"]),
        "stg_order_items": stage_order_items(raw["order_items"]),
        "stg_payments": stage_payments(raw["payments"]),
        "stg_reviews": stage_reviews(raw["reviews"]),
        "stg_products": stage_products(raw["products"], raw["translation"]),
        "stg_sellers": stage_sellers(raw["sellers"]),
        "stg_zip_geo": stage_zip_geo(raw["geolocation"], box),
    }
