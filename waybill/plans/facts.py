"""Order-grain fact, customer sequence and first-order retention."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from waybill.functions.bands import lateness_bucket
from waybill.functions.geo import haversine_km
from waybill.functions.measures import row_count
from waybill.functions.timing import days_between, month_of
from waybill.operators.dedupe import first_per_key
from waybill.operators.retention import first_event_retention
from waybill.operators.sequence import sequence_events
from waybill.params import Params

Tables = Mapping[str, DataFrame]

# Order statuses.
DELIVERED = "delivered"
NOT_AN_ORDER = ("canceled", "unavailable")


def main_line_first() -> list[Column]:
    """The line with the highest price, ties going to the lowest line number.

    Lines equal in both are settled by their keys.
    """
    return [
        F.col("price").desc_nulls_last(),
        F.col("order_item_id").asc_nulls_last(),
        F.col("product_id").desc_nulls_last(),
        F.col("seller_id").desc_nulls_last(),
    ]


def order_lines(items: DataFrame) -> DataFrame:
    """Per order: line count, distinct sellers, value, freight, and the main line's keys.

    The lines move once, by order. The main line is found in a window over the order, and the sums by
    seller and then by order are taken where the lines then are. Lines without an order have no main line.
    """
    line = W.partitionBy("order_id").orderBy(*main_line_first())

    def of_main_line(key: str) -> Column:
        return F.when(F.col("order_id").isNotNull(), F.first(key).over(line)).alias(f"main_{key}")

    per_order = ["order_id", "main_seller_id", "main_product_id"]
    by_seller = (
        items.select("*", of_main_line("seller_id"), of_main_line("product_id"))
        .groupBy(*per_order, "seller_id")
        .agg(
            row_count().alias("lines"),
            F.sum("price").alias("value"),
            F.sum("freight").alias("freight"),
        )
    )
    totals = by_seller.groupBy(*per_order).agg(
        F.sum("lines").alias("item_count"),
        F.count("seller_id").alias("seller_count"),
        F.sum("value").alias("item_value"),
        F.sum("freight").alias("freight_value"),
    )
    return totals.select(
        "order_id",
        "item_count",
        "seller_count",
        "item_value",
        "freight_value",
        "main_seller_id",
        "main_product_id",
    )


def main_lines(items: DataFrame) -> DataFrame:
    """The main line of each order, as it stands."""
    return first_per_key(items, ["order_id"], main_line_first())


def order_payments(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("paid_value"), F.max("installments").alias("installments")
    )


def delivered_orders(orders: DataFrame) -> DataFrame:
    return orders.filter(
        (F.col("order_status") == DELIVERED)
        & F.col("delivered_at").isNotNull()
        & F.col("estimated_at").isNotNull()
    )


def order_timing(orders: DataFrame) -> DataFrame:
    """Adds month, day differences and lateness to orders that have all three timestamps."""
    late_days = days_between(F.col("estimated_at"), F.col("delivered_at"))
    return orders.withColumns(
        {
            "order_month": month_of(F.col("purchased_at")),
            "delivery_days": days_between(F.col("purchased_at"), F.col("delivered_at")),
            "promised_days": days_between(F.col("purchased_at"), F.col("estimated_at")),
            "days_late": late_days,
            # The same calendar day is on time, whatever the hour.
            "is_late": late_days > 0,
            "lateness_bucket": lateness_bucket(late_days),
        }
    )


def located(df: DataFrame, zip_column: str, geo: DataFrame, lat: str, lng: str) -> DataFrame:
    """Adds the zip's mean point where it is known."""
    points = geo.select(
        F.col("zip").alias("_zip"), F.col("lat").alias(lat), F.col("lng").alias(lng)
    )
    return df.join(points, df[zip_column] == points["_zip"], "left").drop("_zip")


def build_fct_orders(t: Tables) -> DataFrame:
    """One row per delivered order, 27 columns.

    Everything keyed by order is joined first, on the partitioning the reductions already have.
    Coordinates are attached to sellers and customers before those meet the orders, so the wide
    rows never move for a zip lookup. No join carries a broadcast hint: dimensions are broadcast
    when Spark's size estimate allows it and shuffled, with skew splitting, beyond that.
    """
    sellers = located(t["stg_sellers"], "seller_zip", t["stg_zip_geo"], "seller_lat", "seller_lng")
    customers = located(t["stg_customers"], "customer_zip", t["stg_zip_geo"], "cust_lat", "cust_lng")
    products = t["stg_products"].select(
        F.col("product_id").alias("main_product_id"), F.col("category").alias("main_category")
    )
    reviews = t["stg_reviews"].select("order_id", "review_score", "has_comment")
    # A line without a seller can be the main line; such an order has no seller to join.
    orders = (
        delivered_orders(t["stg_orders"])
        .join(order_lines(t["stg_order_items"]), "order_id")
        .join(order_payments(t["stg_payments"]), "order_id", "left")
        .join(reviews, "order_id", "left")
        .join(sellers.withColumnRenamed("seller_id", "main_seller_id"), "main_seller_id")
        .join(products, "main_product_id", "left")
        .join(customers, "customer_id")
    )
    return order_timing(orders).select(
        "order_id",
        "customer_unique_id",
        "purchased_at",
        "order_month",
        "delivered_at",
        "estimated_at",
        "delivery_days",
        "promised_days",
        "days_late",
        "is_late",
        "lateness_bucket",
        "review_score",
        (F.col("review_score") <= 2).alias("is_negative_review"),
        "has_comment",
        "item_count",
        "seller_count",
        "item_value",
        "freight_value",
        "paid_value",
        "installments",
        "customer_state",
        "customer_city",
        "main_seller_id",
        "seller_state",
        "main_category",
        (F.col("customer_state") == F.col("seller_state")).alias("same_state"),
        haversine_km(
            F.col("seller_lat"), F.col("seller_lng"), F.col("cust_lat"), F.col("cust_lng")
        ).alias("distance_km"),
    )


def customer_sequence(t: Tables, fct_orders: DataFrame | None = None) -> DataFrame:
    """Every order of a person in time, canceled and unavailable ones left out.

    With the fact, it also carries when each person's first order was delivered.
    """
    orders = t["stg_orders"]
    people = t["stg_customers"].select("customer_id", "customer_unique_id")
    kept = orders.filter(~F.col("order_status").isin(*NOT_AN_ORDER))
    events = kept.join(people, "customer_id").select(
        "customer_unique_id", "order_id", "purchased_at"
    )
    return sequence_events(
        events, "customer_unique_id", "order_id", "purchased_at", outcomes=fct_orders, outcome_ts="delivered_at"
    )


def customer_orders(sequence: DataFrame) -> DataFrame:
    """The published form of the sequence."""
    return sequence.select(
        "customer_unique_id",
        "order_id",
        "purchased_at",
        F.col("event_seq").alias("order_seq"),
        F.col("next_ts").alias("next_purchased_at"),
    )


def first_order_retention(
    sequence: DataFrame, fct_orders: DataFrame, orders: DataFrame, params: Params = Params()
) -> DataFrame:
    """Delivered first orders: the fact's columns, the next order after delivery and its flags.

    The data end is the last purchase among all orders, canceled ones included.
    """
    return first_event_retention(
        sequence,
        fct_orders,
        entity="customer_unique_id",
        ts="purchased_at",
        outcome_event="order_id",
        outcome_ts="delivered_at",
        data_end=orders.agg(F.max("purchased_at").alias("data_end")).scalar(),
        window_days=params.window_days,
    )
