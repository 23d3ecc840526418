"""Dashboard fields over the order fact."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions.bands import bi_distance_band
from waybill.functions.measures import hits, ratio, row_count
from waybill.functions.text import strip_sort_prefix


def with_bi_fields(fct_orders: DataFrame) -> DataFrame:
    """Adds the two label fields without sort prefixes."""
    return fct_orders.withColumns(
        {
            "lateness_label": strip_sort_prefix(F.col("lateness_bucket")),
            "distance_label": bi_distance_band(F.col("distance_km")),
        }
    )


def bi_filters(
    fct_orders: DataFrame,
    months: tuple[dt.date, dt.date] | None = None,
    states: Sequence[str] | None = None,
    categories: Sequence[str] | None = None,
) -> DataFrame:
    """The dashboard's filters. The month range prunes partitions of the stored fact."""
    if months is not None:
        fct_orders = fct_orders.filter(F.col("order_month").between(*months))
    if states is not None:
        fct_orders = fct_orders.filter(F.col("customer_state").isin(*states))
    if categories is not None:
        fct_orders = fct_orders.filter(F.col("main_category").isin(*categories))
    return fct_orders


def bi_measures() -> list[Column]:
    late_orders = hits(F.col("is_late"))
    return [
        row_count().alias("orders"),
        late_orders.alias("late_orders"),
        ratio(late_orders, F.count("order_id")).alias("late_rate"),
        F.avg("review_score").alias("avg_review"),
        ratio(hits(F.col("review_score") <= 2), F.count("review_score")).alias(
            "negative_review_rate"
        ),
        F.avg("distance_km").alias("avg_distance_km"),
    ]


def bi_kpis(fct_orders: DataFrame, *by: str, **filters) -> DataFrame:
    """KPI fields overall, or per value of the given fields."""
    return bi_filters(with_bi_fields(fct_orders), **filters).groupBy(*by).agg(*bi_measures())


def top_sellers(mart_seller: DataFrame, k: int) -> DataFrame:
    """Sellers with the most late orders."""
    most_late = [F.col("late_orders").desc_nulls_last(), F.col("seller_id").asc_nulls_last()]
    return (
        mart_seller.orderBy(*most_late)
        .limit(k)
        .select("seller_id", "late_orders", "late_rate", "avg_review")
    )
