"""Data behind the charts: labels, error bars, threshold classes. Drawing is left to the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.functions.measures import weighted_mean
from waybill.functions.text import strip_sort_prefix
from waybill.operators.proportions import Z95, standard_error
from waybill.plans.report import MIN_MONTH_ORDERS, MIN_STATE_ORDERS, states_by_late_rate

# Late rates from which a state counts as high or raised.
HIGH_LATE_RATE, RAISED_LATE_RATE = 0.12, 0.08


def chart_reviews_by_lateness(mart_lateness: DataFrame) -> DataFrame:
    return mart_lateness.select(
        strip_sort_prefix(F.col("lateness_bucket")).alias("label"),
        "avg_review",
        "orders",
        "negative_review_rate",
    )


def chart_retention_ci(test: DataFrame) -> DataFrame:
    """Two bars in percent with the half-width of their 95% interval."""
    bars = test.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(label).alias("label"),
                        F.col(p).alias("share"),
                        F.col(x).alias("repeat_customers"),
                        F.col(n).alias("customers"),
                    )
                    for label, p, x, n in (
                        ("On-time first delivery", "p1", "on_time_repeat", "on_time_customers"),
                        ("Late first delivery", "p2", "late_repeat", "late_customers"),
                    )
                ]
            )
        )
    )
    error = standard_error(F.col("share"), F.col("customers"))
    return bars.select(
        "label",
        (F.col("share") * 100.0).alias("repeat_pct"),
        (Z95 * error * 100.0).alias("half_width_pct"),
        "repeat_customers",
        "customers",
    )


def overall_late_rate(mart: DataFrame) -> DataFrame:
    """Late rate of all orders from any mart with `late_rate` and `orders`."""
    return mart.agg(weighted_mean("late_rate", "orders").alias("late_rate"))


def chart_states(mart_state: DataFrame, min_orders: int = MIN_STATE_ORDERS) -> DataFrame:
    """States for a bar chart, the lowest late rate first."""
    rate = F.col("late_rate")
    states = states_by_late_rate(mart_state, min_orders)
    return states.orderBy(rate.asc_nulls_first(), F.col("customer_state").asc_nulls_first()).select(
        "customer_state",
        (rate * 100.0).alias("late_pct"),
        "avg_distance_km",
        F.when(rate >= HIGH_LATE_RATE, "high")
        .when(rate >= RAISED_LATE_RATE, "raised")
        .otherwise("normal")
        .alias("level"),
    )


def chart_distance(mart_distance: DataFrame) -> DataFrame:
    return mart_distance.filter(~F.col("distance_band").startswith("9")).select(
        strip_sort_prefix(F.col("distance_band")).alias("label"),
        (F.col("late_rate") * 100.0).alias("late_pct"),
        "avg_delivery_days",
        "avg_review",
    )


def chart_monthly(mart_monthly: DataFrame, min_orders: int = MIN_MONTH_ORDERS) -> DataFrame:
    return mart_monthly.filter(F.col("orders") >= min_orders).select(
        "order_month", (F.col("late_rate") * 100.0).alias("late_pct"), "avg_review"
    )
