"""Summary figures and their text lines."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions.bands import DISTANCE_UNKNOWN, LATE, ON_TIME
from waybill.functions.measures import rate, ratio, row_count
from waybill.functions.text import fixed, month_label, percent, strip_sort_prefix, thousands

# Smallest groups worth naming in the summary, and how many are named.
MIN_STATE_ORDERS, STATES_NAMED = 300, 5
MIN_MONTH_ORDERS, MONTHS_NAMED = 500, 3


def report_totals(fct_orders: DataFrame) -> DataFrame:
    """Each distinct count reads its own column; together they would expand the fact's rows."""

    def distinct(column: str) -> Column:
        return fct_orders.agg(F.countDistinct(column)).scalar()

    return fct_orders.agg(
        row_count().alias("orders"),
        rate(F.col("is_late")).alias("late_rate"),
        F.min("purchased_at").alias("first_order"),
        F.max("purchased_at").alias("last_order"),
    ).select(
        "orders",
        distinct("customer_unique_id").alias("customers"),
        distinct("main_seller_id").alias("sellers"),
        "late_rate",
        "first_order",
        "last_order",
    )


def report_headline(late_vs_ontime: DataFrame) -> DataFrame:
    """Late and on-time figures side by side, with how many times as many reviews are negative."""

    def of(label: str, value: str) -> Column:
        return F.max(F.when(F.col("delivery") == label, F.col(value)))

    values = ("avg_review", "negative_review_rate", "five_star_rate")
    sides = {"late": LATE, "on_time": ON_TIME}
    return late_vs_ontime.agg(
        *[of(label, v).alias(f"{side}_{v}") for side, label in sides.items() for v in values]
    ).withColumn(
        "negative_review_ratio",
        ratio(F.col("late_negative_review_rate"), F.col("on_time_negative_review_rate")),
    )


def states_by_late_rate(mart_state: DataFrame, min_orders: int = MIN_STATE_ORDERS) -> DataFrame:
    return mart_state.filter(F.col("orders") >= min_orders)


def report_states(
    mart_state: DataFrame, min_orders: int = MIN_STATE_ORDERS, top: int = STATES_NAMED
) -> DataFrame:
    """States with the highest late rate among those with enough orders."""
    return (
        states_by_late_rate(mart_state, min_orders)
        .orderBy(F.col("late_rate").desc_nulls_last(), F.col("customer_state").asc_nulls_last())
        .limit(top)
    )


def report_distance(mart_distance: DataFrame) -> DataFrame:
    """Known distance bands, the nearest first."""
    return mart_distance.filter(F.col("distance_band") != DISTANCE_UNKNOWN).orderBy("distance_band")


def report_seller_deciles(mart_seller: DataFrame) -> DataFrame:
    """Per decile: the late rate weighs sellers by orders, the review is a mean of seller means."""
    return mart_seller.groupBy("late_rate_decile").agg(
        row_count().alias("sellers"),
        F.sum("orders").alias("orders"),
        ratio(F.sum("late_orders"), F.sum("orders")).alias("late_rate"),
        F.avg("avg_review").alias("avg_review"),
    ).orderBy("late_rate_decile")


def report_decile_ends(deciles: DataFrame) -> DataFrame:
    """One row: all sellers counted, and the worst and the best decile."""
    worst, best = (
        pick(F.struct("late_rate", "avg_review"), "late_rate_decile")
        for pick in (F.min_by, F.max_by)
    )
    return deciles.agg(
        F.sum("sellers").alias("sellers"), worst.alias("worst"), best.alias("best")
    ).select(
        "sellers",
        F.col("worst.late_rate").alias("worst_late_rate"),
        F.col("worst.avg_review").alias("worst_avg_review"),
        F.col("best.late_rate").alias("best_late_rate"),
        F.col("best.avg_review").alias("best_avg_review"),
    )


def report_worst_months(
    mart_monthly: DataFrame, min_orders: int = MIN_MONTH_ORDERS, top: int = MONTHS_NAMED
) -> DataFrame:
    return (
        mart_monthly.filter(F.col("orders") >= min_orders)
        .orderBy(F.col("late_rate").desc_nulls_last(), F.col("order_month").asc_nulls_last())
        .limit(top)
    )


def _lines(section: int, df: DataFrame, position: Column, *parts: str | Column) -> DataFrame:
    """One text line per row; parts are literal text or formatted columns, `unknown` where NULL."""
    text = F.concat(
        *[F.lit(p) if isinstance(p, str) else F.coalesce(p, F.lit("unknown")) for p in parts]
    )
    return df.select(
        F.lit(section).alias("section"), position.cast("string").alias("position"), text.alias("line")
    )


def summary_lines(
    t: Mapping[str, DataFrame], test: DataFrame, window_days: int, min_seller_orders: int
) -> DataFrame:
    """The summary as (section, position, line), to be written in that order.

    All inputs but the fact are marts, so each part is a few formatted rows.
    """
    c, first = F.col, F.lit(0)
    parts = [
        _lines(
            1, report_totals(t["fct_orders"]), first,
            thousands(c("orders")), " delivered orders, ", thousands(c("customers")),
            " customers, ", thousands(c("sellers")), " sellers, ", month_label(c("first_order")),
            " to ", month_label(c("last_order")), "; late: ", percent(c("late_rate"), 1),
        ),
        _lines(
            2, report_headline(t["mart_late_vs_ontime"]), first,
            "Reviews, late / on time: average ", fixed(c("late_avg_review"), 2), " / ",
            fixed(c("on_time_avg_review"), 2), ", 1-2 stars ",
            percent(c("late_negative_review_rate")), " / ",
            percent(c("on_time_negative_review_rate")), " (",
            fixed(c("negative_review_ratio"), 1), "x), 5 stars ",
            percent(c("late_five_star_rate")), " / ", percent(c("on_time_five_star_rate")),
        ),
        _lines(
            3, t["mart_lateness"], c("lateness_bucket"),
            "Lateness ", strip_sort_prefix(c("lateness_bucket")), ": ", thousands(c("orders")),
            " reviewed orders, average review ", fixed(c("avg_review"), 2), ", ",
            percent(c("negative_review_rate")), " negative",
        ),
        _lines(
            4, test, first,
            f"Came back within {window_days} days, on time / late: ",
            thousands(c("on_time_repeat")), " of ", thousands(c("on_time_customers")), " (",
            percent(c("p1"), 2), ") / ", thousands(c("late_repeat")), " of ",
            thousands(c("late_customers")), " (", percent(c("p2"), 2), "), relative gap ",
            percent(F.abs("relative_diff")), ", z ", fixed(c("z"), 2), ", p ",
            fixed(c("p_value"), 3), ", 95% interval ", fixed(c("ci_low") * 100, 2), " to ",
            fixed(c("ci_high") * 100, 2), " points",
        ),
        _lines(
            5, report_states(t["mart_state"]), F.format_string("%05d", c("late_rank")),
            "State ", c("customer_state"), ": ", percent(c("late_rate"), 1), " late, ",
            thousands(c("orders")), " orders, ",
            thousands(c("avg_distance_km")),
            " km from the seller on average, average review ",
            F.coalesce(fixed(c("avg_review"), 2), F.lit("none")),
        ),
        _lines(
            6, report_distance(t["mart_distance"]), c("distance_band"),
            "Distance ", strip_sort_prefix(c("distance_band")), ": ", percent(c("late_rate"), 1),
            " late, ", fixed(c("avg_delivery_days"), 1), " days to deliver",
        ),
        _lines(
            7, report_decile_ends(report_seller_deciles(t["mart_seller"])), first,
            thousands(c("sellers")), f" sellers with at least {min_seller_orders} orders; ",
            "worst tenth ", percent(c("worst_late_rate"), 1), " late, average review ",
            F.coalesce(fixed(c("worst_avg_review"), 2), F.lit("none")), "; best tenth ",
            percent(c("best_late_rate"), 1), " late, average review ",
            F.coalesce(fixed(c("best_avg_review"), 2), F.lit("none")),
        ),
        _lines(
            8, report_worst_months(t["mart_monthly"]),
            F.format_string("%.12f", 1.0 - c("late_rate")),
            "Month ", month_label(c("order_month")), ": ", percent(c("late_rate"), 1), " late",
        ),
    ]
    return reduce(DataFrame.unionByName, parts)
