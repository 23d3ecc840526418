"""Reporting marts. Each is one row per group; order them when they are read or exported.

The six marts of the order fact are finished from one table of partial states: counts and sums per
group, for all groupings in a single pass over the fact. States add up, so they could as well be
kept per month and merged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from waybill.functions.bands import delivery_label, distance_band
from waybill.functions.measures import hits, rate, ratio, row_count
from waybill.operators.ranking import ntile_scalable
from waybill.operators.shares import share_of_total, share_within_labels
from waybill.params import Params
from waybill.sources.storage import scratch_path, scratch_table, write_table


def groupings() -> dict[str, Column]:
    """The key of each mart of the fact, by the name of the column that holds it."""
    return {
        "lateness_bucket": F.col("lateness_bucket"),
        "delivery": delivery_label(F.col("is_late")),
        "customer_state": F.col("customer_state"),
        "seller_id": F.col("main_seller_id"),
        "order_month": F.col("order_month"),
        "distance_band": distance_band(F.col("distance_km")),
    }


def _known(value: str) -> list[Column]:
    """Sum and count of the values that are not null."""
    return [F.sum(value).alias(f"{value}_sum"), F.count(value).alias(f"{value}_count")]


def _mean(value: str, out: str) -> Column:
    return ratio(F.col(f"{value}_sum"), F.col(f"{value}_count")).alias(out)


def _share(part: str, whole: str, out: str) -> Column:
    return ratio(F.col(part), F.col(whole)).alias(out)


def _states() -> dict[str, list[Column]]:
    """What is kept of each column of the fact."""
    return {
        "is_late": [hits(F.col("is_late")).alias("late_orders")],
        "review_score": [*_known("review_score"), hits(F.col("review_score") == 5).alias("five_stars")],
        "is_negative_review": [hits(F.col("is_negative_review")).alias("negative_reviews")],
        "delivery_days": _known("delivery_days"),
        "reviewed_days": _known("reviewed_days"),
        "promised_days": _known("promised_days"),
        "distance_km": _known("distance_km"),
        "item_value": [F.sum("item_value").alias("item_value")],
        "seller_state": [F.max("seller_state").alias("seller_state")],
    }


def fact_states(
    fct_orders: DataFrame, keys: Sequence[str] | None = None, values: Sequence[str] | None = None
) -> DataFrame:
    """Partial states per group, for each of `keys` (all by default): `grouping` names the key.

    One scan of the fact's columns that the marts need (`values`, all by default), expanded once per
    key and combined before its only shuffle. A null key is a group of its own; an empty fact has no
    groups. `reviewed_days` are the delivery days of reviewed orders.
    """
    by = {key: column for key, column in groupings().items() if keys is None or key in keys}
    kept = {value: states for value, states in _states().items() if values is None or value in values}
    reviewed_days = F.when(F.col("review_score").isNotNull(), F.col("delivery_days")).alias("reviewed_days")
    rows = fct_orders.select(
        *[column.alias(f"by_{key}") for key, column in by.items()],
        *[reviewed_days if value == "reviewed_days" else F.col(value) for value in kept],
    )
    names = [f"by_{key}" for key in by]
    states = rows.groupingSets([[F.col(name)] for name in names], *names).agg(
        F.grouping_id().alias("missing"),
        row_count().alias("orders"),
        *[state for states in kept.values() for state in states],
    )
    # A bit per key, first key highest, set where the key is not part of the group.
    every = (1 << len(by)) - 1
    grouping = F.coalesce(
        *[
            F.when(F.col("missing") == every - (1 << (len(by) - 1 - place)), key)
            for place, key in enumerate(by)
        ]
    )
    return states.withColumn("grouping", grouping).drop("missing")


def _group(states: DataFrame, key: str) -> DataFrame:
    """The states of one key, in a column of its name."""
    return states.filter(F.col("grouping") == key).withColumnRenamed(f"by_{key}", key)


def finish_lateness(states: DataFrame, retention: DataFrame) -> DataFrame:
    """Review scores of reviewed orders and repeat rate of mature first orders, by lateness.

    Buckets without a reviewed order are left out, whatever the retention side has.
    """
    reviews = (
        _group(states, "lateness_bucket")
        .filter("review_score_count > 0")
        .select(
            "lateness_bucket",
            F.col("review_score_count").alias("orders"),
            _mean("review_score", "avg_review"),
            _share("negative_reviews", "review_score_count", "negative_review_rate"),
        )
    )
    repeats = (
        retention.filter("is_mature")
        .groupBy("lateness_bucket")
        .agg(row_count().alias("mature_first_orders"), rate(F.col("repeat_in_window")).alias("repeat_rate"))
    )
    return (
        share_within_labels(reviews, "orders", "share_of_orders")
        .join(repeats, "lateness_bucket", "left")
        .select(
            "lateness_bucket",
            "orders",
            "share_of_orders",
            "avg_review",
            "negative_review_rate",
            "mature_first_orders",
            "repeat_rate",
        )
    )


def finish_late_vs_ontime(states: DataFrame) -> DataFrame:
    return (
        _group(states, "delivery")
        .filter("review_score_count > 0")
        .select(
            "delivery",
            F.col("review_score_count").alias("orders"),
            _mean("review_score", "avg_review"),
            _share("negative_reviews", "review_score_count", "negative_review_rate"),
            _share("five_stars", "review_score_count", "five_star_rate"),
            _mean("reviewed_days", "avg_delivery_days"),
        )
    )


def finish_state(states: DataFrame) -> DataFrame:
    """By customer state; rank 1 has the highest late rate, equal rates share a rank."""
    by_state = _group(states, "customer_state").select(
        "customer_state",
        "orders",
        _share("late_orders", "orders", "late_rate"),
        _mean("delivery_days", "avg_delivery_days"),
        _mean("promised_days", "avg_promised_days"),
        _mean("distance_km", "avg_distance_km"),
        _mean("review_score", "avg_review"),
    )
    # One row per state of the country by now, so a single-task window is enough.
    worst_first = W.orderBy(F.col("late_rate").desc_nulls_last())
    return by_state.withColumn("late_rank", F.rank().over(worst_first).cast("bigint"))


def seller_totals(states: DataFrame, min_orders: int) -> DataFrame:
    """Whole orders credited to their main seller, sellers with few orders left out."""
    return (
        _group(states, "seller_id")
        .filter(F.col("orders") >= min_orders)
        .select(
            "seller_id",
            "seller_state",
            "orders",
            "late_orders",
            _share("late_orders", "orders", "late_rate"),
            _mean("review_score", "avg_review"),
            "item_value",
        )
    )


def finish_seller(totals: DataFrame) -> DataFrame:
    """By main seller, with the share of all late orders and the late-rate decile (1 is worst).

    Sellers with equal late rates are ordered by id, so deciles are reproducible. `totals` is read
    twice, so it should come from a stored table: sellers grow with the data.
    """
    worst_first = [F.col("late_rate").desc_nulls_last(), F.col("seller_id").asc_nulls_last()]
    shared = share_of_total(totals, "late_orders", "share_of_all_late_orders")
    return ntile_scalable(shared, worst_first, 10, "late_rate_decile")


def finish_monthly(states: DataFrame) -> DataFrame:
    return _group(states, "order_month").select(
        "order_month",
        "orders",
        _share("late_orders", "orders", "late_rate"),
        _mean("review_score", "avg_review"),
        _mean("delivery_days", "avg_delivery_days"),
    )


def finish_distance(states: DataFrame) -> DataFrame:
    return _group(states, "distance_band").select(
        "distance_band",
        "orders",
        _share("late_orders", "orders", "late_rate"),
        _mean("delivery_days", "avg_delivery_days"),
        _mean("promised_days", "avg_promised_days"),
        _mean("review_score", "avg_review"),
    )


def mart_lateness(fct_orders: DataFrame, retention: DataFrame) -> DataFrame:
    states = fact_states(fct_orders, ["lateness_bucket"], ["review_score", "is_negative_review"])
    return finish_lateness(states, retention)


def mart_late_vs_ontime(fct_orders: DataFrame) -> DataFrame:
    return finish_late_vs_ontime(fact_states(fct_orders, ["delivery"]))


def mart_retention_late_vs_ontime(retention: DataFrame) -> DataFrame:
    return (
        retention.filter("is_mature")
        .groupBy(delivery_label(F.col("is_late")).alias("first_delivery"))
        .agg(
            row_count().alias("customers"),
            hits(F.col("repeat_in_window")).alias("repeat_customers"),
            rate(F.col("repeat_in_window")).alias("repeat_rate"),
        )
    )


def mart_state(fct_orders: DataFrame) -> DataFrame:
    return finish_state(fact_states(fct_orders, ["customer_state"]))


def mart_seller(fct_orders: DataFrame, params: Params = Params()) -> DataFrame:
    """Seller totals are stored once, then ranked and summed from there."""
    totals = seller_totals(fact_states(fct_orders, ["seller_id"]), params.min_seller_orders)
    return finish_seller(scratch_table(totals, "sellers"))


def mart_monthly(fct_orders: DataFrame) -> DataFrame:
    return finish_monthly(fact_states(fct_orders, ["order_month"]))


def mart_distance(fct_orders: DataFrame) -> DataFrame:
    return finish_distance(fact_states(fct_orders, ["distance_band"]))


def build_marts(
    fct_orders: DataFrame, retention: DataFrame, params: Params = Params()
) -> dict[str, DataFrame]:
    """All marts. The fact is read once, at once, for the states; they are stored by key, so that
    each mart reads only its own.
    """
    spark = fct_orders.sparkSession
    states = write_table(fact_states(fct_orders), scratch_path(spark, "mart-states"), partition_by="grouping")
    return {
        "mart_lateness": finish_lateness(states, retention),
        "mart_late_vs_ontime": finish_late_vs_ontime(states),
        "mart_retention_late_vs_ontime": mart_retention_late_vs_ontime(retention),
        "mart_state": finish_state(states),
        "mart_seller": finish_seller(seller_totals(states, params.min_seller_orders)),
        "mart_monthly": finish_monthly(states),
        "mart_distance": finish_distance(states),
    }
