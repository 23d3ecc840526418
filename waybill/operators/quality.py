"""Data-quality checks: each yields a name and the number of failing rows."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions.measures import hits, row_count
from waybill.sources.storage import scratch_table


class QualityError(RuntimeError):
    """Some check has failing rows."""


def unique_check(key: str) -> Column:
    """Rows beyond the first of each key; rows without a key all count as failing."""
    return row_count() - F.countDistinct(key)


def range_check(column: str, low: float, high: float) -> Column:
    """Rows outside the inclusive range; unknown values pass."""
    return hits(~F.col(column).between(low, high))


def predicate_check(failing: Column) -> Column:
    """Rows that meet the failing condition; where it is NULL the row passes."""
    return hits(failing)


def scan_checks(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """All row-level checks on one table in a single pass over it."""
    counted = df.agg(*[check.alias(f"c{i}") for i, check in enumerate(checks.values())])
    pairs = [
        F.struct(F.lit(name).alias("check_name"), F.col(f"c{i}").alias("failing_rows"))
        for i, name in enumerate(checks)
    ]
    return counted.select(F.inline(F.array(*pairs)))


def fk_check(
    name: str, child: DataFrame, child_key: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Child rows whose key is missing or not in the parent.

    Child rows are counted per key before the anti-join, so a key with most of the rows, or most
    rows having no key, is one row by then.
    """
    per_key = child.groupBy(F.col(child_key).alias("_key")).agg(row_count().alias("_rows"))
    known = parent.select(F.col(parent_key).alias("_key"))
    return (
        per_key.join(known, "_key", "left_anti")
        .agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("failing_rows"))
        .select(F.lit(name).alias("check_name"), "failing_rows")
    )


def line_checks(items: DataFrame, sellers: DataFrame, products: DataFrame) -> DataFrame:
    """Negative prices and unknown sellers and products, from one pass over the lines.

    The pass counts lines per seller, per product and in all; only those counts, written once, meet
    the dimensions.
    """
    negative = hits((F.col("price") < 0) | (F.col("freight") < 0)).alias("_negative")
    counts = scratch_table(
        items.groupingSets([["seller_id"], ["product_id"], []], "seller_id", "product_id").agg(
            F.grouping_id().alias("_level"), row_count().alias("_rows"), negative
        ),
        "line-counts",
    )

    def orphans(name: str, level: int, parent: DataFrame, key: str) -> DataFrame:
        own = counts.filter(F.col("_level") == level)
        return (
            own.join(parent.select(key), key, "left_anti")
            .agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("failing_rows"))
            .select(F.lit(name).alias("check_name"), "failing_rows")
        )

    bad_prices = counts.filter("_level = 3").select(
        F.lit("Negative prices or freight").alias("check_name"),
        F.col("_negative").alias("failing_rows"),
    )
    return bad_prices.unionByName(
        orphans("Order items with an unknown seller", 1, sellers, "seller_id")
    ).unionByName(orphans("Order items with an unknown product", 2, products, "product_id"))


def run_checks(
    t: Mapping[str, DataFrame], fct_orders: DataFrame, retention: DataFrame
) -> DataFrame:
    """The ten checks of the pipeline, one row each; all should be 0."""
    # The check names are part of the published report.
    items, reviews = t["stg_order_items"], t["stg_reviews"]
    reports = [
        scan_checks(
            fct_orders,
            {
                "Duplicate order IDs in fct_orders": unique_check("order_id"),
                "Delivered before purchase": predicate_check(
                    F.col("delivered_at") < F.col("purchased_at")
                ),
                "Distance over 5,000 km (bad coordinates)": predicate_check(
                    F.col("distance_km") > 5000
                ),
            },
        ),
        scan_checks(
            reviews,
            {
                "More than one review per order after dedupe": unique_check("order_id"),
                "Review scores outside 1-5": range_check("review_score", 1, 5),
            },
        ),
        line_checks(items, t["stg_sellers"], t["stg_products"]),
        scan_checks(
            retention,
            {"Customers with more than one first order": unique_check("customer_unique_id")},
        ),
        fk_check(
            "Orders without a customer",
            t["stg_orders"],
            "customer_id",
            t["stg_customers"],
            "customer_id",
        ),
    ]
    return reduce(DataFrame.unionByName, reports)


def gate(report: DataFrame) -> DataFrame:
    """Raise when any check has failing rows; returns the report otherwise."""
    failing = report.filter("failing_rows <> 0").collect()  # at most one row per check
    if failing:
        listed = ", ".join(f"{row.check_name}: {row.failing_rows}" for row in failing)
        raise QualityError(f"data quality checks failed: {listed}")
    return report
