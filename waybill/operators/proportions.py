"""Two-proportion z-test as columns, for any number of segments at once."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions.bands import LATE, ON_TIME
from waybill.functions.measures import hits, ratio

# Fixed value: normal quantile of the 95% interval.
Z95 = 1.96


def _complementary_error_function():
    """Vectorised erfc; Spark has no built-in. It sees one value per tested segment.

    Defined in a function so that workers need not import this package.
    """

    @F.pandas_udf("double")
    def erfc(values: pd.Series) -> pd.Series:
        return values.map(math.erfc, na_action="ignore").astype("float64")

    return erfc


def standard_error(p: Column, n: Column) -> Column:
    return F.sqrt(ratio(p * (1.0 - p), n))


def two_proportion_ztest(df: DataFrame, x1: str, n1: str, x2: str, n2: str) -> DataFrame:
    """Adds p1, p2, diff, relative_diff, z, p_value, ci_low, ci_high.

    The statistic uses the pooled standard error, the 95% interval the unpooled one. An empty
    group, or a pooled share of 0 or 1, leaves the affected columns NULL. relative_diff is NaN
    when p1 is 0.
    """
    rates = df.withColumns(
        {"p1": ratio(F.col(x1), F.col(n1)), "p2": ratio(F.col(x2), F.col(n2))}
    )
    pooled = ratio(F.col(x1) + F.col(x2), F.col(n1) + F.col(n2))
    pooled_error = F.sqrt(
        pooled * (1.0 - pooled) * (ratio(F.lit(1), F.col(n1)) + ratio(F.lit(1), F.col(n2)))
    )
    tested = rates.withColumn("diff", F.col("p1") - F.col("p2")).withColumns(
        {
            "relative_diff": F.when(F.col("p1") == 0, float("nan")).otherwise(
                ratio(F.col("diff"), F.col("p1"))
            ),
            "z": ratio(F.col("diff"), pooled_error),
        }
    )
    p1_error, p2_error = (
        standard_error(F.col(p), F.col(n)) for p, n in (("p1", n1), ("p2", n2))
    )
    margin = Z95 * F.sqrt(p1_error * p1_error + p2_error * p2_error)
    erfc = _complementary_error_function()
    return tested.withColumns(
        {
            "p_value": erfc(F.abs("z") / F.sqrt(F.lit(2.0))),
            "ci_low": F.col("diff") - margin,
            "ci_high": F.col("diff") + margin,
        }
    )


def retention_test(mart: DataFrame) -> DataFrame:
    """One row: repeat rates of on-time (1) and late (2) first deliveries, from the mart."""

    def of(label: str, value: str) -> Column:
        return F.max(F.when(F.col("first_delivery") == label, F.col(value)))

    counts = mart.agg(
        of(ON_TIME, "customers").alias("on_time_customers"),
        of(LATE, "customers").alias("late_customers"),
        of(ON_TIME, "repeat_customers").alias("on_time_repeat"),
        of(LATE, "repeat_customers").alias("late_repeat"),
    )
    return _tested(counts)


def retention_test_by(retention: DataFrame, *segments: str) -> DataFrame:
    """The same test for every segment of the mature cohort."""
    late, repeat = F.col("is_late"), F.col("repeat_in_window")
    counts = (
        retention.filter("is_mature")
        .groupBy(*segments)
        .agg(
            hits(~late).alias("on_time_customers"),
            hits(late).alias("late_customers"),
            hits(~late & repeat).alias("on_time_repeat"),
            hits(late & repeat).alias("late_repeat"),
        )
    )
    return _tested(counts)


def _tested(counts: DataFrame) -> DataFrame:
    return two_proportion_ztest(
        counts, "on_time_repeat", "on_time_customers", "late_repeat", "late_customers"
    )
