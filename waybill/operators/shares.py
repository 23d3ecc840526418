"""Share of a grand total."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from waybill.functions.measures import ratio


def share_of_total(df: DataFrame, value: str, out: str) -> DataFrame:
    """Adds `value / sum(value)`; the total is a scalar subquery, so no row has to move.

    `df` is evaluated twice: give it a stored table or a cheap plan.
    """
    total = df.agg(F.sum(value).alias("total")).scalar()
    return df.withColumn(out, ratio(F.col(value), total))


def share_within_labels(df: DataFrame, value: str, out: str) -> DataFrame:
    """The same for a frame with one row per fixed label, evaluated once.

    The window gathers all rows in one task: only for frames whose row count is bounded by a
    list of labels.
    """
    return df.withColumn(out, ratio(F.col(value), F.sum(value).over(W.partitionBy())))
