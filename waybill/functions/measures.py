"""Aggregate expressions shared by the marts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_count() -> Column:
    return F.count(F.lit(1))


def rate(condition: Column) -> Column:
    """Share of rows that meet the condition; rows where it is NULL count as not meeting it."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def hits(condition: Column) -> Column:
    """Number of rows that meet the condition."""
    return F.count_if(condition)


def ratio(part: Column, whole: Column) -> Column:
    """Double division that gives NULL for an empty denominator."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def weighted_mean(value: str, weight: str) -> Column:
    return ratio(F.sum(F.col(value) * F.col(weight)), F.sum(weight))
