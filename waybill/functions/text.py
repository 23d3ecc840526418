"""Text helpers for codes, free text and presentation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CODE_WIDTH = 5


def pad_code(code: Column, width: int = CODE_WIDTH) -> Column:
    """Zero-pad on the left to `width`; longer codes keep their first `width` characters."""
    return F.lpad(code, width, "0")


def has_text(message: Column) -> Column:
    """True when the message holds anything but space separators; never NULL.

    Non-breaking and other Unicode spaces count as blank, tabs and newlines do not.
    """
    return F.coalesce(message.rlike(r"[^\p{Zs}]"), F.lit(False))


def strip_sort_prefix(label: Column) -> Column:
    """Drop the digit and the space that only serve to sort a label."""
    return F.substring(label, 3, 2**31 - 1)


def month_label(day: Column) -> Column:
    """`Mar 2018`"""
    return F.date_format(day, "MMM yyyy")


def thousands(value: Column) -> Column:
    """`1,234,567`"""
    return F.format_number(value, 0)


def fixed(value: Column, places: int) -> Column:
    """NULL stays NULL; formatting alone would cut a piece out of the word `null`."""
    return F.when(value.isNotNull(), F.format_string(f"%.{places}f", value.cast("double")))


def percent(share: Column, places: int = 0) -> Column:
    """`0.214` as `21%` or `21.4%`."""
    return F.concat(fixed(share * 100.0, places), F.lit("%"))
