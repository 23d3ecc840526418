"""Ordered threshold labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels and limits. The leading digit is a sort prefix.
# Lateness limits are inclusive upper bounds in days late.
LATENESS_BANDS = (
    (0, "0 On time"),
    (3, "1 1-3 days late"),
    (7, "2 4-7 days late"),
    (14, "3 8-14 days late"),
)
LATENESS_TAIL = "4 15+ days late"
# Distance limits are exclusive upper bounds in km.
DISTANCE_BANDS = (
    (100, "1 <100 km"),
    (500, "2 100-499 km"),
    (1000, "3 500-999 km"),
    (2000, "4 1,000-1,999 km"),
)
DISTANCE_TAIL = "5 2,000+ km"
DISTANCE_UNKNOWN = "9 Unknown"
LATE, ON_TIME = "Late", "On time"


def bucketize(
    value: Column,
    bands: Sequence[tuple[float, str]],
    tail: str,
    *,
    inclusive: bool,
    null_label: str | None = None,
) -> Column:
    """Label of the first band whose upper bound holds `value`, else `tail`.

    NULL gets `null_label`; without one it falls through to `tail`.
    """
    label = F.when(value.isNull(), F.lit(null_label)) if null_label is not None else F
    for bound, name in bands:
        label = label.when(value <= bound if inclusive else value < bound, F.lit(name))
    return label.otherwise(F.lit(tail))


def lateness_bucket(days_late: Column) -> Column:
    return bucketize(days_late, LATENESS_BANDS, LATENESS_TAIL, inclusive=True)


def distance_band(km: Column) -> Column:
    """Band of the distance mart: an unknown distance has its own label."""
    return bucketize(
        km, DISTANCE_BANDS, DISTANCE_TAIL, inclusive=False, null_label=DISTANCE_UNKNOWN
    )


def bi_distance_band(km: Column) -> Column:
    """Band of the dashboard field: no sort prefix, and an unknown distance counts as farthest."""
    bands = [(bound, name[2:]) for bound, name in DISTANCE_BANDS]
    return bucketize(km, bands, DISTANCE_TAIL[2:], inclusive=False)


def delivery_label(is_late: Column) -> Column:
    return F.when(is_late, F.lit(LATE)).otherwise(F.lit(ON_TIME))
