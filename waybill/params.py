"""Typed parameters of the pipeline."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Box:
    """Inclusive coordinate box; points outside are treated as bad geocodes."""

    south: float
    north: float
    west: float
    east: float


# Default repeat window (days), smallest seller kept in the seller mart (orders),
# and the coordinate box of the country the marketplace operates in.
REPEAT_WINDOW_DAYS = 180
MIN_SELLER_ORDERS = 30
COUNTRY_BOX = Box(south=-34.0, north=6.0, west=-74.0, east=-34.0)


@dataclass(frozen=True)
class Params:
    window_days: int = REPEAT_WINDOW_DAYS
    min_seller_orders: int = MIN_SELLER_ORDERS
    box: Box = COUNTRY_BOX
