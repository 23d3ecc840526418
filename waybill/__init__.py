"""Delivery, review and retention analytics for marketplace orders, on Spark DataFrames."""

from waybill.params import Params

__all__ = ["Params"]
