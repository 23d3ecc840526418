"""Exact positions in a global order without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from waybill.sources.storage import scratch_table

# Layout of monotonically_increasing_id: task number above, row number in the task below.
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1


def with_global_index(
    df: DataFrame, order: Sequence[Column], index: str = "global_index", total: str | None = None
) -> DataFrame:
    """Adds the 1-based position of each row in the global `order`, and optionally the row count.

    `order` should end in a unique key. The global sort range-partitions on all its columns, so
    rows that share a leading value spread over many tasks. The sorted rows are written once;
    each position is then the row's place in its range plus the sizes of the earlier ranges,
    of which there are at most as many as shuffle partitions.
    """
    placed = scratch_table(
        df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), "sorted"
    )
    range_no = F.shiftright("_place", _ROW_BITS)
    sizes = placed.groupBy(range_no.alias("_range")).agg(F.count(F.lit(1)).alias("_size"))
    earlier = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        "_range",
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_size").over(W.partitionBy()).alias("_total"),
    )
    place_in_range = F.col("_place").bitwiseAND(F.lit(_ROW_MASK))
    indexed = placed.withColumn("_range", range_no).join(F.broadcast(offsets), "_range")
    extra = [] if total is None else [F.col("_total").alias(total)]
    return indexed.select(
        *df.columns, (F.col("_offset") + place_in_range + 1).alias(index), *extra
    )


def ntile_scalable(df: DataFrame, order: Sequence[Column], tiles: int, out: str) -> DataFrame:
    """NTILE over the whole frame: sizes differ by at most one, larger tiles first."""
    indexed = with_global_index(df, order, "_index", "_rows")
    small = F.floor(F.col("_rows") / tiles)
    larger = F.col("_rows") % tiles
    in_larger = larger * (small + 1)
    # With fewer rows than tiles every row is in a larger tile, so `small` is never a divisor.
    tile = F.when(
        F.col("_index") <= in_larger, F.ceil(F.col("_index") / (small + 1))
    ).otherwise(larger + F.ceil(F.try_divide(F.col("_index") - in_larger, small)))
    return indexed.withColumn(out, tile.cast("bigint")).drop("_index", "_rows")
