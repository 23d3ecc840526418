"""File outputs for other tools: CSV with a header, JSON lines and text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def write_csv(
    df: DataFrame, path: str, single_file: bool = False, compression: str = "none"
) -> str:
    """CSV with header. `single_file` is for report-sized frames only."""
    out = df.coalesce(1) if single_file else df
    (
        out.write.mode("overwrite")
        .option("timestampNTZFormat", TIMESTAMP_FORMAT)
        # The writer would trim text otherwise.
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path, header=True, quote='"', escape='"', compression=compression)
    )
    return path


def read_json_as(spark: SparkSession, path: str, schema_of: DataFrame) -> DataFrame:
    """Read a JSON file back with the types it was written from."""
    return spark.read.schema(schema_of.schema).json(path)


def read_csv_as(spark: SparkSession, path: str, schema_of: DataFrame) -> DataFrame:
    """Read an extract back with the types it was written from, columns bound by name."""
    text = spark.read.csv(path, header=True, inferSchema=False, quote='"', escape='"')
    return text.select(
        *[text[field.name].cast(field.dataType).alias(field.name) for field in schema_of.schema]
    )


def write_json(df: DataFrame, path: str) -> str:
    """One JSON object per row; for one-row statistics and report-sized frames."""
    df.coalesce(1).write.mode("overwrite").json(path, ignoreNullFields=False)
    return path


def extract_orders(fct_orders: DataFrame) -> DataFrame:
    """The order fact without the person key."""
    return fct_orders.drop("customer_unique_id")


# Extract name -> (table, ordering of its rows). The order-grain extract is not sorted
# and stays in many files; marts are a handful of rows per key.
EXTRACTS = {
    "orders": ("fct_orders", None),
    "lateness": ("mart_lateness", ("lateness_bucket", True)),
    "state": ("mart_state", ("late_rank", True)),
    "seller": ("mart_seller", ("late_orders", False)),
    "monthly": ("mart_monthly", ("order_month", True)),
    "distance": ("mart_distance", ("distance_band", True)),
    "late_vs_ontime": ("mart_late_vs_ontime", ("delivery", False)),
    "retention_late_vs_ontime": ("mart_retention_late_vs_ontime", ("first_delivery", False)),
}


def in_order(frame: DataFrame, column: str, ascending: bool, single_file: bool) -> DataFrame:
    """Rows by `column`, ties by all others; in one partition for report-sized frames."""
    rest = [F.col(c).asc_nulls_last() for c in frame.columns if c != column]
    by = F.col(column).asc_nulls_last() if ascending else F.col(column).desc_nulls_last()
    return frame.coalesce(1).sortWithinPartitions(by, *rest) if single_file else frame.orderBy(by, *rest)


def export_extracts(tables: Mapping[str, DataFrame], out_dir: str) -> dict[str, str]:
    """Write the eight extracts to `<out_dir>/<name>.csv`; returns their paths by name."""
    paths = {}
    for name, (table, order) in EXTRACTS.items():
        frame = tables[table]
        if table == "fct_orders":
            frame = extract_orders(frame)
        # The seller mart grows with the number of sellers, so it keeps its sorted part files.
        single = table.startswith("mart_") and table != "mart_seller"
        if order is not None:
            frame = in_order(frame, *order, single_file=single)
        paths[name] = write_csv(frame, f"{out_dir.rstrip('/')}/{name}.csv")
    return paths
