"""Raw zone: CSV files with a header, every column read as text and picked by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Base names of the nine raw inputs. Files may carry any `<vendor>_` prefix, and
# each may be a single file or a folder of part files. One vendor's files make a raw zone.
RAW_INPUTS = {
    "customers": "customers_dataset.csv",
    "geolocation": "geolocation_dataset.csv",
    "order_items": "order_items_dataset.csv",
    "payments": "order_payments_dataset.csv",
    "reviews": "order_reviews_dataset.csv",
    "orders": "orders_dataset.csv",
    "products": "products_dataset.csv",
    "sellers": "sellers_dataset.csv",
    "translation": "product_category_name_translation.csv",
}

# Inputs with free text, where a quoted field can hold line breaks. Such a file cannot be split,
# so large ones should arrive as a folder of many files.
MULTI_LINE_INPUTS = frozenset({"reviews"})


def _find(spark: SparkSession, raw_dir: str, base: str) -> list[str]:
    """Paths in `raw_dir` named `base` or `<vendor>_<base>`, on any file system Spark can reach."""
    path_class = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    found = []
    # `orders_dataset.csv` must not pick up `..._order_items_dataset.csv`, hence the exact suffix.
    for pattern in (base, f"*_{base}"):
        path = path_class(raw_dir.rstrip("/"), pattern)
        statuses = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
        found += [status.getPath().toString() for status in statuses or []]
    return found


def require_inputs(
    spark: SparkSession, raw_dir: str, names: tuple[str, ...] = tuple(RAW_INPUTS)
) -> dict[str, list[str]]:
    """Paths of every named input; raises before any job runs when some are missing."""
    paths = {name: _find(spark, raw_dir, RAW_INPUTS[name]) for name in names}
    missing = [RAW_INPUTS[name] for name, hits in paths.items() if not hits]
    if missing:
        raise FileNotFoundError(f"no file for these raw inputs in {raw_dir}: {', '.join(missing)}")
    doubled = [path for hits in paths.values() if len(hits) > 1 for path in hits]
    if doubled:
        raise ValueError(f"more than one vendor's files in {raw_dir}: {', '.join(sorted(doubled))}")
    return paths


def read_raw(
    spark: SparkSession, path: str | list[str], multi_line: bool = False
) -> DataFrame:
    """CSV with all columns as text; doubled quotes inside quoted fields are unescaped.

    A part file with another header and a row with more or fewer fields than the header stop the
    job. Spark sees the length of a row only if it parses all columns, so the scan is not pruned.
    """
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": multi_line}
    names = spark.read.csv(path, inferSchema=False, **options).columns
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    reader = spark.read.option("columnPruning", False)
    return reader.csv(path, schema=schema, enforceSchema=False, mode="FAILFAST", **options)


def read_raw_zone(spark: SparkSession, raw_dir: str) -> dict[str, DataFrame]:
    """All nine inputs. Staging casts must stop on malformed text, so ANSI mode has to be on."""
    if spark.conf.get("spark.sql.ansi.enabled") != "true":
        raise RuntimeError("set spark.sql.ansi.enabled=true: malformed values would become NULL")
    paths = require_inputs(spark, raw_dir)
    return {
        name: read_raw(spark, found, multi_line=name in MULTI_LINE_INPUTS)
        for name, found in paths.items()
    }
