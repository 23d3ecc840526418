"""Written tables: durable ones of the job and scratch ones that cut a plan in two."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


# Tables are written once and read a few times, so the smaller files of zstd pay off.
COMPRESSION = "zstd"


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Full refresh of a Parquet table; returns a scan of what was written.

    Unpartitioned tables are written as they come, without a shuffle. For a partitioned one the
    rebalance hint groups rows by partition value and lets Spark split oversized groups, so there
    are neither many small files nor one task for a month with most of the rows.
    """
    spark = df.sparkSession
    if partition_by is None:
        df.write.mode("overwrite").parquet(path, compression=COMPRESSION)
    else:
        grouped = df.hint("rebalance", partition_by)
        grouped.write.mode("overwrite").partitionBy(partition_by).parquet(path, compression=COMPRESSION)
    # The reader moves partition columns to the end; keep the order of the definition.
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir`, else one in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/shared"
    return folder.rstrip("/")


_scratch: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def scratch_mark(spark: SparkSession) -> int:
    """How many scratch paths this application has used so far."""
    return len(_scratch.get(spark.sparkContext.applicationId, []))


def drop_scratch(spark: SparkSession, since: int = 0) -> None:
    """Remove scratch data made after a `scratch_mark`; frames that read it fail afterwards."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    paths = _scratch.get(spark.sparkContext.applicationId, [])
    for path in paths[since:]:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)
    del paths[since:]


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back; this runs a job at once.

    For frames used several times: the work is done once, survives lost executors, and later
    reads prune columns and know the real size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=COMPRESSION)
    return df.sparkSession.read.schema(df.schema).parquet(path)
