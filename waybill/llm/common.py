"""Helpers shared by the operators: words, scratch tables, samples, free column names."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
# Everything below U+0080 that is neither a digit nor a letter parts words.
SEPARATORS = "".join(map(chr, (*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80))))
#: A word of `words`, in text that still has its capitals.
WORD_CLASS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
#: What parts such words.
GAP_CLASS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
BLANK_WORD = r"[^\x20\x09-\x0D]+"

_scratch: dict[str, list[str]] = {}


def words(text: Column) -> Column:
    """Lower-cased (A-Z only) words of a text; no words for null."""
    plain = F.translate(text, UPPER + SEPARATORS, LOWER + " " * len(SEPARATORS))
    return F.coalesce(F.array_remove(F.split(plain, " "), ""), F.array().cast("array<string>"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach: `spark.checkpoint.dir`, or one in the warehouse where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/shared"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and scan it from there: a cut that outlives executors.

    This runs a job at once. `drop_scratch` removes the files when no frame needs them any more.
    """
    return stored_at(df, scratch_path(df.sparkSession, name))


def stored_at(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_mark(spark: SparkSession) -> int:
    """How many scratch folders this application has made so far."""
    return len(_scratch.get(spark.sparkContext.applicationId, []))


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove one scratch folder before the others."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def drop_scratch(spark: SparkSession, since: int = 0, keep: tuple[str, ...] = ()) -> None:
    """Remove the scratch folders that operators made after a `scratch_mark`, but those in `keep`.

    Frames that read them fail afterwards. Called by jobs that know when their results are written.
    """
    made = _scratch.get(spark.sparkContext.applicationId, [])
    for path in made[since:]:
        if path not in keep:
            remove_path(spark, path)
            made.remove(path)


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores until no column of `df` has it (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def repeat(df: DataFrame, times: Column) -> DataFrame:
    """Each row `times` times."""
    name = free_name(df, "copy")
    return df.select("*", F.explode(F.array_repeat(F.lit(0), times.cast("int"))).alias(name)).drop(name)


def seeded_sample(df: DataFrame, key: str, rows: int, seed: int) -> DataFrame:
    """At most `rows` rows, the same ones at each run: those with the least hash of `key`.

    For fitting models only. A top-k by hash keeps `rows` rows per task and sorts nothing else.
    """
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(key)), F.col(key)).limit(rows)


def sample_texts(docs: DataFrame, chosen: DataFrame, longest: int) -> DataFrame:
    """A text for each row of `chosen` (unique doc_id, label columns), of at most `longest` bytes.

    An id with several rows gives one of them, the same at each run; ids without such a row give
    none. `chosen` is a bounded sample, so it is broadcast; each task keeps a text per id before the
    shuffle, so an id with most of the rows brings no more than others.
    """
    fits = docs.select("doc_id", "text").filter(F.coalesce(F.octet_length("text"), F.lit(0)) <= longest)
    least = F.min(F.struct(F.xxhash64("text").alias("draw"), "text"))
    rows = fits.join(F.broadcast(chosen), "doc_id").groupBy(*chosen.columns).agg(least.alias("least"))
    return rows.select(*chosen.columns, "least.text")


def qualified(spark: SparkSession, path: str) -> str:
    """`path` as a URI of the store that Spark itself would use for it.

    A path without a scheme belongs to Hadoop's default file system; tasks that open files themselves
    would take it for their own machine's disk.
    """
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store.makeQualified(where).toString()
