"""A corpus from raw documents, in stages; each stage's result is a table that the next one reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from waybill.llm import decontaminate, grade_model, mixing, order_minhash, token_output
from waybill.llm.common import drop_scratch, scratch_mark, scratch_path, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the ordinal quality model selects; it is fitted on the rated ones.

    Null and empty texts are scored like others. Without two grades among the ratings the model is a
    constant: the one grade there is, or with no rating at all a good one. Rows that repeat are judged alike.
    """
    model = grade_model.fit(docs, grade_model.grades(table(spark, sf_dir, "labels")))
    return grade_model.select(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate class.

    Rows without an id are all kept, wordless texts once for each id.
    """
    return order_minhash.dedupe(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold too much of the benchmark.

    Null texts and an empty benchmark leave documents as they are; repeated ids are judged by their text.
    """
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents to their source's target, some several times and some not.

    Null sources are one source. Texts without words do not count towards a target.
    """
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token files and returns each document's place and checksum from them.

    A null or empty text is its end id alone; repeated rows are written as often as they come.
    """
    path = scratch_path(spark, "corpus-tokens")
    token_output.write_tokens(docs, path)
    return token_output.digests(token_output.read_tokens(spark, path))


STAGES = [
    ("quality classifier", quality),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixture),
    ("token output", tokens),
]
# Fitted weights, near-duplicate classes and token ids are beyond SQL; tests check each stage instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to `documents`; every result but the last is written and read again.

    What a stage left in the shared folder is removed once its result is written. An empty table gives
    an empty result; columns of any name besides those of `documents` go through to the last stage.
    """
    docs, kept = table(spark, sf_dir, "documents"), ()
    for name, stage in STAGES[:-1]:
        mark = scratch_mark(spark) - len(kept)
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs, kept = spark.read.parquet(path), (path,)
        drop_scratch(spark, mark, kept)
    return STAGES[-1][1](spark, docs, sf_dir)
