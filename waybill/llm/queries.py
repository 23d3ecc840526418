"""The registered queries of the operators, over whole tables, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm import (
    decontaminate,
    grade_model,
    graph_index,
    lexical_search,
    license_index,
    mixing,
    order_minhash,
    preference,
    quality_rules,
    spelling,
    token_output,
    url_filter,
    warc,
)
from waybill.llm.common import scratch_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


@query
def op1_decontamination(spark, sf):
    """Contamination of every document by the benchmark's 13-word windows."""
    judged = decontaminate.scan(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    ids = F.concat_ws(",", F.array_sort(F.col("items").cast("array<string>")))
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        "contaminated",
    )


@query
def op2_warc(spark, sf):
    """Every page written to a web archive and read back."""
    path = scratch_path(spark, "warc")
    warc.write_archive(table(spark, sf, "pages"), path)
    return warc.pages_of(warc.read_archive(spark, path))


@query
def op3_mixing(spark, sf):
    """Every document's share in a mix of the sources."""
    return mixing.plan(table(spark, sf, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


@query
def op5_url_filter(spark, sf):
    """Host, path, rule and verdict of every page's url."""
    return url_filter.judge(table(spark, sf, "pages"))


@query
def op8_preference(spark, sf):
    """Every conversation as a preference example against its neighbour's reply."""
    pairs = preference.with_foreign_reply(table(spark, sf, "conversations"))
    return preference.examples(pairs).select(
        "conv_id", "n_prompt_turns", "prompt", "chosen", "rejected", "chosen_mask", "rejected_mask", "differs"
    )


@query
def op7_quality_rules(spark, sf):
    """Rule counts and verdict of every document."""
    docs = table(spark, sf, "documents")
    return quality_rules.judge(docs, quality_rules.fit(docs, table(spark, sf, "labels")))


@query
def op10_licenses(spark, sf):
    """Licence phrases and labels of every document."""
    return license_index.scan(table(spark, sf, "documents"))


@query
def op4_grades(spark, sf):
    """Expected grade, tail probability and selection of every document."""
    docs = table(spark, sf, "documents")
    model = grade_model.fit(docs, grade_model.grades(table(spark, sf, "labels")))
    scored, expected, tail = grade_model.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", expected, tail, (F.col(tail) >= grade_model.SELECT_FROM).alias("selected"))


@query
def op6_order_minhash(spark, sf):
    """The near-duplicate class of every document."""
    return order_minhash.classes(table(spark, sf, "documents"))


@query
def op9_token_output(spark, sf):
    """Every document's place and checksum, from the token files that were written for it."""
    path = scratch_path(spark, "tokens")
    token_output.write_tokens(table(spark, sf, "documents"), path)
    return token_output.digests(token_output.read_tokens(spark, path))


@query
def op11_spelling(spark, sf):
    """Every frequent word with its more frequent neighbour by one edit, after letters were lost at random."""
    return spelling.variants(spelling.word_counts(table(spark, sf, "documents"), letter_lost=199))


@query
def op12_nearest(spark, sf):
    """The five nearest vectors of every fiftieth one."""
    vectors = table(spark, sf, "embeddings")
    return graph_index.nearest(vectors, F.col("vec_id") % 50 == 0)


@query
def op13_lexical_search(spark, sf):
    """The ten best documents of every benchmark item."""
    return lexical_search.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def mixing_targets(spark, sf):
    """What SQL can say of op3_mixing: sizes and targets."""
    return op3_mixing(spark, sf).drop("taken")


@query
def url_rules(spark, sf):
    """What SQL can say of op5_url_filter: host, path, rule and the rule's verdict."""
    return url_filter.by_rules(table(spark, sf, "pages")).drop("url")


@query
def rule_counts(spark, sf):
    """What SQL can say of op7_quality_rules: the counts and the base verdict."""
    return op7_quality_rules(spark, sf).drop("kept", "quality")


@query
def license_base(spark, sf):
    """What SQL can say of op10_licenses: the base phrases."""
    return op10_licenses(spark, sf).drop("labels", "score")
