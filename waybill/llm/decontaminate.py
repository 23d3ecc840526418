"""Benchmark decontamination: benchmark n-grams as a broadcast hash set, probed by every text window.

Column functions only. One scan of the documents: each text becomes its words, each window of n
words one 64-bit hash, and the hashes probe the broadcast benchmark windows in the same stage. A
hit counts after its words were compared with the benchmark's. The only shuffle moves one short row
per document and one per hit.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import GAP_CLASS, WORD_CLASS, repeat, stored, words

NGRAM_WORDS = 13
#: Benchmark windows in one broadcast (about 300 bytes each). A larger benchmark is probed in blocks
#: of this many, each with a scan of its own, so no broadcast grows with the data.
BLOCK_WINDOWS = 200_000
#: A document is contaminated from one hit word in this many.
MOST_WORDS_PER_HIT = 20


def benchmark_windows(benchmark: DataFrame, n: int = NGRAM_WORDS) -> DataFrame:
    """Distinct windows with the items that hold them: window, length, hash, items.

    An item shorter than `n` words is one window; one without words has none. Repeated items count once.
    """
    items = benchmark.select("item_id", words(F.col("text")).alias("tokens")).filter(F.size("tokens") > 0)
    items = items.withColumn("length", F.least(F.lit(n), F.size("tokens")))
    starts = F.sequence(F.lit(1), F.size("tokens") - F.col("length") + 1)
    return (
        items.select("item_id", "length", "tokens", F.explode(starts).alias("start"))
        .select("item_id", "length", F.slice("tokens", F.col("start"), F.col("length")).alias("window"))
        .groupBy("window", "length")
        .agg(F.collect_set("item_id").alias("items"))
        .withColumn("hash", F.xxhash64("window"))
    )


def document_key(docs: DataFrame) -> list[Column]:
    """What tells one document from another: its id and its text, so that repeated ids do not mix."""
    return [F.col("doc_id"), F.xxhash64("text").alias("text_key")]


def _probe(tokens: DataFrame, windows: DataFrame, lengths: list[int], count_documents: bool) -> DataFrame:
    """A row per verified hit and, with `count_documents`, at least one per document.

    The window at each word is hashed from array items, not from a slice: no copy is made per word.
    """
    starts = (
        tokens.withColumn("length", F.explode(F.array(*map(F.lit, lengths))))
        .select("*", F.posexplode_outer("tokens").alias("start", "word"))
        .drop("word")
    )
    window = F.lit(None).cast("bigint")
    for length in lengths:
        hashed = F.xxhash64(*(F.get("tokens", F.col("start") + i) for i in range(length)))
        fits = (F.col("length") == length) & (F.col("start") + length <= F.size("tokens"))
        window = F.when(fits, hashed).otherwise(window)
    first = F.coalesce(F.col("start"), F.lit(0)) == 0
    marks = first & (F.col("length") == lengths[0]) & F.lit(count_documents)
    probed = starts.withColumns({"probe": window, "marks": marks})
    met = probed.join(
        F.broadcast(windows.withColumnRenamed("length", "window_length")),
        (F.col("probe") == F.col("hash"))
        & (F.slice("tokens", F.col("start") + 1, F.col("window_length")) == F.col("window")),
        "left",
    )
    is_hit = F.col("window").isNotNull()
    hit = F.struct(F.col("start"), (F.col("start") + F.col("length")).alias("end"))
    return met.filter(F.col("marks") | is_hit).select(
        "doc_id",
        "text_key",
        F.size("tokens").alias("n_words"),
        F.col("marks").cast("int").alias("copies"),
        F.when(is_hit, hit).alias("hit"),
        F.col("items").alias("hit_items"),
    )


def _merged(hits: Column) -> Column:
    """Disjoint spans of words, in order, that cover the same words as the hits."""
    span = "struct<start:int,end:int>"
    nothing = F.struct(
        F.array().cast(f"array<{span}>").alias("done"), F.lit(None).cast(span).alias("open")
    )

    def add(state, hit):
        joins = hit["start"] <= state["open"]["end"]
        grown = F.struct(
            state["open"]["start"].alias("start"),
            F.greatest(state["open"]["end"], hit["end"]).alias("end"),
        )
        return (
            F.when(state["open"].isNull(), F.struct(state["done"].alias("done"), hit.alias("open")))
            .when(joins, F.struct(state["done"].alias("done"), grown.alias("open")))
            .otherwise(
                F.struct(F.concat(state["done"], F.array(state["open"])).alias("done"), hit.alias("open"))
            )
        )

    def close(state):
        return F.when(state["open"].isNull(), state["done"]).otherwise(
            F.concat(state["done"], F.array(state["open"]))
        )

    return F.aggregate(F.sort_array(hits), nothing, add, close)


def scan(docs: DataFrame, benchmark: DataFrame, n: int = NGRAM_WORDS) -> DataFrame:
    """Contamination of every document: doc_id, text_key, n_words, spans, n_hit, items, contaminated.

    Null texts have no words and are clean. Null ids are kept. Rows that repeat an id with another
    text are judged apart; full repeats are returned as often as given. An empty benchmark leaves
    everything clean. Other columns of either table are not read. The benchmark's windows are written
    to scratch and counted first, which sets the number of broadcast blocks.
    """
    windows = stored(benchmark_windows(benchmark, n), "windows")
    lengths = sorted(row[0] for row in windows.select("length").distinct().collect()) or [n]
    blocks = max(1, -(-windows.count() // BLOCK_WINDOWS))
    tokens = docs.select(*document_key(docs), words(F.col("text")).alias("tokens"))
    found = reduce(
        DataFrame.unionByName,
        (
            _probe(tokens, windows.filter(F.pmod("hash", F.lit(blocks)) == block), lengths, block == 0)
            for block in range(blocks)
        ),
    )
    judged = (
        found.groupBy("doc_id", "text_key")
        .agg(
            F.max("n_words").cast("bigint").alias("n_words"),
            F.sum("copies").alias("copies"),
            F.collect_set("hit").alias("hits"),
            F.array_distinct(F.flatten(F.collect_set("hit_items"))).alias("items"),
        )
        .withColumn("spans", _merged(F.col("hits")))
        .withColumn(
            "n_hit",
            F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"]),
        )
    )
    judged = repeat(judged, F.col("copies"))
    dirty = (F.col("n_hit") > 0) & (F.lit(MOST_WORDS_PER_HIT) * F.col("n_hit") >= F.col("n_words"))
    return judged.select("doc_id", "text_key", "n_words", "spans", "n_hit", "items", dirty.alias("contaminated"))


def _same_document(docs: DataFrame, other: DataFrame) -> Column:
    return F.xxhash64(docs["text"]).eqNullSafe(other["text_key"]) & docs["doc_id"].eqNullSafe(other["of_doc"])


def remove_documents(docs: DataFrame, benchmark: DataFrame, n: int = NGRAM_WORDS) -> DataFrame:
    """The documents that are not contaminated, with all their columns and repeats."""
    dirty = scan(docs, benchmark, n).filter("contaminated")
    dirty = dirty.select(F.col("doc_id").alias("of_doc"), "text_key").distinct()
    return docs.join(dirty, _same_document(docs, dirty), "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = NGRAM_WORDS) -> DataFrame:
    """All documents; hit words, with the separators after them, are cut out of contaminated texts."""
    dirty = scan(docs, benchmark, n).filter("contaminated")
    dirty = dirty.select(F.col("doc_id").alias("of_doc"), "text_key", "spans").dropDuplicates(["of_doc", "text_key"])
    joined = docs.join(dirty, _same_document(docs, dirty), "left")
    text, spans = docs["text"], dirty["spans"]
    head = F.regexp_extract(text, f"^{GAP_CLASS}*", 0)
    pieces = F.regexp_extract_all(text, F.lit(f"{WORD_CLASS}+{GAP_CLASS}*"), F.lit(0))
    starts = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.size(pieces)))
    ends = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    kept = F.flatten(F.zip_with(ends, starts, lambda a, b: F.slice(pieces, a + 1, b - a)))
    cut = F.concat(head, F.array_join(kept, ""))
    return joined.select(
        *(
            (F.when(spans.isNotNull(), cut).otherwise(text).alias(c) if c == "text" else docs[c])
            for c in docs.columns
        )
    )
