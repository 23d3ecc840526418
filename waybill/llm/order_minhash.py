"""Near-duplicate detection by Order MinHash, verified by banded alignment.

Sketch: each of several hash functions picks the least occurrence-labelled five-word shingles of a
text, and an entry is those shingles in text order, so it is sensitive to edits and to moved passages
alike. Texts that share an entry are candidates; a candidate pair is a link when at least 0.8 of both
texts' labelled shingles are shared and an alignment of the shared ones, in order and inside a band
around the diagonal, covers at least 0.8 of the longer text. Classes are the connected components.

Equal texts are collapsed first, so a group of copies costs one sketch from there on. A bucket of few
texts is compared in full. Members of a larger one meet its most central and its shortest text, which
joins most of them. What that leaves apart is then joined exactly: members of large buckets in different
components meet at every shingle that a link must share (`across`), so no link between components goes
unseen there and no bucket is paired in full.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import free_name, remove_path, scratch_path, stored, stored_at
from waybill.llm.hashing import Run, mixed, runs, salted

#: Shingle words and least similarity.
SHINGLE_WORDS, LEAST_SIMILARITY = 5, 0.8
#: Sketch entries, and shingles in each. A pair at similarity 0.8 shares an entry with probability
#: 0.51, and none of them with 1e-5; texts that share a passage of a third of their words share an
#: entry with probability 0.04.
ENTRIES, PICKED = 16, 3
#: Buckets up to this size are paired in full.
SMALL_BUCKET = 24
#: Shingles are ordered by counts in this many slots. Any order is exact; the rarest first meet least.
COUNT_SLOTS = 1 << 18
#: A shingle's texts are dealt to tasks by this many.
SALTED_ROWS = 1000

_MOST = np.uint64(0xFFFFFFFFFFFFFFFF)


def labelled_shingles(run: Run) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of shingles with their occurrence numbers, in text order, and the text of each.

    A text of fewer words, but not none, is one shingle.
    """
    hashes, first = run.windows(SHINGLE_WORDS)
    text = run.word_text[first]
    short = np.flatnonzero((run.words > 0) & (run.words < SHINGLE_WORDS))
    if len(short):
        begins = np.concatenate([[0], np.cumsum(run.words)])
        whole = np.zeros(len(short), dtype=np.uint64)
        for i in range(SHINGLE_WORDS - 1):
            has = run.words[short] > i
            whole[has] = mixed(whole[has] + run.word_hash[begins[short[has]] + i])
        text, hashes = np.concatenate([text, short]), np.concatenate([hashes, whole])
        order = np.argsort(text, kind="stable")
        text, hashes = text[order], hashes[order]
    keys = hashes ^ salted(text.astype(np.uint64), 7)
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = ranked[1:] != ranked[:-1]
    places = np.arange(len(keys))
    occurrence = np.zeros(len(keys), dtype=np.uint64)
    occurrence[order] = places - np.maximum.accumulate(np.where(new, places, 0))
    return mixed(hashes + occurrence * np.uint64(0xD6E8FEB86659FD93)), text


def sketches(shingles: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """Entries of each text, a row per text; texts without shingles have zeros."""
    out = np.zeros((texts, ENTRIES), dtype=np.uint64)
    if not len(shingles):
        return out
    starts = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
    present = text[starts]
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(text))))
    for j in range(ENTRIES):
        values = salted(shingles, 100 + j)
        picked = []
        for _ in range(PICKED):
            least = np.minimum.reduceat(values, starts)
            at = np.flatnonzero(values == least[group])
            at = at[np.concatenate([[True], group[at][1:] != group[at][:-1]])]
            values[at] = _MOST
            picked.append(at)
        # A text of fewer shingles picks some again, which adds nothing to tell it by.
        entry = np.zeros(len(starts), dtype=np.uint64)
        for at in np.sort(np.stack(picked), axis=0):
            entry = mixed(entry + shingles[at])
        out[present, j] = salted(entry, j)
    return out


def sequence_digest(run: Run) -> np.ndarray:
    """Two 64-bit hashes of each text's word sequence."""
    out = np.zeros((run.texts, 2), dtype=np.uint64)
    if len(run.word_hash):
        begins = np.cumsum(run.words) - run.words
        place = np.arange(len(run.word_hash)) - begins[run.word_text]
        full = np.flatnonzero(run.words)
        for side in range(2):
            value = salted(run.word_hash + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 8 + side)
            out[full, side] = np.add.reduceat(value, begins[full])
    return out


_ENTRY_COLUMNS = [f"entry{j}" for j in range(ENTRIES)]
_FEATURES = (
    "row bigint, doc_id bigint, text_key bigint, n_words bigint, digest binary, "
    + ", ".join(f"{name} bigint" for name in _ENTRY_COLUMNS)
    + ", shingles array<int>"
)


def features(docs: DataFrame) -> DataFrame:
    """Of every row of `docs`: a number of its own, id, hash of the text, word count, digest of the words,
    sketch and shingles. To be stored: the numbers hold for what was written."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, run in runs(batch.column("text"), lowered=True, blank_words=False):
                shingles, text = labelled_shingles(run)
                sketch = sketches(shingles, text, run.texts).view(np.int64)
                small = (shingles >> np.uint64(32)).astype(np.uint32).view(np.int32)
                ends = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=run.texts))])
                digest = sequence_digest(run)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(name).slice(row, run.texts) for name in ("row", "doc_id", "text_key")],
                        pa.array(run.words.astype(np.int64)),
                        pa.array([d.tobytes() for d in digest], type=pa.binary()),
                        *[pa.array(np.ascontiguousarray(sketch[:, j])) for j in range(ENTRIES)],
                        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(small)),
                    ],
                    names=["row", "doc_id", "text_key", "n_words", "digest", *_ENTRY_COLUMNS, "shingles"],
                )

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("text_key"), "text"
    )
    return rows.mapInArrow(make, _FEATURES)


def _pair(a, b):
    return F.struct(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))


def _full_pairs(rows: DataFrame) -> DataFrame:
    """All pairs of each small bucket."""
    members = rows.groupBy("key").agg(F.array_sort(F.collect_set("node")).alias("nodes"))
    later = lambda x, i: F.slice("nodes", i + 2, F.size("nodes"))
    pairs = F.flatten(
        F.transform("nodes", lambda x, i: F.transform(later(x, i), lambda y: _pair(x, y)))
    )
    return members.select(F.explode(pairs).alias("pair"))


def _stars(hot: DataFrame) -> DataFrame:
    """Each member of a large bucket with the bucket's leaders, once each.

    The leaders are the member with the largest sum of bucket sizes over all entries and the one of the
    fewest words: the text that others are versions of, or that is little but the passage they share, is
    near to most of them. They come from partial aggregates.
    """
    central = hot.groupBy("node").agg(F.sum("n").alias("central"))
    draw = F.xxhash64("node")
    ranked = (("central", draw), (-F.col("n_words"), draw))
    leaders = F.array_distinct(F.array(*(F.max(F.struct(*by, "node"))["node"] for by in ranked)))
    led = hot.join(hot.join(central, "node").groupBy("key").agg(leaders.alias("leaders")), "key")
    # An entry of each place at most, so a row holds no more than a few leaders.
    met = led.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("leaders"))).alias("leaders"))
    rows = met.select("node", F.explode(F.array_remove("leaders", F.col("node"))).alias("leader"))
    return rows.select(_pair(F.col("node"), F.col("leader")).alias("pair"))


def buckets(texts: DataFrame) -> DataFrame:
    """(node, n_words, key, n): the entries that a text shares with n - 1 others."""
    entries = F.array(*_ENTRY_COLUMNS)
    rows = texts.select("node", "n_words", F.posexplode(entries).alias("place", "entry"))
    rows = rows.select("node", "n_words", F.xxhash64("place", "entry").alias("key"))
    sizes = rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    return rows.join(sizes, "key")


def candidates(met: DataFrame) -> DataFrame:
    """Distinct candidate pairs a < b from `buckets`."""
    pairs = _full_pairs(met.filter(F.col("n") <= SMALL_BUCKET))
    return pairs.union(_stars(met.filter(F.col("n") > SMALL_BUCKET))).distinct().select("pair.a", "pair.b")


def similarity(a: np.ndarray, b: np.ndarray) -> tuple[float, float]:
    """Jaccard similarity of two texts' labelled shingles, and the share of words that align.

    The alignment chains shared shingles that stand in the same order in both texts, no further from
    the diagonal than the edits that the similarity allows; words of chained shingles are aligned.
    """
    # Shingles are 32-bit hashes, which very long texts can hold twice.
    _, i, j = np.intersect1d(a, b, return_indices=True)
    jaccard = len(i) / (len(a) + len(b) - len(i))
    longest = max(len(a), len(b)) + SHINGLE_WORDS - 1
    band = (1 - LEAST_SIMILARITY) * longest
    order = np.argsort(i)
    i, j = i[order], j[order]
    inside = np.abs(i - j) <= band
    i, j = i[inside], j[inside]
    if len(j) > 1 and not (np.diff(j) > 0).all():
        chain = longest_increasing(j)
        i, j = i[chain], j[chain]
    words = min(_covered(i), _covered(j))
    return jaccard, words / longest


def _covered(starts: np.ndarray) -> int:
    if not len(starts):
        return 0
    return int(np.minimum(np.diff(starts), SHINGLE_WORDS).sum()) + SHINGLE_WORDS


def longest_increasing(values: np.ndarray) -> np.ndarray:
    """Indices of a longest strictly increasing subsequence."""
    tails: list[int] = []
    ends: list[int] = []
    before = np.full(len(values), -1)
    for at, value in enumerate(values.tolist()):
        k = bisect_left(tails, value)
        if k == len(tails):
            tails.append(value)
            ends.append(at)
        else:
            tails[k], ends[k] = value, at
        before[at] = ends[k - 1] if k else -1
    chain, at = [], ends[-1]
    while at >= 0:
        chain.append(at)
        at = before[at]
    return np.array(chain[::-1])


def links(pairs: DataFrame, shingles: DataFrame) -> DataFrame:
    """The pairs that are near duplicates; `shingles` has node and shingles of every candidate."""
    # Both sides grow with the corpus: the same shuffled plan at every size, never a broadcast.
    side = lambda node, own: shingles.select(F.col("node").alias(node), F.col("shingles").alias(own)).hint("merge")
    joined = pairs.join(side("b", "of_b"), "b").join(side("a", "of_a"), "a")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [batch.column(name) for name in ("of_a", "of_b")]
            offsets = [side.offsets.to_numpy() for side in sides]
            values = [side.values.to_numpy(zero_copy_only=False) for side in sides]
            good = np.zeros(len(batch), dtype=bool)
            for row in range(len(batch)):
                a, b = (v[o[row] : o[row + 1]] for o, v in zip(offsets, values, strict=True))
                if min(len(a), len(b)) >= LEAST_SIMILARITY * max(len(a), len(b)):
                    good[row] = min(similarity(a, b)) >= LEAST_SIMILARITY
            yield pa.RecordBatch.from_arrays(
                [batch.column(name).filter(pa.array(good)) for name in ("a", "b")], names=["a", "b"]
            )

    return joined.select("a", "b", "of_a", "of_b").mapInArrow(verify, "a bigint, b bigint")


def _rarity(shingles: DataFrame) -> np.ndarray:
    """How many shingles fall to each of COUNT_SLOTS slots."""
    keys = shingles.select(F.explode("shingles").alias("key"))
    counts = keys.groupBy(F.pmod("key", F.lit(COUNT_SLOTS)).alias("slot")).agg(F.count("*").alias("n")).toArrow()
    out = np.zeros(COUNT_SLOTS, dtype=np.int64)
    out[counts["slot"].to_numpy()] = counts["n"].to_numpy()
    return out


def _prefixes(members: DataFrame, rarity: np.ndarray) -> DataFrame:
    """(node, label, key, pos, len), stored: the rarest shingles of each text, as many as it takes that
    two texts at the least similarity share one, with their place in that order."""
    shared = members.sparkSession.sparkContext.broadcast(rarity)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            side = batch.column("shingles")
            offsets, values = side.offsets.to_numpy(), side.values.to_numpy(zero_copy_only=False)
            picked, lengths = [], np.diff(offsets)
            for row, length in enumerate(lengths.tolist()):
                own = np.unique(values[offsets[row] : offsets[row + 1]])
                order = np.argsort(shared.value[own % COUNT_SLOTS], kind="stable")
                picked.append(own[order[: length - ceil(LEAST_SIMILARITY * length - 1e-6) + 1]])
            counts = np.array([len(keys) for keys in picked], dtype=np.int64)
            row = np.repeat(np.arange(len(picked)), counts)
            place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node").take(pa.array(row)),
                    batch.column("label").take(pa.array(row)),
                    pa.array(np.concatenate([*picked, np.zeros(0, dtype=np.int32)]).astype(np.int32)),
                    pa.array(place.astype(np.int32)),
                    pa.array(lengths[row].astype(np.int32)),
                ],
                names=["node", "label", "key", "pos", "len"],
            )

    rows = members.select("node", "label", "shingles").mapInArrow(
        make, "node bigint, label bigint, key int, pos int, len int"
    )
    rows = stored(rows, "prefixes")
    shared.destroy()
    return rows


def across(met: DataFrame, shingles: DataFrame, found: DataFrame) -> DataFrame:
    """Distinct pairs a < b of members of large buckets that lie in different components of `found`
    and whose shingles may be similar enough: a prefix-filtered join that misses none.

    Two texts at the least similarity share a shingle among the rarest of both, and from the first
    such shingle on both have enough left for the overlap. At each shingle all members but those of
    its largest component meet the others, so a component's own pairs are not made. The members of a
    frequent shingle are dealt to as many tasks as they fill with SALTED_ROWS each.
    """
    hot = met.filter(F.col("n") > SMALL_BUCKET).select("node").distinct()
    labels = hot.join(found, "node", "left").select("node", F.coalesce("label", "node").alias("label"))
    prefixes = _prefixes(shingles.join(labels, "node"), _rarity(shingles))
    sizes = prefixes.groupBy("key", "label").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("key").agg(
        F.max(F.struct("n", "label"))["label"].alias("largest"),
        F.count("*").alias("labels"),
        F.ceil(F.sum("n") / SALTED_ROWS).cast("int").alias("salts"),
    )
    apart = stored(prefixes.join(largest.filter("labels > 1").drop("labels"), "key"), "apart")
    minor = apart.filter("label <> largest").select(
        "key",
        F.pmod(F.xxhash64("node"), F.col("salts")).cast("int").alias("salt"),
        *(F.col(name).alias(f"{name}_x") for name in ("node", "label", "pos", "len")),
    )
    every = apart.select("*", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    overlap = LEAST_SIMILARITY / (1 + LEAST_SIMILARITY) * (F.col("len") + F.col("len_x")) - 1e-6
    left = F.least(F.col("len") - F.col("pos"), F.col("len_x") - F.col("pos_x"))
    met_there = minor.join(every, ["key", "salt"]).filter(
        (F.col("label") != F.col("label_x"))
        & ((F.col("label") == F.col("largest")) | (F.col("node_x") < F.col("node")))
        & (left >= overlap)
    )
    pairs = met_there.select(_pair(F.col("node_x"), F.col("node")).alias("pair"))
    return pairs.distinct().select("pair.a", "pair.b")


def connected(met: DataFrame, shingles: DataFrame) -> DataFrame:
    """node, label: components of the links of `candidates`, then joined by the links across them."""
    pairs = stored(candidates(met), "pairs")
    found = stored(components(stored(links(pairs, shingles), "links")), "components")
    bridges = links(stored(across(met, shingles, found), "across"), shingles)
    side = lambda node, label: found.select(F.col("node").alias(node), F.col("label").alias(label))
    bridges = bridges.join(side("a", "x"), "a", "left").join(side("b", "y"), "b", "left")
    bridges = stored(bridges.select("a", "b", F.coalesce("x", "a").alias("x"), F.coalesce("y", "b").alias("y")), "bridges")
    if bridges.isEmpty():
        return found
    joined = components(bridges.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))
    joined = joined.select(F.col("node").alias("label"), F.col("label").alias("least"))
    alone = bridges.select(F.col("a").alias("node"), F.col("x").alias("label")).union(bridges.select("b", "y"))
    nodes = found.union(alone).distinct()
    return nodes.join(joined, "label", "left").select("node", F.coalesce("least", "label").alias("label"))


def components(edges: DataFrame) -> DataFrame:
    """node, label: the least node of each node's connected component.

    Every node first joins its least neighbour, and edges inside what that brings together drop out:
    most classes are stars around a few texts and end here. The rest is labelled in rounds.
    """
    edges = stored(edges.select("a", "b").distinct(), "edges")
    both = edges.union(edges.select(F.col("b"), F.col("a")))
    first = stored(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("near")), "near")
    left = first.select(F.col("node").alias("a"), F.col("near").alias("x"))
    right = first.select(F.col("node").alias("b"), F.col("near").alias("y"))
    rest = edges.join(left, "a").join(right, "b").filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b"))
    rest = stored(rest.distinct(), "edges")
    if rest.isEmpty():
        return first.select("node", F.col("near").alias("label"))
    labels = _labels(rest).withColumnRenamed("node", "near")
    return first.join(labels, "near", "left").select("node", F.coalesce("label", "near").alias("label"))


def _labels(edges: DataFrame) -> DataFrame:
    """Labels in rounds: the least label among the neighbours, then that label's own label, so that
    labels travel far. Each round is a written table; ends when a round changes nothing."""
    both = stored(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("near")), "b")
        least = near.groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        nearer = labels.join(least, "node").select(
            "node", F.least("label", "near").alias("label"), F.col("label").alias("was")
        )
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = stored(
            nearer.join(jump, "label", "left").select(
                "node", F.least("label", F.coalesce("further", "label")).alias("label"), "was"
            ),
            "labels",
        )
        if new.filter("label <> was").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")


def _labelled(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, label, class_id of every row; label is null for wordless texts. Stored.

    A text is a node by the number of one of its rows, so texts that share an id stay apart.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "shingles")
    made = stored_at(features(docs), path)
    entries = [F.min(name).alias(name) for name in _ENTRY_COLUMNS]
    texts = stored(
        made.filter("n_words > 0").groupBy("digest", "n_words").agg(
            F.min("row").alias("node"), F.min("doc_id").alias("least_id"), *entries
        ),
        "texts",
    )
    ids = stored(made.select("doc_id", "text_key", "digest", "n_words"), "digests")
    met = stored(buckets(texts), "buckets")
    # From here on only texts that share an entry with another one matter; their shingles move once.
    wanted = met.select("node").distinct()
    shingles = stored(
        made.select(F.col("row").alias("node"), "shingles").join(wanted.hint("merge"), "node", "left_semi"), "candidates"
    )
    remove_path(spark, path)
    found = connected(met, shingles)
    named = texts.select("digest", "n_words", "node", "least_id").join(found, "node", "left")
    named = stored(named.withColumn("label", F.coalesce("label", "node")).drop("node"), "labels")
    least = named.groupBy("label").agg(F.min("least_id").alias("class_id"))
    named = named.drop("least_id").join(least, "label")
    # Wordless rows meet nothing here, so that they never gather in one task.
    with_words = ids.filter("n_words > 0").join(named, ["digest", "n_words"])
    wordless = ids.filter("n_words = 0").select(
        "doc_id", "text_key", F.lit(None).cast("bigint").alias("label"), F.col("doc_id").alias("class_id")
    )
    return with_words.select("doc_id", "text_key", "label", "class_id").union(wordless)


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id of every document: the least id of its near-duplicate class.

    Texts are compared by their lower-cased words. Null and wordless texts are alone, in a class of
    their own id. Rows that repeat an id are listed as often, each with the class of its own text; rows
    without an id take the class of their text and never give it their id, so a class of nothing else
    has none. Very long texts are compared whole. Writes tables to scratch and runs jobs.
    """
    return _labelled(docs).select("doc_id", "class_id")


def dedupe(docs: DataFrame) -> DataFrame:
    """One row of each class, the one with the least id, with its columns.

    Rows without an id are all kept. Where the least id is repeated in a class, the text with the least
    hash stays, once. Wordless rows stay once for each id. Whole texts move once, to a narrow list of
    those to keep, and once more only if that list has repeated rows.
    """
    rows = _labelled(docs).filter("doc_id IS NOT NULL")
    alike = F.when(F.col("label").isNull(), F.col("doc_id")).alias("alone")
    counts = rows.groupBy("label", alike, "doc_id", "text_key").agg(F.count("*").alias("n"))
    first = F.min(F.struct("doc_id", "text_key", "n"))
    keep = stored(counts.groupBy("label", "alone").agg(first.alias("keep")).select("keep.*"), "kept-rows")
    name = free_name(docs, "text_key")
    keyed = docs.withColumn(name, F.xxhash64("text"))
    once = lambda some: keyed.join(some.withColumnRenamed("text_key", name).hint("merge"), ["doc_id", name], "left_semi")
    several = keep.filter("n > 1")
    kept = once(keep.filter("n = 1"))
    if not several.isEmpty():
        kept = kept.union(once(several).dropDuplicates(["doc_id", name]))
    return kept.select(*docs.columns).union(docs.filter("doc_id IS NULL"))
