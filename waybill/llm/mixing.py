"""Mixing sources to target weights by subset-sum budget fitting.

Texts are read once, for their sizes in words. Each source's target is a number of whole passes over
it plus a remaining budget; documents are counted by exact size, a bounded knapsack over those counts
says how many documents of each size fill the budget, and the documents are then picked by seeded
hash. Only (source, size) counts reach the knapsack, one source to a task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.common import BLANK_WORD, free_name, repeat, stored

#: The weights that sources take in turn, and the most passes over a source.
WEIGHTS = (5, 2, 1)
MOST_PASSES = 3
SEED = 17
#: Documents of one source and size are dealt to this many buckets by hash, so that ranking them
#: never gathers a hot size in one task.
BUCKETS = 1024
#: Words of budget that the knapsack itself fits word by word; larger budgets in cells of more words.
KNAPSACK_WORDS = 1 << 16


def sizes(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, source, size, text_key, draw: one short row per document; a null text has size 0."""
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(BLANK_WORD)), F.lit(0)).cast("bigint")
    return docs.select(
        "doc_id",
        "source",
        size.alias("size"),
        F.xxhash64("text").alias("text_key"),
        F.xxhash64(F.lit(seed), "doc_id").alias("draw"),
    )


def targets(counts: DataFrame) -> DataFrame:
    """source, source_size, target of every source, from (source, size, n) rows.

    Sources take the weights by code point, null last. A source gets min(3 * size, level * weight),
    with the one level that makes the targets add up to all words: what resharing the excess ends at.
    The windows run over one row per source.
    """
    per_source = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (turn % len(WEIGHTS) + 1).cast("int"))
    weighed = per_source.withColumn("weight", weight).withColumns(
        {
            "most": F.lit(MOST_PASSES) * F.col("source_size"),
            "all": F.sum("source_size").over(Window.partitionBy()),
            "weights": F.sum("weight").over(Window.partitionBy()),
        }
    )
    fullness = F.col("most") / F.col("weight")
    before = Window.orderBy(fullness, F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    left = F.col("all") - F.coalesce(F.sum("most").over(before), F.lit(0))
    weight_left = F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levelled = weighed.withColumn("own_level", left / weight_left)
    below = F.col("own_level") <= fullness
    levelled = levelled.withColumn(
        "level", F.max(F.when(below, F.col("own_level"))).over(Window.partitionBy())
    )
    target = F.when(below, F.col("level") * F.col("weight")).otherwise(F.col("most").cast("double"))
    return levelled.select("source", "source_size", target.alias("target"))


def fit(lengths: np.ndarray, free: np.ndarray, budget: int) -> np.ndarray:
    """How many of the `free` documents of each length add up as near as possible to `budget`.

    Bounded knapsack: multiplicities are split into powers of two, and for each sum the part that
    first reached it is kept, which is enough to read the choice back. Stops when the budget is met.
    Above KNAPSACK_WORDS, sums are kept exactly but one to a cell of budget / KNAPSACK_WORDS words.
    """
    chosen = np.zeros(len(lengths), dtype=np.int64)
    if budget <= 0:
        return chosen
    limit, cell = 2 * budget, -(-budget // KNAPSACK_WORDS)
    reached = np.full(limit // cell + 1, -1, dtype=np.int64)
    reached[0] = 0
    by = np.full(len(reached), -1, dtype=np.int64)
    parts: list[tuple[int, int]] = []
    for i in np.argsort(-lengths, kind="stable"):
        length, left, step = int(lengths[i]), int(free[i]), 1
        if not 0 < length <= limit:
            continue
        left = min(left, limit // length)
        while left > 0 and reached[budget // cell] != budget:
            times = min(step, left)
            left, step = left - times, step * 2
            sums = reached[reached >= 0] + times * length
            sums = sums[sums <= limit]
            at = sums // cell
            new = reached[at] < 0
            new[1:] &= at[1:] != at[:-1]
            reached[at[new]], by[at[new]] = sums[new], len(parts)
            parts.append((int(i), times))
        if reached[budget // cell] == budget:
            break
    sums = reached[reached >= 0]
    total = int(sums[np.argmin(np.abs(sums - budget))])
    while total:
        i, times = parts[by[total // cell]]
        chosen[i] += times
        total -= times * int(lengths[i])
    return chosen


def _settled(lengths: np.ndarray, counts: np.ndarray, taken: np.ndarray, budget: int) -> tuple[int, np.ndarray]:
    """How far from the budget, and the choice: documents fitted to what `taken` leaves, then to what
    is left or over after that. Never further off than `taken`."""
    for _ in range(3):
        rest = budget - int((lengths * taken).sum())
        if rest > 0:
            taken = taken + fit(lengths, counts - taken, rest)
        elif rest < 0:
            taken = taken - fit(lengths, taken, -rest)
    return abs(budget - int((lengths * taken).sum())), taken


def quotas(lengths: np.ndarray, counts: np.ndarray, target: float) -> tuple[int, np.ndarray]:
    """Whole passes over a source, and how many documents of each length to take once more.

    Lengths share the remaining budget evenly, rounded down; what rounding leaves goes to the longest
    documents that fit until the knapsack can fit the rest. Where that does not meet the budget, as
    when only documents longer than the rest are free, the knapsack also starts from the even share
    and from nothing, and the nearest choice is taken.
    """
    total = int((lengths * counts).sum())
    if total == 0:
        return 0, np.zeros(len(lengths), dtype=np.int64)
    goal = min(round(target), MOST_PASSES * total)
    passes, budget = divmod(goal, total)
    even = np.array([int(n) * budget // total for n in counts], dtype=np.int64)
    even[lengths == 0] = 0
    taken = even.copy()
    rest = budget - int((lengths * taken).sum())
    for i in np.argsort(-lengths, kind="stable"):
        if rest <= KNAPSACK_WORDS:
            break
        length = int(lengths[i])
        if length:
            more = min(int(counts[i] - taken[i]), rest // length, -(-(rest - KNAPSACK_WORDS) // length))
            taken[i] += more
            rest -= more * length
    off, taken = _settled(lengths, counts, taken, budget)
    for start in (even, np.zeros_like(even)):
        if off:
            other, choice = _settled(lengths, counts, start, budget)
            off, taken = (other, choice) if other < off else (off, taken)
    return passes, taken


def _quotas_of_source(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("size", ignore_index=True)
    passes, more = quotas(rows["size"].to_numpy(), rows["n"].to_numpy(), float(rows["target"].iloc[0]))
    return pd.DataFrame({"source": rows["source"], "size": rows["size"], "passes": passes, "more": more})


def plan(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """Every document with its share: doc_id, source, size, text_key, source_size, target, copies, taken.

    `copies` is how often the mix takes the document, `taken` the words that makes. Null sources are
    one source. Null and empty texts have no words, and sources without words a target of 0. Rows that
    repeat an id are documents of their own. The sizes and their counts are written to scratch.
    """
    sized = stored(sizes(docs, seed).withColumn("bucket", F.pmod("draw", F.lit(BUCKETS))), "sizes")
    dealt = stored(sized.groupBy("source", "size", "bucket").agg(F.count("*").alias("n")), "size-counts")
    counts = dealt.groupBy("source", "size").agg(F.sum("n").alias("n"))
    goals = stored(targets(counts), "targets")
    of = goals.withColumnRenamed("source", "of_source")
    fitted = stored(
        counts.join(of, F.col("source").eqNullSafe(F.col("of_source")))
        .select("source", "size", "n", "target")
        .groupBy("source")
        .applyInPandas(_quotas_of_source, "source string, size bigint, passes bigint, more bigint"),
        "quotas",
    )
    quota = fitted.select(
        F.col("source").alias("of_source"), F.col("size").alias("of_size"), "passes", "more"
    )
    before = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("n").over(before), F.lit(0))
    by_bucket = (
        dealt.join(quota, F.col("source").eqNullSafe(F.col("of_source")) & (F.col("size") == F.col("of_size")))
        .withColumn("most", F.greatest(F.lit(0), F.least(F.col("n"), F.col("more") - earlier)))
        .select("of_source", "of_size", F.col("bucket").alias("of_bucket"), "passes", "most")
    )
    same = (
        F.col("source").eqNullSafe(F.col("of_source"))
        & (F.col("size") == F.col("of_size"))
        & (F.col("bucket") == F.col("of_bucket"))
    )
    turn = F.row_number().over(
        Window.partitionBy("source", "size", "bucket").orderBy("draw", "doc_id", "text_key")
    )
    shares = (
        sized.join(by_bucket, same)
        .withColumn("copies", F.col("passes") + (turn <= F.col("most")).cast("bigint"))
        .drop("of_source")
        .join(of, F.col("source").eqNullSafe(F.col("of_source")))
    )
    return shares.select(
        "doc_id", "source", "size", "text_key", "source_size", "target", "copies",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mixed corpus: each document as often as its share says, with all its columns.

    Of rows that repeat one id and text, the first ones take what does not divide evenly.
    """
    shares = stored(
        plan(docs, seed)
        .groupBy(F.col("doc_id").alias("of_doc"), F.col("source").alias("of_source"), F.col("text_key"))
        .agg(F.sum("copies").alias("all_copies"), F.count("*").alias("rows")),
        "shares",
    )
    same = (
        docs["doc_id"].eqNullSafe(shares["of_doc"])
        & docs["source"].eqNullSafe(shares["of_source"])
        & (F.xxhash64(docs["text"]) == shares["text_key"])
    )
    times = free_name(docs, "times")
    single = docs.join(shares.filter("rows = 1"), same).select(
        *(docs[c] for c in docs.columns), shares["all_copies"].alias(times)
    )
    one_group = Window.partitionBy(shares["of_doc"], shares["of_source"], shares["text_key"])
    turn = F.row_number().over(one_group.orderBy(F.lit(0)))
    share = F.floor(shares["all_copies"] / shares["rows"]) + (turn <= shares["all_copies"] % shares["rows"]).cast("bigint")
    several = docs.join(shares.filter("rows > 1"), same).select(
        *(docs[c] for c in docs.columns), share.alias(times)
    )
    both = single.union(several)
    return repeat(both, F.col(times)).drop(times)
