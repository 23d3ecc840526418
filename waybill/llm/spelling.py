"""Spelling variants: vocabulary words one edit apart, found by Bloom-guided neighbourhoods.

Every word's edits are generated as hashes: the word without a letter, and with a letter replaced by a
later one of the alphabet (the other directions are the same pairs seen from the other word). An edit is
looked up in Bloom filters of the vocabulary, cut into shards by length and, within a length, by hash, and
each filter into blocks of 512 bits that a single memory line holds. Only edits that a filter knows are
written out as strings and shuffled to an exact join with the vocabulary, which removes the filters' false
positives. Filters have no false negatives, so no pair is lost.

Filters are built by bit-wise aggregates that combine before their shuffle, and broadcast in passes of at
most PASS_BYTES, so the broadcast stays the same when the vocabulary grows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import LOWER, UPPER, stored
from waybill.llm.hashing import U, mixed, powers, salted

#: Letters of a word, once A-Z are lower-cased.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
#: Words of a filter shard, bits a word, lanes of 64 bits in a block, and bytes broadcast at once.
SHARD_WORDS, BITS, LANES, PASS_BYTES = 1 << 13, 24, 8, 64 << 20
#: Longer words share the shards of this length.
LONGEST_CLASS = 64
#: Words are handled in groups of about this many letters.
GROUP_LETTERS = 1 << 16

BLOCKS = SHARD_WORDS * BITS // (64 * LANES)
SHARD_BYTES = BLOCKS * LANES * 8
_INVERSE = pow(int(powers(2)[1]), -1, 1 << 64)


def word_counts(
    docs: DataFrame, least_length: int = 6, least_count: int = 5, letter_lost: int | None = None
) -> DataFrame:
    """word, n: lower-cased (A-Z) runs of letters of whole texts, with their occurrences.

    Counts combine before their shuffle, so a word with a third of all occurrences is a row per task.
    With `letter_lost`, an occurrence loses the letter `h % length` where `letter_lost` divides h, the
    CRC-32 of `<doc_id>:<run>`; a null id is the empty string there. Null and empty texts have no words.
    """
    plain = F.translate("text", UPPER, LOWER)
    # Runs that are too short from the outset are not even extracted.
    found = F.explode(F.regexp_extract_all(plain, F.lit(f"[a-zÀ-ÿ]{{{least_length},}}"), F.lit(0)))
    if letter_lost:
        tagged = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), found.alias("run"))
        hashed = tagged.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
        at = (F.col("h") % F.char_length("run")).cast("int")
        cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
        words = hashed.select(F.when(F.col("h") % letter_lost == 0, cut).otherwise(F.col("run")).alias("word"))
        words = words.filter(F.char_length("word") >= least_length)
    else:
        words = docs.select(found.alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


@dataclass
class Layout:
    """Which shards hold the words of a length: the first one, and how many."""

    first: np.ndarray
    parts: np.ndarray

    @property
    def shards(self) -> int:
        return int(self.parts.sum())

    def shard(self, key: np.ndarray, length: int) -> np.ndarray:
        """The shard of keys of words of `length`; that length has words."""
        at = min(length, LONGEST_CLASS)
        return self.first[at] + ((key >> U(40)) % U(self.parts[at])).astype(np.int64)

    def known(self, length: int) -> bool:
        return bool(self.parts[min(length, LONGEST_CLASS)])


def layout(vocabulary: DataFrame) -> Layout:
    length = F.least(F.char_length("word"), F.lit(LONGEST_CLASS)).alias("length")
    rows = vocabulary.groupBy(length).agg(F.count("*").alias("n")).collect()
    parts = np.zeros(LONGEST_CLASS + 1, dtype=np.int64)
    for row in rows:
        parts[row.length] = -(-row.n // SHARD_WORDS)
    return Layout(np.cumsum(parts) - parts, parts)


def letter_groups(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, letters): words of equal length as a matrix of code points, in bounded groups."""
    words = column.to_pylist()
    lengths = np.array([len(word) for word in words], dtype=np.int64)
    order = np.argsort(lengths, kind="stable")
    begin = 0
    while begin < len(order):
        length = int(lengths[order[begin]])
        end = min(int(np.searchsorted(lengths[order], length, side="right")), begin + max(1, GROUP_LETTERS // max(1, length)))
        rows = order[begin:end]
        data = "".join([words[k] for k in rows.tolist()]).encode("utf-32-le")
        yield rows, np.frombuffer(data, dtype=np.uint32).reshape(len(rows), length)
        begin = end


def _terms(letters: np.ndarray) -> np.ndarray:
    return (letters.astype(U) + U(1)) * powers(letters.shape[1] + 1)[: letters.shape[1]]


def _key(total: np.ndarray, length: int) -> np.ndarray:
    return mixed(total + U(length * 0x9E3779B97F4A7C15 % 2**64))


def keys(letters: np.ndarray) -> np.ndarray:
    """64-bit keys of words of one length."""
    return _key(_terms(letters).sum(axis=1, dtype=U), letters.shape[1])


def deletions(letters: np.ndarray) -> np.ndarray:
    """Keys of the words without their i-th letter, a row per word."""
    terms = _terms(letters)
    ends = np.cumsum(terms, axis=1, dtype=U)
    before = ends - terms
    after = (ends[:, -1:] - ends) * U(_INVERSE)
    return _key(before + after, letters.shape[1] - 1)


def replacements(letters: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(letter, places, keys): the words with an earlier letter of the alphabet replaced by that letter;
    places count through the matrix row by row."""
    size, length = letters.shape
    by = np.tile(powers(length + 1)[:length], size)
    flat = letters.ravel()
    rest = np.repeat(_terms(letters).sum(axis=1, dtype=U), length) - flat.astype(U) * by
    for letter in map(ord, LETTERS):
        place = np.flatnonzero(flat < letter)
        yield letter, place, _key(rest[place] + U(letter) * by[place], length)


def lane_masks(key: np.ndarray) -> np.ndarray:
    """The bit of each lane that a key sets, a row per key."""
    bits = salted(key, 3)[:, None] >> (U(6) * np.arange(LANES, dtype=U))
    return U(1) << (bits & U(63))


def block_of(key: np.ndarray) -> np.ndarray:
    return ((key & U(0xFFFFFFFF)) % U(BLOCKS)).astype(np.int64)


def filter_bits(vocabulary: DataFrame, shards: Layout) -> DataFrame:
    """shard, block and its lanes: the filters of a vocabulary, ORed together before the shuffle."""
    lanes = [f"lane{k}" for k in range(LANES)]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, letters in letter_groups(batch.column("word")):
                key = keys(letters)
                masks = lane_masks(key).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shards.shard(key, letters.shape[1])),
                        pa.array(block_of(key)),
                        *[pa.array(np.ascontiguousarray(masks[:, k])) for k in range(LANES)],
                    ],
                    names=["shard", "block", *lanes],
                )

    kind = "shard bigint, block bigint, " + ", ".join(f"{lane} bigint" for lane in lanes)
    made = vocabulary.select("word").mapInArrow(make, kind)
    return made.groupBy("shard", "block").agg(*[F.bit_or(lane).alias(lane) for lane in lanes])


@dataclass
class Filters:
    """The filter shards `low` to `high` of a layout."""

    shards: Layout
    low: int
    high: int
    bits: np.ndarray

    def holds(self, key: np.ndarray, length: int) -> np.ndarray:
        """Which keys of words of `length` may be in the vocabulary and lie in these shards: their places."""
        if not self.shards.known(length):
            return np.zeros(0, dtype=np.int64)
        shard = self.shards.shard(key, length) - self.low
        at = np.flatnonzero((shard >= 0) & (shard < self.high - self.low))
        own = key[at]
        line = shard[at] * BLOCKS + block_of(own)
        bits = salted(own, 3)
        for lane in range(LANES):
            mask = U(1) << ((bits >> U(6 * lane)) & U(63))
            kept = np.flatnonzero(self.bits[line, lane] & mask)
            at, line, bits = at[kept], line[kept], bits[kept]
        return at


def probe(vocabulary: DataFrame, filters) -> DataFrame:
    """word, n, edit: the edits of each word that the broadcast `filters` know, once each."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = filters.value
        for batch in batches:
            words, counts = batch.column("word"), batch.column("n")
            for rows, letters in letter_groups(words):
                size, length = letters.shape
                found: list[tuple[int, int, int]] = []
                # Of equal letters in a row, the first is the one left out.
                first = np.ones((size, length), dtype=bool)
                first[:, 1:] = letters[:, 1:] != letters[:, :-1]
                place = np.flatnonzero(first)
                place = place[known.holds(deletions(letters).ravel()[place], length - 1)]
                found += [(*divmod(p, length), -1) for p in place.tolist()]
                for letter, place, key in replacements(letters):
                    place = place[known.holds(key, length)]
                    found += [(*divmod(p, length), letter) for p in place.tolist()]
                if not found:
                    continue
                of = [rows[row] for row, _, _ in found]
                own = words.take(pa.array(of))
                edits = [
                    word[:at] + (chr(letter) if letter >= 0 else "") + word[at + 1 :]
                    for word, (_, at, letter) in zip(own.to_pylist(), found, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [own, counts.take(pa.array(of)), pa.array(edits)], names=["word", "n", "edit"]
                )

    return vocabulary.select("word", "n").mapInArrow(make, "word string, n bigint, edit string")


def near_words(vocabulary: DataFrame) -> DataFrame:
    """word, near, n, near_n: all ordered pairs of `vocabulary` (word, n) that are one edit apart.

    Words are distinct and made of LETTERS. Writes tables to scratch and runs a job per pass.
    """
    spark, shards = vocabulary.sparkSession, layout(vocabulary)
    bits = stored(filter_bits(vocabulary, shards), "filters")
    step, passes = max(1, PASS_BYTES // SHARD_BYTES), []
    for low in range(0, shards.shards, step):
        high = min(low + step, shards.shards)
        own = bits.filter(F.col("shard").between(low, high - 1)).toArrow()
        table = np.zeros(((high - low) * BLOCKS, LANES), dtype=U)
        line = (own["shard"].to_numpy() - low) * BLOCKS + own["block"].to_numpy()
        for lane in range(LANES):
            table[line, lane] = own[f"lane{lane}"].to_numpy().view(U)
        shared = spark.sparkContext.broadcast(Filters(shards, low, high, table))
        passes.append(stored(probe(vocabulary, shared), "positives"))
        shared.destroy()
    if not passes:
        return vocabulary.select("word", F.col("word").alias("near"), "n", F.col("n").alias("near_n")).filter("false")
    positives = reduce(DataFrame.union, passes)
    exact = vocabulary.select(F.col("word").alias("edit"), F.col("n").alias("near_n"))
    pairs = positives.join(exact, "edit").select("word", F.col("edit").alias("near"), "n", "near_n")
    turned = pairs.select(F.col("near"), F.col("word"), F.col("near_n"), F.col("n"))
    both = F.array(
        F.struct("word", "near", "n", "near_n"),
        F.struct(*[F.col(a).alias(b) for a, b in zip(turned.columns, ("word", "near", "n", "near_n"), strict=True)]),
    )
    return pairs.select(F.inline(both))


def _roots(links: DataFrame) -> DataFrame:
    """word, root: the end of each word's chain of forms. Every round doubles how far a word sees."""
    seen = stored(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = seen.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = stored(
            seen.join(further, "root", "left").select(
                "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
            ),
            "roots",
        )
        if new.filter("moved").isEmpty():
            return seen
        seen = new.select("word", "root")


def variants(vocabulary: DataFrame, times: int = 5) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of `vocabulary` (word, n).

    A word's form is the most frequent word one edit away (ties: least in code-point order) if it occurs
    at least `times` as often; null otherwise. The root is the last form that following forms leads to.
    As counts grow along a chain, there are no cycles.
    """
    vocabulary = stored(vocabulary.select("word", "n"), "vocabulary")
    near = near_words(vocabulary).groupBy(F.col("word").alias("of")).agg(
        F.count("*").alias("n_near"), F.min(F.struct(-F.col("near_n"), "near"))["near"].alias("near"),
        F.max("near_n").alias("near_n"),
    )
    is_form = F.col("near_n") >= times * F.col("n")
    known = stored(
        vocabulary.join(near, vocabulary["word"] == near["of"], "left").select(
            "word",
            F.when(is_form, F.col("near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(is_form, F.col("near_n")).alias("form_n"),
        ),
        "near",
    )
    roots = _roots(known.filter("form IS NOT NULL")).withColumnRenamed("word", "of")
    return known.join(roots, known["word"] == roots["of"], "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
