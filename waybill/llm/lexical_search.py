"""Ranked lexical search: item weights times document impacts, as dense blocked multiplication.

Documents are counted against the items' vocabulary once, in Arrow batches, and what they hold of it
is stored as sparse rows; document counts, lengths and term weights come from that table. Then tiles of
documents are turned into dense impact matrices, a vocabulary tile at a time, and multiplied by the
items' weights with BLAS. All factors are whole numbers, and a vocabulary tile ends where the largest
possible sum of an item would reach 2^53, so every product is exact in float64; tiles are added up in
64-bit integers. Each task keeps the best documents of each item, ties at the last place included in
every comparison, and the tasks' best are ranked once more.

Items are searched in blocks, so what is broadcast is bounded by ITEM_BLOCK_TERMS and the longest item.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from waybill.llm.common import stored, words
from waybill.llm.hashing import Run, hash_spans, runs
from waybill.llm.repair import ranges

#: A term's impact is below this, weights and impacts are in thousandths and millionths.
LARGEST_IMPACT = 1_000_000
#: Terms of the items (repeats included) that are searched in one pass over the documents.
ITEM_BLOCK_TERMS = 1 << 17
#: Sizes of the matrices that are multiplied.
ITEM_TILE, VOCABULARY_TILE, DOCUMENT_TILE = 256, 1024, 1024
#: Sums in float64 stay below this.
EXACT = 1 << 53

_COUNTS = "doc_id bigint, n bigint, terms array<int>, counts array<int>"
_BEST = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


class Vocabulary:
    """Terms by the order of their hashes, with their bytes for exact comparison."""

    def __init__(self, terms: list[str]):
        packed = [term.encode() for term in terms]
        ends = np.cumsum([len(p) for p in packed]).astype(np.int64)
        data = np.frombuffer(b"".join(packed), dtype=np.uint8)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        hashes = hash_spans(data, starts, ends)
        order = np.argsort(hashes)
        self.data, self.hashes = data, hashes[order]
        self.starts, self.lengths = starts[order], (ends - starts)[order]
        self.terms = [terms[k] for k in order]

    def places(self, run: Run) -> tuple[np.ndarray, np.ndarray]:
        """(words of the run that are terms, the term of each)."""
        at = np.searchsorted(self.hashes, run.word_hash)
        at[at == len(self.hashes)] = 0
        length = run.word_ends - run.word_starts
        found = np.flatnonzero((self.hashes[at] == run.word_hash) & (self.lengths[at] == length))
        if not len(found):
            return found, found
        at, length = at[found], length[found]
        same = run.lowered_data[ranges(run.word_starts[found], length)] == self.data[ranges(self.starts[at], length)]
        exact = np.logical_and.reduceat(same, np.cumsum(length) - length)
        return found[exact], at[exact]


@dataclass
class Tile:
    """Part of an item tile's vocabulary: its terms, and weights of items (rows) for them (columns)."""

    terms: np.ndarray
    rows: np.ndarray
    columns: np.ndarray
    weights: np.ndarray

    def matrix(self, items: int) -> np.ndarray:
        out = np.zeros((items, len(self.terms)))
        out[self.rows, self.columns] = self.weights
        return out


def tiles(rows: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> list[Tile]:
    """Vocabulary tiles of one item tile, from its (item, term, weight) entries with positive weights.

    A tile has at most VOCABULARY_TILE terms, and no item's weights in it, times the largest impact,
    reach EXACT. A weight that is too large on its own is split over several tiles.
    """
    most = (EXACT - 1) // LARGEST_IMPACT
    out: list[Tile] = []
    held: dict[int, int] = {}
    part: list[tuple[int, int, int]] = []
    columns: dict[int, int] = {}

    def close() -> None:
        if part:
            r, c, w = (np.array(x, dtype=np.int64) for x in zip(*part, strict=True))
            out.append(Tile(np.array(list(columns), dtype=np.int64), r, c, w.astype(np.float64)))
        held.clear(), part.clear(), columns.clear()

    for k in np.argsort(terms, kind="stable").tolist():
        row, term, left = int(rows[k]), int(terms[k]), int(weights[k])
        while left:
            take = min(left, most)
            if held.get(row, 0) + take > most or (term not in columns and len(columns) == VOCABULARY_TILE):
                close()
            part.append((row, columns.setdefault(term, len(columns)), take))
            held[row] = held.get(row, 0) + take
            left -= take
    close()
    return out


def counted(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, n (terms of the text, all of them), and its vocabulary terms with their counts.

    Documents without any term are left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for row, run in runs(batch.column("text"), lowered=True, blank_words=False):
                at, term = known.places(run)
                keys, counts = np.unique(run.word_text[at] * len(known.terms) + term, return_counts=True)
                text, term = np.divmod(keys, len(known.terms))
                ends = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=run.texts))])
                ends = pa.array(ends.astype(np.int32))
                found = pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(row, run.texts),
                        pa.array(run.words.astype(np.int64)),
                        pa.ListArray.from_arrays(ends, pa.array(term.astype(np.int32))),
                        pa.ListArray.from_arrays(ends, pa.array(counts.astype(np.int32))),
                    ],
                    names=["doc_id", "n", "terms", "counts"],
                )
                yield found.filter(pa.array(run.words > 0))

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(make, _COUNTS)


class Best:
    """The best documents of each item of a tile so far: highest score first, then least id."""

    def __init__(self, items: int, keep: int):
        self.keep = keep
        self.scores = [np.zeros(0, dtype=np.int64)] * items
        self.ids = [np.zeros(0, dtype=np.int64)] * items
        self.known = [np.zeros(0, dtype=bool)] * items

    def add(self, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        """A row per item and a column per document; documents that only tie with the last stay in play."""
        least = [own[-1] if len(own) == self.keep else 1 for own in self.scores]
        good = scores >= np.array(least, dtype=np.int64)[:, None]
        for item in np.flatnonzero(good.any(axis=1)).tolist():
            at = np.flatnonzero(good[item])
            score = np.concatenate([self.scores[item], scores[item, at]])
            own = np.concatenate([self.ids[item], ids[at]])
            has = np.concatenate([self.known[item], known[at]])
            order = np.lexsort((own, ~has, -score))[: self.keep]
            self.scores[item], self.ids[item], self.known[item] = score[order], own[order], has[order]


@dataclass
class Search:
    """What tasks need: item tiles with their first item and vocabulary tiles, and corpus statistics."""

    item_tiles: list[tuple[int, int, list[Tile]]]
    terms: int
    n_docs: int
    n_terms: int

    def impacts(self, n: np.ndarray, counts: np.ndarray) -> np.ndarray:
        length = 25 + (75 * n * self.n_docs) // self.n_terms
        return (1_000_000_000 * counts) // (1000 * counts + 8 * length)

    def scores(self, items: int, parts: list[Tile], term, doc, impact, docs: int) -> np.ndarray:
        out = np.zeros((items, docs), dtype=np.int64)
        for part in parts:
            place = np.full(self.terms, -1, dtype=np.int64)
            place[part.terms] = np.arange(len(part.terms))
            at = place[term]
            own = np.flatnonzero(at >= 0)
            if len(own):
                dense = np.zeros((len(part.terms), docs))
                dense[at[own], doc[own]] = impact[own]
                out += (part.matrix(items) @ dense).astype(np.int64)
        return out


def _best_of_tasks(rows: DataFrame, search: Search, keep: int) -> DataFrame:
    """item, doc_id, score: each task's best documents of each item."""
    shared = rows.sparkSession.sparkContext.broadcast(search)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        best = [Best(items, keep) for _, items, _ in plan.item_tiles]
        for batch in batches:
            for row in range(0, len(batch), DOCUMENT_TILE):
                part = batch.slice(row, DOCUMENT_TILE)
                side = part.column("terms")
                first, last = side.offsets[0].as_py(), side.offsets[-1].as_py()
                term = side.values.to_numpy(zero_copy_only=False)[first:last]
                doc = np.repeat(np.arange(len(part)), np.diff(side.offsets.to_numpy()))
                counts = part.column("counts")
                count = counts.values.to_numpy(zero_copy_only=False)[counts.offsets[0].as_py() : counts.offsets[-1].as_py()]
                n = part.column("n").to_numpy(zero_copy_only=False)
                impact = plan.impacts(n[doc], count.astype(np.int64)).astype(np.float64)
                known = part.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
                ids = part.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
                for own, (_, items, parts) in zip(best, plan.item_tiles, strict=True):
                    own.add(plan.scores(items, parts, term, doc, impact, len(part)), ids, known)
        for own, (first_item, items, _) in zip(best, plan.item_tiles, strict=True):
            sizes = [len(x) for x in own.ids]
            if sum(sizes):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(first_item + np.repeat(np.arange(items), sizes)),
                        pa.array(np.concatenate(own.ids), mask=~np.concatenate(own.known)),
                        pa.array(np.concatenate(own.scores)),
                    ],
                    schema=_BEST,
                )

    return rows.mapInArrow(make, "item bigint, doc_id bigint, score bigint")


def _search_block(docs: DataFrame, item_terms: pa.Table, keep: int) -> DataFrame:
    """number (of the item), doc_id, score of one block of items, from (number, term, repeats)."""
    numbers, item = np.unique(item_terms["number"].to_numpy(), return_inverse=True)
    vocabulary = Vocabulary(sorted(set(item_terms["term"].to_pylist())))
    place = {term: k for k, term in enumerate(vocabulary.terms)}
    term = np.array([place[t] for t in item_terms["term"].to_pylist()], dtype=np.int64)
    repeats = item_terms["repeats"].to_numpy()

    rows = stored(counted(docs, vocabulary), "term-counts")
    n_docs, n_terms = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    per_term = rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toArrow()
    holding = np.zeros(len(place), dtype=np.int64)
    holding[per_term["term"].to_numpy()] = per_term["df"].to_numpy()
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in holding.tolist()])

    entry = repeats * weight[term]
    entry[holding[term] == 0] = 0
    item_tiles = []
    for first in range(0, len(numbers), ITEM_TILE):
        own = np.flatnonzero((item >= first) & (item < first + ITEM_TILE) & (entry > 0))
        size = min(ITEM_TILE, len(numbers) - first)
        item_tiles.append((first, size, tiles(item[own] - first, term[own], entry[own])))
    search = Search(item_tiles, len(place), int(n_docs), max(1, int(n_terms)))
    best = stored(_best_of_tasks(rows, search, keep), "task-best")
    named = docs.sparkSession.createDataFrame(
        pa.table({"item": np.arange(len(numbers)), "number": numbers}), "item bigint, number bigint"
    )
    return best.join(named, "item").select("number", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, keep: int = 10) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the best `keep` documents of each item, score above 0.

    `docs` has doc_id and text, `items` has item_id and text; further columns don't matter. Null and
    wordless texts have no terms: such documents don't count, such items have no rows. Equal scores go
    by doc_id, null last. Every row of `items` is an item of its own, rows that repeat an id too, and
    every row of `docs` a document of its own. Scores and document lengths are 64-bit integers, as the
    formula has it. Writes tables to scratch and runs jobs: two passes over the documents' terms for each
    block of ITEM_BLOCK_TERMS item terms.
    """
    numbered = stored(
        items.select(F.monotonically_increasing_id().alias("number"), "item_id", words(F.col("text")).alias("words")),
        "items",
    )
    terms = numbered.select("number", F.explode("words").alias("term"))
    terms = stored(terms.groupBy("number", "term").agg(F.count("*").alias("repeats")), "item-terms")
    total = terms.agg(F.coalesce(F.sum("repeats"), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(total / ITEM_BLOCK_TERMS))
    found = []
    for block in range(blocks):
        part = terms.filter(F.pmod(F.xxhash64("number"), F.lit(blocks)) == block).toArrow()
        if len(part):
            found.append(_search_block(docs, part, keep))
    if not found:
        empty = "item_id bigint, rank int, doc_id bigint, score bigint"
        return docs.sparkSession.createDataFrame([], empty)
    best = found[0]
    for more in found[1:]:
        best = best.union(more)
    order = W.partitionBy("number").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)
    return ranked.join(numbered.select("number", "item_id"), "number").select("item_id", "rank", "doc_id", "score")
