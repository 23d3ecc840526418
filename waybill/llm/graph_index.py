"""Approximate nearest neighbours by cosine: a robust-pruned directed graph per shard.

Equal vectors are one node, so a group of copies takes no more room than a vector. Nodes are dealt to
shards of bounded size by hash; a task builds a shard's graph: nodes come in batches of growing size, a
greedy search in the graph so far proposes each node's neighbours, and pruning keeps a neighbour only if
no kept one is closer to it by the factor ALPHA, so that edges point in diverse directions. Edges go both
ways and full nodes are pruned again. A second round inserts every node once more into the whole graph.

Queries are searched in every shard by beam search, in blocks of bounded size that are broadcast, and
scored in float64 on the vectors as they were given; the shards' best are merged. Nodes of an answer
stand for their rows with the least ids.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from waybill.llm.common import stored

#: Nodes of a shard, edges of a node, beam while building and while searching, and pruning factor.
SHARD_NODES, EDGES, BUILD_BEAM, SEARCH_BEAM, ALPHA = 4096, 32, 64, 96, 1.2
#: Searches that run together, and bytes of query vectors that are broadcast at once.
BATCH, QUERY_BYTES = 512, 16 << 20


def usable(vector: str) -> Column:
    """Whether a vector takes part: it has components, all finite and some not zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    every = F.forall(vector, finite) & F.exists(vector, lambda x: x != 0)
    return F.coalesce(F.col(vector).isNotNull() & every, F.lit(False))


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors in float64, each divided by a power of two near its largest component: no cosine changes
    and no square overflows."""
    vectors = vectors.astype(np.float64)
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, initial=0.0))
    return np.ldexp(vectors, -exponent[:, None])


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = scaled(vectors)
    return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)


class Graph:
    """A directed graph over unit vectors with at most EDGES edges a node; -1 fills free places."""

    def __init__(self, points: np.ndarray, edges: np.ndarray | None = None, start: int = 0):
        self.points, self.start = points, start
        self.edges = np.full((len(points), EDGES), -1, dtype=np.int32) if edges is None else edges

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, distances) of the `beam` nearest nodes met, nearest first; -1 where there are fewer."""
        size = len(queries)
        nodes = np.full((size, beam), -1, dtype=np.int32)
        far = np.full((size, beam), np.inf, dtype=np.float32)
        opened = np.zeros((size, beam), dtype=bool)
        seen = np.zeros((size, len(self.points)), dtype=bool)
        nodes[:, 0], far[:, 0], seen[:, self.start] = self.start, 1 - queries @ self.points[self.start], True
        active = np.arange(size)
        while len(active):
            waiting = (nodes[active] >= 0) & ~opened[active]
            active = active[waiting.any(axis=1)]
            if not len(active):
                break
            at = (nodes[active] >= 0) & ~opened[active]
            at = at.argmax(axis=1)
            opened[active, at] = True
            near = self.edges[nodes[active, at]]
            new = (near >= 0) & ~seen[active[:, None], near]
            row, _ = np.nonzero(new)
            seen[active[row], near[new]] = True
            distance = np.full(near.shape, np.inf, dtype=np.float32)
            distance[new] = 1 - np.einsum("ij,ij->i", self.points[near[new]], queries[active[row]])
            all_far = np.concatenate([far[active], distance], axis=1)
            order = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
            far[active] = np.take_along_axis(all_far, order, axis=1)
            all_nodes = np.concatenate([nodes[active], np.where(new, near, -1)], axis=1)
            nodes[active] = np.take_along_axis(all_nodes, order, axis=1)
            all_opened = np.concatenate([opened[active], np.zeros(near.shape, dtype=bool)], axis=1)
            opened[active] = np.take_along_axis(all_opened, order, axis=1)
        return nodes, far

    def prune(self, own: np.ndarray, pool: np.ndarray) -> np.ndarray:
        """EDGES neighbours of each node in `own` from its row of `pool` (-1: free, repeats allowed)."""
        pool = np.where(pool == own[:, None], -1, pool)
        vectors = self.points[pool]
        far = 1 - np.einsum("ijk,ik->ij", vectors, self.points[own])
        far[pool < 0] = np.inf
        order = np.argsort(far, axis=1, kind="stable")
        pool, far = np.take_along_axis(pool, order, axis=1), np.take_along_axis(far, order, axis=1)
        vectors = self.points[pool]
        between = 1 - vectors @ vectors.transpose(0, 2, 1)
        alive = np.isfinite(far)
        kept = np.full((len(own), EDGES), -1, dtype=np.int32)
        rows = np.arange(len(own))
        # Squared distances of unit vectors are twice these, so the factor is squared as well.
        relaxed = ALPHA * ALPHA
        for k in range(EDGES):
            some = alive.any(axis=1)
            if not some.any():
                break
            pick = alive.argmax(axis=1)
            kept[some, k] = pool[rows[some], pick[some]]
            covered = relaxed * between[rows, pick] <= far
            covered |= pool == pool[rows, pick][:, None]
            alive &= ~covered
        return kept

    def link(self, own: np.ndarray, kept: np.ndarray) -> None:
        """Set the edges of `own`, and give their ends edges back, pruning those that are full."""
        self.edges[own] = kept
        source, target = np.repeat(own, EDGES), kept.ravel()
        source, target = source[target >= 0], target[target >= 0]
        if not len(target):
            return
        far = 1 - np.einsum("ij,ij->i", self.points[source], self.points[target])
        order = np.lexsort((far, target))
        source, target = source[order].astype(np.int32), target[order]
        first = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]]))
        place = np.arange(len(target)) - np.repeat(first, np.diff(np.append(first, len(target))))
        ends = target[first]
        incoming = np.full((len(ends), EDGES), -1, dtype=np.int32)
        near = place < EDGES
        incoming[np.searchsorted(ends, target[near]), place[near]] = source[near]
        for begin in range(0, len(ends), BATCH):
            part = slice(begin, begin + BATCH)
            pool = np.concatenate([self.edges[ends[part]], incoming[part]], axis=1)
            known = (self.edges[ends[part]][:, :, None] == incoming[part][:, None, :]).any(axis=1)
            pool[:, EDGES:][known] = -1
            pool = np.take_along_axis(pool, np.argsort(pool < 0, axis=1, kind="stable"), axis=1)
            full = (pool >= 0).sum(axis=1) > EDGES
            self.edges[ends[part][~full]] = pool[~full, :EDGES]
            if full.any():
                self.edges[ends[part][full]] = self.prune(ends[part][full], pool[full])


def build(points: np.ndarray) -> Graph:
    """The graph over unit vectors, the same at every run."""
    order = np.random.default_rng(7).permutation(len(points))
    centre = points.mean(axis=0)
    graph = Graph(points, start=int(np.argmax(points @ centre)))
    order = np.concatenate([[graph.start], order[order != graph.start]]).astype(np.int64)
    done = min(len(order), EDGES)
    first = order[:done]
    graph.link(first, graph.prune(first, np.tile(first.astype(np.int32), (done, 1))))
    while done < len(order):
        batch = order[done : done + min(BATCH, done)]
        graph.link(batch, graph.prune(batch, graph.search(points[batch], BUILD_BEAM)[0]))
        done += len(batch)
    for begin in range(0, len(order), BATCH):
        batch = order[begin : begin + BATCH]
        pool = np.concatenate([graph.search(points[batch], BUILD_BEAM)[0], graph.edges[batch]], axis=1)
        graph.link(batch, graph.prune(batch, pool))
    return graph


_SHARD = pa.schema(
    [("dim", pa.int32()), ("shard", pa.int64()), ("start", pa.int32()), ("nodes", pa.binary())]
    + [("least", pa.binary()), ("vectors", pa.binary()), ("edges", pa.binary())]
)


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def build_index(nodes: DataFrame) -> DataFrame:
    """One row per shard of `nodes` (node, dim, least, vector): its vectors and graph, packed.

    Shards hold vectors of one length. A shard has about SHARD_NODES nodes, whatever the table has.
    """

    def make(table: pa.Table) -> pa.Table:
        dim = table["dim"][0].as_py()
        table = table.sort_by("node")
        vectors = _matrix(table["vector"], dim)
        graph = build(unit(vectors))
        row = {
            "dim": dim,
            "shard": table["shard"][0].as_py(),
            "start": graph.start,
            "nodes": table["node"].to_numpy().astype("<i8").tobytes(),
            "least": table["least"].to_numpy().astype("<i8").tobytes(),
            "vectors": vectors.astype("<f8").tobytes(),
            "edges": graph.edges.astype("<i4").tobytes(),
        }
        return pa.Table.from_pylist([row], schema=_SHARD)

    sizes = nodes.groupBy("dim").agg(F.count("*").alias("n"))
    total = sizes.agg(F.coalesce(F.sum(F.ceil(F.col("n") / SHARD_NODES)), F.lit(1))).first()[0]
    dealt = nodes.join(sizes, "dim").select(
        "*", F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / SHARD_NODES)).alias("shard")
    )
    # A count of partitions of its own: by bytes, Spark would put many shards into one task.
    dealt = dealt.drop("n").repartition(4 * int(total), "dim", "shard")
    kind = "dim int, shard bigint, start int, nodes binary, least binary, vectors binary, edges binary"
    return dealt.groupBy("dim", "shard").applyInArrow(make, kind)


def search_index(index: DataFrame, queries: DataFrame, keep: int) -> DataFrame:
    """query, node, score: the `keep` best nodes of every shard for each query (query, dim, vector)."""
    spark = index.sparkSession
    sizes = queries.groupBy("dim").agg(F.count("*").alias("n"))
    blocks = sizes.agg(F.coalesce(F.sum(F.col("dim") * F.col("n") * 8), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(blocks / QUERY_BYTES))
    found = []
    for block in range(blocks):
        own = queries.filter(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block).toArrow()
        by_dim = {}
        for dim in own["dim"].unique().to_pylist():
            part = own.filter(pa.compute.equal(own["dim"], dim))
            by_dim[dim] = (part["query"].to_numpy(), _matrix(part["vector"], dim).astype(np.float64))
        shared = spark.sparkContext.broadcast(by_dim)
        found.append(stored(_search_block(index, shared, keep), "shard-best"))
        shared.destroy()
    return reduce(DataFrame.union, found)


def _search_block(index: DataFrame, queries, keep: int) -> DataFrame:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                shard = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
                if shard["dim"] in queries.value:
                    yield from best_of_shard(shard, *queries.value[shard["dim"]], keep)

    return index.mapInArrow(make, "query bigint, node bigint, score double")


def best_of_shard(shard: dict, ids: np.ndarray, queries: np.ndarray, keep: int) -> Iterator[pa.RecordBatch]:
    """The best nodes of a packed shard by exact cosine, ties to the node with the least id."""
    nodes = np.frombuffer(shard["nodes"], dtype="<i8")
    least = np.frombuffer(shard["least"], dtype="<i8")
    vectors = scaled(np.frombuffer(shard["vectors"], dtype="<f8").reshape(len(nodes), -1))
    norms = np.linalg.norm(vectors, axis=1)
    edges = np.frombuffer(shard["edges"], dtype="<i4").reshape(len(nodes), EDGES)
    graph = Graph((vectors / norms[:, None]).astype(np.float32), edges, shard["start"])
    for begin in range(0, len(ids), BATCH):
        part = scaled(queries[begin : begin + BATCH])
        length = np.linalg.norm(part, axis=1)
        met, _ = graph.search((part / length[:, None]).astype(np.float32), SEARCH_BEAM)
        score = np.einsum("ijk,ik->ij", vectors[met], part) / (norms[met] * length[:, None])
        score[met < 0] = -np.inf
        order = np.lexsort((least[met], -score), axis=1)[:, :keep]
        score, met = np.take_along_axis(score, order, axis=1), np.take_along_axis(met, order, axis=1)
        row, column = np.nonzero(met >= 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[begin + row]), pa.array(nodes[met[row, column]]), pa.array(score[row, column])],
            names=["query", "node", "score"],
        )


def nearest(df: DataFrame, is_query: Column, keep: int = 5, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the `keep` nearest rows found for each query row.

    Every usable row but the query's own is a candidate, rows that repeat an id or a vector too. Nearest
    first by cosine, ties to the smaller id. Vectors that are null, empty, zero or hold null or
    non-finite components take no part, neither do rows without an id; vectors meet only those of their
    length. Rows with fewer candidates get fewer answers. Writes tables to scratch and runs jobs.
    """
    given = df.select(F.col(id_column).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector"), is_query.alias("asked"))
    rows = given.filter(F.col("id").isNotNull() & usable("vector"))
    rows = stored(rows.select(F.monotonically_increasing_id().alias("row"), "*"), "vectors")
    # The rows that can be an answer for their vector: one more than asked for, as a row is no answer to itself.
    first = W.partitionBy("vector").orderBy("id", "row")
    few = rows.select("row", "id", "vector").withColumn("place", F.row_number().over(first)).filter(F.col("place") <= keep + 1)
    nodes = few.groupBy("vector").agg(
        F.min("id").alias("least"), F.collect_list(F.struct("id", "row")).alias("members")
    )
    nodes = stored(
        nodes.select(F.monotonically_increasing_id().alias("node"), F.size("vector").alias("dim"), "*"), "nodes"
    )
    index = stored(build_index(nodes.select("node", "dim", "least", "vector")), "graph")
    asked = rows.filter("asked").select("row", "id", "vector").join(nodes.select("node", "dim", "vector"), "vector")
    asked = stored(asked.select("row", "id", "node"), "queries")
    wanted = nodes.join(asked.select("node").distinct(), "node", "left_semi")
    met = search_index(index, wanted.select(F.col("node").alias("query"), "dim", "vector"), keep + 1)
    answers = nodes.select("node", "least", "members")
    of_query = W.partitionBy("query").orderBy(F.col("score").desc(), "least")
    best = met.join(answers, "node").withColumn("place", F.row_number().over(of_query)).filter(F.col("place") <= keep + 1)
    best = best.select("query", "score", F.inline("members")).select(
        F.col("query").alias("node"), "score", F.col("id").alias("found_id"), F.col("row").alias("found")
    )
    pairs = asked.join(best, "node").filter("row <> found")
    of_row = W.partitionBy("row").orderBy(F.col("score").desc(), "found_id", "found")
    ranked = pairs.withColumn("rank", F.row_number().over(of_row)).filter(F.col("rank") <= keep)
    return ranked.select(F.col("id").alias("query_id"), "rank", F.col("found_id").alias("vec_id"), "score")
