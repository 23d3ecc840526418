"""Approximate nearest neighbours against all distances."""

import math

import numpy as np
from pyspark.sql import functions as F

from waybill.llm import graph_index as index

KIND = "vec_id bigint, embedding array<float>, node int, score string"


def exact(rows, asked, keep=5):
    """(query_id, rank, vec_id, score) rows for (id, vector) rows, by all distances."""
    good = [
        (i, np.array(v, dtype=np.float32).astype(np.float64))
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    out = []
    for k, (i, v) in enumerate(good):
        if not asked(i):
            continue
        others = [(o, w) for j, (o, w) in enumerate(good) if j != k and len(w) == len(v)]
        scored = sorted((-(v @ w) / (np.linalg.norm(v) * np.linalg.norm(w)), o) for o, w in others)
        out += [(i, rank, o, -s) for rank, (s, o) in enumerate(scored[:keep], 1)]
    return out


def found(frame):
    assert frame.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    return sorted((tuple(row) for row in frame.collect()), key=lambda row: (row[0], row[1], row[2]))


def frame_of(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], KIND)


def same(got, want):
    want = sorted(want, key=lambda row: (row[0], row[1], row[2]))
    assert [row[:3] for row in got] == [row[:3] for row in want]
    assert np.allclose([row[3] for row in got], [row[3] for row in want], rtol=0, atol=1e-12)


def test_small_tables_are_answered_exactly(spark):
    draw = np.random.default_rng(4)
    rows = [(k, draw.normal(size=8).astype(np.float32).tolist()) for k in range(300)]
    rows += [(1000 + k, rows[10][1]) for k in range(40)]  # copies of one vector
    rows += [(k, rows[20][1]) for k in (20, 20, 21)]  # repeated rows and ids
    rows += [(500, None), (501, []), (502, [0.0] * 8), (503, [1.0, None] * 4), (504, [float("nan")] * 8)]
    rows += [(505, [float("inf")] + [0.0] * 7), (None, [1.0] * 8), (550, [1.0, 2.0]), (551, [2.0, 1.0])]
    asked = lambda i: i % 10 == 0
    got = found(index.nearest(frame_of(spark, rows), F.col("vec_id") % 10 == 0))
    same(got, exact(rows, asked))


def test_tables_without_answers(spark):
    query = F.col("vec_id") % 50 == 0
    for rows in ([], [(1, [1.0, 2.0])], [(50, [1.0, 2.0])], [(50, None), (7, [1.0])], [(50, [0.0]), (7, [1.0])]):
        assert found(index.nearest(frame_of(spark, rows), query)) == []
    assert found(index.nearest(frame_of(spark, [(50, [1.0, 0.0]), (7, [0.0, 2.0])]), query)) == [(50, 1, 7, 0.0)]


def test_recall_over_several_shards(spark, monkeypatch):
    monkeypatch.setattr(index, "SHARD_NODES", 700)
    monkeypatch.setattr(index, "QUERY_BYTES", 8 * 32 * 16)
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(40, 32))
    points = (centres[draw.integers(0, 40, 2500)] + 0.7 * draw.normal(size=(2500, 32))).astype(np.float32)
    points[1000:1800] = points[3]  # a third of the rows are one vector
    rows = [(k, v) for k, v in enumerate(points.tolist())]
    got = found(index.nearest(frame_of(spark, rows), F.col("vec_id") % 50 == 0))
    want = exact(rows, lambda i: i % 50 == 0)
    assert len(got) == len(want) == 250
    hits = {(q, v) for q, _, v, _ in got} & {(q, v) for q, _, v, _ in want}
    assert len(hits) >= 0.98 * len(want)
    assert [row[:2] for row in got] == [row[:2] for row in sorted(want)]


def test_extreme_lengths_do_not_change_the_cosine():
    vectors = np.array([[3e300, 4e300], [3e-300, 4e-300], [1.0, 0.0]])
    scaled = index.scaled(vectors)
    assert np.isfinite(scaled).all() and (np.abs(scaled).max(axis=1) >= 0.5).all()
    assert np.allclose(index.unit(vectors), [[0.6, 0.8], [0.6, 0.8], [1, 0]])


def test_pruned_edges_are_diverse_and_reach_every_node():
    draw = np.random.default_rng(6)
    points = index.unit(draw.normal(size=(900, 16)))
    graph = index.build(points)
    for own in range(0, 900, 90):
        edges = graph.edges[own][graph.edges[own] >= 0]
        assert own not in edges and len(set(edges.tolist())) == len(edges)
    seen, front = {graph.start}, [graph.start]
    while front:
        front = [int(x) for node in front for x in graph.edges[node] if x >= 0 and int(x) not in seen and not seen.add(int(x))]
    assert len(seen) == 900
    nodes, far = graph.search(points[:50], 20)
    assert (nodes[:, 0] == np.arange(50)).mean() > 0.95
    assert (np.diff(far, axis=1) >= 0).all()
