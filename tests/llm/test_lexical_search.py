"""Ranked lexical search against a plain version; exactness of the tiles."""

import random

import numpy as np
import pyarrow as pa

from tests.llm.brute import ODD_TEXTS, lexical_ranking
from waybill.llm import lexical_search as search

KIND = "doc_id bigint, text string, item_id string, score double"


def docs_of(spark, rows):
    return spark.createDataFrame([(*row, "x", 0.5) for row in rows], KIND)


def items_of(spark, rows):
    return spark.createDataFrame([(*row, 3) for row in rows], "item_id bigint, text string, doc_id int")


def found(frame):
    assert frame.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    return sorted((tuple(row) for row in frame.collect()), key=repr)


def made(seed, docs=150, items=12):
    draw = random.Random(seed)
    words = [f"{c}{k}" for c in "abcé" for k in range(30)] + ["THE", "the", "漢字"]
    weights = [1 + 200 // (k + 1) for k in range(len(words))]
    text = lambda n: draw.choice([" ", ". ", "-"]).join(draw.choices(words, weights, k=n))
    rows = [(k, text(draw.choice([0, 1, 3, 30, 200]))) for k in range(docs)]
    return rows, [(k, text(draw.choice([1, 2, 20, 60]))) for k in range(items)]


def test_rankings_match_the_plain_version(spark):
    docs, items = made(1)
    docs += [(3, docs[5][1]), (3, docs[5][1]), (None, docs[5][1]), (None, None)]  # repeated and null ids
    docs += [(1000 + k, text) for k, text in enumerate(ODD_TEXTS)] + [(2000, "a0 " * 60_000)]
    items += [(900, None), (901, ""), (902, "word that nobody has"), (903, docs[5][1]), (None, "a0 漢字 THE")]
    assert found(search.search(docs_of(spark, docs), items_of(spark, items))) == sorted(lexical_ranking(docs, items), key=repr)


def test_many_ties_keep_the_least_ids(spark):
    docs = [(k, "same words here") for k in range(3000, 0, -1)] + [(-5, "other words")]
    items = [(1, "same"), (2, "words words"), (3, "here same")]
    assert found(search.search(docs_of(spark, docs), items_of(spark, items))) == sorted(lexical_ranking(docs, items), key=repr)


def test_blocks_and_small_tiles_give_the_same(spark, monkeypatch):
    docs, items = made(2)
    expected = sorted(lexical_ranking(docs, items, keep=3), key=repr)
    monkeypatch.setattr(search, "ITEM_BLOCK_TERMS", 60)
    monkeypatch.setattr(search, "ITEM_TILE", 2)
    monkeypatch.setattr(search, "VOCABULARY_TILE", 4)
    assert found(search.search(docs_of(spark, docs), items_of(spark, items), keep=3)) == expected


def test_empty_tables(spark):
    docs, items = made(4, 5, 2)
    assert found(search.search(docs_of(spark, []), items_of(spark, items))) == []
    assert found(search.search(docs_of(spark, docs), items_of(spark, []))) == []
    assert found(search.search(docs_of(spark, [(1, None)]), items_of(spark, [(1, None)]))) == []


def test_tiles_stay_exact_and_hold_all_weights():
    most = (search.EXACT - 1) // search.LARGEST_IMPACT
    rows, terms = np.array([0, 0, 1, 0, 1]), np.array([5, 2, 2, 9, 5])
    weights = np.array([most - 1, 7, 3, 5 * most + 11, 1])
    made_tiles = search.tiles(rows, terms, weights)
    total = {}
    for tile in made_tiles:
        dense = tile.matrix(2)
        assert (dense.sum(axis=1) <= most).all()
        for row, column in zip(*np.nonzero(dense), strict=True):
            key = int(row), int(tile.terms[column])
            total[key] = total.get(key, 0) + int(dense[row, column])
    assert total == dict(zip(zip(rows.tolist(), terms.tolist(), strict=True), weights.tolist(), strict=True))


def test_scores_beyond_the_exact_range_of_doubles():
    weights = np.array([20 * search.EXACT // search.LARGEST_IMPACT + 1, 1])
    plan = search.Search([], 2, 1, 1)
    parts = search.tiles(np.array([0, 0]), np.array([0, 1]), weights)
    impact = np.array([999_999.0, 1.0])
    out = plan.scores(1, parts, np.array([0, 1]), np.array([0, 0]), impact, 1)
    assert int(out[0, 0]) == int(weights[0]) * 999_999 + 1


def test_terms_are_compared_by_their_bytes():
    vocabulary = search.Vocabulary(["alpha", "be", "é"])
    vocabulary.hashes = np.sort(vocabulary.hashes)
    for _, run in search.runs(pa.array(["alpha BE é alphx", None, "é"]), lowered=True, blank_words=False):
        at, term = vocabulary.places(run)
        assert [vocabulary.terms[k] for k in term] == ["alpha", "be", "é", "é"]
        assert at.tolist() == [0, 1, 2, 4]
        # A term of equal hash and length but other bytes is no match.
        vocabulary.data = vocabulary.data.copy()
        vocabulary.data[vocabulary.starts[term[1]]] += 1
        assert [vocabulary.terms[k] for k in vocabulary.places(run)[1]] == ["alpha", "é", "é"]
