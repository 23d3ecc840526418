import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import blank_words
from waybill.llm import mixing


def levelled(sizes):
    """Targets by resharing the excess by weight until none is above: the contract's own procedure."""
    total, order = sum(sizes.values()), sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full, target = set(), {}
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        share = sum(weight[s] for s in order if s not in full)
        target = {s: 3 * sizes[s] if s in full else left * weight[s] / share for s in order}
        above = {s for s in order if s not in full and target[s] > 3 * sizes[s]}
        if not above:
            return target
        full |= above


def test_fit_against_all_subsets():
    random = np.random.default_rng(5)
    for _ in range(60):
        lengths = np.sort(random.choice(np.arange(1, 40), 4, replace=False))
        free = random.integers(0, 3, 4)
        budget = int(random.integers(0, 90))
        taken = mixing.fit(lengths, free, budget)
        assert ((0 <= taken) & (taken <= free)).all()
        sums = [sum(c * n for c, n in zip(cs, lengths)) for cs in itertools.product(*(range(f + 1) for f in free))]
        reachable = [s for s in sums if s <= 2 * budget] or [0]
        assert abs((taken * lengths).sum() - budget) == min(abs(s - budget) for s in reachable)


def test_quotas_with_large_budget():
    random = np.random.default_rng(6)
    lengths = np.unique(random.integers(0, 30000, 500))
    counts = random.integers(1, 200, len(lengths))
    total = int((lengths * counts).sum())
    for share in (0.0, 0.3, 1.0, 1.7, 3.0):
        passes, more = mixing.quotas(lengths, counts, share * total)
        assert (more <= counts).all() and (more >= 0).all()
        assert abs(passes * total + (lengths * more).sum() - share * total) <= 1
    assert mixing.quotas(np.array([0]), np.array([9]), 0.0)[1].sum() == 0


def test_quotas_of_long_documents():
    assert mixing.quotas(np.array([100_000]), np.array([1]), 90_000.0)[1].tolist() == [1]
    lengths, counts = np.array([100, 10_000_000]), np.array([100, 1])
    assert mixing.quotas(lengths, counts, 9_000_000.0)[1].tolist() == [0, 1]
    random = np.random.default_rng(8)
    for size in (2, 5, 9, 12):
        for _ in range(8):
            lengths = np.sort(random.choice(np.arange(70_000, 900_000), size, replace=False))
            counts, total = np.ones(size, dtype=np.int64), int(lengths.sum())
            sums = np.array([lengths[np.array(c, dtype=bool)].sum() for c in itertools.product((0, 1), repeat=size)])
            target = int(random.integers(1, total))
            _, more = mixing.quotas(lengths, counts, float(target))
            assert ((more >= 0) & (more <= counts)).all()
            cells = -(-target // mixing.KNAPSACK_WORDS)
            assert abs((lengths * more).sum() - target) <= np.abs(sums - target).min() + size * cells
    lengths = np.unique(random.integers(70_000, 300_000, 300))
    target = int(lengths.sum()) // 3
    more = mixing.quotas(lengths, np.ones(len(lengths), dtype=np.int64), float(target))[1]
    assert abs((lengths * more).sum() - target) <= target // mixing.KNAPSACK_WORDS


DOCS = [
    *((i, "w " * (1 + i % 7), "b") for i in range(40)),
    *((100 + i, "é " * (1 + i % 5), "a") for i in range(9)),
    (200, "one two three", None), (201, None, None), (202, "", "empty"), (203, " \n", "empty"),
    *((300, "same row again", "c") for _ in range(5)), (300, "same id", "c"), (None, "no id at all", "c"),
]


@pytest.fixture
def docs(spark):
    frame = spark.createDataFrame(DOCS, "doc_id long, text string, source string")
    return frame.withColumns({"size": F.lit(1), "times": F.lit("t"), "bucket": F.lit(0)})


def test_plan(spark, docs, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKETS", 3)
    rows = mixing.plan(docs).collect()
    assert len(rows) == len(DOCS)
    assert sorted((r.doc_id or -1, r.size) for r in rows) == sorted((i or -1, len(blank_words(t))) for i, t, _ in DOCS)
    sizes = {}
    for _, text, source in DOCS:
        sizes[source] = sizes.get(source, 0) + len(blank_words(text))
    target = levelled(sizes)
    for source in sizes:
        own = [r for r in rows if r.source == source]
        assert {r.source_size for r in own} == {sizes[source]}
        assert own[0].target == pytest.approx(target[source])
        assert all(r.taken % max(r.size, 1) == 0 and r.taken <= 3 * r.size for r in own)
        least = min((r.size for r in own if r.size), default=0)
        assert abs(sum(r.taken for r in own) - target[source]) <= least
    again = mixing.plan(docs.orderBy(F.rand())).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_mix_repeats_documents(docs):
    rows, mixed = mixing.plan(docs).collect(), mixing.mix(docs)
    assert mixed.columns == docs.columns
    want = sorted(str((r.doc_id, r.source)) for r in rows for _ in range(r.copies))
    assert sorted(str((r.doc_id, r.source)) for r in mixed.collect()) == want


def test_clashing_columns(docs):
    names = ("of_doc", "of_source", "text_key", "all_copies", "rows", "times", "copy", "size")
    mixed = mixing.mix(docs.withColumns({n: F.lit("x") for n in names}))
    assert mixed.count() == mixing.mix(docs).count()
    assert set(names) <= set(mixed.columns) and mixed.filter("rows <> 'x' OR times <> 'x' OR text_key <> 'x'").isEmpty()


def test_empty_table(docs):
    assert mixing.plan(docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0)).count() == 0
