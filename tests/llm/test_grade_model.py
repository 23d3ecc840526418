import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm.brute import ODD_TEXTS
from tests.llm.test_quality_rules import texts
from waybill.llm import grade_model, hashing
from waybill.llm.common import sample_texts


def graded(count, seed):
    """Grade 0 for junk, 1 for prose with an insult, 2 for other prose."""
    random = np.random.default_rng(seed)
    out, good = texts(count, seed)
    grades = np.where(good, 2, 0).astype(np.int32)
    for i in np.flatnonzero(good)[::3]:
        out[i] += " you " + random.choice(["blockhead", "blockheads", "dunce", "duncely"])
        grades[i] = 1
    return out, grades


def reaches(model, rows):
    return np.concatenate([model.reaches(run) for _, run in hashing.runs(pa.array(rows), True, False)])


def test_held_out_grades():
    rows, grades = graded(1200, 1)
    model = grade_model.train(pa.array(rows), grades)
    assert (np.diff(model.thresholds) > 0).all()
    new, truth = graded(400, 2)
    found = reaches(model, new)
    assert (found[:, 0] >= found[:, 1]).all()
    selected = found[:, 1] >= grade_model.SELECT_FROM
    assert selected[truth == 2].mean() > 0.98 and selected[truth < 2].mean() < 0.1
    expected = found.sum(axis=1)
    assert expected[truth == 0].mean() < expected[truth == 1].mean() < expected[truth == 2].mean()
    # One telling word counts in a long text as well.
    long = [" ".join(new[i] for i in np.flatnonzero(truth == 2)[:80]) + end for end in ("", " you blockhead")]
    found = reaches(model, long)[:, 1]
    assert found[0] >= 0.5 > found[1]


def test_gradient():
    """The search ends where nearby points are no better."""
    best = grade_model.minimize(lambda x: (((x - 3) ** 2 * [1, 50]).sum(), 2 * (x - 3) * [1, 50]), np.zeros(2), 60)
    assert np.allclose(best, 3, atol=1e-2)


def test_loss_and_gradient_against_plain_sums():
    """The loss is minus the mean log probability of each row's own grade; its gradient is its slope."""
    random = np.random.default_rng(5)
    top, width, n = 3, 4, 40
    grades = random.integers(0, top + 1, n).astype(np.int32)
    text, at = (m.ravel() for m in np.meshgrid(np.arange(n), np.arange(width), indexing="ij"))
    keep = random.random(len(text)) < 0.6
    text, at, value = text[keep], at[keep], random.normal(size=keep.sum())
    loss = grade_model.likelihood(grades, top, (text, at, value), width)

    def plain(x):
        first, gaps = x[width], x[width + 1 :]
        thresholds = [first + sum(math.exp(g) for g in gaps[:k]) for k in range(top)]
        total = 0.0
        for row, grade in enumerate(grades):
            score = sum(x[a] * v for t, a, v in zip(text, at, value, strict=True) if t == row)
            below = [0.0, *(1 / (1 + math.exp(score - t)) for t in thresholds), 1.0]
            total -= math.log(below[grade + 1] - below[grade])
        return total / n + grade_model.PENALTY / n / 2 * sum(w * w for w in x[:width])

    for _ in range(3):
        x = random.normal(size=width + top)
        got, gradient = loss(x)
        assert math.isclose(got, plain(x), rel_tol=1e-9)
        for k in range(len(x)):
            step = np.zeros(len(x))
            step[k] = 1e-6
            assert math.isclose(gradient[k], (plain(x + step) - plain(x - step)) / 2e-6, rel_tol=1e-4, abs_tol=1e-7)


def test_scores_against_plain_sums():
    rows, grades = graded(300, 4)
    model = grade_model.train(pa.array(rows), grades)
    weight = dict(zip(model.slots.tolist(), model.weights.tolist(), strict=True))
    for row, got in zip(rows[:40], reaches(model, rows[:40]), strict=True):
        (_, run), = hashing.runs(pa.array([row]), True, False)
        _, slot, value = grade_model.features(run)
        score = sum(weight.get(s, 0.0) * v for s, v in zip(slot.tolist(), value.tolist(), strict=True))
        assert np.allclose(got, [1 / (1 + math.exp(t - score)) for t in model.thresholds], atol=1e-4)


def test_one_grade():
    rows = ["a b", "c", ""]
    for grade, selected in ((0, False), (2, True)):
        model = grade_model.train(pa.array(rows), np.full(3, grade, dtype=np.int32))
        assert ((reaches(model, rows)[:, 1] >= 0.5) == selected).all()


def test_score_and_select(spark):
    rows, grades = graded(300, 3)
    documents = [(i, text, "s") for i, text in enumerate([*rows, *ODD_TEXTS])] + [(0, rows[0], "s"), (None, None, None)]
    docs = spark.createDataFrame(documents, "doc_id long, text string, Expected_Grade string")
    docs = docs.withColumn("select_probability", F.lit(7))
    labels = spark.createDataFrame(
        [(i, int(g > 0), int(g == 1)) for i, g in enumerate(grades)] + [(5, None, 1), (900, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    rated = grade_model.grades(labels)
    assert rated.filter("doc_id = 5").count() == 1
    model = grade_model.fit(docs, rated)
    scored, expected, tail = grade_model.score(docs, model)
    assert (expected, tail) == ("expected_grade_", "select_probability_") and scored.count() == len(documents)
    chosen = grade_model.select(docs, model)
    assert chosen.columns == docs.columns
    kept = {r.doc_id for r in chosen.collect()}
    assert np.mean([i in kept for i in np.flatnonzero(grades == 2)]) > 0.95
    assert np.mean([i in kept for i in np.flatnonzero(grades == 0)]) < 0.05
    again = grade_model.fit(docs.orderBy(F.rand(1)), rated)
    assert np.allclose(again.weights, model.weights)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    rated = spark.createDataFrame([], "doc_id long, grade int")
    model = grade_model.fit(docs, rated)
    assert grade_model.select(docs, model).count() == 1 and grade_model.select(docs.limit(0), model).count() == 0


def test_one_row_of_an_id_with_many(spark):
    """An id of 10,000 rows, rated twice, is one training row; and no text above the bound is fitted on."""
    docs = spark.range(10_000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("t "), "id").alias("text"))
    long = "w " * grade_model.TRAINING_TEXT_BYTES
    rest = spark.createDataFrame([(2, "b"), (2, "b"), (3, None), (4, long), (5, long), (5, "five")], "doc_id long, text string")
    docs = docs.union(rest)
    rated = spark.createDataFrame([(i, g) for i in range(1, 7) for g in (2, i % 2)], "doc_id long, grade int")
    lowest = rated.groupBy("doc_id").agg(F.min("grade").alias("grade"))
    rows = sample_texts(docs.repartition(7), lowest, grade_model.TRAINING_TEXT_BYTES).collect()
    assert sorted((r.doc_id, r.grade) for r in rows) == [(1, 1), (2, 0), (3, 1), (5, 1)]
    found = {r.doc_id: r.text for r in rows}
    assert (found[2], found[3], found[5]) == ("b", None, "five")
    again = sample_texts(docs.repartition(3), lowest, grade_model.TRAINING_TEXT_BYTES).collect()
    assert {r.doc_id: r.text for r in again} == found
    model = grade_model.fit(docs, rated)
    assert len(model.thresholds) == len(grade_model.fit(docs.distinct(), rated).thresholds)
    assert np.allclose(model.weights, grade_model.fit(docs.distinct(), rated).weights)
