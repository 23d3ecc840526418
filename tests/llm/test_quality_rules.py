import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import ODD_TEXTS, rule_counts
from waybill.llm import hashing, quality_rules
from waybill.llm.quality_rules import Model


def texts(count, seed):
    """Good prose and two kinds of junk, with labels."""
    random = np.random.default_rng(seed)
    plain = ["and", "the", "river", "stone", "walks", "under", "bridge", "evening", "slowly", "paper"]
    out, good = [], []
    for i in range(count):
        words = [plain[k] + str(random.integers(30)) for k in random.integers(0, len(plain), 40)]
        good.append(i % 4 != 0)
        if not good[-1]:
            words = [w.upper() + "!!" if i % 8 else w + "$$$" for w in words]
        out.append(" ".join(words))
    return out, np.array(good)


@pytest.mark.parametrize("run_bytes", [1 << 20, 40])
def test_counts_against_brute_force(monkeypatch, run_bytes):
    monkeypatch.setattr(hashing, "RUN_BYTES", run_bytes)
    random = np.random.default_rng(1)
    alphabet = ["a", "bb", " ", "\n", "\t", "é", "$", "*", "x y", " 漢 ", "\x0b", "\x1c", "Z"]
    mixed = ["".join(random.choice(alphabet, random.integers(0, 120))) for _ in range(200)] + ODD_TEXTS
    got = []
    for _, run in hashing.runs(pa.array(mixed), lowered=True, blank_words=True):
        got += zip(*(column.tolist() for column in quality_rules._counts(run).values()), strict=True)
    assert got == [rule_counts(text) for text in mixed]


@pytest.mark.parametrize("lowered", [True, False])
def test_counts_tell_case_apart(lowered):
    random = np.random.default_rng(7)
    alphabet = ["a", "A", "z", "Z", "é", " ", " ", "\n"]
    mixed = ["".join(random.choice(alphabet, random.integers(0, 200))) for _ in range(200)]
    mixed += ["one two three four five ONE TWO THREE FOUR FIVE", "One two three four five " * 2]
    got = []
    for _, run in hashing.runs(pa.array(mixed), lowered=lowered, blank_words=True):
        got += zip(*(column.tolist() for column in quality_rules._counts(run).values()), strict=True)
    assert got == [rule_counts(text) for text in mixed]


def test_held_out_accuracy_and_calibration():
    known, good = texts(400, 1)
    model = quality_rules.train(pa.array(known), good, np.arange(400) % 5 == 0)
    new, truth = texts(200, 2)
    found = np.concatenate([model.probability(run) for _, run in hashing.runs(pa.array(new), True, True)])
    assert ((found >= quality_rules.KEEP_FROM) == truth).mean() > 0.97
    slope, shift = quality_rules.platt(np.array([-2.0, -1, 1, 2] * 50), np.array([0.0, 0, 1, 1] * 50))
    assert slope > 0 and abs(shift) < 0.1


def test_one_class_and_no_labels():
    rows = pa.array(["a b", "c"])
    for good, keeps in (([True, True], True), ([False, False], False)):
        model = quality_rules.train(rows, np.array(good), np.array([False, False]))
        run = next(hashing.runs(rows, True, True))[1]
        assert ((model.probability(run) >= 0.5) == keeps).all()


def test_judge(spark):
    rows = [*enumerate(ODD_TEXTS), (1, "repeated id"), (None, "no id"), (50, "word " * 60000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"kept": F.lit(1), "n_words": F.lit(2)})
    labels = spark.createDataFrame([(1, 1), (2, None), (3, 0)], "doc_id long, quality int")
    got = quality_rules.judge(docs, quality_rules.fit(docs, labels)).collect()
    counts = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got)
    assert counts == sorted((str(i), *rule_counts(text)) for i, text in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and r.quality >= quality_rules.KEEP_FROM)
    none = quality_rules.fit(docs, labels.limit(0))
    assert isinstance(none, Model)
    assert quality_rules.judge(docs.limit(0), none).count() == 0
