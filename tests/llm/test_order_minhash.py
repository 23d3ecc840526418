import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm.brute import ODD_TEXTS, labelled_shingles, near_classes
from waybill.llm import hashing, order_minhash


def prose(random, count):
    return [f"w{i}" for i in random.integers(0, 3000, count)]


def corpus():
    """Texts with exact copies, near copies of a few edits, shared passages and moved halves."""
    random = np.random.default_rng(4)
    texts, passage = list(ODD_TEXTS), prose(random, 60)
    for _ in range(25):
        base = prose(random, int(random.integers(30, 300)))
        texts.append(" ".join(base))
        for edits in (0, 1, 2, 4, 9):
            copy = list(base)
            for at in random.integers(0, len(copy), edits):
                copy[at] = "edited" + str(random.integers(1000))
            texts.append(" ".join(copy).upper() if edits == 0 else " ".join(copy))
        texts.append(" ".join(passage + prose(random, 80)))
    hub = prose(random, 150)
    for i in range(80):
        copy = list(hub)
        for at in random.integers(0, 150, i % 6):
            copy[at] = "hub" + str(random.integers(500))
        texts.append(" ".join(copy) + "!" * (i % 3))
    halves = prose(random, 400)
    texts += [" ".join(halves), " ".join(halves[200:] + halves[:200])]
    return dict(enumerate(texts))


def test_shingles_against_brute_force():
    texts = list(corpus().values())
    for row, run in hashing.runs(pa.array(texts), lowered=True, blank_words=False):
        shingles, of = order_minhash.labelled_shingles(run)
        for k in range(run.texts):
            assert len(np.unique(shingles[of == k])) == len(labelled_shingles(texts[row + k]))


def test_classes_against_all_pairs(spark):
    texts = corpus()
    moved = max(texts)
    rows = [*texts.items(), (3, texts[3]), (None, texts[30])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"rep": F.lit(1), "digest": F.lit("d")})
    got = order_minhash.classes(docs.repartition(5)).collect()
    assert len(got) == len(rows)
    found = {r.doc_id: r.class_id for r in got if r.doc_id is not None}
    want = near_classes(texts)
    want[moved] = moved  # the same shingles in another order are no near copy
    assert found == want
    kept = order_minhash.dedupe(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["None", *map(str, set(want.values()))])


def versions(count, edits, length, seed):
    """Versions of a text that is not among them: each makes some of a few edits, so that every shingle
    is in many versions and a link is a difference of three edits at most."""
    random = np.random.default_rng(seed)
    base, made = prose(random, length), set()
    while len(made) < count:
        made.add(tuple(random.integers(0, 2, edits).tolist()))
    out = []
    for bits in sorted(made):
        copy = list(base)
        for edit, bit in enumerate(bits):
            if bit:
                copy[5 + edit * (length // edits)] = f"edit{edit}"
        out.append(" ".join(copy))
    return dict(enumerate(random.permutation(out).tolist()))


def test_versions_without_central_text(spark):
    texts = versions(400, 15, 180, 3)
    docs = spark.createDataFrame([*texts.items()], "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in order_minhash.classes(docs.repartition(5)).collect()}
    assert found == near_classes(texts)


def test_alignment():
    a = np.arange(100)
    jaccard, aligned = order_minhash.similarity(a, np.concatenate([a[50:], a[:50]]))
    assert jaccard == 1.0 and aligned < 0.8
    assert order_minhash.similarity(a, np.delete(a, [3, 70])) > (0.8, 0.8)
    assert order_minhash.longest_increasing(np.array([5, 1, 2, 9, 3, 4])).tolist() == [1, 2, 4, 5]


def test_components_of_long_chains(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 200), (50, 100)]
    edges = spark.createDataFrame(chain, "a long, b long")
    found = {r.node: r.label for r in order_minhash.components(edges).collect()}
    assert found == {**{i: 0 for i in range(41)}, 50: 50, 100: 50, 200: 50}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert order_minhash.classes(docs).count() == 0 and order_minhash.dedupe(docs).count() == 0


def test_an_id_with_two_texts_ties_no_classes(spark):
    random = np.random.default_rng(9)
    a, b = (prose(random, 100) for _ in range(2))
    near = lambda words: " ".join([*words[:-1], "changed"])
    rows = [(1, near(a)), (2, near(b)), (3, " ".join(a)), (3, " ".join(b)), (3, " ".join(b)), (4, ""), (4, " "), (None, near(a))]
    docs = spark.createDataFrame([(*row, 1) for row in rows], "doc_id long, text string, text_key int")
    got = sorted((tuple(r) for r in order_minhash.classes(docs).collect()), key=str)
    assert got == sorted([(1, 1), (2, 2), (3, 1), (3, 2), (3, 2), (4, 4), (4, 4), (None, 1)], key=str)
    kept = [r.text for r in order_minhash.dedupe(docs).collect()]
    assert sorted(t for t in kept if t.strip()) == sorted([near(a), near(b), near(a)]) and len(kept) == 4


def test_repeated_rows_without_near_ones_stay_once(spark):
    random = np.random.default_rng(10)
    texts = [" ".join(prose(random, 40)) for _ in range(3)]
    docs = spark.createDataFrame([(5, texts[0])] * 50 + [(6, texts[1]), (6, texts[2])], "doc_id long, text string")
    assert sorted(tuple(r) for r in order_minhash.dedupe(docs).collect()) == sorted([(5, texts[0]), (6, texts[1]), (6, texts[2])])


def test_very_long_texts(spark):
    random = np.random.default_rng(11)
    long = prose(random, 120_000)
    other = [w if k % 100 else "edit" for k, w in enumerate(long)]
    rows = [(1, " ".join(long)), (2, " ".join(other)), (3, " ".join(prose(random, 120_000)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, order_minhash.classes(docs).collect())) == [(1, 1), (2, 1), (3, 3)]
