"""Each stage of the pipeline against a plain version of its work, on the smallest tables."""

import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.brute import ODD_TEXTS, blank_words, contamination, near_classes
from tests.llm.test_token_output import plain_ids
from waybill.llm import common

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the generated tables")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The documents and the result of each stage, written and read as the pipeline does."""
    folder = tmp_path_factory.mktemp("stages")
    out = [common.table(spark, SF_DIR, "documents")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], SF_DIR).write.parquet(f"{folder}/{k}")
        out.append(spark.read.parquet(f"{folder}/{k}"))
    return out


def test_columns_stay(tables):
    assert all(t.columns == tables[0].columns for t in tables[:-1])
    assert all(t.dtypes == tables[0].dtypes for t in tables[:-1])


def test_quality_keeps_clean_documents(spark, tables):
    labels = common.table(spark, SF_DIR, "labels").collect()
    kept = {r.doc_id for r in tables[1].collect()}
    clean = [r.doc_id in kept for r in labels if r.quality == 1 and r.toxic == 0]
    poor = [r.doc_id in kept for r in labels if r.quality == 0]
    assert np.mean(clean) > 0.95 and np.mean(poor) < 0.3
    assert kept <= {r.doc_id for r in tables[0].collect()}


def test_one_document_of_each_class_stays(tables):
    texts = {r.doc_id: r.text for r in tables[1].collect()}
    assert sorted(r.doc_id for r in tables[2].collect()) == sorted(set(near_classes(texts).values()))


def test_contaminated_documents_go(spark, tables):
    items = [tuple(r) for r in common.table(spark, SF_DIR, "benchmark").select("item_id", "text").collect()]
    judged = {r.doc_id: contamination(r.text, items) for r in tables[2].collect()}
    clean = sorted(i for i, (n, hit, _) in judged.items() if not (hit > 0 and 20 * hit >= n))
    assert 0 < len(clean) < len(judged)
    assert sorted(r.doc_id for r in tables[3].collect()) == clean


def test_sources_meet_their_targets(spark, tables):
    from waybill.llm import mixing

    copies = Counter(r.doc_id for r in tables[4].collect())
    words, goal, taken, sizes = {}, {}, Counter(), {}
    for r in mixing.plan(tables[3]).collect():
        words[r.doc_id], goal[r.source] = r.size, r.target
        taken[r.source] += copies[r.doc_id] * r.size
        sizes.setdefault(r.source, []).append(r.size)
        assert copies[r.doc_id] == r.copies <= 3
    assert sum(goal.values()) == pytest.approx(sum(words.values()))
    for source, own in sizes.items():
        passes, budget = divmod(round(goal[source]), sum(own))
        sums = {0}
        for size in own:
            sums |= {s + size for s in sums}
        best = min(abs(s - budget) for s in sums if s <= 2 * budget)
        assert abs(taken[source] - passes * sum(own) - budget) == best
    assert words == {r.doc_id: len(blank_words(r.text)) for r in tables[3].collect()}


def test_tokens(tables):
    docs = sorted(tables[4].collect(), key=lambda r: r.doc_id)
    want, start = [], 0
    for row, ids in zip(docs, plain_ids([r.text for r in docs]), strict=True):
        ids = np.array([*ids, 2], dtype="<u4")
        want.append((row.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, tables[5].collect())) == want


def test_run(spark, tables):
    before = {p.name for p in Path(common.shared_folder(spark)).iterdir()}
    got = sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect()))
    assert got == sorted(map(tuple, tables[5].collect()))
    left = {p.name.rpartition("-")[0] for p in Path(common.shared_folder(spark)).iterdir() if p.name not in before}
    assert left == {"llm-mixing", "llm-corpus-tokens"}


def _folder(spark, path, docs, labels, benchmark):
    for name, frame in (("documents", docs), ("labels", labels), ("benchmark", benchmark)):
        frame.write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_edge_cases(spark, tmp_path):
    """Nulls in any column, empty and very long texts, repeated rows and clashing column names."""
    docs = [(i, text, "en", "web", 0) for i, text in enumerate(ODD_TEXTS)]
    prose = [" ".join(f"w{(k * 7 + j * j) % 997}" for j in range(60)) for k in range(12)]
    docs += [(100 + k, text, None, None if k % 2 else "book", None) for k, text in enumerate(prose)]
    docs += docs[-3:] + [(None, prose[0], "en", "web", 1), (None, None, None, None, None)]
    docs.append((200, " ".join(f"v{j % 50021}" for j in range(120_000)), "en", "book", 1))
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    frame = frame.withColumns({"size": F.lit("s"), "spans": F.lit(1), "text_key": F.lit(2), "rep": F.lit(3)})
    labels = spark.createDataFrame(
        [(100, 1, 0), (100, 1, 0), (101, 1, 0), (2, 0, 0), (None, 1, 0), (3, None, None)],
        "doc_id long, quality int, toxic int",
    )
    items = spark.createDataFrame([(1, " ".join(prose[5].split()[:30])), (2, None), (None, "")], "item_id long, text string")
    sf_dir = _folder(spark, tmp_path, frame, labels, items)
    out = [common.table(spark, sf_dir, "documents")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], sf_dir).write.parquet(f"{tmp_path}/{k}")
        out.append(spark.read.parquet(f"{tmp_path}/{k}"))
    assert all(t.columns == frame.columns for t in out[:-1])
    # Of the repeated documents one stays, and the one that holds a benchmark passage goes.
    # Rows without an id are never duplicates.
    ids = Counter(r.doc_id for r in out[3].collect())
    assert ids.pop(None, 0) == sum(r.doc_id is None for r in out[1].collect())
    assert all(n == 1 for n in ids.values()) and 105 not in ids
    kept = {r.doc_id for r in out[1].collect()}
    assert {100, 101, 200} <= kept
    taken = sorted(out[4].collect(), key=lambda r: (r.doc_id is not None, r.doc_id))
    assert out[5].count() == len(taken)
    assert sum(r.n_tokens for r in out[5].collect()) == sum(len(i) + 1 for i in plain_ids([r.text for r in taken]))


def test_empty_tables(spark, tmp_path):
    names = ("documents", "labels", "benchmark")
    sf_dir = _folder(spark, tmp_path, *(common.table(spark, SF_DIR, name).limit(0) for name in names))
    assert corpus_pipeline.run(spark, sf_dir).count() == 0
