from pyspark.sql import functions as F

from tests.llm.brute import ODD_TEXTS, contamination, words
from waybill.llm import decontaminate

PASSAGE = " ".join(f"w{i}" for i in range(30))
ITEMS = [(1, PASSAGE), (2, PASSAGE), (3, "only four words here"), (4, None), (5, "..."), (5, "again " + PASSAGE)]
DOCS = [
    *enumerate(ODD_TEXTS),
    (100, "before " + PASSAGE.upper() + " after"),
    (101, "x " * 500 + PASSAGE),
    (102, " ".join(f"w{i}" for i in range(5, 17))),
    (103, "(only) four, words: here! " + PASSAGE + " and only four words here"),
    (103, "another text of a repeated id"),
    (104, PASSAGE),
    (104, PASSAGE),
    (None, PASSAGE),
    (105, "filler " * 21000 + " ".join(f"w{i}" for i in range(13))),
]


def frames(spark, docs=DOCS, items=ITEMS):
    documents = spark.createDataFrame(docs, "doc_id long, text string")
    # Names that the operator uses itself must not get in its way.
    documents = documents.withColumns({"text_key": F.lit("t"), "hash": F.lit(1), "spans": F.lit(2)})
    return documents, spark.createDataFrame(items, "item_id long, text string").withColumn("window", F.lit(0))


def test_scan_against_brute_force(spark):
    documents, benchmark = frames(spark)
    got = sorted(
        (str(r.doc_id), r.n_words, r.n_hit, tuple(sorted(r["items"])), r.contaminated)
        for r in decontaminate.scan(documents, benchmark).collect()
    )
    want = []
    for doc_id, text in DOCS:
        n, hit, found = contamination(text, ITEMS)
        want.append((str(doc_id), n, hit, tuple(sorted(found)), hit > 0 and 20 * hit >= n))
    assert got == sorted(want)


def test_blocks_agree(spark, monkeypatch):
    documents, benchmark = frames(spark)
    rows = lambda: sorted(map(str, decontaminate.scan(documents, benchmark).select("doc_id", "n_hit").collect()))
    whole = rows()
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 5)
    assert rows() == whole


def test_removal(spark):
    documents, benchmark = frames(spark)
    kept = decontaminate.remove_documents(documents, benchmark)
    assert kept.columns == documents.columns
    want = [d for d in DOCS if not (lambda n, h, _: h > 0 and 20 * h >= n)(*contamination(d[1], ITEMS))]
    assert sorted(map(str, (tuple(r)[:2] for r in kept.collect()))) == sorted(map(str, want))

    cut = {(r.doc_id, r.text) for r in decontaminate.remove_spans(documents, benchmark).collect()}
    assert (100, "before after") in cut and (104, "") in cut
    assert (105, DOCS[-1][1]) in cut
    assert all(words(text)[:1] != ["w0"] for i, text in cut if i in (100, 103, 104))


def test_empty_tables(spark):
    documents, benchmark = frames(spark)
    assert decontaminate.scan(documents.limit(0), benchmark).count() == 0
    clean = decontaminate.scan(documents, benchmark.limit(0))
    assert clean.count() == len(DOCS) and clean.filter("contaminated OR n_hit > 0").isEmpty()
    assert decontaminate.remove_documents(documents, benchmark.limit(0)).count() == len(DOCS)
