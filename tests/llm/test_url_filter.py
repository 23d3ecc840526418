import math

import pytest
from pyspark.sql import functions as F

from waybill.llm import url_filter

CASES = [
    (None, "", "", None), ("", "", "", None), ("no scheme/org/", "", "", None), ("a://", "", "", None),
    ("http://Example.ORG/es/x", "example.org", "/es/x", "example.org/es/"),
    ("http://a.example.org/en/12?p=1", "a.example.org", "/en/12", "example.org/en/1"),
    ("http://notexample.org/es/x", "notexample.org", "/es/x", "org/"),
    ("http://x.org", "x.org", "", None), ("http://x.org?q=/", "x.org", "", None), ("http://x.org#/", "x.org", "", None),
    ("http://x.com/fr/1#a", "x.com", "/fr/1", "com/fr/"), ("http://x.com/de/", "x.com", "/de/", "com/de/"),
    ("http://x.com/de", "x.com", "/de", None), ("ftp://É.com/é b\nc?", "É.com", "/é b\nc", None),
    ("x://y://z.org/", "y:", "//z.org/", None), ("http://org/a", "org", "/a", "org/"),
]


@pytest.fixture
def pages(spark):
    rows = [(i, url) for i, (url, *_) in enumerate(CASES)] + [(0, None), (None, "http://x.com/de/1")]
    rows += [(1000 + i, f"http://h{i % 9}.com/{'fr' if i % 3 else 'de'}/{i}") for i in range(120)]
    rows += [(2000 + i, f"http://spam-{i}-x.net/de/{i * 7919}?a={i}&b=1&c=2") for i in range(20)]
    frame = spark.createDataFrame(rows, "page_id long, url string")
    return frame.withColumns({"host": F.lit(1), "prediction": F.lit(1), "label": F.lit("l"), "features": F.lit(0)})


def test_hosts_and_rules(pages):
    rows = {r.page_id: r for r in url_filter.judge(pages).collect()}
    for i, (_, host, path, rule) in enumerate(CASES):
        assert (rows[i].host, rows[i].path, rows[i]["rule"]) == (host, path, rule)
        if rule:
            assert rows[i].verdict == next(r for r in url_filter.RULES if r.endswith(" " + rule)).split()[0]
        else:
            assert rows[i].verdict in ("allow", "block")
    assert rows[None].verdict == "block"


def test_trees_learn_from_labels(spark, pages):
    labelled = spark.createDataFrame(
        [(f"http://shop{i}.net/en/a{i}", 0) for i in range(200)]
        + [(f"http://cheap-pills-{i}.net/x/9{i * 31}8?u=1&v=2&w={i}", 1) for i in range(200)],
        "url string, label int",
    )
    verdict = {r.page_id: r.verdict for r in url_filter.judge(pages, labelled=labelled).collect()}
    assert {verdict[2000 + i] for i in range(20)} == {"block"}
    fresh = spark.createDataFrame([(i, f"http://shop{i}.net/en/b{i}") for i in range(300, 350)], "page_id long, url string")
    found = [r.verdict for r in url_filter.judge(fresh, labelled=labelled).collect()]
    assert found.count("allow") >= 48


def test_one_class_none_and_empty(spark, pages):
    net = spark.createDataFrame([(1, "http://a.net/"), (1, "http://a.net/")], "page_id long, url string")
    assert [r.verdict for r in url_filter.judge(net).collect()] == ["allow", "allow"]
    bad = spark.createDataFrame([("http://b.net/", 1)], "url string, label int")
    assert [r.verdict for r in url_filter.judge(net, labelled=bad).collect()] == ["block", "block"]
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_main_path_has_no_python(pages):
    plan = url_filter.judge(pages)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_entropy(spark):
    row = spark.createDataFrame([("aabb", "")], "a string, b string")
    got = row.select(url_filter._entropy(F.col("a")), url_filter._entropy(F.col("b"))).first()
    assert got[0] == pytest.approx(1.0) and got[1] == 0.0


def test_repeated_urls_count_once_and_statistics_are_over_all(spark):
    rows = [(f"http://a{i}.net/x/{i}.html", i % 2) for i in range(60)] + [("http://hot.com/a.php", 1)] * 5000
    rows += [("http://hot.com/a.php", 0)]
    host, path = url_filter.host_and_path(F.col("url"))
    labelled = spark.createDataFrame(rows, "url string, label int")
    known = labelled.select("url", host.alias("host"), path.alias("path"), F.col("label").cast("double"))
    model = url_filter.fit(known, rows=20)
    assert model.overall == pytest.approx(30 / 61)
    counts = {r.suffix: round(r.suffix_log_count, 6) for r in model.suffixes.collect()}
    assert counts == {"net": round(math.log1p(60), 6), "com": round(math.log1p(1), 6)}
    share = {r.suffix: r.suffix_share for r in model.suffixes.collect()}
    prior = url_filter.PRIOR_URLS
    assert share["net"] == pytest.approx((30 + prior * 30 / 61) / (60 + prior))


def test_features_against_plain_python(spark):
    urls = [url for url, *_ in CASES] + ["http://a-b.c9.net/d/e.tar.gz?x=1&y=2#z", "h://" + "q" * 50_000 + ".com/7"]
    host, path = url_filter.host_and_path(F.col("url"))
    frame = spark.createDataFrame([(u,) for u in urls], "url string").select("url", host.alias("host"), path.alias("path"))
    for row in url_filter.lexical(frame).collect():
        url = row.url or ""
        assert row.path_length == len(row.path) and row.path_depth == row.path.count("/")
        assert row.host_depth == len(row.host.split(".")) and row.hyphens == row.host.count("-")
        assert row.suffix == row.host.split(".")[-1]
        last = row.path.split("/")[-1]
        assert row.ending == (last.split(".")[-1] if "." in last else "")
        digits = sum(c in "0123456789" for c in url)
        assert row.digit_ratio == pytest.approx(digits / max(len(url), 1))
