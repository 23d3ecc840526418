import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from waybill.functions import bands, geo, measures, text, timing
from waybill.params import Box


@pytest.mark.parametrize(
    "start, end, days",
    [
        ("2020-01-01 23:00", "2020-01-02 01:00", 1),
        ("2020-01-01 23:00", "2020-01-03 01:00", 2),
        ("2020-01-01 00:00", "2020-01-01 23:59", 0),
        ("2020-03-01 00:00", "2020-02-28 23:00", -2),
        (None, "2020-01-01 00:00", None),
    ],
)
def test_days_between_counts_date_boundaries(one, ts, start, end, days):
    got = one(
        "a timestamp_ntz, b timestamp_ntz",
        (ts(start), ts(end)),
        timing.days_between(F.col("a"), F.col("b")),
    )
    assert got == days


def test_month_of_ignores_the_session_zone(spark, ts):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        df = spark.createDataFrame([(ts("2020-03-01 00:30"),)], "t timestamp_ntz")
        row = df.select(
            timing.month_of(F.col("t")).cast("string"),
            timing.days_before(F.col("t"), 1).cast("string"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert tuple(row) == ("2020-03-01", "2020-02-29 00:30:00")


@pytest.mark.parametrize(
    "days, label",
    [
        (-9, "0 On time"),
        (0, "0 On time"),
        (1, "1 1-3 days late"),
        (3, "1 1-3 days late"),
        (4, "2 4-7 days late"),
        (7, "2 4-7 days late"),
        (8, "3 8-14 days late"),
        (14, "3 8-14 days late"),
        (15, "4 15+ days late"),
    ],
)
def test_lateness_bucket_edges(one, days, label):
    assert one("d bigint", (days,), bands.lateness_bucket(F.col("d"))) == label


@pytest.mark.parametrize(
    "km, mart, field",
    [
        (0.0, "1 <100 km", "<100 km"),
        (99.99, "1 <100 km", "<100 km"),
        (100.0, "2 100-499 km", "100-499 km"),
        (999.9, "3 500-999 km", "500-999 km"),
        (1000.0, "4 1,000-1,999 km", "1,000-1,999 km"),
        (2000.0, "5 2,000+ km", "2,000+ km"),
        (None, "9 Unknown", "2,000+ km"),
    ],
)
def test_distance_bands_differ_on_unknown(one, km, mart, field):
    km_column = F.col("km")
    got = one("km double", (km,), bands.distance_band(km_column), bands.bi_distance_band(km_column))
    assert got == (mart, field)


@pytest.mark.parametrize(
    "message, expected",
    [
        (None, False),
        ("", False),
        ("   ", False),
        ("\u00a0", False),
        (" \u3000 ", False),
        ("\t", True),
        ("\n", True),
        (" ok ", True),
    ],
)
def test_has_text(one, message, expected):
    assert one("m string", (message,), text.has_text(F.col("m"))) is expected


@pytest.mark.parametrize(
    "code, padded", [("123", "00123"), ("12345", "12345"), ("1234567", "12345"), (None, None)]
)
def test_pad_code(one, code, padded):
    assert one("c string", (code,), text.pad_code(F.col("c"))) == padded


def test_presentation(one):
    got = one(
        "n bigint, p double, l string, d date",
        (1234567, 0.2141, "2 4-7 days late", dt.date(2018, 3, 9)),
        text.thousands(F.col("n")),
        text.percent(F.col("p"), 1),
        text.percent(F.col("p")),
        text.fixed(F.col("p"), 2),
        text.strip_sort_prefix(F.col("l")),
        text.month_label(F.col("d")),
    )
    assert got == ("1,234,567", "21.4%", "21%", "0.21", "4-7 days late", "Mar 2018")


def haversine(*points):
    return geo.haversine_km(*[F.lit(p).cast("double") for p in points])


def test_haversine(one):
    same, quarter, antipodal, unknown = one(
        "x int",
        (1,),
        haversine(-23.5, -46.6, -23.5, -46.6),
        haversine(0, 0, 0, 90),
        haversine(12.3456789, 10, -12.3456789, -170),
        haversine(1, 2, None, 4),
    )
    assert same == 0
    assert quarter == pytest.approx(math.pi / 2 * 6371)
    assert antipodal == pytest.approx(math.pi * 6371)
    assert unknown is None


def test_centroids_keep_the_box_edges(spark):
    points = spark.createDataFrame(
        [("a", 0.0, 0.0), ("a", 10.0, 10.0), ("a", 10.1, 5.0), ("b", 5.0, -0.1), ("c", None, 1.0)],
        "k string, lat double, lng double",
    )
    got = geo.centroids(points, "k", "lat", "lng", Box(0, 10, 0, 10)).collect()
    assert [tuple(r) for r in got] == [("a", 5.0, 5.0)]


def test_rate_counts_null_as_a_miss(spark):
    df = spark.createDataFrame([(True,), (False,), (None,), (True,)], "f boolean")
    row = df.agg(measures.rate(F.col("f")), measures.hits(F.col("f"))).first()
    assert tuple(row) == (0.5, 2)


def test_ratio_of_nothing_is_null(one):
    assert one("a bigint, b bigint", (1, 0), measures.ratio(F.col("a"), F.col("b"))) is None
