import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from waybill.operators import sequence as seq
from waybill.operators.dedupe import first_per_key
from waybill.operators.proportions import retention_test, retention_test_by, two_proportion_ztest
from waybill.operators.quality import (
    QualityError,
    fk_check,
    gate,
    predicate_check,
    range_check,
    scan_checks,
    unique_check,
)
from waybill.operators.ranking import ntile_scalable, with_global_index
from waybill.operators.retention import first_event_retention
from waybill.operators.shares import share_of_total, share_within_labels
from waybill.plans.facts import order_lines


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)


def test_first_per_key_puts_nulls_last_and_breaks_ties(spark):
    df = spark.createDataFrame(
        [("k", 1, "b"), ("k", 1, "a"), ("k", None, "0"), ("m", None, "z"), (None, 3, "n")],
        "key string, v int, id string",
    )
    order = [F.col("v").desc_nulls_last(), F.col("id").asc_nulls_last()]
    kept = first_per_key(df, ["key"], order)
    assert rows(kept, "key", "id") == rows(
        spark.createDataFrame([("k", "a"), ("m", "z"), (None, "n")], "key string, id string")
    )
    assert "WindowGroupLimit" in kept._jdf.queryExecution().toString()


LINES = "order_id string, order_item_id int, product_id string, seller_id string, price double, freight double"


def test_main_line_is_the_dearest_line_not_the_dearest_seller(spark):
    items = spark.createDataFrame(
        [
            ("o1", 1, "p1", "sA", 40.0, 1.0),
            ("o1", 2, "p2", "sA", 40.0, 1.0),
            ("o1", 3, "p3", "sA", 40.0, 1.0),
            ("o1", 4, "p4", "sB", 100.0, 2.0),
            ("o2", 2, "p5", "sB", 7.0, 0.0),
            ("o2", 1, "p6", "sA", 7.0, 0.0),
            ("o3", 1, "p7", None, None, 0.5),
            ("o3", 2, "p8", "sC", 1.0, 0.5),
        ],
        LINES,
    )
    assert rows(order_lines(items)) == [
        ("o1", 4, 2, 220.0, 5.0, "sB", "p4"),
        ("o2", 2, 2, 14.0, 0.0, "sA", "p6"),
        ("o3", 2, 1, 1.0, 1.0, "sC", "p8"),
    ]


def random_lines(spark, n, seed):
    pick = random.Random(seed)
    data = [
        (
            f"o{pick.randrange(40)}",
            i,
            f"p{pick.randrange(9)}",
            pick.choice([None, "s1", "s2", "s3"]),
            pick.choice([None, 1.0, 2.0, 3.5]),
            0.25,
        )
        for i in range(n)
    ]
    return spark.createDataFrame(data, LINES)


def test_main_line_agrees_with_the_window_form(spark):
    items = random_lines(spark, 500, 5)
    order = [F.col("price").desc_nulls_last(), F.col("order_item_id").asc_nulls_last()]
    expected = first_per_key(items, ["order_id"], order)
    assert rows(order_lines(items), "order_id", "main_seller_id", "main_product_id") == rows(
        expected, "order_id", "seller_id", "product_id"
    )


def test_lines_without_an_order_have_no_main_line(spark):
    items = spark.createDataFrame(
        [(None, 1, "p1", "sA", 5.0, 1.0), (None, 2, "p2", "sB", 6.0, 1.0), ("o1", 1, None, "sA", 2.0, 0.0)], LINES
    )
    assert rows(order_lines(items)) == [("o1", 1, 1, 2.0, 0.0, "sA", None), (None, 2, 2, 11.0, 2.0, None, None)]


def test_lines_move_once_for_sums_and_main_line(spark):
    plan = order_lines(random_lines(spark, 50, 6))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(order_id") == plan.count("Exchange ") == 1


@pytest.mark.parametrize("n", [1, 7, 10, 13, 100, 1003])
def test_ntile_scalable_equals_the_window(spark, n):
    pick = random.Random(n)
    df = spark.createDataFrame(
        [(pick.choice([None, 0.0, 0.0, 0.0, 0.5, pick.random()]), i) for i in range(n)],
        "rate double, id int",
    ).repartition(3)
    order = [F.col("rate").desc_nulls_last(), F.col("id").asc_nulls_last()]
    expected = df.withColumn("tile", F.ntile(10).over(W.orderBy(*order)).cast("bigint"))
    assert rows(ntile_scalable(df, order, 10, "tile")) == rows(expected)


def test_global_index_spreads_a_single_hot_value(spark):
    df = spark.range(5000).select(F.lit("same").alias("v"), "id").repartition(4)
    placed = with_global_index(df, [F.col("v"), F.col("id")], "at", "n")
    assert placed.filter("at <> id + 1 OR n <> 5000").count() == 0


def test_ntile_of_nothing(spark):
    empty = spark.createDataFrame([], "rate double, id int")
    assert ntile_scalable(empty, [F.col("rate").desc(), F.col("id")], 10, "tile").count() == 0


def test_shares(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "k string, n int")
    expected = [("a", 1, 0.25), ("b", 3, 0.75)]
    assert rows(share_of_total(df, "n", "share")) == expected
    assert rows(share_within_labels(df, "n", "share")) == expected
    nothing = df.withColumn("n", F.lit(0))
    assert rows(share_of_total(nothing, "n", "s"), "s") == [(None,), (None,)]


EVENTS = "person string, event string, at timestamp_ntz"


def random_events(spark, ts, seed, n=600):
    """A third of the events belong to one person, another part to nobody; many equal times."""
    pick = random.Random(seed)
    data = []
    for i in range(n):
        person = pick.choice(["hot", None, f"p{pick.randrange(60)}"])
        day = ts(f"2020-01-{pick.randrange(1, 29):02d} {pick.randrange(3):02d}:00")
        data.append((person, f"e{i:04d}", None if pick.random() < 0.02 else day))
    return spark.createDataFrame(data, EVENTS)


def plain_window(events):
    line = W.partitionBy("person").orderBy(
        F.col("at").asc_nulls_last(), F.col("event").asc_nulls_last()
    )
    return events.select(
        "*",
        F.row_number().over(line).cast("bigint").alias("event_seq"),
        F.lead("at").over(line).alias("next_ts"),
        F.first("event").over(line).alias("first_event"),
    )


@pytest.mark.parametrize("seed", [0, 20, 150])
def test_sequence_equals_one_window_per_entity(spark, ts, seed):
    events = random_events(spark, ts, seed)
    got = seq.sequence_events(events, "person", "event", "at")
    assert rows(got) == rows(plain_window(events))


def test_sequence_of_many_busy_entities(spark, ts):
    data = [
        (f"p{i % 1500}", f"e{i:05d}", ts(f"2020-0{1 + i % 7}-{1 + i % 28:02d} 0{i % 10}:00"))
        for i in range(12000)
    ]
    events = spark.createDataFrame(data, EVENTS)
    got = seq.sequence_events(events, "person", "event", "at")
    assert rows(got) == rows(plain_window(events))
    # One plan for every size: nothing is counted, limited or collected to choose another.
    assert "Limit" not in got._jdf.queryExecution().toString()


@pytest.fixture
def many_ranges(spark):
    """Ranges and batches of a few rows, so that entities reach over many of both."""
    settings = {
        "spark.sql.shuffle.partitions": "9",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "7",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("seed", [4, 5, 6])
def test_sequence_over_many_ranges_and_batches(spark, ts, many_ranges, seed):
    events = random_events(spark, ts, seed, 400)
    got = seq.sequence_events(events, "person", "event", "at")
    assert rows(got) == rows(plain_window(events))


def test_one_day_of_one_person_is_spread_over_the_ranges(spark, ts, many_ranges):
    data = [("hot", f"e{i:04d}", ts("2020-01-01 10:00")) for i in range(900)]
    events = spark.createDataFrame([("a", "x", None), (None, None, None), *data, ("z", "y", None)], EVENTS)
    got = seq.sequence_events(events, "person", "event", "at")
    assert rows(got) == rows(plain_window(events))
    stored = got._jdf.queryExecution().analyzed().collectLeaves().head().toString()
    assert "_range" in stored
    scanned = spark.read.parquet(got.inputFiles()[0].rsplit("/", 1)[0])
    sizes = [r["count"] for r in scanned.groupBy("_range").count().collect()]
    assert len(sizes) == 9 and max(sizes) < 3 * len(data) / 9


@pytest.mark.parametrize("seed", [7, 8])
def test_a_sequence_with_outcomes_gives_the_same_retention(spark, ts, many_ranges, seed):
    events = random_events(spark, ts, seed, 500)
    firsts = plain_window(events).filter("event_seq = 1").select("person", "event", "at")
    chosen = events.filter(F.pmod(F.crc32("event"), F.lit(3)) > 0).union(firsts).distinct()
    delay = F.make_dt_interval(F.pmod(F.crc32("event"), F.lit(9)).cast("int") - 2)
    outcomes = chosen.select(
        "person", "event", "at",
        F.when(F.pmod(F.crc32("event"), F.lit(7)) > 0, F.coalesce("at", F.lit(ts("2020-01-05 00:00"))) + delay).alias("done"),
    )
    # Outcomes of events that are not in the sequence change nothing.
    stray = spark.createDataFrame([("hot", "nothing", ts("2020-01-02 00:00"), ts("2020-01-03 00:00"))], outcomes.schema)
    common = dict(
        entity="person", ts="at", outcome_event="event", outcome_ts="done",
        data_end=F.lit(ts("2020-01-28 02:00")), window_days=4,
    )
    plain = seq.sequence_events(events, "person", "event", "at")
    carried = seq.sequence_events(events, "person", "event", "at", outcomes.union(stray), "done")
    assert rows(carried.drop(seq.FIRST_OUTCOME)) == rows(plain)
    got, want = (first_event_retention(s, outcomes, **common) for s in (carried, plain))
    assert want.filter("next_order_at is not null").count() > 10
    assert rows(got) == rows(want)


def test_sequence_of_nothing(spark):
    events = spark.createDataFrame([], EVENTS)
    assert seq.sequence_events(events, "person", "event", "at").collect() == []


def literal_retention(events, outcomes, end, days):
    """The definition, as self-joins: first event, its outcome, earliest later event."""
    numbered = plain_window(events)
    first = numbered.filter("event_seq = 1").join(outcomes, F.col("event") == F.col("order_id"))
    later = numbered.filter("event_seq > 1").select(
        F.col("person").alias("who"), F.col("at").alias("later_at")
    )
    after = (F.col("who") == F.col("person")) & (F.col("later_at") > F.col("delivered_at"))
    found = first.join(later, after, "left").groupBy("order_id", "delivered_at")
    gap = F.datediff("next_order_at", "delivered_at").cast("bigint")
    return found.agg(F.min("later_at").alias("next_order_at")).select(
        "order_id",
        "delivered_at",
        "next_order_at",
        gap.alias("days_to_next_order"),
        F.coalesce(gap <= days, F.lit(False)).alias("repeat_in_window"),
        (F.col("delivered_at") <= F.lit(end) - F.make_dt_interval(F.lit(days))).alias("is_mature"),
    )


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_retention_equals_the_self_join(spark, ts, seed):
    events = random_events(spark, ts, seed)
    first_of_nobody = plain_window(events).filter("person is null and event_seq = 1")
    # Outcomes exist for two events in three, some before the event itself.
    chosen = events.filter(F.pmod(F.crc32("event"), F.lit(3)) > 0)
    chosen = chosen.union(first_of_nobody.select(*events.columns)).distinct()
    outcomes = chosen.select(
        F.col("event").alias("order_id"),
        (
            F.coalesce("at", F.lit(ts("2020-01-05 00:00")))
            + F.make_dt_interval(F.pmod(F.crc32("event"), F.lit(9)).cast("int") - 2)
        ).alias("delivered_at"),
    )
    end = ts("2020-01-28 02:00")
    got = first_event_retention(
        seq.sequence_events(events, "person", "event", "at"),
        outcomes,
        entity="person",
        ts="at",
        outcome_event="order_id",
        outcome_ts="delivered_at",
        data_end=F.lit(end),
        window_days=4,
    )
    expected = literal_retention(events, outcomes, end, 4)
    assert expected.filter("next_order_at is not null").count() > 10
    assert rows(got, *expected.columns) == rows(expected)


def test_checks_count_failing_rows(spark):
    df = spark.createDataFrame(
        [("a", 1, 1.0), ("a", 6, -1.0), (None, None, None), ("b", 0, 2.0)],
        "k string, score int, price double",
    )
    report = scan_checks(
        df,
        {
            "unique": unique_check("k"),
            "range": range_check("score", 1, 5),
            "negative": predicate_check((F.col("price") < 0) | (F.col("score") < 0)),
        },
    )
    assert rows(report) == [("negative", 1), ("range", 2), ("unique", 2)]
    known = spark.createDataFrame([("a",), (None,)], "id string")
    assert rows(fk_check("orphans", df, "k", known, "id")) == [("orphans", 2)]
    assert rows(fk_check("none", df.limit(0), "k", known, "id")) == [("none", 0)]


def test_gate(spark):
    clean = spark.createDataFrame([("fine", 0)], "check_name string, failing_rows bigint")
    assert gate(clean) is clean
    broken = clean.union(spark.createDataFrame([("bad", 3)], clean.schema))
    with pytest.raises(QualityError, match="bad: 3"):
        gate(broken)


COUNTS = "x1 bigint, n1 bigint, x2 bigint, n2 bigint"


def ztest(spark, *counts):
    df = spark.createDataFrame([counts], COUNTS)
    return two_proportion_ztest(df, "x1", "n1", "x2", "n2").first()


def test_ztest_published_figures(spark):
    got = ztest(spark, 1058, 59197, 55, 4517)
    # Published result of these counts.
    expected = {
        "p1": 0.0178725273240198,
        "p2": 0.012176223156962585,
        "diff": 0.0056963041670572145,
        "relative_diff": 0.31871844780461805,
        "z": 2.8167433891404663,
        "p_value": 0.004851326950535907,
        "ci_low": 0.002324567967616273,
        "ci_high": 0.009068040366498156,
    }
    for name, value in expected.items():
        assert got[name] == pytest.approx(value, rel=1e-9), name


def test_ztest_of_equal_shares(spark):
    got = ztest(spark, 18, 240, 36, 480)
    assert (got.z, got.p_value, got.diff) == (0.0, 1.0, 0.0)


@pytest.mark.parametrize("counts", [(0, 0, 5, 10), (0, 10, 0, 10), (10, 10, 10, 10)])
def test_ztest_without_a_statistic_is_null(spark, counts):
    got = ztest(spark, *counts)
    assert got.z is None and got.p_value is None


def test_ztest_relative_to_zero_is_nan(spark):
    got = ztest(spark, 0, 10, 5, 10)
    assert got.relative_diff != got.relative_diff and got.z < 0


def test_retention_test_with_a_missing_group(spark):
    mart = spark.createDataFrame(
        [("On time", 10, 2, 0.2)],
        "first_delivery string, customers bigint, repeat_customers bigint, repeat_rate double",
    )
    got = retention_test(mart).first()
    assert (got.p1, got.p2, got.z, got.late_customers) == (0.2, None, None, None)


def test_retention_test_by_segment_matches_the_overall_one(spark):
    cohort = spark.createDataFrame(
        [("x", i % 3 == 0, i % 5 == 0, i % 7 != 0) for i in range(300)],
        "seg string, is_late boolean, repeat_in_window boolean, is_mature boolean",
    )
    got = retention_test_by(cohort, "seg").first()
    kept = [r for r in cohort.collect() if r.is_mature]
    late = [r for r in kept if r.is_late]
    assert got.late_customers == len(late)
    assert got.on_time_repeat == sum(r.repeat_in_window for r in kept if not r.is_late)
