import json
from pathlib import Path

import marketplace
import pytest

from verification import registry
from waybill.operators.quality import QualityError
from waybill.params import Params
from waybill.plans import bi, charts, report
from waybill.plans.job import run_pipeline
from waybill.sources.extracts import read_json_as
from waybill.sources.raw import read_raw_zone, require_inputs
from waybill.sources.snapshots import read_tables, versions
from waybill.sources.staging import stage_all
from waybill.sources.storage import shared_folder

PARAMS = Params(window_days=60, min_seller_orders=2)


@pytest.fixture(scope="module")
def out(tmp_path_factory):
    return tmp_path_factory.mktemp("job") / "out"


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory, out):
    raw = marketplace.write(tmp_path_factory.mktemp("raw") / "zone")
    return run_pipeline(spark, raw, str(out), PARAMS)


def by(df, key, *columns):
    return {r[key]: (r[columns[0]] if len(columns) == 1 else tuple(r[c] for c in columns))
            for r in df.collect()}


def test_report_of_a_sound_shop(built):
    failing = by(built["quality_checks"], "check_name", "failing_rows")
    assert len(failing) == 10 and not any(failing.values())


def test_fact_is_what_was_delivered_against_a_promise(built):
    fact = built["fct_orders"]
    assert sorted(r.order_id for r in fact.collect()) == [
        "k01", "k02", "k03", "k05", "k06", "k07", "k09", "k10", "k11", "k13",
    ]
    assert len(fact.columns) == 27 and fact.columns[3] == "order_month"


def test_days_and_bands_at_their_edges(built):
    got = by(built["fct_orders"], "order_id", "delivery_days", "days_late", "is_late", "lateness_bucket")
    assert got["k01"] == (2, 0, False, "0 On time")  # the last second of the promised day
    assert got["k07"][1:] == (3, True, "1 1-3 days late")
    assert got["k03"][1:] == (4, True, "2 4-7 days late")
    assert got["k13"][1:] == (8, True, "3 8-14 days late")
    assert got["k05"][1:] == (15, True, "4 15+ days late")
    assert got["k09"][1:] == (-8, False, "0 On time")


def test_one_review_per_order(built):
    got = by(built["fct_orders"], "order_id", "review_score", "is_negative_review", "has_comment")
    assert got["k01"] == (4, False, False)  # a non-breaking space says nothing
    assert got["k03"] == (2, True, True)  # the later answer, over two lines with quotes
    assert got["k05"] == (1, True, True)  # a tab is text
    assert got["k07"] == (5, False, False)  # equal times: the lower review id
    assert got["k13"] == (None, None, None)
    assert built["stg_reviews"].count() == 5


def test_main_line_and_sums(built):
    got = by(
        built["fct_orders"], "order_id", "item_count", "seller_count", "item_value",
        "freight_value", "paid_value", "installments", "main_seller_id", "main_category",
    )
    # West sold more of it in all, east the dearest line.
    assert got["k01"] == (3, 2, 140.0, 3.0, 10.25, 6, "east", "tapete")
    assert got["k03"][-2:] == ("west", "unknown")  # equal prices: the lower line; no category
    assert got["k05"][-1] == "tables"
    assert got["k10"][-1] == "ferro"  # no translation
    assert got["k13"][4:6] == (None, None)


def test_weights_that_are_not_numbers_are_null(built):
    got = by(built["stg_products"], "product_id", "weight_g")
    assert got == {"odd": 7.0, "desk": 12000.0, "rug": None, "pen": None, "ink": 5.5, "lamp": 800.0}


def test_distance(built):
    got = by(built["fct_orders"], "order_id", "distance_km", "same_state")
    assert got["k03"] == (pytest.approx(0.0, abs=1e-6), True)
    assert got["k06"] == (pytest.approx(222.4, abs=0.1), False)  # two degrees to the south
    assert got["k09"] == (None, True)  # all points of the zip lie outside the box
    bands = by(built["mart_distance"], "distance_band", "orders")
    assert bands["9 Unknown"] == 6 and sum(bands.values()) == 10


def test_sequence_skips_what_was_never_sold(built):
    got = by(built["customer_orders"], "order_id", "order_seq", "next_purchased_at")
    assert not {"k08", "k14"} & got.keys()
    assert [got[o][0] for o in ("k05", "k06", "k07", "k09")] == [1, 2, 3, 1]
    assert str(got["k05"][1]) == "2022-05-01 10:00:00" and got["k07"][1] is None
    assert built["customer_orders"].columns == [
        "customer_unique_id", "order_id", "purchased_at", "order_seq", "next_purchased_at",
    ]


def test_who_came_back(built):
    cohort = built["first_order_retention"]
    got = by(
        cohort, "customer_unique_id", "order_id", "days_to_next_order", "repeat_in_window",
        "is_mature",
    )
    assert got == {
        "olga": ("k01", 60, True, True),
        "pim": ("k03", 61, False, True),
        "quinn": ("k05", 12, True, True),
        "sven": ("k09", None, False, True),
        "ulf": ("k10", None, False, True),
        "vera": ("k11", None, False, False),
        "yara": ("k13", None, False, True),
    }
    assert cohort.columns[27:] == [
        "next_order_at", "days_to_next_order", "repeat_in_window", "is_mature",
    ]


def test_maturity_boundary_is_exact(spark, ts):
    from pyspark.sql import functions as F

    from waybill.operators.retention import first_event_retention

    sequence = spark.createDataFrame(
        [(f"p{i}", f"o{i}", 1, ts("2020-01-01 00:00"), None) for i in range(2)],
        "person string, first_event string, event_seq bigint, at timestamp_ntz, next_ts timestamp_ntz",
    )
    outcomes = spark.createDataFrame(
        [("o0", ts("2020-06-01 10:00:00")), ("o1", ts("2020-06-01 10:00:01"))],
        "order_id string, delivered_at timestamp_ntz",
    )
    got = first_event_retention(
        sequence, outcomes, entity="person", ts="at", outcome_event="order_id", outcome_ts="delivered_at",
        data_end=F.lit(ts("2020-06-11 10:00:00")), window_days=10,
    )
    assert by(got, "order_id", "is_mature") == {"o0": True, "o1": False}


def test_marts(built):
    split = by(built["mart_retention_late_vs_ontime"], "first_delivery", "customers", "repeat_customers")
    assert split == {"On time": (3, 1), "Late": (3, 1)}
    late = by(built["mart_lateness"], "lateness_bucket", "orders", "share_of_orders", "mature_first_orders")
    assert late == {
        "0 On time": (2, 0.4, 3),
        "1 1-3 days late": (1, 0.2, None),  # reviewed, but nobody's first order
        "2 4-7 days late": (1, 0.2, 1),
        "4 15+ days late": (1, 0.2, 1),
    }
    sellers = by(built["mart_seller"], "seller_id", "orders", "late_orders",
                 "share_of_all_late_orders", "late_rate_decile")
    assert sellers == {"west": (5, 3, 0.75, 1), "east": (4, 1, 0.25, 2)}
    states = by(built["mart_state"], "customer_state", "orders", "late_rank")
    assert states == {"WW": (5, 1), "SS": (2, 2), "EE": (3, 3)}


def test_report_and_charts(built):
    totals = report.report_totals(built["fct_orders"]).first()
    assert (totals.orders, totals.customers, totals.sellers) == (10, 7, 3)
    assert totals.late_rate == pytest.approx(0.4)
    headline = report.report_headline(built["mart_late_vs_ontime"]).first()
    assert headline.late_negative_review_rate == pytest.approx(2 / 3)
    assert headline.negative_review_ratio is None  # no negative review on time
    overall = charts.overall_late_rate(built["mart_state"]).first()
    assert overall.late_rate == pytest.approx(0.4)
    states = charts.chart_states(built["mart_state"], 1).collect()
    assert [(r.customer_state, r.level) for r in states] == [("EE", "normal"), ("SS", "high"), ("WW", "high")]
    deciles = report.report_seller_deciles(built["mart_seller"])
    assert [r.late_rate_decile for r in deciles.collect()] == [1, 2]
    ends = report.report_decile_ends(deciles).first()
    assert (ends.sellers, ends.worst_late_rate, ends.best_late_rate) == (2, 0.6, 0.25)


def test_dashboard_filters(built):
    import datetime as dt

    kpis = bi.bi_kpis(
        built["fct_orders"], months=(dt.date(2022, 2, 1), dt.date(2022, 5, 1)), states=["WW"]
    )
    row = kpis.first()
    assert (row.orders, row.late_orders, row.late_rate) == (3, 2, pytest.approx(2 / 3))
    # The month range reads only its own folders of the stored fact.
    assert "PartitionFilters: [isnotnull(order_month" in kpis._jdf.queryExecution().toString()
    assert [r.seller_id for r in bi.top_sellers(built["mart_seller"], 1).collect()] == ["west"]


def csv_rows(folder):
    lines = [line for part in sorted(folder.glob("part-*")) for line in part.read_text().splitlines()]
    return [line.split(",") for line in lines if not line.startswith(lines[0].split(",")[0] + ",")]


def test_extracts(spark, out):
    # Name and the order of its rows by one column; the orders have none.
    order = {
        "orders": None, "lateness": (0, False), "state": ("late_rank", False), "seller": ("late_orders", True),
        "monthly": (0, False), "distance": (0, False), "late_vs_ontime": (0, True),
        "retention_late_vs_ontime": (0, True),
    }
    assert {p.name for p in (out / "extracts").iterdir()} == {f"{name}.csv" for name in order}
    for name, by_column in order.items():
        if by_column:
            path = out / "extracts" / f"{name}.csv"
            columns = spark.read.csv(str(path), header=True).columns
            at = by_column[0] if isinstance(by_column[0], int) else columns.index(by_column[0])
            keys = [row[at] for row in csv_rows(path)]
            assert len(keys) > 1 and keys == sorted(keys, reverse=by_column[1]), name
    orders = spark.read.csv(str(out / "extracts" / "orders.csv"), header=True)
    assert "customer_unique_id" not in orders.columns and orders.count() == 10
    assert by(orders, "order_id", "purchased_at")["k01"] == "2022-01-10 23:00:00"


def test_statistic_reads_back(spark, built, out):
    again = read_json_as(spark, str(out / "retention_test.json"), built["retention_test"]).collect()
    assert again == built["retention_test"].collect() and again[0].on_time_repeat == 1
    (statistic,) = (out / "retention_test.json").glob("part-*")
    assert json.loads(statistic.read_text())["late_customers"] == 3


def test_summary_reads_in_full(out):
    (summary,) = (out / "summary.txt").glob("part-*")
    lines = summary.read_text().splitlines()
    assert lines[0] == "10 delivered orders, 7 customers, 3 sellers, Jan 2022 to Sep 2022; late: 40.0%"
    assert lines[1] == (
        "Reviews, late / on time: average 2.67 / 3.50, 1-2 stars 67% / 0% (unknownx), 5 stars 33% / 0%"
    )
    assert lines[2:6] == [
        "Lateness On time: 2 reviewed orders, average review 3.50, 0% negative",
        "Lateness 1-3 days late: 1 reviewed orders, average review 5.00, 0% negative",
        "Lateness 4-7 days late: 1 reviewed orders, average review 2.00, 100% negative",
        "Lateness 15+ days late: 1 reviewed orders, average review 1.00, 100% negative",
    ]
    assert lines[6].startswith(
        "Came back within 60 days, on time / late: 1 of 3 (33.33%) / 1 of 3 (33.33%), relative gap 0%,"
    )
    # No state and no month is large enough to be named.
    assert [line.split(":")[0] for line in lines[7:-1]] == ["Distance <100 km", "Distance 100-499 km"]
    assert lines[-1] == (
        "2 sellers with at least 2 orders; worst tenth 60.0% late, average review 1.50;"
        " best tenth 25.0% late, average review 4.00"
    )


def test_the_tables_are_one_version(spark, built, out):
    stored = read_tables(spark, str(out / "tables"))
    assert stored.keys() == built.keys() and len(stored) == 20
    for name in ("fct_orders", "mart_seller", "retention_test"):
        assert stored[name].columns == built[name].columns
        assert sorted(map(str, stored[name].collect())) == sorted(map(str, built[name].collect()))


def test_a_run_that_dies_leaves_the_tables_before_it(spark, tmp_path, monkeypatch):
    raw, out = marketplace.write(tmp_path / "zone"), str(tmp_path / "out")
    run_pipeline(spark, raw, out, PARAMS)
    before = read_tables(spark, f"{out}/tables")["fct_orders"].count()
    (Path(raw) / "shop_orders_dataset.csv").write_text(
        "".join((Path(raw) / "shop_orders_dataset.csv").read_text().splitlines(keepends=True)[:6])
    )

    def dies(*_):
        raise RuntimeError("driver lost")

    monkeypatch.setattr("waybill.plans.job.build_marts", dies)
    with pytest.raises(RuntimeError):
        run_pipeline(spark, raw, out, PARAMS)
    assert versions(spark, f"{out}/tables") == [1]
    assert read_tables(spark, f"{out}/tables")["fct_orders"].count() == before > 0


def test_the_job_reads_the_fact_once_for_all_marts(spark, built, out):
    from waybill.plans.marts import fact_states

    fact = read_tables(spark, str(out / "tables"))["fct_orders"]
    plan = fact_states(fact)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and plan.count("Exchange") == 1
    states = fact_states(fact).collect()
    per_key = {key: sum(r.orders for r in states if r.grouping == key) for key in {r.grouping for r in states}}
    assert len(per_key) == 6 and set(per_key.values()) == {fact.count()}


def test_retention_stores_the_fact_it_reads_twice(spark, tmp_path, monkeypatch):
    staged = stage_all(read_raw_zone(spark, marketplace.write(tmp_path / "zone")))
    monkeypatch.setattr(registry.derive, "typed", lambda *_: staged)
    cohort = registry._retention(spark, str(tmp_path), PARAMS)
    assert cohort.count() > 0
    # The rest of the plan reads what was stored.
    assert not [path for path in cohort.inputFiles() if path.endswith(".csv")]


def test_nothing_is_left_in_the_shared_folder(spark, tmp_path):
    folder = Path(shared_folder(spark))
    before = set(folder.iterdir()) if folder.exists() else set()
    run_pipeline(spark, marketplace.write(tmp_path / "zone"), str(tmp_path / "out"), PARAMS)
    assert set(folder.iterdir()) == before


def test_two_vendors_are_not_merged(spark, tmp_path):
    marketplace.write(tmp_path / "zone")
    marketplace.write(tmp_path / "other", prefix="old_")
    for file in (tmp_path / "other").glob("old_*"):
        (tmp_path / "zone" / file.name).write_bytes(file.read_bytes())
    with pytest.raises(ValueError, match="old_orders_dataset.csv.*shop_orders_dataset.csv"):
        require_inputs(spark, str(tmp_path / "zone"))


def test_missing_inputs_are_all_named(spark, tmp_path):
    raw = Path(marketplace.write(tmp_path / "zone"))
    partial = tmp_path / "partial"
    partial.mkdir()
    for file in raw.iterdir():
        if "sellers" not in file.name and "shop_orders" not in file.name:
            (partial / file.name).write_bytes(file.read_bytes())
    with pytest.raises(FileNotFoundError) as error:
        run_pipeline(spark, str(partial), str(tmp_path / "out"))
    assert "orders_dataset.csv" in str(error.value) and "sellers_dataset" in str(error.value)
    assert "order_items" not in str(error.value)
    assert not (tmp_path / "out").exists()


def test_inputs_with_and_without_vendor_prefix(spark, tmp_path):
    plain = marketplace.write(tmp_path / "plain", prefix="")
    assert all(len(found) == 1 for found in require_inputs(spark, plain).values())


def test_each_failing_check_is_reported_before_the_job_stops(spark, tmp_path):
    rows = marketplace.tables()
    items = rows["order_items_dataset.csv"]
    raw = marketplace.write(
        tmp_path / "zone",
        # A second copy of k02, a delivery before its purchase, an order nobody placed.
        orders_dataset=[
            *rows["orders_dataset.csv"],
            *[o for o in rows["orders_dataset.csv"] if o[0] == "k02"],
            ("X1", "of-k01", "delivered", "2022-05-05 00:00:00", None, None,
             "2022-05-01 00:00:00", "2022-05-09 00:00:00"),
            ("X2", "nobody", "delivered", "2022-05-05 00:00:00", None, None,
             "2022-05-06 00:00:00", "2022-05-09 00:00:00"),
        ],
        order_items_dataset=[
            *items,
            ("X1", 1, "lamp", "east", "", 10, 1.5),
            ("X2", 1, "nothing", "nobody", "", -1, 1.5),
        ],
        order_reviews_dataset=[
            *rows["order_reviews_dataset.csv"],
            ("v9", "k02", "6", "", "", "2022-01-01 00:00:00", "2022-03-18 00:00:00"),
        ],
    )
    with pytest.raises(QualityError):
        run_pipeline(spark, raw, str(tmp_path / "out"), PARAMS)
    assert versions(spark, str(tmp_path / "out" / "tables")) == []
    written = spark.read.csv(str(tmp_path / "out" / "quality_checks.csv"), header=True)
    failing = {r.check_name: int(r.failing_rows) for r in written.collect()}
    assert {name: n for name, n in failing.items() if n} == {
        "Duplicate order IDs in fct_orders": 1,
        "Orders without a customer": 1,
        "Order items with an unknown seller": 1,
        "Order items with an unknown product": 1,
        "Review scores outside 1-5": 1,
        "Delivered before purchase": 1,
        "Negative prices or freight": 1,
    }
    assert not (tmp_path / "out" / "retention_test.json").exists()
