"""Queries of the checked registry: the library's operators on the driver's tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cache, reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verification import derive
from waybill.functions import bands, geo, measures, text, timing
from waybill.operators import proportions, quality, ranking, shares
from waybill.operators.sequence import sequence_events
from waybill.params import COUNTRY_BOX, Params
from waybill.plans import bi, charts, facts, job, marts, report
from waybill.sources import extracts, raw, snapshots, staging
from waybill.sources.storage import scratch_path, scratch_table, write_table

Query = Callable[[SparkSession, str], DataFrame]

# At this many orders the seller filter keeps some and drops some at every scale factor, as
# orders and suppliers grow together.
SELLER_ORDERS = 110
PARAMS = Params(min_seller_orders=SELLER_ORDERS)
LONG_WINDOW = Params(window_days=1800)

QUERIES: dict[str, Query] = {}


# Sums of two-decimal prices: exact to the cent, whatever the order of addition.
CENTS = ("item_value",)


def comparable(df: DataFrame) -> DataFrame:
    """Plain types for the value comparison: text, bigint and doubles of six decimals."""
    out = []
    for field in df.schema:
        column = F.col(field.name)
        match field.dataType:
            case T.DoubleType():
                # The same double arithmetic as in the SQL. Adding zero turns -0.0 into 0.0.
                places = 1e2 if field.name in CENTS else 1e6
                column = F.rint(column * places) / places + 0.0
            case T.IntegerType() | T.LongType():
                column = column.cast("bigint")
            case T.DateType() | T.TimestampNTZType() | T.BooleanType():
                column = column.cast("string")
        out.append(column.alias(field.name))
    return df.select(*out)


def query(build: Query) -> Query:
    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build(spark, sf_dir))

    QUERIES[build.__name__] = run
    return build


@cache
def _fact(spark, sf) -> DataFrame:
    return facts.build_fct_orders(derive.typed(spark, sf))


def forget_plans() -> None:
    """Plan every later query anew; for timing."""
    derive.forget_plans()
    _fact.cache_clear()


def _sequence(spark, sf) -> DataFrame:
    return facts.customer_sequence(derive.typed(spark, sf))


def _retention(spark, sf, params=PARAMS, fact=None) -> DataFrame:
    """`fact` is a stored fact when the caller needs one for itself as well.

    It is read for the outcomes of the sequence and again for the cohort, so it is stored here otherwise.
    """
    t = derive.typed(spark, sf)
    fact = scratch_table(_fact(spark, sf), "fct_orders") if fact is None else fact
    return facts.first_order_retention(
        facts.customer_sequence(t, fact),
        fact,
        t["stg_orders"],
        params,
    )


# --- sources, staging, sinks ---------------------------------------------------------------


@query
def csv_roundtrip(spark, sf):
    """Raw orders and items written as CSV, scanned back as text and cast."""
    path = scratch_path(spark, "raw")
    text_form = derive.raw_text(spark, sf)
    for name in ("orders", "order_items"):
        extracts.write_csv(text_form[name], f"{path}/{raw.RAW_INPUTS[name]}")
    paths = raw.require_inputs(spark, path, ("orders", "order_items"))
    orders = staging.stage_orders(raw.read_raw(spark, paths["orders"]))
    items = staging.stage_order_items(raw.read_raw(spark, paths["order_items"]))
    return (
        items.groupBy("order_id")
        .agg(F.sum("order_item_id").alias("line_numbers"), F.sum("price").alias("item_value"))
        .join(orders, "order_id")
        .select(
            "order_id", "order_status", "purchased_at", "delivered_at", "line_numbers",
            "item_value",
        )
    )


@query
def table_roundtrip(spark, sf):
    """The monthly figures off a stored fact that is partitioned by month."""
    fact = _fact(spark, sf).select("order_id", "order_month", "is_late", "days_late")
    stored = write_table(fact, scratch_path(spark, "fct_orders"), partition_by="order_month")
    return stored.groupBy("order_month").agg(
        measures.row_count().alias("orders"), F.sum("days_late").alias("days_late")
    )


@query
def extract_orders(spark, sf):
    return extracts.extract_orders(_fact(spark, sf))


@query
def extract_roundtrip(spark, sf):
    """Monthly mart exported as CSV and read back with dates parsed."""
    mart = marts.mart_monthly(_fact(spark, sf))
    path = extracts.write_csv(mart, scratch_path(spark, "monthly.csv"), single_file=True)
    return extracts.read_csv_as(spark, path, mart)


@query
def stage_orders(spark, sf):
    return staging.stage_orders(derive.raw_text(spark, sf)["orders"])


@query
def stage_customers(spark, sf):
    return staging.stage_customers(derive.raw_text(spark, sf)["customers"])


@query
def stage_order_items(spark, sf):
    return staging.stage_order_items(derive.raw_text(spark, sf)["order_items"])


@query
def stage_payments(spark, sf):
    return staging.stage_payments(derive.raw_text(spark, sf)["payments"])


@query
def stage_reviews(spark, sf):
    return staging.stage_reviews(derive.raw_text(spark, sf)["reviews"])


@query
def stage_products(spark, sf):
    text_form = derive.raw_text(spark, sf)
    return staging.stage_products(text_form["products"], text_form["translation"])


@query
def stage_sellers(spark, sf):
    return staging.stage_sellers(derive.raw_text(spark, sf)["sellers"])


@query
def stage_zip_geo(spark, sf):
    return staging.stage_zip_geo(derive.raw_text(spark, sf)["geolocation"])


# --- scalar functions ----------------------------------------------------------------------


@query
def order_timing(spark, sf):
    delivered = facts.delivered_orders(derive.typed(spark, sf)["stg_orders"])
    return facts.order_timing(delivered).select(
        "order_id", "order_month", "delivery_days", "promised_days", "days_late", "is_late",
        timing.days_before(F.col("delivered_at"), PARAMS.window_days).alias("window_start"),
    )


@query
def lateness_bucket(spark, sf):
    delivered = facts.delivered_orders(derive.typed(spark, sf)["stg_orders"])
    return (
        facts.order_timing(delivered)
        .groupBy("lateness_bucket")
        .agg(
            measures.row_count().alias("orders"),
            F.min("days_late").alias("least_days"),
            F.max("days_late").alias("most_days"),
        )
    )


@query
def string_funcs(spark, sf):
    customer = derive.load(spark, sf, "customer")
    return customer.select(
        "c_custkey",
        text.pad_code(F.col("c_nationkey").cast("string")).alias("short_code"),
        text.pad_code(F.col("c_name")).alias("long_code"),
        text.strip_sort_prefix(F.col("c_name")).alias("label"),
        text.has_text(F.translate("c_mktsegment", "ABCDEFGHIJKLMNOPQRSTUV", " " * 22)).alias(
            "has_wxyz"
        ),
    )


@query
def month_label(spark, sf):
    orders = derive.load(spark, sf, "orders")
    return orders.groupBy(text.month_label(F.col("o_orderdate")).alias("label")).agg(
        measures.row_count().alias("orders"),
        F.min(timing.month_of(F.col("o_orderdate"))).alias("month"),
    )


@query
def number_format(spark, sf):
    orders = derive.load(spark, sf, "orders")
    # Only finished orders have figures: groups without any show how NULL is formatted.
    price = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))
    return orders.groupBy("o_orderpriority", "o_orderstatus").agg(
        text.thousands(measures.row_count()).alias("orders"),
        text.fixed(F.max(price), 1).alias("highest_price"),
        text.percent(F.avg((price > 100000).cast("double")), 1).alias("dear"),
    )


@query
def zip_geo(spark, sf):
    points = derive.raw_inputs(spark, sf)["geolocation"]
    return geo.centroids(
        points, "geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng", COUNTRY_BOX
    )


@query
def distance_km(spark, sf):
    """One zip dimension joined in two roles, then the distance."""
    t = derive.typed(spark, sf)
    sellers = facts.located(
        t["stg_sellers"], "seller_zip", t["stg_zip_geo"], "seller_lat", "seller_lng"
    )
    customers = facts.located(
        t["stg_customers"], "customer_zip", t["stg_zip_geo"], "cust_lat", "cust_lng"
    )
    km = geo.haversine_km(
        F.col("seller_lat"), F.col("seller_lng"), F.col("cust_lat"), F.col("cust_lng")
    )
    return (
        t["stg_order_items"]
        .join(customers, F.col("order_id") == F.col("customer_id"))
        .join(sellers, "seller_id")
        .groupBy("customer_zip", "seller_zip")
        .agg(
            measures.row_count().alias("lines"),
            F.max(km).alias("distance_km"),
            F.max(bands.distance_band(km)).alias("distance_band"),
        )
    )


@query
def bi_distance_band(spark, sf):
    return bi.bi_kpis(_fact(spark, sf), "distance_label")


# --- joins, aggregates, windows ------------------------------------------------------------


@query
def join_inner(spark, sf):
    """Items to sellers, a dimension that drops unmatched rows, and to customers."""
    t = derive.typed(spark, sf)
    return (
        t["stg_order_items"]
        .join(t["stg_sellers"], "seller_id")
        .join(t["stg_customers"], F.col("order_id") == F.col("customer_id"))
        .groupBy("seller_state", "customer_state")
        .agg(measures.row_count().alias("lines"), F.sum("price").alias("item_value"))
    )


@query
def join_left(spark, sf):
    """Orders enriched with payments and the latest review where there is one."""
    t = derive.typed(spark, sf)
    return (
        t["stg_orders"]
        .join(facts.order_payments(t["stg_payments"]), "order_id", "left")
        .join(t["stg_reviews"], "order_id", "left")
        .select("order_id", "paid_value", "installments", "review_score", "has_comment")
    )


@query
def check_orphans(spark, sf):
    """Lines whose part or supplier key is unknown, against dimensions with gaps by design."""
    part, supplier = derive.load(spark, sf, "part"), derive.load(spark, sf, "supplier")
    lines = derive.load(spark, sf, "lineitem")
    small_parts = part.filter(F.col("p_size") <= 25)
    in_credit = supplier.filter(F.col("s_acctbal") > 0)
    return quality.fk_check(
        "unknown part", lines, "l_partkey", small_parts, "p_partkey"
    ).unionByName(quality.fk_check("unknown supplier", lines, "l_suppkey", in_credit, "s_suppkey"))


@query
def agg_items(spark, sf):
    items = derive.typed(spark, sf)["stg_order_items"]
    return facts.order_lines(items).select(
        "order_id", "item_count", "seller_count", "item_value",
        "freight_value",
    )


@query
def agg_payments(spark, sf):
    return facts.order_payments(derive.typed(spark, sf)["stg_payments"])


@query
def late_rate(spark, sf):
    return _fact(spark, sf).groupBy("main_category").agg(
        measures.rate(F.col("is_late")).alias("late_rate"),
        measures.rate(F.col("is_negative_review")).alias("negative_review_rate"),
        measures.hits(F.col("is_late")).alias("late_orders"),
    )


@query
def dedupe_latest(spark, sf):
    return derive.typed(spark, sf)["stg_reviews"]


@query
def main_line(spark, sf):
    """The line that the fact takes for an order's seller and product."""
    return facts.main_lines(derive.typed(spark, sf)["stg_order_items"]).select(
        "order_id", "seller_id", "product_id", "price"
    )


@query
def customer_orders(spark, sf):
    return facts.customer_orders(_sequence(spark, sf))


@query
def customer_orders_hot(spark, sf):
    """The same sequence with two thirds of all orders placed by one person."""
    orders = derive.load(spark, sf, "orders").select(
        F.when(F.col("o_orderkey") % 3 != 0, 0).otherwise(F.col("o_custkey")).alias("person"),
        "o_orderkey",
        F.col("o_orderdate").cast("timestamp_ntz").alias("ordered_at"),
    )
    return sequence_events(orders, "person", "o_orderkey", "ordered_at")


@query
def share_of_total(spark, sf):
    totals = derive.load(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.sum("l_quantity").alias("quantity")
    )
    return shares.share_of_total(scratch_table(totals, "suppliers"), "quantity", "share")


@query
def ntile_scalable(spark, sf):
    lines = derive.load(spark, sf, "lineitem").select(
        "l_quantity", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    order = [F.col("l_quantity").desc_nulls_last()] + [
        F.col(c).asc_nulls_last()
        for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    ]
    return (
        ranking.ntile_scalable(lines, order, 7, "tile")
        .groupBy("tile")
        .agg(
            measures.row_count().alias("lines"),
            F.sum("l_quantity").alias("quantity"),
            F.sum("l_orderkey").alias("order_keys"),
        )
    )


# --- fact, retention, marts ----------------------------------------------------------------


@query
def fct_orders(spark, sf):
    return _fact(spark, sf)


@query
def next_after_delivery(spark, sf):
    return _retention(spark, sf).select("customer_unique_id", "next_order_at")


@query
def first_order_retention(spark, sf):
    return _retention(spark, sf)


@query
def retention_long_window(spark, sf):
    return _retention(spark, sf, LONG_WINDOW).select(
        "customer_unique_id", "order_id", "next_order_at", "days_to_next_order",
        "repeat_in_window", "is_mature",
    )


def _lateness(spark, sf):
    # Read twice, for reviews and for retention: store the few columns both need.
    fact = scratch_table(
        _fact(spark, sf).select(
            "order_id", "customer_unique_id", "purchased_at", "delivered_at", "lateness_bucket",
            "review_score", "is_negative_review",
        ),
        "fct_orders",
    )
    return marts.mart_lateness(fact, _retention(spark, sf, fact=fact))


@query
def mart_lateness(spark, sf):
    return _lateness(spark, sf)


@query
def late_vs_ontime(spark, sf):
    return marts.mart_late_vs_ontime(_fact(spark, sf))


@query
def retention_late_vs_ontime(spark, sf):
    return marts.mart_retention_late_vs_ontime(_retention(spark, sf))


@query
def mart_state(spark, sf):
    return marts.mart_state(_fact(spark, sf))


@query
def mart_seller(spark, sf):
    return marts.mart_seller(_fact(spark, sf), PARAMS)


@query
def mart_monthly(spark, sf):
    return marts.mart_monthly(_fact(spark, sf))


@query
def mart_distance(spark, sf):
    return marts.mart_distance(_fact(spark, sf))


def _raw_zone(spark, sf) -> str:
    """All nine raw inputs as folders of gzipped CSV files."""
    zone = scratch_path(spark, "raw")
    for name, frame in derive.raw_text(spark, sf).items():
        extracts.write_csv(frame, f"{zone}/{raw.RAW_INPUTS[name]}", compression="gzip")
    return zone


@query
def job_distance_extract(spark, sf):
    """The whole job from raw CSV files, and one of its extracts read back."""
    zone, out = _raw_zone(spark, sf), scratch_path(spark, "out")
    tables = job.run_pipeline(spark, zone, out, PARAMS)
    return extracts.read_csv_as(
        spark, f"{out}/extracts/distance.csv", tables["mart_distance"]
    )


@query
def job_extracts(spark, sf):
    """The whole job, and every figure of its seven mart extracts read back: a row per figure."""
    zone, out = _raw_zone(spark, sf), scratch_path(spark, "out")
    tables = job.run_pipeline(spark, zone, out, PARAMS)
    figures = []
    for name, (table, _) in extracts.EXTRACTS.items():
        if table != "fct_orders":
            mart = extracts.read_csv_as(spark, f"{out}/extracts/{name}.csv", tables[table])
            item, *rest = [c for c in mart.columns if c != "seller_state"]
            values = {c: F.col(c).cast("double") for c in rest}
            values |= {c: F.rint(values[c] * 1e2) / 1e2 for c in CENTS if c in values}
            long = mart.select(F.col(item).cast("string"), *[v.alias(c) for c, v in values.items()])
            figures.append(
                long.unpivot(item, rest, "figure", "value").select(
                    F.lit(name).alias("extract"), F.col(item).alias("item"), "figure", "value"
                )
            )
    return reduce(DataFrame.union, figures)


@query
def job_orders_extract(spark, sf):
    """The orders extract of the job's newest version of the tables, read back from CSV."""
    zone, out = _raw_zone(spark, sf), scratch_path(spark, "out")
    job.run_pipeline(spark, zone, out, PARAMS)
    stored = extracts.extract_orders(snapshots.read_tables(spark, f"{out}/tables")["fct_orders"])
    orders = extracts.read_csv_as(spark, f"{out}/extracts/orders.csv", stored)
    # Ids are text in raw files.
    return orders.withColumns({c: F.col(c).cast("bigint") for c in ("order_id", "main_seller_id")})


# --- quality, statistics, report, dashboard, charts ----------------------------------------


def _report(spark, sf):
    t = derive.typed(spark, sf)
    fact = scratch_table(
        facts.build_fct_orders(t).select(
            "order_id", "customer_unique_id", "purchased_at", "delivered_at", "distance_km"
        ),
        "fct_orders",
    )
    return quality.run_checks(t, fact, _retention(spark, sf, fact=fact))


@query
def quality_checks(spark, sf):
    return _report(spark, sf)


@query
def quality_gate(spark, sf):
    """Raises when a check fails; on these tables all pass."""
    report_once = scratch_table(_report(spark, sf), "quality_checks")
    return quality.gate(report_once).agg(F.sum("failing_rows").alias("failing_rows"))


@query
def quality_report_file(spark, sf):
    """The report as the job leaves it, a CSV file, read back."""
    report = scratch_table(_report(spark, sf), "quality_checks")
    path = extracts.write_csv(report, scratch_path(spark, "quality_checks.csv"), single_file=True)
    return extracts.read_csv_as(spark, path, report)


@query
def statistic_file(spark, sf):
    """The test's statistic as the job leaves it, a JSON file, read back."""
    mart = marts.mart_retention_late_vs_ontime(_retention(spark, sf))
    test = scratch_table(proportions.retention_test(mart).drop("p_value"), "retention_test")
    path = extracts.write_json(test, scratch_path(spark, "retention_test.json"))
    return extracts.read_json_as(spark, path, test)


@query
def extract_order(spark, sf):
    """The state extract read back, with the number of each line in its file."""
    mart = scratch_table(marts.mart_state(_fact(spark, sf)), "mart_state")
    ordered = extracts.in_order(mart, "late_rank", True, single_file=True)
    path = extracts.write_csv(ordered, scratch_path(spark, "state.csv"))
    # One file, read by one task from its first line on.
    lines = extracts.read_csv_as(spark, path, mart).coalesce(1)
    return lines.select(
        (F.monotonically_increasing_id() + 1).alias("line"), "customer_state", "late_rank", "orders"
    )


@query
def chart_order(spark, sf):
    """The state chart's bars with their places, the lowest late rate first."""
    bars = charts.chart_states(marts.mart_state(_fact(spark, sf)), 1).coalesce(1)
    return bars.select((F.monotonically_increasing_id() + 1).alias("place"), "customer_state")


@query
def ztest_late_vs_ontime(spark, sf):
    mart = marts.mart_retention_late_vs_ontime(_retention(spark, sf))
    return proportions.retention_test(mart).drop("p_value")


@query
def ztest_by_segment(spark, sf):
    return proportions.retention_test_by(_retention(spark, sf), "customer_state").drop("p_value")


@query
def ztest_p_value(spark, sf):
    """Significance per state; no SQL engine here has the error function."""
    tested = proportions.retention_test_by(_retention(spark, sf), "customer_state")
    return tested.select("customer_state", "z", "p_value")


@query
def report_totals(spark, sf):
    return report.report_totals(_fact(spark, sf))


@query
def report_headline(spark, sf):
    return report.report_headline(marts.mart_late_vs_ontime(_fact(spark, sf)))


@query
def report_states(spark, sf):
    return report.report_states(marts.mart_state(_fact(spark, sf)))


@query
def report_distance(spark, sf):
    return report.report_distance(marts.mart_distance(_fact(spark, sf)))


@query
def report_seller_deciles(spark, sf):
    return report.report_seller_deciles(marts.mart_seller(_fact(spark, sf), PARAMS))


@query
def report_decile_ends(spark, sf):
    deciles = report.report_seller_deciles(marts.mart_seller(_fact(spark, sf), PARAMS))
    return report.report_decile_ends(deciles)


@query
def report_worst_months(spark, sf):
    return report.report_worst_months(marts.mart_monthly(_fact(spark, sf)), min_orders=100)


@query
def chart_reviews_by_lateness(spark, sf):
    return charts.chart_reviews_by_lateness(_lateness(spark, sf))


@query
def chart_retention_ci(spark, sf):
    mart = marts.mart_retention_late_vs_ontime(_retention(spark, sf))
    return charts.chart_retention_ci(proportions.retention_test(mart))


@query
def overall_late_rate(spark, sf):
    return charts.overall_late_rate(marts.mart_state(_fact(spark, sf)))


@query
def chart_states(spark, sf):
    return charts.chart_states(marts.mart_state(_fact(spark, sf)))


@query
def chart_distance(spark, sf):
    return charts.chart_distance(marts.mart_distance(_fact(spark, sf)))


@query
def chart_monthly(spark, sf):
    return charts.chart_monthly(marts.mart_monthly(_fact(spark, sf)), min_orders=100)


@query
def bi_kpis(spark, sf):
    """KPIs per lateness label, under all three dashboard filters."""
    return bi.bi_kpis(
        _fact(spark, sf),
        "lateness_label",
        months=(dt.date(1995, 1, 1), dt.date(1997, 12, 1)),
        states=["NATION_1", "NATION_2", "NATION_3", "NATION_5", "NATION_8", "NATION_13"],
        categories=["economy", "promo", "LARGE", "unknown"],
    )


@query
def top_sellers(spark, sf):
    return bi.top_sellers(marts.mart_seller(_fact(spark, sf), PARAMS), 10)
