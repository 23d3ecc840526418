"""The batch job: raw files to tables, checks, test, extracts and summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from waybill.operators.proportions import retention_test
from waybill.operators.quality import gate, run_checks
from waybill.params import Params
from waybill.plans.facts import (
    build_fct_orders,
    customer_orders,
    customer_sequence,
    first_order_retention,
)
from waybill.plans.marts import build_marts
from waybill.plans.report import summary_lines
from waybill.sources.extracts import export_extracts, write_csv, write_json
from waybill.sources.raw import read_raw_zone
from waybill.sources.staging import stage_all
from waybill.sources.snapshots import Refresh, clean_up
from waybill.sources.storage import drop_scratch, scratch_mark


def build_tables(
    spark: SparkSession, raw_dir: str, refresh: Refresh, params: Params = Params()
) -> dict[str, DataFrame]:
    """Write the 8 staging tables, the fact, both customer tables and the 7 marts.

    Each stage reads the stored result of the one before, so its joins know real sizes, and the
    work of a lost executor is redone from files. Nothing is visible before the refresh is committed.
    """
    tables: dict[str, DataFrame] = {}

    def store(name: str, df: DataFrame, partition_by: str | None = None) -> None:
        tables[name] = refresh.write(name, df, partition_by)

    for name, df in stage_all(read_raw_zone(spark, raw_dir), params.box).items():
        store(name, df)
    # By month, so that the dashboard's month range reads only its own files.
    store("fct_orders", build_fct_orders(tables), partition_by="order_month")
    sequence = customer_sequence(tables, tables["fct_orders"])
    store("customer_orders", customer_orders(sequence))
    store(
        "first_order_retention",
        first_order_retention(sequence, tables["fct_orders"], tables["stg_orders"], params),
    )
    marts = build_marts(tables["fct_orders"], tables["first_order_retention"], params)
    for name, df in marts.items():
        store(name, df)
    return tables


def run_pipeline(
    spark: SparkSession, raw_dir: str, out_dir: str, params: Params = Params()
) -> dict[str, DataFrame]:
    """Everything, in order. The check report is written before a failing check stops the job.

    The tables become a new version under `<out>/tables` once they pass the checks; a run that fails
    leaves the version before it in place. Read them with `snapshots.read_tables`. Reports and
    extracts are written after that, from the new version.

    Every result is a written table, so scratch data is removed at the end, also when it fails.
    """
    mark = scratch_mark(spark)
    try:
        return _run(spark, raw_dir, out_dir, params)
    finally:
        drop_scratch(spark, mark)


def _run(
    spark: SparkSession, raw_dir: str, out_dir: str, params: Params
) -> dict[str, DataFrame]:
    out = out_dir.rstrip("/")
    refresh = Refresh(spark, f"{out}/tables")
    tables = build_tables(spark, raw_dir, refresh, params)
    report = run_checks(tables, tables["fct_orders"], tables["first_order_retention"])
    report = refresh.write("quality_checks", report)
    write_csv(report, f"{out}/quality_checks.csv", single_file=True)
    gate(report)
    test = refresh.write("retention_test", retention_test(tables["mart_retention_late_vs_ontime"]))
    refresh.commit()
    write_json(test, f"{out}/retention_test.json")
    export_extracts(tables, f"{out}/extracts")
    lines = summary_lines(tables, test, params.window_days, params.min_seller_orders)
    lines.coalesce(1).sortWithinPartitions("section", "position").select("line").write.mode(
        "overwrite"
    ).text(f"{out}/summary.txt")
    clean_up(spark, f"{out}/tables")
    return {**tables, "quality_checks": report, "retention_test": test}
