import datetime as dt

import duckdb
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from waybill.sources import snapshots, staging
from waybill.sources.extracts import read_csv_as, write_csv
from waybill.sources.raw import read_raw
from waybill.sources.storage import scratch_table, shared_folder, write_table

CSV = (
    "﻿id,note,n\r\n"
    '1,"said ""hi"", left\n  then came back",3\r\n'
    '2,"",\r\n'
    "3,plain , 4 \r\n"
    '4,"a,b",2.5\r\n'
)


def test_csv_scan_reads_text_like_an_independent_reader(spark, tmp_path):
    path = tmp_path / "notes.csv"
    path.write_text(CSV, encoding="utf-8", newline="")
    got = [tuple(r) for r in read_raw(spark, str(path), multi_line=True).collect()]
    want = duckdb.execute(
        f"SELECT * FROM read_csv('{path}', header = true, all_varchar = true)"
    ).fetchall()
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert got[0] == ("1", 'said "hi", left\n  then came back', "3")


@pytest.mark.parametrize("text", ["3", " 3 ", "3.0", "3.7", "2.5", "-2.5", "1e2", None])
def test_whole_numbers_round_like_the_strict_sql_cast(spark, text):
    raw = spark.createDataFrame(
        [("o", text, "p", "s", "1.5", "2")],
        "order_id string, order_item_id string, product_id string, seller_id string, "
        "price string, freight_value string",
    )
    want = duckdb.execute("SELECT CAST(? AS INTEGER)", [text]).fetchone()[0]
    assert staging.stage_order_items(raw).first().order_item_id == want


@pytest.mark.parametrize("column", ["price", "order_item_id"])
def test_unreadable_numbers_stop_the_job(spark, column):
    raw = spark.createDataFrame(
        [("o", "1", "p", "s", "1.5", "2")],
        "order_id string, order_item_id string, product_id string, seller_id string, "
        "price string, freight_value string",
    ).withColumn(column, F.lit("n/a"))
    with pytest.raises(PySparkException):
        staging.stage_order_items(raw).collect()


def test_columns_bind_by_name_whatever_their_order(spark, tmp_path):
    path = tmp_path / "sellers.csv"
    path.write_text("seller_state,seller_id,seller_city,seller_zip_code_prefix\nXX,s1,town,42\n")
    row = staging.stage_sellers(read_raw(spark, str(path))).first()
    assert tuple(row) == ("s1", "00042", "town", "XX")


def test_partitioned_table_keeps_column_order_and_refreshes(spark, tmp_path):
    path = str(tmp_path / "t")
    for day in (1, 2):
        df = spark.createDataFrame(
            [(dt.date(2020, 1, day), "a"), (dt.date(2020, 2, day), "b")], "month date, v string"
        )
        stored = write_table(df, path, partition_by="month")
    assert stored.columns == ["month", "v"]
    assert sorted(r.month for r in stored.collect()) == [dt.date(2020, 1, 2), dt.date(2020, 2, 2)]


def test_csv_extract_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [
            (" a,b  ", 1, 1e-7, True, dt.date(2020, 1, 2), dt.datetime(2020, 1, 2, 3, 4, 5)),
            ('q"q', None, None, None, None, None),
        ],
        "s string, n bigint, x double, f boolean, d date, t timestamp_ntz",
    )
    path = write_csv(df, str(tmp_path / "x.csv"), single_file=True)
    assert sorted(read_csv_as(spark, path, df).collect()) == sorted(df.collect())


def test_raw_inputs_may_be_compressed(spark, tmp_path):
    df = spark.createDataFrame([('said "a,b"', "1"), ("two\nlines", None)], "note string, n string")
    path = write_csv(df, str(tmp_path / "reviews_dataset.csv"), compression="gzip")
    assert list((tmp_path / "reviews_dataset.csv").glob("*.csv.gz"))
    assert sorted(read_raw(spark, path, multi_line=True).collect()) == sorted(df.collect())


def test_tables_are_written_with_zstd(spark, tmp_path):
    parted = write_table(spark.range(9).selectExpr("id", "id % 2 AS half"), str(tmp_path / "p"), partition_by="half")
    for stored in (scratch_table(spark.range(3), "z"), write_table(spark.range(3), str(tmp_path / "t")), parted):
        assert all(name.endswith(".zstd.parquet") for name in stored.inputFiles())


def test_scratch_tables_live_in_the_folder_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    stored = scratch_table(spark.range(3), "r")
    assert stored.inputFiles()[0].startswith(f"file://{shared_folder(spark)}/r-")


@pytest.mark.parametrize(
    "second, stops",
    [("b,a\n1,2\n", True), ("a,b\n1\n", True), ("a,b\n1,2,3\n", True), ("a,b\n1,\n", False)],
    ids=["other header", "short row", "long row", "empty field"],
)
def test_part_files_must_agree(spark, tmp_path, second, stops):
    folder = tmp_path / "orders_dataset.csv"
    folder.mkdir()
    (folder / "part-1.csv").write_text("a,b\nx,y\n")
    (folder / "part-2.csv").write_text(second)
    read = read_raw(spark, str(folder))
    if stops:
        # Also when only one column is asked for.
        for frame in (read, read.select("b")):
            with pytest.raises(Exception):
                frame.collect()
    else:
        assert sorted(map(str, read.collect())) == ["Row(a='1', b=None)", "Row(a='x', b='y')"]


def _stored(spark, root, version=None):
    frame = snapshots.read_tables(spark, root, version)["t"]
    return sorted(tuple(r) for r in frame.collect())


def test_a_refresh_is_seen_whole_or_not_at_all(spark, tmp_path):
    root = str(tmp_path / "tables")
    with pytest.raises(FileNotFoundError):
        snapshots.read_tables(spark, root)
    first = snapshots.Refresh(spark, root)
    first.write("t", spark.createDataFrame([(1, "a"), (2, "b")], "n bigint, month string"), "n")
    assert snapshots.versions(spark, root) == []
    assert first.commit() == 1

    @F.udf("bigint")
    def dies(n):
        if n == 9:
            raise RuntimeError("lost in the middle")
        return n

    second = snapshots.Refresh(spark, root)
    second.write("u", spark.range(3))
    with pytest.raises(PySparkException):
        second.write("t", spark.range(10).repartition(5).select(dies("id").alias("n")))
    assert snapshots.versions(spark, root) == [1]
    assert _stored(spark, root) == [(1, "a"), (2, "b")]
    assert snapshots.read_tables(spark, root)["t"].columns == ["n", "month"]


def test_versions_roll_back_and_are_cleaned_up(spark, tmp_path):
    root = str(tmp_path / "tables")
    for n in range(3):
        refresh = snapshots.Refresh(spark, root)
        refresh.write("t", spark.createDataFrame([(n,)], "n bigint"))
        assert refresh.commit() == n + 1
    assert _stored(spark, root) == [(2,)] and _stored(spark, root, 1) == [(0,)]
    old = snapshots.read_tables(spark, root, 2)["t"]
    assert snapshots.roll_back(spark, root, 1) == 4
    assert _stored(spark, root) == [(0,)]
    lost = snapshots.Refresh(spark, root)
    lost.write("t", spark.range(1))
    # Young data stays, whether a commit names it or not.
    assert snapshots.clean_up(spark, root, keep=2) == []
    assert snapshots.versions(spark, root) == [3, 4]
    assert [r.n for r in old.collect()] == [1]
    assert len(snapshots.clean_up(spark, root, keep=2, min_age_hours=0)) == 2
    assert _stored(spark, root, 3) == [(2,)] and _stored(spark, root, 4) == [(0,)]
    with pytest.raises(FileNotFoundError):
        snapshots.read_tables(spark, root, 2)


def test_a_commit_number_taken_by_another_run_is_not_overwritten(spark, tmp_path):
    folder = snapshots.Folder(spark, str(tmp_path / "tables"))
    assert folder.write_new("commits/0000000001.json", "mine")
    assert not folder.write_new("commits/0000000001.json", "theirs")
    assert folder.read("commits/0000000001.json") == "mine"
    assert folder.names("commits") == ["0000000001.json"]
