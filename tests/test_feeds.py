from pathlib import Path

import pytest

from pyspark.sql import functions as F
from tidegate.operators import feeds as X
from tidegate.session import scratch_path
from tidegate.sources.readers import read_with_header_repair


def _plain_feed_name(name):
    tokens = Path(name).stem.split("_")
    return "_".join(tokens[:-1] if tokens[-1].isdigit() else tokens)


NAMES = ["a_1_20.txt", "123.csv", "a_.csv", "noext", ".hidden", "x_20240101.tar.gz", "a_b.c_9.csv", "_7.csv", "a__5", "5"]


def test_feed_name(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "f string")
    got = {r["f"]: r["n"] for r in df.withColumn("n", X.feed_name(F.col("f"))).collect()}
    assert got == {n: _plain_feed_name(n) for n in NAMES}


@pytest.mark.parametrize(
    "names, want",
    [
        (["20240131", "abc", "202401300930"], "20240131"),
        (["20240131", "202401311530"], "202401311530"),
        (["202401310000"], "20240131"),
        (["abc", "2024", "20241399"], None),
        ([], None),
    ],
)
def test_latest_batch(spark, names, want):
    df = spark.createDataFrame([(n,) for n in names], "name string")
    assert X.latest_batch(df).first()["batch"] == want


@pytest.mark.parametrize(
    "pattern, names, want",
    [
        ("f_YYYYMMDD.csv", ["f_20240201.csv", "f_20240101.csv", "g_20240201.csv", "f_x.csv"], [2, 1, 2, None]),
        ("f_MMDDYYYY.csv", ["f_02012023.csv", "f_01012024.csv"], [1, 2]),
        ("f_MmmYyy.csv", ["f_M01Y24.csv", "f_M12Y99.csv", "f_M11Y68.csv"], [2, 1, 3]),
        ("f_Www.csv", ["f_W52.csv", "f_W03.csv", "f_W60.csv"], [2, 1, None]),
        ("f.csv", ["a", "b"], [1, 1]),
    ],
)
def test_file_batch_order(spark, pattern, names, want):
    df = spark.createDataFrame([(n,) for n in names], "file_name string")
    got = {r["file_name"]: r["batch_order"] for r in X.file_batch_order(df, pattern).collect()}
    assert [got[n] for n in names] == want
    single = X.file_batch_order(df, pattern, multiple=False).collect()
    assert {r["batch_order"] for r in single} == {1}


def test_field_count_ignores_quoted_separators(spark):
    df = spark.createDataFrame([('a||"b||c"||d',), ("a||b",), ("",)], "value string")
    assert [r[0] for r in df.select(X.field_count(F.col("value"), "||")).collect()] == [3, 2, 1]


def test_header_repair_threshold(spark):
    columns = ["a", "b", "c", "d", "e"]
    folder = Path(scratch_path(spark, "headers").replace("file:", ""))
    folder.mkdir(parents=True)
    (folder / "kept.csv").write_text("a,b,X,Y,Z\n1,2,3,4,5\n")  # 3 unknown names: still a header
    (folder / "added.csv").write_text("a,W,X,Y,Z\n6,7,8,9,10\n")  # 4 unknown names: data
    got = sorted(tuple(r) for r in read_with_header_repair(spark, str(folder), columns).collect())
    assert got == [("1", "2", "3", "4", "5"), ("6", "7", "8", "9", "10"), ("a", "W", "X", "Y", "Z")]


def test_misfit_names_are_refused(spark):
    files = spark.createDataFrame([("a_20240131.csv",), ("a_oops.csv",)], "file_name string")
    ordered = X.file_batch_order(files, "a_YYYYMMDD.csv")
    assert [r["file_name"] for r in X.misfit_names(ordered).collect()] == ["a_oops.csv"]
    with pytest.raises(Exception, match="a_oops.csv"):
        X.assign_ids(ordered, 1, 1).collect()


def test_every_missing_feed_is_named(spark):
    config = spark.createDataFrame([(f"feed{i}", "Y") for i in range(150)], "feed string, mandatory_flag string")
    with pytest.raises(ValueError) as problem:
        X.require_feeds(spark.createDataFrame([], "file_name string"), config)
    assert str(problem.value).count("feed") >= 150


def test_header_with_bars(spark):
    headers = spark.createDataFrame([("f", 1, 'A|"B"')], "file_name string, dataset_id int, header string")
    metadata = spark.createDataFrame([(1, 1, "A", "Y"), (1, 2, "B", "Y")], "dataset_id int, column_sequence_number int, source_column_name string, header_flag string")
    assert X.header_mismatch(headers, metadata, "|").count() == 0


def test_require_feeds(spark):
    listing = spark.createDataFrame([("a_1.csv",)], "file_name string")
    config = spark.createDataFrame([("a", "Y"), ("b", "Y"), ("c", "N")], "feed string, mandatory_flag string")
    with pytest.raises(ValueError, match="b"):
        X.require_feeds(listing, config)
    X.require_feeds(listing, config.filter("feed <> 'b'"))


def test_backfill_without_archive(spark):
    missing = spark.createDataFrame([("a", "N")], "feed string, cleanup_flag string")
    copied, left = X.backfill(missing, spark.createDataFrame([], "batch string, file_name string"))
    assert copied.count() == 0 and left.count() == 1


def test_needs_run(spark):
    files = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d")], "batch_id int, file_name string")
    log = spark.createDataFrame(
        [(1, "a", "s", "SUCCEEDED"), (2, "c", "s", "SUCCEEDED"), (3, "d", "s", "FAILED"), (1, "b", "other", "SUCCEEDED")],
        "batch_id int, file_name string, step string, status string",
    )
    got = {r["batch_id"]: r["needs_run"] for r in X.needs_run(files, log, "s").collect()}
    assert got == {1: True, 2: False, 3: True}


def test_nothing_pending(spark):
    empty = spark.createDataFrame([], "file_name string")
    assert X.pending_or_skip(empty, True)[1] == X.SKIPPED
    with pytest.raises(X.NothingToDo):
        X.pending_or_skip(empty, False)
    assert X.pending_or_skip(spark.createDataFrame([("a",)], "file_name string"), False)[1] == X.RUNNING


def test_lineage_needs_both_columns(spark):
    rows = spark.createDataFrame([("a.csv", 1)], "file_name string, x int")
    ids = spark.createDataFrame([("a.csv", 9)], "file_name string, file_id bigint")
    assert X.tag_lineage(rows, 5, ids, configured=["x", "BATCH_ID"]).columns == ["file_name", "x"]
    tagged = X.tag_lineage(rows, 5, ids, configured=["BATCH_ID", "file_id"]).first()
    assert (tagged["batch_id"], tagged["file_id"]) == (5, 9)
