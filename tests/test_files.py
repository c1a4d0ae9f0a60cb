import os

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T
from tests.conftest import plan_of
from tidegate.plans.jobs import run_jobs
from tidegate.session import CHECKPOINT_CONF, scratch_path, shared_dir
from tidegate.sources import catalog as C
from tidegate.sources import readers as R
from tidegate.sources import writers as K


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get(CHECKPOINT_CONF).rstrip("/")
    assert scratch_path(spark, "x").startswith(shared_dir(spark))


def test_batch_rewrite_touches_one_batch(spark):
    root = scratch_path(spark, "t")
    df = spark.createDataFrame([(1, "f1"), (2, "f2")], "x int, file_id string")
    K.write_batch(df, root, 1)
    K.write_batch(df, root, 2)
    K.write_batch(df.filter("x = 1"), root, 2)
    counts = {r["batch_id"]: r["count"] for r in spark.read.parquet(root).groupBy("batch_id").count().collect()}
    assert counts == {1: 2, 2: 1}


def test_empty_publish(spark):
    empty = spark.createDataFrame([], "x int, file_id string")
    path = scratch_path(spark, "p")
    assert K.publish(empty, path, True) is False
    assert spark.read.parquet(path).columns == ["x", "file_id"]
    assert K.publish(empty, path + "2", False) is False
    assert not os.path.exists((path + "2").replace("file:", ""))
    full = spark.createDataFrame([(1, "f")], "x int, file_id string")
    for flag in (True, False):  # an empty batch replaces what was published there
        again = scratch_path(spark, "again")
        assert K.publish(full, again, flag) is True and K.publish(empty, again, flag) is False
        left = spark.read.parquet(again).count() if flag else int(os.path.exists(again.replace("file:", "")))
        assert left == 0


def test_single_text_file(spark):
    folder = scratch_path(spark, "out")
    df = spark.createDataFrame([("a", None, "d"), ("b|", " x ", "d")], "name string, note string, batch_date string")
    path = K.export_text(df, folder, "people", "2024-01-31", one_file=True)
    assert path.endswith("people_2024-01-31.txt")
    lines = open(path.replace("file:", ""), encoding="utf-8").read().splitlines()
    assert lines[0] == "NAME||NOTE" and sorted(lines[1:]) == ["a||", "b||| x "]
    K.export_text(df, folder, "people", "2024-01-31", one_file=True)


def test_single_file_holds_all_parts_behind_one_header(spark):
    path = K.export_text(spark.range(1000).repartition(7), scratch_path(spark, "big"), "n", "d", one_file=True)
    lines = open(path.replace("file:", "")).read().splitlines()
    assert lines[0] == "ID" and sorted(map(int, lines[1:])) == list(range(1000))
    plain = scratch_path(spark, "plain.csv")
    K.write_csv(spark.range(5), plain, one_file=True)
    assert sorted(open(plain.replace("file:", "")).read().split()) == ["0", "1", "2", "3", "4", "id"]


def test_backup_clears_what_is_excluded_or_gone(spark):
    source, out = scratch_path(spark, "src"), scratch_path(spark, "out")
    for name in ("a", "b", "c"):
        spark.range(3).write.parquet(f"{source}/{name}")
    tables = {n: f"{source}/{n}" for n in ("a", "b", "c")}
    K.backup_tables(spark, tables, out, "d1")
    K.backup_tables(spark, {n: tables[n] for n in ("a", "b")}, out, "d2", exclude=["B"])
    assert sorted(os.listdir(f"{out}/latest".replace("file:", ""))) == ["a"]
    assert spark.read.parquet(f"{out}/archive/d1/c").count() == 3


def test_names():
    assert K.table_name("Fact-Job-Events") == "fact_job_events"
    assert K.partition_name("batch-id") == "pt_batchid" and K.partition_name("pt_x") == "pt_x"


def test_column_types_per_step():
    meta = [
        {"column_name": "_b", "column_data_type": "int", "column_sequence_number": 2},
        {"column_name": "PT_FILE_ID", "column_data_type": "int", "column_sequence_number": 3},
        {"column_name": "a", "column_data_type": "date", "column_sequence_number": 1},
    ]
    assert C.column_ddl(meta, "landing") == {"a": "string", "_b": "string"}
    assert C.column_ddl(meta, "staging") == {"a": "date", "_b": "int"}
    with pytest.raises(ValueError):
        C.column_ddl(meta, "nowhere")


def test_job_failure_is_audited(spark):
    audit = scratch_path(spark, "audit")
    config = {"jobs": [{"name": "ok", "transforms": [{"view": "one", "sql": "SELECT 1 AS x"}]},
                       {"name": "broken", "transforms": [{"sql": "SELECT * FROM \"no\" such"}]}]}
    with pytest.raises(Exception):
        run_jobs(spark, config, "20240131", audit)
    got = {r["job"]: r["status"] for r in spark.read.parquet(audit).collect()}
    assert got == {"ok": "SUCCEEDED", "broken": "FAILED"}
    assert run_jobs(spark, {}, "20240131") == []


def test_graph_configuration_is_checked(spark):
    with pytest.raises(ValueError, match="startswith"):
        spark.createDataFrame([(1, "a")], "id int, node string").createOrReplaceTempView("v_test")
        spark.createDataFrame([(1, 1)], "src int, dst int").createOrReplaceTempView("e_test")
        run_jobs(spark, {"jobs": [{"name": "g", "transforms": [{"graph": {"vertices": "v_test", "edges": "e_test"}}]}]}, "d")


def test_batch_read_prunes_partitions(spark):
    path = scratch_path(spark, "parts")
    spark.range(10).withColumn("batch_id", F.col("id") % 2).write.partitionBy("batch_id").parquet(path)
    plan = plan_of(R.read_parquet(spark, path, batch=1))
    assert "PartitionFilters: [isnotnull(batch_id" in plan


def test_backup_excludes_prefixes(spark):
    src = scratch_path(spark, "src")
    spark.range(3).write.parquet(src)
    assert K.backup_tables(spark, {"Dim-A": src, "tmp-b": src}, scratch_path(spark, "b"), "d", exclude=["TMP"]) == ["Dim-A"]


def test_export_reads_back_everywhere(spark):
    path = K.export_text(spark.range(100).withColumn("t", F.lit("a b")), scratch_path(spark, "many"), "n", "d")
    back = R.read_delimited(spark, path, ["ID", "T"], sep="||")
    assert back.count() == 100 and back.filter("T = 'a b'").count() == 100


def test_json_names_in_any_case(spark):
    path = scratch_path(spark, "any_case")
    lines = ['{"A":1,"b":"x","N":{"k":1}}', "", '{"a":2.5,"B":null}', '[{"a":3},{"A":"4"}]', "not json", '{"B":{"z":[1,2]},"n":{"k":"7"},"other":1}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("any case", "reading")
    read = R.read_json_ignoring_case(spark, path, T.StructType.fromDDL("a int, B string, n struct<k:int>, gone date"))
    assert not jobs.getJobIdsForGroup("any case")  # nothing is inferred
    rows = read.collect()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert read.columns == ["a", "B", "n", "gone"]
    assert [(r.a, r.B, r.n and r.n.k, r.gone) for r in rows] == [
        (1, "x", 1, None), (2, None, None, None), (3, None, None, None), (4, None, None, None), (None, None, None, None), (None, '{"z":[1,2]}', 7, None),
    ]
