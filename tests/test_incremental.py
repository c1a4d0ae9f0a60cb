"""Loads, landings and upserts that are repeated after a crash."""

import pytest

from pyspark.sql import functions as F
from tidegate.operators.dimensions import upsert_rows
from tidegate.session import folders_of, scratch_path
from tidegate.streaming import bucketed_table as B
from tidegate.streaming import incremental as I

ROWS = "k int, at timestamp, v string"


def _rows(spark, *ks, day=1):
    return spark.createDataFrame([(k, f"2024-01-{day:02d} 00:00:0{k % 10}", f"v{k}") for k in ks], "k int, at string, v string").withColumn("at", F.col("at").cast("timestamp"))


def _keys(df):
    return sorted(r.k for r in df.collect())


@pytest.mark.parametrize("keys", [(), ("k",)])
@pytest.mark.parametrize("crash", ["before the log row", "after the log row"])
@pytest.mark.parametrize("done", [0, 1, 2])
def test_a_repeated_load_gives_each_row_once(spark, monkeypatch, keys, crash, done):
    path, log = scratch_path(spark, "t"), scratch_path(spark, "log")
    loads = [_rows(spark, 1, 2), _rows(spark, 1, 2, 3), _rows(spark, 1, 2, 3, 4, 5)]
    for source in loads[:done]:
        I.incremental_load(source, "at", path, log, keys)
    if crash == "after the log row":
        I.incremental_load(loads[done], "at", path, log, keys)
    else:
        with monkeypatch.context() as m, pytest.raises(RuntimeError):
            m.setattr(F, "current_timestamp", lambda: (_ for _ in ()).throw(RuntimeError("killed")))
            I.incremental_load(loads[done], "at", path, log, keys)
        known = I.loaded_rows(spark, path, log, loads[0].schema)
        assert _keys(known) == ([] if not done else _keys(loads[done - 1]))  # readers see finished runs only
    marks = [I.incremental_load(source, "at", path, log, keys) for source in loads[done:]]
    assert _keys(I.loaded_rows(spark, path, log, loads[0].schema)) == [1, 2, 3, 4, 5]
    assert marks == sorted(marks) and marks[-1] == loads[-1].agg(F.max("at")).first()[0]


def test_the_mark_never_goes_back(spark):
    path, log = scratch_path(spark, "t"), scratch_path(spark, "log")
    top = I.incremental_load(_rows(spark, 1, 9), "at", path, log)
    assert I.incremental_load(_rows(spark, 3), "at", path, log) == top
    assert I.incremental_load(_rows(spark, 3).limit(0), "at", path, log) == top
    runs = I.committed_runs(spark, path, log).orderBy("run").collect()
    assert [(r.run, r.rows) for r in runs] == [(1, 2), (2, 0), (3, 0)] and len({r.current_max for r in runs}) == 1


@pytest.mark.parametrize("kind", ["date", "bigint", "string", "decimal(12,3)", "timestamp_ntz"])
def test_marks_keep_their_type(spark, kind):
    path, log = scratch_path(spark, "t"), scratch_path(spark, "log")
    text = {"bigint": ["7", "12"], "decimal(12,3)": ["7.125", "12.5"]}.get(kind, ["2024-01-02", "2024-11-30"])
    df = spark.createDataFrame([(i, t) for i, t in enumerate(text)], "k int, at string").withColumn("at", F.col("at").cast(kind))
    assert I.incremental_load(df.filter("k = 0"), "at", path, log) == df.filter("k = 0").first().at
    assert I.incremental_load(df, "at", path, log) == df.filter("k = 1").first().at
    assert _keys(I.loaded_rows(spark, path, log, df.schema)) == [0, 1]


def test_rows_without_a_value_are_loaded_once(spark):
    path, log = scratch_path(spark, "t"), scratch_path(spark, "log")
    df = spark.createDataFrame([(1, None, "a"), (2, None, "b")], "k int, at timestamp, v string")
    for source in (df.filter("k = 1"), df, df):
        assert I.incremental_load(source, "at", path, log, ["k"]) is None
    assert _keys(I.loaded_rows(spark, path, log, df.schema)) == [1, 2]


def _merge(new, held):
    return upsert_rows(new, held, ["k"])


def _table(df):
    return sorted((r.k, r.v) for r in df.collect())


def _data(spark, table):
    return {f"{w}/{b}" for w in folders_of(spark, f"{table}/data") for b in folders_of(spark, f"{table}/data/{w}")}


def test_only_touched_buckets_are_written(spark):
    table = scratch_path(spark, "t")
    rows = spark.range(5000).select(F.col("id").cast("int").alias("k"), F.lit("old").alias("v"))
    first = B.rewrite_buckets(rows, table, ["k"], _merge, 64)
    assert len(first.folders) == 64 == len(_data(spark, table))
    buckets = {r.b: r.k for r in rows.groupBy(B.bucket_of(["k"], 64).alias("b")).agg(F.min("k").alias("k")).collect()}
    changed = [buckets[3], buckets[40]]
    second = B.rewrite_buckets(rows.filter(F.col("k").isin(changed)).withColumn("v", F.lit("new")), table, ["k"], _merge)
    moved = {b for b in second.folders if second.folders[b] != first.folders[b]}
    assert moved == {"3", "40"} and len(_data(spark, table)) == 66
    got = B.read_version(spark, table)
    assert got.count() == 5000 and _keys(got.filter("v = 'new'")) == sorted(changed)
    assert got.select("k").distinct().count() == 5000
    assert B.read_version(spark, table, 0).filter("v = 'new'").count() == 0
    assert {r.b for r in B.read_version(spark, table, buckets=[3, 40]).select(B.bucket_of(["k"], 64).alias("b")).collect()} == {3, 40}


def test_a_crash_before_the_manifest_leaves_the_old_version(spark, monkeypatch):
    table = scratch_path(spark, "t")
    df = spark.createDataFrame([(1, "a"), (None, "n"), (3, "c")], "k int, v string")
    B.rewrite_buckets(df, table, ["k"], _merge, 8)
    new = spark.createDataFrame([(1, "A"), (None, "N"), (4, "D")], "k int, v string")
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(B, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        B.rewrite_buckets(new, table, ["k"], _merge)
    assert sorted(map(str, _table_of(B.read_version(spark, table)))) == sorted(map(str, _table_of(df)))
    # So does one that dies while the manifest is written, under its temporary name.
    place, fs = B._folder(spark, f"{table}/manifest/.half")
    fs.create(place, False).close()
    assert B.versions(spark, table) == [0]
    done = B.rewrite_buckets(new, table, ["k"], _merge)
    assert done.number == 1 and done.buckets == 8
    rows = {r.k: r.v for r in B.read_version(spark, table).collect()}
    assert rows == {1: "A", None: "N", 3: "c", 4: "D"}
    named = {f.removeprefix("data/") for n in (0, 1) for f in B.version(spark, table, n).folders.values()}
    assert _data(spark, table) == named  # what the dead attempt wrote is gone


def _table_of(df):
    return [(r.k, r.v) for r in df.collect()]


def test_retention_follows_the_manifests(spark):
    table = scratch_path(spark, "t")
    for i in range(5):
        B.rewrite_buckets(spark.createDataFrame([(i % 2, f"v{i}")], "k int, v string"), table, ["k"], _merge, 4, f"b{i}", i, keep=2)
    assert B.versions(spark, table) == [3, 4] and B.version(spark, table).stamp == 4
    assert _table(B.read_version(spark, table)) == [(0, "v4"), (1, "v3")] and _table(B.read_version(spark, table, 3)) == [(0, "v2"), (1, "v3")]
    named = {f.removeprefix("data/") for n in (3, 4) for f in B.version(spark, table, n).folders.values()}
    assert _data(spark, table) == named
    again = B.rewrite_buckets(spark.createDataFrame([(7, "x")], "k int, v string"), table, ["k"], _merge, 4, "b4")
    assert again.number == 4  # the batch that made the newest version is not applied twice
    with pytest.raises(ValueError):
        B.rewrite_buckets(spark.createDataFrame([(7, "x")], "k int, v string"), table, ["v"], _merge)
    with pytest.raises(ValueError):
        B.read_version(spark, table, 0)
    with pytest.raises(RuntimeError, match="another writer"):
        B.commit(spark, table, again)


def test_an_empty_batch_and_an_empty_table(spark):
    table = scratch_path(spark, "t")
    none = spark.createDataFrame([], "k int, v string")
    with pytest.raises(ValueError):
        B.read_version(spark, table)
    B.rewrite_buckets(none, table, ["k"], _merge)
    assert B.read_version(spark, table).columns == ["k", "v"] and B.read_version(spark, table).count() == 0
    B.rewrite_buckets(spark.createDataFrame([(1, "a")], "k int, v string"), table, ["k"], _merge)
    B.rewrite_buckets(none, table, ["k"], _merge)
    assert _table(B.read_version(spark, table)) == [(1, "a")]


RULES = [{"column_name": "v", "function_name": "trim", "function_params": None}]
CHECKS = [{"rule_id": "v", "column": "v", "check": "not_null", "severity": "critical"}]


def test_a_repeated_batch_has_equal_ids_and_one_audit_row(spark, monkeypatch):
    source, target, errors, bookmark = (scratch_path(spark, n) for n in ("in", "out", "errors", "bookmark"))
    audit = f"{bookmark}_audit"
    schema = spark.createDataFrame([], "k int, v string").schema

    def arrive(*rows):
        spark.createDataFrame(list(rows), schema).repartition(3).write.mode("append").parquet(source)
        return I.file_stream(spark, source, schema)

    def land(stream):
        I.stream_landing(stream, target, errors, bookmark, RULES, CHECKS, ["k"])

    land(arrive((1, " a"), (2, None), (3, "c ")))
    first = {r.file_name: r.file_id for r in I.landing_files(spark, audit).collect()}
    assert sorted(first.values()) == list(range(1, len(first) + 1)) and sorted(first) == sorted(first, key=first.get)
    whole = spark.createDataFrame([], "k int, v string, file_name string, file_id bigint, row_id string").schema
    # The next batch dies after its rows were written, before its audit row.
    keep = I._audit_batch
    calls = []

    def dies(spark_, audit_, at, values):
        calls.append(values[0])
        if values[0] == "SUCCEEDED":
            raise RuntimeError("killed")
        keep(spark_, audit_, at, values)

    stream = arrive((4, "d"), (5, None), (6, "f"))
    with monkeypatch.context() as m, pytest.raises(Exception):
        m.setattr(I, "_audit_batch", dies)
        land(stream)
    assert calls == ["SUCCEEDED", "FAILED"]
    assert _keys(I.landed_rows(spark, target, audit, whole)) == [1, 3]
    assert {r.batch_id: r.status for r in I.landing_audit(spark, audit).collect()} == {0: "SUCCEEDED", 1: "FAILED"}
    before = {r.file_name: r.file_id for r in spark.read.parquet(f"{audit}/files/batch_id=1").collect()}
    land(I.file_stream(spark, source, schema))
    rows = I.landed_rows(spark, target, audit, whole).collect()
    assert sorted(r.k for r in rows) == [1, 3, 4, 6]
    ids = {r.file_name: r.file_id for r in I.landing_files(spark, audit).collect()}
    assert {k: v for k, v in ids.items() if k in before} == before and sorted(ids.values()) == list(range(1, len(ids) + 1))
    assert all(ids[r.file_name] == r.file_id for r in rows)
    log = {r.batch_id: (r.status, r.files, r.rows_read, r.rows_landed, r.rows_rejected) for r in I.landing_audit(spark, audit).collect()}
    assert log == {0: ("SUCCEEDED", len(first), 3, 2, 1), 1: ("SUCCEEDED", len(before), 3, 2, 1)}
    assert sum(r["rows_read"] for r in I.landing_files(spark, audit).collect()) == 6
