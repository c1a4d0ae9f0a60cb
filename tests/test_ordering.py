import random
from itertools import groupby

import pytest

from pyspark.sql import functions as F
from tests.conftest import plan_of
from tidegate.operators import ordering as W

CHUNKS = [1, 7, 90]


def _rows(seed, n=300, groups=4):
    rnd = random.Random(seed)
    # group 0 holds most rows
    return [(0 if rnd.random() < 0.6 else rnd.randrange(groups), i, rnd.choice("ab"), rnd.randrange(-50, 200)) for i in range(n)]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "g int, i int, v string, x int").repartition(5)


@pytest.mark.parametrize("size", CHUNKS)
def test_number_rows(spark, size):
    rows = _rows(1)
    got = W.number_rows(_frame(spark, rows), ["x", "i"], "n", 10, size).collect()
    want = {r[1]: n for n, r in enumerate(sorted(rows, key=lambda r: (r[3], r[1])), 10)}
    assert {r["i"]: r["n"] for r in got} == want


@pytest.mark.parametrize("size", CHUNKS)
def test_number_rows_with_null_keys(spark, size):
    df = spark.createDataFrame([(None, i) for i in range(20)] + [(f"k{i:02d}", i) for i in range(20)], "k string, i int")
    got = W.number_rows(df, ["k", "i"], "n", 1, size).orderBy("n").collect()
    assert [r["n"] for r in got] == list(range(1, 41))
    assert [r["k"] for r in got][:20] == [None] * 20 and got[-1]["k"] == "k19"


@pytest.mark.parametrize("size", CHUNKS)
def test_dense_rank(spark, size):
    rows = _rows(2)
    got = W.dense_rank_of(_frame(spark, rows), "x", "r", size).collect()
    ranks = {x: n for n, x in enumerate(sorted({r[3] for r in rows}), 1)}
    assert all(r["r"] == ranks[r["x"]] for r in got) and len(got) == len(rows)


def test_dense_rank_keeps_null(spark):
    df = spark.createDataFrame([(5,), (None,), (7,), (5,)], "x int")
    got = sorted(((r["x"], r["r"]) for r in W.dense_rank_of(df, "x", "r", 3).collect()), key=str)
    assert got == sorted([(5, 1), (5, 1), (7, 2), (None, None)], key=str)


@pytest.mark.parametrize("size", CHUNKS)
def test_with_previous(spark, size):
    rows = _rows(3)
    got = {r["i"]: r["p"]["x"] if r["p"] else None for r in W.with_previous(_frame(spark, rows), ["g"], ["i"], ["x"], "p", size).collect()}
    want, last = {}, {}
    for g, i, _, x in sorted(rows, key=lambda r: (r[0], r[1])):
        want[i] = last.get(g)
        last[g] = x
    assert got == want


@pytest.mark.parametrize("size", CHUNKS)
@pytest.mark.parametrize("value", ["v", "same"])
def test_run_lengths(spark, size, value):
    rows = _rows(4)
    df = _frame(spark, rows).withColumn("same", F.lit("one"))
    got = sorted((r["g"], r["i"], r[value], r["run_length"]) for r in W.run_lengths(df, ["g"], ["i"], value, size).collect())
    want = []
    for g, part in groupby(sorted(rows), key=lambda r: r[0]):
        for v, run in groupby(part, key=lambda r: r[2] if value == "v" else "one"):
            run = list(run)
            want.append((g, run[0][1], v, len(run)))
    assert got == sorted(want)


@pytest.mark.parametrize("size", CHUNKS)
def test_steps_and_gaps(spark, size):
    rows = _rows(5, 120)
    df = _frame(spark, rows)
    steps = {r["g"]: (r["step"], r["low"], r["high"]) for r in W.smallest_step(df, ["g"], "x", size).collect()}
    gaps = sorted((r["g"], r["missing"]) for r in W.missing_integers(df, ["g"], "x", size).collect())
    values = {}
    for g, _, _, x in rows:
        values.setdefault(g, set()).add(x)
    want_gaps = []
    for g, xs in values.items():
        o = sorted(xs)
        assert steps[g] == min((b - a, a, b) for a, b in zip(o, o[1:]))
        want_gaps += [(g, n) for n in range(o[0], o[-1]) if n not in xs]
    assert gaps == sorted(want_gaps)


def test_append_with_keys_from_empty(spark):
    empty = spark.createDataFrame([], "key string, name string")
    new = spark.createDataFrame([("b",), ("a",)], "name string")
    got = W.append_with_keys(empty, new, "key", ["name"], {}).collect()
    assert sorted((int(r["key"]), r["name"]) for r in got) == [(1, "a"), (2, "b")]


def test_keys_beyond_ten_digits(spark):
    old = spark.createDataFrame([("9999999999", "x")], "key string, name string")
    new = spark.createDataFrame([("b",), ("a",)], "name string")
    got = sorted((r["key"], r["name"]) for r in W.append_with_keys(old, new, "key", ["name"], {}).collect())
    assert got == [(9999999999, "x"), (10000000000, "a"), (10000000001, "b")]
    with pytest.raises(Exception, match="not a decimal"):
        W.append_with_keys(old, new, "key", ["name"], {}, key_type="decimal(10,0)").collect()
    with pytest.raises(Exception, match="not a bigint"):
        W.append_with_keys(old.withColumn("key", F.lit("x1")), new, "key", ["name"], {}).collect()


def test_a_gap_of_three_thousand_million_is_no_array(spark):
    gap = W.missing_integers(spark.createDataFrame([(1, 0), (1, 3_000_000_001)], "g int, x bigint"), ["g"], "x")
    assert sorted(r["missing"] for r in gap.filter("missing < 4 or missing > 2999999998").collect()) == [1, 2, 3, 2999999999, 3000000000]


def test_numbering_moves_no_table_to_one_task(spark):
    orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet").select("o_orderdate", "o_orderkey")
    plan = plan_of(W.number_rows(orders, ["o_orderdate", "o_orderkey"], chunks=15))
    # The rows are read as stored; only the chunk sizes (one row per chunk) are brought together.
    assert plan.count("SinglePartition") == 1 and "Sort" not in plan.split("BroadcastExchange")[0]


def test_chunks_are_ranges_of_a_hot_group(spark):
    df = spark.range(2000).select(F.lit(1).alias("g"), "id")
    stored = W.stored_in_order(df, ["g", "id"], 10)
    sizes = [r["count"] for r in stored.groupBy("__chunk").count().collect()]
    assert len(sizes) == 10 and max(sizes) < 600 and sum(sizes) == 2000
    ends = stored.groupBy("__chunk").agg(F.min("id").alias("a"), F.max("id").alias("b")).orderBy("__chunk").collect()
    assert all(x["b"] < y["a"] for x, y in zip(ends, ends[1:]))


@pytest.mark.parametrize("of", ["runs", "previous"])
def test_rows_are_exchanged_once(spark, monkeypatch, of):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), "id", (F.col("id") % 5 < 3).alias("v"))
    stored = []
    keep = W.store
    monkeypatch.setattr(W, "store", lambda d, name: stored.append(plan_of(d)) or keep(d, name))
    made = W.run_lengths(df, ["g"], ["id"], "v", 6) if of == "runs" else W.with_previous(df, ["g"], ["id"], ["id"], "p", 6)
    assert len(stored) == 1 and stored[0].count("rangepartitioning(") >= 1 and "hashpartitioning(" not in stored[0]
    # Afterwards only summaries of chunks are dealt by key: never the group or the order of rows.
    after = plan_of(made)
    assert "rangepartitioning(" not in after and "hashpartitioning(g" not in after


def test_runs_of_odd_values(spark):
    nan, rows = float("nan"), []
    for i, v in enumerate([None, None, nan, nan, 0.0, -0.0, 1.5, None, nan]):
        rows.append((None if i % 2 else None, i, v, [v] if v is not None else None))
    df = spark.createDataFrame(rows, "g int, i int, v double, a array<double>").repartition(4)
    for size in (1, 4, 20):
        got = sorted((r.i, r.run_length) for r in W.run_lengths(df, ["g"], ["i"], "v", size).collect())
        assert got == [(0, 2), (2, 2), (4, 2), (6, 1), (7, 1), (8, 1)]
    lists = spark.createDataFrame([(i, x) for i, x in enumerate([[1], [1], [2], None, None, [1, 2]])], "i int, a array<int>")
    assert sorted((r.i, r.run_length) for r in W.run_lengths(lists, [], ["i"], "a", 3).collect()) == [(0, 2), (2, 1), (3, 2), (5, 1)]
    assert W.run_lengths(df.limit(0), ["g"], ["i"], "v").count() == 0 and W.with_previous(df.limit(0), ["g"], ["i"], ["v"]).count() == 0


def test_one_run_over_many_chunks_and_batches(spark, monkeypatch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.range(300).select(F.lit(1).alias("g"), "id", (F.col("id") >= 250).alias("v"))
        assert sorted((r.id, r.run_length) for r in W.run_lengths(df, ["g"], ["id"], "v", 12).collect()) == [(0, 250), (250, 50)]
        prev = {r.id: r.p.id if r.p else None for r in W.with_previous(df, ["g"], ["id"], ["id"], "p", 12).collect()}
        assert prev == {i: i - 1 if i else None for i in range(300)}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
