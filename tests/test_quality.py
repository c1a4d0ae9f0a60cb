import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of, runs_python
from tidegate.operators import dimensions as D
from tidegate.operators import quality as M
from tidegate.operators import relational as R
from tidegate.session import scratch_path
from tidegate.sources.readers import read_parquet


@pytest.fixture(scope="module")
def feed(spark):
    return spark.createDataFrame([(1, "a", "5"), (2, None, "x"), (3, "a", None)], "row_id bigint, name string, n string")


def _rule(check, **more):
    return {"rule_id": check, "check": check, "column": "name", **more}


def test_row_rules_share_one_scan(feed):
    rules = [_rule("not_null"), _rule("range", column="n", min=0, max=9), _rule("in_list", values=["b"])]
    errors = M.dq_check(feed, rules)
    assert sorted((r["row_id"], r["rule_id"]) for r in errors.collect()) == [(1, "in_list"), (2, "not_null"), (2, "range"), (3, "in_list")]
    plan = plan_of(errors)
    assert plan.count("Scan") <= 2 and "Exchange" not in plan and not runs_python(plan)


def test_unique_and_referential(feed, spark):
    known = spark.createDataFrame([("5",)], "code string")
    rules = [_rule("unique"), _rule("referential", column="n", reference="codes", reference_column="code")]
    got = sorted((r["row_id"], r["rule_id"]) for r in M.dq_check(feed, rules, references={"codes": known}).collect())
    assert got == [(1, "unique"), (2, "referential"), (3, "unique")]


def test_no_rules_and_unknown_rule(feed):
    assert M.dq_check(feed, [], carry=["name"]).count() == 0
    with pytest.raises(ValueError):
        M.dq_check(feed, [_rule("guess")])


def test_filter(feed):
    errors = M.dq_check(feed, [_rule("not_null", severity="warning"), _rule("range", column="n", min=0, max=9)])
    assert sorted(r["row_id"] for r in M.dq_filter(feed, errors).collect()) == [1, 3]
    everything = M.dq_check(feed, [{"rule_id": "r", "check": "sql_predicate", "predicate": "row_id > 9"}])
    with pytest.raises(M.NoRowsLeft):
        M.dq_filter(feed, everything)


def test_stitch(spark):
    old = spark.createDataFrame([(1, "old", 1), (2, "old", 1), (None, "old", 1)], "k int, v string, batch_id bigint")
    new = spark.createDataFrame([(2, "early", 1, 5), (2, "late", 2, 5), (None, "new", 1, 5), (4, "new", 1, 5)], "k int, v string, at int, batch_id bigint")
    got = D.stitch_scd1(new.drop("batch_id"), old.selectExpr("k", "v", "0 AS at", "batch_id"), ["k"], 5, latest_by="at").collect()
    assert {(r["k"], r["v"], r["batch_id"]) for r in got} == {(1, "old", 5), (2, "late", 5), (None, "new", 5), (4, "new", 5)}
    with pytest.raises(ValueError):
        D.stitch_scd1(new, old, [], 5)
    with pytest.raises(ValueError):
        D.stitch_scd1(new, old, ["k"], 5, scd_type=3)


def test_reconcile_with_nulls_and_copies(spark):
    source = spark.createDataFrame([(1, "a"), (2, None), (None, "n"), (4, "x"), (4, "b")], "k int, v string")
    target = spark.createDataFrame([(1, "a"), (2, "z"), (None, "n"), (4, "b"), (5, "q")], "k int, v string")
    r = M.reconcile(source, target, ["k"], ["v"])
    assert [x["k"] for x in r.missing.collect()] == [] and [x["k"] for x in r.extra.collect()] == [5]
    assert [tuple(x) for x in r.duplicates.collect()] == [(4, 2, 1)]
    assert [tuple(x) for x in r.mismatches.collect()] == [(2, "v", None, "z")]
    assert tuple(r.summary.first()) == (0, 1, 1, 1, 3)


def test_reconcile_compares_differing_buckets_only(spark):
    base = spark.range(20_000).selectExpr("id AS k", "concat('v', id % 7) AS v", "IF(id % 5 = 0, NULL, id * 0.5) AS x")
    changed = base.withColumn("v", F.when(F.col("k") == 77, "other").otherwise(F.col("v"))).filter("k <> 4000")
    target = changed.union(spark.createDataFrame([(None, "n", 1.0), (90_000, None, None)], "k bigint, v string, x double"))
    # A key that repeats alike on both sides leaves the digests equal; it is reported all the same.
    double = spark.createDataFrame([(5, "v5", 2.5)], "k bigint, v string, x double")
    r = M.reconcile(base.union(double), target.union(double), ["k"], ["v", "x"])
    assert [x["k"] for x in r.missing.collect()] == [4000] and {x["k"] for x in r.extra.collect()} == {None, 90_000}
    assert [x["column_name"] for x in r.mismatches.collect()] == ["v", "x"][:1] and r.mismatches.first()["k"] == 77
    assert sorted(tuple(x) for x in r.duplicates.collect()) == [(5, 2, 2)]
    assert tuple(r.summary.first()) == (1, 2, 1, 1, 5)
    assert r.compared.count() < 60  # of 20,001 keys
    same = M.reconcile(base, base, ["k"], ["v", "x"])
    assert same.compared.count() == 0 and tuple(same.summary.first()) == (0, 0, 0, 0, 0)


def test_digests_agree_with_a_full_comparison(spark):
    rnd = random.Random(5)
    for _ in range(2):
        make = lambda: [(rnd.choice([None, *range(12)]), rnd.choice(["a", None]), rnd.choice([0.0, -0.0, float("nan")])) for _ in range(25)]
        one, two = (spark.createDataFrame(make(), "k int, v string, x double") for _ in range(2))
        reports = lambda n: {f: sorted(map(str, getattr(M.reconcile(one, two, ["k"], ["v", "x"], buckets=n), f).collect())) for f in ("missing", "extra", "duplicates", "mismatches", "summary")}
        whole = reports(1)  # one bucket: everything is compared
        assert reports(16_384) == whole


def test_suite_reports_failures(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    report = M.reconcile_all(spark, {"good": lambda: M.reconcile(df, df, ["k"], ["v"]), "bad": lambda: 1 / 0})
    assert {r["subject"]: r["status"] for r in report.collect()} == {"good": "DONE", "bad": "FAILED"}


def test_remap_guard(spark):
    fact = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-12-31"), (3, "2024-06-01"), (1, "2025-01-01")], "k int, d string")
    maps = {"dim": spark.createDataFrame([(1, 11), (2, 0)], "orig_key int, updated_key int")}
    run = lambda g: sorted((r["d"], r["k"]) for r in R.remap_keys(fact, {"k": "dim"}, maps, {"dim": ("2024-01-01", "2024-12-31")}, "d", g).collect())
    assert run(True) == [("2024-01-01", 11), ("2024-06-01", 3), ("2024-12-31", 2), ("2025-01-01", 1)]
    assert run(False) == [("2024-01-01", 11), ("2024-06-01", None), ("2024-12-31", 0), ("2025-01-01", 1)]
    with pytest.raises(ValueError):
        R.remap_keys(fact, {"other": "dim"}, maps, {"dim": ("a", "b")}, "d", True)
    plan = plan_of(R.remap_keys(fact, {"k": "dim"}, maps, {"dim": ("2024-01-01", "2024-12-31")}, "d", True))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_pairs(spark):
    df = spark.createDataFrame([(x,) for x in (8, 11, 3, 16, 14, 5, 30, 8)], "x int")
    got = sorted(tuple(r) for r in R.pairs_with_sum(df, "x", 19).collect())
    assert got == [(3, 16, 1), (5, 14, 1), (8, 11, 2)]
    assert [tuple(r) for r in R.pairs_with_sum(df, "x", 16).filter("low = high").collect()] == [(8, 8, 1)]
    assert R.pairs_with_sum(df, "x", 99).count() == 0


def test_places_tell_exact_copies_apart(spark):
    path = scratch_path(spark, "copies")
    spark.createDataFrame([(1, "a")] * 40 + [(2, None)] * 40, "k int, v string").repartition(3).write.parquet(path)
    rows = read_parquet(spark, path, row_id="row_id")
    ids = [r.row_id for r in rows.collect()]
    assert len(set(ids)) == 80 and sorted(ids) == sorted(r.row_id for r in read_parquet(spark, path, row_id="row_id").repartition(2).collect())
    rules = [{"rule_id": "v", "column": "v", "check": "not_null", "severity": "critical"}]
    errors = M.dq_check(rows, rules)
    assert errors.count() == 40 and M.dq_filter(rows, errors).count() == 40
