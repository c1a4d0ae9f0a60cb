import pytest

from pyspark.sql import functions as F
from tests.conftest import plan_of, runs_python
from tidegate.operators import columns as P
from tidegate.operators import standardize as N


def test_canonical_column_variants(spark):
    base = spark.createDataFrame([(1, 2, "n")], "x int, file_id int, file_name string")
    run = lambda df: P.canonical_column(df, "received", "file_name", "file_id")
    assert run(base).columns == ["x", "received"] and run(base).first()["received"] == "n"
    assert run(base.drop("file_id")).first()["received"] == "n"
    assert run(base.drop("file_name")).first()["received"] == "2"
    assert run(base.select("x")).columns == ["x"]


def test_thresh_counts_non_nulls(spark):
    df = spark.createDataFrame([(1, None, None), (1, 2, None), (None, None, None)], "a int, b int, c int")
    assert P.drop_nulls(df, thresh=2).count() == 1
    assert P.drop_nulls(df, thresh=1).count() == 2
    assert P.drop_nulls(df, how="all").count() == 2
    assert P.drop_nulls(df, subset=["b"]).count() == 1


def test_cast_overflow_is_null(spark):
    df = spark.createDataFrame([("7",), ("12",), ("x",)], "a string")
    assert [r["a"] for r in P.cast_columns(df, ["a"], "decimal(1,0)").collect()] == [7, None, None]


def test_apply_schema(spark):
    df = spark.createDataFrame([("31/12/2023 23:59", "9", "z")], "t string, n string, extra string")
    meta = [
        {"column_name": "n", "column_data_type": "int", "column_sequence_number": 2},
        {"column_name": "t", "column_data_type": "timestamp", "column_date_format": "dd/MM/yyyy HH:mm", "column_sequence_number": 1},
    ]
    out = P.apply_schema(df, meta)
    assert out.columns == ["t", "n"] and out.first()["n"] == 9 and out.first()["t"].minute == 59
    with pytest.raises(ValueError):
        P.apply_schema(df, [])
    with pytest.raises(ValueError):
        P.apply_schema(df.drop("n"), meta)


def test_evolve_starts_at_one_and_skips_lineage(spark):
    meta = spark.createDataFrame([], "column_id bigint, dataset_id string, column_name string, column_data_type string, column_sequence_number int")
    seen = P.observed_columns(spark.createDataFrame([(1, 2, 3)], ["new col", "pt_batch_id", "b-c"]), "d")
    drift = P.schema_drift(seen, meta)
    got = sorted((r["column_name"], r["column_id"], r["column_sequence_number"]) for r in P.evolve_metadata(meta, drift).collect())
    assert got == [("BC", 1, 1), ("NEW_COL", 2, 2)]


def test_drop_if_all_and_names(spark):
    df = spark.createDataFrame([(1, 2)], ["a", "b"])
    assert P.drop_if_all(df, ["a", "c"]).columns == ["a", "b"]
    assert P.drop_if_all(df, ["a"]).columns == ["b"]
    assert P.clean_name("Pay-Grade (EUR) x") == "PAYGRADE_EUR_X"
    assert P.upper_columns(df, drop=["B"]).columns == ["A"]
    assert P.bucket(F.lit(1999), 10) is not None


def _rule(f, p=None, c="v"):
    return {"column_name": c, "function_name": f, "function_params": p}


UNUSABLE = [
    _rule("left_padding"),
    _rule("left_padding", '{"length": 05, "padding_value": "*"}'),
    _rule("left_padding", '{"padding_value":"0"}'),
    _rule("mystery"),
    _rule("type_conversion", '{"type":"upper"}'),
    _rule("type_conversion", "[]"),
    _rule("date_conversion", "not json"),
]
USABLE = [
    _rule("type_conversion", "{'type':'Upper'}"),
    _rule("trim"),
    _rule("zip_extractor", "anything"),
    _rule("replace", '{"to_replace":".","value":""}'),
]


def test_rule_validation_agrees(spark):
    rules = [dict(r, no=i) for i, r in enumerate(UNUSABLE + USABLE)]
    frame = spark.createDataFrame([(r["no"], r["column_name"], r["function_name"], r["function_params"]) for r in rules],
                                  "no int, column_name string, function_name string, function_params string")
    rejected = sorted(r["no"] for r in N.rejected_rules(frame).collect())
    assert rejected == list(range(len(UNUSABLE)))
    df = spark.createDataFrame([(" a.b ",)], "v string")
    assert N.standardize(df, UNUSABLE).first()["v"] == " a.b "
    for rule in UNUSABLE:
        with pytest.raises(N.RejectedRules):
            N.standardize(df, [rule], strict=True)


def test_standardize_order_and_plan(spark):
    df = spark.createDataFrame([("x.y",), ("  ",), (None,)], "v string")
    rules = [_rule("replace", "{'to_replace':'X','value':'Q'}"), _rule("type_conversion", "{'type':'Upper'}"),
             _rule("right_padding", "{'padding_value':'-','length':5}"), _rule("blank_conversion")]
    out = N.standardize(df, rules)
    assert [r["v"] for r in out.collect()] == ["Q.Y--", None, None]
    plan = plan_of(out)
    assert not runs_python(plan) and "Exchange" not in plan


def test_zip_and_dates(spark):
    df = spark.createDataFrame([("a 123 b 1234567",), ("none",)], "v string")
    assert [r[0] for r in df.select(N.zip_code(F.col("v"))).collect()] == ["12345", None]
    bad = spark.createDataFrame([("20240230",), ("20240229",)], "v string")
    assert [r[0] for r in bad.select(N.convert_date(F.col("v"), "yyyyMMdd", "dd.MM.yyyy")).collect()] == [None, "29.02.2024"]
