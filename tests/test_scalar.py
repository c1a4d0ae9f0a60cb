import datetime as dt
import random

import numpy as np
import pytest

from pyspark.sql import functions as F
from tests.conftest import plan_of, runs_python
from tidegate.functions import scalar as S


def test_business_days_against_numpy(spark):
    rnd = random.Random(9)
    day = lambda: dt.date(1960, 1, 1) + dt.timedelta(days=rnd.randrange(40_000))
    pairs = [(day(), day()) for _ in range(2000)]
    start = dt.date(2024, 2, 23)
    pairs += [(start + dt.timedelta(a), start + dt.timedelta(b)) for a in range(9) for b in range(9)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, s date, e date")
    S.register_functions(spark)
    df.createOrReplaceTempView("day_pairs")
    direct = df.select("i", S.business_days(F.col("s"), F.col("e")).alias("n"))
    assert not runs_python(plan_of(direct))
    want = [int(np.busday_count(s, e)) for s, e in pairs]
    assert [r["n"] for r in direct.orderBy("i").collect()] == want
    assert [r["n"] for r in spark.sql("SELECT DAY_BETWEEN(s, e) AS n FROM day_pairs ORDER BY i").collect()] == want


def test_business_days_of_nulls(spark):
    df = spark.createDataFrame([(None, dt.date(2024, 1, 1)), (dt.date(2024, 1, 1), None), (None, None)], "s date, e date")
    assert [r[0] for r in df.select(S.business_days(F.col("s"), F.col("e"))).collect()] == [0, 0, 0]


def test_zip_to_map(spark):
    df = spark.createDataFrame([(["a", "b", "a"], [1, 2, 3]), (["x", "y"], [1]), ([], []), (["q"], [7, 8])], "k array<string>, v array<int>")
    got = [r[0] for r in df.select(S.zip_to_map(F.col("k"), F.col("v"))).collect()]
    assert got == [{"b": 2, "a": 3}, {"x": 1}, {}, {"q": 7}]


def test_words(spark):
    df = spark.createDataFrame([("  how are\tyou\n",), ("",), ("one",)], "t string")
    got = df.select(S.first_word(F.col("t")), S.last_word_length(F.col("t")), S.reverse_words(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [("how", 3, "you are how"), (None, None, ""), ("one", 3, "one")]


def test_conditional_add_and_message(spark):
    df = spark.createDataFrame([(3, "bolt"), (3, "gear"), (3, None)], "n int, l string")
    got = [r[0] for r in df.select(S.conditional_add(F.col("n"), F.col("l"), {"bolt": 4, "gear": 9}, 50)).collect()]
    assert got == [7, 12, 53]
    text = spark.createDataFrame([("it's \"bad\" luck",)], "m string").select(S.clean_message(F.col("m"), 8)).first()[0]
    assert text == "its ba"  # cut first, then freed of quotes
    whole = spark.createDataFrame([("x" * 5000 + '"',)], "m string").select(S.clean_message(F.col("m"), None)).first()[0]
    assert whole == "x" * 5000


def test_exact_cast_never_gives_null(spark):
    df = spark.createDataFrame([("12",), (None,)], "k string")
    assert [r[0] for r in df.select(S.exact_cast(F.col("k"), "int")).collect()] == [12, None]
    for bad in ("x", "99999999999"):
        with pytest.raises(Exception, match="not a int"):
            spark.createDataFrame([(bad,)], "k string").select(S.exact_cast(F.col("k"), "int")).collect()


def test_nested_and_dates(spark):
    df = spark.sql("SELECT array(array(array(1, 2), array(3)), array(array(4))) AS a, '30-02-2024' AS d")
    row = df.select(S.flatten_levels(F.col("a"), 2).alias("f"), S.parse_time(F.col("d"), "dd-MM-yyyy").alias("d")).first()
    assert row["f"] == [1, 2, 3, 4] and row["d"] is None
