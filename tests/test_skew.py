import random

import pytest

from pyspark.sql import functions as F
from tidegate.operators import skew


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def sides(spark):
    rnd = random.Random(3)
    left = [(1 if rnd.random() < 0.4 else (None if rnd.random() < 0.3 else rnd.randrange(40)), i % 7) for i in range(400)]
    right = [(k, k * 10) for k in range(0, 40, 2)] + [(1, 77), (1, 78), (None, 5)]
    return spark.createDataFrame(left, "k int, a int"), spark.createDataFrame(right, "k int, b int")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot_rows", [1, 20, 10_000])
def test_balanced_join_equals_join(sides, how, hot_rows):
    left, right = sides
    got = skew.balanced_join(left, right, ["k"], how, hot_rows=hot_rows, fraction=1.0, salts=5)
    assert got.columns == left.join(right, ["k"], how).columns
    assert _sorted(got) == _sorted(left.join(right, ["k"], how))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_balanced_join_with_null_safe_key(sides, how):
    left, right = (d.withColumn("s", skew.null_safe_key(["k"])).drop("k") for d in sides)
    got = skew.balanced_join(left, right, ["s"], how, hot_rows=10, fraction=1.0, salts=3)
    assert _sorted(got) == _sorted(left.join(right, ["s"], how))


def test_identical_rows_of_a_hot_key_are_spread(spark):
    left = spark.range(4000).select(F.lit(1).alias("k"), F.lit("x").alias("a")).repartition(8)
    right = spark.createDataFrame([(1, "y")], "k int, b string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = skew.balanced_join(left, right, ["k"], hot_rows=100, fraction=1.0, salts=16)
        tasks = joined.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(tasks) > 2 and sum(r["count"] for r in tasks) == 4000


def test_lookup_beyond_broadcast_bound(sides):
    left, right = sides
    got = skew.lookup_join(left, right, ["k"], "left", max_broadcast_rows=3, hot_rows=10, fraction=1.0)
    assert _sorted(got) == _sorted(left.join(right, ["k"], "left"))


def test_unsupported_kind(sides):
    with pytest.raises(ValueError):
        skew.balanced_join(*sides, ["k"], "full_outer")
