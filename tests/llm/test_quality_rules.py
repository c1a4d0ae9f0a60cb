import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import CLASHING
from tidegate.llm import quality_rules as Q
from tidegate.llm.queries import QUERIES


def test_held_out_accuracy(spark, folder, labels):
    rows = QUERIES["op1_quality_rules"](spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert sum(r.predicted == r.quality for r in held) >= 0.95 * len(held)


def test_expression_equals_the_rules_by_hand(spark):
    rules = (((("bars", True, 0.5), ("upper", False, 0.1)), 2.0), ((("bars", False, 0.5),), -1.0))
    model = Q.RuleModel(0.25, rules)
    rows = [(0.5, 0.2), (0.5, 0.1), (0.6, 0.9), (0.0, 0.0)]
    df = spark.createDataFrame(rows, "bars double, upper double")
    got = [r[0] for r in df.select(model.score({n: F.col(n) for n in df.columns})).collect()]
    margins = [0.25 + 2 * (b <= 0.5 and u > 0.1) - (b > 0.5) for b, u in rows]
    assert got == pytest.approx([1 / (1 + 2.718281828459045**-m) for m in margins])


def test_statistics_of_odd_texts():
    assert Q.statistics_of(None) == Q.statistics_of("") == Q.statistics_of(" \n") == (0.0,) * len(Q.NAMES)
    own = dict(zip(Q.NAMES, Q.statistics_of("AB!! AB!! c")))
    assert own["tails"] == own["bangs"] == pytest.approx(2 / 3)
    assert own["echoes"] == pytest.approx(1 / 3) and own["distinct_words"] == pytest.approx(2 / 3)


def test_without_two_classes_the_score_is_constant(spark, odd_documents):
    stats = Q.stored_statistics(odd_documents)
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    model = Q.fit_quality(stats, none)
    assert not model.rules and model.intercept == 0.0
    torn = spark.createDataFrame([(5, 1), (5, 0), (7, None)], "doc_id bigint, quality int")
    assert not Q.fit_quality(stats, torn).rules


def test_stage_keeps_rows_and_columns(spark, extra, labels, documents):
    kept = Q.accepted(extra, spark.createDataFrame([], "doc_id bigint, quality int"))
    assert kept.columns == extra.columns and kept.count() == extra.count()
    assert Q.accepted(extra.limit(0), labels).count() == 0
    assert set(CLASHING) <= set(kept.columns)


def test_names_of_rules_are_deduplicated(spark, documents, labels):
    stats = Q.stored_statistics(documents)
    model = Q.fit_quality(stats, labels)
    assert len({r for r, _ in model.rules}) == len(model.rules)
