"""Registered queries against their SQL, and the pipeline against plain versions of its stages."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.test_decontamination import by_hand as contamination
from tests.llm.test_secret_scan import base_findings
from tests.llm.test_shingle_join import brute_force
from tests.oracle import compare, connect
from tidegate.llm.queries import QUERIES, SQL
from tidegate.session import store


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, folder, name):
    ok, note = compare(spark, folder, QUERIES[name], SQL[name], connect(folder))
    assert ok, note


def test_all_queries_are_registered():
    names = entry.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names


def test_pipeline_stages(spark, folder, documents):
    columns, docs = documents.columns, documents
    benchmark = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    rows = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = store(stage(spark, docs, folder), name)
        assert docs.columns == columns
        after = docs.collect()
        rows[name] = {r.doc_id: r for r in after}
        if name == "shingle_join":
            assert set(rows[name]) == {k for k, (_, c) in brute_force({k: r.text for k, r in before.items()}).items() if k == c}
        elif name == "decontamination":
            facts = {k: contamination(r.text, benchmark) for k, r in before.items()}
            assert set(rows[name]) == {k for k, (n, h, _) in facts.items() if not (h and 20 * h >= n)}
        elif name == "secret_scan":
            assert set(rows[name]) == set(before)
            for k, r in rows[name].items():
                found = base_findings(before[k].text or "")
                assert (r.text == before[k].text) or "[SECRET]" in r.text
                assert not found or not base_findings(r.text)
        elif name != "entropy_mix":
            assert all(before[k] == r for k, r in rows[name].items())
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    kept = [labels[k] for k in rows["quality_rules"] if k in labels]
    assert sum(kept) >= 0.95 * len(kept)
    words = sum(len(r.text.encode().split()) for r in after)
    assert abs(words - sum(len(r.text.encode().split()) for r in before.values())) <= 20
