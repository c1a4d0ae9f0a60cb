from collections import defaultdict

import pytest

from tests.llm.conftest import DOCUMENTS
from tidegate.llm import mixing as M
from tidegate.llm.queries import QUERIES


def targets_by_hand(sizes, weights=(1, 2, 3), cap=3.0):
    """Share by weight; what a source may not take is shared again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, rest = {}, set(order), sum(sizes.values())
    while free:
        total = sum(weight[s] for s in free)
        above = {s for s in free if rest * weight[s] / total > cap * sizes[s]}
        if not above:
            return target | {s: rest * weight[s] / total for s in free}
        for s in above:
            target[s] = cap * sizes[s]
        rest -= sum(target[s] for s in above)
        free -= above
    return target


def plan(df, **options):
    rows = M.mix(df, **options).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    return by


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1, "c": 1000, "d": 3}, {"a": 5, None: 500, "b": 1}, {"x": 7}, {"a": 0, "b": 10, "c": 0},
])
def test_targets_and_exact_totals(spark, sizes):
    rows = [(i, " ".join(["w"] * n), s) for i, (s, total) in enumerate(sizes.items()) for n in ([total // 3, total - total // 3] if total > 2 else [total])]
    rows = [(k, t, s) for k, (_, t, s) in enumerate(rows)]
    got = plan(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))
    want = targets_by_hand(sizes)
    for source, own in got.items():
        assert {r.source_size for r in own} == {sizes[source]}
        assert own[0].target == pytest.approx(want[source])
        taken = [r.copies * r.size + r.cut_words for r in own]
        assert abs(sum(taken) - want[source]) < 1
        assert all(t <= 3 * r.size for t, r in zip(taken, own)) and sum(r.cut_words > 0 for r in own) <= 1


def test_rates_are_the_tilt_of_the_dual(spark, documents):
    for own in plan(documents).values():
        assert own[0].rate == pytest.approx(own[0].target / own[0].source_size)


def test_reruns_agree_and_equal_rows_share(spark, folder):
    first, second = (sorted(map(tuple, QUERIES["op8_entropy_mix"](spark, folder).collect())) for _ in range(2))
    assert first == second


def test_odd_documents(spark, extra):
    rows = M.mix(extra).collect()
    assert len(rows) == extra.count()
    assert all(r.copies == 0 for r in rows if r.size == 0)
    assert M.mix(extra.limit(0)).count() == 0
    copies = M.mixed_copies(extra)
    assert copies.columns == extra.columns and M.mixed_copies(extra.limit(0)).count() == 0
    words = sum(len((r.text or "").split()) for r in copies.collect())
    assert abs(words - sum(r.size for r in rows)) <= 5


def test_copies_follow_the_plan(spark, documents):
    wanted = {r.doc_id: r.copies * r.size + r.cut_words for r in M.mix(documents).collect()}
    taken = defaultdict(int)
    for r in M.mixed_copies(documents).collect():
        taken[r.doc_id] += len(r.text.encode().split())
    assert {k: v for k, v in wanted.items() if v} == dict(taken)


def test_equal_rows_get_their_copies(spark):
    rows = [(1, "a b c", "en", "s", 5)] * 5 + [(2, "d e f g", "en", "t", 7)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    wanted = sum(r.copies * r.size + r.cut_words for r in M.mix(df).collect())
    got = M.mixed_copies(df).collect()
    assert sum(len(r.text.split()) for r in got) == wanted
