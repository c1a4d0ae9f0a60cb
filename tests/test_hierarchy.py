import math
import random

import pytest

from tests.conftest import plan_of, runs_python
from tidegate.operators import hierarchy as H


def _simulate(nodes, edges, start, max_iter):
    """Rounds of messages, as a vertex program would exchange them."""
    state = {n: (0.0, [str(n)]) if n == start else (math.inf, [""]) for n in nodes}
    for _ in range(max_iter):
        inbox = {}
        for s, d in set(edges):
            if s in state and d in state and state[s][0] < state[d][0] - 1:
                inbox.setdefault(d, []).append((str(s), state[s][0] + 1, state[s][1] + [str(d)]))
        for d, messages in inbox.items():
            _, dist, path = min(messages)
            if dist <= state[d][0]:
                state[d] = (dist, path)
    return state


def _climb(start, managers):
    chain, current = [], start
    while True:
        above = [m for m, c in managers if c == current]
        if not above:
            return chain, "no_manager"
        manager = min(above)
        stop = manager == current or manager in chain or manager == start
        chain.append(manager)
        if stop:
            return chain, "cycle"
        current = manager


def _expand(spark, nodes, edges, start=0, max_iter=50, **kw):
    v = spark.createDataFrame([(n, str(n)) for n in nodes], "id int, node string")
    e = spark.createDataFrame(edges, "src int, dst int")
    return H.hierarchy(v, e, "id", start, max_iter, **kw)


@pytest.mark.parametrize("seed", range(3))
def test_random_graphs(spark, seed):
    rnd = random.Random(seed)
    nodes = list(range(40))
    edges = [(rnd.randrange(45), rnd.randrange(45)) for _ in range(50)] + [(3, d) for d in range(12, 24)]
    result = _expand(spark, nodes, edges, hot_rows=5 if seed else 10_000, fraction=1.0)
    got = {r["id"]: (r["dist"], r["path"]) for r in result.collect()}
    assert got == _simulate(nodes, edges, 0, 50)
    managers = [(str(s), str(d)) for s, d in edges]
    pairs = spark.createDataFrame(managers, "currentnode string, childnode string")
    chains = H.repair_chains(H.unreachable(result), pairs).collect()
    assert {r["node"]: (r["newPath"], r["status"]) for r in chains} == {
        str(n): _climb(str(n), managers) for n in nodes if got[n][0] == math.inf
    }


def test_edge_cases(spark):
    assert {r["dist"] for r in _expand(spark, [0, 1], []).collect()} == {0.0, math.inf}
    assert {r["dist"] for r in _expand(spark, [1, 2], [(1, 2)]).collect()} == {math.inf}
    line = [0, 1, 2, 3], [(0, 1), (1, 2), (2, 3)]
    for limit in (None, 3):
        assert {r["id"]: r["dist"] for r in _expand(spark, *line, max_iter=limit).collect()} == {0: 0.0, 1: 1.0, 2: 2.0, 3: 3.0}
    with pytest.raises(ValueError, match="beyond 2 levels"):
        _expand(spark, *line, max_iter=2)


def test_two_roots(spark):
    v = spark.createDataFrame([(1, "a", "top"), (2, "b", "top"), (3, "c", "low")], "id int, node string, kind string")
    e = spark.createDataFrame([(2, 3), (1, 3)], "src int, dst int")
    got = {r["node"]: r["path"] for r in H.hierarchy(v, e, "kind", "top", 5).collect()}
    assert got == {"a": ["a"], "b": ["b"], "c": ["a", "c"]}


def test_max_depth_leaves_open_chains(spark):
    nodes = spark.createDataFrame([("a",)], "node string")
    pairs = spark.createDataFrame([("b", "a"), ("c", "b")], "currentnode string, childnode string")
    assert [tuple(r) for r in H.repair_chains(nodes, pairs, max_depth=1).collect()] == [("a", ["b"], "open")]
    assert [tuple(r) for r in H.repair_chains(nodes, pairs).collect()] == [("a", ["b", "c"], "no_manager")]


def test_no_python_in_the_loop(spark):
    assert not runs_python(plan_of(_expand(spark, [0, 1], [(0, 1)])))


@pytest.mark.parametrize("end", ["no_manager", "cycle"])
def test_a_long_chain_takes_few_rounds(spark, monkeypatch, end):
    n, rounds = 4096, []
    keep = H.cut_lineage
    monkeypatch.setattr(H, "cut_lineage", lambda df: rounds.append(1) or keep(df))
    pairs = [(f"{i + 1:05d}", f"{i:05d}") for i in range(n)] + ([("04000", f"{n:05d}")] if end == "cycle" else [])
    chains = H.repair_chains(spark.createDataFrame([("00000",), ("04090",)], "node string"), spark.createDataFrame(pairs, "currentnode string, childnode string"))
    got = {r.node: (r.newPath, r.status) for r in chains.collect()}
    assert len(rounds) <= 14
    if end == "cycle":
        assert got["00000"] == ([f"{i:05d}" for i in range(1, n + 1)] + ["04000"], "cycle")
        assert got["04090"] == ([f"{i:05d}" for i in [*range(4091, n + 1), *range(4000, 4091)]], "cycle")
    else:
        assert got["00000"] == ([f"{i:05d}" for i in range(1, n + 1)], "no_manager") and got["04090"][0] == [f"{i:05d}" for i in range(4091, n + 1)]


@pytest.mark.parametrize("depth", [1, 2, 3, 5, 8])
def test_depth_limits_equal_a_plain_climb(spark, depth):
    rnd = random.Random(depth)
    managers = [(str(rnd.randrange(30)), str(c)) for c in range(30)] + [("40", "41"), ("41", "42"), ("42", "43")]
    pairs = spark.createDataFrame(managers, "currentnode string, childnode string")
    nodes = spark.createDataFrame([(str(n),) for n in [*range(30), 40, 41, 42, 43, 99]], "node string")
    for r in H.repair_chains(nodes, pairs, max_depth=depth).collect():
        chain, status = _climb(r.node, managers)
        steps = len(chain) + (status == "no_manager")
        assert (r.newPath, r.status) == (chain[:depth], "open" if steps > depth else status)


def test_chains_without_managers(spark):
    nodes, none = spark.createDataFrame([("a",), (None,)], "node string"), spark.createDataFrame([], "currentnode string, childnode string")
    assert sorted(map(str, ((r.node, r.newPath, r.status) for r in H.repair_chains(nodes, none).collect()))) == ["('a', [], 'no_manager')", "(None, [], 'no_manager')"]


def test_visited_vertices_stay_where_they_are(spark):
    vertices = spark.range(50).selectExpr("id", "string(id) AS node", "0.0D AS dist", "array(string(id)) AS path")
    sent = spark.range(100).selectExpr("id AS dst", "string(id) AS dst_node", "string(id % 7) AS parent", "array('0') AS above")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        with H.Visited(vertices) as visited:
            found = H.next_level(sent, visited.ids(), 1)
            tree = found._jdf.queryExecution().executedPlan().toString()
            assert tree.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in tree
            assert visited.add(found, 1) and visited.level(1).count() == 50 and visited.ids().count() == 100
            assert not visited.add(H.next_level(sent, visited.ids(), 2), 2)
            result = visited.result()
        assert result.columns == ["id", "node", "dist", "path"] and result.count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
