import random
import re

import numpy as np
import pytest

from tidegate.llm import shingle_join as J
from tidegate.llm.components import components
from tidegate.llm.queries import QUERIES

_LOWER = {i: i + 32 for i in range(65, 91)}


def set_of(text):
    words = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(_LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_force(texts):
    """{doc_id: (n_shingles, component_id)} by comparing all pairs."""
    sets = {k: set_of(t) for k, t in texts.items()}
    name = {k: k for k in sets}
    ids = sorted(sets)

    def find(x):
        while name[x] != x:
            x = name[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                name[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in ids}


def answer(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def family(rng, base, copies, share):
    """Copies of `base` with a share of their words replaced."""
    return [" ".join(w if rng.random() > share else f"e{rng.randrange(10**6)}" for w in base) for _ in range(copies)]


def test_query_equals_brute_force(spark, folder, documents):
    assert answer(QUERIES["op7_shingle_join"](spark, folder)) == brute_force({r.doc_id: r.text for r in documents.collect()})


@pytest.mark.parametrize("block", [512, 8])
def test_families_near_the_threshold(spark, monkeypatch, block):
    """Near copies on either side of 0.8, exact copies, shared passages and short texts; with tiny blocks, too."""
    monkeypatch.setattr(J, "BLOCK_SETS", block)
    rng = random.Random(block)
    vocabulary = [f"v{i}" for i in range(400)]
    texts = []
    for size, share in ((60, 0.01), (60, 0.02), (200, 0.015), (30, 0.03), (120, 0.0), (9, 0.05)):
        texts += family(rng, [rng.choice(vocabulary) for _ in range(size)], 25, share)
    passage = [rng.choice(vocabulary) for _ in range(40)]
    texts += [" ".join(passage + [rng.choice(vocabulary) for _ in range(rng.randrange(4, 30))]) for _ in range(40)]
    texts += ["a b c d", "A B\tc D", "a b c", "a", "", None, "a b c d e", "a b c d e f"]
    rng.shuffle(texts)
    ids = rng.sample(range(10_000), len(texts))
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id bigint, text string")
    assert answer(J.near_duplicates(df)) == brute_force(dict(zip(ids, texts)))


def test_block_links_join_the_same_sets():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 60, 200).astype(np.uint64)
    sets = []
    for _ in range(60):
        keep = base[rng.random(200) > rng.choice([0.05, 0.1, 0.2])]
        sets.append(np.unique(np.concatenate([keep, rng.integers(0, 1 << 60, rng.integers(0, 20)).astype(np.uint64)])))
    groups = list(range(60))
    for a, b in J.linked_in_block(sets):
        groups = [min(groups[a], groups[b]) if g in (groups[a], groups[b]) else g for g in groups]
    want = list(range(60))
    for a in range(60):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                want = [min(want[a], want[b]) if g in (want[a], want[b]) else g for g in want]
    assert [groups.index(g) for g in groups] == [want.index(g) for g in want]


def test_hashes_follow_words():
    a, counts = J.word_hashes([b"Ab  c\td", b"", b" ab", b"\n"])
    assert counts.tolist() == [3, 0, 1, 0] and a[0] == a[3] and len(set(a.tolist())) == 3
    many = J.word_hashes([f"x{i}".encode() for i in range(20_000)])[0]
    assert len(set(many.tolist())) == 20_000


def test_odd_documents(spark, extra):
    rows = J.near_duplicates(extra).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id))
    assert by[1] == [(0, 1)] and by[2] == [(0, 2)] and by[3] == [(0, 3)] and by[7] == [(1, 7)]
    assert by[5] == [(3, 5), (3, 5)] and by[6] == [(3, 5)] and by[None] == [(3, 5)]
    assert J.near_duplicates(extra.limit(0)).count() == 0
    kept = J.one_of_each(extra)
    assert kept.columns == extra.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 7, 8]


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (200, 200)] + [(300, 300 + i) for i in range(50)]
    got = {r.vertex: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[101] == 100 and all(got[300 + i] == 300 for i in range(50))


def test_stage_keeps_one_of_each(spark, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    want = sorted(k for k, (_, c) in brute_force(texts).items() if k == c)
    assert sorted(r.doc_id for r in J.one_of_each(documents).collect()) == want




A, B = "one two three four five six seven", "eight nine ten eleven twelve more words"


@pytest.mark.parametrize("rows, want", [
    ([(3, A), (5, A), (5, B)], [(3, A), (5, B)]),
    ([(5, A), (5, B)], [(5, A), (5, B)]),
    ([(5, ""), (5, B), (5, None)], [(5, ""), (5, B), (5, None)]),
    ([(5, A), (5, A.upper()), (5, B), (5, B)], [(5, A), (5, B)]),
    ([(None, A), (None, A), (None, B)], [(None, A), (None, B)]),
    ([(5, ""), (5, ""), (6, A), (None, A), (None, A)], [(5, ""), (6, A), (None, A)]),
])
def test_one_row_of_each_component_stays(spark, rows, want):
    """One doc_id on rows of different texts: no text goes without a near copy that stays."""
    got = J.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    plain = lambda pairs: sorted((repr(k), (t or repr(t)).lower()) for k, t in pairs)
    assert plain(got) == plain(want)
