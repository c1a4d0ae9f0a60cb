import hashlib

import pytest

from tests.conftest import plan_of, runs_python
from tidegate.llm import simhash as H
from tidegate.llm.queries import QUERIES


def by_hand(texts):
    """The edited text of each document and which is next, from {doc_id: text}."""
    ids = sorted(texts, reverse=True)
    out = {}
    for i, k in enumerate(ids):
        text, after = texts[k], texts[ids[(i + 1) % len(ids)]]
        n = len(text) // 3
        out[k] = (text[: len(text) - n] + after[:n], ids[(i + 1) % len(ids)])
    return out


def test_query_equals_brute_force(spark, folder, documents):
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    rows = {r.doc_id: r for r in QUERIES["op4_simhash"](spark, folder).collect()}
    edits = by_hand(texts)
    assert set(rows) == set(texts)
    prints = {k: int(r.fingerprint, 16) for k, r in rows.items()}
    cosine = lambda d: 1.0 if d == 0 else max(0.0, __import__("math").cos(d * 3.141592653589793 / 128))
    for k, row in rows.items():
        edited, after = edits[k]
        assert row.n_chars == len(texts[k]) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.near_next == pytest.approx(cosine((prints[k] ^ prints[after]).bit_count()), abs=1e-9)
        if k % 20 == 0:
            assert row.n_within_3 == sum((prints[k] ^ p).bit_count() <= 3 for p in prints.values()) - 1
    by_text = {}
    for k, text in texts.items():
        assert by_text.setdefault(text, rows[k].fingerprint) == rows[k].fingerprint
    # A text that keeps two thirds of itself is nearer than the next one, but for chance in 128 bits and copies.
    wins = [r.near_edited > r.near_next for r in rows.values() if r.n_chars > 300]
    assert sum(wins) >= 0.97 * len(wins)


def test_votes_by_hand(spark):
    """Packed lanes count as plain votes do, over several pieces, too."""
    df = spark.createDataFrame([(1, " ".join(f"w{i % 501}" for i in range(70_000))), (2, "a"), (3, "")], "id bigint, text string")
    got = {r.id: r for r in H.fingerprints(df, ["id"]).collect()}
    sql = spark.sql("SELECT id, xxhash64(2, w, lead(w, 1) OVER o, lead(w, 2) OVER o) AS h FROM (SELECT id, pos, w FROM VALUES (1) AS t(id) "
                    "LATERAL VIEW posexplode(transform(sequence(0, 69999), i -> concat('w', i % 501))) AS pos, w) WINDOW o AS (ORDER BY pos)")
    votes = [0] * 64
    for r in sql.collect():
        for b in range(64):
            votes[b] += 1 if r.h >> b & 1 else -1
    assert got[1].f2 & ((1 << 64) - 1) == sum(1 << b for b in range(64) if votes[b] > 0)
    assert len(got) == 3


def test_neighbours_equal_brute_force(spark):
    import random

    rng = random.Random(5)
    base = [rng.getrandbits(128) for _ in range(30)]
    near = [b ^ sum(1 << i for i in rng.sample(range(128), rng.randint(0, 6))) for b in base for _ in range(6)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = [(signed(v & ((1 << 64) - 1)), signed(v >> 64)) for v in base + near]
    df = spark.createDataFrame(rows, "f1 bigint, f2 bigint")
    distinct = {(a & ((1 << 64) - 1)) | (b & ((1 << 64) - 1)) << 64 for a, b in rows}
    for radius in (3, 4):
        got = H.neighbours(df, df, radius).collect()
        assert len(got) == len(set(got)) == sum((a ^ b).bit_count() <= radius for a in distinct for b in distinct)


def test_odd_rows(spark, extra):
    rows = H.compare_with_edits(extra.select("doc_id", "text")).collect()
    distinct = extra.select("doc_id", "text").distinct().count() - 0
    assert len(rows) == distinct
    assert H.compare_with_edits(extra.select("doc_id", "text").limit(0)).count() == 0
    one = H.compare_with_edits(extra.filter("doc_id = 7").select("doc_id", "text")).collect()
    assert len(one) == 1 and (one[0].f1, one[0].f2) == (one[0].x1, one[0].x2)


def test_no_python_runs(spark, folder):
    assert not runs_python(plan_of(QUERIES["op4_simhash"](spark, folder)))


def test_query_names_neighbours_and_has_every_row(spark, tmp_path):
    base = " ".join(f"w{i}" for i in range(300))
    rows = [(20, base), (20, base), (21, base), (22, base + " end"), (40, "quite another text of few words"), (None, base), (60, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op4_simhash"](spark, str(tmp_path)).collect()
    assert sorted(repr(r.doc_id) for r in got) == sorted(repr(k) for k, _ in rows)
    prints = [int(r.fingerprint, 16) for r in got]
    for r, own in zip(got, prints):
        if r.doc_id is None or r.doc_id % 20:
            assert r.within_3 is None and r.n_within_3 is None
            continue
        near = {o.fingerprint for o, p in zip(got, prints) if (own ^ p).bit_count() <= 3}
        assert r.within_3.split(",") == sorted(near)
        assert r.n_within_3 == sum(o.fingerprint in near for o in got) - 1
    assert next(r.n_within_3 for r in got if r.doc_id == 20) >= 3
