"""Importance resampling against a plain version."""

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import DOCUMENTS
from tidegate.llm import importance_resampling as M

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def buckets(text, n):
    return [crc32(f.encode()) % n for f in features(text)]


def by_hand(docs, target, percent=25, n=10_000, seed=7, least=20):
    """(doc_id, n_features, weight, score, rank) of every (doc_id, text), in any order."""
    own = [buckets(t, n) for _, t in docs]
    s, t = Counter(b for x in own for b in x), Counter(b for x in target for b in buckets(x, n))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + n) / ((s[b] + 1) * (all_t + n)))) for b in range(n)]
    rows = []
    for (k, _), own_buckets in zip(docs, own):
        weight = sum(gain[b] for b in own_buckets) // len(own_buckets) if own_buckets else 0
        h = int(hashlib.sha256(f"{seed}:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        rows.append([k, len(own_buckets), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in rows if r[1] >= 2 * least - 1), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(able[: len(able) * percent // 100]):
        r[4] = i + 1
    return sorted(map(repr, map(tuple, rows)))


def as_rows(df):
    return sorted(repr((r.doc_id, r.n_features, r.weight, r.score, r["rank"])) for r in df.collect())


@pytest.mark.parametrize("piece", [M.PIECE, 64])
def test_kernels_count_every_feature(monkeypatch, piece):
    monkeypatch.setattr(M, "PIECE", piece)
    texts = [
        None, "", "...", "one", " one", "one two", "ONE two, two.one\n\nzwei ÄÖ 日本 a", "\x00a\x7fb", "w" * 500, "a " * 300, "." * 400 + "a b" + "-" * 300,
        "x" * 70 + " y " + "z" * 90 + "  q", "ſ K İ", " ".join(f"w{i}" for i in range(400)), "été" * 90 + " " + "é" * 40, "ab " * 21 + "." * 200 + "cd ef " * 30,
    ]
    found, n = M.features_of(texts, 1 << 20)
    edges = [0, *n.cumsum().tolist()]
    for text, i, j in zip(texts, edges, edges[1:]):
        assert sorted(found[i:j].tolist()) == sorted(buckets(text, 1 << 20)), repr(text)


def test_odd_documents_equal_brute_force(spark, extra):
    free = extra.drop("score")
    docs = [(r.doc_id, r.text) for r in free.collect()]
    target = spark.createDataFrame([("one two three",), (None,), ("",), ("w1x1 w2x2 seven",)], "text string")
    for percent in (0, 50, 100):
        made = M.resample(free, target, percent, least_words=3)
        assert made.columns == [*free.columns, *M.NEW]
        assert as_rows(made) == by_hand(docs, [r.text for r in target.collect()], percent, least=3)


def test_documents_near_the_target_are_drawn(spark):
    good = [(i, "alpha beta gamma delta " * 8) for i in range(200)]
    other = [(200 + i, "lorem ipsum dolor sit " * 8) for i in range(200)]
    rows = M.drawn(M.resample(spark.createDataFrame(good + other, "doc_id long, text string"), spark.createDataFrame([("alpha beta gamma delta " * 50,)], "text string")))
    kept = [r.doc_id for r in rows.collect()]
    assert len(kept) == 100 and sum(k < 200 for k in kept) >= 95 and rows.columns == ["doc_id", "text"]


def test_empty_tables(spark, documents):
    none = documents.limit(0)
    assert M.resample(none, documents).count() == 0
    docs = [(r.doc_id, r.text) for r in documents.limit(30).collect()]
    assert as_rows(M.resample(documents.limit(30), none)) == by_hand(docs, [])


def test_ties_and_copies_are_ranked_one_by_one(spark):
    text = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(1, text)] * 40 + [(None, text)] * 5, "doc_id long, text string").repartition(6)
    ranks = [(r.doc_id, r["rank"]) for r in M.resample(df, df, 100).collect()]
    assert sorted(n for _, n in ranks) == list(range(1, 46))


def test_a_needed_name_is_refused(documents):
    for name in ("score", "Rank", "row"):
        with pytest.raises(ValueError):
            M.resample(documents.withColumn(name, F.lit(1)), documents)


def test_one_document_of_nulls(spark):
    assert as_rows(M.resample(spark.createDataFrame([(None, None, None, None, None)], DOCUMENTS), spark.createDataFrame([], DOCUMENTS))) == by_hand([(None, None)], [])
