import hashlib
import random
import re

import pytest

from tests.llm.conftest import DOCUMENTS
from tidegate.llm import decontamination as D

_LOWER = {i: i + 32 for i in range(65, 91)}
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return _WORD.findall((text or "").translate(_LOWER))


def by_hand(text, items):
    own, hit, found = words(text), set(), set()
    for item, item_text in items:
        w = words(item_text)
        n = min(13, len(w))
        windows = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(own) - n + 1 if n else 0):
            if tuple(own[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                found.add(str(item if item is not None else ""))
    return len(own), len(hit), sorted(found)


def results(df):
    return {r.doc_id: (r.hits.n_words, sum(b - a for a, b in zip(r.hits.starts, r.hits.ends)), list(r.hits["items"])) for r in df.collect()}


@pytest.fixture
def case(spark):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "日本", "x-y", "Don't"]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    items = [(1, " ".join(passage)), (2, " ".join(passage[20:] + ["z"] * 5)), (10, "Short ITEM"), (3, ""), (4, None), (None, "one two three"), (5, "w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1"), (1, "other text of item one")]
    texts = [None, "", "short item", "SHORT\nitem!", "a shorter item", " ".join(passage).upper(), " , ".join(passage[5:18]), " ".join(passage[5:17]), "one two three " * 3, " ".join(["w1"] * 40)]
    for _ in range(20):
        filler = [rng.choice(vocabulary) for _ in range(rng.randrange(300))]
        at, a = rng.randrange(len(filler) + 1), rng.randrange(25)
        texts.append(" ".join(filler[:at] + passage[a : a + rng.randrange(10, 30)] + filler[at:]))
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in enumerate(texts)], DOCUMENTS)
    return docs, spark.createDataFrame(items, "item_id bigint, text string"), dict(enumerate(texts)), items


@pytest.mark.parametrize("block_windows", [400_000, 40])
def test_equals_brute_force(case, block_windows):
    """Also when the benchmark is dealt into several blocks."""
    docs, benchmark, texts, items = case
    assert results(D.find_hits(docs, benchmark, block_windows=block_windows)) == {k: by_hand(t, items) for k, t in texts.items()}


def test_stages(case):
    docs, benchmark, texts, items = case
    facts = {k: by_hand(t, items) for k, t in texts.items()}
    kept = D.without_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, (n, h, _) in facts.items() if not (h and 20 * h >= n)}
    cut = {r.doc_id: r.text for r in D.without_hit_spans(docs, benchmark).collect()}
    for k, (n, h, _) in facts.items():
        assert len(words(cut[k])) == n - h
        if not h:
            assert cut[k] == texts[k]


def test_odd_documents(spark, extra):
    benchmark = spark.createDataFrame([(1, "two three four")], "item_id bigint, text string")
    found = D.find_hits(extra.drop("hits"), benchmark)
    assert found.count() == extra.count()
    assert {r.doc_id for r in found.filter("size(hits.items) > 0").collect()} == {5, 6, None}
    kept = D.without_contaminated(extra, benchmark)
    assert kept.columns == extra.columns and kept.count() == extra.count() - 4
    assert D.find_hits(extra.drop("hits").limit(0), benchmark).count() == 0
    assert D.without_contaminated(extra, benchmark.limit(0)).count() == extra.count()
    with pytest.raises(ValueError, match="already has"):
        D.find_hits(extra, benchmark)


def test_one_huge_item_is_dealt_into_blocks(spark, monkeypatch):
    long = [f"w{i}" for i in range(30_000)]
    benchmark = spark.createDataFrame([(None, " ".join(long)), (None, "short one"), (7, " ".join(long[:13]))], "item_id bigint, text string")
    texts = {1: " ".join(["x", *long[9_990:10_020], "y"]), 2: " ".join(long[3:15]), 3: "a short one!", 4: " ".join(long[:14])}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    sizes, build = [], D.WindowIndex.__init__
    monkeypatch.setattr(D.WindowIndex, "__init__", lambda self, items, size: sizes.append(len(items)) or build(self, items, size))
    found = {r.doc_id: (r.hits.starts, r.hits.ends, r.hits.items) for r in D.find_hits(docs, benchmark, block_windows=5_000).collect()}
    assert len(sizes) == 6 and max(sizes) < 5_500 and sum(sizes) == 30_000 - 12 + 2
    assert found == {1: ([1], [31], [""]), 2: ([], [], []), 3: ([1], [3], [""]), 4: ([0], [14], ["", "7"])}


def test_digest():
    assert D.items_digest(["9", "10"]) == hashlib.sha256(b"10,9").hexdigest()
