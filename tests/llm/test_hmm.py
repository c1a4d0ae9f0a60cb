import math
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest

from tidegate.llm import hmm as M
from tidegate.llm.queries import QUERIES


def small_model(symbols=5, states=3):
    rng = np.random.default_rng(3)
    norm = lambda a, axis: a / a.sum(axis, keepdims=True)
    return M.Model(norm(rng.random(states), 0), norm(rng.random((states, states)), 1), norm(rng.random((symbols, states)), 0))


def paths(model, symbols):
    """(probability, path) of all state paths."""
    for path in product(range(len(model.start)), repeat=len(symbols)):
        p = model.start[path[0]] * model.emits[symbols[0], path[0]]
        for a, b, s in zip(path, path[1:], symbols[1:]):
            p *= model.moves[a, b] * model.emits[s, b]
        yield p, path


def test_forward_equals_sum_over_paths():
    model = small_model()
    sequences = [np.array(s) for s in ([0, 1, 2, 3, 4], [4, 4, 0], [2, 1], [3])]
    got = M.forward(model, sequences)
    assert got == pytest.approx([math.log(sum(p for p, _ in paths(model, s))) for s in sequences])


def test_expected_counts_equal_sums_over_paths():
    model = small_model()
    pieces = np.array([[0, 1, 2, 4], [3, 3, 0, 1]]).T
    starts, moves, emits, likelihood = M.expected_counts(model, pieces)
    want = [np.zeros_like(model.start), np.zeros_like(model.moves), np.zeros_like(model.emits), 0.0]
    for column in pieces.T:
        total = sum(p for p, _ in paths(model, column))
        want[3] += math.log(total)
        for p, path in paths(model, column):
            want[0][path[0]] += p / total
            for a, b in zip(path, path[1:]):
                want[1][a, b] += p / total
            for s, k in zip(column, path):
                want[2][s, k] += p / total
    for got, expected in zip((starts, moves, emits, likelihood), want):
        assert got == pytest.approx(expected)


def test_query_equals_plain_counts_and_beats_the_base(spark, folder, documents):
    rows = {r.doc_id: r for r in QUERIES["op6_hmm_score"](spark, folder).collect()}
    texts = {r.doc_id: r.text for r in documents.collect()}
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in texts}
    counts = Counter(t for k, v in texts.items() if not held[k] for t in M.tokens_of(v))
    n, v = sum(counts.values()), len(counts)
    for k, text in texts.items():
        tokens, row = M.tokens_of(text), rows[k]
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (held[k], len(tokens), sum(counts[t] > 0 for t in tokens), n)
        assert row.base_score == pytest.approx(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens))
    own = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in own) > sum(r.base_score for r in own)


def test_training_raises_the_likelihood(spark, documents):
    train = documents.selectExpr("doc_id", "false AS held_out", "text")
    counts = Counter(t for r in documents.collect() for t in M.tokens_of(r.text))
    numbers = {w: k for k, (w, _) in enumerate(counts.most_common(300))}
    texts = M.encoded(train, numbers, 32)
    sequences = [np.frombuffer(r.symbols, np.uint16).astype(int) for r in texts.select("symbols").collect()]
    weights = np.bincount(np.concatenate(sequences), minlength=332).astype(float)
    sequences.sort(key=lambda s: -len(s))
    scores = [M.forward(M.baum_welch(texts, weights, 16, 4, steps, 10_000, 1), sequences).sum() for steps in (0, 1, 3)]
    assert scores[0] < scores[1] < scores[2]


def test_class_factor_is_a_distribution(spark):
    """Words of a class and one unseen word add up to 1, so scores are probabilities of token sequences."""
    counts = {b"aaab": 2, b"xaab": 1}
    assert len({M.class_of(b"zz" + b"aaab", 8), M.class_of(b"aaab", 8)}) == 1
    n, v = sum(counts.values()), len(counts)
    assert sum((c + 1) / (n + v + 1) for c in [*counts.values(), 0]) == pytest.approx(1)


def test_odd_documents(spark, extra):
    rows = M.score_texts(extra, frequent=50, classes=8, states=2, steps=1).collect()
    assert len(rows) == extra.count() and all(r.score < 0 and math.isfinite(r.score) for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert M.score_texts(extra.limit(0), frequent=5, classes=2, states=2, steps=1).count() == 0


def test_a_long_text_is_not_padded_against_short_ones():
    sequences = [np.zeros(n, np.int64) for n in [1_000_000, *[100] * 500, 0]]
    batches = list(M.batches_by_length(sequences, 512))
    assert sorted(i for own in batches for i in own) == list(range(502))
    assert all(len(own) * max(len(sequences[i]) for i in own) <= 1 << 21 for own in batches) and len(batches) == 2
