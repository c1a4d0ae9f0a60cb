"""Alignment against a plain version that encodes whole texts and compares the ends of tokens."""

import hashlib
import random
from collections import Counter, defaultdict
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import DOCUMENTS
from tidegate.llm import token_alignment as M
from tidegate.llm.queries import QUERIES

BITS = [
    "a", "the", " ", "  ", "   ", "\n", "\n ", "\t", "▁", "▁▁", "\xa0", " \xa0", "　", " ", "1", "12345", "<|endoftext|>", "<s>", "</s>",
    "<unk>", "<0x41>", "'s", "'ll", "!", "...", "日本語", "é", "é", "😀", "ſ", "K", "İ", "\x00", "\x7f", "\x85", "​", "﻿", "ß", "—", "==",
]


@pytest.fixture(scope="module")
def tool():
    return M.aligner(f"{M.TOKENIZERS}/{M.A_FILE}", f"{M.TOKENIZERS}/{M.B_FILE}")


def by_hand(tool, text):
    """n_a, n_b, n_groups, groups as text and the linked pairs of ids with their times."""
    nothing = 0, 0, 0, "", Counter()
    if not text:
        return nothing
    letters, wanted = M.byte_letters(), (" " + text).encode()
    a, b = tool.a.encode(" " + text, add_special_tokens=False).ids, tool.b.encode(text)
    bytes_a = [bytes(letters[c] for c in tool.a.id_to_token(i)) for i in a]
    bytes_b = [bytes([int(tool.b.id_to_piece(i)[3:5], 16)]) if tool.b.is_byte(i) else tool.b.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if b"".join(bytes_a) != wanted or b"".join(bytes_b) != wanted:
        return nothing
    ends = [{end: i + 1 for i, end in enumerate(accumulate(map(len, side)))} for side in (bytes_a, bytes_b)]
    groups, done = [], [0, 0]
    for cut in sorted(set(ends[0]) & set(ends[1])):
        upto = [e[cut] for e in ends]
        groups.append((a[done[0] : upto[0]], b[done[1] : upto[1]]))
        done = upto
    pairs = Counter((x, y) for own, other in groups for x in own for y in other)
    return len(a), len(b), len(groups), ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups), pairs


def corpus_by_hand(tool, texts):
    """The digest columns of every text; `texts` by id."""
    made = {k: by_hand(tool, t) for k, t in texts.items()}
    count = Counter(p for m in made.values() for p in m[4])
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    rows = {}
    for k, (n_a, n_b, n_groups, groups, pairs) in made.items():
        best = sum(n for p, n in pairs.items() if count[p] == most[p[0]])
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        rows[k] = (n_a, n_b, n_groups, sum(pairs.values()), best, sum(n * count[p] for p, n in pairs.items()), digest)
    return rows


def as_rows(df):
    return {r.doc_id: tuple(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")) for r in df.collect()}


def plain(tool, struct):
    pairs = Counter({divmod(p, tool.n_b): n for p, n in zip(struct["pairs"], struct["times"])})
    return struct["n_a"], struct["n_b"], struct["n_groups"], struct["groups"], pairs


@pytest.mark.parametrize("piece", [M.PIECE, 40])
def test_segments_and_pieces_give_what_whole_texts_give(tool, monkeypatch, piece):
    monkeypatch.setattr(M, "PIECE", piece)
    draw = random.Random(piece)
    texts = ["".join(draw.choices(BITS, k=draw.randint(0, 25))) for _ in range(1500)]
    texts += [None, "", " ", "x" + " " * 99, "-" * 300, " " * 1201 + "x", "ab" * 700]
    made = M._align_texts(tool, texts, M._aligned_type(M.T.IntegerType())).to_pylist()
    for text, struct in zip(texts, made):
        own = by_hand(tool, text)
        assert plain(tool, struct) == own and struct["n_links"] == sum(own[4].values()), repr(text)
    assert sum(s["n_a"] == 0 for s in made) > 100 and sum(s["n_a"] > 0 for s in made) > 400


def test_ranked_encoder_equals_the_tokenizer(tool, documents):
    texts = [r.text for r in documents.select("text").collect() if r.text]
    assert M.ranked_encoder(tool.a, {i: x.as_py() for i, x in enumerate(tool.a_bytes)})
    assert [tool.encode_a(t) for t in texts] == [tool.a.encode(t, add_special_tokens=False).ids for t in texts]


def test_coalesce_breaks_where_the_running_maximum_is_reached():
    np = M.np
    a, b = np.array([0, 2, 5, 6]), np.array([0, 3, 6])
    group_a, group_b, n = M.coalesce(a, np.array([2, 5, 6, 9]), b, np.array([3, 6, 9]))
    assert (group_a.tolist(), group_b.tolist(), n) == ([0, 0, 0, 1], [0, 0, 1], 2)
    assert M.coalesce(*[np.zeros(0, np.int64)] * 4)[2] == 0


def test_query_equals_brute_force(spark, folder, documents, tool):
    rows = as_rows(QUERIES["op11_token_alignment"](spark, folder))
    assert rows == corpus_by_hand(tool, {r.doc_id: r.text for r in documents.collect()})


@pytest.mark.parametrize("frequent", [1, 50, M.FREQUENT])
def test_broadcast_pairs_and_joined_pairs_agree(spark, tool, frequent):
    texts = {k: " ".join(f"word{i % 7} x{i * k}" for i in range(40)) for k in range(12)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert as_rows(M.align_corpus(df, frequent=frequent)) == corpus_by_hand(tool, texts)


def test_odd_documents(spark, extra, tool):
    rows = M.align_corpus(extra).drop("lang").collect()
    texts = dict(enumerate(r.text for r in extra.collect()))
    assert sorted((r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in rows) == sorted(corpus_by_hand(tool, texts).values())
    assert {"size", "score", "hits"} <= set(rows[0].asDict())
    assert M.align_corpus(extra.limit(0)).count() == 0
    one = spark.createDataFrame([(1, None, None, None, None)], DOCUMENTS)
    assert M.align_corpus(one).select("n_a", "groups_sha256").first() == (0, "")


def test_a_needed_name_is_refused(documents):
    for name in ("aligned", "row", "N_best"):
        with pytest.raises(ValueError):
            M.align_corpus(documents.withColumn(name, F.lit(1)))
