"""Alignment of two tokenizers over the same text by interval coalescing.

The tokens of both tokenizers are intervals of bytes. All of them, A's and B's together, are sorted by
start (lexsort), the running maximum of their ends is taken (maximum.accumulate), and a group ends
where a start reaches that maximum: there tokens of both sides end. Within a group every A token is
linked with every B token.

Neither tokenizer joins a space with a character before it that is not white space. A text is therefore
cut there into segments that both encode independently, and a segment that occurs often in a slice of
texts is encoded and aligned once. A cut that is not certain is left out, which changes no result.

Two questions need the whole corpus: in how many documents a pair of ids is linked, and which partners
of an A id are linked in most documents. Each document keeps its distinct pairs, and Spark counts them.
The counts return to the documents in two ways. Pairs that hold more than 1 / `frequent` of all rows
(document, pair) are fewer than `frequent`, so they are broadcast as sorted arrays of a proven size;
they include every hot key. The others meet their counts in a shuffled join.

Null and empty texts, and texts whose tokens do not give their bytes again, have no tokens: numbers are
zero and `groups` is empty. Repeated rows and ids count as documents of their own. Columns of the input
pass through; a name that is needed is refused. A text beyond a few megabytes is worked in pieces
that end at a cut; one segment is never divided. Groups beyond 256 links multiply the counts of their
ids instead of listing their links.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidegate.llm.texts import release_memory, slices, small_batches
from tidegate.session import store

#: Folder of the vocabulary files on every machine; a parameter of the functions below.
TOKENIZERS = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: At most so many id pairs are broadcast with their counts.
FREQUENT = 1 << 20
#: Texts are worked in slices, long ones in pieces, of about so many bytes.
PIECE = 4 << 20
_DENSE = 256

# A space after such a byte starts a segment. Left out: ASCII white space and the last bytes of white space
# beyond ASCII and of the piece mark U+2581, whatever comes before them.
_CLOSES = np.ones(256, bool)
_CLOSES[:33] = False
for _wide in "\x85\xa0                　▁":
    _CLOSES[_wide.encode()[-1]] = False


def byte_letters() -> dict[str, int]:
    """The letters of byte-level vocabularies: visible Latin-1 stands for itself, other bytes for letters from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The concatenation of starts[i], starts[i] + 1, … of counts[i] integers each."""
    ends = np.cumsum(counts)
    return np.repeat(starts - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)


def _before(counts: np.ndarray) -> np.ndarray:
    """Sums of all earlier counts."""
    return np.cumsum(counts) - counts


def _binary(offsets: np.ndarray, data, kind: pa.DataType) -> pa.Array:
    return pa.Array.from_buffers(kind, len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), data])


def _flat(lists: list) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(counts.sum())), counts


def _content(values: pa.Array) -> np.ndarray:
    """All bytes of a binary array, one value after the other."""
    edges = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1]
    return np.frombuffer(values.buffers()[2], np.uint8)[edges[0] : edges[-1]] if len(values) else np.zeros(0, np.uint8)


def coalesce(start_a: np.ndarray, end_a: np.ndarray, start_b: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Group numbers of A's and B's tokens, and how many groups there are."""
    start, end = np.concatenate((start_a, start_b)), np.concatenate((end_a, end_b))
    side = np.repeat(np.array([0, 1], np.int8), (len(start_a), len(start_b)))
    order = np.lexsort((side, start))
    reach = np.maximum.accumulate(end[order])
    group = np.empty(len(start), np.int64)
    breaks = np.concatenate(([0], (start[order][1:] >= reach[:-1]).astype(np.int64)))[: len(start)]
    group[order] = np.cumsum(breaks)
    return group[: len(start_a)], group[len(start_a) :], int(breaks.sum()) + 1 if len(start) else 0


# The public split pattern of byte-level tokenizers.
_SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def ranked_encoder(tokenizer, decoded: dict[int, bytes]) -> Callable[[str], list[int]] | None:
    """A faster encoder with the same ids, for a byte-level BPE whose merges stand in the order of their ids; else None."""
    import tiktoken

    spec = json.loads(tokenizer.to_str())
    model, split = spec["model"], spec["pre_tokenizer"] or {}
    plain = model["type"] == "BPE" and not spec["normalizer"] and not any(model[k] for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    if not plain or split.get("type") != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"]:
        return None
    made = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    special = {t["id"] for t in spec["added_tokens"]}
    ranks = {b: i for i, b in decoded.items() if i not in special}
    if any(x >= y for x, y in zip(made, made[1:])) or len(ranks) != len(made) + 256 or sum(len(b) == 1 for b in ranks) != 256:
        return None
    return tiktoken.Encoding("own", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class Aligner:
    """Both tokenizers with their tables, and the alignment of a slice of texts."""

    def __init__(self, a_path: str, b_path: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are parallel already
        self.a, self.b = Tokenizer.from_file(a_path), SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        letters = byte_letters()
        vocabulary = {i: t for t, i in self.a.get_vocab().items()}
        self.n_a, self.n_b = max(vocabulary) + 1, self.b.get_piece_size()
        decoded = [bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t in (vocabulary.get(i, "") for i in range(self.n_a))]
        pieces = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(map(self.b.id_to_piece, range(self.n_b)))]
        self.a_bytes, self.b_bytes = pa.array(decoded, pa.binary()), pa.array(pieces, pa.binary())
        self.a_len, self.b_len = (np.array([len(x) for x in t], np.int64) for t in (decoded, pieces))
        self.encode_a = ranked_encoder(self.a, dict(enumerate(decoded))) or (lambda s: self.a.encode(s, add_special_tokens=False).ids)
        self.lone = self.b.piece_to_id("▁")
        self.most = max(self.n_a, self.n_b)
        #: Decimals followed by each separator: between ids of a side, between the sides, after a group.
        self.decimals = pa.array([f"{i}{mark}".encode() for mark in ",|;" for i in range(self.most)], pa.binary())
        self.pair_bits = (self.n_a * self.n_b).bit_length()

    def encode(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids and counts of both sides. A segment starts with a space, which B adds by itself."""
        own = list(map(self.encode_a, segments))
        other = self.b.encode([s[1:] for s in segments], num_threads=1)
        other = [[self.lone] if s == " " else ids for s, ids in zip(segments, other)]
        return *_flat(own), *_flat(other)

    def spelt(self, segments: pa.Array, lengths: np.ndarray, ids: np.ndarray, counts: np.ndarray, size: np.ndarray, table: pa.Array) -> np.ndarray:
        """Which segments the bytes of their tokens give again."""
        owner = np.repeat(np.arange(len(counts)), counts)
        good = np.bincount(owner, size[ids], len(counts)).astype(np.int64) == lengths
        made = _content(pc.take(table, pa.array(ids[good[owner]])))
        wanted = _content(segments.filter(pa.array(good)))
        if not np.array_equal(made, wanted):
            place = np.repeat(np.flatnonzero(good), lengths[good])
            good[place[made != wanted]] = False
        return good

    def align(self, texts: list[bytes]) -> dict[str, np.ndarray | pa.Array]:
        """Per text (none of them empty): good, n_a, n_b, n_groups, n_links, groups, and its distinct pairs with their times."""
        n = len(texts)
        data = b"".join(b" " + t for t in texts)
        raw = np.frombuffer(data, np.uint8)
        begins = _before(np.array([len(t) + 1 for t in texts], np.int64))
        first = np.zeros(len(raw), bool)
        first[1:] = (raw[1:] == 32) & _CLOSES[raw[:-1]]
        first[begins] = True
        at = np.flatnonzero(first)
        unit = np.searchsorted(begins, at, "right") - 1
        coded = _binary(np.append(at, len(raw)), pa.py_buffer(data), pa.binary()).dictionary_encode()
        segment, segments = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        k = len(segments)
        a, count_a, b, count_b = self.encode(segments.cast(pa.string()).to_pylist())
        lengths = pc.binary_length(segments).to_numpy().astype(np.int64)
        good = self.spelt(segments, lengths, a, count_a, self.a_len, self.a_bytes) & self.spelt(segments, lengths, b, count_b, self.b_len, self.b_bytes)
        # Segments whose bytes differ are emptied here; their texts have no tokens at all.
        a, b = a[np.repeat(good, count_a)], b[np.repeat(good, count_b)]
        count_a, count_b = count_a * good, count_b * good
        end_a, end_b = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        group_a, group_b, n_groups = coalesce(end_a - self.a_len[a], end_a, end_b - self.b_len[b], end_b)
        size_a, size_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
        first_a, first_b = _before(size_a), _before(size_b)
        owner = np.repeat(np.arange(k), count_a)[first_a] if n_groups else np.zeros(0, np.int64)
        groups, links = np.bincount(owner, minlength=k), np.bincount(owner, size_a * size_b, k).astype(np.int64)

        # The groups as text: ids in group order, A before B, each followed by its separator.
        place_a, place_b = np.arange(len(a)) + first_b[group_a], np.arange(len(b)) + first_a[group_b] + size_a[group_b]
        shown = np.empty(len(a) + len(b), np.int64)
        shown[place_a] = a + self.most * (np.arange(len(a)) == first_a[group_a] + size_a[group_a] - 1)
        shown[place_b] = b + 2 * self.most * (np.arange(len(b)) == first_b[group_b] + size_b[group_b] - 1)
        written = pc.take(self.decimals, pa.array(shown))
        width = pc.binary_length(written).to_numpy().astype(np.int64)
        edges = np.append(0, np.cumsum(width))[np.append(0, np.cumsum(count_a + count_b))]
        per_segment = _binary(edges, written.buffers()[2], pa.binary())
        whole = per_segment.take(pa.array(segment))
        edges = np.append(0, np.cumsum(np.bincount(unit, np.diff(edges)[segment], n).astype(np.int64)))
        text = pc.ascii_rtrim(_binary(edges, whole.buffers()[2], pa.string()), ";")

        pairs, times, per_text = self.pairs(a, b, group_b, size_a, size_b, first_a, first_b, owner, k, unit * k + segment)
        fine = np.bincount(unit, ~good[segment], n) == 0
        total = {m: np.bincount(unit, v[segment], n).astype(np.int64) for m, v in (("n_a", count_a), ("n_b", count_b), ("n_groups", groups), ("n_links", links))}
        return total | {"good": fine, "groups": text, "pairs": pairs, "times": times, "n_pairs": np.bincount(per_text, minlength=n)}

    def pairs(self, a, b, group_b, size_a, size_b, first_a, first_b, owner, k, used):
        """Distinct linked pairs of each text with how often they are linked; `used` is text * k + segment of every occurrence."""
        dense = size_a * size_b > _DENSE
        of_b = np.flatnonzero(~dense[group_b])
        reps = size_a[group_b[of_b]]
        key = a[_ranges(first_a[group_b[of_b]], reps)] * self.n_b + np.repeat(b[of_b], reps)
        seg, times = owner[np.repeat(group_b[of_b], reps)], np.ones(len(key), np.int64)
        more = [(key, seg, times)]
        for g in np.flatnonzero(dense).tolist():
            ids_a, n_a = np.unique(a[first_a[g] : first_a[g] + size_a[g]], return_counts=True)
            ids_b, n_b = np.unique(b[first_b[g] : first_b[g] + size_b[g]], return_counts=True)
            more.append((np.add.outer(ids_a * self.n_b, ids_b).ravel(), np.full(len(ids_a) * len(ids_b), owner[g]), np.outer(n_a, n_b).ravel()))
        if len(more) > 1:
            key, seg, times = (np.concatenate(x) for x in zip(*more))
            order = np.argsort(seg, kind="stable")
            key, seg, times = key[order], seg[order], times[order]
        per_segment = np.bincount(seg, minlength=k)
        uses, often = np.unique(used, return_counts=True)
        text, segment = uses // max(k, 1), uses % max(k, 1)
        reps = per_segment[segment]
        at = _ranges(_before(per_segment)[segment], reps)
        return summed((np.repeat(text, reps) << self.pair_bits) | key[at], times[at] * np.repeat(often, reps), self.pair_bits)


def summed(keys: np.ndarray, times: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order with their summed times: the low bits of each key, the sums, the high bits."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    sums = np.add.reduceat(times[order], first) if len(first) else times[:0]
    return keys[first] & ((1 << bits) - 1), sums, keys[first] >> bits


@lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def _pieces(text: bytes) -> list[bytes]:
    """A long text cut into pieces of at least `PIECE` bytes, each but the first without the space that `align` adds."""
    raw = np.frombuffer(text, np.uint8)
    cuts, at = [], PIECE
    while at < len(raw):
        window = raw[at - 1 : at + PIECE]
        found = np.flatnonzero((window[1:] == 32) & _CLOSES[window[:-1]])
        at += int(found[0]) if len(found) else PIECE
        if len(found):
            cuts.append(at)
            at += PIECE
    return [text[i + (i > 0) : j] for i, j in zip([0, *cuts], [*cuts, len(text)])]


NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def _aligned_type(pair: T.DataType) -> T.StructType:
    numbers = [T.StructField(n, T.LongType()) for n in NUMBERS]
    lists = [T.StructField("pairs", T.ArrayType(pair)), T.StructField("times", T.ArrayType(T.LongType()))]
    return T.StructType([*numbers, T.StructField("groups", T.StringType()), *lists])


def _align_texts(tool: Aligner, texts: list[str | None], kind: T.StructType) -> pa.StructArray:
    """One struct for each text of a bounded slice."""
    raw = [(t or "").encode() for t in texts]
    cut = [_pieces(t) if t else [] for t in raw]
    counts = np.array([len(c) for c in cut], np.int64)
    parts = []
    flat = [p for c in cut for p in c]
    if counts.max(initial=0) > 1:  # a long text: one piece at a time
        parts = [tool.align([p]) for p in flat]
    elif flat:
        parts = [tool.align(flat)]
    n = len(raw)
    of_piece = np.repeat(np.arange(n), counts)
    joined = {m: np.concatenate([p[m] for p in parts]) if parts else np.zeros(0, np.int64) for m in (*NUMBERS, "good", "pairs", "times", "n_pairs")}
    good = np.bincount(of_piece, ~joined["good"].astype(bool), n) == 0
    numbers = [np.bincount(of_piece, joined[m], n).astype(np.int64) * good for m in NUMBERS]
    shown = [t for p in parts for t in p["groups"].to_pylist()]
    edges = np.append(0, np.cumsum(counts))
    groups = [";".join(shown[i:j]) if g else "" for g, i, j in zip(good, edges[:-1], edges[1:])]
    of_pair = np.repeat(of_piece, joined["n_pairs"])
    pairs, times, owner = joined["pairs"], joined["times"], of_pair
    if counts.max(initial=0) > 1:
        pairs, times, owner = summed((of_pair << tool.pair_bits) | pairs, times, tool.pair_bits)
    kept = good[owner] if len(owner) else np.zeros(0, bool)
    offsets = np.append(0, np.cumsum(np.bincount(owner[kept], minlength=n)))
    types = [f.type for f in to_arrow_type(kind)]
    lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(v[kept], t.value_type)).cast(t) for v, t in ((pairs, types[-2]), (times, types[-1]))]
    return pa.StructArray.from_arrays([*map(pa.array, numbers), pa.array(groups, pa.string()), *lists], fields=list(to_arrow_type(kind)))


def align(docs: DataFrame, text: str = "text", folder: str = TOKENIZERS, a_file: str = A_FILE, b_file: str = B_FILE, name: str = "aligned") -> DataFrame:
    """`docs` with the struct `name`: n_a, n_b, n_groups, n_links, groups (ids `a1,a2|b1;a3|b2,b3`), and the
    distinct linked pairs with how often each is linked. A pair is the A id times the size of B's vocabulary plus the B id.
    """
    if name in docs.columns:
        raise ValueError(f"the table already has a column {name}")
    a_path, b_path = f"{folder}/{a_file}", f"{folder}/{b_file}"
    tool = aligner(a_path, b_path)
    kind = _aligned_type(T.IntegerType() if tool.n_a * tool.n_b < 1 << 31 else T.LongType())
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(a_path, b_path)
        for part in slices(batches, at, PIECE):
            made = _align_texts(own, part.column(at).to_pylist(), kind)
            yield pa.RecordBatch.from_arrays([*part.columns, made], names=[*part.schema.names, name])
        release_memory()

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, kind)]))


def vocabulary_sizes(folder: str = TOKENIZERS, a_file: str = A_FILE, b_file: str = B_FILE) -> tuple[int, int]:
    tool = aligner(f"{folder}/{a_file}", f"{folder}/{b_file}")
    return tool.n_a, tool.n_b


def pair_counts(kept: DataFrame, n_b: int) -> DataFrame:
    """pair, n (documents that hold it linked), best (no partner of its A id is in more)."""
    counts = store(kept.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "pair_counts")
    own = F.floor(F.col("pair") / n_b)
    top = counts.groupBy(own.alias("a")).agg(F.max("n").alias("most"))
    return counts.join(top, own == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _frequent_sums(index) -> Callable:
    """Adds up what the broadcast pairs give, and lists the other pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = index.value
        for batch in batches:
            lists, weights = batch.column(1), batch.column(2)
            sizes = pc.list_value_length(lists).to_numpy().astype(np.int64)
            keys, times = lists.flatten().to_numpy(), weights.flatten().to_numpy()
            row = np.repeat(np.arange(len(sizes)), sizes)
            at = np.minimum(np.searchsorted(pair, keys), max(len(pair) - 1, 0))
            known = pair[at] == keys if len(pair) else np.zeros(len(keys), bool)
            score = np.zeros((2, len(keys)), np.int64)
            score[:, known] = n[at[known]] * times[known], best[at[known]] * times[known]
            edges = np.append(0, np.cumsum(sizes))
            sums = [np.diff(np.append(0, np.cumsum(s))[edges]) for s in score]
            rest = np.append(0, np.cumsum(np.bincount(row[~known], minlength=len(sizes))))
            rare = [pa.ListArray.from_arrays(pa.array(rest, pa.int32()), pa.array(v[~known])) for v in (keys, times)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, sums), *rare], names=["row", "count_sum", "n_best", "rare", "times"])
        release_memory()

    return run


def pair_scores(kept: DataFrame, counts: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """row, count_sum and n_best of `kept` (row, pairs, times): sums over all links of what `counts` says of their pair."""
    spark = kept.sparkSession
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") * frequent > total
    chosen = counts.filter(hot).orderBy("pair").toArrow()
    index = spark.sparkContext.broadcast(tuple(chosen.column(c).to_numpy() for c in ("pair", "n", "best")))
    kind = kept.schema["pairs"].dataType.simpleString()
    shape = f"row bigint, count_sum bigint, n_best bigint, rare {kind}, times array<bigint>"
    summed_up = store(kept.select("row", "pairs", "times").mapInArrow(_frequent_sums(index), shape), "frequent_sums")
    rest = summed_up.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("pair"), "x.times")
    met = rest.join(counts.filter(~hot), "pair")
    late = met.groupBy("row").agg(F.sum(F.col("times") * F.col("n")).alias("count_sum"), F.sum(F.col("times") * F.col("best").cast("long")).alias("n_best"))
    both = summed_up.select("row", "count_sum", "n_best").unionByName(late)
    return both.groupBy("row").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))


def align_corpus(docs: DataFrame, text: str = "text", folder: str = TOKENIZERS, frequent: int = FREQUENT) -> DataFrame:
    """`docs` without its text, with n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 (of the text `groups`).

    count_sum adds up, over all links of a document, in how many documents the pair of ids is linked; n_best counts the
    links to a partner that is linked with their A id in most documents, ties included.
    """
    new = [*NUMBERS, "n_best", "count_sum", "groups_sha256"]
    clash = {*new, "aligned", "row", "pairs", "times"} & {c.lower() for c in docs.columns}
    if clash:
        raise ValueError(f"the table already has {', '.join(sorted(clash))}")
    carried = [c for c in docs.columns if c != text]
    made = align(docs.withColumn("row", F.monotonically_increasing_id()), text, folder)
    digest = F.when(F.col("aligned.groups") == "", "").otherwise(F.sha2("aligned.groups", 256))
    kept = store(made.select(*carried, "row", *[f"aligned.{n}" for n in NUMBERS], digest.alias("groups_sha256"), "aligned.pairs", "aligned.times"), "aligned")
    counts = store(pair_counts(kept, vocabulary_sizes(folder)[1]), "pair_table")
    sums = pair_scores(kept, counts, frequent)
    return kept.drop("pairs", "times").join(sums, "row").select(*carried, *new)
