"""Benchmark decontamination: find words of documents that lie inside windows of benchmark items.

Words are lower-cased (A-Z) runs of ASCII letters and digits and of characters beyond ASCII. A window
is `size` consecutive words of an item; an item of fewer words, but not none, is one window.

The windows become a hash set that is broadcast. Its size is bounded: distinct pairs of window and item are made by
tasks, counted with their bytes, and dealt by their own hash into blocks of about `block_windows` pairs and
`block_bytes` bytes at most, so neither a huge item nor a repeated id makes a block larger. Documents are scanned block
by block, each pass adding to the hits that the last one stored, which is then deleted. Usually there is one block and
one pass without a shuffle. A scan maps words to the block's vocabulary, keeps the
runs of known words, looks up the hash of each window there, and verifies the words of each hit.

Null texts have no words. Items without words have no window. Items with equal ids count once; a null
id counts as the empty text. Repeated documents are judged each on its own. Columns of the documents
pass through, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.llm.texts import LOWER_BYTES, annotate
from tidegate.session import discard, store

#: Every ASCII byte that is neither letter nor digit separates words.
_WORDS = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in LOWER_BYTES)
_MIX = np.uint64(0x9E3779B97F4A7C15)

HITS = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("starts", T.ArrayType(T.LongType())),
    T.StructField("ends", T.ArrayType(T.LongType())),
    T.StructField("items", T.ArrayType(T.StringType())),
])


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


def _hash(ids: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    h = np.zeros(len(at), np.uint64)
    for j in range(length):
        h = (h ^ ids[at + j].astype(np.uint64)) * _MIX
        h ^= h >> np.uint64(29)
    return h


class WindowIndex:
    """The windows of one block of items: vocabulary, and by window length sorted hashes with their items."""

    def __init__(self, items: list[tuple[str, list[bytes]]], size: int):
        self.words: dict[bytes, int] = {}
        self.items = sorted({i for i, _ in items})
        number = {item: k for k, item in enumerate(self.items)}
        found: dict[int, dict[tuple[int, ...], set[int]]] = {}
        for item, words in items:
            ids = [self.words.setdefault(w, len(self.words)) for w in words]
            length = min(size, len(ids))
            for i in range(len(ids) - length + 1 if length else 0):
                found.setdefault(length, {}).setdefault(tuple(ids[i : i + length]), set()).add(number[item])
        self.by_length = {}
        for length, windows in found.items():
            rows = np.array(list(windows), np.int64)
            hashes = _hash(rows.ravel(), np.arange(len(rows)) * length, length)
            order = np.argsort(hashes, kind="stable")
            owners = list(windows.values())
            self.by_length[length] = (hashes[order], rows[order], [sorted(owners[k]) for k in order])

    def scan(self, texts: list) -> list[tuple[int, list[tuple[int, int]], set[str]]]:
        """Per text: words, word spans inside windows (merged), items that occur."""
        get = self.words.get
        parts, starts, counts, total = [], [], [], 0
        for text in texts:
            words = words_of(text)
            parts.append(np.fromiter((get(w, -1) for w in words), np.int64, len(words)))
            parts.append(np.array([-1]))  # no window crosses the end of a text
            starts.append(total)
            counts.append(len(words))
            total += len(words) + 1
        ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        unknown = np.concatenate(([0], np.cumsum(ids < 0)))
        spans: list[tuple[int, int]] = []
        items: list[set[str]] = [set() for _ in texts]
        begin = np.array(starts, np.int64)
        for length, (hashes, windows, owners) in self.by_length.items():
            if len(ids) < length:
                continue
            at = np.flatnonzero(unknown[length:] == unknown[:-length])
            h = _hash(ids, at, length)
            lo, hi = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
            for place, a, b in zip(at[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist()):
                for k in range(a, b):
                    if np.array_equal(ids[place : place + length], windows[k]):
                        spans.append((place, place + length))
                        doc = int(np.searchsorted(begin, place, "right")) - 1
                        items[doc].update(self.items[o] for o in owners[k])
        by_doc: dict[int, list[tuple[int, int]]] = {}
        for a, b in sorted(spans):
            doc = int(np.searchsorted(begin, a, "right")) - 1
            a, b = a - starts[doc], b - starts[doc]
            own = by_doc.setdefault(doc, [])
            if own and a <= own[-1][1]:
                own[-1] = (own[-1][0], max(b, own[-1][1]))
            else:
                own.append((a, b))
        return [(counts[d], by_doc.get(d, []), items[d]) for d in range(len(texts))]


def windows_of(benchmark: DataFrame, size: int) -> DataFrame:
    """Distinct (item, window): the windows of `benchmark`, each as its words joined by a space; null ids are the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                for first in range(0, len(words), 10_000):
                    last = min(first + 10_000, max(len(words) - size, 0) + 1)
                    made = [b" ".join(words[i : i + size]) for i in range(first, last)]
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(made), pa.string()), pa.array(made, pa.binary())], names=["item", "window"])

    listed = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    return listed.mapInArrow(run, "item string, window binary").distinct()


def find_hits(
    docs: DataFrame, benchmark: DataFrame, size: int = 13, block_windows: int = 400_000, block_bytes: int = 64 << 20, name: str = "hits"
) -> DataFrame:
    """`docs` with the struct `name`: n_words, starts and ends of hit word spans, items as texts."""
    if name in docs.columns:
        raise ValueError(f"the table already has a column {name}")
    spark = docs.sparkSession
    windows = store(windows_of(benchmark, size), "windows")
    total = windows.agg(F.count(F.lit(1)), F.sum(F.length("window") + F.length("item"))).first()
    n_blocks = 1 + max(total[0] // block_windows, (total[1] or 0) // block_bytes)
    dealt = F.pmod(F.xxhash64("window", "item"), F.lit(n_blocks))
    current = docs
    for block in range(n_blocks):
        part = windows.filter(dealt == block).collect()
        index = spark.sparkContext.broadcast(WindowIndex([(r["item"], bytes(r["window"]).split()) for r in part], size))
        found = annotate(current, "text", f"__hits_{block}", HITS, _scanner(index))
        before, current = current, found if n_blocks == 1 else store(found, f"hits_{block}")
        if n_blocks > 1:
            index.unpersist()
        if block:
            discard(before)
    blocks = [F.col(f"__hits_{b}") for b in range(n_blocks)]
    if n_blocks == 1:
        return current.withColumnRenamed("__hits_0", name)
    spans = F.array_sort(F.concat(*[F.arrays_zip(b["starts"], b["ends"]) for b in blocks]))
    merged = F.aggregate(
        spans, F.array().cast("array<struct<starts:bigint,ends:bigint>>"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["ends"] >= s["starts"]),
            F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(F.struct(
                F.try_element_at(done, F.lit(-1))["starts"].alias("starts"),
                F.greatest(F.try_element_at(done, F.lit(-1))["ends"], s["ends"]).alias("ends"),
            ))),
        ).otherwise(F.concat(done, F.array(s))),
    )
    hits = F.struct(
        blocks[0]["n_words"].alias("n_words"), merged["starts"].alias("starts"), merged["ends"].alias("ends"),
        F.array_sort(F.array_distinct(F.concat(*[b["items"] for b in blocks]))).alias("items"),
    )
    return current.select(*docs.columns, hits.alias(name))


def _scanner(index):
    def scan(texts: list) -> list[tuple]:
        return [(n, [a for a, _ in spans], [b for _, b in spans], sorted(items)) for n, spans, items in index.value.scan(texts)]

    return scan


def n_hit(hits):
    return F.aggregate(F.zip_with(hits["starts"], hits["ends"], lambda a, b: b - a), F.lit(0).cast("bigint"), lambda s, x: s + x)


def contaminated(hits):
    """At least one word in twenty is hit."""
    return (n_hit(hits) > 0) & (20 * n_hit(hits) >= hits["n_words"])


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def without_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = 13) -> DataFrame:
    """The documents that are not contaminated, unchanged."""
    return find_hits(docs, benchmark, size, name="__hits").filter(~contaminated(F.col("__hits"))).select(*docs.columns)


def without_hit_spans(docs: DataFrame, benchmark: DataFrame, size: int = 13) -> DataFrame:
    """All documents, with the words of benchmark windows cut out of the texts, each cut leaving one space."""
    found = find_hits(docs, benchmark, size, name="__hits")
    cut = annotate(
        found.withColumn("__cut", F.struct(F.col("text"), F.col("__hits.starts").alias("starts"), F.col("__hits.ends").alias("ends"))),
        "__cut", "__left", T.StructType([T.StructField("text", T.StringType())]), _cut_spans,
    )
    return cut.select(*[F.col("__left.text").alias("text") if c == "text" else F.col(c) for c in docs.columns])


def _cut_spans(rows: list) -> list[tuple]:
    out = []
    for row in rows:
        text, starts = row["text"], row["starts"]
        if not starts:
            out.append((text,))
            continue
        raw = text.encode("utf-8", "surrogatepass")
        marked = raw.translate(_WORDS)
        places, at = [], 0
        for word in marked.split():
            at = marked.index(word, at)
            places.append((at, at + len(word)))
            at += len(word)
        kept, done = [], 0
        for a, b in zip(starts, row["ends"]):
            kept.append(raw[done : places[a][0]])
            done = places[b - 1][1]
        kept.append(raw[done:])
        out.append((b" ".join(k.strip() for k in kept).strip().decode("utf-8", "surrogatepass"),))
    return out
