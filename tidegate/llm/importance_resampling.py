"""Importance resampling of documents towards a target text, on hashed n-grams, with Arrow kernels.

Features of a text are its words and its pairs of neighbouring words, repeats counted; each falls into one of
`buckets` by the CRC-32 of its bytes. Words are lower-cased (A-Z) runs of ASCII letters and digits and of
characters beyond ASCII.

A slice of texts is worked by kernels: `ascii_lower`, `split_pattern_regex`, the flattened list and
`dictionary_encode` give the words as indices into a dictionary. Indices shifted by one form the pairs; only
distinct words and distinct pairs meet the CRC, the latter continuing the CRC of their first word. In the
first pass the slices' bucket counts are summed by Spark, for the corpus and for the target. The gain of a
bucket compares both shares, each with one more feature per bucket. The second pass takes the gain of every
feature and adds up the segment of each document.

A document's score is its floored mean gain plus Gumbel noise that depends on its id and the seed alone, so
taking the highest scores draws documents without replacement by their importance. Scores are ordered by
range partitioning, never in one task.

Null and empty texts have no features and weight 0. A null id counts as the empty text for the noise and stands
after all other ids. Repeated rows have equal scores and ranks of their own. Empty tables are allowed on either
side. Columns of the input pass through; a name that is needed is refused. A text beyond a few megabytes is
worked in pieces that overlap by one word.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.llm.texts import release_memory, slices, small_batches
from tidegate.operators.ordering import number_rows
from tidegate.session import store

#: What separates words, as an expression over UTF-8, and the same as a table of bytes.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SEPARATES = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
#: Texts are worked in slices, long ones in pieces, of about so many bytes.
PIECE = 4 << 20
NEW = ("n_features", "weight", "score", "rank")


def _pieces(text: str) -> list[str]:
    """A text cut at separators; each piece but the first starts with the last word of the one before."""
    if len(text) <= PIECE // 4:
        return [text]
    raw = np.frombuffer(data := text.encode("utf-8", "surrogatepass"), np.uint8)
    gaps = _SEPARATES[raw]
    out, start, at = [], 0, PIECE
    while at < len(raw):
        rest = np.flatnonzero(gaps[at : at + PIECE])
        if not len(rest):
            at += PIECE
            continue
        cut = at + int(rest[0])
        filled = np.flatnonzero(~gaps[start:cut])
        at = cut + PIECE
        if not len(filled):  # nothing but separators so far: no word is carried
            continue
        end = start + int(filled[-1]) + 1
        before = np.flatnonzero(gaps[start:end])
        word = start + int(before[-1]) + 1 if len(before) else start
        if word == start:  # one word fills the piece
            continue
        out.append((start, end))
        start = word
    out.append((start, len(raw)))
    return [data[i:j].decode("utf-8", "surrogatepass") for i, j in out]


def features_of(texts: list[str | None], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every feature, text by text, and how many features each text has."""
    cut = [_pieces(t) if t else [""] for t in texts]
    owner = np.repeat(np.arange(len(cut)), [len(c) for c in cut])
    carried = np.append(False, owner[1:] == owner[:-1]) if len(owner) else np.zeros(0, bool)
    lists = pc.split_pattern_regex(pc.ascii_lower(pa.array([p for c in cut for p in c], pa.string())), pattern=SEPARATORS)
    coded = lists.flatten().dictionary_encode()
    word, piece = coded.indices.to_numpy().astype(np.int64), pc.list_parent_indices(lists).to_numpy().astype(np.int64)
    # A separator at the beginning or the end leaves an empty word.
    filled = (pc.binary_length(coded.dictionary).to_numpy() > 0)[word] if len(word) else np.zeros(0, bool)
    word, piece = word[filled], piece[filled]
    words = coded.dictionary.cast(pa.binary()).to_pylist()
    single = np.fromiter(map(crc32, words), np.int64, len(words))
    joined = np.fromiter((crc32(b" ", c) for c in single.tolist()), np.int64, len(words))
    pair = np.flatnonzero(piece[1:] == piece[:-1])
    distinct, which = np.unique(word[pair] * max(len(words), 1) + word[pair + 1], return_inverse=True)
    first, second = distinct // max(len(words), 1), distinct % max(len(words), 1)
    double = np.fromiter(map(crc32, map(words.__getitem__, second.tolist()), joined[first].tolist()), np.int64, len(distinct))
    # The first word of a carried piece was counted with the piece before.
    own = np.append(True, piece[1:] != piece[:-1])[: len(piece)]
    counted = ~(own & carried[piece])
    text = np.concatenate((owner[piece[counted]], owner[piece[pair]]))
    bucket = np.concatenate((single[word[counted]], double[which])) % buckets
    order = np.argsort(text, kind="stable")
    return bucket[order], np.bincount(text, minlength=len(texts))


def bucket_counts(texts: DataFrame, buckets: int, text: str = "text") -> DataFrame:
    """bucket, n: how many features of all texts fall into it. Each task sends at most one row per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for part in slices(batches, 0, PIECE):
            total += np.bincount(features_of(part.column(0).to_pylist(), buckets)[0], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])
        release_memory()

    small_batches(texts.sparkSession)
    return texts.select(text).mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int, scale: int = 1000) -> DataFrame:
    """bucket, gain: the floored `scale` times log of the target's share over the source's share, for every bucket."""
    every = source.sparkSession.range(buckets).select(F.col("id").alias("bucket"))
    both = every.join(source.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left").fillna(0)
    all_s, all_t = (float(n or 0) for n in both.agg(F.sum("s"), F.sum("t")).first())
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    share = (t + 1) * (all_s + buckets) / ((s + 1) * (all_t + buckets))
    return both.select("bucket", F.floor(scale * F.log(share)).alias("gain"))


def with_weights(docs: DataFrame, gains: np.ndarray, text: str = "text") -> DataFrame:
    """`docs` with n_features and weight, the floored mean of the gains of its features; `gains` has one number per bucket."""
    at, shared = docs.columns.index(text), docs.sparkSession.sparkContext.broadcast(gains)
    shape = T.StructType([*docs.schema.fields, T.StructField("n_features", T.LongType()), T.StructField("weight", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for part in slices(batches, at, PIECE):
            bucket, n = features_of(part.column(at).to_pylist(), len(table))
            upto = np.append(0, np.cumsum(table[bucket]))
            sums = np.diff(upto[np.append(0, np.cumsum(n))])
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(n, pa.int64()), pa.array(sums // np.maximum(n, 1), pa.int64())], names=[*part.schema.names, "n_features", "weight"])
        release_memory()

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, shape)


def gumbel(doc_id: Column, seed: int, scale: int = 1000) -> Column:
    """Floored Gumbel noise that depends on the id as text and the seed alone."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-scale * F.log(-F.log((drawn + 0.5) / float(1 << 32))))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 25, buckets: int = 10_000, seed: int = 7, least_words: int = 20,
    text: str = "text", doc_id: str = "doc_id", keep: list[str] | None = None,
) -> DataFrame:
    """The columns `keep` (all without it) of `docs` with n_features, weight, score and rank.

    Of the documents with at least `least_words` words, `percent` in a hundred (rounded down) with the highest
    scores are drawn and ranked from 1, ties by smaller id; the rank of the others is null.
    """
    keep = list(docs.columns if keep is None else keep)
    clash = {*NEW, "row", "order_1", "order_2"} & {c.lower() for c in keep}
    if clash:
        raise ValueError(f"the table already has {', '.join(sorted(clash))}")
    counts = [store(bucket_counts(df, buckets, text), "bucket_counts") for df in (docs, target)]
    gains = bucket_gains(*counts, buckets)
    table = np.array([r.gain for r in gains.orderBy("bucket").collect()], np.int64)
    carried = list(dict.fromkeys([*keep, doc_id, text]))
    weighed = with_weights(docs.select(*[F.col(f"`{c}`") for c in carried]), table, text)
    score = F.col("weight") + gumbel(F.col(f"`{doc_id}`"), seed)
    scored = store(weighed.withColumn("score", score).withColumn("row", F.monotonically_increasing_id()).select(*keep, *NEW[:3], "row", F.col(f"`{doc_id}`").alias("order_2")), "scored")
    # n words have n and n - 1 features.
    eligible = scored.filter(F.col("n_features") >= 2 * least_words - 1)
    drawn = eligible.count() * percent // 100
    keys = eligible.select((-F.col("score")).alias("order_0"), F.col("order_2").isNull().alias("order_1"), "order_2", "row")
    ranks = number_rows(keys, ["order_0", "order_1", "order_2", "row"], "rank").filter(F.col("rank") <= drawn).select("row", "rank")
    return scored.join(ranks, "row", "left").select(*keep, *NEW)


def drawn(resampled: DataFrame) -> DataFrame:
    """The documents drawn, without the columns that `resample` added."""
    return resampled.filter(F.col("rank").isNotNull()).drop(*NEW)
