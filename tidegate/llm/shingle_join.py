"""Exact n-gram Jaccard self-join with set-relation skipping.

A document's set holds its distinct word 5-grams; two documents link when the Jaccard similarity of
their sets is at least `percent` / 100. The result names connected components, and loses no link.

* **Equal sets** are one set from the start (128-bit key), so exact copies cost nothing further.
* **Prefixes.** All sets are put in one global order: shingles by hash, frequent ones last. Sets that
  link share a shingle among their first n - ceil(n * percent / 100) + 1, so only these are indexed.
  Which shingles count as frequent is estimated on a part of the documents (at most `MOST_FREQUENT`
  are broadcast); any order is correct, a better one only gives shorter lists.
* **Index lists** of one entry are dropped. In each other list every set is paired with one leader;
  pairs whose sketches agree join into clusters of similar sets.
* **Within a cluster** blocks of sets of like size are compared: the overlap of a set with all others
  is derived from the computed overlaps of its most similar leader, by the index lists of just the
  shingles in which both differ; blocks of other sizes are skipped, as are sets that are linked already.
* **Across clusters** entries of one list are paired, skipping by size and by position in the sets, then
  by how many lists have both, then by a 1024-bit parity bitmap whose distance bounds the symmetric
  difference. Survivors are verified.

No step expands equal sets or clusters into all pairs of rows; clusters too large for a task
are dealt into pairs of blocks. Links stay in DataFrames. Sets are read from the texts a second time,
for sets in clusters or surviving pairs (passed through a 2 MB bitmap), rather than stored.

Null or empty texts have an empty set and link with nothing. A null doc_id is never a component's
name unless all its documents have null. Repeated rows are copies of each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidegate.llm.components import components
from tidegate.llm.texts import LOWER_BYTES, release_memory, slices, small_batches
from tidegate.session import discard, store, workspace

WORDS = 5
MOST_FREQUENT = 200_000
SAMPLED_ONE_IN, SAMPLED_LEAST = 16, 3
BITMAP_BITS = 1024
FILTER_BITS = 1 << 24
BLOCK_SETS, BLOCK_SHINGLES = 512, 500_000
LIST_CHUNK = 1024
HEAD = 24

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        table = np.full(max(n, 1 << 16), base, np.uint64)
        table[0] = 1
        have = _POWERS[base] = np.multiply.accumulate(table)
    return have[:n]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, in order; how many words each text has). Letters A-Z count as a-z.

    A word's hash is a polynomial of its bytes, read off running sums over the joined texts.
    """
    joined = np.frombuffer(b" ".join(texts).translate(LOWER_BYTES) + b" ", np.uint8)
    space = _SPACE[joined]
    inside = ~space
    starts = np.flatnonzero(inside & np.concatenate(([True], space[:-1])))
    ends = np.flatnonzero(space[1:] & inside[:-1]) + 1
    running = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum((joined.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(joined)), out=running[1:])
    hashes = (running[ends] - running[starts]) * _powers(_INVERSE, len(joined))[starts]
    borders = np.cumsum([len(t) + 1 for t in texts])
    counts = np.diff(np.searchsorted(starts, borders), prepend=0)
    return _mixed(hashes + (ends - starts).astype(np.uint64)), counts


def shingle_sets(texts: list, words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text of fewer words is one shingle."""
    hashes, counts = word_hashes([(t or "").encode("utf-8", "surrogatepass") for t in texts])
    multiplier = np.uint64(0xD6E8FEB86659FD93)
    n = max(len(hashes) - words + 1, 0)
    windows = np.zeros(n, np.uint64)
    for j in range(words):
        windows = windows * multiplier + hashes[j : j + n]
    windows = _mixed(windows)
    out, at = [], 0
    for c in counts.tolist():
        if c >= words:
            out.append(np.unique(windows[at : at + c - words + 1]))
        elif c:
            short = np.array([c], np.uint64)
            for j in range(at, at + c):
                short = short * multiplier + hashes[j : j + 1]
            out.append(_mixed(short))
        else:
            out.append(np.zeros(0, np.uint64))
        at += c
    return out


def set_key(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def route(key: bytes) -> int:
    """64 bits of the key, by which lists name a set; sets that share them are told apart later."""
    return int.from_bytes(key[:8], "little", signed=True)


def parity_bitmap(tokens: np.ndarray) -> list[int]:
    """Bit b: whether an odd number of shingles falls on b. Differing bits need differing shingles."""
    bits = (np.bincount((tokens >> np.uint64(54)).astype(np.int64), minlength=BITMAP_BITS) & 1).astype(np.uint8)
    return np.packbits(bits).view(np.int64).tolist()


def text_key(text: Column) -> Column:
    """128 bits that tell the texts of rows with one doc_id apart; null for null."""
    return F.unhex(F.md5(text))


def _sets_of(docs: DataFrame, schema: str, make, *more: Column) -> DataFrame:
    """Rows that `make(doc_id, tokens, key, *more)` returns for documents with words, or None for no row."""
    fields = T._parse_datatype_string(schema)
    arrow = [to_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1, 1 << 20):
            rows = []
            others = [c.to_pylist() for c in part.columns[2:]]
            for doc_id, tokens, *own in zip(part.column(0).to_pylist(), shingle_sets(part.column(1).to_pylist()), *others):
                row = make(doc_id, tokens, set_key(tokens), *own)
                if row is not None:
                    rows.append(row)
            columns = list(zip(*rows)) if rows else [()] * len(fields)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), type=t) for c, t in zip(columns, arrow)], names=fields.names,
            )
        release_memory()

    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text", *more).mapInArrow(run, fields)


def _signed(tokens: np.ndarray) -> list[int]:
    return tokens.view(np.int64).tolist()


def frequent_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, sorted; how frequent each is): the most frequent ones, as a part of the documents shows."""
    part = docs.filter(F.pmod(F.xxhash64("text"), F.lit(SAMPLED_ONE_IN)) == 0)
    sets = _sets_of(part, "key binary, tokens array<bigint>", lambda d, t, k: (k, _signed(t)) if len(t) else None)
    single = sets.groupBy("key").agg(F.first("tokens").alias("tokens"))
    counts = single.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    top = counts.filter(F.col("n") >= SAMPLED_LEAST).orderBy(F.col("n").desc(), "token").limit(MOST_FREQUENT).collect()
    tokens = np.array([r.token for r in top], np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], np.array([r.n for r in top], np.int64)[order]


def in_global_order(tokens: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    known, counts = frequent
    if not len(known) or not len(tokens):
        return tokens
    at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
    rank = np.where(known[at] == tokens, counts[at], 0)
    return tokens[np.argsort(rank, kind="stable")] if rank.any() else tokens


def least_overlap(total, percent: int):
    """The least overlap at which sets of `total` shingles together link."""
    return -((-percent * total) // (100 + percent))


def document_sets(docs: DataFrame, percent: int) -> DataFrame:
    """doc_id, row (key of the text), n, key, route, bitmap, head (a sketch: the least hashes) and prefix of every document, stored."""
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_shingles(docs))

    def make(doc_id, tokens, key, row):
        n = len(tokens)
        if not n:
            return doc_id, row, 0, None, None, None, None, None
        prefix = in_global_order(tokens, frequent.value)[: n - -(-percent * n // 100) + 1]
        head = tokens[:HEAD].astype(np.uint32).view(np.int32).tolist()
        return doc_id, row, n, key, route(key), parity_bitmap(tokens), head, _signed(prefix)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, row binary, n bigint, key binary, route bigint, bitmap array<bigint>, head array<int>, prefix array<bigint>"
    return store(_sets_of(docs, schema, make, text_key(F.col("text")).alias("row")), "sets")


def index_lists(sets: DataFrame) -> DataFrame:
    """token, route, n, pos, entries of the list and its leader, for lists of several sets."""
    entry = F.posexplode("prefix").alias("pos", "token")
    rows = sets.select("route", "n", entry).select("token", "route", (F.shiftleft(F.col("n"), 32) + F.col("pos")).alias("place"))
    whole = Window.partitionBy("token")
    lists = rows.select(
        "*", F.count(F.lit(1)).over(whole).alias("entries"),
        F.min(F.struct(F.xxhash64("route").alias("h"), "route")).over(whole)["route"].alias("leader"),
    ).filter("entries > 1")
    return lists.select("token", "route", F.shiftright("place", 32).alias("n"), F.col("place").bitwiseAND(F.lit(0xFFFFFFFF)).alias("pos"), "entries", "leader")


def similar_clusters(lists: DataFrame, sets: DataFrame, share: float) -> DataFrame:
    """(route, cluster) of sets whose heads agree with those of leaders in at least `share`."""
    heads = sets.select("route", "head")
    pairs = lists.filter("route <> leader").select("route", "leader").distinct()
    both = pairs.join(heads, "route").join(heads.select(F.col("route").alias("leader"), F.col("head").alias("other")), "leader")
    alike = both.filter(F.size(F.array_intersect("head", "other")) >= F.lit(share) * F.least(F.size("head"), F.size("other")))
    named = components(alike.select(F.col("route").alias("a"), F.col("leader").alias("b")))
    return named.select(F.col("vertex").alias("route"), F.col("component").alias("cluster"))


def _may_link(n1: Column, n2: Column, percent: int) -> Column:
    return 100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)


def pairs_across(lists: DataFrame, clusters: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of sets in different clusters that no bound excludes."""
    named = lists.join(clusters, "route", "left").withColumn("cluster", F.coalesce("cluster", "route"))
    # A long list is dealt into chunks; a cluster's entries of a chunk are one row, so a list of one
    # cluster pairs with nothing.
    chunk = F.pmod(F.xxhash64("route"), F.ceil(F.col("entries") / LIST_CHUNK))
    groups = named.groupBy("token", "cluster", chunk.alias("chunk")).agg(F.collect_list(F.struct("n", "pos", "route")).alias("sets"))
    mixed = groups.groupBy(F.col("token").alias("of")).agg(F.min("cluster").alias("low"), F.max("cluster").alias("high")).filter("low <> high")
    groups = store(groups.join(mixed, groups["token"] == mixed["of"], "left_semi"), "groups")
    left = groups.select("token", F.col("cluster").alias("c1"), F.col("sets").alias("s1"))
    right = groups.select("token", F.col("cluster").alias("c2"), F.col("sets").alias("s2"))
    smaller = (F.size("s1") < F.size("s2")) | ((F.size("s1") == F.size("s2")) & (F.col("c1") < F.col("c2")))
    met = left.join(right, "token").filter((F.col("c1") != F.col("c2")) & smaller)
    met = met.select(F.explode("s1").alias("x"), "s2")

    def fits(y: Column) -> Column:
        x = F.col("x")
        # What both share lies before the place in either set or from there on.
        most = F.least(x["pos"], y["pos"]) + F.least(x["n"] - x["pos"], y["n"] - y["pos"])
        return _may_link(x["n"], y["n"], percent) & ((100 + percent) * most >= percent * (x["n"] + y["n"]))

    met = met.select("x", F.explode(F.filter("s2", fits)).alias("y"))
    first, second = (F.when((F.col("x.route") < F.col("y.route")) == low, F.col("x")).otherwise(F.col("y")) for low in (True, False))
    met = met.select(first.alias("p"), second.alias("q")).select(F.col("p.route").alias("a"), F.col("q.route").alias("b"), F.col("p.n").alias("n1"), F.col("q.n").alias("n2"))
    # Of two sets that link, at most n - overlap shingles of either are missing in the other, so their
    # prefixes share at least what is left of the shorter one. Every shared one is a list with both.
    least = F.ceil(percent * (F.col("n1") + F.col("n2")) / (100 + percent))
    left_over = [n - F.ceil(percent * n / 100) + 1 - (n - least) for n in (F.col("n1"), F.col("n2"))]
    pairs = met.groupBy("a", "b", "n1", "n2").agg(F.count(F.lit(1)).alias("shared")).filter(F.col("shared") >= F.least(*left_over)).select("a", "b").distinct()
    maps = sets.select("route", "n", "bitmap")
    both = pairs.join(maps.select(F.col("route").alias("a"), F.col("n").alias("n1"), F.col("bitmap").alias("m1")), "a")
    both = both.join(maps.select(F.col("route").alias("b"), F.col("n").alias("n2"), F.col("bitmap").alias("m2")), "b")
    apart = F.aggregate(F.zip_with("m1", "m2", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, x: s + x)
    least = F.ceil(percent * (F.col("n1") + F.col("n2")) / (100 + percent))
    return both.filter(apart <= F.col("n1") + F.col("n2") - 2 * least).select("a", "b")


def block_tasks(clusters: DataFrame, sets: DataFrame) -> DataFrame:
    """(block, route): which sets each comparison of blocks needs.

    A small cluster is one block. A larger one is dealt by size, in classes so wide that sets that link are in
    one class or in neighbouring ones, and by hash into chunks; pairs of chunks that can link are compared.
    """
    members = clusters.join(sets.select("route", "n"), "route").withColumn("class", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.2501))))
    weights = members.groupBy("cluster", "class").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("w"))
    chunks = F.ceil(F.greatest(F.col("m") / BLOCK_SETS, F.col("w") / BLOCK_SHINGLES)).cast("int")
    whole = weights.groupBy("cluster").agg(F.sum("m").alias("all_m"), F.sum("w").alias("all_w"))
    small = (F.col("all_m") <= BLOCK_SETS) & (F.col("all_w") <= BLOCK_SHINGLES)
    sized = weights.join(whole, "cluster").select("cluster", "class", chunks.alias("k"), small.alias("small"))
    near = sized.groupBy("cluster").agg(F.map_from_entries(F.collect_list(F.struct("class", "k"))).alias("ks"), F.first("small").alias("small"))
    placed = members.join(near, "cluster")
    own = F.try_element_at("ks", F.col("class"))
    mine = F.pmod(F.xxhash64("route"), own).cast("int")
    upper, lower = (F.coalesce(F.try_element_at("ks", F.col("class") + d), F.lit(0)) for d in (1, -1))

    def name(kind: str, at: Column, i: Column, j: Column) -> Column:
        return F.concat_ws("/", F.col("cluster").cast("string"), F.lit(kind), at.cast("string"), i.cast("string"), j.cast("string"))

    def each(n: Column, make) -> Column:
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), make)).otherwise(F.array().cast("array<string>"))

    blocks = F.when(F.col("small"), F.array(F.col("cluster").cast("string"))).otherwise(F.concat(
        each(own, lambda j: name("=", F.col("class"), F.least(mine, j), F.greatest(mine, j))),
        each(upper, lambda j: name("+", F.col("class"), mine, j)),
        each(lower, lambda j: name("+", F.col("class") - 1, j, mine)),
    ))
    return placed.select("route", F.explode(F.array_distinct(blocks)).alias("block"))


def linked_in_block(sets: list[np.ndarray], percent: int = 80) -> list[tuple[int, int]]:
    """Links that join the same sets as all links among `sets` (sorted shingle arrays) would."""
    order = sorted(range(len(sets)), key=lambda k: len(sets[k]))
    sizes = np.array([len(sets[k]) for k in order], np.int64)
    owner = np.repeat(np.arange(len(order)), sizes)
    _, token, frequency = np.unique(np.concatenate([sets[k] for k in order]), return_inverse=True, return_counts=True)
    shared = frequency[token] > 1
    owner, token = owner[shared], token[shared]
    by_token = np.argsort(token, kind="stable")  # each list is sorted by size, as sets are
    entries = owner[by_token]
    starts = np.searchsorted(token[by_token], np.arange(len(frequency)))
    lengths = np.diff(np.append(starts, len(entries)))
    begin = np.searchsorted(owner, np.arange(len(order) + 1))
    own = [np.sort(token[begin[i] : begin[i + 1]]) for i in range(len(order))]
    parent = list(range(len(order)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def overlaps(tokens: np.ndarray) -> np.ndarray:
        n = lengths[tokens]
        at = np.repeat(starts[tokens] - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.bincount(entries[at], minlength=len(order))

    links: list[tuple[int, int]] = []
    leaders: list[tuple[int, np.ndarray]] = []
    ends = np.searchsorted(sizes * percent, sizes * 100, "right")  # sets beyond are too large to link
    for i in range(len(order)):
        root = find(i)
        if all(find(j) == root for j in range(i + 1, int(ends[i]))):
            continue
        # The leader whose computed answers are nearest: what it shares with i is among them.
        best = max(leaders, key=lambda e: 2 * e[1][i] - len(own[e[0]]), default=None)
        if best is not None and len(own[best[0]]) < 2 * int(best[1][i]):
            gained = np.setdiff1d(own[i], own[best[0]], assume_unique=True)
            lost = np.setdiff1d(own[best[0]], own[i], assume_unique=True)
            counts = best[1] + overlaps(gained) - overlaps(lost)
        else:
            counts = overlaps(own[i])
            leaders.append((i, counts))
        near = np.arange(i + 1, ends[i])
        hits = near[(100 + percent) * counts[near] >= percent * (sizes[i] + sizes[near])]
        for j in hits.tolist():
            a, b = find(i), find(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((order[i], order[j]))
    return links


def _needed_filter(needed: DataFrame) -> np.ndarray:
    """A bitmap of FILTER_BITS over the routes (hashes themselves): of fixed size, whatever their number."""
    place = F.pmod(F.col("route"), F.lit(FILTER_BITS)) + 1
    rows = needed.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in rows:
        at = (r.bucket - 1) * 4096
        out[at : at + 4096] = np.frombuffer(bytes(r.bits), np.uint8)
    return out


def needed_sets(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """route, key and tokens (binary) of the sets whose route is in `needed` (distinct), stored."""
    bits = docs.sparkSession.sparkContext.broadcast(_needed_filter(needed))

    def make(doc_id, tokens, key):
        place = route(key) % FILTER_BITS
        wanted = len(tokens) and bits.value[place >> 3] >> (place & 7) & 1
        return (route(key), key, tokens.tobytes()) if wanted else None

    found = _sets_of(docs, "route bigint, key binary, tokens binary", make)
    # The bitmap lets a few others through, and copies of a set: one of each that is needed stays.
    return store(found.join(needed, "route", "left_semi").groupBy("route", "key").agg(F.first("tokens").alias("tokens")), "tokens")


def links(docs: DataFrame, sets: DataFrame, percent: int = 80, share: float = 0.3) -> DataFrame:
    """Links (a, b) between keys of different sets, stored: their components are those of all links."""
    with workspace(docs.sparkSession):
        lists = store(index_lists(sets), "lists")
        clusters = store(similar_clusters(lists, sets, share), "clusters")
        across = store(pairs_across(lists, clusters, sets, percent), "across")
        discard(lists)
        needed = store(clusters.select("route").union(across.select("a")).union(across.select("b")).distinct(), "needed")
        tokens = needed_sets(docs, needed)

        def within(group: pd.DataFrame) -> pd.DataFrame:
            keys = group["key"].tolist()
            found = linked_in_block([np.frombuffer(t, np.uint64) for t in group["tokens"]], percent)
            if len(keys) > 100:
                release_memory()
            return pd.DataFrame({"a": [keys[i] for i, _ in found], "b": [keys[j] for _, j in found]})

        blocks = block_tasks(clusters, sets).join(tokens, "route")
        inside = blocks.select("block", "key", "tokens").groupBy("block").applyInPandas(within, "a binary, b binary")
        one = tokens.select(F.col("route").alias("a"), F.col("key").alias("k1"), F.col("tokens").alias("t1"))
        two = tokens.select(F.col("route").alias("b"), F.col("key").alias("k2"), F.col("tokens").alias("t2"))
        pairs = across.join(one, "a").join(two, "b").select("k1", "k2", "t1", "t2")

        def verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                keep = []
                for x, y in zip(frame["t1"], frame["t2"]):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append((100 + percent) * both >= percent * (len(x) + len(y)))
                yield frame.loc[keep, ["k1", "k2"]].rename(columns={"k1": "a", "k2": "b"})

        return store(inside.union(pairs.mapInPandas(verify, "a binary, b binary")), "links", outer=True)


def _with_choice(docs: DataFrame, percent: int) -> DataFrame:
    """doc_id, row, n, component_id and stays of every document: whether it is the row that its component keeps.

    `stays` is the row with the least doc_id, then text key; of rows without a doc_id it is one more.
    """
    rows = document_sets(docs, percent)
    own, lost = F.struct("doc_id", "row"), F.col("doc_id").isNull()
    # One row per set: copies are combined before the shuffle where they are on one executor.
    sets = store(rows.filter("n > 0").groupBy("key").agg(
        F.min(F.when(~lost, own)).alias("first"), F.min(F.when(lost, F.col("row"))).alias("first_lost"),
        F.first("n").alias("n"), F.first("route").alias("route"),
        F.first("bitmap").alias("bitmap"), F.first("head").alias("head"), F.first("prefix").alias("prefix"),
    ), "distinct_sets")
    members = store(rows.select("doc_id", "row", "n", "key"), "members")
    discard(rows)
    joined = components(links(docs, sets, percent))
    named = sets.select("key", "first", "first_lost").join(joined, F.col("key") == F.col("vertex"), "left")
    named = named.select(F.col("key").alias("of"), "first", "first_lost", F.coalesce("component", "key").alias("component"))
    least = named.groupBy("component").agg(F.min("first").alias("first"), F.min("first_lost").alias("first_lost"))
    answer = named.select("of", "component").join(least, "component").select("of", "first", "first_lost")
    found = members.join(answer, members["key"] == answer["of"], "left")
    return found.select(
        "doc_id", "row", "n", F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
        ((F.col("n") == 0) | F.when(lost, F.col("row") == F.col("first_lost")).otherwise(own == F.col("first"))).alias("stays"),
    )


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (the least doc_id reachable over links) of every document."""
    return _with_choice(docs, percent).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The documents without near duplicates: one row of each component stays, the one with the least doc_id.

    Rows are told apart by doc_id and text, so one doc_id may stand on rows of several components. Of a
    component's rows with a null doc_id one stays besides. Rows without words link with nothing; of rows that
    repeat both doc_id and text one stays.
    """
    with workspace(docs.sparkSession):
        found = store(_with_choice(docs, percent).select("doc_id", "row", "stays"), "near_duplicates", outer=True)
    gone = store(found.filter("not stays").select("doc_id", "row").distinct(), "gone")
    repeated = store(found.filter("stays").groupBy("doc_id", "row").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id", "row"), "repeated")
    # Rows that a bitmap of fixed size excludes are neither gone nor repeated: only the others are shuffled with their texts.
    touched = gone.union(repeated)
    place = F.pmod(F.xxhash64("doc_id", "__row"), F.lit(FILTER_BITS)) + 1
    bits = touched.withColumnRenamed("row", "__row").groupBy(F.bitmap_bucket_number(place).alias("__bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("__bits"))
    bits = F.broadcast(store(bits, "touched_bits"))
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("__bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    known = docs.withColumn("__row", text_key(F.col("text")))
    marked = known.join(bits, F.bitmap_bucket_number(place) == F.col("__bucket"), "left")
    hit = F.coalesce(F.call_function("getbit", byte, (at % 8).cast("int")) == 1, F.lit(False))
    marked = marked.withColumn("__hit", hit).drop("__bits", "__bucket")
    free, near = marked.filter("not __hit").drop("__hit"), marked.filter("__hit").drop("__hit")

    def those(rows: DataFrame, among: DataFrame, how: str) -> DataFrame:
        return rows.join(among, rows["doc_id"].eqNullSafe(among["doc_id"]) & rows["__row"].eqNullSafe(among["row"]), how)

    kept = those(near, gone, "left_anti")
    if repeated.isEmpty():
        return free.unionByName(kept).drop("__row")
    first = those(kept, repeated, "left_semi").dropDuplicates(["doc_id", "__row"])
    return free.unionByName(those(kept, repeated, "left_anti")).unionByName(first).drop("__row")
