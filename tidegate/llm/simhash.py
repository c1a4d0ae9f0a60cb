"""Document fingerprints by SimHash, with DataFrame functions only.

The terms of a text are its runs of `RUN` lower-cased words, each as often as it occurs. A term's two
64-bit hashes vote on 128 signed bits, once for each occurrence; the bits with more votes for than
against make the fingerprint. Votes are counted in packed lanes: `(hash >> i) & 0x0001000100010001`
adds to four bits at a time, so 32 sums of longs hold all votes of up to `PIECE` terms, and pieces of
a long text are summed in wider lanes. Equal texts have equal fingerprints.

`neighbours` finds all fingerprints within a Hamming radius by permuted block tables: bits are cut into
radius + 2 blocks, and any fingerprint within the radius agrees in at least two blocks; there is one table
for each pair of blocks, in which fingerprints meet by the values of both.

The search finds exact and almost exact copies: 3 of 128 bits are a cosine of 0.997. The README has the
measured recall for pairs of lesser likeness; near copies at 0.8 are the matter of `shingle_join`.

Null is the empty text; texts without words share one term. Rows equal in doc_id and text are one
document, with their number in `copies`. An empty table gives an empty result, and in a table of one document it is its own next.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.texts import SPACES
from tidegate.operators.ordering import stored_in_order
from tidegate.session import store

RUN = 3
BITS = 128
PIECE = 32_000  # terms; lanes of 16 bits hold fewer than 32,768 votes without touching the sign
_NARROW, _WIDE = 0x0001000100010001, 0x0000FFFF0000FFFF
KEY = ["k1", "k2"]


def row_key(doc_id: Column, text: Column) -> list[Column]:
    """128 bits that name a row by its id and text."""
    return [F.xxhash64(F.lit(k), doc_id.isNull(), doc_id, text).alias(f"k{k}") for k in (1, 2)]


def fingerprints(texts: DataFrame, by: list[str]) -> DataFrame:
    """`by` and the fingerprint (f1, f2) of `text`. `by` must name a row of `texts`."""
    trimmed = F.lower(F.btrim("text", F.lit(SPACES)))
    words = texts.select(*by, F.split(trimmed, "[ \\t-\\r]+").alias("w0"))
    words = words.select(*by, "w0", *[F.slice("w0", k + 1, F.size("w0")).alias(f"w{k}") for k in range(1, RUN)])
    runs = F.arrays_zip(*[F.col(f"w{k}") for k in range(RUN)])
    terms = words.select(*by, F.posexplode(runs).alias("pos", "term"))
    parts = [F.col("term")[f"w{k}"] for k in range(RUN)]
    hashed = terms.select(
        *by, F.floor(F.col("pos") / PIECE).alias("piece"),
        F.xxhash64(F.lit(1), *parts).alias("h1"), F.xxhash64(F.lit(2), *parts).alias("h2"),
    )
    lanes = [F.sum(F.shiftrightunsigned(h, i).bitwiseAND(F.lit(_NARROW))).alias(f"{h}_{i}") for h in ("h1", "h2") for i in range(16)]
    pieces = hashed.groupBy(*by, "piece").agg(F.count(F.lit(1)).alias("terms"), *lanes)
    wide = []
    for h in ("h1", "h2"):
        for i in range(16):
            lane = F.col(f"{h}_{i}")
            wide.append(F.sum(lane.bitwiseAND(F.lit(_WIDE))).alias(f"{h}_{i}_even"))
            wide.append(F.sum(F.shiftrightunsigned(lane, 16).bitwiseAND(F.lit(_WIDE))).alias(f"{h}_{i}_odd"))
    votes = pieces.groupBy(*by).agg(F.sum("terms").alias("terms"), *wide)

    def fingerprint(h: str) -> Column:
        bits = []
        for i in range(16):
            for k in range(4):
                sums = F.col(f"{h}_{i}_{'odd' if k % 2 else 'even'}")
                ayes = F.shiftrightunsigned(sums, 32 * (k // 2)).bitwiseAND(F.lit(0xFFFFFFFF))
                bit = 1 << (i + 16 * k)
                bits.append(F.when(2 * ayes > F.col("terms"), F.lit(bit if bit < 1 << 63 else -(1 << 63))).otherwise(F.lit(0)))
        return reduce(lambda a, b: a.bitwiseOR(b), bits)

    return votes.select(*by, fingerprint("h1").alias("f1"), fingerprint("h2").alias("f2"))


def distance(a1: Column, a2: Column, b1: Column, b2: Column) -> Column:
    return F.bit_count(a1.bitwiseXOR(b1)) + F.bit_count(a2.bitwiseXOR(b2))


def likeness(hamming: Column) -> Column:
    """The cosine of the two texts' term counts, as the share of differing bits estimates it; 0 at least."""
    return F.when(hamming == 0, 1.0).otherwise(F.greatest(F.lit(0.0), F.cos(hamming * (math.pi / BITS))))


def as_text(f1: Column, f2: Column) -> Column:
    return F.lower(F.concat(*[F.lpad(F.hex(f), 16, "0") for f in (f1, f2)]))


def neighbours(prints: DataFrame, queries: DataFrame, radius: int = 3) -> DataFrame:
    """(q1, q2, f1, f2): for each distinct fingerprint of `queries` those of `prints` within `radius` bits.

    Both have the columns f1 and f2. Equal fingerprints are one row on either side.
    """
    n = radius + 2
    width = -(-BITS // n)
    if not 0 <= radius or width > 31 or width * (n - 1) >= BITS:
        raise ValueError("the radius gives blocks that two of them do not fit into a long, or empty ones")

    def block(k: int, f1: Column, f2: Column) -> Column:
        low, high = k * width, min(BITS, (k + 1) * width)
        mask = (1 << (high - low)) - 1
        if high <= 64:
            return F.shiftrightunsigned(f1, low).bitwiseAND(F.lit(mask))
        if low >= 64:
            return F.shiftrightunsigned(f2, low - 64).bitwiseAND(F.lit(mask))
        return F.shiftrightunsigned(f1, low).bitwiseOR(F.shiftleft(f2, 64 - low)).bitwiseAND(F.lit(mask))

    def tables(df: DataFrame, names: list[str]) -> DataFrame:
        own = df.select(F.col("f1").alias(names[0]), F.col("f2").alias(names[1])).distinct()
        blocks = [block(k, F.col(names[0]), F.col(names[1])) for k in range(n)]
        keys = [F.struct(F.lit(t).alias("table"), F.shiftleft(blocks[i], width).bitwiseOR(blocks[j]).alias("value")) for t, (i, j) in enumerate(combinations(range(n), 2))]
        return own.select(*names, F.explode(F.array(*keys)).alias("at")).select(*names, "at.table", "at.value")

    met = tables(queries, ["q1", "q2"]).join(tables(prints, ["f1", "f2"]), ["table", "value"])
    near = met.filter(distance(F.col("q1"), F.col("q2"), F.col("f1"), F.col("f2")) <= radius)
    return near.select("q1", "q2", "f1", "f2").distinct()


def in_descending_order(docs: DataFrame) -> DataFrame:
    """k1, k2, doc_id, n_chars, copies (how many rows) of distinct rows; t1, t2, need: of the row whose next document this is.

    Next is the document before in ascending order of doc_id (nulls first, ties by key); the first one's
    is the last. `need` is the number of characters that the other row takes.
    """
    rows = docs.select("doc_id", F.length("text").cast("long").alias("n_chars"), *row_key(F.col("doc_id"), F.col("text"))).groupBy("doc_id", "n_chars", *KEY).agg(F.count(F.lit(1)).alias("copies"))
    stored = stored_in_order(rows, ["doc_id", *KEY])
    inside = Window.partitionBy("__chunk").orderBy("__pos")
    after = F.lead(F.struct("k1", "k2", "n_chars")).over(inside)
    firsts = stored.groupBy("__chunk").agg(F.min_by(F.struct("k1", "k2", "n_chars"), "__pos").alias("first"))
    # One row per chunk from here on; after the last chunk comes the first again.
    by_chunk = Window.partitionBy(F.lit(0)).orderBy("__chunk")
    whole = by_chunk.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    border = firsts.select(F.col("__chunk").alias("of"), F.coalesce(F.lead("first").over(by_chunk), F.first("first").over(whole)).alias("border"))
    joined = stored.withColumn("after", after).join(border, stored["__chunk"] == border["of"])
    to = F.coalesce("after", "border")
    return store(joined.select("doc_id", "n_chars", "copies", *KEY, to["k1"].alias("t1"), to["k2"].alias("t2"), F.floor(to["n_chars"] / 3).alias("need")), "order")


def with_edited(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of order, texts): texts has k1, k2, text and the edited text of every distinct row."""
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    order = in_descending_order(base)
    keyed = base.select(*row_key(F.col("doc_id"), F.col("text")), "text")
    single = keyed.withColumn("__n", F.row_number().over(Window.partitionBy(*KEY).orderBy(F.lit(0)))).filter("__n = 1").drop("__n")
    # Both uses of the texts read one shuffle; what travels again is the beginning that the other row needs.
    heads = single.join(order.select(*KEY, "t1", "t2", "need"), KEY).select(
        F.col("t1").alias("k1"), F.col("t2").alias("k2"), F.substring("text", F.lit(1), F.col("need").cast("int")).alias("head"),
    )
    n = F.length("text")
    kept = F.substring("text", F.lit(1), (n - F.floor(n / 3)).cast("int"))
    return order, single.join(heads, KEY).select(*KEY, "text", F.concat(kept, "head").alias("edited"))


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Per distinct row: doc_id, n_chars, copies, edited_sha256, f1, f2, e1, e2 (edited), x1, x2 (next document)."""
    order, texts = with_edited(docs)
    both = texts.select(*KEY, F.sha2("edited", 256).alias("edited_sha256"), F.explode(F.array(
        F.struct(F.lit(False).alias("is_edited"), F.col("text").alias("text")), F.struct(F.lit(True).alias("is_edited"), F.col("edited").alias("text")),
    )).alias("version")).select(*KEY, "edited_sha256", "version.is_edited", "version.text")
    prints = fingerprints(both, [*KEY, "is_edited", "edited_sha256"])
    paired = prints.groupBy(*KEY).agg(
        F.first("edited_sha256").alias("edited_sha256"),
        *[F.max(F.when(F.col("is_edited") == flag, F.col(f))).alias(name) for flag, names in ((False, ("f1", "f2")), (True, ("e1", "e2"))) for f, name in zip(("f1", "f2"), names)],
    )
    own = store(paired, "fingerprints")
    nexts = order.join(own.select(*KEY, F.col("f1").alias("x1"), F.col("f2").alias("x2")), KEY).select(F.col("t1").alias("k1"), F.col("t2").alias("k2"), "x1", "x2")
    return order.select(*KEY, "doc_id", "n_chars", "copies").join(own, KEY).join(nexts, KEY)
