"""Shards of nearly equal bytes by histogram sort.

Rows are ordered by a key of three parts: a hash of the text, so that equal texts lie side by side, a
hash of the id, and the place of the row in the input, which tells only rows apart that are equal in
both. The borders between shards are found before any text moves:

1. The key space is cut into cells, first by the leading bits of the key. Each pass counts the exact
   bytes and rows of the cells across all partitions, so the bytes below every cell border are known.
2. A cell that holds a wanted border farther from both its ends than the tolerance is probed again:
   it is cut into 256 cells between its least and its greatest key. A cell with a single text is cut by
   the hash of the id, so the copies of a text that holds a third of all bytes are spread as well.
3. This goes on until no border is open. With a tolerance of 0 every border is the border between two
   rows that is nearest to its target, so shards differ by less than the largest row.

Then rows are exchanged once. A shard is exchanged in parts, runs of cells of bounded size, so no task
holds a shard; a row's slot is its place in its part after the exact row counts of the shard's earlier
parts. Rows are stored with their keys first, so every pass counts the same rows and reads only keys.

A row's size is the bytes of its text in UTF-8 plus 1; a null text has size 1 and counts as empty. A row
larger than a shard's share gets a shard of its own, and others may stay empty. Null ids count as the
empty text. Repeated rows are rows of their own. An empty table gives an empty result. Columns of the
input pass through; a name that is needed is refused.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.session import store

#: Hexadecimal digits of a hash in a key part (60 bits), and leading bits that number the cells of the first pass.
_DIGITS, _FIRST_BITS = 15, 16
#: Cells that an open cell is cut into.
_FAN_OUT = 256
#: A part holds about so many bytes; a shard has at least so many parts, and all shards have at most so many together.
PART_BYTES, LEAST_PARTS, MOST_PARTS = 64 << 20, 16, 1 << 15
_KEY, _LOW, _HIGH = (["__k1", "__k2", "__k3"], ["__low1", "__low2", "__low3"], ["__high1", "__high2", "__high3"])
NEW = ("size", "text_crc32", "shard", "slot")


def _hash_part(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, _DIGITS), 16, 10).cast("bigint")


def keyed(docs: DataFrame, text: str, doc_id: str, keep: Sequence[str]) -> DataFrame:
    """The columns `keep` with size, text_crc32, the key parts and the number of the first cell."""
    own, name = F.coalesce(F.col(f"`{text}`"), F.lit("")), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))
    return docs.select(
        *[F.col(f"`{c}`") for c in keep], (F.octet_length(own).cast("bigint") + 1).alias("size"), F.crc32(own).alias("text_crc32"),
        _hash_part(own).alias("__k1"), _hash_part(name).alias("__k2"), F.monotonically_increasing_id().alias("__k3"),
    ).withColumn("__cell", F.shiftright("__k1", 4 * _DIGITS - _FIRST_BITS))


def _counted(rows: DataFrame, *by: str) -> DataFrame:
    """Exact bytes and rows of each cell, and its least and greatest key parts."""
    ends = [f(k).alias(n) for names, f in ((_LOW, F.min), (_HIGH, F.max)) for k, n in zip(_KEY, names)]
    return rows.groupBy("__cell", *by).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"), *ends)


def _placed(cells: DataFrame, total: int, parts: int) -> DataFrame:
    """Cells with the bytes `before` and `after` them in key order, and the part that holds their middle.

    There are at most 65,536 cells of the first pass and 256 for each one cut since: one task can order them.
    """
    upto = Window.partitionBy(F.lit(0)).orderBy(*_LOW).rowsBetween(Window.unboundedPreceding, 0)
    placed = cells.withColumn("after", F.sum("bytes").over(upto)).withColumn("before", F.col("after") - F.col("bytes"))
    middle = (F.col("before") + F.col("after")).cast("double")
    return placed.withColumn("part", F.least(F.floor(middle * parts / (2.0 * total)), F.lit(parts - 1)).cast("int"))


def _open(placed: DataFrame, total: int, shards: int, parts: int, tolerance: float) -> DataFrame:
    """Cells of several rows that are larger than two parts or hold a shard's border too far from both ends."""
    step = float(total) / shards
    border = F.round((F.col("before") + F.col("after")) / (2 * step)) * step
    apart = F.least(border - F.col("before"), F.col("after") - border)
    return placed.filter((F.col("n") > 1) & ((F.col("bytes") > 2.0 * total / parts) | (apart > tolerance)))


def _at_level(level: Column, names: Sequence[str]) -> Column:
    return F.when(level == 0, F.col(names[0])).when(level == 1, F.col(names[1])).otherwise(F.col(names[2]))


def _cut(keys: DataFrame, wide: DataFrame) -> DataFrame:
    """Exact counts of the finer cells of the cells `wide`, a row for each cell that has rows."""
    level = F.when(F.col(_LOW[0]) < F.col(_HIGH[0]), 0).when(F.col(_LOW[1]) < F.col(_HIGH[1]), 1).otherwise(2)
    # A cell is open for its size or for a border, so there are fewer than parts and shards together.
    probes = F.broadcast(wide.select(F.col("__cell").alias("__of"), level.alias("__level"), *_LOW, *_HIGH))
    inside = (F.col("__cell") == F.col("__of")) & F.col(_KEY[0]).between(F.col(_LOW[0]), F.col(_HIGH[0]))
    for deeper in (1, 2):
        inside &= (F.col("__level") < deeper) | F.col(_KEY[deeper]).between(F.col(_LOW[deeper]), F.col(_HIGH[deeper]))
    key, low, high = (_at_level(F.col("__level"), names) for names in (_KEY, _LOW, _HIGH))
    width = F.floor((high - low) / _FAN_OUT) + 1
    old = [F.col(n).alias(f"__of{i}") for i, n in enumerate(_LOW)]
    touched = keys.join(probes, inside).select("__cell", "size", *_KEY, *old, F.floor((key - low) / width).alias("__probe"))
    return _counted(touched, "__of0", "__of1", "__of2", "__probe")


def histogram(keys: DataFrame, total: int, shards: int, parts: int, tolerance: float) -> DataFrame:
    """The cells with their exact bytes and rows, once no cell is open: every one belongs to one part."""
    cells = store(_counted(keys.select("__cell", "size", *_KEY)), "cells")
    while True:
        placed = store(_placed(cells, total, parts), "placed")
        wide = _open(placed, total, shards, parts, tolerance)
        if wide.isEmpty():
            return placed
        settled = placed.join(wide.select(*_LOW), _LOW, "left_anti")
        cells = store(settled.select(*cells.columns).unionByName(_cut(keys, wide).select(*cells.columns)), "cells")


def _guide(cells: DataFrame, per_shard: int) -> DataFrame:
    """For each first cell, where its parts start in key order: `cuts` of (key parts, part, rows of the shard before the part)."""
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = cells.groupBy("part").agg(F.sum("n").alias("n")).withColumn("shard", F.floor(F.col("part") / per_shard).cast("int"))
    bases = parts.select("part", "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    starts = cells.groupBy("__cell", "part").agg(F.min(F.struct(*_LOW)).alias("low"))
    cut = F.struct(F.col("low.*"), "part", "shard", "base")
    return starts.join(F.broadcast(bases), "part").groupBy(F.col("__cell").alias("__of")).agg(F.array_sort(F.collect_list(cut)).alias("cuts"))


def _last_cut(cuts: Column) -> Column:
    """The last of the sorted `cuts` that is not above the row's key, by binary search: steps of falling powers of two."""
    key = F.struct(*[F.col(k).alias(n) for k, n in zip(_KEY, _LOW)])
    steps = F.array(*[F.lit(1 << b) for b in range(MOST_PARTS.bit_length(), -1, -1)])

    def further(at: Column, step: Column) -> Column:
        cut = F.get(cuts, at + step - 1)
        return F.when((at + step <= F.size(cuts)) & (F.struct(*[cut[n].alias(n) for n in _LOW]) <= key), at + step).otherwise(at)

    return F.get(cuts, F.aggregate(steps, F.lit(0), further) - 1)


def shard_documents(
    docs: DataFrame, shards: int = 16, tolerance: float = 0.0, text: str = "text", doc_id: str = "doc_id", keep: Sequence[str] | None = None,
) -> DataFrame:
    """The columns `keep` (all without it) with size, text_crc32, shard (from 0) and slot (gapless from 0 in each shard).

    `tolerance` is what a shard's border may lie off its target, as a share of a shard's bytes; with 0 it is
    the nearest border between two rows. All equal texts that no border cuts are in one shard.
    """
    keep = list(docs.columns if keep is None else keep)
    clash = {*NEW, "part", "base", "cuts", *_KEY, *_LOW, "__cell", "__of"} & {c.lower() for c in keep}
    if clash:
        raise ValueError(f"the table already has {', '.join(sorted(clash))}")
    keys = store(keyed(docs, text, doc_id, keep), "sharding_keys")
    total = max(keys.agg(F.sum("size")).first()[0] or 0, 1)
    per_shard = max(min(max(LEAST_PARTS, -(-total // (shards * PART_BYTES))), MOST_PARTS // shards), 1)
    cells = histogram(keys, total, shards, shards * per_shard, tolerance * total / shards)
    # One row for each first cell and one cut more for each part: at most 65,536 and `MOST_PARTS`, whatever the input.
    guide = F.broadcast(store(_guide(cells, per_shard), "sharding_guide"))
    at = keys.join(guide, F.col("__cell") == F.col("__of")).withColumn("__at", _last_cut(F.col("cuts")))
    dealt = at.select(*[F.col(f"`{c}`") for c in keep], "size", "text_crc32", *_KEY, "__at.part", "__at.shard", "__at.base")
    place = F.row_number().over(Window.partitionBy("part").orderBy(*_KEY))
    return dealt.withColumn("slot", F.col("base") + place - 1).select(*[F.col(f"`{c}`") for c in keep], *NEW)


def write_shards(sharded: DataFrame, folder: str) -> None:
    """A folder `shard=n` for each shard that has rows. A part is one task's, so a shard has at most as many files as parts."""
    sharded.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("shard").parquet(folder)
