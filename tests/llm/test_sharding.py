"""Shards against a plain version that orders all rows and adds up their sizes."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of, runs_python
from tests.llm.conftest import DOCUMENTS
from tidegate.llm import sharding as M
from tidegate.llm.queries import QUERIES


def part_of_key(value):
    return hashlib.md5(("" if value is None else str(value)).encode()).hexdigest()[:15]


def by_hand(rows, shards):
    """(doc_id, text): shard and slot of each row; a row goes where its middle lies."""
    rows = sorted(rows, key=lambda r: (part_of_key(r[1]), part_of_key(r[0])))
    sizes = [len((t or "").encode()) + 1 for _, t in rows]
    total, before, slots, out = sum(sizes), 0, defaultdict(int), []
    for (k, t), n in zip(rows, sizes):
        shard = (2 * before + n) * shards // (2 * total)
        out.append((k, n, zlib.crc32((t or "").encode()), shard, slots[shard]))
        slots[shard] += 1
        before += n
    return out


def as_rows(df):
    return sorted(map(repr, ((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in df.collect())))


def same(df, shards, **options):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    return as_rows(M.shard_documents(df, shards, **options)) == sorted(map(repr, by_hand(rows, shards)))


@pytest.fixture(scope="module")
def skewed(spark):
    """A text that holds half of all rows, a row that holds a tenth of all bytes, and null texts."""
    rows = [(i, "the same text again and again") for i in range(1500)] + [(1500 + i, f"text {i} " * (1 + i % 9)) for i in range(1500)]
    rows += [(4000, "x" * 15_000)] + [(5000 + i, None) for i in range(40)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(7)


@pytest.mark.parametrize("shards", [1, 2, 5, 16])
def test_borders_are_the_nearest_between_rows(skewed, shards):
    assert same(skewed, shards)


def test_deeper_probes_and_many_parts(skewed, monkeypatch):
    monkeypatch.setattr(M, "_FAN_OUT", 3)
    monkeypatch.setattr(M, "PART_BYTES", 200)
    assert same(skewed, 16)


def test_input_order_and_partitions_change_nothing(skewed):
    shuffled = skewed.orderBy(F.rand(5)).repartition(3)
    assert as_rows(M.shard_documents(shuffled)) == as_rows(M.shard_documents(skewed))


def test_tolerance_keeps_groups_whole_and_sizes_near(skewed):
    rows = M.shard_documents(skewed, 4, tolerance=0.2).collect()
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in rows:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    share = sum(sizes.values()) / 4
    assert all(abs(n - share) <= 0.4 * share for n in sizes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(rows) == skewed.count()


def test_copies_of_a_row_get_slots_of_their_own(spark):
    df = spark.createDataFrame([(1, "one row")] * 900 + [(2, "two")] * 10, "doc_id long, text string").repartition(5)
    assert same(df, 8)


def test_copies_lie_side_by_side(spark, documents):
    rows = M.shard_documents(documents).collect()
    by_text = defaultdict(set)
    for r in rows:
        by_text[r.text].add(r.shard)
    assert all(max(s) - min(s) == len(s) - 1 for s in by_text.values()) and sum(len(s) > 1 for s in by_text.values()) <= 15


def test_odd_documents(spark, extra):
    free = extra.drop("size")
    made = M.shard_documents(free)
    assert made.columns == [*free.columns, *M.NEW]
    assert as_rows(made) == sorted(map(repr, by_hand([(r.doc_id, r.text) for r in free.collect()], 16)))
    assert M.shard_documents(free.limit(0)).count() == 0
    assert M.shard_documents(spark.createDataFrame([(1, None, None, None, None)], DOCUMENTS)).select("size", "text_crc32", "slot").first() == (1, 0, 0)
    for name in ("size", "shard", "part", "__k1", "SLOT"):
        with pytest.raises(ValueError):
            M.shard_documents(free.withColumn(name, F.lit(1)))


def test_written_shards_hold_their_rows(spark, documents, tmp_path):
    made = M.shard_documents(documents)
    M.write_shards(made, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert as_rows(back) == as_rows(made)


def test_the_main_path_is_native(spark, folder):
    assert not runs_python(plan_of(QUERIES["op12_histogram_shards"](spark, folder)))
