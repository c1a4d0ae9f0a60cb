"""Order-based operators that need no unbounded window.

A global or per-group order is cut into ranges of the full sort key ("chunks") by Spark's range
partitioning, whatever the size of a group. The chunk of a row and its position there are stored
with the row in the shared folder, so every later branch and every retried task sees the same ones.
What looks at neighbours scans each chunk once in its order, in Arrow batches, before it is stored. So rows
are exchanged once; what crosses a chunk border is a summary of one or two rows per chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidegate.functions.scalar import exact_cast
from tidegate.operators.skew import lookup_join
from tidegate.session import scratch_path, ship_package, store

_CHUNK, _POS = "__chunk", "__pos"
# monotonically_increasing_id keeps the partition above this bit and the position below it.
_PARTITION_BIT = 33
#: Integers that one task expands from one row.
GAP_BLOCK = 100_000


def stored_in_order(df: DataFrame, order: Sequence[str], chunks: int | None = None) -> DataFrame:
    """`df` range-partitioned and sorted by `order`, with the chunk and position of each row.

    Chunks follow each other in the order. Without `chunks` there are up to
    `spark.sql.shuffle.partitions`, and adaptive execution joins neighbours when they are small.
    Rows with equal sort keys share a chunk, so `order` should identify a row.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(chunks, *order) if chunks else df.repartitionByRange(*order)
    place = F.monotonically_increasing_id()
    path = scratch_path(spark, "ordered")
    ranged.sortWithinPartitions(*order).withColumn("__place", place).select(
        *df.columns,
        F.shiftright("__place", _PARTITION_BIT).cast("int").alias(_CHUNK),
        F.col("__place").bitwiseAND(F.lit((1 << _PARTITION_BIT) - 1)).alias(_POS),
    ).write.parquet(path)
    return spark.read.parquet(path)


def _chunk_sizes(stored: DataFrame) -> DataFrame:
    return stored.groupBy(_CHUNK).agg(F.count(F.lit(1)).alias("__n"))


def _running_offsets(per_chunk: DataFrame, amount: str, name: str) -> DataFrame:
    """Sum of `amount` over all earlier chunks; one row per chunk, so the window is small."""
    earlier = Window.partitionBy(F.lit(0)).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    return per_chunk.select(_CHUNK, F.coalesce(F.sum(amount).over(earlier), F.lit(0)).alias(name))


def number_rows(
    df: DataFrame,
    order: Sequence[str],
    name: str = "row_num",
    start: int | Column = 1,
    chunks: int | None = None,
) -> DataFrame:
    """Contiguous numbers from `start` in the order of the (unique) business key `order`.

    One range shuffle, no window over rows: a number is the position in the chunk plus the sizes of
    the chunks before.
    """
    stored = stored_in_order(df, order, chunks)
    offsets = _running_offsets(_chunk_sizes(stored), "__n", "__before")
    first = start if isinstance(start, Column) else F.lit(start)
    return (
        stored.join(F.broadcast(offsets), _CHUNK, "left")
        .withColumn(name, (F.col(_POS) + F.col("__before") + first).cast("bigint"))
        .select(*[c for c in df.columns if c != name], name)
    )


def dense_rank_of(
    df: DataFrame, value: str, name: str = "rank", chunks: int | None = None
) -> DataFrame:
    """Dense rank from 1 of a value over the whole table; null values keep a null rank.

    The distinct values are numbered, then looked up. The lookup is broadcast only when it was
    counted to be small.
    """
    distinct = df.select(value).filter(F.col(value).isNotNull()).distinct()
    ranks = number_rows(distinct, [value], name, 1, chunks)
    return lookup_join(df, ranks, [value], "left")


Batches = Iterator[pa.RecordBatch]


def _scanned(df: DataFrame, order: Sequence[str], chunks: int | None, schema: T.StructType, scan: Callable[[Batches, int], Batches]) -> DataFrame:
    """What `scan(batches, chunk)` makes of each chunk of `df` in the order `order`, stored with the chunk's number `__chunk`."""
    ranged = df.repartitionByRange(chunks, *order) if chunks else df.repartitionByRange(*order)
    ship_package(df.sparkSession)

    def run(batches: Batches) -> Batches:
        chunk = TaskContext.get().partitionId()
        for made in scan((b for b in batches if b.num_rows), chunk):
            yield pa.RecordBatch.from_arrays([*made.columns, pa.array(np.full(made.num_rows, chunk, np.int32))], names=[*made.schema.names, _CHUNK])

    placed = T.StructType([*schema.fields, T.StructField(_CHUNK, T.IntegerType())])
    return store(ranged.sortWithinPartitions(*order).mapInArrow(run, placed), "scanned")


def _as_before(rows: pa.RecordBatch, columns: Sequence[str]) -> np.ndarray:
    """For each row but the first: do the columns equal those of the row before? Nulls are equal, and so are NaNs."""
    same = np.ones(max(rows.num_rows - 1, 0), bool)
    for name in columns:
        values = rows.column(rows.schema.get_field_index(name))
        a, b = values.slice(0, len(same)), values.slice(1)
        try:
            equal = pc.fill_null(pc.equal(a, b), False)
        except pa.ArrowNotImplementedError:  # nested values
            equal = pa.array([x == y for x, y in zip(a.to_pylist(), b.to_pylist())], pa.bool_())
        equal = pc.or_(equal, pc.and_(a.is_null(), b.is_null()))
        if pa.types.is_floating(values.type):
            equal = pc.or_(equal, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
        same &= equal.to_numpy(zero_copy_only=False)
    return same


def _joined(first: pa.RecordBatch | None, rest: pa.RecordBatch) -> pa.RecordBatch:
    if first is None:
        return rest
    return pa.RecordBatch.from_arrays([pa.concat_arrays([a, b]) for a, b in zip(first.columns, rest.columns)], schema=rest.schema)


def with_previous(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    carry: Sequence[str],
    name: str = "prev",
    chunks: int | None = None,
) -> DataFrame:
    """Add struct `name` with the `carry` columns of the preceding row of the same group, else null.

    `group + order` must identify a row. A group may span many chunks.
    """
    schema, full = df.schema, [*group, *order]
    struct = T.StructType([schema[c] for c in carry])
    arrow = to_arrow_type(struct)

    def scan(batches: Batches, chunk: int) -> Batches:
        last, at = None, 0
        for batch in batches:
            rows = _joined(last, batch)
            known = _as_before(rows, group) if last is not None else np.append(False, _as_before(rows, group))
            n = batch.num_rows
            fields = [rows.column(rows.schema.get_field_index(c)) for c in carry]
            # Without a row before it, the chunk's first row stands in for its own and is masked.
            fields = [f.slice(0, n) if last is not None else pa.concat_arrays([f.slice(0, 1), f.slice(0, n - 1)]) for f in fields]
            before = pa.StructArray.from_arrays([f.cast(k.type) for f, k in zip(fields, arrow)], fields=list(arrow), mask=pa.array(~known))
            yield pa.RecordBatch.from_arrays([*batch.columns, before, pa.array(np.arange(at, at + n))], names=[*batch.schema.names, name, _POS])
            last, at = batch.slice(n - 1), at + n

    shape = T.StructType([*schema.fields, T.StructField(name, struct), T.StructField(_POS, T.LongType())])
    scanned = _scanned(df, full, chunks, shape, scan)
    # The last row of each chunk, one row per chunk: it stands before the first row of the next chunk.
    row = F.struct(*[F.col(c) for c in dict.fromkeys([*group, *carry])])
    ends = scanned.groupBy(_CHUNK).agg(F.max_by(row, _POS).alias("__last"))
    border = ends.select(_CHUNK, F.lag("__last").over(Window.partitionBy(F.lit(0)).orderBy(_CHUNK)).alias("__border"))
    joined = scanned.join(F.broadcast(border), _CHUNK, "left")
    same = (F.col(_POS) == 0) & F.col("__border").isNotNull()
    for g in group:
        same = same & F.col(f"__border.{g}").eqNullSafe(F.col(g))
    over = F.when(same, F.struct(*[F.col(f"__border.{c}").alias(c) for c in carry])).otherwise(F.col(name))
    return joined.select(*df.columns, over.alias(name))


def run_lengths(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    value: str,
    chunks: int | None = None,
) -> DataFrame:
    """Lengths of runs of equal consecutive values per group.

    Columns: group, the order columns of the run's first row, value, `run_length`. Each chunk becomes
    its runs in one scan. Only its first and last run can go on in other chunks; these, two rows per chunk at
    most, are put together afterwards.
    """
    full = [*group, *order]
    same_run = [*group, *([value] if value not in group else [])]
    columns = [*full, *([value] if value not in full else [])]

    def scan(batches: Batches, chunk: int) -> Batches:
        held, length, k = None, 0, 0

        def runs(rows: pa.RecordBatch, lengths: np.ndarray, last: bool) -> pa.RecordBatch:
            n = rows.num_rows
            more = [pa.array(lengths), pa.array(np.arange(k, k + n)), pa.array(np.full(n, last))]
            return pa.RecordBatch.from_arrays([*rows.columns, *more], names=[*rows.schema.names, "run_length", "__k", "__last"])

        for batch in batches:
            rows = _joined(held, batch)
            starts = np.append(0, np.flatnonzero(~_as_before(rows, same_run)) + 1)
            lengths = np.diff(np.append(starts, rows.num_rows))
            if held is not None:
                lengths[0] += length - 1
            held, length = rows.slice(int(starts[-1]), 1), int(lengths[-1])
            if len(starts) > 1:
                yield runs(rows.take(pa.array(starts[:-1])), lengths[:-1], False)
                k += len(starts) - 1
        if held is not None:
            yield runs(held, np.array([length]), True)

    own = df.select(*columns)
    extra = [T.StructField("run_length", T.LongType()), T.StructField("__k", T.LongType()), T.StructField("__last", T.BooleanType())]
    runs = _scanned(own, full, chunks, T.StructType([*own.schema.fields, *extra]), scan)
    place = Window.partitionBy(F.lit(0)).orderBy(_CHUNK, "__k")
    borders = runs.filter(F.col("__last") | (F.col("__k") == 0)).withColumn("__prior", F.lag(F.struct(*same_run)).over(place))
    goes_on = (F.col("__k") == 0) & F.col("__prior").isNotNull()
    for c in same_run:
        goes_on = goes_on & F.col(f"__prior.{c}").eqNullSafe(F.col(c))
    numbered = borders.withColumn("__run", F.sum(F.when(goes_on, 0).otherwise(1)).over(place))
    first = F.min_by(F.struct(*columns), F.struct(_CHUNK, "__k")).alias("__first")
    merged = numbered.groupBy("__run").agg(first, F.sum("run_length").alias("run_length")).select("__first.*", "run_length")
    inner = runs.filter(~F.col("__last") & (F.col("__k") > 0)).select(*columns, "run_length")
    return inner.unionByName(merged)


def smallest_step(
    df: DataFrame, group: Sequence[str], value: str, chunks: int | None = None
) -> DataFrame:
    """Per group, the smallest difference between neighbouring distinct values, with the pair.

    Ties go to the lowest pair. Groups with fewer than two distinct values are absent.
    """
    distinct = df.select(*group, value).filter(F.col(value).isNotNull()).distinct()
    pairs = with_previous(distinct, group, [value], [value], "__prev", chunks).filter("__prev is not null")
    low = F.col(f"__prev.{value}")
    best = F.min(F.struct((F.col(value) - low).alias("step"), low.alias("low"), F.col(value).alias("high")))
    return pairs.groupBy(*group).agg(best.alias("b")).select(*group, "b.step", "b.low", "b.high")


def missing_integers(
    df: DataFrame, group: Sequence[str], value: str, chunks: int | None = None
) -> DataFrame:
    """Integers absent between the lowest and highest value of each group.

    Gaps are cut into blocks of at most `GAP_BLOCK` integers and the blocks are spread over all tasks
    before they are expanded, so a wide gap is neither one array nor one task.
    """
    number = F.col(value).cast("bigint").alias(value)
    distinct = df.select(*group, number).filter(F.col(value).isNotNull()).distinct()
    gaps = with_previous(distinct, group, [value], [value], "__prev", chunks).filter(
        F.col(f"__prev.{value}") < F.col(value) - 1
    )
    low, high = F.col(f"__prev.{value}") + 1, F.col(value) - 1
    # Two steps, so that the list of a gap's blocks stays short as well: large blocks, then small ones.
    cut = gaps.select(*group, low.alias("__low"), high.alias("__high"))
    for size in (GAP_BLOCK * GAP_BLOCK, GAP_BLOCK):
        begins = cut.withColumn("__from", F.explode(F.sequence("__low", "__high", F.lit(size).cast("bigint"))))
        cut = begins.select(*group, F.col("__from").alias("__low"), F.least("__high", F.col("__from") + (size - 1)).alias("__high"))
    spread = cut.hint("rebalance")
    return spread.select(*group, F.explode(F.sequence("__low", "__high")).alias("missing"))


def append_with_keys(
    existing: DataFrame,
    new: DataFrame,
    key: str,
    order: Sequence[str],
    constants: dict[str, Column],
    key_type: str = "bigint",
    chunks: int | None = None,
) -> DataFrame:
    """Existing rows plus `new` ones numbered on from the highest existing key.

    New rows are numbered in the order of `order`, a unique business key, so a rerun gives the same
    keys. `constants` fills columns the new rows lack; columns are matched by name. A key that does not
    fit `key_type`, old or new, is an error and never null.
    """
    typed = existing.withColumn(key, exact_cast(F.col(f"`{key}`"), key_type))
    top = typed.agg(F.coalesce(F.max(key), F.lit(0)).cast("bigint").alias("m")).scalar()
    numbered = number_rows(new, order, key, top + 1, chunks)
    numbered = numbered.withColumns({key: exact_cast(F.col(f"`{key}`"), key_type), **constants})
    return typed.unionByName(numbered.select(*typed.columns))
