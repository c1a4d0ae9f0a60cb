"""Small helpers for texts inside tasks and in column expressions."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: The white space that separates words: space and 0x09 to 0x0D, which is what bytes.split() uses.
SPACES = " \t\n\u000b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())


def crc_mod(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus


def word_count(text: Column) -> Column:
    """Words between white space; null has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, "[ \\t-\\r]+"))).cast("long")


#: Rows of an Arrow batch at most: texts are long, and a batch is held on both sides of the pipe.
BATCH_ROWS = 1_000
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """From here on Arrow batches of this session hold at most `BATCH_ROWS` rows; a smaller setting stays."""
    if not 0 < int(spark.conf.get(_BATCH_CONF)) <= BATCH_ROWS:
        spark.conf.set(_BATCH_CONF, str(BATCH_ROWS))


def release_memory() -> None:
    """Give freed memory of this worker back to the system; workers stay idle next to later stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def slices(batches: Iterator[pa.RecordBatch], column: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that the texts of a slice hold about `most` bytes, but whole rows."""
    for batch in batches:
        own = batch.column(column)
        own = own.field("text") if pa.types.is_struct(own.type) else own
        lengths = pa.compute.fill_null(pa.compute.binary_length(own), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(lengths.tolist()):
            if held and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def annotate(df: DataFrame, text: str, name: str, kind: T.StructType, function: Callable[[list], list[tuple]]) -> DataFrame:
    """`df` with one more column, the struct `name` that `function` makes of the column `text`.

    `function` gets the texts of a bounded slice (null is passed as None) and returns one tuple each.
    It runs inside tasks on Arrow batches; rows stay where they are. A name that `df` has is refused.
    """
    if name in df.columns:
        raise ValueError(f"the table already has a column {name}")
    at = df.columns.index(text)
    schema = T.StructType([*df.schema.fields, T.StructField(name, kind)])
    arrow = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, at):
            rows = function(part.column(at).to_pylist())
            columns = zip(*rows) if rows else [[] for _ in kind]
            made = pa.StructArray.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(columns, arrow)], fields=list(arrow))
            yield pa.RecordBatch.from_arrays([*part.columns, made], names=[*part.schema.names, name])
        release_memory()

    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)
