"""Joins that stay balanced when one key holds a large part of the rows.

By default a join is left to adaptive execution, which splits the large partitions of a skewed join. Where
hot keys are known, or asked for by `hot_rows`, their rows are spread over `SALTS` shuffle groups, and
only the partner rows of hot keys are copied once per group; keys beyond the bounded list are again
left to adaptive execution. Which keys count as hot changes the plan, never the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_HOT_KEYS = 1000
HOT_ROWS = 2_000_000
SALTS = 64
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 64 << 20

_SALT = "__salt"


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, fraction: float = 0.05):
    """At most `MAX_HOT_KEYS` key tuples whose estimated row count reaches `hot_rows`.

    The estimate may come from a sample: it only steers the plan.
    """
    sampled = df.select(*keys).sample(fraction=fraction, seed=7) if fraction < 1.0 else df.select(*keys)
    counted = (
        sampled.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__n"))
        .filter(F.col("__n") >= F.lit(max(1, int(hot_rows * fraction))))
        .orderBy(F.desc("__n"))
        .limit(MAX_HOT_KEYS)
    )
    return [tuple(row[k] for k in keys) for row in counted.collect()]


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when `df` has at most `max_rows` rows and `max_bytes` bytes; reads no more than needed to tell.

    Texts and binaries count by their bytes, nested values by their printed form, others by 16.
    """
    def width(field: T.StructField) -> Column:
        own = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            own = F.to_json(F.struct(own))
        elif not isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.lit(16)
        return F.coalesce(F.octet_length(own), F.lit(0)) + 16

    size = F.lit(0).cast("bigint")
    for field in df.schema:
        size = size + width(field)
    row = df.limit(max_rows + 1).select(size.alias("w")).agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("w")).first()
    return row.n <= max_rows and (row.w or 0) <= max_bytes


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df` with a broadcast hint if its rows and bytes were checked to be few, else unchanged."""
    return F.broadcast(df) if is_small(df, max_rows) else df


def balanced_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    hot_rows: int | None = None,
    fraction: float = 0.05,
    salts: int = SALTS,
    hot: list[tuple] | None = None,
) -> DataFrame:
    """Equi-join on same-named columns; the left side may have hot keys.

    `how`: inner, left, left_semi or left_anti (the kinds for which copying the right side of hot
    keys keeps the result). `hot` may carry keys found earlier, so that a loop looks once; with `hot_rows`
    they are looked for here. Without either it is a plain join and starts no job.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"balanced_join cannot split a {how} join")
    on = list(on)
    if hot is None and hot_rows is not None:
        hot = hot_keys(left, on, hot_rows, fraction)
    if not hot:
        return left.join(right, on, how)
    # Null keys match nothing, so their rows are spread without copies of the right side.
    null_key = F.lit(False)
    for k in on:
        null_key = null_key | F.col(k).isNull()
    hot = [key for key in hot if all(part is not None for part in key)]
    schema = T.StructType([left.schema[k] for k in on])
    hot_frame = F.broadcast(left.sparkSession.createDataFrame(hot, schema).withColumn("__hot", F.lit(True)))
    # Row content and map task, not a random number: a retried task must send its rows the same way.
    hashable = [f.name for f in left.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    spread = F.pmod(F.xxhash64(*hashable, F.spark_partition_id()), F.lit(salts))
    salted_left = left.join(hot_frame, on, "left").withColumn(
        _SALT, F.when(F.col("__hot") | null_key, spread).otherwise(F.lit(0)).cast("int")
    ).drop("__hot")
    copies = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_right = right.join(hot_frame, on, "left").withColumn(_SALT, F.explode(copies)).drop("__hot")
    return salted_left.join(salted_right, [*on, _SALT], how).drop(_SALT)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    max_broadcast_rows: int = BROADCAST_ROWS,
    **balance,
) -> DataFrame:
    """Join with a usually small right side: broadcast once its size was checked, else balanced."""
    if is_small(right, max_broadcast_rows):
        return left.join(F.broadcast(right), list(on), how)
    return balanced_join(left, right, on, how, **balance)


def null_safe_key(keys: Sequence[str]) -> Column:
    """One join key in which nulls equal nulls, as fields of a struct do."""
    return F.struct(*[F.col(k) for k in keys])
