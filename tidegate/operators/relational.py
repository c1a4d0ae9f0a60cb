"""Joins, aggregations, sorting and set operations."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.scalar import exact_cast
from tidegate.operators.skew import BROADCAST_ROWS, balanced_join, is_small, lookup_join


def join_first(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, n: int, order: Sequence[str | Column]
) -> DataFrame:
    """Inner join keeping both key columns, then the first `n` rows by `order`."""
    joined = balanced_join(left, right.withColumnRenamed(right_key, left_key), [left_key])
    return joined.withColumn(right_key, F.col(left_key)).orderBy(*order).limit(n)


def lookup(
    df: DataFrame,
    mapping: DataFrame,
    column: str,
    mapping_key: str,
    max_broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Left outer lookup of `column`; a key repeated in the mapping repeats the row.

    The mapping is broadcast after its row count was checked, otherwise both sides are shuffled
    with hot keys spread out.
    """
    right = mapping.withColumnRenamed(mapping_key, column)
    return lookup_join(df, right, [column], "left", max_broadcast_rows)


def with_calendar(df: DataFrame, calendar: DataFrame, date_key: str, calendar_key: str = "cal_date_key") -> DataFrame:
    """Add the calendar's columns for the row's date key."""
    return lookup(df, calendar, date_key, calendar_key)


def remap_keys(
    df: DataFrame,
    columns: Mapping[str, str],
    maps: Mapping[str, DataFrame],
    windows: Mapping[str, tuple[str, str]],
    date_column: str,
    guarded: bool,
    calendar: DataFrame | None = None,
) -> DataFrame:
    """Replace keys by their updated value for rows dated inside the conversion window.

    `columns` maps a key column to its dimension, `maps` a dimension to `(orig_key, updated_key)`,
    `windows` a dimension to its first and last day (both included). With `guarded`, updated keys
    that are 0 or absent keep the original; without it, rows inside the window take whatever the
    map says, so an unmatched key becomes null. With a `calendar(cal_date_key, calendar_dt)`,
    `date_column` is a date key.
    """
    unknown = {dim for dim in columns.values() if dim not in maps or dim not in windows}
    if unknown or any(c not in df.columns for c in columns):
        raise ValueError(f"no key map for {sorted(unknown)} or column absent from the table")
    order = df.columns
    work = df
    day = F.col(date_column)
    if calendar is not None:
        narrow = calendar.select("cal_date_key", F.col("calendar_dt").alias("__day"))
        work = with_calendar(work, narrow, date_column)
        day = F.col("__day")
    small = {dim: is_small(maps[dim]) for dim in set(columns.values())}
    updates = {}
    for i, (column, dim) in enumerate(columns.items()):
        new = f"__new_{i}"
        narrow = maps[dim].select(F.col("orig_key").alias(column), F.col("updated_key").alias(new))
        if small[dim]:
            work = work.join(F.broadcast(narrow), [column], "left")
        else:
            work = balanced_join(work, narrow, [column], "left")
        first, last = windows[dim]
        inside = day.cast("date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
        if guarded:
            inside = inside & (F.col(new) != 0)
        updates[column] = F.when(inside, F.col(new)).otherwise(F.col(column)).alias(column)
    return work.select(*[updates.get(c, F.col(c)) for c in order])


def missing(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `left` without a partner."""
    return balanced_join(left, right.select(*keys).distinct(), keys, "left_anti")


def present(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `left` with a partner, once each."""
    return balanced_join(left, right.select(*keys).distinct(), keys, "left_semi")


def pairs_with_sum(df: DataFrame, column: str, target) -> DataFrame:
    """Unordered pairs of values with the given sum, and how many row pairs there are.

    Works on the distinct values with their frequencies. A value pairs with itself only when it
    occurs at least twice (a choice).
    """
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    low = counted.select(F.col(column).alias("low"), F.col("n").alias("n_low"), (F.lit(target) - F.col(column)).alias("high"))
    high = counted.select(F.col(column).alias("high"), F.col("n").alias("n_high"))
    rows = F.when(F.col("low") == F.col("high"), (F.col("n_low") * (F.col("n_low") - 1) / 2).cast("bigint")).otherwise(
        F.col("n_low") * F.col("n_high")
    )
    return (
        low.filter(F.col("low") <= F.col("high"))
        .join(high, "high")
        .select("low", "high", rows.alias("row_pairs"))
        .filter("row_pairs > 0")
    )


def group_summary(df: DataFrame, key: str, counted: str, averaged: str) -> DataFrame:
    """Count of non-null `counted` and mean of `averaged` per key, largest count first."""
    return (
        df.groupBy(key)
        .agg(F.count(counted).alias("row_count"), F.avg(averaged).alias("mean_value"))
        .orderBy(F.desc("row_count"), F.asc(key))
    )


def word_count(df: DataFrame, text: str, separator: str = " ") -> DataFrame:
    """Frequency of the tokens between single separators (plain text, any length); empty tokens count."""
    return (
        df.select(F.explode(F.split(text, re.escape(separator))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    )


def value_frequency(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def value_range(df: DataFrame, column: str) -> DataFrame:
    """Lowest and highest value in one row."""
    return df.agg(F.min(column).alias("min_value"), F.max(column).alias("max_value"))


def count_and_top_key(df: DataFrame, key: str, kind: str = "bigint") -> DataFrame:
    """Row count and the highest key read as a number; a key that is no such number is an error."""
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.max(exact_cast(F.col(f"`{key}`"), kind)).alias("top_key"))


def lowest_message(df: DataFrame, key: str, value: str, rank_by: str) -> DataFrame:
    """Per key, the value of the message whose `rank_by` is lowest; equal ranks take the lowest value."""
    best = F.min(F.struct(F.col(rank_by), F.col(value)))
    return df.groupBy(key).agg(best.alias("__b")).select(key, f"__b.{rank_by}", f"__b.{value}")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def latest_per(df: DataFrame, keys: Sequence[str], value: str, at: str) -> DataFrame:
    """The `value` of the latest row of each key; equal times take the highest value."""
    best = F.max(F.struct(F.col(at), F.col(value)))
    return df.groupBy(*keys).agg(best.alias("__b")).select(*keys, f"__b.{value}", f"__b.{at}")


def first_rows(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def append_rows(df: DataFrame, rows: Sequence[tuple], columns: Sequence[str]) -> DataFrame:
    """Add literal rows, given for `columns`; types follow the table, other columns are null."""
    spark = df.sparkSession
    text = spark.createDataFrame([tuple(None if v is None else str(v) for v in r) for r in rows],
                                 ", ".join(f"`{c}` string" for c in columns))
    typed = text.select(*[F.col(c).cast(df.schema[c].dataType).alias(c) for c in columns])
    return df.unionByName(typed, allowMissingColumns=True)


def _by_side(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows with the sides that hold them: 1 left, 2 right, 3 both."""
    both = left.withColumn("__sides", F.lit(1)).union(right.withColumn("__sides", F.lit(2)))
    return both.groupBy(*left.columns).agg(F.bit_or("__sides").alias("__sides"))


def symmetric_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows found on exactly one side, with one shuffle; the sides may hold copies."""
    return _by_side(left, right).filter("__sides < 3").drop("__sides")


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of the left side that the right side lacks."""
    return _by_side(left, right).filter("__sides = 1").drop("__sides")


def common(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows found on both sides."""
    return _by_side(left, right).filter("__sides = 3").drop("__sides")
