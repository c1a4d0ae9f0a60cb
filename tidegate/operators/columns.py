"""Schema and column operators."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.operators.ordering import number_rows
from tidegate.session import store

LINEAGE_COLUMNS = ("PT_BATCH_ID", "PT_FILE_ID")


def upper_columns(df: DataFrame, drop: Iterable[str] = ()) -> DataFrame:
    """Upper-case all names; columns named in `drop` (any case) are removed if present."""
    unwanted = {d.upper() for d in drop}
    return df.select(*[F.col(f"`{c}`").alias(c.upper()) for c in df.columns if c.upper() not in unwanted])


def canonical_column(df: DataFrame, target: str, preferred: str, fallback: str) -> DataFrame:
    """Rename `preferred` to `target`, or `fallback` as string when `preferred` is absent.

    With both present `fallback` is dropped; with neither the frame is unchanged.
    """
    if preferred in df.columns:
        return df.drop(fallback).withColumnRenamed(preferred, target)
    if fallback in df.columns:
        return df.withColumn(fallback, F.col(fallback).cast("string")).withColumnRenamed(fallback, target)
    return df


def add_columns(df: DataFrame, columns: Mapping[str, tuple[object, str]]) -> DataFrame:
    """Add typed constants, `{name: (value, type)}`; a value of None gives a typed null."""
    return df.withColumns({name: F.lit(value).cast(kind) for name, (value, kind) in columns.items()})


def cast_columns(df: DataFrame, columns: Iterable[str], kind: str) -> DataFrame:
    """Cast columns to one type; what does not fit becomes null."""
    return df.withColumns({c: _fitting(df, c, kind) for c in columns})


def _fitting(df: DataFrame, column: str, kind: str) -> Column:
    """`try_cast`, after a plain comparison for numbers that are far too large for a decimal.

    Overflow inside the cast is costly per row; the comparison never changes the result.
    """
    tried = F.expr(f"try_cast(`{column}` AS {kind})")
    digits = re.fullmatch(r"decimal\((\d+),\s*(\d+)\)", kind.lower())
    if digits and isinstance(df.schema[column].dataType, T.NumericType):
        limit = 10.0 ** (int(digits[1]) - int(digits[2]))
        return F.when(F.col(column).between(-limit, limit), tried)
    return tried


def recode(df: DataFrame, target: str, source: str, mapping: Mapping[object, object]) -> DataFrame:
    """Set `target` where `source` has a mapped value, keep it elsewhere."""
    by_result: dict[object, list] = {}
    for value, result in mapping.items():
        by_result.setdefault(result, []).append(value)
    expression = F.col(target)
    for result, values in by_result.items():
        expression = F.when(F.col(source).isin(values), F.lit(result)).otherwise(expression)
    return df.withColumn(target, expression)


def drop_if_all(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop the columns only when every one of them is present."""
    return df.drop(*columns) if set(columns) <= set(df.columns) else df


def bucket(value: Column, width: int) -> Column:
    """Lower bound of the bucket of `width` that holds the value (10 gives decades)."""
    return (F.floor(value / width) * width).cast("bigint")


def clean_name(name: str) -> str:
    """Upper case, blanks to underscores, other special characters removed.

    The allowed set (letters, digits, underscore) is a choice.
    """
    return re.sub("[^A-Z0-9_]", "", name.upper().replace(" ", "_"))


def clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_name(c) for c in df.columns])


def clean_name_column(name: Column) -> Column:
    """`clean_name` for names held in a table."""
    return F.regexp_replace(F.replace(F.upper(name), F.lit(" "), F.lit("_")), "[^A-Z0-9_]", "")


def schema_drift(incoming: DataFrame, metadata: DataFrame) -> DataFrame:
    """Incoming columns that are not configured.

    `incoming(dataset_id, column_name)` as observed, `metadata(dataset_id, column_name)` as
    configured; incoming names are cleaned and configured ones upper-cased before comparing.
    """
    seen = incoming.select("dataset_id", clean_name_column(F.col("column_name")).alias("column_name")).distinct()
    known = metadata.select("dataset_id", F.upper("column_name").alias("column_name")).distinct()
    return seen.join(known, ["dataset_id", "column_name"], "left_anti")


def observed_columns(df: DataFrame, dataset_id: str) -> DataFrame:
    """The column list of a frame as a table, for `schema_drift`."""
    return df.sparkSession.createDataFrame([(dataset_id, c) for c in df.columns], "dataset_id string, column_name string")


def evolve_metadata(metadata: DataFrame, drift: DataFrame) -> DataFrame:
    """Configured columns plus the new ones as strings.

    Within a dataset new columns continue `column_sequence_number` (from 1 if there is none), in
    name order (a choice). `column_id` continues its highest value over the drift rows in (dataset, name) order. Batch
    and file id columns are never added. Column lists are small by nature, so the numbering window
    is per dataset.
    """
    fresh = drift.filter(~F.col("column_name").isin(*LINEAGE_COLUMNS))
    last = metadata.groupBy("dataset_id").agg(F.max("column_sequence_number").alias("last_seq"))
    top_id = metadata.agg(F.coalesce(F.max("column_id"), F.lit(0)).cast("bigint").alias("m")).scalar()
    numbered = (
        number_rows(fresh, ["dataset_id", "column_name"], "column_id", top_id + 1)
        .join(last, "dataset_id", "left")
        .withColumn(
            "column_sequence_number",
            F.coalesce("last_seq", F.lit(0))
            + F.row_number().over(Window.partitionBy("dataset_id").orderBy("column_name")),
        )
        .withColumn("column_data_type", F.lit("string"))
    )
    shared = ["column_id", "dataset_id", "column_name", "column_data_type", "column_sequence_number"]
    return metadata.unionByName(numbered.select(*shared), allowMissingColumns=True)


def read_widened(frames: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    """Union of batches under the widened column list; absent columns are null."""
    parts = [
        frame.select(*[F.col(c) if c in frame.columns else F.lit(None).cast("string").alias(c) for c in columns])
        for frame in frames
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def apply_schema(df: DataFrame, metadata: Sequence[Mapping]) -> DataFrame:
    """Typed columns from strings, in sequence order.

    `metadata` rows: `column_name`, `column_data_type`, `column_sequence_number`, optional
    `column_date_format`. No metadata or an absent column is an error. A value that does not fit
    becomes null (a choice).
    """
    if not metadata:
        raise ValueError("no column metadata configured")
    ordered = sorted(metadata, key=lambda m: m["column_sequence_number"])
    absent = [m["column_name"] for m in ordered if m["column_name"] not in df.columns]
    if absent:
        raise ValueError(f"columns missing from the data: {absent}")
    return df.select(*[_typed(m).alias(m["column_name"]) for m in ordered])


def _typed(meta: Mapping) -> Column:
    name, kind, fmt = meta["column_name"], meta["column_data_type"].lower(), meta.get("column_date_format")
    if kind == "date" and fmt:
        return F.try_to_timestamp(F.col(name), F.lit(fmt)).cast("date")
    if kind == "timestamp" and fmt:
        return F.try_to_timestamp(F.col(name), F.lit(fmt))
    return F.expr(f"try_cast(`{name}` AS {kind})")


def strip_characters(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.withColumn(column, F.regexp_replace(column, pattern, ""))


def drop_nulls(df: DataFrame, how: str = "any", thresh: int | None = None, subset=None) -> DataFrame:
    """Drop rows with nulls; `thresh` keeps rows with at least that many non-null values."""
    return df.na.drop(how=how, thresh=thresh, subset=subset)


def fill_nulls(df: DataFrame, value, subset=None) -> DataFrame:
    """Fill nulls in columns of the value's type."""
    return df.na.fill(value, subset=subset)


def swap_columns(df: DataFrame, columns: Iterable[str], prefix: str = "new_") -> DataFrame:
    """Replace each column by its computed twin `<prefix><column>` and drop the twins."""
    twins = {c: f"{prefix}{c}" for c in columns}
    return df.select(
        *[F.col(twins[c]).alias(c) if c in twins else F.col(c) for c in df.columns if c not in twins.values()]
    )


def add_row_id(df: DataFrame, name: str = "row_id", key: Sequence[str] | None = None) -> DataFrame:
    """A row id that stays the same however often the result is read.

    With a unique business `key` it is the key's 128-bit hash as text. Without one, rows are numbered,
    so exact copies differ, and the numbered table is stored.
    """
    if key:
        return df.withColumn(name, F.md5(F.to_json(F.struct(*key))))
    return store(df.withColumn(name, F.monotonically_increasing_id()), "row_ids")


def stamp(df: DataFrame, created: str = "created_dt", updated: str = "updated_dt") -> DataFrame:
    """Creation and update time of this run."""
    now = F.current_timestamp()
    return df.withColumns({created: now, updated: now})


def flagged(df: DataFrame, flag: str, value: str = "Y") -> DataFrame:
    return df.filter(F.col(flag) == value)


def without_prefixes(df: DataFrame, column: str, prefixes: Iterable[str]) -> DataFrame:
    """Rows whose value starts with none of the prefixes, ignoring case."""
    keep = F.lit(True)
    for prefix in prefixes:
        keep = keep & ~F.lower(column).startswith(prefix.lower())
    return df.filter(keep)


def within(day: Column, first: str, last: str) -> Column:
    """first <= day <= last."""
    return day.cast("date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
