"""Dimension upkeep: upsert, effective-date defaults, table-specific cleansing."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.operators.columns import add_columns
from tidegate.operators.skew import balanced_join, null_safe_key

# Open start and end of an effective period.
FIRST_DAY, LAST_DAY = "19000101", "29991231"


def one_per_key(df: DataFrame, keys: Sequence[str], latest_by: str | None = None) -> DataFrame:
    """One row per key: the one with the highest `latest_by`, else the highest row by all columns."""
    rest = [c for c in df.columns if c not in keys]
    lead = [latest_by] if latest_by else []
    best = F.max(F.struct(*lead, *[c for c in rest if c not in lead]))
    return df.groupBy(*keys).agg(best.alias("__b")).select(*keys, "__b.*").select(*df.columns)


def stitch_scd1(
    new: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    batch_id: int,
    scd_type: int = 1,
    latest_by: str | None = None,
    batch_column: str = "batch_id",
) -> DataFrame:
    """Upsert: new rows replace history rows of the same key, the others stay.

    Duplicates within the new batch are resolved by `latest_by` (a choice). All rows carry the new
    batch id. Null keys match each other.
    """
    if not keys:
        raise ValueError("no key columns configured")
    if scd_type != 1:
        raise ValueError(f"SCD type {scd_type} is not supported")
    stitched = upsert_rows(new.drop(batch_column), history.drop(batch_column), keys, latest_by)
    return stitched.withColumn(batch_column, F.lit(batch_id).cast("bigint"))


def upsert_rows(new: DataFrame, held: DataFrame, keys: Sequence[str], latest_by: str | None = None) -> DataFrame:
    """The rows of `held` whose key `new` lacks, and one row for each key of `new`. Null keys match each other."""
    incoming = one_per_key(new, keys, latest_by)
    key = null_safe_key(keys).alias("__key")
    kept = balanced_join(held.select("*", key), incoming.select(key), ["__key"], "left_anti").drop("__key")
    return kept.unionByName(incoming)


def latest_successful_batch(log: DataFrame) -> DataFrame:
    """Highest batch id whose current status is success, in one row."""
    return log.filter("status = 'SUCCEEDED'").agg(F.max("batch_id").alias("batch_id"))


def add_scd2_defaults(df: DataFrame, start: str = "start_dt_wid", end: str = "end_dt_wid") -> DataFrame:
    """Open effective period for a dimension that had none."""
    return add_columns(df, {start: (FIRST_DAY, "decimal(10,0)"), end: (LAST_DAY, "decimal(10,0)")})


Step = Callable[[DataFrame], DataFrame]


def cleanse(df: DataFrame, table: str, steps: Mapping[str, Sequence[Step]], always: Sequence[Step] = ()) -> DataFrame:
    """Run the common steps and then those configured for the table, in order."""
    for step in [*always, *steps.get(table, ())]:
        df = step(df)
    return df
