"""Catalog tables, partitions and views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.sources.writers import gathered, partition_name

TEXT_STEPS = ("landing", "pre_dqm")
TYPED_STEPS = ("staging", "publish_table")
FILE_ID = "pt_file_id"


def column_ddl(metadata: Sequence[Mapping], step: str) -> dict[str, str]:
    """Column name to type: strings before staging, configured types from then on.

    The file id column is left out; names are always quoted, which also covers names that start
    with an underscore or a digit.
    """
    if step not in TEXT_STEPS + TYPED_STEPS:
        raise ValueError(f"unknown step {step}")
    ordered = sorted(metadata, key=lambda m: m["column_sequence_number"])
    return {
        m["column_name"]: "string" if step in TEXT_STEPS else m["column_data_type"]
        for m in ordered
        if m["column_name"].lower() != FILE_ID
    }


def _quoted(value: object) -> str:
    """A SQL string literal."""
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def publish_table(
    df: DataFrame, name: str, path: str, step: str, metadata: Sequence[Mapping], partition_by: Sequence[str] = ()
) -> DataFrame:
    """Write `df` to `path` and register it as an external table `db.table`.

    Publishing again replaces the snapshot: the table is registered anew with these columns and this
    path, and partitions that are not in `df` are gone.
    """
    spark = df.sparkSession
    columns = column_ddl(metadata, step)
    partitions = {p: partition_name(p) for p in partition_by}
    out = df.select(
        *[F.col(f"`{c}`").cast(kind).alias(c) for c, kind in columns.items() if c not in partitions],
        *[F.col(f"`{c}`").cast("string").alias(p) for c, p in partitions.items()],
    )
    writer = gathered(out, list(partitions.values())).write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partitions.values()) if partitions else writer).parquet(path)
    body = ", ".join(
        [f"`{c}` {kind}" for c, kind in columns.items() if c not in partitions]
        + [f"`{p}` string" for p in partitions.values()]
    )
    parted = f"PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions.values())})" if partitions else ""
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: the files stay
    spark.sql(f"CREATE TABLE {name} ({body}) USING parquet {parted} LOCATION {_quoted(path)}")
    if partitions:
        refresh_partitions(spark, name)
    return spark.table(name)


def refresh_partitions(spark: SparkSession, name: str, batch: Mapping[str, object] | None = None) -> None:
    """Add one partition, or repair them all."""
    if batch:
        spec = ", ".join(f"`{k}` = {_quoted(v)}" for k, v in batch.items())
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({spec})")
    else:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def publish_views(
    spark: SparkSession, name: str, latest_batch: object, batch_column: str = "pt_batch_id", temporary: bool = False
) -> None:
    """`<name>_full` over all batches and `<name>_latest` over the given one, both recreated."""
    kind = "TEMPORARY VIEW" if temporary else "VIEW"
    base = name.split(".")[-1] if temporary else name
    spark.sql(f"CREATE OR REPLACE {kind} {base}_full AS SELECT * FROM {name}")
    spark.sql(
        f"CREATE OR REPLACE {kind} {base}_latest AS SELECT * FROM {name} WHERE `{batch_column}` = {_quoted(latest_batch)}"
    )
