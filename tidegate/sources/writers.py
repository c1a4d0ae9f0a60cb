"""Sinks and publishing."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.operators.columns import upper_columns
from tidegate.session import delete_path
from tidegate.sources.readers import read_delimited

# Text must come back as it was, blanks at its ends included.
KEEP_BLANKS = dict(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def gathered(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bring rows of one output folder together, so that each task writes few files.

    The rebalance hint lets adaptive execution split a folder that holds very many rows.
    """
    return df.hint("rebalance", *by) if by else df


def write_batch(df: DataFrame, root: str, batch_id, by: Sequence[str] = ("file_id",), batch_column: str = "batch_id") -> str:
    """Overwrite one batch, partitioned by file id; other batches stay untouched.

    The batch goes to its own `<batch column>=<id>` folder, so a rerun replaces exactly that batch.
    Rows of a hot file are spread over several output files.
    """
    path = f"{root}/{batch_column}={batch_id}"
    writer = gathered(df.drop(batch_column), by).write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return path


def publish(df: DataFrame, path: str, handle_empty: bool, by: Sequence[str] = ("file_id",)) -> bool:
    """Write a publish batch over what was published there; returns False when it was empty.

    With `handle_empty` an empty batch leaves files with the schema, unpartitioned, so that readers do
    not fail; without it nothing is left. Either way earlier rows of the batch are gone.
    """
    if df.isEmpty():
        if handle_empty:
            df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
        else:
            delete_path(df.sparkSession, path)
        return False
    writer = gathered(df, by).write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return True


def publish_location(landing: str, post_dq: str, handle_empty: bool) -> str:
    """Where the publish step reads a batch: landing when empty files are handled, else after the checks."""
    return landing if handle_empty else post_dq


def write_csv(
    df: DataFrame, path: str, partition_by: Sequence[str] | None = None, one_file: bool = False, header: bool = True
) -> None:
    """CSV, with header unless told otherwise, written in parallel, optionally partitioned by key.

    With `one_file` the parts become the single file `path` after the write.
    """
    options = dict(header=header, quote='"', escape='"', **KEEP_BLANKS)
    if one_file:
        if partition_by:
            raise ValueError("one file has no partitions")
        _write_one_file(df, path, options)
        return
    writer = df.write.mode("overwrite").options(**options)
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path)


def _write_one_file(df: DataFrame, target: str, options: Mapping) -> None:
    """Write parts in parallel without headers, then join them on the file system behind one header.

    The rows are streamed from file to file by the driver, in the order of the parts: no task and no memory holds them
    all, but one machine copies every byte. That is what a single file costs where the store cannot join files.
    """
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    parts = f"{target}_parts_{uuid.uuid4().hex}"
    df.limit(0).coalesce(1).write.options(**options).csv(f"{parts}/head")
    df.write.options(**{**options, "header": False}).csv(f"{parts}/rows")
    goal = jvm.org.apache.hadoop.fs.Path(target)
    fs = goal.getFileSystem(conf)
    fs.delete(goal, True)
    out = fs.create(goal)
    try:
        for folder in ("head", "rows"):
            listed = fs.listStatus(jvm.org.apache.hadoop.fs.Path(f"{parts}/{folder}"))
            for path in sorted((s.getPath() for s in listed if s.getPath().getName().startswith("part-")), key=lambda p: p.getName()):
                part = fs.open(path)
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, conf, False)
                part.close()
    finally:
        out.close()
        delete_path(spark, parts)


def export_text(
    df: DataFrame, folder: str, name: str, batch_date: str, sep: str = "||", one_file: bool = False, ext: str = "txt"
) -> str:
    """Delimited UTF-8 text with header, upper-case names, without BATCH_DATE, nulls empty.

    Writes `<name>_<batch_date>.<ext>`: a folder of part files, or with `one_file` a single file.
    """
    target = f"{folder}/{name}_{batch_date}.{ext}"
    out = upper_columns(df, drop=["BATCH_DATE"])
    options = dict(sep=sep, header=True, encoding="UTF-8", nullValue="", emptyValue="", escape='"', **KEEP_BLANKS)
    if not one_file:
        out.write.mode("overwrite").options(**options).csv(target)
        return target
    _write_one_file(out, target, options)
    return target


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str], mode: str = "append") -> None:
    df.write.mode(mode).jdbc(url, table, properties=dict(properties))


def table_name(source: str) -> str:
    """Warehouse name of a lake table: lower case, dashes to underscores."""
    return source.lower().replace("-", "_")


def full_refresh(df: DataFrame, url: str, table: str, properties: Mapping[str, str]) -> None:
    """Truncate an existing table and load it again; an absent target is an error."""
    spark = df.sparkSession
    spark.read.jdbc(url, f"(SELECT * FROM {table} WHERE 1 = 0) t", properties=dict(properties)).schema
    df.toDF(*[c.lower() for c in df.columns]).write.mode("overwrite").option("truncate", True).jdbc(
        url, table, properties=dict(properties)
    )


def refresh_all(
    spark: SparkSession, tables: Mapping[str, str], url: str, properties: Mapping[str, str]
) -> dict[str, str]:
    """`full_refresh` for a map of table to Parquet path; returns the outcome of each table."""
    outcome = {}
    for source, path in tables.items():
        try:
            full_refresh(spark.read.parquet(path), url, table_name(source), properties)
            outcome[source] = "SUCCEEDED"
        except Exception as problem:  # reported per table, the others go on
            outcome[source] = f"FAILED: {problem}"
    return outcome


def to_landing(spark: SparkSession, source: str, target: str, spec: Mapping) -> DataFrame:
    """Convert a raw batch (csv, json or parquet) to Parquet.

    `spec`: format, columns, sep, header, multiline (line breaks in quoted fields), row_id (name or None).
    """
    kind = spec.get("format", "csv")
    if kind == "csv":
        raw = read_delimited(spark, source, spec["columns"], spec.get("sep", ","), spec.get("header", True), spec.get("multiline", False))
    elif kind in ("parquet", "json"):
        raw = spark.read.format(kind).load(source)
    else:
        raise ValueError(f"unknown format {kind}")
    if spec.get("row_id"):
        # The landing is the stored copy that keeps the numbers.
        raw = raw.withColumn(spec["row_id"], F.monotonically_increasing_id())
    raw.write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def backup_tables(
    spark: SparkSession,
    tables: Mapping[str, str],
    destination: str,
    batch_date: str,
    exclude: Iterable[str] = (),
    threads: int = 8,
) -> list[str]:
    """Copy each table to `latest/` (replaced as a whole) and to a dated folder, several tables at a time.

    Tables that are excluded or gone are no longer in `latest/` afterwards. Tables whose name starts with an excluded prefix, in any case, are left out.
    """
    prefixes = tuple(p.lower() for p in exclude)
    chosen = sorted(t for t in tables if not (prefixes and t.lower().startswith(prefixes)))

    delete_path(spark, f"{destination}/latest")

    def copy(table: str) -> None:
        for path in (f"{destination}/latest/{table}", f"{destination}/archive/{batch_date}/{table}"):
            spark.read.parquet(tables[table]).write.mode("overwrite").parquet(path)

    with ThreadPoolExecutor(max_workers=threads) as pool:
        list(pool.map(copy, chosen))
    return chosen


def backup_before_change(spark: SparkSession, path: str) -> str:
    """Copy a table to `<path>-before-conv`."""
    copy = f"{path.rstrip('/')}-before-conv"
    spark.read.parquet(path).write.mode("overwrite").parquet(copy)
    return copy


def archive_batch(df: DataFrame, root: str, day: str, batch_id, file_column: str = "file_id") -> DataFrame:
    """Store a raw batch under `<root>/<day>/batch=/file=`; returns its record counts per file."""
    path = f"{root}/{day}/batch={batch_id}"
    gathered(df.withColumnRenamed(file_column, "file"), ["file"]).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).partitionBy("file").parquet(path)
    stored = df.sparkSession.read.parquet(path)
    return stored.groupBy("file").agg(F.count(F.lit(1)).alias("record_count")).withColumn("batch", F.lit(batch_id))


def partition_name(name: str) -> str:
    """Catalog partition column: `pt_` prefix, no blanks or dashes."""
    clean = re.sub("[ -]", "", name)
    return clean if clean.startswith("pt_") else f"pt_{clean}"
