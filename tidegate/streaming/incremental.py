"""Full, incremental and bookmarked loads."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.scalar import clean_message
from tidegate.operators.columns import add_row_id
from tidegate.operators.dimensions import upsert_rows
from tidegate.operators.feeds import FAILED, SUCCEEDED, observe_count, tag_lineage
from tidegate.operators.ordering import number_rows
from tidegate.operators.quality import dq_check, passing_rows
from tidegate.operators.standardize import standardize
from tidegate.session import delete_path, folders_of
from tidegate.streaming.bucketed_table import read_version, rewrite_buckets, version


def full_load(df: DataFrame, path: str) -> DataFrame:
    """Replace the object at `path`."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def incremental_rows(
    df: DataFrame, refresh_column: str, previous_max: Column | None, loaded: DataFrame | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """Rows refreshed since the last load; the literal comparison is pushed to the scan.

    Rows that arrive late with exactly the last maximum count too, without those of `loaded` that have
    the same `keys` at that value. Rows without a refresh value are new as long as `loaded` lacks their keys.
    Without `loaded` only rows beyond the maximum are returned.
    """
    if previous_max is None and loaded is None:
        return df
    value = F.col(refresh_column)
    beyond = df.filter(value.isNotNull()) if previous_max is None else df.filter(value > previous_max)
    if loaded is None:
        return beyond
    if not keys:
        raise ValueError("rows at the last maximum are told apart by keys")
    edge = value.isNull() if previous_max is None else (value == previous_max) | value.isNull()
    known = loaded.filter(edge).select(*[F.col(k).alias(f"__{k}") for k in keys], value.alias("__at"))
    same = value.eqNullSafe(F.col("__at"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return beyond.unionByName(df.filter(edge).join(known, same, "left_anti"))


LOAD_LOG = "object string, run bigint, previous_max string, current_max string, rows bigint, without_value bigint, logged_at timestamp"


def _as_text(value: Column, kind: T.DataType) -> Column:
    """A value as text that `_from_text` reads back in every session time zone."""
    return (F.unix_micros(value) if isinstance(kind, T.TimestampType) else value).cast("string")


def _from_text(text: str, kind: T.DataType) -> Column:
    return F.timestamp_micros(F.lit(int(text))) if isinstance(kind, T.TimestampType) else F.lit(text).cast(kind)


def committed_runs(spark: SparkSession, path: str, log: str) -> DataFrame:
    """The log rows of the finished runs of one object; none while there is no log."""
    if not _holds_files(spark, log):
        return spark.createDataFrame([], LOAD_LOG)
    return spark.read.schema(LOAD_LOG).parquet(log).filter(F.col("object") == path)


def _holds_files(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place))


def loaded_rows(spark: SparkSession, path: str, log: str, schema: T.StructType) -> DataFrame:
    """What the finished runs of `incremental_load` loaded. A run that is not in the log does not count."""
    last = committed_runs(spark, path, log).agg(F.max("run")).first()[0]
    return _rows_of_runs(spark, path, last or 0, schema)


def _rows_of_runs(spark: SparkSession, path: str, last: int, schema: T.StructType) -> DataFrame:
    if not last:
        return spark.createDataFrame([], schema)
    read = spark.read.schema(T.StructType([*schema.fields, T.StructField("run", T.LongType())])).option("basePath", path).parquet(f"{path}/run=*")
    return read.filter(F.col("run") <= last).drop("run")


def incremental_load(df: DataFrame, refresh_column: str, path: str, log: str, keys: Sequence[str] = ()):
    """Load the rows refreshed since the last finished run, and return the highest refresh value loaded so far.

    A load has two phases: the rows go to the folder `<path>/run=<n>` of the next run, and then one row is
    appended to `log`, from which readers and the next run learn that the run is finished. A load that is
    repeated after a crash replaces the folder if the row is missing, and otherwise is a further run; either
    way each row is loaded once. The log row has the maxima before and after, so the mark never goes back,
    the rows loaded and those without a refresh value. Runs of one object follow each other, one at a time.

    With `keys`, rows that arrive late at the last maximum and rows without a refresh value are loaded
    once each; without, only rows beyond the maximum are, and rows without a value by the first run.
    """
    spark, kind, seen = df.sparkSession, df.schema[refresh_column].dataType, Observation()
    # The last run has the highest maximum: it starts from those before.
    done = committed_runs(spark, path, log).agg(F.max(F.struct("run", "current_max")).alias("last")).first().last
    run, text = (done.run + 1, done.current_max) if done else (1, None)
    previous = None if text is None else _from_text(text, kind)
    loaded = _rows_of_runs(spark, path, done.run, df.schema) if done and keys else None
    # Where a finished run found no value at all, only keys tell old rows from new ones.
    fresh = incremental_rows(df, refresh_column, previous, loaded, keys)
    if done and previous is None and not keys:
        fresh = fresh.filter(F.col(refresh_column).isNotNull())
    counted = fresh.observe(
        seen, _as_text(F.max(refresh_column), kind).alias("top"), F.max(refresh_column).alias("value"), F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(refresh_column).isNull()).alias("without_value"),
    )
    counted.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/run={run}")
    top = seen.get["top"]
    current = text if top is None else top
    row = spark.createDataFrame([(path, run, text, current, seen.get["rows"], seen.get["without_value"])], LOAD_LOG.rpartition(",")[0])
    row.withColumn("logged_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(log)
    return seen.get["value"] if top is not None or text is None else spark.range(1).select(previous).first()[0]


def file_stream(
    spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet", max_files: int | None = None, **options
) -> DataFrame:
    """Stream of the files of a folder, with the file name of each row."""
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder).select("*", F.col("_metadata.file_name").alias("file_name"))


def _run_of(spark: SparkSession, bookmark: str) -> tuple[str, bool]:
    """The id of the run that a bookmark belongs to, kept inside it, and whether the run is new."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    place = hadoop.Path(f"{bookmark}/run_id")
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(place):
        return spark.read.text(str(place.toString())).first()[0], False
    run = uuid.uuid4().hex
    out = fs.create(place, False)
    out.write(bytearray(run, "utf-8"))
    out.close()
    return run, True


def ingest_new_files(stream: DataFrame, target: str, bookmark: str) -> None:
    """Append what is new since the bookmark. Deleting the bookmark folder starts over.

    A run's batches lie in `<target>/run=<id>/batch_id=<n>`, each replaced as a whole when it is
    repeated. A run that starts over replaces what earlier runs loaded. Read with `ingested`.
    """
    spark = stream.sparkSession
    run, new = _run_of(spark, bookmark)
    if new:
        for name in folders_of(spark, target):
            delete_path(spark, f"{target}/{name}")

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/run={run}/batch_id={batch_id}")

    _each_batch(stream, bookmark, handle)


def ingested(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """What `ingest_new_files` loaded, without the names of runs and batches."""
    reader = spark.read.schema(schema).option("recursiveFileLookup", "true")
    return reader.parquet(target)


def reset_to_batch(spark: SparkSession, target: str, bookmark: str, batch_id: int) -> None:
    """Take a load back to the state after `batch_id`: later batches are dropped and will be read again."""
    run, _ = _run_of(spark, bookmark)
    hadoop = spark._jvm.org.apache.hadoop.fs
    for log in ("offsets", "commits"):
        folder = hadoop.Path(f"{bookmark}/{log}")
        fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        for status in fs.listStatus(folder) if fs.exists(folder) else ():
            name = status.getPath().getName().strip(".").removesuffix(".crc")
            if name.isdigit() and int(name) > batch_id:
                fs.delete(status.getPath(), False)
    for name in folders_of(spark, f"{target}/run={run}"):
        if int(name.removeprefix("batch_id=")) > batch_id:
            delete_path(spark, f"{target}/run={run}/{name}")


def unread_files(listing: DataFrame, bookmark: DataFrame) -> DataFrame:
    """Files of a listing that no run of `bookmark(run_id, file_name)` has read."""
    return listing.join(bookmark.select("file_name").distinct(), "file_name", "left_anti")


def reset_bookmark(bookmark: DataFrame, run_id) -> DataFrame:
    """The bookmark as it stood after the given run, so that later files are read again."""
    return bookmark.filter(F.col("run_id") <= F.lit(run_id))


def _each_batch(stream: DataFrame, bookmark: str, handle: Callable[[DataFrame, int], None]) -> None:
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", bookmark)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


BATCH_AUDIT = (
    "batch_id bigint, status string, files bigint, rows_read bigint, rows_landed bigint, rows_rejected bigint, first_file_id bigint, "
    "last_file_id bigint, message string, started_at timestamp, ended_at timestamp"
)
FILE_AUDIT = "batch_id bigint, file_id bigint, file_name string, rows_read bigint"


def stream_landing(
    stream: DataFrame,
    target: str,
    errors: str,
    bookmark: str,
    rules: Sequence[Mapping],
    checks: Sequence[Mapping],
    key: Sequence[str],
    audit: str | None = None,
) -> None:
    """Tag, standardise, check and land each micro-batch of `file_stream`.

    Rows get the number of their micro-batch (`batch_id`) and the id of their file (`file_id`). File ids count on, in
    the order of file names, from the last id of the batches before, as the audit has it. Rows with a critical error
    go only to the error output. Last, the batch's audit row is written; readers (`landed_rows`, `landing_errors`) take
    only batches that have one. Everything a batch writes lies in its own `batch_id=` folders, so a repeated batch
    has the same ids, no row twice and one audit row. A failure leaves the row FAILED, which the next attempt replaces.

    `audit` is a folder, by default `<bookmark>_audit`; it holds `batches` and, with the rows of each file, `files`.
    """
    audit = audit or f"{bookmark.rstrip('/')}_audit"

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark, started = batch.sparkSession, datetime.now(timezone.utc)
        at = f"batch_id={batch_id}"
        raw = batch.persist()
        try:
            first = _last_file_id(spark, audit, batch_id) + 1
            # One row for each file of the batch; their number is bounded by the trigger, their list is not collected.
            counted = raw.groupBy("file_name").agg(F.count(F.lit(1)).alias("rows_read"))
            files = number_rows(counted, ["file_name"], "file_id", first)
            files.select("file_id", "file_name", "rows_read").write.mode("overwrite").parquet(f"{audit}/files/{at}")
            files = spark.read.parquet(f"{audit}/files/{at}")
            tagged = tag_lineage(raw, batch_id, files.select("file_name", "file_id"))
            clean = standardize(add_row_id(tagged, "row_id", key), rules)
            wrong = dq_check(clean, checks)
            wrong.write.mode("overwrite").parquet(f"{errors}/{at}")
            good, seen = observe_count(passing_rows(clean, checks, require_rows=False).drop("batch_id"))
            good.write.mode("overwrite").parquet(f"{target}/{at}")
            read = files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("rows_read"), F.lit(0)).alias("rows"), F.coalesce(F.max("file_id"), F.lit(first - 1)).alias("last")).first()
            landed = seen.get["record_count"]
            _audit_batch(spark, audit, at, (SUCCEEDED, read.files, read.rows, landed, read.rows - landed, first, read.last, None, started))
        except Exception as problem:
            _audit_batch(spark, audit, at, (FAILED, None, None, None, None, None, None, str(problem), started))
            raise
        finally:
            raw.unpersist()

    _each_batch(stream, bookmark, handle)


def _audit_batch(spark: SparkSession, audit: str, at: str, values: tuple) -> None:
    fields = BATCH_AUDIT.partition(", ")[2].rpartition(",")[0]
    row = spark.createDataFrame([values], fields).withColumn("message", clean_message(F.col("message"))).withColumn("ended_at", F.current_timestamp())
    row.coalesce(1).write.mode("overwrite").parquet(f"{audit}/batches/{at}")


def landing_audit(spark: SparkSession, audit: str) -> DataFrame:
    """One row for each micro-batch that was tried: its status, files, rows, file ids and times."""
    if not _holds_files(spark, f"{audit}/batches"):
        return spark.createDataFrame([], BATCH_AUDIT)
    return spark.read.schema(BATCH_AUDIT).option("basePath", f"{audit}/batches").parquet(f"{audit}/batches/batch_id=*")


def landing_files(spark: SparkSession, audit: str) -> DataFrame:
    """Id, name and rows of each file of the finished batches."""
    return _of_finished(spark, audit, f"{audit}/files", T.StructType.fromDDL(FILE_AUDIT.partition(", ")[2]))


def landed_rows(spark: SparkSession, target: str, audit: str, schema: T.StructType) -> DataFrame:
    """The landed rows of the finished batches, with `batch_id`; `schema` has the other columns."""
    return _of_finished(spark, audit, target, schema)


def landing_errors(spark: SparkSession, errors: str, audit: str, schema: T.StructType) -> DataFrame:
    """The rule errors of the finished batches, with `batch_id`; `schema` has the other columns."""
    return _of_finished(spark, audit, errors, schema)


def _of_finished(spark: SparkSession, audit: str, folder: str, schema: T.StructType) -> DataFrame:
    done = landing_audit(spark, audit).filter(F.col("status") == SUCCEEDED).select("batch_id")
    full = T.StructType([*[f for f in schema.fields if f.name != "batch_id"], T.StructField("batch_id", T.LongType())])
    if not _holds_files(spark, folder):
        return spark.createDataFrame([], full)
    rows = spark.read.schema(full).option("basePath", folder).parquet(f"{folder}/batch_id=*")
    return rows.join(done, "batch_id", "left_semi").select(*full.names)


def _last_file_id(spark: SparkSession, audit: str, batch_id: int) -> int:
    """The highest file id that batches before this one gave."""
    return landing_audit(spark, audit).filter((F.col("status") == SUCCEEDED) & (F.col("batch_id") < batch_id)).agg(F.coalesce(F.max("last_file_id"), F.lit(0))).first()[0]


def stream_upsert(
    stream: DataFrame, target: str, bookmark: str, keys: Sequence[str], latest_by: str | None = None, buckets: int | None = None, keep: int = 2
) -> None:
    """SCD-1 upsert of each micro-batch into a bucketed table; only buckets that the batch has keys of are rewritten.

    A batch that is repeated after a crash makes no second version; a new bookmark goes on with the table that is
    there. The last `keep` versions stay readable. Read the newest one with `newest_version`: all its rows carry the
    number of its batch, which the manifest has, so that rows that stay are not written again for it.
    """
    spark = stream.sparkSession
    run, _ = _run_of(spark, bookmark)

    def handle(batch: DataFrame, batch_id: int) -> None:
        new = batch.drop("batch_id").persist()
        try:
            merge = lambda rows, held: upsert_rows(rows, held, keys, latest_by)
            rewrite_buckets(new, target, keys, merge, buckets, f"{run}/{batch_id}", batch_id, keep)
        finally:
            new.unpersist()

    _each_batch(stream, bookmark, handle)


def newest_version(spark: SparkSession, target: str) -> DataFrame:
    """The newest complete version of a table kept by `stream_upsert`."""
    return read_version(spark, target).withColumn("batch_id", F.lit(version(spark, target).stamp).cast("bigint"))
