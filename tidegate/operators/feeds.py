"""Feed and batch control on listing and audit tables."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidegate.operators.ordering import dense_rank_of, number_rows
from tidegate.operators.skew import bounded_broadcast, lookup_join, null_safe_key
from tidegate.operators.relational import latest_per

FAILED, SUCCEEDED, SKIPPED, RUNNING = "FAILED", "SUCCEEDED", "SKIPPED", "IN PROGRESS"

# Markers of a file-name pattern and the text they stand for.
FULL_DATES = {
    "YYYYMMDD": ("_([0-9]{4}(?:1[0-2]|0[1-9])[0-3][0-9])", "yyyyMMdd"),
    "MMDDYYYY": ("((?:1[0-2]|0[1-9])[0-3][0-9][0-9]{4})", "MMddyyyy"),
}
MONTH_MARKER, MONTH_TEXT = "MmmYyy", "M(1[0-2]|0[1-9])Y([0-9]{2})"
WEEK_MARKER, WEEK_TEXT = "_Www", "_W(0[1-9]|[1-4][0-9]|5[0-2])"
# Two-digit years from here on belong to the last century.
CENTURY_TURN = 69


def feed_name(file_name: Column) -> Column:
    """Logical feed: the name without its last extension and without an all-digit last token."""
    stem = F.regexp_replace(file_name, r"^(.+)\.[^.]+$", "$1")
    return F.regexp_replace(stem, "(^|_)[0-9]+$", "")


def missing_feeds(listing: DataFrame, config: DataFrame) -> DataFrame:
    """Mandatory feeds of `config(feed, mandatory_flag)` without a file in `listing(file_name)`."""
    seen = listing.select(feed_name(F.col("file_name")).alias("feed")).distinct()
    return config.filter("mandatory_flag = 'Y'").join(seen, "feed", "left_anti")


def require_feeds(listing: DataFrame, config: DataFrame) -> None:
    """Raise when a mandatory feed is missing."""
    # One short row per configured feed at most; every missing one is named.
    names = sorted(r["feed"] for r in missing_feeds(listing, config).select("feed").collect())
    if names:
        raise ValueError(f"mandatory feeds are missing: {names}")


def latest_batch(names: DataFrame, column: str = "name") -> DataFrame:
    """The newest batch folder among `yyyyMMdd` and `yyyyMMddHHmm` names; null when there is none.

    Printed with 8 digits when its time is midnight. Names that are no valid date are ignored.
    """
    name = F.col(column)
    when = F.when(name.rlike("^[0-9]{8}$"), F.try_to_timestamp(name, F.lit("yyyyMMdd"))).when(
        name.rlike("^[0-9]{12}$"), F.try_to_timestamp(name, F.lit("yyyyMMddHHmm"))
    )
    midnight = (F.hour("t") == 0) & (F.minute("t") == 0)
    return names.agg(F.max(when).alias("t")).select(
        F.when(midnight, F.date_format("t", "yyyyMMdd")).otherwise(F.date_format("t", "yyyyMMddHHmm")).alias("batch")
    )


def backfill(missing: DataFrame, archive: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Replacement files from the newest archive batch, and the feeds still missing.

    `missing(feed, cleanup_flag)`, `archive(batch, file_name)`. Only feeds with cleanup flag N are
    taken from the archive.
    """
    newest = latest_batch(archive.select("batch").distinct(), "batch").scalar()
    available = archive.filter(F.col("batch") == newest).withColumn("feed", feed_name(F.col("file_name")))
    wanted = missing.filter("cleanup_flag = 'N'").select("feed").distinct()
    copied = available.join(bounded_broadcast(wanted), "feed", "left_semi").select("feed", "batch", "file_name")
    return copied, missing.join(copied.select("feed").distinct(), "feed", "left_anti")


def field_count(line: Column, separator: str) -> Column:
    """Number of fields; separators inside double quotes do not count (a choice)."""
    bare = F.regexp_replace(line, '"[^"]*"', "")
    removed = F.length(bare) - F.length(F.replace(bare, F.lit(separator), F.lit("")))
    return (removed / len(separator)).cast("int") + 1


def field_count_errors(lines: DataFrame, separator: str, expected: int, value: str = "value") -> DataFrame:
    """Lines whose field count differs from the configured one."""
    counted = lines.withColumn("n_fields", field_count(F.col(value), separator))
    return counted.filter(F.col("n_fields") != expected)


def header_mismatch(headers: DataFrame, metadata: DataFrame, separator: str = ",") -> DataFrame:
    """Positions at which a file's header differs from the configured source columns.

    `headers(file_name, dataset_id, header)`, `metadata(dataset_id, column_sequence_number,
    source_column_name, header_flag)`. Only datasets with flag Y are checked; V (variable) and N
    are skipped. The separator is plain text, and quotes around a header field are not part of its name.
    """
    configured = (
        metadata.filter("header_flag = 'Y'")
        .groupBy("dataset_id")
        .agg(F.array_sort(F.collect_list(F.struct("column_sequence_number", "source_column_name"))).alias("c"))
        .select("dataset_id", F.transform("c", lambda x: x["source_column_name"]).alias("expected"))
    )
    compared = lookup_join(headers, configured, ["dataset_id"], "inner")
    fields = F.split("header", re.escape(separator))
    compared = compared.withColumn("actual", F.transform(fields, lambda f: F.regexp_replace(f, '^"(.*)"$', "$1")))
    length = F.greatest(F.size("actual"), F.size("expected"))
    return (
        compared.withColumn("pos", F.explode(F.sequence(F.lit(0), length - 1)))
        .select(
            "file_name", "dataset_id", (F.col("pos") + 1).alias("position"),
            F.get("actual", F.col("pos")).alias("actual"), F.get("expected", F.col("pos")).alias("expected"),
        )
        .filter(~F.col("actual").eqNullSafe(F.col("expected")))
    )


def pending_files(listing: DataFrame, audit: DataFrame, static: bool) -> DataFrame:
    """Files to process: static sources skip the failed ones, others everything already logged.

    `audit(file_name, status)` holds the current status of each file.
    """
    done = audit.filter(F.col("status") == FAILED) if static else audit.filter(
        F.col("status").isin(FAILED, SUCCEEDED, RUNNING, SKIPPED)
    )
    return listing.join(done.select("file_name").distinct(), "file_name", "left_anti")


class NothingToDo(ValueError):
    """No file is left to process."""


def pending_or_skip(pending: DataFrame, skip_allowed: bool) -> tuple[DataFrame, str]:
    """The pending files with the status of their batch: in progress, or skipped when there are none.

    Without `skip_allowed` an empty list is an error.
    """
    if not pending.isEmpty():
        return pending, RUNNING
    if not skip_allowed:
        raise NothingToDo("no files to process")
    return pending, SKIPPED


def retry_files(audit: DataFrame) -> DataFrame:
    """Failed files with their old batch and file ids."""
    return audit.filter(F.col("status") == FAILED)


def needs_run(files: DataFrame, log: DataFrame, step: str) -> DataFrame:
    """Per batch: must `step` run, because one of its files has no log row or failed?

    `files(batch_id, file_name)`, `log(batch_id, file_name, step, status)` with current statuses.
    """
    state = log.filter(F.col("step") == step).select("batch_id", "file_name", "status")
    todo = F.col("status").isNull() | (F.col("status") == FAILED)
    return (
        files.join(state, ["batch_id", "file_name"], "left")
        .groupBy("batch_id")
        .agg(F.bool_or(todo).alias("needs_run"))
    )


def file_order_value(file_name: Column, pattern: str) -> Column:
    """Sort value found in a file name: a date as days, a week number, or 0 without a pattern.

    Null when the name does not fit its pattern.
    """
    for marker, (regex, fmt) in FULL_DATES.items():
        if marker in pattern:
            return F.unix_date(F.try_to_timestamp(F.regexp_extract(file_name, regex, 1), F.lit(fmt)).cast("date"))
    if MONTH_MARKER in pattern:
        month, year = (F.regexp_extract(file_name, MONTH_TEXT, i).try_cast("int") for i in (1, 2))
        century = F.when(year >= CENTURY_TURN, 1900).otherwise(2000)
        return F.unix_date(F.make_date(century + year, month, F.lit(1)))
    if WEEK_MARKER in pattern:
        week = F.regexp_extract(file_name, WEEK_TEXT, 1)
        return F.when(week != "", week.try_cast("int"))
    return F.lit(0)


def file_batch_order(files: DataFrame, pattern: str, multiple: bool = True) -> DataFrame:
    """Add `batch_order`: files with equal dates share a batch, batches count from 1.

    Without `multiple` all files form batch 1. A name that does not fit has a null order; `assign_ids`
    refuses it, and `misfit_names` lists such files.
    """
    value = file_order_value(F.col("file_name"), pattern) if multiple else F.lit(0)
    ranked = dense_rank_of(files.withColumn("__v", value), "__v", "batch_order")
    return ranked.drop("__v")


def assign_ids(files: DataFrame, last_batch_id: int, last_file_id: int) -> DataFrame:
    """Batch ids continue from `last_batch_id` by batch order, file ids from `last_file_id` by name.

    A file without batch order, because its name does not fit the pattern, is an error.
    """
    misfit = F.raise_error(F.concat(F.lit("the file name does not fit its pattern: "), F.col("file_name"))).cast("int")
    files = files.withColumn("batch_order", F.coalesce("batch_order", misfit))
    numbered = number_rows(files, ["batch_order", "file_name"], "file_id", last_file_id + 1)
    return numbered.withColumn("batch_id", (F.col("batch_order") + last_batch_id).cast("bigint"))


def misfit_names(ordered: DataFrame) -> DataFrame:
    """The files of `file_batch_order` whose names do not fit their pattern."""
    return ordered.filter("batch_order is null")


def unprocessed_sources(control: DataFrame, log: DataFrame) -> DataFrame:
    """Work list without full loads that have already completed; other load types always stay.

    Both frames carry platform, source_system, database_name, object_name and query_text (nullable).
    """
    key = ["platform", "source_system", "database_name", "object_name", "query_text"]
    source = null_safe_key(key).alias("__source")
    is_full = F.lower("load_type") == "full"
    done = log.filter((F.col("status") == SUCCEEDED) & is_full).select(source).distinct()
    full = control.filter(is_full).select("*", source).join(done, "__source", "left_anti").drop("__source")
    return full.unionByName(control.filter(~is_full))


def select_sources(
    control: DataFrame,
    systems: Sequence[str] | None = None,
    database: str | None = None,
    object_name: str | None = None,
) -> DataFrame:
    """Active control rows; systems compare in lower case, the other filters exactly."""
    chosen = control.filter("active_flag = 'Y'")
    if systems:
        chosen = chosen.filter(F.lower("source_system").isin([s.lower() for s in systems]))
    if database:
        chosen = chosen.filter(F.col("database_name") == database)
    if object_name:
        chosen = chosen.filter(F.col("object_name") == object_name)
    return chosen


def batch_counts(df: DataFrame, *by: str) -> DataFrame:
    """Rows per batch (and file)."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("record_count"))


def observe_count(df: DataFrame) -> tuple[DataFrame, Observation]:
    """`df` that counts its rows while it is written; read `observation.get["record_count"]` after."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("record_count")), seen


def log_status(spark: SparkSession, path: str, rows: DataFrame, max_length: int | None = 2000) -> None:
    """Append status rows to the audit table; messages are cut at `max_length` and stripped of quotes."""
    from tidegate.functions.scalar import clean_message

    logged = rows.withColumn("message", clean_message(F.col("message"), max_length)) if "message" in rows.columns else rows
    logged.write.mode("append").parquet(path)


def current_status(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Latest status per key, by `logged_at`."""
    return latest_per(log, keys, "status", "logged_at")


def tag_lineage(
    df: DataFrame,
    batch_id: int,
    file_ids: DataFrame,
    file_column: str = "file_name",
    configured: Sequence[str] | None = None,
) -> DataFrame:
    """Add `batch_id` and the `file_id` of the row's file.

    `file_ids(<file_column>, file_id)` has one row per file; rows of one file are many, so its hot
    keys are spread when the list is too long to broadcast. With a list of `configured` columns
    the tags are added only if it names both.
    """
    if configured is not None and not {"batch_id", "file_id"} <= {c.lower() for c in configured}:
        return df
    tagged = df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    return lookup_join(tagged, file_ids, [file_column], "left")
