"""Data-quality rules and reconciliation.

The rule vocabulary is a choice of this library: not_null, length, range, in_list, regex,
date_format, sql_predicate work on one row; unique and referential look at other rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.operators.skew import balanced_join, lookup_join
from tidegate.session import store

CRITICAL = "critical"
ERROR_SCHEMA = "row_id bigint, rule_id string, column_name string, value string, severity string"
ROW_CHECKS = ("not_null", "length", "range", "in_list", "regex", "date_format", "sql_predicate")
TABLE_CHECKS = ("unique", "referential")


class NoRowsLeft(ValueError):
    """Every row of a batch failed its checks."""


def _passes(rule: Mapping) -> Column:
    """Condition under which a row passes; nulls pass all checks but not_null."""
    check = rule["check"]
    if check == "sql_predicate":
        return F.expr(rule["predicate"])
    c = F.col(rule["column"])
    match check:
        case "not_null":
            return c.isNotNull()
        case "length":
            return F.length(c).between(rule.get("min", 0), rule.get("max", 2**31 - 1))
        case "range":
            number = F.expr(f"try_cast(`{rule['column']}` AS double)")
            inside = F.lit(True)
            if rule.get("min") is not None:
                inside = inside & (number >= rule["min"])
            if rule.get("max") is not None:
                inside = inside & (number <= rule["max"])
            return F.when(c.isNotNull(), F.coalesce(inside & number.isNotNull(), F.lit(False)))
        case "in_list":
            return c.isin(list(rule["values"]))
        case "regex":
            return c.rlike(rule["pattern"])
        case "date_format":
            return F.when(c.isNotNull(), F.try_to_timestamp(c, F.lit(rule["format"])).isNotNull())
    raise ValueError(f"unknown check {check}")


def _error(rule: Mapping, value: Column) -> Column:
    return F.struct(
        F.lit(rule["rule_id"]).alias("rule_id"),
        F.lit(rule.get("column", "")).alias("column_name"),
        value.cast("string").alias("value"),
        F.lit(rule.get("severity", CRITICAL)).alias("severity"),
    )


def dq_check(
    df: DataFrame,
    rules: Sequence[Mapping],
    row_id: str = "row_id",
    references: Mapping[str, DataFrame] | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per failing row and rule; without rules the result is empty.

    All row checks share one scan. `unique` fails every row whose value occurs more than once,
    `referential` every non-null value absent from `references[name]` (its column `reference_column`).
    `carry` adds columns such as the batch id to the output.
    """
    for rule in rules:
        if rule["check"] not in ROW_CHECKS + TABLE_CHECKS:
            raise ValueError(f"unknown check {rule['check']}")
    # Ids are numbers, or texts such as the hash of a key.
    kind = T.StringType() if df.schema[row_id].dataType == T.StringType() else T.LongType()
    keep = [F.col(row_id).cast(kind).alias("row_id"), *[F.col(c) for c in carry]]
    out = ["row_id", *carry, "rule_id", "column_name", "value", "severity"]
    parts = []
    by_row = [r for r in rules if r["check"] in ROW_CHECKS]
    if by_row:
        failed = F.array(
            *[F.when(~F.coalesce(_passes(r), F.lit(True)), _error(r, F.col(r["column"]) if r.get("column") else F.lit(None)))
              for r in by_row]
        )
        parts.append(
            df.select(*keep, F.explode(F.filter(failed, lambda e: e.isNotNull())).alias("e")).select(
                "row_id", *carry, "e.*"
            )
        )
    for rule in rules:
        if rule["check"] in TABLE_CHECKS:
            value = F.col(rule["column"])
            narrow = df.select(*keep, value.alias("__v")).filter("__v is not null")
            if rule["check"] == "unique":
                repeated = narrow.groupBy("__v").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select("__v")
                bad = balanced_join(narrow, repeated, ["__v"], "left_semi")
            else:
                known = (references or {})[rule["reference"]].select(F.col(rule["reference_column"]).alias("__v")).distinct()
                bad = lookup_join(narrow, known, ["__v"], "left_anti")
            parts.append(bad.select("row_id", *carry, _error(rule, F.col("__v")).alias("e")).select("row_id", *carry, "e.*"))
    if not parts:
        schema = T.StructType(
            [T.StructField("row_id", kind), *[df.schema[c] for c in carry]]
            + [T.StructField(n, T.StringType()) for n in ("rule_id", "column_name", "value", "severity")]
        )
        return df.sparkSession.createDataFrame([], schema)
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.select(*out)


def dq_summary(errors: DataFrame, checked: int | Column, rules: Sequence[Mapping]) -> DataFrame:
    """Per rule: rows checked, rows failed, pass rate. Rules without failures are listed too."""
    listed = errors.sparkSession.createDataFrame(
        [(r["rule_id"], r.get("severity", CRITICAL)) for r in rules], "rule_id string, severity string"
    )
    failed = errors.groupBy("rule_id").agg(F.count(F.lit(1)).alias("failed"))
    total = (checked if isinstance(checked, Column) else F.lit(checked)).cast("bigint")
    bad = F.coalesce("failed", F.lit(0)).cast("bigint")
    return F.broadcast(listed).join(failed, "rule_id", "left").select(
        "rule_id", "severity", total.alias("checked"), bad.alias("failed"),
        F.round(F.when(total > 0, (total - bad) / total), 6).alias("pass_rate"),
    )


def dq_filter(df: DataFrame, errors: DataFrame, row_id: str = "row_id", require_rows: bool = True) -> DataFrame:
    """Rows without a critical error (a choice: other severities only report)."""
    bad = errors.filter(F.col("severity") == CRITICAL).select(F.col("row_id").alias(row_id)).distinct()
    clean = balanced_join(df, bad, [row_id], "left_anti")
    if require_rows and clean.isEmpty():
        raise NoRowsLeft("no rows left after the quality checks")
    return clean


def passing_rows(
    df: DataFrame,
    rules: Sequence[Mapping],
    row_id: str = "row_id",
    references: Mapping[str, DataFrame] | None = None,
    require_rows: bool = True,
) -> DataFrame:
    """The rows `dq_filter(df, dq_check(df, rules))` keeps, without moving the table where it can.

    Critical row rules become a filter of the scan; only critical `unique` and `referential` rules
    need the join with their errors.
    """
    critical = [r for r in rules if r.get("severity", CRITICAL) == CRITICAL]
    clean = df
    for rule in critical:
        if rule["check"] in ROW_CHECKS:
            clean = clean.filter(F.coalesce(_passes(rule), F.lit(True)))
    by_table = [r for r in critical if r["check"] in TABLE_CHECKS]
    if by_table:
        return dq_filter(clean, dq_check(df, by_table, row_id, references), row_id, require_rows)
    if require_rows and clean.isEmpty():
        raise NoRowsLeft("no rows left after the quality checks")
    return clean


@dataclass(frozen=True)
class Reconciliation:
    """Result frames of one comparison; `compared` has one row per key that had to be compared."""

    compared: DataFrame
    missing: DataFrame
    extra: DataFrame
    duplicates: DataFrame
    mismatches: DataFrame
    summary: DataFrame


def suspect_buckets(source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int) -> DataFrame:
    """The buckets, by hash of the key, in which the sides may differ or a key may occur twice; `buckets` rows at most.

    Both sides are digested where they are read: per bucket the difference in rows and in sums of one hash of key and
    columns, and the exclusive or of another. Sides that agree in a bucket hold the same rows there (but for a chance
    of 2 to the -100), so whether keys repeat in it is told by one side: of it the hashes of the keys are shuffled.
    """

    def rows(df: DataFrame, sign: int) -> DataFrame:
        whole = [c for name in (*keys, *columns) for c in (F.col(name).isNull(), F.col(name))]
        return df.select(
            _bucket(keys, buckets).alias("__bucket"), F.lit(sign).alias("sign"), F.xxhash64(F.lit(1), *whole).alias("h1"),
            (F.xxhash64(F.lit(2), *whole).cast("decimal(20,0)") * sign).alias("h2"),
        )

    net = rows(source, 1).union(rows(target, -1)).groupBy("__bucket").agg(F.sum("sign").alias("n"), F.bit_xor("h1").alias("h1"), F.sum("h2").alias("h2"))
    differing = net.filter("n <> 0 OR h1 <> 0 OR h2 <> 0").select("__bucket")
    key = source.select(_bucket(keys, buckets).alias("__bucket"), _key_hash(keys).alias("key"))
    repeated = key.groupBy("key", "__bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("__bucket")
    return differing.union(repeated).distinct()


def _key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[c for name in keys for c in (F.col(name).isNull(), F.col(name))])


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(_key_hash(keys), F.lit(buckets))


def reconcile(
    source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int = 16_384
) -> Reconciliation:
    """Compare a source extract with the loaded table.

    Keys that occur several times on a side are reported, then one copy per key (the smallest by
    all columns) is compared. Null keys match each other.

    Digests by bucket of the key's hash come first; only rows of buckets that differ, or in which a key repeats,
    are shuffled with their columns. So the cost beyond two scans follows the differences. The list of such
    buckets has at most `buckets` rows and is broadcast. In these buckets both sides meet in one aggregation by
    key, and a hot key is combined before the shuffle. `compared` has the keys of these buckets.
    """
    suspects = F.broadcast(store(suspect_buckets(source, target, keys, columns, buckets), "suspect_buckets"))
    source, target = (df.withColumn("__bucket", _bucket(keys, buckets)).join(suspects, "__bucket", "left_semi") for df in (source, target))
    picked = [*keys, *columns]
    both = source.select(*picked, F.lit("s").alias("__side")).unionByName(target.select(*picked, F.lit("t").alias("__side")))
    row = F.struct(*[F.col(c) for c in columns])
    compared = both.groupBy(*keys).agg(
        *[F.count_if(F.col("__side") == side).alias(f"n_{side}") for side in ("s", "t")],
        *[F.min(F.when(F.col("__side") == side, row)).alias(side) for side in ("s", "t")],
    )
    in_both = (F.col("n_s") > 0) & (F.col("n_t") > 0)
    differing = F.filter(
        F.array(
            *[
                F.when(
                    ~F.col(f"s.{c}").eqNullSafe(F.col(f"t.{c}")),
                    F.struct(
                        F.lit(c).alias("column_name"),
                        F.col(f"s.{c}").cast("string").alias("source_value"),
                        F.col(f"t.{c}").cast("string").alias("target_value"),
                    ),
                )
                for c in columns
            ]
        ),
        lambda e: e.isNotNull(),
    )
    # Stored once: the five reports read the outcome, not both tables again.
    compared = store(compared.withColumn("diffs", F.when(in_both, differing).otherwise(F.array())), "compared")
    is_missing, is_extra = F.col("n_t") == 0, F.col("n_s") == 0
    is_double = (F.col("n_s") > 1) | (F.col("n_t") > 1)
    wrong = is_missing | is_extra | is_double | (F.size("diffs") > 0)
    return Reconciliation(
        compared,
        compared.filter(is_missing).select(*keys),
        compared.filter(is_extra).select(*keys),
        compared.filter(is_double).select(*keys, "n_s", "n_t"),
        compared.select(*keys, F.inline("diffs")),
        compared.agg(
            F.count_if(is_missing).alias("missing_records"),
            F.count_if(is_extra).alias("extra_records"),
            F.count_if(is_double).alias("dup_records"),
            F.count_if(F.size("diffs") > 0).alias("mismatched_records"),
            F.count_if(wrong).alias("total_records_with_errors"),
        ),
    )


SUMMARY_SCHEMA = (
    "subject string, status string, missing_records bigint, extra_records bigint, dup_records bigint, "
    "mismatched_records bigint, total_records_with_errors bigint, message string"
)


def reconcile_all(spark, subjects: Mapping[str, Callable[[], Reconciliation]], threads: int = 4) -> DataFrame:
    """Run the subjects side by side; one that fails is reported and the others go on.

    The result has one row per subject.
    """

    def outcome(name: str) -> tuple:
        try:
            s = subjects[name]().summary.first()
            return (name, "DONE", *[s[i] for i in range(5)], None)
        except Exception as problem:  # any failure of a subject is part of the report
            return (name, "FAILED", None, None, None, None, None, str(problem))

    with ThreadPoolExecutor(max_workers=threads) as pool:
        rows = list(pool.map(outcome, subjects))
    return spark.createDataFrame(rows, SUMMARY_SCHEMA)
