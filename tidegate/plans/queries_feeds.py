"""Queries over feed control, hierarchy, dimension and data-quality operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.operators import columns as P
from tidegate.operators import dimensions as D
from tidegate.operators import feeds as X
from tidegate.operators import hierarchy as H
from tidegate.operators import quality as M
from tidegate.operators.ordering import number_rows
from tidegate.operators.standardize import standardize
from tidegate.plans.inputs import derived, table
from tidegate.plans.registry import query
from tidegate.session import scratch_path
from tidegate.sources.readers import read_parquet

FEED_OF = "regexp_replace(regexp_replace({c}, '^(.+)\\.[^.]+$', '\\1'), '(^|_)[0-9]+$', '')"
NAME_FEED = FEED_OF.format(c="file_name")

# Feed configuration: feed, mandatory flag, clean-up flag.
FEED_CONFIG = [(f"feed_{s}_{p}", "Y" if p != 5 else "N", "N" if p % 2 == 0 else "Y") for s in "fopx" for p in range(1, 7)]
_CONFIG_SQL = "config(feed, mandatory_flag, cleanup_flag) AS (VALUES " + ", ".join(map(str, FEED_CONFIG)) + ")"


def _config(spark):
    return spark.createDataFrame(FEED_CONFIG, "feed string, mandatory_flag string, cleanup_flag string")


# --- feeds and batches --------------------------------------------------------------------------


@query("f01_feed_name", f"SELECT file_name, {NAME_FEED} AS feed FROM feed_files", inputs=("feed_files",))
def _(spark, sf):
    return derived(spark, sf, "feed_files").withColumn("feed", X.feed_name(F.col("file_name")))


@query(
    "f02_missing_feeds",
    f"""WITH {_CONFIG_SQL} SELECT feed, mandatory_flag, cleanup_flag FROM config
        WHERE mandatory_flag = 'Y' AND feed NOT IN (SELECT {NAME_FEED} FROM feed_files)""",
    inputs=("feed_files",),
)
def _(spark, sf):
    return X.missing_feeds(derived(spark, sf, "feed_files"), _config(spark))


@query(
    "f03_latest_batch",
    """WITH names AS (SELECT DISTINCT concat(strftime(o_orderdate, '%Y%m%d'), CASE o_orderstatus WHEN 'F' THEN '' WHEN 'O' THEN '0930' ELSE 'x' END) AS name FROM orders),
         times AS (SELECT CASE WHEN regexp_full_match(name, '[0-9]{8}') THEN TRY_STRPTIME(name, '%Y%m%d')
                               WHEN regexp_full_match(name, '[0-9]{12}') THEN TRY_STRPTIME(name, '%Y%m%d%H%M') END AS t FROM names)
       SELECT CASE WHEN hour(MAX(t)) = 0 AND minute(MAX(t)) = 0 THEN strftime(MAX(t), '%Y%m%d') ELSE strftime(MAX(t), '%Y%m%d%H%M') END AS batch FROM times""",
)
def _(spark, sf):
    suffix = F.when(F.col("o_orderstatus") == "F", "").when(F.col("o_orderstatus") == "O", "0930").otherwise("x")
    names = table(spark, sf, "orders").select(F.concat(F.date_format("o_orderdate", "yyyyMMdd"), suffix).alias("name"))
    return X.latest_batch(names.distinct())


_ARCHIVE = """archive AS (SELECT substr(file_name, 10, 8) AS batch, replace(file_name, 'feed_p', 'feed_x') AS file_name FROM feed_files)"""
_MISSING = f"missing AS (SELECT * FROM config WHERE mandatory_flag = 'Y' AND feed NOT IN (SELECT {NAME_FEED} FROM feed_files))"


def _archive(spark, sf):
    files = derived(spark, sf, "feed_files")
    return files.select(
        F.substring("file_name", 10, 8).alias("batch"),
        F.replace("file_name", F.lit("feed_p"), F.lit("feed_x")).alias("file_name"),
    )


@query(
    "f04_backfill_copied",
    f"""WITH {_CONFIG_SQL}, {_ARCHIVE}, {_MISSING}
        SELECT {NAME_FEED} AS feed, batch, file_name FROM archive
        WHERE batch = (SELECT MAX(batch) FROM archive) AND {NAME_FEED} IN (SELECT feed FROM missing WHERE cleanup_flag = 'N')""",
    inputs=("feed_files",),
)
def _(spark, sf):
    missing = X.missing_feeds(derived(spark, sf, "feed_files"), _config(spark))
    return X.backfill(missing, _archive(spark, sf))[0]


@query(
    "f04_backfill_still_missing",
    f"""WITH {_CONFIG_SQL}, {_ARCHIVE}, {_MISSING}
        SELECT feed, mandatory_flag, cleanup_flag FROM missing WHERE NOT (cleanup_flag = 'N' AND feed IN
          (SELECT {NAME_FEED} FROM archive WHERE batch = (SELECT MAX(batch) FROM archive)))""",
    inputs=("feed_files",),
)
def _(spark, sf):
    missing = X.missing_feeds(derived(spark, sf, "feed_files"), _config(spark))
    return X.backfill(missing, _archive(spark, sf))[1]


@query(
    "f06_field_count",
    "SELECT o_orderkey, value, CAST(4 AS BIGINT) AS n_fields FROM order_lines WHERE value LIKE '%|extra'",
    inputs=("order_lines",),
)
def _(spark, sf):
    bad = X.field_count_errors(derived(spark, sf, "order_lines"), "|", 3)
    return bad.withColumn("n_fields", F.col("n_fields").cast("bigint"))


@query(
    "f07_header_mismatch",
    """WITH need AS (SELECT h.file_name, h.dataset_id, string_split(h.header, ',') AS actual,
              (SELECT list(source_column_name ORDER BY column_sequence_number) FROM part_columns c
               WHERE c.dataset_id = h.dataset_id AND c.header_flag = 'Y') AS expected FROM part_headers h),
            pos AS (SELECT file_name, dataset_id, actual, expected, unnest(range(1, greatest(len(actual), len(expected)) + 1)) AS p
                    FROM need WHERE expected IS NOT NULL)
       SELECT file_name, dataset_id, CAST(p AS BIGINT) AS position, actual[p] AS actual, expected[p] AS expected
       FROM pos WHERE actual[p] IS DISTINCT FROM expected[p]""",
    inputs=("part_headers", "part_columns"),
)
def _(spark, sf):
    found = X.header_mismatch(derived(spark, sf, "part_headers"), derived(spark, sf, "part_columns"))
    return found.withColumn("position", F.col("position").cast("bigint"))


@query(
    "f07_header_bars",
    """SELECT h.file_name, CAST(p AS BIGINT) AS position, string_split(h.header, ',')[p] AS actual, e.names[p] AS expected
       FROM part_headers h JOIN (SELECT dataset_id, list(source_column_name ORDER BY column_sequence_number) AS names FROM part_columns
            WHERE header_flag = 'Y' GROUP BY dataset_id) e USING (dataset_id),
            unnest(range(1, greatest(len(string_split(h.header, ',')), len(e.names)) + 1)) AS u(p)
       WHERE string_split(h.header, ',')[p] IS DISTINCT FROM e.names[p]""",
    inputs=("part_headers", "part_columns"),
)
def _(spark, sf):
    # The same headers with fields in quotes and two bars between them.
    quoted = F.concat(F.lit('"'), F.replace("header", F.lit(","), F.lit('"||"')), F.lit('"'))
    found = X.header_mismatch(derived(spark, sf, "part_headers").withColumn("header", quoted), derived(spark, sf, "part_columns"), "||")
    return found.select("file_name", F.col("position").cast("bigint"), "actual", "expected")


def _pending(static):
    return lambda spark, sf: X.pending_files(derived(spark, sf, "feed_files"), derived(spark, sf, "feed_log"), static)


query(
    "f08_pending_static",
    "SELECT file_name FROM feed_files WHERE file_name NOT IN (SELECT file_name FROM feed_log WHERE status = 'FAILED')",
    ("feed_files", "feed_log"),
)(_pending(True))
query(
    "f08_pending_new",
    "SELECT file_name FROM feed_files WHERE file_name NOT IN (SELECT file_name FROM feed_log)",
    ("feed_files", "feed_log"),
)(_pending(False))


@query(
    "f08_retry_files",
    "SELECT file_name, status FROM feed_log WHERE status = 'FAILED'",
    inputs=("feed_log",),
)
def _(spark, sf):
    return X.retry_files(derived(spark, sf, "feed_log"))


@query(
    "f09_needs_run",
    """SELECT substr(f.file_name, 10, 6) AS batch_id, MAX(CASE WHEN l.status IS NULL OR l.status = 'FAILED' THEN 1 ELSE 0 END) = 1 AS needs_run
       FROM feed_files f LEFT JOIN feed_log l ON f.file_name = l.file_name GROUP BY 1""",
    inputs=("feed_files", "feed_log"),
)
def _(spark, sf):
    batch = F.substring("file_name", 10, 6).alias("batch_id")
    files = derived(spark, sf, "feed_files").select(batch, "file_name")
    log = derived(spark, sf, "feed_log").select(batch, "file_name", F.lit("landing").alias("step"), "status")
    return X.needs_run(files, log, "landing")


@query(
    "f10_file_batch_order",
    """SELECT file_name, dense_rank() OVER (ORDER BY substr(file_name, 10, 8)) AS batch_order FROM feed_files""",
    inputs=("feed_files",),
)
def _(spark, sf):
    return X.file_batch_order(derived(spark, sf, "feed_files"), "feed_x_n_YYYYMMDD.csv")


@query(
    "f10_file_month_order",
    """WITH m AS (SELECT DISTINCT concat('feed_M', substr(file_name, 14, 2), 'Y', substr(file_name, 12, 2), '.csv') AS file_name,
                         substr(file_name, 10, 6) AS k FROM feed_files)
       SELECT file_name, dense_rank() OVER (ORDER BY k) AS batch_order FROM m""",
    inputs=("feed_files",),
)
def _(spark, sf):
    month, year = F.substring("file_name", 14, 2), F.substring("file_name", 12, 2)
    named = derived(spark, sf, "feed_files").select(F.concat(F.lit("feed_M"), month, F.lit("Y"), year, F.lit(".csv")).alias("file_name"))
    return X.file_batch_order(named.distinct(), "feed_MmmYyy.csv")


@query(
    "f11_assign_ids",
    """SELECT file_name, dense_rank() OVER (ORDER BY substr(file_name, 10, 8)) + 500 AS batch_id,
              row_number() OVER (ORDER BY substr(file_name, 10, 8), file_name) + 9000 AS file_id FROM feed_files""",
    inputs=("feed_files",),
)
def _(spark, sf):
    ordered = X.file_batch_order(derived(spark, sf, "feed_files"), "feed_x_n_YYYYMMDD.csv")
    return X.assign_ids(ordered, 500, 9000).select("file_name", "batch_id", "file_id")


_CONTROL = "platform, source_system, database_name, object_name, query_text, load_type, active_flag"


@query(
    "f12_unprocessed_sources",
    f"""SELECT {_CONTROL} FROM control c WHERE lower(load_type) <> 'full' OR NOT EXISTS (
          SELECT 1 FROM control_log l WHERE l.status = 'SUCCEEDED' AND l.source_system = c.source_system
          AND l.database_name = c.database_name AND l.object_name = c.object_name AND l.query_text IS NOT DISTINCT FROM c.query_text)""",
    inputs=("control", "control_log"),
)
def _(spark, sf):
    return X.unprocessed_sources(derived(spark, sf, "control"), derived(spark, sf, "control_log"))


@query(
    "f13_select_sources",
    f"""SELECT {_CONTROL} FROM control WHERE active_flag = 'Y' AND source_system IN ('Sys1', 'Sys4', 'Sys9', 'Sys11') AND database_name = 'sales'""",
    inputs=("control",),
)
def _(spark, sf):
    return X.select_sources(derived(spark, sf, "control"), ["SYS1", "sys4", "sYs9", "Sys11"], "sales")


@query(
    "f14_batch_counts",
    "SELECT strftime(o_orderdate, '%Y-%m') AS batch, o_orderstatus AS file, COUNT(*) AS record_count FROM orders GROUP BY 1, 2",
)
def _(spark, sf):
    o = table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("batch"), F.col("o_orderstatus").alias("file"))
    return X.batch_counts(o, "batch", "file")


@query(
    "f15_current_status",
    """SELECT file_name, status, logged_at FROM (SELECT file_name, status, logged_at,
         row_number() OVER (PARTITION BY file_name ORDER BY logged_at DESC) AS r FROM file_events) x WHERE r = 1""",
    inputs=("file_events",),
)
def _(spark, sf):
    path = scratch_path(spark, "audit")
    events = derived(spark, sf, "file_events").withColumn("message", F.lit('said "no"'))
    for status in ("FAILED", "SUCCEEDED"):
        X.log_status(spark, path, events.filter(F.col("status") == status))
    return X.current_status(spark.read.parquet(path), ["file_name"])


@query(
    "s09_tag_lineage",
    """SELECT o_orderkey, file_name, CAST(7 AS BIGINT) AS batch_id, file_id FROM (
         SELECT logged_at AS o_orderkey, file_name, dense_rank() OVER (ORDER BY file_name) AS file_id FROM file_events) x""",
    inputs=("file_events",),
)
def _(spark, sf):
    rows = derived(spark, sf, "file_events").select(F.col("logged_at").alias("o_orderkey"), "file_name")
    ids = number_rows(derived(spark, sf, "feed_files"), ["file_name"], "file_id")
    return X.tag_lineage(rows, 7, ids)


# --- hierarchy ----------------------------------------------------------------------------------

MAX_LEVELS = 30
HIERARCHY_SQL = f"""
  edge AS (SELECT DISTINCT e.src, e.dst FROM staff_edges e JOIN staff v ON v.id = e.dst),
  walk(id, depth) AS (SELECT CAST(0 AS BIGINT), 0 UNION
       SELECT e.dst, w.depth + 1 FROM walk w JOIN edge e ON e.src = w.id WHERE w.depth < {MAX_LEVELS}),
  level AS (SELECT id, MIN(depth) AS dist FROM walk GROUP BY id),
  chosen AS (SELECT c.id, MIN(CAST(p.id AS VARCHAR)) AS parent FROM level c JOIN edge e ON e.dst = c.id
             JOIN level p ON p.id = e.src AND p.dist = c.dist - 1 GROUP BY c.id),
  path(id, up) AS (SELECT CAST(0 AS BIGINT), '0' UNION ALL
       SELECT c.id, concat(p.up, '>', CAST(c.id AS VARCHAR)) FROM path p JOIN chosen c ON c.parent = CAST(p.id AS VARCHAR))"""
_STAFF = ("staff", "staff_edges")


def _expanded(spark, sf):
    return H.hierarchy(derived(spark, sf, "staff"), derived(spark, sf, "staff_edges"), "id", 0)


def _distance():
    return F.when(F.col("dist") != float("inf"), F.col("dist").cast("bigint")).cast("string").alias("dist")


@query(
    "h01_hierarchy",
    f"""WITH RECURSIVE {HIERARCHY_SQL}
        SELECT v.id, v.node, CAST(l.dist AS VARCHAR) AS dist, COALESCE(p.up, '') AS path
        FROM staff v LEFT JOIN level l ON l.id = v.id LEFT JOIN path p ON p.id = v.id""",
    inputs=_STAFF, recursive=True,
)
def _(spark, sf):
    return _expanded(spark, sf).select("id", "node", _distance(), F.array_join("path", ">").alias("path"))


@query(
    "h02_hierarchy_output",
    f"""WITH RECURSIVE {HIERARCHY_SQL}
        SELECT DISTINCT v.node, v.segment, CAST(l.dist AS VARCHAR) AS dist,
               COALESCE(array_to_string(list_reverse(string_split(p.up, '>')), '>'), '') AS path
        FROM staff v LEFT JOIN level l ON l.id = v.id LEFT JOIN path p ON p.id = v.id""",
    inputs=_STAFF, recursive=True,
)
def _(spark, sf):
    shaped = H.shape_hierarchy(_expanded(spark, sf), "node", "segment")
    return shaped.select("node", "segment", _distance(), F.array_join("path", ">").alias("path"))


@query(
    "e03_unreachable",
    f"WITH RECURSIVE {HIERARCHY_SQL} SELECT id, node FROM staff WHERE id NOT IN (SELECT id FROM level)",
    inputs=_STAFF, recursive=True,
)
def _(spark, sf):
    return H.unreachable(_expanded(spark, sf)).select("id", "node")


CHAIN_SQL = f"""{HIERARCHY_SQL},
  above AS (SELECT CAST(dst AS VARCHAR) AS child, MIN(CAST(src AS VARCHAR)) AS manager FROM staff_edges GROUP BY dst),
  climb(node, cur, chain, state) AS (
    SELECT node, node, CAST([] AS VARCHAR[]), 'open' FROM staff WHERE id NOT IN (SELECT id FROM level)
    UNION ALL
    SELECT c.node, a.manager, CASE WHEN a.manager IS NULL THEN c.chain ELSE list_append(c.chain, a.manager) END,
           CASE WHEN a.manager IS NULL THEN 'no_manager'
                WHEN a.manager = c.cur OR list_contains(c.chain, a.manager) OR a.manager = c.node THEN 'cycle' ELSE 'open' END
    FROM climb c LEFT JOIN above a ON a.child = c.cur WHERE c.state = 'open')"""


def _repaired(spark, sf):
    pairs = derived(spark, sf, "staff_edges").select(
        F.col("src").cast("string").alias("currentnode"), F.col("dst").cast("string").alias("childnode")
    )
    return H.repair_chains(H.unreachable(_expanded(spark, sf)), pairs)


@query(
    "h04_repair_chains",
    f"WITH RECURSIVE {CHAIN_SQL} SELECT node, array_to_string(chain, '>') AS new_path FROM climb WHERE state <> 'open'",
    inputs=_STAFF, recursive=True,
)
def _(spark, sf):
    return _repaired(spark, sf).select("node", F.array_join("newPath", ">").alias("new_path"))


@query(
    "h05_chain_status",
    f"WITH RECURSIVE {CHAIN_SQL} SELECT state AS status, COUNT(*) AS n FROM climb WHERE state <> 'open' GROUP BY 1",
    inputs=_STAFF, recursive=True,
)
def _(spark, sf):
    return H.chain_status(_repaired(spark, sf))


# --- dimensions ---------------------------------------------------------------------------------


@query(
    "d01_scd1_stitch",
    """WITH n AS (SELECT c_custkey, c_name, MAX(c_acctbal) AS c_acctbal, c_mktsegment FROM customer_batch GROUP BY 1, 2, 4)
       SELECT c_custkey, c_name, round(c_acctbal, 2) AS c_acctbal, c_mktsegment, CAST(2 AS BIGINT) AS batch_id FROM n
       UNION ALL SELECT c_custkey, c_name, round(c_acctbal, 2), c_mktsegment, 2 FROM customer_history
                 WHERE c_custkey NOT IN (SELECT c_custkey FROM n)""",
    inputs=("customer_batch", "customer_history"),
)
def _(spark, sf):
    new, old = derived(spark, sf, "customer_batch"), derived(spark, sf, "customer_history")
    stitched = D.stitch_scd1(new, old, ["c_custkey"], 2, latest_by="c_acctbal")
    return stitched.withColumn("c_acctbal", F.round("c_acctbal", 2))


@query(
    "d01_latest_successful_batch",
    """SELECT CAST(MAX(o_orderkey) AS BIGINT) AS batch_id FROM orders WHERE o_totalprice >= 50000""",
)
def _(spark, sf):
    log = derived(spark, sf, "file_events").select(F.col("logged_at").alias("batch_id"), "status")
    return D.latest_successful_batch(log)


@query(
    "d02_scd2_defaults",
    "SELECT p_partkey, CAST(19000101 AS BIGINT) AS start_dt_wid, CAST(29991231 AS BIGINT) AS end_dt_wid FROM part",
)
def _(spark, sf):
    done = D.add_scd2_defaults(table(spark, sf, "part").select("p_partkey"))
    return P.cast_columns(done, ["start_dt_wid", "end_dt_wid"], "bigint")


CLEANSE = {
    "dim-part": [
        lambda df: P.recode(df, "p_type", "p_size", {5: "odd size", 15: "odd size", 25: "odd size"}),
        lambda df: P.add_columns(df, {"active_flag": (None, "string")}),
    ],
    "dim-other": [lambda df: df.drop("p_size")],
}


@query(
    "d03_cleanse",
    """SELECT p_partkey, CASE WHEN p_size IN (5, 15, 25) THEN 'odd size' ELSE p_type END AS p_type, p_size,
              p_name AS source_name, CAST(NULL AS VARCHAR) AS active_flag FROM part""",
)
def _(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_type", "p_size", F.col("p_name").alias("file_name"))
    canonical = lambda df: P.canonical_column(df, "source_name", "file_name", "file_id")
    return D.cleanse(part, "dim-part", CLEANSE, always=[canonical])


# --- data quality -------------------------------------------------------------------------------

STANDARD_RULES = [
    {"column_name": "name_raw", "function_name": "trim", "function_params": None},
    {"column_name": "name_raw", "function_name": "blank_conversion", "function_params": None},
    {"column_name": "addr_raw", "function_name": "zip_extractor", "function_params": None},
    {"column_name": "seg_raw", "function_name": "type_conversion", "function_params": "{'type':'Lower'}"},
]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
DQ_RULES = [
    {"rule_id": "r1", "column": "name_raw", "check": "not_null", "severity": "critical"},
    {"rule_id": "r2", "column": "bal_raw", "check": "range", "min": -500, "max": 9000, "severity": "warning"},
    {"rule_id": "r3", "column": "joined_raw", "check": "date_format", "format": "yyyyMMdd", "severity": "critical"},
    {"rule_id": "r4", "column": "seg_raw", "check": "in_list", "values": SEGMENTS, "severity": "critical"},
    {"rule_id": "r5", "column": "addr_raw", "check": "regex", "pattern": "ZIP [0-9]{5}-", "severity": "warning"},
    {"rule_id": "r6", "column": "name_raw", "check": "length", "min": 1, "max": 21, "severity": "warning"},
    {"rule_id": "r7", "column": "joined_raw", "check": "unique", "severity": "info"},
    {"rule_id": "r8", "column": "c_custkey", "check": "referential", "reference": "orders", "reference_column": "o_custkey", "severity": "info"},
    {"rule_id": "r9", "check": "sql_predicate", "predicate": "bal_raw <> 'n/a' OR seg_raw <> 'MACHINERY'", "severity": "warning"},
]
DQ_SQL = """failed AS (
  SELECT c_custkey AS row_id, 'r1' AS rule_id, 'name_raw' AS column_name, name_raw AS value, 'critical' AS severity FROM customer_feed WHERE name_raw IS NULL
  UNION ALL SELECT c_custkey, 'r2', 'bal_raw', bal_raw, 'warning' FROM customer_feed
            WHERE COALESCE(TRY_CAST(bal_raw AS DOUBLE) NOT BETWEEN -500 AND 9000, bal_raw IS NOT NULL)
  UNION ALL SELECT c_custkey, 'r3', 'joined_raw', joined_raw, 'critical' FROM customer_feed WHERE TRY_STRPTIME(joined_raw, '%Y%m%d') IS NULL
  UNION ALL SELECT c_custkey, 'r4', 'seg_raw', seg_raw, 'critical' FROM customer_feed
            WHERE seg_raw NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')
  UNION ALL SELECT c_custkey, 'r5', 'addr_raw', addr_raw, 'warning' FROM customer_feed WHERE NOT regexp_matches(addr_raw, 'ZIP [0-9]{5}-')
  UNION ALL SELECT c_custkey, 'r6', 'name_raw', name_raw, 'warning' FROM customer_feed WHERE length(name_raw) NOT BETWEEN 1 AND 21
  UNION ALL SELECT c_custkey, 'r7', 'joined_raw', joined_raw, 'info' FROM customer_feed
            WHERE joined_raw IN (SELECT joined_raw FROM customer_feed GROUP BY 1 HAVING COUNT(*) > 1)
  UNION ALL SELECT c_custkey, 'r8', 'c_custkey', CAST(c_custkey AS VARCHAR), 'info' FROM customer_feed
            WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
  UNION ALL SELECT c_custkey, 'r9', '', NULL, 'warning' FROM customer_feed WHERE bal_raw = 'n/a' AND seg_raw = 'MACHINERY')"""
_FEED = ("customer_feed",)


def _errors(spark, sf):
    feed = derived(spark, sf, "customer_feed").withColumn("row_id", F.col("c_custkey"))
    return feed, M.dq_check(feed, DQ_RULES, references={"orders": table(spark, sf, "orders")})


@query("m01_dq_check", f"WITH {DQ_SQL} SELECT row_id, rule_id, column_name, value, severity FROM failed", inputs=_FEED)
def _(spark, sf):
    return _errors(spark, sf)[1]


@query(
    "m02_dq_summary",
    f"""WITH {DQ_SQL}, rules(rule_id, severity) AS (VALUES ('r1','critical'),('r2','warning'),('r3','critical'),('r4','critical'),
          ('r5','warning'),('r6','warning'),('r7','info'),('r8','info'),('r9','warning')),
        total AS (SELECT COUNT(*) AS n FROM customer_feed)
        SELECT r.rule_id, r.severity, (SELECT n FROM total) AS checked, COUNT(f.rule_id) AS failed,
               round(((SELECT n FROM total) - COUNT(f.rule_id)) / CAST((SELECT n FROM total) AS DOUBLE), 6) AS pass_rate
        FROM rules r LEFT JOIN failed f ON f.rule_id = r.rule_id GROUP BY 1, 2""",
    inputs=_FEED,
)
def _(spark, sf):
    feed, errors = _errors(spark, sf)
    return M.dq_summary(errors, feed.agg(F.count(F.lit(1))).scalar(), DQ_RULES)


@query(
    "m03_dq_filter",
    f"WITH {DQ_SQL} SELECT c_custkey, name_raw, seg_raw FROM customer_feed WHERE c_custkey NOT IN (SELECT row_id FROM failed WHERE severity = 'critical')",
    inputs=_FEED,
)
def _(spark, sf):
    feed, errors = _errors(spark, sf)
    return M.dq_filter(feed, errors).select("c_custkey", "name_raw", "seg_raw")


@query(
    "m03_passing_rows",
    f"WITH {DQ_SQL} SELECT c_custkey, name_raw, seg_raw FROM customer_feed WHERE c_custkey NOT IN (SELECT row_id FROM failed WHERE severity = 'critical' OR rule_id = 'r8')",
    inputs=_FEED,
)
def _(spark, sf):
    feed = derived(spark, sf, "customer_feed").withColumn("row_id", F.col("c_custkey"))
    rules = [dict(r, severity="critical") if r["rule_id"] == "r8" else r for r in DQ_RULES]
    kept = M.passing_rows(feed, rules, references={"orders": table(spark, sf, "orders")})
    return kept.select("c_custkey", "name_raw", "seg_raw")


@query(
    "m03_exact_copies",
    f"""WITH {DQ_SQL}, kept AS (SELECT c_custkey, name_raw FROM customer_feed WHERE c_custkey NOT IN (SELECT row_id FROM failed WHERE severity = 'critical'))
        SELECT c_custkey, name_raw, COUNT(*) AS copies, COUNT(*) AS row_ids FROM (SELECT * FROM kept UNION ALL SELECT * FROM kept) x GROUP BY 1, 2""",
    inputs=_FEED,
)
def _(spark, sf):
    # Every row is there twice. Rows are told apart by their place in the stored feed, which is read as it is.
    feed, path = derived(spark, sf, "customer_feed"), scratch_path(spark, "doubled")
    feed.unionByName(feed).write.parquet(path)
    rows = read_parquet(spark, path, row_id="row_id")
    errors = M.dq_check(rows, DQ_RULES, references={"orders": table(spark, sf, "orders")})
    kept = M.dq_filter(rows, errors)
    return kept.groupBy("c_custkey", "name_raw").agg(F.count(F.lit(1)).alias("copies"), F.count_distinct("row_id").alias("row_ids"))


COMPARE_SQL = """
  t0 AS (SELECT o_orderkey, o_custkey, round(o_totalprice, 2) AS o_totalprice, o_orderstatus,
         row_number() OVER (PARTITION BY o_orderkey ORDER BY o_custkey, o_totalprice, o_orderstatus NULLS FIRST) AS r,
         COUNT(*) OVER (PARTITION BY o_orderkey) AS n FROM order_target),
  s0 AS (SELECT o_orderkey, o_custkey, round(o_totalprice, 2) AS o_totalprice, o_orderstatus, 1 AS n FROM orders),
  c AS (SELECT COALESCE(s0.o_orderkey, t.o_orderkey) AS o_orderkey, COALESCE(s0.n, 0) AS n_s, COALESCE(t.n, 0) AS n_t,
        s0.o_totalprice AS sp, t.o_totalprice AS tp, s0.o_orderstatus AS ss, t.o_orderstatus AS ts, s0.o_custkey AS sc, t.o_custkey AS tc
        FROM s0 FULL OUTER JOIN (SELECT * FROM t0 WHERE r = 1) t ON s0.o_orderkey = t.o_orderkey)"""
_TARGET = ("order_target",)


def _reconciled(spark, sf):
    columns = ["o_custkey", "o_totalprice", "o_orderstatus"]
    pick = lambda df: df.select("o_orderkey", "o_custkey", F.round("o_totalprice", 2).alias("o_totalprice"), "o_orderstatus")
    return M.reconcile(pick(table(spark, sf, "orders")), pick(derived(spark, sf, "order_target")), ["o_orderkey"], columns)


@query("m04_reconcile_missing", f"WITH {COMPARE_SQL} SELECT o_orderkey FROM c WHERE n_t = 0", inputs=_TARGET)
def _(spark, sf):
    return _reconciled(spark, sf).missing


@query(
    "m04_reconcile_duplicates",
    f"WITH {COMPARE_SQL} SELECT o_orderkey, CAST(n_s AS BIGINT) AS n_s, CAST(n_t AS BIGINT) AS n_t FROM c WHERE n_s > 1 OR n_t > 1",
    inputs=_TARGET,
)
def _(spark, sf):
    return _reconciled(spark, sf).duplicates


@query(
    "m04_reconcile_mismatches",
    f"""WITH {COMPARE_SQL}, both_sides AS (SELECT * FROM c WHERE n_s > 0 AND n_t > 0)
        SELECT o_orderkey, 'o_totalprice' AS column_name, CAST(CAST(sp AS DECIMAL(18,2)) AS VARCHAR) AS source_value,
               CAST(CAST(tp AS DECIMAL(18,2)) AS VARCHAR) AS target_value FROM both_sides WHERE sp IS DISTINCT FROM tp
        UNION ALL SELECT o_orderkey, 'o_orderstatus', ss, ts FROM both_sides WHERE ss IS DISTINCT FROM ts
        UNION ALL SELECT o_orderkey, 'o_custkey', CAST(sc AS VARCHAR), CAST(tc AS VARCHAR) FROM both_sides WHERE sc IS DISTINCT FROM tc""",
    inputs=_TARGET,
)
def _(spark, sf):
    found = _reconciled(spark, sf).mismatches
    money = F.col("column_name") == "o_totalprice"
    plain = lambda c: F.when(money, F.expr(f"try_cast({c} AS decimal(18,2))").cast("string")).otherwise(F.col(c)).alias(c)
    return found.select("o_orderkey", "column_name", plain("source_value"), plain("target_value"))


_SUMMARY = """CAST(COUNT(*) FILTER (n_t = 0) AS BIGINT) AS missing_records, CAST(COUNT(*) FILTER (n_s = 0) AS BIGINT) AS extra_records,
  CAST(COUNT(*) FILTER (n_s > 1 OR n_t > 1) AS BIGINT) AS dup_records,
  CAST(COUNT(*) FILTER (n_s > 0 AND n_t > 0 AND (sp IS DISTINCT FROM tp OR ss IS DISTINCT FROM ts OR sc IS DISTINCT FROM tc)) AS BIGINT) AS mismatched_records,
  CAST(COUNT(*) FILTER (n_t = 0 OR n_s = 0 OR n_t > 1 OR sp IS DISTINCT FROM tp OR ss IS DISTINCT FROM ts OR sc IS DISTINCT FROM tc) AS BIGINT) AS total_records_with_errors"""


@query("m04_reconcile_summary", f"WITH {COMPARE_SQL} SELECT {_SUMMARY} FROM c", inputs=_TARGET)
def _(spark, sf):
    return _reconciled(spark, sf).summary


@query(
    "m05_reconcile_all",
    f"""WITH {COMPARE_SQL}, lines AS (SELECT l_orderkey, COUNT(*) AS n FROM lineitem GROUP BY 1)
        SELECT 'orders' AS subject, 'DONE' AS status, {_SUMMARY} FROM c
        UNION ALL SELECT 'customers', 'DONE', 0, 0, 0, 0, 0
        UNION ALL SELECT 'staff', 'DONE', COUNT(*) FILTER (src IS NULL), 0, 0, 0, COUNT(*) FILTER (src IS NULL) FROM (
            SELECT v.id, e.src FROM (SELECT c_custkey AS id FROM customer) v LEFT JOIN (
              SELECT o_custkey AS dst, MIN(o_orderkey) AS src FROM orders GROUP BY 1) e ON e.dst = v.id) x
        UNION ALL SELECT 'order lines', 'DONE', COUNT(*) FILTER (l.n IS NULL), COUNT(*) FILTER (o.o_orderkey IS NULL), COUNT(*) FILTER (l.n > 1), 0,
            COUNT(*) FILTER (l.n IS NULL OR o.o_orderkey IS NULL OR l.n > 1) FROM orders o FULL OUTER JOIN lines l ON l.l_orderkey = o.o_orderkey
        UNION ALL SELECT 'broken', 'FAILED', NULL, NULL, NULL, NULL, NULL""",
    inputs=_TARGET,
)
def _(spark, sf):
    c, o = table(spark, sf, "customer"), table(spark, sf, "orders")
    with_orders = c.join(o.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi")
    keys = o.select("o_orderkey", F.lit(1).alias("one"))
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.lit(1).alias("one"))
    subjects = {
        "orders": lambda: _reconciled(spark, sf),
        "customers": lambda: M.reconcile(c, c, ["c_custkey"], ["c_name", "c_acctbal"]),
        "staff": lambda: M.reconcile(c, with_orders, ["c_custkey"], ["c_name"]),
        "order lines": lambda: M.reconcile(keys, lines, ["o_orderkey"], ["one"]),
        "broken": lambda: M.reconcile(c, o, ["no_such_key"], ["c_name"]),
    }
    return M.reconcile_all(spark, subjects).drop("message")


# --- the whole way from a raw feed to the published dimension -----------------------------------

CLEAN_SCHEMA = [
    {"column_name": "c_custkey", "column_data_type": "bigint", "column_sequence_number": 1},
    {"column_name": "name_raw", "column_data_type": "string", "column_sequence_number": 2},
    {"column_name": "bal_raw", "column_data_type": "decimal(12,2)", "column_sequence_number": 3},
    {"column_name": "joined_raw", "column_data_type": "date", "column_date_format": "yyyyMMdd", "column_sequence_number": 4},
    {"column_name": "addr_raw", "column_data_type": "string", "column_sequence_number": 5},
    {"column_name": "seg_raw", "column_data_type": "string", "column_sequence_number": 6},
]
FLOW_RULES = [
    {"rule_id": "name", "column": "name_raw", "check": "not_null", "severity": "critical"},
    {"rule_id": "joined", "column": "joined_raw", "check": "date_format", "format": "yyyyMMdd", "severity": "critical"},
    {"rule_id": "segment", "column": "seg_raw", "check": "in_list", "values": [s.lower() for s in SEGMENTS], "severity": "critical"},
    {"rule_id": "balance", "column": "bal_raw", "check": "range", "min": -500, "max": None, "severity": "warning"},
]


@query(
    "raw_to_published",
    """WITH std AS (SELECT c_custkey, NULLIF(trim(name_raw), '') AS name, bal_raw, joined_raw,
              NULLIF(regexp_extract(addr_raw, '([0-9]{5})[0-9]*', 1), '') AS zip, lower(seg_raw) AS segment FROM customer_feed),
         clean AS (SELECT * FROM std WHERE name IS NOT NULL AND TRY_STRPTIME(joined_raw, '%Y%m%d') IS NOT NULL
                   AND segment IN ('automobile', 'building', 'furniture', 'household', 'machinery')),
         published AS (
           SELECT c_custkey, name, CAST(TRY_CAST(bal_raw AS DECIMAL(12,2)) AS DOUBLE) AS balance,
                  strftime(TRY_STRPTIME(joined_raw, '%Y%m%d'), '%Y-%m-%d') AS joined, zip, segment FROM clean
           UNION ALL SELECT c_custkey, c_name, c_acctbal, NULL, NULL, lower(c_mktsegment) FROM customer_history
                     WHERE c_custkey NOT IN (SELECT c_custkey FROM clean))
       SELECT c_custkey, name, balance, joined, zip, segment, CAST(2 AS BIGINT) AS batch_id FROM published""",
    inputs=("customer_feed", "customer_history"),
)
def _(spark, sf):
    feed = derived(spark, sf, "customer_feed").withColumn("row_id", F.col("c_custkey"))
    standard = standardize(feed, STANDARD_RULES)
    clean = M.passing_rows(standard, FLOW_RULES)
    typed = P.apply_schema(clean, CLEAN_SCHEMA).select(
        "c_custkey", F.col("name_raw").alias("name"), F.col("bal_raw").cast("double").alias("balance"),
        F.col("joined_raw").cast("string").alias("joined"), F.col("addr_raw").alias("zip"), F.col("seg_raw").alias("segment"),
    )
    history = derived(spark, sf, "customer_history").select(
        "c_custkey", F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.lit(None).cast("string").alias("joined"),
        F.lit(None).cast("string").alias("zip"), F.lower("c_mktsegment").alias("segment"),
    )
    return D.stitch_scd1(typed, history, ["c_custkey"], 2)
