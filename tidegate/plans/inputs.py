"""Tables and derived inputs of the queries.

A derived input is SQL text over whole base tables that both engines understand. Defects (wrong
values, missing keys, cycles) hang on attributes of the data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Input:
    sql: str
    uses: tuple[str, ...]


INPUTS: dict[str, Input] = {
    # Fan-out 4 tree with self-managers, managers among the own reports, missing and second managers.
    "staff_edges": Input(
        """SELECT CAST(CASE WHEN c_nationkey = 3 THEN c_custkey
                            WHEN c_nationkey = 7 THEN 4 * c_custkey + 1
                            ELSE floor((c_custkey - 1) / 4.0) END AS BIGINT) AS src, c_custkey AS dst
           FROM {customer} WHERE c_custkey > 0 AND c_nationkey <> 11
           UNION ALL
           SELECT CAST(floor((c_custkey - 1) / 7.0) AS BIGINT) AS src, c_custkey AS dst
           FROM {customer} WHERE c_custkey > 0 AND c_mktsegment = 'BUILDING' AND c_nationkey NOT IN (3, 7, 11)""",
        ("customer",),
    ),
    "staff": Input(
        "SELECT c_custkey AS id, CAST(c_custkey AS VARCHAR(20)) AS node, c_mktsegment AS segment FROM {customer}",
        ("customer",),
    ),
    # One file per order status, priority and day.
    "feed_files": Input(
        """SELECT DISTINCT concat('feed_', lower(o_orderstatus), '_', substr(o_orderpriority, 1, 1), '_',
                  replace(substr(CAST(o_orderdate AS VARCHAR(30)), 1, 10), '-', ''), '.csv') AS file_name
           FROM {orders}""",
        ("orders",),
    ),
    # Files dated before 2000 were handled; the status follows the priority digit.
    "feed_log": Input(
        """SELECT file_name, CASE substr(file_name, 8, 1) WHEN '1' THEN 'FAILED' WHEN '3' THEN 'SKIPPED'
                                  WHEN '4' THEN 'IN PROGRESS' ELSE 'SUCCEEDED' END AS status
           FROM {feed_files} WHERE substr(file_name, 10, 4) < '2000'""",
        ("feed_files",),
    ),
    # Each order leaves one log row on its file, at the order's number; later rows win.
    "file_events": Input(
        """SELECT concat('feed_', lower(o_orderstatus), '_', substr(o_orderpriority, 1, 1), '_',
                  replace(substr(CAST(o_orderdate AS VARCHAR(30)), 1, 10), '-', ''), '.csv') AS file_name,
                  o_orderkey AS logged_at, o_custkey,
                  CASE WHEN o_totalprice < 50000 THEN 'FAILED' ELSE 'SUCCEEDED' END AS status
           FROM {orders}""",
        ("orders",),
    ),
    # Dirty all-string feed.
    "customer_feed": Input(
        """SELECT c_custkey,
             CASE WHEN c_nationkey = 19 THEN '   ' WHEN c_nationkey = 23 THEN NULL
                  ELSE concat('  ', c_name, ' ') END AS name_raw,
             CASE WHEN c_nationkey = 5 THEN 'n/a' ELSE CAST(c_acctbal AS VARCHAR(30)) END AS bal_raw,
             CASE WHEN c_nationkey = 11 THEN '20240230'
                  ELSE concat('2024', lpad(CAST(1 + c_custkey % 12 AS VARCHAR(10)), 2, '0'),
                              lpad(CAST(1 + c_custkey % 28 AS VARCHAR(10)), 2, '0')) END AS joined_raw,
             concat('Unit ', CAST(c_nationkey AS VARCHAR(10)), ' ZIP ', CAST(10000 + c_custkey AS VARCHAR(20)),
                    '-', lpad(CAST(c_nationkey AS VARCHAR(10)), 4, '0')) AS addr_raw,
             CASE WHEN c_nationkey = 7 THEN 'unknown' ELSE c_mktsegment END AS seg_raw
           FROM {customer}""",
        ("customer",),
    ),
    # Loaded copy of orders with missing, changed, emptied, doubled and surplus records.
    "order_target": Input(
        """SELECT o_orderkey, o_custkey,
                  CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'O' THEN o_totalprice + 1
                       ELSE o_totalprice END AS o_totalprice,
                  CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F' THEN NULL
                       ELSE o_orderstatus END AS o_orderstatus
           FROM {orders} WHERE NOT (o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')
           UNION ALL SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM {orders}
                     WHERE o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P'
           UNION ALL SELECT -1 - o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM {orders}
                     WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'F'""",
        ("orders",),
    ),
    "calendar": Input(
        """SELECT DISTINCT CAST(replace(substr(CAST(o_orderdate AS VARCHAR(30)), 1, 10), '-', '') AS INT) AS cal_date_key,
                  CAST(o_orderdate AS DATE) AS calendar_dt FROM {orders}""",
        ("orders",),
    ),
    # Regions 1 and 2 were renumbered, region 0 was not (0), the others are absent from the map.
    "key_map": Input(
        """SELECT n_nationkey AS orig_key, CASE WHEN n_regionkey = 0 THEN 0 ELSE n_nationkey + 100 END AS updated_key
           FROM {nation} WHERE n_regionkey <= 2""",
        ("nation",),
    ),
    "order_fact": Input(
        """SELECT o_orderkey, o_orderdate, c_nationkey AS nation_key, c_nationkey AS prior_nation_key,
                  CAST(replace(substr(CAST(o_orderdate AS VARCHAR(30)), 1, 10), '-', '') AS INT) AS date_key
           FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
        ("orders", "customer"),
    ),
    "customer_history": Input(
        """SELECT c_custkey, c_name, c_acctbal, c_mktsegment, CAST(1 AS BIGINT) AS batch_id
           FROM {customer} WHERE c_nationkey < 18""",
        ("customer",),
    ),
    "customer_batch": Input(
        """SELECT c_custkey, c_name, c_acctbal + 100 AS c_acctbal, c_mktsegment, CAST(2 AS BIGINT) AS batch_id
           FROM {customer} WHERE c_nationkey >= 12
           UNION ALL
           SELECT c_custkey, c_name, c_acctbal + 50 AS c_acctbal, c_mktsegment, CAST(2 AS BIGINT) AS batch_id
           FROM {customer} WHERE c_nationkey = 20""",
        ("customer",),
    ),
    # A standardisation rule per part, some of them unusable.
    "part_rules": Input(
        """SELECT p_partkey AS rule_no, p_name AS column_name,
             CASE p_type WHEN 'ECONOMY' THEN 'type_conversion' WHEN 'LARGE' THEN 'left_padding'
                         WHEN 'MEDIUM' THEN 'trim' WHEN 'PROMO' THEN 'date_conversion'
                         WHEN 'SMALL' THEN 'sub_string' ELSE 'no_such_rule' END AS function_name,
             CASE WHEN p_size < 5 THEN NULL
                  WHEN p_size < 10 THEN concat('{{"padding_value":00', CAST(p_size AS VARCHAR(10)), ',"length":11}}')
                  WHEN p_type = 'ECONOMY' AND p_size < 25 THEN '{{''type'':''Upper''}}'
                  WHEN p_type = 'ECONOMY' THEN '{{"type":"upper"}}'
                  WHEN p_type = 'LARGE' THEN '{{"padding_value":"0","length":11}}'
                  WHEN p_type = 'PROMO' AND p_size < 30 THEN '{{"src":"yyyyMMdd"}}'
                  WHEN p_type = 'PROMO' THEN '{{"src":"yyyyMMdd","tgt":"yyyy-MM-dd"}}'
                  ELSE '{{"start_index":4,"length":5}}' END AS function_params
           FROM {part}""",
        ("part",),
    ),
    # Control table of an extraction: one source object per supplier.
    "control": Input(
        """SELECT 'lake' AS platform, concat('Sys', CAST(s_nationkey AS VARCHAR(10))) AS source_system,
                  CASE WHEN s_nationkey < 12 THEN 'sales' ELSE 'stock' END AS database_name, s_name AS object_name,
                  CASE WHEN s_acctbal > 8000 THEN 'select 1' ELSE NULL END AS query_text,
                  CASE WHEN s_acctbal < 1000 THEN 'incremental' WHEN s_acctbal < 2000 THEN 'delta' ELSE 'Full' END AS load_type,
                  CASE WHEN s_nationkey = 4 THEN 'N' ELSE 'Y' END AS active_flag
           FROM {supplier}""",
        ("supplier",),
    ),
    "control_log": Input(
        """SELECT 'lake' AS platform, concat('Sys', CAST(s_nationkey AS VARCHAR(10))) AS source_system,
                  CASE WHEN s_nationkey < 12 THEN 'sales' ELSE 'stock' END AS database_name, s_name AS object_name,
                  CASE WHEN s_acctbal > 8000 THEN 'select 1' ELSE NULL END AS query_text,
                  'full' AS load_type, CASE WHEN s_nationkey = 9 THEN 'FAILED' ELSE 'SUCCEEDED' END AS status
           FROM {supplier} WHERE s_nationkey <= 16""",
        ("supplier",),
    ),
    # Header line of a file per part, and the configured header per type.
    "part_headers": Input(
        """SELECT CAST(p_partkey AS VARCHAR(20)) AS file_name, p_type AS dataset_id,
                  concat('KEY,NAME,', CASE WHEN p_size <= 5 THEN 'COST' ELSE 'PRICE' END,
                         CASE WHEN p_size >= 45 THEN ',EXTRA' ELSE '' END) AS header
           FROM {part}""",
        ("part",),
    ),
    "part_columns": Input(
        """SELECT dataset_id, column_sequence_number, source_column_name,
                  CASE dataset_id WHEN 'ECONOMY' THEN 'V' WHEN 'PROMO' THEN 'N' ELSE 'Y' END AS header_flag
           FROM (SELECT DISTINCT p_type AS dataset_id, 1 AS column_sequence_number, 'KEY' AS source_column_name FROM {part}
                 UNION ALL SELECT DISTINCT p_type, 2, 'NAME' FROM {part}
                 UNION ALL SELECT DISTINCT p_type, 3, 'PRICE' FROM {part}) c""",
        ("part",),
    ),
    # Columns seen in the incoming files of a brand, and those configured for it.
    "seen_columns": Input(
        """SELECT p_brand AS dataset_id, concat(p_name, ' (', lower(p_type), ')') AS column_name FROM {part}""",
        ("part",),
    ),
    "known_columns": Input(
        """SELECT p_brand AS dataset_id, replace(concat(p_name, '_', lower(p_type)), ' ', '_') AS column_name,
                  MIN(p_partkey) AS column_id, MIN(p_size) AS column_sequence_number, 'string' AS column_data_type
           FROM {part} WHERE p_size < 40 GROUP BY 1, 2""",
        ("part",),
    ),
    # Delimited lines; some hold a surplus field, all a quoted separator.
    "order_lines": Input(
        """SELECT o_orderkey, concat(CAST(o_orderkey AS VARCHAR(20)), '|', CAST(o_custkey AS VARCHAR(20)), '|"',
                  o_orderpriority, '|', o_orderstatus, '"', CASE WHEN o_orderstatus = 'P' THEN '|extra' ELSE '' END) AS value
           FROM {orders}""",
        ("orders",),
    ),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def derived(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A derived input as a DataFrame."""
    item = INPUTS[name]
    frames = {u: derived(spark, folder, u) if u in INPUTS else table(spark, folder, u) for u in item.uses}
    return spark.sql(item.sql, **frames)
