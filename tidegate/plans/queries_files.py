"""Queries over sources, sinks, catalog, jobs and streams.

Each one writes whole tables below the shared scratch folder and reads them back, so that the
result can be compared with the tables themselves.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.operators import columns as P
from tidegate.operators.dimensions import upsert_rows
from tidegate.operators.feeds import observe_count
from tidegate.plans.inputs import derived, table
from tidegate.plans.jobs import run_jobs
from tidegate.plans.queries_feeds import HIERARCHY_SQL, MAX_LEVELS
from tidegate.plans.registry import query
from tidegate.session import scratch_path
from tidegate.sources import catalog as C
from tidegate.sources import readers as R
from tidegate.sources import records as Q
from tidegate.sources import writers as K
from tidegate.streaming import bucketed_table as B
from tidegate.streaming import incremental as I

ORDER_TEXT_SQL = """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
    strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders"""
ORDER_META = [
    {"column_name": "o_orderpriority", "column_data_type": "string", "column_sequence_number": 5},
    {"column_name": "o_orderkey", "column_data_type": "bigint", "column_sequence_number": 1},
    {"column_name": "o_custkey", "column_data_type": "bigint", "column_sequence_number": 2},
    {"column_name": "o_orderstatus", "column_data_type": "string", "column_sequence_number": 3},
    {"column_name": "o_orderdate", "column_data_type": "date", "column_sequence_number": 4},
]


def _order_text(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), "o_orderstatus",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderpriority",
    )


# --- sources ------------------------------------------------------------------------------------


@query("s01_delimited_read", ORDER_TEXT_SQL)
def _(spark, sf):
    path = scratch_path(spark, "orders_psv")
    _order_text(spark, sf).write.options(sep="|", header=True).csv(path)
    return R.read_delimited(spark, path, ORDER_META, sep="|", header=True)


@query("s01_multiline_read", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5(text) AS text, lang FROM documents")
def _(spark, sf):
    path = scratch_path(spark, "documents_csv")
    K.write_csv(table(spark, sf, "documents").select("doc_id", "text", "lang"), path)
    read = R.read_delimited(spark, path, ["doc_id", "text", "lang"], multiline=True)
    return read.withColumn("text", F.md5("text"))


@query("s02_quoted_csv", """SELECT CAST(c_custkey AS VARCHAR) AS k, concat('say "', c_name, '", then ""', c_mktsegment) AS remark FROM customer""")
def _(spark, sf):
    path = scratch_path(spark, "remarks")
    remark = F.concat(F.lit('say "'), F.col("c_name"), F.lit('", then ""'), F.col("c_mktsegment"))
    K.write_csv(table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), remark.alias("remark")), path)
    return R.read_quoted_csv(spark, path)


@query("s03_parquet_batch", "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_linenumber = 3")
def _(spark, sf):
    path = scratch_path(spark, "lineitem")
    table(spark, sf, "lineitem").write.partitionBy("l_linenumber").parquet(path)
    return R.read_parquet(spark, path, batch=3, batch_column="l_linenumber").select("l_orderkey", "l_partkey", "l_quantity")


@query("s04_json_read", "SELECT event_id, user_id, event_type, value, CAST(props AS VARCHAR) AS props FROM events")
def _(spark, sf):
    path = scratch_path(spark, "events_json")
    table(spark, sf, "events").drop("ts").write.json(path)
    return R.read_json(spark, path, "event_id bigint, user_id bigint, event_type string, value double, props string")


@query("s05_text_read", "SELECT unnest(string_split(text, chr(10))) AS value FROM conversations")
def _(spark, sf):
    path = scratch_path(spark, "lines")
    table(spark, sf, "conversations").select("text").write.text(path)
    return R.read_text(spark, path)


def _register(spark, name, df, step, meta, by=()):
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return C.publish_table(df, name, scratch_path(spark, name), step, meta, by)


@query("s07_catalog_read", ORDER_TEXT_SQL)
def _(spark, sf):
    _register(spark, "tidegate_s07", _order_text(spark, sf), "landing", ORDER_META)
    return R.read_table(spark, spark.catalog.currentDatabase(), "tidegate_s07")


@query(
    "s08_literal_frame",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS meaning
       FROM orders WHERE o_orderstatus IN ('F', 'O')""",
)
def _(spark, sf):
    names = R.literal_frame(spark, [("F", "finished"), ("O", "open")], ["o_orderstatus", "meaning"])
    return table(spark, sf, "orders").join(F.broadcast(names), "o_orderstatus").select("o_orderkey", "meaning")


@query("f14_observed_count", "SELECT COUNT(*) AS stored, COUNT(*) AS observed FROM lineitem")
def _(spark, sf):
    path = scratch_path(spark, "counted")
    counted, seen = observe_count(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"))
    counted.write.parquet(path)
    stored = R.count_rows(spark.read.parquet(path))
    return stored.select(F.col("row_count").alias("stored"), F.lit(seen.get["record_count"]).cast("bigint").alias("observed"))


@query("s10_count_rows", "SELECT COUNT(*) AS row_count FROM lineitem")
def _(spark, sf):
    return R.count_rows(table(spark, sf, "lineitem"))


@query("s10_preview", "SELECT event_id, event_type FROM events ORDER BY event_id LIMIT 20")
def _(spark, sf):
    return R.preview(table(spark, sf, "events").select("event_id", "event_type"), 20, ["event_id"])


# --- sinks --------------------------------------------------------------------------------------


@query(
    "k01_write_batch",
    """SELECT o_orderkey, CAST(1 AS BIGINT) AS batch_id, o_orderstatus AS file_id FROM orders
       UNION ALL SELECT o_orderkey, 2, o_orderpriority FROM orders WHERE o_totalprice > 100000""",
)
def _(spark, sf):
    root = scratch_path(spark, "staging")
    o = table(spark, sf, "orders")
    first = o.select("o_orderkey", F.col("o_orderstatus").alias("file_id"))
    second = o.select("o_orderkey", "o_totalprice", F.col("o_orderpriority").alias("file_id"))
    K.write_batch(first, root, 1)
    K.write_batch(second.drop("o_totalprice"), root, 2)
    K.write_batch(second.filter("o_totalprice > 100000").drop("o_totalprice"), root, 2)
    return R.read_parquet(spark, root).select("o_orderkey", F.col("batch_id").cast("bigint"), F.col("file_id").cast("string"))


@query("k02_publish_empty", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_totalprice > 0")
def _(spark, sf):
    root = scratch_path(spark, "publish")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    K.publish(o.filter("o_totalprice <= 0").drop("o_totalprice"), f"{root}/none", True, ["o_orderstatus"])
    K.publish(o.filter("o_totalprice > 0").drop("o_totalprice"), f"{root}/some", True, ["o_orderstatus"])
    return spark.read.parquet(f"{root}/none").unionByName(spark.read.parquet(f"{root}/some"))


@query("k02_republish_empty", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'P'")
def _(spark, sf):
    # An empty batch takes the place of an earlier one, with the flag and without it.
    root = scratch_path(spark, "publish")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    kept, gone = o.filter("o_orderstatus = 'P'"), o.filter("o_orderstatus = 'none'")
    for name, rows, flag in (("a", kept, True), ("b", o, True), ("b", gone, True), ("c", o, False), ("c", gone, False)):
        K.publish(rows, f"{root}/batch={name}", flag, ())
    return spark.read.parquet(root).drop("batch")


@query("k03_write_csv", "SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderpriority, o_orderstatus FROM orders")
def _(spark, sf):
    path = scratch_path(spark, "orders_csv")
    K.write_csv(table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus"), path, ["o_orderstatus"])
    return spark.read.schema("o_orderkey bigint, o_orderpriority string, o_orderstatus string").option("header", True).csv(path)


@query(
    "k04_export_text",
    """SELECT CAST(c_custkey AS VARCHAR) AS "C_CUSTKEY", NULLIF(name_raw, '') AS "NAME_RAW", seg_raw AS "SEG_RAW" FROM customer_feed""",
    inputs=("customer_feed",),
)
def _(spark, sf):
    feed = derived(spark, sf, "customer_feed").select("c_custkey", "name_raw", "seg_raw", F.lit("x").alias("batch_date"))
    path = K.export_text(feed, scratch_path(spark, "export"), "customers", "2024-01-31")
    return R.read_delimited(spark, path, ["C_CUSTKEY", "NAME_RAW", "SEG_RAW"], sep="||")


@query(
    "k05_export_single_csv",
    """SELECT o_orderstatus AS "STATUS", o_orderpriority AS "PRIORITY", CAST(COUNT(*) AS VARCHAR) AS "N" FROM orders GROUP BY 1, 2""",
)
def _(spark, sf):
    report = table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    path = K.export_text(report.agg(F.count(F.lit(1)).alias("n")), scratch_path(spark, "report"), "report", "20240131120000",
                         sep=",", one_file=True, ext="csv")
    return R.read_quoted_csv(spark, path)


@query(
    "k08_json_ignoring_case",
    "SELECT o_orderkey AS batch_id, o_orderstatus AS status, CAST(NULL AS VARCHAR) AS end_time FROM orders",
)
def _(spark, sf):
    path = scratch_path(spark, "log_json")
    table(spark, sf, "orders").select(F.col("o_orderkey").alias("Batch_ID"), F.col("o_orderstatus").alias("STATUS")).write.json(path)
    wanted = T.StructType.fromDDL("batch_id bigint, status string, end_time string")
    return R.read_json_ignoring_case(spark, path, wanted)


@query(
    "k08_case_by_record",
    "SELECT o_orderkey AS batch_id, CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE o_orderstatus END AS status, o_totalprice AS amount FROM orders",
)
def _(spark, sf):
    # The case of the names differs from record to record; every third one lacks a field.
    path, nth = scratch_path(spark, "mixed_json"), F.col("o_orderkey") % 3
    spelt = lambda n, key, status: F.when(nth == n, F.to_json(F.struct(F.col("o_orderkey").alias(key), *status, F.col("o_totalprice").alias("Amount" if n else "amount"))))
    status = lambda name: [F.col("o_orderstatus").alias(name)]
    lines = F.coalesce(spelt(0, "BATCH_ID", status("Status")), spelt(1, "batch_id", status("STATUS")), spelt(2, "Batch_Id", []))
    table(spark, sf, "orders").select(lines.alias("value")).write.text(path)
    return R.read_json_ignoring_case(spark, path, T.StructType.fromDDL("batch_id bigint, status string, amount double"))


@query("k09_to_landing", ORDER_TEXT_SQL)
def _(spark, sf):
    raw, landed = scratch_path(spark, "raw"), scratch_path(spark, "landing")
    _order_text(spark, sf).write.options(sep="~", header=True).csv(raw)
    spec = {"format": "csv", "columns": ORDER_META, "sep": "~", "header": True, "row_id": "row_id"}
    return K.to_landing(spark, raw, landed, spec).drop("row_id")


@query(
    "k09_multiline",
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority || chr(10) || '"' || o_custkey || '", ' || chr(10) || chr(10) || o_orderstatus AS note, o_orderstatus FROM orders""",
)
def _(spark, sf):
    raw, landed = scratch_path(spark, "raw"), scratch_path(spark, "landing")
    o = table(spark, sf, "orders")
    note = F.concat("o_orderpriority", F.lit('\n"'), "o_custkey", F.lit('", \n\n'), "o_orderstatus").alias("note")
    o.select("o_orderkey", note, "o_orderstatus").write.options(header=True, escape='"').csv(raw)
    spec = {"format": "csv", "columns": ["o_orderkey", "note", "o_orderstatus"], "header": True, "multiline": True}
    return K.to_landing(spark, raw, landed, spec)


@query(
    "k10_publish_table",
    """SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority, o_orderstatus AS pt_o_orderstatus FROM orders""",
)
def _(spark, sf):
    made = _register(spark, "tidegate_k10", _order_text(spark, sf), "staging", ORDER_META, ["o_orderstatus"])
    return made.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


@query(
    "k10_republish",
    """SELECT o_orderkey, o_orderpriority, o_orderstatus AS pt_o_orderstatus FROM orders WHERE o_orderstatus <> 'F'""",
)
def _(spark, sf):
    # Again to another path, with fewer columns, and without a partition.
    text, name = _order_text(spark, sf), "tidegate_k10_again"
    _register(spark, name, text, "staging", ORDER_META, ["o_orderstatus"])
    fewer = [m for m in ORDER_META if m["column_name"] in ("o_orderkey", "o_orderpriority", "o_orderstatus")]
    path = scratch_path(spark, name)
    C.publish_table(text, name, path, "staging", fewer, ["o_orderstatus"])
    return C.publish_table(text.filter("o_orderstatus <> 'F'"), name, path, "staging", fewer, ["o_orderstatus"])


@query(
    "k11_refresh_partitions",
    """SELECT o_orderkey, o_orderstatus AS pt_o_orderstatus FROM orders UNION ALL SELECT o_orderkey, 'late' FROM orders WHERE o_orderstatus = 'P'""",
)
def _(spark, sf):
    text = _order_text(spark, sf)
    path = scratch_path(spark, "tidegate_k11")
    spark.sql("DROP TABLE IF EXISTS tidegate_k11")
    C.publish_table(text, "tidegate_k11", path, "landing", ORDER_META, ["o_orderstatus"])
    text.filter("o_orderstatus = 'P'").drop("o_orderstatus").write.parquet(f"{path}/pt_o_orderstatus=late")
    C.refresh_partitions(spark, "tidegate_k11", {"pt_o_orderstatus": "late"})
    return spark.table("tidegate_k11").select(F.col("o_orderkey").cast("bigint"), "pt_o_orderstatus")


@query(
    "k12_views",
    """SELECT 'full' AS kind, pt_batch_id, COUNT(*) AS n FROM (SELECT strftime(o_orderdate, '%Y') AS pt_batch_id FROM orders) a GROUP BY 2
       UNION ALL SELECT 'latest', pt_batch_id, COUNT(*) FROM (SELECT strftime(o_orderdate, '%Y') AS pt_batch_id FROM orders) a
       WHERE pt_batch_id = (SELECT MAX(strftime(o_orderdate, '%Y')) FROM orders) GROUP BY 2""",
)
def _(spark, sf):
    by_year = _order_text(spark, sf).withColumn("batch_id", F.substring("o_orderdate", 1, 4))
    meta = [*ORDER_META, {"column_name": "batch_id", "column_data_type": "string", "column_sequence_number": 9}]
    _register(spark, "tidegate_k12", by_year, "publish_table", meta, ["batch_id"])
    newest = spark.table("tidegate_k12").agg(F.max("pt_batch_id").alias("b")).first()["b"]
    C.publish_views(spark, "tidegate_k12", newest)
    count = lambda kind: spark.table(f"tidegate_k12_{kind}").groupBy("pt_batch_id").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit(kind))
    return count("full").unionByName(count("latest"))


@query(
    "k13_backup_tables",
    """SELECT place, name, n FROM (SELECT unnest(['latest', 'archive/2024-01-31']) AS place) p,
         (SELECT 'customer' AS name, COUNT(*) AS n FROM customer UNION ALL SELECT 'orders', COUNT(*) FROM orders) t""",
)
def _(spark, sf):
    tables = {n: f"{sf}/{n}.parquet" for n in ("customer", "orders", "lineitem", "supplier")}
    place = scratch_path(spark, "backup")
    done = K.backup_tables(spark, tables, place, "2024-01-31", exclude=["LINE", "supp"])
    result = None
    for where in ("latest", "archive/2024-01-31"):
        for name in done:
            part = R.count_rows(spark.read.parquet(f"{place}/{where}/{name}")).select(
                F.lit(where).alias("place"), F.lit(name).alias("name"), F.col("row_count").alias("n")
            )
            result = part if result is None else result.union(part)
    return result


@query(
    "k13_second_backup",
    """SELECT 'latest' AS place, c_custkey AS key, c_acctbal + 1 AS value FROM customer
       UNION ALL SELECT 'archive/d1', c_custkey, c_acctbal FROM customer
       UNION ALL SELECT 'archive/d2', c_custkey, c_acctbal + 1 FROM customer
       UNION ALL SELECT 'archive/d1', s_suppkey, s_acctbal FROM supplier""",
)
def _(spark, sf):
    # The second backup holds changed customers and leaves the suppliers out: they are gone from the latest one only.
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("value"))
    supplier = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("value"))
    place, source = scratch_path(spark, "backup"), scratch_path(spark, "tables")
    paths = {n: f"{source}/{n}" for n in ("customer", "supplier")}
    customer.write.parquet(paths["customer"])
    supplier.write.parquet(paths["supplier"])
    K.backup_tables(spark, paths, place, "d1")
    customer.withColumn("value", F.col("value") + 1).write.mode("overwrite").parquet(paths["customer"])
    K.backup_tables(spark, paths, place, "d2", exclude=["SUPP"])
    held = [(f"{where}/{name}", where) for where in ("latest", "archive/d1", "archive/d2") for name in paths if (where, name) in (("archive/d1", "supplier"),) or name == "customer"]
    parts = [spark.read.parquet(f"{place}/{path}").select(F.lit(where).alias("place"), "key", "value") for path, where in held]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


@query("k14_backup_before_change", "SELECT p_partkey, p_name, p_size FROM part")
def _(spark, sf):
    path = scratch_path(spark, "part")
    table(spark, sf, "part").write.parquet(path)
    copy = K.backup_before_change(spark, path)
    table(spark, sf, "part").withColumn("p_size", F.lit(0)).write.mode("overwrite").parquet(path)
    return spark.read.parquet(copy).select("p_partkey", "p_name", "p_size")


@query("k15_archive_batch", "SELECT o_orderpriority AS file, COUNT(*) AS record_count, CAST(77 AS BIGINT) AS batch FROM orders GROUP BY 1")
def _(spark, sf):
    raw = table(spark, sf, "orders").withColumn("file_id", F.col("o_orderpriority"))
    return K.archive_batch(raw, scratch_path(spark, "archive"), "2024-01-31", 77).withColumn("batch", F.col("batch").cast("bigint"))


@query("k15_archive_contents", "SELECT o_orderkey, o_totalprice, o_orderpriority AS file, 2 AS batch FROM orders WHERE o_orderstatus <> 'F' UNION ALL SELECT o_orderkey, o_totalprice, 'late', 1 FROM orders WHERE o_orderstatus = 'F'")
def _(spark, sf):
    # Two batches of a day, the second one archived twice: each is there once, with all columns.
    root = scratch_path(spark, "archive")
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", F.col("o_orderpriority").alias("file_id"))
    K.archive_batch(o.filter("o_orderstatus = 'F'").withColumn("file_id", F.lit("late")), root, "2024-01-31", 1)
    for part in (o, o.filter("o_orderstatus <> 'F'")):
        K.archive_batch(part, root, "2024-01-31", 2)
    return spark.read.parquet(f"{root}/2024-01-31").select("o_orderkey", "o_totalprice", "file", "batch")


@query("f05_header_repair", ORDER_TEXT_SQL)
def _(spark, sf):
    folder = scratch_path(spark, "mixed")
    text = _order_text(spark, sf)
    for status, header in (("F", True), ("O", False), ("P", True)):
        text.filter(F.col("o_orderstatus") == status).write.mode("append").options(header=header).csv(folder)
    return R.read_with_header_repair(spark, folder, text.columns)


@query(
    "f05_two_feeds",
    """SELECT 'orders' AS feed, CAST(o_orderkey AS VARCHAR) AS a, o_orderstatus AS b, o_orderpriority AS c FROM orders
       UNION ALL SELECT 'parts', CAST(p_partkey AS VARCHAR), p_brand, p_type FROM part""",
)
def _(spark, sf):
    # Two feeds in one folder, with headers of their own; one half of each has no header line.
    folder = scratch_path(spark, "feeds")
    order_names, part_names = ["ORDER", "DATE", "STATUS", "PRIORITY", "CUSTOMER"], ["PART", "BRAND", "TYPE", "SIZE", "PRICE"]
    orders = table(spark, sf, "orders").select(*[F.col(c).cast("string").alias(n) for c, n in zip(("o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "o_custkey"), order_names)])
    parts = table(spark, sf, "part").select(*[F.col(c).cast("string").alias(n) for c, n in zip(("p_partkey", "p_brand", "p_type", "p_size", "p_retailprice"), part_names)])
    for feed, rows, half in (("orders", orders, F.col("STATUS") == "F"), ("parts", parts, F.col("SIZE").cast("int") > 25)):
        for day, header, part in (("20240131", True, rows.filter(half)), ("20240201", False, rows.filter(~half))):
            K.write_csv(part, f"{folder}/{feed}_{day}.csv", one_file=True, header=header)
    config = [{"feed": "orders", "header_available_flag": "N", "headers": order_names}, {"feed": "parts", "header_available_flag": "N", "headers": part_names}]
    read = [Q.read_feed(spark, folder, feed) for feed in config]
    shaped = [
        read[0].select(F.lit("orders").alias("feed"), F.col("ORDER").alias("a"), F.col("STATUS").alias("b"), F.col("PRIORITY").alias("c")),
        read[1].select(F.lit("parts").alias("feed"), F.col("PART").alias("a"), F.col("BRAND").alias("b"), F.col("TYPE").alias("c")),
    ]
    return shaped[0].unionByName(shaped[1])


@query(
    "p10_widened_read",
    """SELECT o_orderkey, o_orderstatus, CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders WHERE o_orderdate < '1998-01-01'
       UNION ALL SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderdate >= '1998-01-01'""",
)
def _(spark, sf):
    o = table(spark, sf, "orders")
    old = o.filter("o_orderdate < '1998-01-01'").select("o_orderkey", "o_orderstatus")
    new = o.filter("o_orderdate >= '1998-01-01'").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return P.read_widened([old, new], ["o_orderkey", "o_orderstatus", "o_orderpriority"])


# --- configured jobs ----------------------------------------------------------------------------


@query(
    "m06_configured_jobs",
    f"""WITH RECURSIVE {HIERARCHY_SQL}
        SELECT v.segment, COUNT(*) AS people, COUNT(l.dist) AS reached, COALESCE(SUM(l.dist), 0)::BIGINT AS levels
        FROM staff v LEFT JOIN level l ON l.id = v.id GROUP BY 1""",
    inputs=("staff", "staff_edges"), recursive=True,
)
def _(spark, sf):
    place = scratch_path(spark, "jobs")
    derived(spark, sf, "staff").write.parquet(f"{place}/staff")
    derived(spark, sf, "staff_edges").write.parquet(f"{place}/edges")
    config = {
        "jobs": [
            {
                "name": "expand",
                "sources": [{"object": f"{place}/staff", "view": "staff_v"}, {"object": f"{place}/edges", "view": "edges_v"}],
                "transforms": [
                    {
                        "graph": {
                            "name": "reporting", "vertices": "staff_v", "edges": "edges_v",
                            "startswith": {"column": "id", "value": 0, "max_iter": MAX_LEVELS, "checkpoint_interval": 2},
                            "output": {"view": "levels_v", "columns": ["id", "node", "segment"]},
                        }
                    }
                ],
                "targets": {"view": "levels_v", "target_location": f"{place}/levels"},
            },
            {
                "name": "summarise",
                "sources": [{"object": f"{place}/levels/batch_date=20240131", "view": "stored_levels"}],
                "transforms": [
                    {"view": "flat", "sql": "SELECT segment, CASE WHEN dist < double('inf') THEN cast(dist AS bigint) END AS d FROM stored_levels"},
                    {"view": "by_segment", "sql": "SELECT segment, count(*) AS people, count(d) AS reached, coalesce(sum(d), 0) AS levels FROM flat GROUP BY segment"},
                ],
                "targets": {"view": "by_segment", "target_location": f"{place}/segments"},
            },
        ]
    }
    written = run_jobs(spark, config, "20240131", f"{place}/audit")
    return spark.read.parquet(written[-1])


# --- incremental and streaming ------------------------------------------------------------------


@query("i01_full_load", "SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal > 0")
def _(spark, sf):
    path = scratch_path(spark, "supplier")
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    I.full_load(s.drop("s_acctbal"), path)
    return I.full_load(s.filter("s_acctbal > 0").drop("s_acctbal"), path)


@query("i02_incremental_load", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, 1 = 1 AS at_top FROM orders")
def _(spark, sf):
    path, log = scratch_path(spark, "orders_inc"), scratch_path(spark, "load_log")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    # Some rows arrive late, with a date that was loaded already as the highest one.
    late = (F.col("o_orderstatus") == "F") & (F.col("o_orderdate") == F.lit("1997-12-31").cast("timestamp"))
    early = o.filter("o_orderdate < '1998-01-01'")
    for source in (early.filter(~late), early, o, o):
        mark = I.incremental_load(source, "o_orderdate", path, log, ["o_orderkey"])
    read = I.loaded_rows(spark, path, log, o.schema)
    return read.select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
        (F.lit(mark) == read.agg(F.max("o_orderdate")).scalar()).alias("at_top"),
    )


@query(
    "i02_repeat_first",
    """SELECT o_orderkey, o_totalprice, CASE WHEN o_orderdate < '1998-01-01' THEN 1 ELSE 2 END AS run, (SELECT COUNT(*) FROM orders WHERE o_orderdate < '1998-01-01') AS first_rows,
         (SELECT COUNT(*) FROM orders) AS logged_rows FROM orders""",
)
def _(spark, sf):
    # The first load dies between its rows and its log row and is repeated; the second leaves half its rows behind before it is repeated.
    path, log = scratch_path(spark, "orders_inc"), scratch_path(spark, "load_log")
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    first = o.filter("o_orderdate < '1998-01-01'")
    first.write.parquet(f"{path}/run=1")
    I.incremental_load(first, "o_orderdate", path, log)
    o.filter("o_orderdate > '1998-03-01'").write.parquet(f"{path}/run=2")
    for _ in range(2):
        I.incremental_load(o, "o_orderdate", path, log)
    runs = I.committed_runs(spark, path, log)
    first_rows, logged_rows = runs.agg(F.max(F.when(F.col("run") == 1, F.col("rows"))), F.sum("rows")).first()
    edge = F.lit("1998-01-01").cast("timestamp")
    rows = I.loaded_rows(spark, path, log, o.schema).withColumn("run", F.when(F.col("o_orderdate") < edge, 1).otherwise(2))
    return rows.select("o_orderkey", "o_totalprice", "run", F.lit(first_rows).alias("first_rows"), F.lit(logged_rows).alias("logged_rows"))


@query("i03_bookmarked_files", "SELECT event_id, event_type FROM events")
def _(spark, sf):
    source, target, bookmark = (scratch_path(spark, n) for n in ("in", "out", "bookmark"))
    e = table(spark, sf, "events").select("event_id", "event_type")
    kinds = F.col("event_type").isin("click", "view")
    for arrived in (e.filter(kinds), e.filter(~kinds)):
        arrived.write.mode("append").parquet(source)
        for _ in range(2):  # the second run finds nothing new
            I.ingest_new_files(I.file_stream(spark, source, e.schema).drop("file_name"), target, bookmark)
    return I.ingested(spark, target, e.schema)


@query("i03_restart", "SELECT event_id, event_type FROM events")
def _(spark, sf):
    # Load, let files arrive, lose the bookmark and start over: every row is there once.
    source, target, first, second = (scratch_path(spark, n) for n in ("in", "out", "bookmark", "bookmark"))
    e = table(spark, sf, "events").select("event_id", "event_type")
    for part, bookmark in ((F.col("event_type") == "click", first), (F.col("event_type") != "click", second)):
        e.filter(part).write.mode("append").parquet(source)
        I.ingest_new_files(I.file_stream(spark, source, e.schema).drop("file_name"), target, bookmark)
    return I.ingested(spark, target, e.schema)


@query("i03_reset_to_batch", "SELECT event_id, event_type FROM events")
def _(spark, sf):
    # Three batches, back to the state after the first, and on again: later files are read once more.
    source, target, bookmark = (scratch_path(spark, n) for n in ("in", "out", "bookmark"))
    e = table(spark, sf, "events").select("event_id", "event_type")
    stream = lambda: I.file_stream(spark, source, e.schema).drop("file_name")
    for part in (F.col("event_type") == "click", F.col("event_type") == "view", ~F.col("event_type").isin("click", "view")):
        e.filter(part).write.mode("append").parquet(source)
        I.ingest_new_files(stream(), target, bookmark)
    I.reset_to_batch(spark, target, bookmark, 0)
    I.ingest_new_files(stream(), target, bookmark)
    return I.ingested(spark, target, e.schema)


@query(
    "i03_reset_to_run",
    "SELECT file_name FROM feed_files WHERE file_name NOT IN (SELECT file_name FROM feed_log WHERE substr(file_name, 10, 4) <= '1997')",
    inputs=("feed_files", "feed_log"),
)
def _(spark, sf):
    bookmark = derived(spark, sf, "feed_log").select(F.substring("file_name", 10, 4).cast("int").alias("run_id"), "file_name")
    return I.unread_files(derived(spark, sf, "feed_files"), I.reset_bookmark(bookmark, 1997))


LANDING_RULES = [
    {"column_name": "name_raw", "function_name": "trim", "function_params": None},
    {"column_name": "name_raw", "function_name": "blank_conversion", "function_params": None},
]
LANDING_CHECKS = [{"rule_id": "name", "column": "name_raw", "check": "not_null", "severity": "critical"}]


@query(
    "i04_stream_landing",
    """SELECT c_custkey, NULLIF(trim(name_raw), '') AS name_raw, seg_raw, 'kept' AS fate FROM customer_feed WHERE NULLIF(trim(name_raw), '') IS NOT NULL
       UNION ALL SELECT c_custkey, NULL, NULL, 'rejected' FROM customer_feed WHERE NULLIF(trim(name_raw), '') IS NULL""",
    inputs=("customer_feed",),
)
def _(spark, sf):
    source, target, errors, bookmark = (scratch_path(spark, n) for n in ("in", "landed", "errors", "bookmark"))
    feed = derived(spark, sf, "customer_feed").select("c_custkey", "name_raw", "seg_raw")
    for part in (feed.filter("seg_raw < 'G'"), feed.filter("seg_raw >= 'G'")):
        part.write.mode("append").parquet(source)
        stream = I.file_stream(spark, source, feed.schema)
        I.stream_landing(stream, target, errors, bookmark, LANDING_RULES, LANDING_CHECKS, ["c_custkey"])
    ids = P.add_row_id(feed.select("c_custkey"), "row_id", ["c_custkey"])
    rejected = spark.read.parquet(errors).join(ids, "row_id").select(
        "c_custkey", F.lit(None).cast("string").alias("name_raw"), F.lit(None).cast("string").alias("seg_raw"), F.lit("rejected").alias("fate")
    )
    kept = spark.read.parquet(target).select("c_custkey", "name_raw", "seg_raw", F.lit("kept").alias("fate"))
    return kept.unionByName(rejected)


@query(
    "i04_audit",
    """WITH parts AS (SELECT *, CASE WHEN seg_raw < 'G' THEN 0 ELSE 1 END AS batch_id, NULLIF(trim(name_raw), '') AS clean FROM customer_feed WHERE seg_raw IS NOT NULL)
       SELECT 'row' AS kind, c_custkey, batch_id::BIGINT AS batch_id, (batch_id + 1)::BIGINT AS file_id, NULL::BIGINT AS rows_read, NULL::BIGINT AS rows_rejected
       FROM parts WHERE clean IS NOT NULL
       UNION ALL SELECT 'file', NULL, batch_id, batch_id + 1, COUNT(*), NULL FROM parts GROUP BY batch_id
       UNION ALL SELECT 'batch SUCCEEDED', NULL, batch_id, batch_id + 1, COUNT(*), COUNT(*) FILTER (clean IS NULL) FROM parts GROUP BY batch_id""",
    inputs=("customer_feed",),
)
def _(spark, sf):
    source, target, errors, bookmark = (scratch_path(spark, n) for n in ("in", "landed", "errors", "bookmark"))
    feed = derived(spark, sf, "customer_feed").select("c_custkey", "name_raw", "seg_raw").filter("seg_raw is not null")
    audit = f"{bookmark}_audit"
    for part in (feed.filter("seg_raw < 'G'"), feed.filter("seg_raw >= 'G'")):
        part.coalesce(1).write.mode("append").parquet(source)  # one file for each batch, so that its id is known
        stream = I.file_stream(spark, source, feed.schema)
        I.stream_landing(stream, target, errors, bookmark, LANDING_RULES, LANDING_CHECKS, ["c_custkey"])
    columns = "c_custkey bigint, file_id bigint"
    rows = I.landed_rows(spark, target, audit, T.StructType.fromDDL(columns)).select(
        F.lit("row").alias("kind"), "c_custkey", "batch_id", "file_id", F.lit(None).cast("bigint").alias("rows_read"), F.lit(None).cast("bigint").alias("rows_rejected")
    )
    none = F.lit(None).cast("bigint")
    files = I.landing_files(spark, audit).select(F.lit("file").alias("kind"), none.alias("c_custkey"), "batch_id", "file_id", "rows_read", none.alias("rows_rejected"))
    batches = I.landing_audit(spark, audit).select(
        F.concat(F.lit("batch "), "status").alias("kind"), none.alias("c_custkey"), "batch_id", F.col("last_file_id").alias("file_id"), "rows_read", "rows_rejected"
    )
    return rows.unionByName(files).unionByName(batches)


@query(
    "i05_touched_buckets",
    """WITH placed AS (SELECT *, ('0x' || substr(md5('{"c_custkey":' || c_custkey || '}'), 1, 8))::BIGINT % 64 AS bucket FROM customer),
       touched AS (SELECT DISTINCT bucket FROM placed WHERE c_custkey <= 2)
       SELECT c_custkey, CASE WHEN c_custkey <= 2 THEN 0.0 ELSE c_acctbal END AS c_acctbal, bucket::INT AS bucket, bucket IN (FROM touched) AS rewritten, (SELECT COUNT(*) FROM touched) AS folders
       FROM placed""",
)
def _(spark, sf):
    # Two customers change: only their buckets are written again.
    target = scratch_path(spark, "versions")
    rows = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    changes = rows.filter("c_custkey <= 2").withColumn("c_acctbal", F.lit(0.0))
    merge = lambda new, held: upsert_rows(new, held, ["c_custkey"])
    old = B.rewrite_buckets(rows, target, ["c_custkey"], merge, 64)
    new = B.rewrite_buckets(changes, target, ["c_custkey"], merge)
    moved = [f for b, f in new.folders.items() if old.folders[b] != f]
    write = F.element_at(F.split("_metadata.file_path", "/"), -3)
    read = B.read_version(spark, target)
    return read.select(
        "c_custkey", "c_acctbal", B.bucket_of(["c_custkey"], new.buckets).alias("bucket"),
        (write == F.lit(moved[0].split("/")[1])).alias("rewritten"), F.lit(len(moved)).cast("bigint").alias("folders"),
    )


@query(
    "i05_stream_upsert",
    """WITH n AS (SELECT c_custkey, MAX(c_acctbal) AS c_acctbal FROM customer_batch GROUP BY 1)
       SELECT c_custkey, round(c_acctbal, 2) AS c_acctbal, CAST(1 AS BIGINT) AS batch_id FROM n
       UNION ALL SELECT c_custkey, round(c_acctbal, 2), 1 FROM customer_history WHERE c_custkey NOT IN (SELECT c_custkey FROM n)""",
    inputs=("customer_batch", "customer_history"),
)
def _(spark, sf):
    source, target, bookmark = (scratch_path(spark, n) for n in ("in", "versions", "bookmark"))
    for name in ("customer_history", "customer_batch"):
        rows = derived(spark, sf, name).select("c_custkey", "c_acctbal")
        rows.write.mode("append").parquet(source)
        stream = I.file_stream(spark, source, rows.schema).drop("file_name")
        I.stream_upsert(stream, target, bookmark, ["c_custkey"], latest_by="c_acctbal")
    return I.newest_version(spark, target).select("c_custkey", F.round("c_acctbal", 2).alias("c_acctbal"), "batch_id")


@query(
    "i05_restart",
    """WITH n AS (SELECT c_custkey, MAX(c_acctbal) AS c_acctbal FROM customer_batch GROUP BY 1)
       SELECT c_custkey, round(c_acctbal, 2) AS c_acctbal FROM n
       UNION ALL SELECT c_custkey, round(c_acctbal, 2) FROM customer_history WHERE c_custkey NOT IN (SELECT c_custkey FROM n)""",
    inputs=("customer_batch", "customer_history"),
)
def _(spark, sf):
    # The bookmark is lost between the two batches; the table that is there is upserted all the same.
    target = scratch_path(spark, "versions")
    for name in ("customer_history", "customer_batch"):
        source, bookmark = scratch_path(spark, "in"), scratch_path(spark, "bookmark")
        rows = derived(spark, sf, name).select("c_custkey", "c_acctbal")
        rows.write.parquet(source)
        stream = I.file_stream(spark, source, rows.schema).drop("file_name")
        I.stream_upsert(stream, target, bookmark, ["c_custkey"], latest_by="c_acctbal")
    return I.newest_version(spark, target).select("c_custkey", F.round("c_acctbal", 2).alias("c_acctbal"))
