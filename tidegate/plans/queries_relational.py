"""Queries over joins, aggregations, ordering and set operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.operators import ordering as W
from tidegate.operators import relational as R
from tidegate.plans.inputs import derived, table
from tidegate.plans.registry import query

# --- joins --------------------------------------------------------------------------------------


@query(
    "j01_join_first",
    """SELECT l_orderkey, o_orderkey, l_linenumber, l_partkey, l_suppkey, o_custkey
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 1000""",
)
def _(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return R.join_first(li, o, "l_orderkey", "o_orderkey", 1000, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


@query(
    "j02_lookup",
    """SELECT c_custkey, c_nationkey, CAST(updated_key AS VARCHAR) AS updated_key
       FROM customer LEFT JOIN key_map ON c_nationkey = orig_key""",
    inputs=("key_map",),
)
def _(spark, sf):
    found = R.lookup(table(spark, sf, "customer"), derived(spark, sf, "key_map"), "c_nationkey", "orig_key")
    return found.select("c_custkey", "c_nationkey", F.col("updated_key").cast("string"))


@query(
    "j03_calendar",
    """SELECT o_orderkey, date_key, strftime(calendar_dt, '%Y-%m-%d') AS calendar_dt
       FROM order_fact LEFT JOIN calendar ON date_key = cal_date_key""",
    inputs=("order_fact", "calendar"),
)
def _(spark, sf):
    dated = R.with_calendar(derived(spark, sf, "order_fact"), derived(spark, sf, "calendar"), "date_key")
    return dated.select("o_orderkey", "date_key", F.col("calendar_dt").cast("string"))


_REMAP_SQL = """SELECT o_orderkey,
    CAST(CASE WHEN calendar_dt BETWEEN DATE '1996-01-01' AND DATE '1998-12-31' {guard}
              THEN a.updated_key ELSE nation_key END AS VARCHAR) AS nation_key,
    CAST(CASE WHEN calendar_dt BETWEEN DATE '1997-06-01' AND DATE '1999-05-31' {guard}
              THEN a.updated_key ELSE prior_nation_key END AS VARCHAR) AS prior_nation_key
    FROM order_fact LEFT JOIN calendar ON date_key = cal_date_key LEFT JOIN key_map a ON nation_key = a.orig_key"""


def _remap(guarded, by_calendar):
    def run(spark, sf):
        fact, maps = derived(spark, sf, "order_fact"), derived(spark, sf, "key_map")
        done = R.remap_keys(
            fact,
            {"nation_key": "nation", "prior_nation_key": "prior"},
            {"nation": maps, "prior": maps},
            {"nation": ("1996-01-01", "1998-12-31"), "prior": ("1997-06-01", "1999-05-31")},
            "date_key" if by_calendar else "o_orderdate",
            guarded,
            derived(spark, sf, "calendar") if by_calendar else None,
        )
        return done.select("o_orderkey", F.col("nation_key").cast("string"), F.col("prior_nation_key").cast("string"))

    return run


_REMAP_INPUTS = ("order_fact", "calendar", "key_map")
query("j04_remap_guarded", _REMAP_SQL.format(guard="AND a.updated_key <> 0"), _REMAP_INPUTS)(_remap(True, True))
query("j04_remap_unguarded", _REMAP_SQL.format(guard=""), _REMAP_INPUTS)(_remap(False, False))


@query(
    "j05_missing",
    "SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
)
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return R.missing(o, table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"])


@query(
    "j06_present",
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
       WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def _(spark, sf):
    urgent = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("l_orderkey"))
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return R.present(li, urgent, ["l_orderkey"])


@query("j07_scalar_subquery", "SELECT o_orderkey, (SELECT MAX(o_orderkey) FROM orders) - o_orderkey AS behind FROM orders")
def _(spark, sf):
    o = table(spark, sf, "orders")
    top = o.agg(F.max("o_orderkey")).scalar()
    return o.select("o_orderkey", (top - F.col("o_orderkey")).alias("behind"))


@query(
    "j08_pairs_with_sum",
    """WITH v AS (SELECT CAST(round(value * 100) AS BIGINT) AS cents, COUNT(*) AS n FROM events GROUP BY 1)
       SELECT a.cents AS low, b.cents AS high,
              CAST(CASE WHEN a.cents = b.cents THEN a.n * (a.n - 1) / 2 ELSE a.n * b.n END AS BIGINT) AS row_pairs
       FROM v a JOIN v b ON a.cents + b.cents = 10000 AND a.cents <= b.cents
       WHERE a.cents < b.cents OR a.n > 1""",
)
def _(spark, sf):
    cents = table(spark, sf, "events").select(F.round(F.col("value") * 100).cast("bigint").alias("cents"))
    return R.pairs_with_sum(cents, "cents", 10000)


# --- aggregations -------------------------------------------------------------------------------


@query(
    "a01_group_summary",
    """SELECT CAST(year(o_orderdate) AS BIGINT) AS order_year, COUNT(o_orderkey) AS row_count, round(AVG(o_totalprice), 3) AS mean_value
       FROM orders GROUP BY 1""",
)
def _(spark, sf):
    o = table(spark, sf, "orders").withColumn("order_year", F.year("o_orderdate").cast("bigint"))
    return R.group_summary(o, "order_year", "o_orderkey", "o_totalprice").withColumn("mean_value", F.round("mean_value", 3))


@query(
    "a02_word_count",
    "SELECT word, COUNT(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) w GROUP BY word",
)
def _(spark, sf):
    return R.word_count(table(spark, sf, "documents"), "text")


@query(
    "a02_fields_between_bars",
    "SELECT word, COUNT(*) AS n FROM (SELECT unnest(string_split(concat(c_mktsegment, '||', c_nationkey, '||', c_name), '||')) AS word FROM customer) w GROUP BY word",
)
def _(spark, sf):
    line = F.concat_ws("||", "c_mktsegment", F.col("c_nationkey").cast("string"), "c_name")
    return R.word_count(table(spark, sf, "customer").select(line.alias("line")), "line", "||")


@query("a03_value_frequency", "SELECT user_id, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2")
def _(spark, sf):
    return R.value_frequency(table(spark, sf, "events"), "user_id", "event_type")


@query("a04_value_range", "SELECT MIN(c_acctbal) AS min_value, MAX(c_acctbal) AS max_value FROM customer")
def _(spark, sf):
    return R.value_range(table(spark, sf, "customer"), "c_acctbal")


@query("a05_count_and_top_key", "SELECT COUNT(*) AS row_count, CAST(MAX(l_orderkey) AS BIGINT) AS top_key FROM lineitem")
def _(spark, sf):
    text = table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("k"))
    return R.count_and_top_key(text, "k").withColumn("top_key", F.col("top_key").cast("bigint"))


@query("a06_distinct", "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def _(spark, sf):
    return table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag").distinct()


@query(
    "a07_lowest_message",
    """SELECT l_orderkey, l_extendedprice, l_partkey FROM (
         SELECT l_orderkey, l_extendedprice, l_partkey,
                row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice, l_partkey) AS r FROM lineitem) x WHERE r = 1""",
)
def _(spark, sf):
    return R.lowest_message(table(spark, sf, "lineitem"), "l_orderkey", "l_partkey", "l_extendedprice")


@query(
    "a08_duplicate_keys",
    "SELECT o_orderkey, COUNT(*) AS n_rows FROM order_target GROUP BY 1 HAVING COUNT(*) > 1",
    inputs=("order_target",),
)
def _(spark, sf):
    return R.duplicate_keys(derived(spark, sf, "order_target"), ["o_orderkey"])


@query(
    "a09_latest_per",
    """SELECT o_custkey, status, logged_at FROM (SELECT o_custkey, status, logged_at,
         row_number() OVER (PARTITION BY o_custkey ORDER BY logged_at DESC) AS r FROM file_events) x WHERE r = 1""",
    inputs=("file_events",),
)
def _(spark, sf):
    return R.latest_per(derived(spark, sf, "file_events"), ["o_custkey"], "status", "logged_at")


# --- windows and sequences ----------------------------------------------------------------------


@query(
    "w01_append_with_keys",
    """WITH first_new AS (SELECT p_partkey, p_name, p_brand, row_number() OVER (ORDER BY p_partkey) AS r FROM part),
            second_new AS (SELECT s_suppkey, s_name, row_number() OVER (ORDER BY s_suppkey) AS r FROM supplier),
            top1 AS (SELECT MAX(c_custkey) AS m FROM customer), top2 AS (SELECT m + (SELECT COUNT(*) FROM part) AS m FROM top1)
       SELECT CAST(c_custkey AS BIGINT) AS attribute_key, c_mktsegment AS attribute_type, c_name AS code, CAST('1' AS VARCHAR) AS source_id FROM customer
       UNION ALL SELECT CAST(r + (SELECT m FROM top1) AS BIGINT), p_brand, concat(p_name, p_partkey), '5' FROM first_new
       UNION ALL SELECT CAST(r + (SELECT m FROM top2) AS BIGINT), 'supplier', s_name, '5' FROM second_new""",
)
def _(spark, sf):
    base = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("attribute_key"), F.col("c_mktsegment").alias("attribute_type"),
        F.col("c_name").alias("code"), F.lit("1").alias("source_id"),
    )
    parts = table(spark, sf, "part").select(
        "p_partkey", F.col("p_brand").alias("attribute_type"), F.concat("p_name", F.col("p_partkey").cast("string")).alias("code")
    )
    suppliers = table(spark, sf, "supplier").select("s_suppkey", F.col("s_name").alias("code"))
    one = W.append_with_keys(base, parts, "attribute_key", ["p_partkey"], {"source_id": F.lit("5")})
    two = W.append_with_keys(
        one, suppliers, "attribute_key", ["s_suppkey"], {"source_id": F.lit("5"), "attribute_type": F.lit("supplier")}
    )
    return two.withColumn("attribute_key", F.col("attribute_key").cast("bigint"))


@query(
    "w02_row_numbers",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_num FROM orders",
)
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return W.number_rows(o, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "row_num")


@query("w03_dense_rank", "SELECT o_orderkey, dense_rank() OVER (ORDER BY o_orderdate) AS day_no FROM orders")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return W.dense_rank_of(o, "o_orderdate", "day_no").select("o_orderkey", "day_no")


@query(
    "w04_run_lengths",
    """WITH flagged AS (SELECT user_id, event_id, event_type, CASE WHEN event_type = lag(event_type) OVER
              (PARTITION BY user_id ORDER BY event_id) THEN 0 ELSE 1 END AS s FROM events),
            runs AS (SELECT *, SUM(s) OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM flagged)
       SELECT user_id, MIN(event_id) AS event_id, event_type, COUNT(*) AS run_length FROM runs GROUP BY user_id, r, event_type""",
)
def _(spark, sf):
    return W.run_lengths(table(spark, sf, "events"), ["user_id"], ["event_id"], "event_type")


@query(
    "w04_role_runs",
    """WITH flagged AS (SELECT conv_id, turn, role, CASE WHEN role = lag(role) OVER
              (PARTITION BY conv_id ORDER BY turn) THEN 0 ELSE 1 END AS s FROM conversations),
            runs AS (SELECT *, SUM(s) OVER (PARTITION BY conv_id ORDER BY turn) AS r FROM flagged)
       SELECT conv_id, MIN(turn) AS turn, role, COUNT(*) AS run_length FROM runs GROUP BY conv_id, r, role""",
)
def _(spark, sf):
    return W.run_lengths(table(spark, sf, "conversations"), ["conv_id"], ["turn"], "role")


@query(
    "w05_smallest_step",
    """WITH d AS (SELECT DISTINCT o_custkey, o_orderkey FROM orders),
            p AS (SELECT o_custkey, o_orderkey AS low, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS high FROM d)
       SELECT o_custkey, step, low, high FROM (SELECT o_custkey, high - low AS step, low, high,
              row_number() OVER (PARTITION BY o_custkey ORDER BY high - low, low) AS r FROM p WHERE high IS NOT NULL) x WHERE r = 1""",
)
def _(spark, sf):
    return W.smallest_step(table(spark, sf, "orders"), ["o_custkey"], "o_orderkey")


@query(
    "w06_missing_lines",
    """SELECT l_orderkey, CAST(unnest(range(lo + 1, hi)) AS BIGINT) AS missing FROM (
         SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS lo,
                CAST(lead(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS BIGINT) AS hi
         FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) d) g WHERE hi > lo + 1""",
)
def _(spark, sf):
    return W.missing_integers(table(spark, sf, "lineitem"), ["l_orderkey"], "l_linenumber")


@query(
    "w06_missing_orders",
    """SELECT CAST(unnest(range(lo + 1, hi)) AS BIGINT) AS missing FROM (
         SELECT l_orderkey AS lo, lead(l_orderkey) OVER (ORDER BY l_orderkey) AS hi
         FROM (SELECT DISTINCT l_orderkey FROM lineitem) d) g WHERE hi > lo + 1""",
)
def _(spark, sf):
    return W.missing_integers(table(spark, sf, "lineitem"), [], "l_orderkey")


# --- order and limit ----------------------------------------------------------------------------


@query("o01_order_by_count", "SELECT l_suppkey, COUNT(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_suppkey")
def _(spark, sf):
    return R.value_frequency(table(spark, sf, "lineitem"), "l_suppkey").orderBy(F.desc("n"), "l_suppkey")


@query("o02_first_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def _(spark, sf):
    return R.first_rows(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 100)


@query(
    "o03_sort_values",
    """SELECT page_id, array_to_string(list_sort(string_split(url, '/')), ' ') AS parts FROM pages ORDER BY parts, page_id""",
)
def _(spark, sf):
    parts = F.array_join(F.array_sort(F.split("url", "/")), " ").alias("parts")
    return table(spark, sf, "pages").select("page_id", parts).orderBy("parts", "page_id")


# --- sets ---------------------------------------------------------------------------------------


@query(
    "u01_union_all",
    """SELECT c_name AS name, c_acctbal AS balance FROM customer UNION ALL SELECT s_name, s_acctbal FROM supplier""",
)
def _(spark, sf):
    c, s = table(spark, sf, "customer"), table(spark, sf, "supplier")
    return c.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")).union(s.select("s_name", "s_acctbal"))


@query(
    "u02_append_rows",
    """SELECT s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey, s_acctbal FROM supplier
       UNION ALL SELECT -1, 'manual one', '13', 0.0 UNION ALL SELECT -2, 'manual two', NULL, 10.5""",
)
def _(spark, sf):
    s = table(spark, sf, "supplier").withColumn("s_nationkey", F.col("s_nationkey").cast("string"))
    return R.append_rows(s, [(-1, "manual one", 13, 0.0), (-2, "manual two", None, 10.5)], ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])


_TOKENS = "SELECT DISTINCT unnest(string_split(text, ' ')) AS word FROM {t}"


def _tokens(spark, sf, name):
    return table(spark, sf, name).select(F.explode(F.split("text", " ")).alias("word"))


@query(
    "u03_symmetric_difference",
    f"""WITH a AS ({_TOKENS.format(t='documents')}), b AS ({_TOKENS.format(t='benchmark')})
        (SELECT word FROM a EXCEPT SELECT word FROM b) UNION ALL (SELECT word FROM b EXCEPT SELECT word FROM a)""",
)
def _(spark, sf):
    return R.symmetric_difference(_tokens(spark, sf, "documents"), _tokens(spark, sf, "benchmark"))


@query(
    "u03_difference",
    "SELECT o_custkey AS k FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'",
)
def _(spark, sf):
    c = table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").select("c_custkey")
    return R.difference(table(spark, sf, "orders").select(F.col("o_custkey").alias("k")), c)


@query("u04_union_distinct", "SELECT l_orderkey AS k FROM lineitem UNION SELECT o_orderkey FROM orders")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    return table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k")).union(o).distinct()


@query(
    "u05_common_words",
    f"WITH a AS ({_TOKENS.format(t='documents')}), b AS ({_TOKENS.format(t='conversations')}) SELECT word FROM a INTERSECT SELECT word FROM b",
)
def _(spark, sf):
    return R.common(_tokens(spark, sf, "documents"), _tokens(spark, sf, "conversations"))
