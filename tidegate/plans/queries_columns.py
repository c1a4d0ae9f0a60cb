"""Queries over column, scalar and standardisation operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.functions import scalar as S
from tidegate.operators import columns as P
from tidegate.operators import standardize as N
from tidegate.plans.inputs import derived, table
from tidegate.plans.registry import query
from tidegate.session import store

# --- schema and columns -------------------------------------------------------------------------


@query("p01_upper_columns", "SELECT s_suppkey AS S_SUPPKEY, s_name AS S_NAME, s_nationkey AS S_NATIONKEY FROM supplier")
def _(spark, sf):
    return P.upper_columns(table(spark, sf, "supplier"), drop=["s_acctbal"])


@query(
    "p02_canonical_column",
    """SELECT CAST(l_orderkey AS VARCHAR) AS source_name, l_linenumber, 'only_id' AS variant FROM lineitem
       UNION ALL SELECT l_returnflag, l_linenumber, 'both' FROM lineitem
       UNION ALL SELECT l_linestatus, l_linenumber, 'only_name' FROM lineitem""",
)
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    parts = {
        "only_id": li.select(F.col("l_orderkey").alias("file_id"), "l_linenumber"),
        "both": li.select(F.col("l_orderkey").alias("file_id"), F.col("l_returnflag").alias("file_name"), "l_linenumber"),
        "only_name": li.select(F.col("l_linestatus").alias("file_name"), "l_linenumber"),
    }
    done = [
        P.canonical_column(df, "source_name", "file_name", "file_id").withColumn("variant", F.lit(v))
        for v, df in parts.items()
    ]
    return done[0].unionByName(done[1]).unionByName(done[2])


@query(
    "p03_add_columns",
    """SELECT c_custkey, 'TOTAL' AS level1, CAST(NULL AS VARCHAR) AS owner, CAST(19000101 AS DOUBLE) AS start_wid
       FROM customer""",
)
def _(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey")
    added = P.add_columns(df, {"level1": ("TOTAL", "string"), "owner": (None, "string"), "start_wid": ("19000101", "decimal(10,0)")})
    return added.withColumn("start_wid", F.col("start_wid").cast("double"))


@query(
    "p04_cast_columns",
    """SELECT l_orderkey, l_linenumber, CAST(TRY_CAST(l_linenumber AS DECIMAL(1,0)) AS DOUBLE) AS flag,
              CAST(TRY_CAST(l_quantity AS DECIMAL(1,0)) AS DOUBLE) AS qty FROM lineitem""",
)
def _(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_linenumber").alias("flag"), F.col("l_quantity").alias("qty"))
    return P.cast_columns(P.cast_columns(df, ["flag", "qty"], "decimal(1,0)"), ["flag", "qty"], "double")


@query(
    "p05_recode",
    """SELECT p_partkey, CASE WHEN p_size IN (5, 15, 25) THEN 'odd size' ELSE p_type END AS p_type FROM part""",
)
def _(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_type", "p_size")
    return P.recode(df, "p_type", "p_size", {5: "odd size", 15: "odd size", 25: "odd size"}).drop("p_size")


@query("p06_drop_if_all", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def _(spark, sf):
    df = table(spark, sf, "orders").drop("o_orderdate")
    kept = P.drop_if_all(df, ["o_custkey", "no_such_column"])
    return P.drop_if_all(kept, ["o_orderstatus", "o_orderpriority"])


@query(
    "p07_bucket",
    """SELECT CAST(floor(year(o_orderdate) / 10.0) * 10 AS BIGINT) AS decade, COUNT(o_orderkey) AS row_count
       FROM orders GROUP BY 1""",
)
def _(spark, sf):
    df = table(spark, sf, "orders").withColumn("decade", P.bucket(F.year("o_orderdate"), 10))
    return df.groupBy("decade").agg(F.count("o_orderkey").alias("row_count"))


@query(
    "p08_clean_names",
    """SELECT p_partkey AS "PARTKEY_NO", p_size AS "SIZE_CM" FROM part""",
)
def _(spark, sf):
    df = table(spark, sf, "part").select(F.col("p_partkey").alias("partkey no."), F.col("p_size").alias("size (cm)"))
    return P.clean_names(df)


@query(
    "p09_schema_drift",
    """SELECT DISTINCT dataset_id, regexp_replace(replace(upper(column_name), ' ', '_'), '[^A-Z0-9_]', '', 'g') AS column_name
       FROM seen_columns
       WHERE NOT EXISTS (SELECT 1 FROM known_columns k WHERE k.dataset_id = seen_columns.dataset_id
              AND upper(k.column_name) = regexp_replace(replace(upper(seen_columns.column_name), ' ', '_'), '[^A-Z0-9_]', '', 'g'))""",
    inputs=("seen_columns", "known_columns"),
)
def _(spark, sf):
    return P.schema_drift(derived(spark, sf, "seen_columns"), derived(spark, sf, "known_columns"))


@query(
    "p10_evolve_schema",
    """WITH drift AS (
         SELECT DISTINCT s.dataset_id, regexp_replace(replace(upper(s.column_name), ' ', '_'), '[^A-Z0-9_]', '', 'g') AS column_name
         FROM seen_columns s),
       fresh AS (SELECT * FROM drift d WHERE NOT EXISTS (SELECT 1 FROM known_columns k
                 WHERE k.dataset_id = d.dataset_id AND upper(k.column_name) = d.column_name))
       SELECT dataset_id, column_name, CAST(column_id AS BIGINT) AS column_id,
              CAST(column_sequence_number AS BIGINT) AS column_sequence_number, column_data_type FROM known_columns
       UNION ALL
       SELECT dataset_id, column_name,
              CAST((SELECT MAX(column_id) FROM known_columns) + row_number() OVER (ORDER BY dataset_id, column_name) AS BIGINT),
              CAST(COALESCE((SELECT MAX(k.column_sequence_number) FROM known_columns k WHERE k.dataset_id = fresh.dataset_id), 0)
                   + row_number() OVER (PARTITION BY dataset_id ORDER BY column_name) AS BIGINT), 'string'
       FROM fresh""",
    inputs=("seen_columns", "known_columns"),
)
def _(spark, sf):
    known = derived(spark, sf, "known_columns")
    drift = P.schema_drift(derived(spark, sf, "seen_columns"), known)
    return P.evolve_metadata(known, drift).select(
        "dataset_id", "column_name", F.col("column_id").cast("bigint"),
        F.col("column_sequence_number").cast("bigint"), "column_data_type",
    )


FEED_COLUMNS = [
    {"column_name": "bal_raw", "column_data_type": "decimal(12,2)", "column_sequence_number": 2},
    {"column_name": "c_custkey", "column_data_type": "bigint", "column_sequence_number": 1},
    {"column_name": "joined_raw", "column_data_type": "date", "column_date_format": "yyyyMMdd", "column_sequence_number": 3},
]


@query(
    "p11_typed_conversion",
    """SELECT c_custkey, CAST(TRY_CAST(bal_raw AS DECIMAL(12,2)) AS DOUBLE) AS bal_raw,
              strftime(TRY_STRPTIME(joined_raw, '%Y%m%d'), '%Y-%m-%d') AS joined_raw FROM customer_feed""",
    inputs=("customer_feed",),
)
def _(spark, sf):
    typed = P.apply_schema(derived(spark, sf, "customer_feed"), FEED_COLUMNS)
    return typed.withColumns({"bal_raw": F.col("bal_raw").cast("double"), "joined_raw": F.col("joined_raw").cast("string")})


@query("p12_cast_column", "SELECT l_orderkey, l_linenumber, CAST(floor(l_quantity) AS BIGINT) AS l_quantity FROM lineitem")
def _(spark, sf):
    return P.cast_columns(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), ["l_quantity"], "bigint")


@query(
    "p13_strip_characters",
    """SELECT page_id, regexp_replace(url, '[^0-9]', '', 'g') AS url, md5(regexp_replace(html, '[$]', '', 'g')) AS html FROM pages""",
)
def _(spark, sf):
    df = P.strip_characters(table(spark, sf, "pages"), "url", "[^0-9]")
    return P.strip_characters(df, "html", "[$]").withColumn("html", F.md5("html"))


@query(
    "p14_drop_nulls",
    """SELECT c_custkey, name, bal, CAST(joined AS VARCHAR) AS joined FROM (
         SELECT c_custkey, CASE WHEN name_raw IS NULL OR trim(name_raw) = '' THEN NULL ELSE trim(name_raw) END AS name,
                CASE WHEN bal_raw = 'n/a' THEN NULL ELSE bal_raw END AS bal,
                CASE WHEN joined_raw = '20240230' THEN NULL ELSE joined_raw END AS joined FROM customer_feed) x
       WHERE (CASE WHEN name IS NULL THEN 0 ELSE 1 END) + (CASE WHEN bal IS NULL THEN 0 ELSE 1 END)
             + (CASE WHEN joined IS NULL THEN 0 ELSE 1 END) >= 3 AND name IS NOT NULL""",
    inputs=("customer_feed",),
)
def _(spark, sf):
    feed = derived(spark, sf, "customer_feed")
    df = feed.select(
        "c_custkey", N.blank_to_null(F.trim("name_raw")).alias("name"), F.nullif("bal_raw", F.lit("n/a")).alias("bal"),
        F.nullif("joined_raw", F.lit("20240230")).alias("joined"),
    )
    return P.drop_nulls(P.drop_nulls(df, thresh=3, subset=["name", "bal", "joined"]), subset=["name"])


@query(
    "p15_fill_nulls",
    """SELECT c_custkey, COALESCE(name_raw, 'missing') AS name_raw, COALESCE(NULLIF(bal_raw, 'n/a'), 'none') AS bal_raw
       FROM customer_feed""",
    inputs=("customer_feed",),
)
def _(spark, sf):
    df = derived(spark, sf, "customer_feed").select("c_custkey", "name_raw", F.nullif("bal_raw", F.lit("n/a")).alias("bal_raw"))
    return P.fill_nulls(P.fill_nulls(df, "none", ["bal_raw"]), "missing")


@query("p16_swap_columns", "SELECT c_custkey, c_nationkey + 100 AS c_nationkey, upper(c_name) AS c_name FROM customer")
def _(spark, sf):
    df = table(spark, sf, "customer").select(
        "c_custkey", "c_nationkey", "c_name", (F.col("c_nationkey") + 100).alias("new_c_nationkey"), F.upper("c_name").alias("new_c_name")
    )
    return P.swap_columns(df, ["c_nationkey", "c_name"])


@query(
    "p17_row_id",
    """WITH twice AS (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'F')
       SELECT COUNT(*) AS n_rows, COUNT(*) AS n_ids, COUNT(DISTINCT o_orderkey) AS n_keys FROM twice""",
)
def _(spark, sf):
    # Exact copies get ids of their own; ids by key are one for each key.
    df = table(spark, sf, "orders")
    twice = P.add_row_id(df.unionByName(df.filter("o_orderstatus = 'F'")))
    keyed = P.add_row_id(twice, "key_id", ["o_orderkey"])
    return keyed.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("row_id").alias("n_ids"), F.count_distinct("key_id").alias("n_keys"),
    )


@query("p18_stamp", "SELECT COUNT(*) AS n_rows, COUNT(*) AS n_stamped FROM supplier")
def _(spark, sf):
    stamped = P.stamp(table(spark, sf, "supplier"))
    same = (F.col("created_dt") == F.col("updated_dt")) & (F.col("created_dt") <= F.current_timestamp())
    return stamped.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(same).alias("n_stamped"))


@query("p19_project_distinct", "SELECT DISTINCT o_custkey AS customer, o_orderstatus AS status FROM orders")
def _(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_custkey").alias("customer"), F.col("o_orderstatus").alias("status")).distinct()


@query(
    "p18_stamp_later",
    """SELECT s_suppkey, s_acctbal < 0 AS changed, s_acctbal < 0 AS updated_later, 1 = 1 AS created_first FROM supplier""",
)
def _(spark, sf):
    # A later run stamps changed rows anew: their creation time stays, only their update time moves.
    first = store(P.stamp(table(spark, sf, "supplier").select("s_suppkey", "s_acctbal")), "stamped")
    created = first.agg(F.min("created_dt").alias("first_created")).scalar()
    changed = first.filter("s_acctbal < 0").withColumn("first_dt", F.col("created_dt"))
    again = P.stamp(changed.drop("created_dt", "updated_dt")).withColumn("created_dt", F.col("first_dt")).drop("first_dt")
    kept = first.filter("not (s_acctbal < 0)").unionByName(again)
    return kept.select(
        "s_suppkey", (F.col("s_acctbal") < 0).alias("changed"), (F.col("updated_dt") > F.col("created_dt")).alias("updated_later"), (F.col("created_dt") == created).alias("created_first")
    )


# --- filters ------------------------------------------------------------------------------------


@query("e01_flag_filter", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def _(spark, sf):
    return P.flagged(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", "F")


@query(
    "e02_membership_filter",
    """SELECT l_orderkey, l_linenumber, p_name FROM lineitem JOIN part ON l_partkey = p_partkey
       WHERE p_type IN ('PROMO', 'SMALL') AND NOT starts_with(lower(p_name), 'red') AND NOT starts_with(lower(p_name), 'old')""",
)
def _(spark, sf):
    part = table(spark, sf, "part").filter(F.col("p_type").isin("PROMO", "SMALL"))
    part = P.without_prefixes(part, "p_name", ["RED", "Old"])
    joined = table(spark, sf, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select("l_orderkey", "l_linenumber", "p_name")


@query(
    "e04_date_range",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders
       WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'""",
)
def _(spark, sf):
    df = table(spark, sf, "orders").filter(P.within(F.col("o_orderdate"), "1996-01-01", "1998-12-31"))
    return df.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"))


@query(
    "e05_palindrome",
    """SELECT word, COUNT(*) AS n FROM (SELECT unnest(string_split(lower(text), ' ')) AS word FROM documents) w
       WHERE word = reverse(word) AND length(word) > 1 AND regexp_full_match(word, '[a-z]+') GROUP BY word""",
)
def _(spark, sf):
    words = table(spark, sf, "documents").select(F.explode(F.split(F.lower("text"), " ")).alias("word"))
    hits = words.filter(S.is_palindrome(F.col("word")) & (F.length("word") > 1) & F.col("word").rlike("^[a-z]+$"))
    return hits.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


# --- scalar functions ---------------------------------------------------------------------------

BUSINESS_DAYS_SQL = """
  SELECT {key}, CAST(CASE WHEN s IS NULL OR e IS NULL THEN 0
       WHEN s <= e THEN (5 * ((e - DATE '1970-01-05') // 7) + least((e - DATE '1970-01-05') % 7, 5))
                      - (5 * ((s - DATE '1970-01-05') // 7) + least((s - DATE '1970-01-05') % 7, 5))
       ELSE (5 * ((e + 1 - DATE '1970-01-05') // 7) + least((e + 1 - DATE '1970-01-05') % 7, 5))
          - (5 * ((s + 1 - DATE '1970-01-05') // 7) + least((s + 1 - DATE '1970-01-05') % 7, 5)) END AS BIGINT) AS days
  FROM ({pairs}) p"""
SHIP_PAIRS = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(o_orderdate AS DATE) AS s,
    CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN NULL ELSE CAST(l_shipdate AS DATE) END AS e
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def _ship_pairs(spark, sf):
    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    returned = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("o_orderdate").cast("date").alias("s"),
        F.when(~returned, F.col("l_shipdate").cast("date")).alias("e"),
    )


@query("c01_business_days", BUSINESS_DAYS_SQL.format(key="l_orderkey, l_linenumber, l_partkey, l_suppkey", pairs=SHIP_PAIRS))
def _(spark, sf):
    days = S.business_days(F.col("s"), F.col("e"))
    return _ship_pairs(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", days.alias("days"))


@query("m07_sql_function", BUSINESS_DAYS_SQL.format(key="l_orderkey, l_linenumber, l_partkey, l_suppkey", pairs=SHIP_PAIRS))
def _(spark, sf):
    S.register_functions(spark)
    return spark.sql(
        "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, DAY_BETWEEN(s, e) AS days FROM {pairs}", pairs=_ship_pairs(spark, sf)
    )


@query(
    "c02_conditional_add",
    """SELECT p_partkey, CAST(p_size + CASE p_type WHEN 'ECONOMY' THEN 7 WHEN 'PROMO' THEN 12 ELSE 4 END AS BIGINT) AS new_size FROM part""",
)
def _(spark, sf):
    added = S.conditional_add(F.col("p_size"), F.col("p_type"), {"ECONOMY": 7, "PROMO": 12}, 4)
    return table(spark, sf, "part").select("p_partkey", added.cast("bigint").alias("new_size"))


@query(
    "c02_vectorized_function",
    """SELECT p_partkey, CAST(p_size + CASE p_type WHEN 'ECONOMY' THEN 7 WHEN 'PROMO' THEN 12 ELSE 4 END AS BIGINT) AS new_size FROM part""",
)
def _(spark, sf):
    def add(size, kind):
        return size + kind.map({"ECONOMY": 7, "PROMO": 12}).fillna(4).astype("int64")

    S.register_vectorized(spark, "tidegate_add", add, "bigint")
    return spark.sql("SELECT p_partkey, tidegate_add(p_size, p_type) AS new_size FROM {part}", part=table(spark, sf, "part"))


WORDS_SQL = r"[w FOR w IN string_split_regex(text, '[ \t\n\r]+') IF w <> '']"


@query("c03_first_word", f"SELECT doc_id, ({WORDS_SQL})[1] AS word FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", S.first_word(F.col("text")).alias("word"))


@query("c04_last_word_length", f"SELECT doc_id, CAST(length(({WORDS_SQL})[-1]) AS BIGINT) AS n FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", S.last_word_length(F.col("text")).cast("bigint").alias("n"))


@query("c05_reverse_words", f"SELECT doc_id, md5(array_to_string(list_reverse({WORDS_SQL}), ' ')) AS reversed FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(S.reverse_words(F.col("text"))).alias("reversed"))


@query("c06_vowel_count", "SELECT doc_id, CAST(length(regexp_replace(text, '[^aeiou]', '', 'g')) AS BIGINT) AS vowels FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", S.vowel_count(F.col("text")).cast("bigint").alias("vowels"))


@query(
    "c07_zip_to_map",
    """SELECT p_partkey, concat(least(a, b), '=', CASE WHEN a <= b THEN va ELSE vb END,
              CASE WHEN a = b THEN '' ELSE concat(',', greatest(a, b), '=', CASE WHEN a <= b THEN vb ELSE va END) END) AS pairs
       FROM (SELECT p_partkey, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b,
                    CAST(p_size AS VARCHAR) AS va, p_brand AS vb FROM part) x""",
)
def _(spark, sf):
    names = F.split("p_name", " ")
    keys = F.concat(names, names)
    values = F.array("p_type", F.col("p_partkey").cast("string"), F.col("p_size").cast("string"), F.col("p_brand"), F.lit("surplus"))
    entries = S.entries_by_key(S.zip_to_map(keys, values))
    text = F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return table(spark, sf, "part").select("p_partkey", text.alias("pairs"))


@query(
    "c08_sort_map",
    """SELECT o_custkey, string_agg(concat(p, '=', CAST(n AS VARCHAR)), ',' ORDER BY p) AS entries
       FROM (SELECT o_custkey, o_orderpriority AS p, COUNT(*) AS n FROM orders GROUP BY 1, 2) x GROUP BY 1""",
)
def _(spark, sf):
    counted = table(spark, sf, "orders").groupBy("o_custkey", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    # At most one entry per priority, so the collected map is small.
    maps = counted.groupBy("o_custkey").agg(F.map_from_entries(F.collect_list(F.struct("o_orderpriority", "n"))).alias("m"))
    text = F.transform(S.entries_by_key(F.col("m")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return maps.select("o_custkey", F.array_join(text, ",").alias("entries"))


@query(
    "c09_field_of_each",
    """SELECT l_orderkey, l_linenumber, concat(CAST(l_partkey AS VARCHAR), ',', CAST(l_suppkey AS VARCHAR)) AS seconds FROM lineitem""",
)
def _(spark, sf):
    pairs = F.array(
        F.struct(F.col("l_linenumber").alias("a"), F.col("l_partkey").alias("b")),
        F.struct(F.col("l_linenumber").alias("a"), F.col("l_suppkey").alias("b")),
    )
    seconds = F.transform(S.field_of_each(pairs, "b"), lambda x: x.cast("string"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.array_join(seconds, ",").alias("seconds"))


@query(
    "c10_flatten",
    r"""SELECT doc_id, CAST(len(flatten([string_split(l, ' ') FOR l IN string_split(text, chr(10))])) AS BIGINT) AS n,
               md5(array_to_string(flatten([string_split(l, ' ') FOR l IN string_split(text, chr(10))]), '/')) AS joined
        FROM documents""",
)
def _(spark, sf):
    nested = F.transform(F.split("text", "\n"), lambda line: F.split(line, " "))
    flat = S.flatten_levels(F.array(nested), 2)
    return table(spark, sf, "documents").select(
        "doc_id", F.size(flat).cast("bigint").alias("n"), F.md5(F.array_join(flat, "/")).alias("joined")
    )


@query("c11_array_reverse", "SELECT page_id, array_to_string(list_reverse(string_split(url, '/')), '>') AS path FROM pages")
def _(spark, sf):
    path = F.array_join(S.root_to_node(F.split("url", "/")), ">")
    return table(spark, sf, "pages").select("page_id", path.alias("path"))


@query(
    "c12_dates",
    """SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%d/%m/%Y') AS shipped,
              strftime(strptime(concat(strftime(l_shipdate, '%m-%d-%Y'), ' 00:00:00'), '%m-%d-%Y %H:%M:%S'), '%Y-%m-%d') AS parsed,
              CAST(NULL AS VARCHAR) AS bad FROM lineitem""",
)
def _(spark, sf):
    text = F.concat(F.date_format("l_shipdate", "MM-dd-yyyy"), F.lit(" 00:00:00"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        S.reformat_time(F.date_format("l_shipdate", "yyyyMMdd"), "yyyyMMdd", "dd/MM/yyyy").alias("shipped"),
        S.reformat_time(text, "MM-dd-yyyy HH:mm:ss", "yyyy-MM-dd").alias("parsed"),
        S.reformat_time(text, "yyyyMMdd", "yyyy-MM-dd").alias("bad"),
    )


@query(
    "c13_clean_message",
    """SELECT page_id, CAST(length(m) AS BIGINT) AS n, md5(m) AS message FROM (
         SELECT page_id, replace(replace(left(html, 2000), '"', ''), '''', '') AS m FROM pages) x""",
)
def _(spark, sf):
    message = S.clean_message(F.col("html"), 2000)
    return table(spark, sf, "pages").select("page_id", F.length(message).cast("bigint").alias("n"), F.md5(message).alias("message"))


@query(
    "c14_start_state",
    """SELECT id, CASE WHEN id = 0 THEN '0.0' ELSE 'Infinity' END AS dist, node, CASE WHEN id = 0 THEN node ELSE '' END AS path FROM staff""",
    inputs=("staff",),
)
def _(spark, sf):
    kind = "struct<dist:double,node:string,path:array<string>>"
    start = F.struct(F.lit(0.0), F.col("node"), F.array("node"))
    other = F.struct(F.lit(float("inf")), F.col("node"), F.array(F.lit("")))
    state = F.when(F.col("id") == 0, start).otherwise(other).cast(kind)
    return derived(spark, sf, "staff").withColumn("s", state).select(
        "id", F.col("s.dist").cast("string").alias("dist"), F.col("s.node").alias("node"), F.array_join("s.path", ">").alias("path")
    )


# --- standardisation ----------------------------------------------------------------------------


def _rule(column, function, params=None):
    return {"column_name": column, "function_name": function, "function_params": params}


def _standard(column, *rules):
    def run(spark, sf):
        feed = derived(spark, sf, "customer_feed").select("c_custkey", F.col(column).alias("v"))
        return N.standardize(feed, [_rule("v", *r) for r in rules])

    return run


def _standard_sql(column, expression):
    return f"SELECT c_custkey, {expression.format(v=column)} AS v FROM customer_feed"


_FEED = ("customer_feed",)
query("n01_upper", _standard_sql("addr_raw", "upper({v})"), _FEED)(_standard("addr_raw", ("type_conversion", "{'type':'Upper'}")))
query("n02_lower", _standard_sql("addr_raw", "lower({v})"), _FEED)(_standard("addr_raw", ("type_conversion", '{"type":"Lower"}')))
query("n03_blank", _standard_sql("name_raw", "CASE WHEN regexp_matches({v}, '[^ \\t\\r\\n]') THEN {v} END"), _FEED)(
    _standard("name_raw", ("blank_conversion",))
)
query("n04_left_pad", _standard_sql("bal_raw", "lpad({v}, 9, '0')"), _FEED)(
    _standard("bal_raw", ("left_padding", '{"padding_value":"0","length":9}'))
)
query("n05_right_pad", _standard_sql("bal_raw", "rpad({v}, 13, '*')"), _FEED)(
    _standard("bal_raw", ("right_padding", "{'padding_value':'*','length':13}"))
)
query("n06_trim", _standard_sql("name_raw", "trim({v})"), _FEED)(_standard("name_raw", ("trim",)))
query("n07_substring", _standard_sql("joined_raw", "substr({v}, 3, 4)"), _FEED)(
    _standard("joined_raw", ("sub_string", '{"start_index":3,"length":4}'))
)
query("n08_replace", _standard_sql("bal_raw", "replace({v}, '.', ',')"), _FEED)(
    _standard("bal_raw", ("replace", '{"to_replace":".","value":","}'))
)
query("n09_zip", _standard_sql("addr_raw", "NULLIF(regexp_extract({v}, '([0-9]{{5}})[0-9]*', 1), '')"), _FEED)(
    _standard("addr_raw", ("zip_extractor",))
)
query("n10_date", _standard_sql("joined_raw", "strftime(TRY_STRPTIME({v}, '%Y%m%d'), '%d.%m.%Y')"), _FEED)(
    _standard("joined_raw", ("date_conversion", '{"src":"yyyyMMdd","tgt":"dd.MM.yyyy"}'))
)
query(
    "n11_timezone",
    """SELECT event_id, strftime(timezone('Asia/Kolkata', timezone('America/New_York',
              strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S'))), '%Y%m%d %H:%M:%S') AS v FROM events""",
)(
    lambda spark, sf: N.standardize(
        table(spark, sf, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("v")),
        [
            _rule("v", "timezone_conversion", "{'src_tz':'America/New_York','tgt_tz':'UTC','src_ts':'yyyy-MM-dd HH:mm:ss',"
                  "'tgt_ts':'yyyy/MM/dd HH:mm:ss','utc_format_conversion_flag':'Y'}"),
            _rule("v", "timezone_conversion", "{'src_tz':'UTC','tgt_tz':'Asia/Kolkata','src_ts':'yyyy/MM/dd HH:mm:ss',"
                  "'tgt_ts':'yyyyMMdd HH:mm:ss','utc_format_conversion_flag':'N'}"),
        ],
    )
)


@query(
    "n12_rejected_rules",
    """SELECT rule_no, function_name FROM part_rules
       WHERE function_name = 'no_such_rule'
          OR (function_name <> 'trim' AND (function_params IS NULL OR function_params LIKE '%:00%'))
          OR (function_name = 'type_conversion' AND function_params LIKE '%upper%')
          OR (function_name = 'date_conversion' AND function_params NOT LIKE '%tgt%')""",
    inputs=("part_rules",),
)
def _(spark, sf):
    return N.rejected_rules(derived(spark, sf, "part_rules")).select("rule_no", "function_name")
