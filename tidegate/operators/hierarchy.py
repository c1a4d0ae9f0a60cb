"""Reporting hierarchies: expansion from a root, and repair of chains that do not reach it."""

from __future__ import annotations

from itertools import count
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.operators.skew import HOT_ROWS, SALTS, hot_keys
from tidegate.session import bucketed, cut_lineage, folders_of, scratch_path


def hierarchy(
    vertices: DataFrame,
    edges: DataFrame,
    start_column: str,
    start_value,
    max_iter: int | None = None,
    hot_rows: int = HOT_ROWS,
    fraction: float = 0.05,
) -> DataFrame:
    """Level and path of every vertex, walking `edges(src, dst)` from the start vertices.

    `vertices(id, node, ...)`; adds `dist` and `path` (start to node). Levels are added until no new
    vertex is found. Vertices that cannot be reached have `dist` infinity and path `['']`. If `max_iter`
    is given and levels remain beyond it, that is an error, not an infinite distance. Of several parents on the level above,
    the one with the lowest node string is taken.

    The edges are stored once, bucketed by source, and only the vertices reached last are sent to
    them. Edges of a very wide parent are spread over several buckets, with a copy of the parent for
    each. A level that is complete is added to a table of visited vertices, bucketed by vertex into as many buckets as
    a shuffle has partitions: new vertices meet it where they lie, and what was visited is never shuffled again.
    """
    targets = vertices.select(F.col("id").alias("dst"), F.col("node").alias("dst_node"))
    starts = F.col(start_column) == F.lit(start_value)
    first = vertices.filter(starts).select("id", "node", F.lit(0.0).alias("dist"), F.array("node").alias("path"))
    pairs = edges.select("src", "dst").filter("src is not null")
    wide = hot_keys(pairs, ["src"], hot_rows, fraction)
    named = pairs.join(targets, "dst")  # a vertex has one row, so only edges can be skewed
    wide_list = edges.sparkSession.createDataFrame(wide, edges.select("src").schema).withColumn("__wide", F.lit(True))
    mark = lambda df: df.join(F.broadcast(wide_list), "src", "left") if wide else df.withColumn("__wide", F.lit(False))
    slot = F.when(F.col("__wide"), F.pmod(F.xxhash64("dst"), F.lit(SALTS))).otherwise(F.lit(0)).cast("int")
    slots = F.when(F.col("__wide"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    rows = pairs.count()
    with bucketed(mark(named).withColumn("slot", slot).drop("__wide"), ["src", "slot"], rows) as stored, Visited(first) as visited:
        for depth in count(1):
            level = visited.level(depth - 1)
            parents = level.select(F.col("id").alias("src"), F.col("node").alias("parent"), F.col("path").alias("above"))
            sent = stored.join(mark(parents).withColumn("slot", F.explode(slots)).drop("__wide"), ["src", "slot"])
            if not visited.add(next_level(sent, visited.ids(), depth), depth):
                break
            if max_iter is not None and depth > max_iter:
                raise ValueError(f"the hierarchy goes on beyond {max_iter} levels")
        reached = visited.result()
    return vertices.join(reached.select("id", "dist", "path"), "id", "left").withColumns(
        {
            "dist": F.coalesce("dist", F.lit(float("inf"))),
            "path": F.coalesce("path", F.array(F.lit(""))),
        }
    )


def next_level(sent: DataFrame, visited: DataFrame, depth: int) -> DataFrame:
    """Vertices not yet in `visited(id)` that rows (dst, dst_node, parent, above) lead to, each by its lowest parent."""
    best = F.min(F.struct("parent", "above", "dst_node"))
    found = sent.groupBy(F.col("dst").alias("id")).agg(best.alias("m")).join(visited, "id", "left_anti")
    path = F.concat("m.above", F.array("m.dst_node"))
    return found.select("id", F.col("m.dst_node").alias("node"), F.lit(float(depth)).alias("dist"), path.alias("path"))


class Visited:
    """A table of vertices by level, bucketed by `id`, that grows by whole levels; gone from the catalog at the end."""

    def __init__(self, first: DataFrame):
        self.spark = first.sparkSession
        self.buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"tidegate_{uuid4().hex}"
        self.path = scratch_path(self.spark, self.name)
        self.schema = first.schema
        self.add(first, 0)

    def __enter__(self) -> Visited:
        return self

    def __exit__(self, *problem) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def add(self, level: DataFrame, depth: int) -> bool:
        """Store a level; whether it has rows."""
        rows = level.withColumn("level", F.lit(depth)).write.mode("append").format("parquet").option("path", self.path)
        rows.partitionBy("level").bucketBy(self.buckets, "id").saveAsTable(self.name)
        return f"level={depth}" in folders_of(self.spark, self.path)

    def ids(self) -> DataFrame:
        return self.spark.table(self.name).select("id")

    def level(self, depth: int) -> DataFrame:
        return self.spark.table(self.name).filter(F.col("level") == depth).drop("level")

    def result(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path).drop("level")


def shape_hierarchy(result: DataFrame, *columns: str) -> DataFrame:
    """Distinct node rows with the path printed from the node up to the root."""
    return result.select(*columns, F.reverse("path").alias("path"), "dist").distinct()


def unreachable(result: DataFrame) -> DataFrame:
    return result.filter(F.col("dist") == F.lit(float("inf")))


def repair_chains(nodes: DataFrame, managers: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Chain of managers above each node that does not hang below the root.

    `nodes(node)`, `managers(currentnode, childnode)`. The chain ends after a manager equal to the
    node it manages, already in the chain, or equal to the start (`status` cycle), or where there
    is no manager (`status` no_manager). Of several managers the lowest string is taken (a choice).
    With `max_depth` longer chains are cut there (`status` open).

    Pointers are doubled: after k rounds every node has the next 2^k managers above it as one list, and a
    round appends the list of the last of them. So a chain of n managers takes log2(n) rounds, each one
    join of the unfinished nodes with the lists. A chain in which a manager comes again is cut there, and
    finished lists are stored once and stay.
    """
    above = managers.filter("currentnode is not null and childnode is not null").groupBy(F.col("childnode").alias("node")).agg(F.min("currentnode").alias("last"))
    lists = above.select("node", F.array("last").alias("newPath"), "last", F.when(F.col("node") == F.col("last"), "cycle").alias("status"))
    active = cut_lineage(lists)
    finished, reach = [active.filter("status is not null")], 1
    active = active.filter("status is null")
    while not active.isEmpty() and (max_depth is None or reach <= max_depth):
        known = active
        for part in finished:
            known = known.unionByName(part)
        further = known.select(F.col("node").alias("last"), F.col("newPath").alias("more"), F.col("last").alias("next"), F.col("status").alias("ended"))
        joined = cut_lineage(active.select("node", "newPath", "last").join(further, "last", "left").transform(_lengthened))
        finished.append(joined.filter("status is not null"))
        active, reach = joined.filter("status is null"), reach * 2
    result = active
    for part in finished:
        result = result.unionByName(part)
    wanted = nodes.select("node").distinct().join(result, "node", "left").select(
        "node", F.coalesce("newPath", F.array().cast("array<string>")).alias("newPath"),
        F.when(F.col("newPath").isNull(), "no_manager").otherwise(F.coalesce("status", F.lit("open"))).alias("status"),
    )
    if max_depth is None:
        return wanted
    # A cycle is seen when its last manager is appended, the lack of a manager one step later.
    steps = F.size("newPath") + (F.col("status") == "no_manager").cast("int")
    return wanted.select("node", F.slice("newPath", 1, max_depth).alias("newPath"), F.when(steps > max_depth, "open").otherwise(F.col("status")).alias("status"))


def _lengthened(joined: DataFrame) -> DataFrame:
    """Rows (node, newPath, last, more, next, ended) with `more` appended, up to the first manager that comes again."""
    everything = F.concat(F.array("node"), "newPath", "more")
    chain = joined.withColumn("whole", everything).withColumn("once", F.array_distinct("whole"))
    # Both lists are equal up to the first repetition.
    same = F.zip_with("whole", "once", lambda a, b: F.coalesce(a == b, F.lit(False)))
    repeated = F.when(F.size("whole") > F.size("once"), F.array_position(same, False).cast("int"))
    cut = chain.withColumn("cut", repeated)
    path = F.when(F.col("more").isNull(), F.col("newPath")).otherwise(F.slice("whole", F.lit(2), F.coalesce(F.col("cut") - 1, F.size("whole"))))
    status = F.when(F.col("more").isNull(), "no_manager").when(F.col("cut").isNotNull(), "cycle").otherwise(F.col("ended"))
    return cut.select("node", path.alias("newPath"), F.col("next").alias("last"), status.alias("status"))


def chain_status(chains: DataFrame) -> DataFrame:
    """How many chains end in a cycle and how many run out of managers."""
    return chains.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
