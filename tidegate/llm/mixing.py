"""Mixing sources to target weights by entropy balancing.

The rates r of the documents minimise sum(size * (r * log(r) - r + 1)), the divergence from taking
every word once, under one token constraint per source: sum(size * r) = target. The convex dual has
one multiplier per source, and the optimum is the exponential tilt r = exp(multiplier of the
source). Newton steps on the dual are distributed: gradient and curvature are sums over documents,
combined before the shuffle, and multipliers stay in a DataFrame of one row per source.

Rates become copies: floor(rate) for each document, and one more for the first documents of the
source in the order of md5(doc_id), until the source's words are used up. Only the last of these
takes a cut copy, so a source meets its target exactly, but for less than a word.

Sources are weighted in code-point order, null last. A target stops at `cap` times the source's
size, and the excess is shared again among the other sources by weight.

Null texts and texts of white space have size 0 and are taken 0 times. An empty table gives an empty
result. Rows with equal doc_id are ordered by their text's hash. Other columns are not touched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.texts import SPACES, word_count
from tidegate.operators.ordering import stored_in_order
from tidegate.session import cut_lineage, store

#: Rounding of a total to whole words; irrational, so that no exact fraction lies on the border.
_ROUND = 0.6180339887498949


def source_targets(totals: DataFrame, weights: Sequence[float], cap: float) -> DataFrame:
    """`totals` (source, source_size) with `target`. Works on one row per source.

    Targets are min(cap * size, level * weight) for the level at which they add up to all words:
    sources sorted by cap / weight stop one after the other, so the level follows from prefix sums.
    """
    everything = Window.partitionBy(F.lit(0))
    by_source = everything.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_source) - 1) % len(weights) + 1).cast("int"))
    limits = totals.select("*", weight.alias("weight"), (F.col("source_size") * float(cap)).alias("limit"))
    limits = limits.withColumn("stops_at", F.col("limit") / F.col("weight"))
    before = everything.orderBy("stops_at", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    rest_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    rest_words = F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    levels = limits.withColumn("level", F.greatest(rest_words, F.lit(0.0)) / rest_weight)
    # The level is the first that its own source does not stop below.
    level = F.min_by("level", F.when(F.col("level") <= F.col("stops_at"), F.col("stops_at"))).over(everything)
    target = F.least(F.col("limit"), F.coalesce(level * F.col("weight"), F.col("limit")))
    return levels.select("source", "source_size", target.alias("target"))


def balance(units: DataFrame, constraints: DataFrame, tolerance: float = 1e-12, most_steps: int = 200) -> DataFrame:
    """`constraints` (source, source_size, target) with `rate`, by Newton's method on the dual.

    `units` has (source, size). Every step sums size * exp(multiplier) over all units of a source;
    with g = that sum - target, the multiplier moves by -g / sum. Steps go on until every source is
    within `tolerance` of its target; an error is raised beyond `most_steps`.
    """
    current = constraints.withColumn("multiplier", F.lit(0.0))
    for _ in range(most_steps):
        tilted = units.join(current.select(F.col("source").alias("of"), "multiplier"), F.col("source").eqNullSafe(F.col("of")))
        sums = tilted.groupBy(F.col("source").alias("of")).agg(F.sum(F.col("size") * F.exp("multiplier")).alias("words"))
        stepped = current.join(sums, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
        active = (F.col("target") > 0) & (F.col("words") > 0)
        off = F.when(active, F.abs(F.col("words") - F.col("target")) / F.col("target")).otherwise(F.lit(0.0))
        # A gradient step never leaves the range where exp() is finite: from above it is below 1.
        step = F.when(active, (F.col("words") - F.col("target")) / F.col("words")).otherwise(F.lit(0.0))
        current = cut_lineage(stepped.select(*constraints.columns, (F.col("multiplier") - step).alias("multiplier"), off.alias("off")))
        worst = current.agg(F.max("off")).first()[0]
        if worst is None or worst <= tolerance:
            rate = F.when(F.col("target") > 0, F.exp("multiplier")).otherwise(F.lit(0.0))
            return current.select(*constraints.columns, rate.alias("rate"))
        current = current.drop("off")
    raise RuntimeError(f"balancing did not converge: still off by {worst}")


def mix(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), cap: float = 3.0, text: Column | None = None) -> DataFrame:
    """For each document: doc_id, source, size, source_size, target, rate, copies (whole) and cut_words.

    `copies * size + cut_words` is what the mix takes. `tie` tells rows of one doc_id apart.
    """
    text = F.col("text") if text is None else text
    keyed = docs.select(
        F.col("doc_id"), F.col("source"), word_count(text).alias("size"),
        F.xxhash64(text).alias("tie"), F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("place"),
    )
    # The order of the extra copies, cut into chunks of the full key: a hot source fills many chunks.
    units = stored_in_order(keyed, ["source", "place", "doc_id", "tie"])
    totals = store(units.groupBy("source").agg(F.sum("size").alias("source_size")), "totals")
    rates = balance(units, store(source_targets(totals, weights, cap), "targets"))
    rate = F.when(F.col("rate") > cap - 1e-9, F.lit(float(cap))).otherwise(F.col("rate"))
    whole = F.floor(rate)
    quota = F.floor(rate * F.col("source_size") + F.lit(_ROUND))
    plans = rates.select(
        F.col("source").alias("of"), "source_size", "target", rate.alias("rate"), whole.alias("whole"),
        F.greatest(quota - whole * F.col("source_size"), F.lit(0)).alias("extra"),
    )
    # Words before a row: those of earlier chunks (a row per source and chunk), then those in its chunk.
    by_chunk = units.groupBy(F.col("source").alias("of_source"), F.col("__chunk").alias("of_chunk")).agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("of_source").orderBy("of_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_chunk.select("of_source", "of_chunk", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy("source", "__chunk").orderBy("__pos").rowsBetween(Window.unboundedPreceding, -1)
    running = units.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = running.join(starts, F.col("source").eqNullSafe(F.col("of_source")) & (F.col("__chunk") == F.col("of_chunk")))
    placed = placed.join(plans, F.col("source").eqNullSafe(F.col("of")))
    left = F.greatest(F.lit(0), F.least(F.col("size"), F.col("extra") - F.col("start") - F.col("before")))
    full = (left == F.col("size")) & (F.col("size") > 0)
    return placed.select(
        "doc_id", "source", "tie", "size", "source_size", "target", "rate",
        (F.when(F.col("size") > 0, F.col("whole")).otherwise(F.lit(0)) + full.cast("long")).alias("copies"),
        F.when(full, F.lit(0)).otherwise(left).cast("long").alias("cut_words"),
    )


def mixed_copies(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), cap: float = 3.0) -> DataFrame:
    """The documents of the mix: a row for each whole copy and one for the cut copy of a source,
    whose words are joined by one space.

    Rows of `docs` that are equal in doc_id and text get the sum of their copies, shared evenly.
    """
    plan = mix(docs, weights, cap).groupBy("doc_id", "tie").agg(
        F.sum("copies").alias("__copies"), F.max("cut_words").alias("__cut"), F.count(F.lit(1)).alias("__rows"),
    ).select(F.col("doc_id").alias("__id"), F.col("tie").alias("__tie"), "__copies", "__cut", "__rows")
    kept = plan.filter((F.col("__copies") > 0) | (F.col("__cut") > 0))
    keyed = docs.withColumn("__hash", F.xxhash64("text"))
    joined = keyed.join(kept, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__tie")))
    # Several equal rows stand for each other: the first gets the remainder and the cut copy.
    turn = Window.partitionBy("doc_id", "__hash").orderBy(F.lit(0))
    single = joined.filter(F.col("__rows") == 1).withColumn("__n", F.lit(1))
    several = joined.filter(F.col("__rows") > 1).withColumn("__n", F.row_number().over(turn))
    rows = single.unionByName(several)
    own = F.floor(F.col("__copies") / F.col("__rows")) + (F.col("__n") <= F.col("__copies") % F.col("__rows")).cast("long")
    cut = F.when(F.col("__n") == 1, F.col("__cut")).otherwise(F.lit(0))
    # The copy numbers: 1 to own are whole, 0 is the cut one.
    numbers = F.concat(
        F.when(own > 0, F.sequence(F.lit(1), own.cast("int"))).otherwise(F.array().cast("array<int>")),
        F.when(cut > 0, F.array(F.lit(0))).otherwise(F.array().cast("array<int>")),
    )
    spread = rows.withColumn("__cut", cut).withColumn("__copy", F.explode(numbers))
    words = F.slice(F.split(F.btrim("text", F.lit(SPACES)), "[ \\t-\\r]+"), F.lit(1), F.col("__cut").cast("int"))
    text = F.when(F.col("__copy") > 0, F.col("text")).otherwise(F.array_join(words, " "))
    spread = spread.withColumn("text", text)
    if "n_chars" in docs.columns:
        spread = spread.withColumn("n_chars", F.length("text").cast("long"))
    return spread.select(*docs.columns)
