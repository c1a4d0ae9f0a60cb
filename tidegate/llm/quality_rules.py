"""Quality classifier: a sparse ensemble of rules over text statistics.

1. Statistics of the text alone: shares of characters, words and lines, computed in one pass.
2. Shallow trees of a random forest are grown on the labelled rows. Every path from a root to a node
   is a conjunction of comparisons: a rule.
3. A lasso logistic regression on the rules' indicators keeps few of them, each with a weight.
4. The kept rules are compiled into one Spark column expression, so scoring is a projection.

All fitting is distributed (Spark ML) and uses every labelled row that is handed in, but that
beyond `sample` rows (a parameter of `fit_rules`) each tree grows on a random sample of about so many. The driver holds
only trees and weights, bounded by `trees` and `depth`.

A document whose labels disagree, or whose label is null, is not learned from. A null or empty text
has statistics of 0 and gets a score like any other. If there are no labelled rows of both classes,
the model is the constant share of good ones (1/2 without any). Rows are scored each on its own.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import islice
from operator import eq

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.llm.texts import annotate, crc_mod
from tidegate.session import store

Condition = tuple[str, bool, float]  # statistic, whether it must be at most the threshold, threshold


_UPPER = bytes(range(65, 91))
_DIGIT = bytes(range(48, 58))
_SYMBOL = bytes(b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:!?'\"()-")
_TAIL = re.compile(rb"[#$%&*!?=~^+]{2,}(?!\S)")
NAMES = (
    "log_words word_length upper digits symbols tails bangs bars stops commas echoes distinct_words distinct_lines line_words"
).split()
STATISTICS = T.StructType([T.StructField(name, T.DoubleType()) for name in NAMES])


def statistics_of(text: str | None) -> tuple[float, ...]:
    """The statistics NAMES of one text; all are 0 for null and for texts of white space."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return (0.0,) * len(NAMES)
    chars, lines = len(text), raw.strip().split(b"\n")

    def share(deleted: bytes) -> float:
        return (len(raw) - len(raw.translate(None, deleted))) / chars

    return (
        math.log1p(n), chars / n, share(_UPPER), share(_DIGIT), share(_SYMBOL), len(_TAIL.findall(raw)) / n,
        raw.count(b"!!") / n, raw.count(b"|") / n, raw.count(b".") / n, raw.count(b",") / n,
        sum(map(eq, words, islice(words, 1, None))) / n, len(set(words)) / n, len(set(lines)) / len(lines), n / len(lines),
    )


def with_statistics(docs: DataFrame, name: str = "statistics") -> DataFrame:
    """`docs` with the struct `name` of the text's statistics."""
    return annotate(docs, "text", name, STATISTICS, lambda texts: [statistics_of(t) for t in texts])


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[tuple[tuple[Condition, ...], float], ...]

    def score(self, stats: dict[str, Column]) -> Column:
        """The rules compiled into one expression over the columns of the statistics."""
        parts = [F.when(holds(rule, stats), F.lit(weight)).otherwise(F.lit(0.0)) for rule, weight in self.rules]
        margin = reduce(lambda a, b: a + b, parts, F.lit(self.intercept))
        return 1 / (1 + F.exp(-margin))


def holds(rule: Sequence[Condition], stats: dict[str, Column]) -> Column:
    tests = [stats[name] <= limit if low else stats[name] > limit for name, low, limit in rule]
    return reduce(lambda a, b: a & b, tests)


def tree_rules(forest, names: Sequence[str]) -> list[tuple[Condition, ...]]:
    """The distinct paths of all trees as conjunctions, one comparison per statistic and side."""
    found: dict[tuple[Condition, ...], None] = {}
    for tree in forest.trees:
        open_nodes = [(tree._call_java("rootNode"), ())]
        while open_nodes:
            node, path = open_nodes.pop()
            if path:
                tight: dict[tuple[str, bool], float] = {}
                for name, low, limit in path:
                    own = tight.get((name, low), limit)
                    tight[name, low] = min(own, limit) if low else max(own, limit)
                found[tuple(sorted((name, low, limit) for (name, low), limit in tight.items()))] = None
            if node.subtreeDepth() > 0:
                name, limit = names[node.split().featureIndex()], node.split().threshold()
                open_nodes += [(node.leftChild(), (*path, (name, True, limit))), (node.rightChild(), (*path, (name, False, limit)))]
    return list(found)


def labelled(stats: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """Rows of `stats` (with doc_id) that have one label, as column `label` (double)."""
    agreed = labels.groupBy(F.col("doc_id").alias("__id")).agg(F.min(label).alias("__low"), F.max(label).alias("__high"))
    agreed = agreed.filter("__low = __high").select("__id", F.col("__low").cast("double").alias("label"))
    return stats.join(agreed, stats["doc_id"] == agreed["__id"]).drop("__id")


def fit_rules(examples: DataFrame, names: Sequence[str], trees: int = 16, depth: int = 3, penalty: float = 5e-4, steps: int = 40, seed: int = 7, sample: int = 50_000) -> RuleModel:
    """Fit on `examples`: the statistics `names` and a `label` of 0.0 or 1.0.

    Each tree grows on a random sample of about `sample` rows where there are more; the lasso is fitted on all rows.
    """
    examples = store(examples.select("label", *names), "examples")  # read by every step of both fits
    counts = {r.label: r.n for r in examples.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    good, bad = counts.get(1.0, 0), counts.get(0.0, 0)
    if not good or not bad:
        share = (good + 0.5) / (good + bad + 1)
        return RuleModel(math.log(share / (1 - share)), ())
    assembled = VectorAssembler(inputCols=list(names), outputCol="features").transform(examples).select("features", "label", *names)
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="onethird", subsamplingRate=min(1.0, sample / (good + bad)),
        minInstancesPerNode=5,
    ).fit(assembled)
    rules = tree_rules(forest, names)
    columns = {n: F.col(n) for n in names}
    indicators = F.array(*[holds(rule, columns).cast("double") for rule in rules])
    coded = assembled.select(array_to_vector(indicators).alias("features"), "label")
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=steps, tol=1e-4, standardization=True).fit(coded)
    weights = lasso.coefficients.toArray()
    return RuleModel(float(lasso.intercept), tuple((r, float(w)) for r, w in zip(rules, weights) if w))


def stored_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every document, stored."""
    return store(with_statistics(docs.select("doc_id", "text")).select("doc_id", "statistics.*"), "statistics")


def fit_quality(stats: DataFrame, labels: DataFrame, folds: int = 5) -> RuleModel:
    """The model of `labels.quality`, learned from rows whose crc32(doc_id) modulo `folds` is not 0."""
    return fit_rules(labelled(stats.filter(crc_mod(F.col("doc_id"), folds) != 0), labels), NAMES)


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The documents that the classifier scores at `threshold` or more, unchanged."""
    model = fit_quality(stored_statistics(docs), labels)
    scored = with_statistics(docs, "__statistics")
    return scored.filter(model.score({n: F.col("__statistics")[n] for n in NAMES}) >= threshold).select(*docs.columns)
