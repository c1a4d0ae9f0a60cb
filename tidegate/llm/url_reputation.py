"""URL filter by rules and by empirical-Bayes reputation of hosts.

A page's outcome is good if the document that its main text equals (with or without its first block,
which repeats the title) is labelled as of quality and not toxic. Outcomes are counted by host, registered domain and suffix. At each level
the share of good pages of a unit is shrunk to that of the level above by a beta-binomial prior: its
mean is the parent's shrunk share, its strength follows from how much the units of that level differ
beyond chance (method of moments, one aggregation). A host's posterior is a beta distribution; a page
is allowed if the posterior's lower bound (mean - z * deviation) is at least `least`. A host without
labelled pages has its domain's prior as posterior.

Rules go before reputation: a rule (host, path) fits its host and all subdomains if the url's path starts
with its path; of those that fit, the longest decides.

A null url or one without "://" has an empty host and path and is judged like any other host.
Without any labelled page the overall share is 1/2. Repeated pages count each. Counts are combined
before the shuffle, so a hot host is no hot task; the table of hosts is joined, never collected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.llm.html_text import main_blocks
from tidegate.llm.texts import LOWER, SPACES, UPPER, annotate
from tidegate.session import store

# Second-level suffixes under which domains are registered one label further down.
SECOND_LEVEL = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "ne.jp", "or.jp", "co.nz", "com.br", "com.cn", "co.in", "co.kr", "co.za", "com.mx", "com.tr")
# The rules of the contract.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


def suffix_of(host: Column) -> Column:
    labels = F.split(F.regexp_replace(host, r"^.*@|:\d*$", ""), r"\.")
    two = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")
    return F.when(two.isin(*SECOND_LEVEL), two).otherwise(F.element_at(labels, -1))


def domain_of(host: Column) -> Column:
    """The suffix and the label before it."""
    labels = F.split(F.regexp_replace(host, r"^.*@|:\d*$", ""), r"\.")
    n = F.size(F.split(suffix_of(host), r"\.")) + 1
    return F.array_join(F.slice(labels, F.greatest(F.size(labels) - n + 1, F.lit(1)), n), ".")


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """(verdict, rule) of the longest rule that fits, or null. For lists that fit into an expression."""
    result = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        own, slash, rest = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)
        result = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(result)
    return result


_DIGESTS = T.StructType([T.StructField("digests", T.ArrayType(T.StringType()))])


def _digests(sources: list) -> list[tuple]:
    out = []
    for source in sources:
        blocks = main_blocks(source)
        versions = [" ".join(blocks), " ".join(blocks[1:])]
        out.append(([hashlib.md5(v.encode("utf-8", "surrogatepass")).hexdigest() for v in versions if v],))
    return out


def page_outcomes(pages: DataFrame, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """host and outcome (1 good, 0 not, null without label) of every page, stored."""
    plain = F.regexp_replace(F.btrim("text", F.lit(SPACES)), "[ \\t-\\r]+", " ")
    digests = docs.select("doc_id", F.md5(plain).alias("digest"))
    good = F.when((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), 1).when(F.col("quality").isNotNull(), 0)
    known = digests.join(labels.select("doc_id", good.alias("good")), "doc_id").groupBy("digest").agg((F.avg("good") >= 0.5).cast("int").alias("outcome"))
    keyed = annotate(pages.select("url", "html"), "html", "main", _DIGESTS, _digests)
    numbered = store(keyed.select(host_of(F.col("url")).alias("host"), F.col("main.digests").alias("digests")), "page_digests")
    # A page is matched by its whole text first, then without its title.
    rows = numbered.withColumn("page", F.monotonically_increasing_id())
    tried = rows.select("page", "host", F.posexplode_outer("digests").alias("turn", "digest"))
    found = tried.join(known, "digest", "left")
    best = F.min_by("outcome", F.when(F.col("outcome").isNotNull(), F.col("turn")))
    return store(found.groupBy("page").agg(F.first("host").alias("host"), best.alias("outcome")).select("host", "outcome"), "outcomes")


def _strength(units: DataFrame, least: float = 1.0, most: float = 1e6) -> float:
    """Prior strength a + b of a level from units with good, n and the parent's share `mean`."""
    spread = F.col("mean") * (1 - F.col("mean"))
    term = F.col("n") * F.pow(F.col("good") / F.col("n") - F.col("mean"), 2) / spread
    row = units.filter((F.col("n") > 0) & (spread > 0)).agg(F.sum(term).alias("t"), F.count(F.lit(1)).alias("g"), F.sum(F.col("n") - 1).alias("d")).first()
    if not row.d:
        return least
    rho = (row.t - row.g) / row.d
    return most if rho <= 1 / (most + 1) else max(least, 1 / rho - 1)


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """host, n, good, a, b of the posterior of every host of `outcomes`, stored."""
    counted = store(outcomes.groupBy("host").agg(F.count("outcome").alias("n"), F.coalesce(F.sum("outcome"), F.lit(0)).alias("good")).select(
        "host", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"), "n", "good",
    ), "hosts")
    total = counted.agg(F.sum("good").alias("good"), F.sum("n").alias("n")).first()
    overall = ((total.good or 0) + 1) / ((total.n or 0) + 2)
    parents = None
    for level, above in (("suffix", None), ("domain", "suffix"), ("host", "domain")):
        units = counted.groupBy(level, *([above] if above else [])).agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
        if parents is None:
            units = units.withColumn("mean", F.lit(overall))
        else:
            units = units.join(parents.select(F.col(above).alias("of"), F.col("share").alias("mean")), F.col(above) == F.col("of")).drop("of")
        strength = _strength(units)
        a = F.col("good") + strength * F.col("mean")
        b = F.col("n") - F.col("good") + strength * (1 - F.col("mean"))
        parents = store(units.select(level, "n", "good", a.alias("a"), b.alias("b"), (a / (a + b)).alias("share")), level)
    return parents


def lower_bound(a: Column, b: Column, z: float) -> Column:
    mean = a / (a + b)
    return mean - z * F.sqrt(mean * (1 - mean) / (a + b + 1))


def judge_urls(pages: DataFrame, reputation: DataFrame, rules: Sequence[tuple[str, str]] = RULES, least: float = 0.5, z: float = 1.645) -> DataFrame:
    """`pages` with the struct `judged`: host, path, rule, verdict, bound."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    known = reputation.select(F.col("host").alias("__host"), lower_bound(F.col("a"), F.col("b"), z).alias("__bound"))
    found = pages.withColumn("__of", host).join(known, F.col("__of") == F.col("__host"), "left")
    rule = rule_of(F.col("__of"), path, rules)
    verdict = F.coalesce(rule["verdict"], F.when(F.col("__bound") >= least, "allow").otherwise("block"))
    judged = F.struct(F.col("__of").alias("host"), path.alias("path"), rule["rule"].alias("rule"), verdict.alias("verdict"), F.col("__bound").alias("bound"))
    return found.select(*pages.columns, judged.alias("judged"))
