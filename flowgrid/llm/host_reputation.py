"""Host reputation by empirical Bayes: page outcomes shrunk from host to registered domain to suffix to the whole corpus.

Outcomes are counts (n labelled pages, k bad ones). On each level a beta prior is centred on the posterior mean of the
level above; its strength is fitted by moments over all units of the level, from sums of integers only, so that the
result does not depend on the order of rows. A host is blocked when the lower bound of its posterior share of bad pages
exceeds ``max_bad``.

Nulls and edges: a null url, or one without ``://``, has empty host and path and is judged as the unit "". A page without
label adds nothing to the counts. Hosts without any label take the posterior of their domain. An empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgrid.llm.common import ascii_lower, stored

MAX_RULES = 1000


def url_host(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Struct (length, rule, verdict) of the longest fitting (rule, verdict); null where none fits.

    A rule is host plus path prefix, ``example.com/en/``. The list is a parameter of at most MAX_RULES entries.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules; store them as a table and join by host")
    fits = []
    for rule, verdict in rules:
        rule_host, slash, rule_path = rule.partition("/")
        own = (host == rule_host) | host.endswith("." + rule_host)
        fits.append(F.when(own & path.startswith(slash + rule_path), F.struct(
            F.lit(len(rule)).alias("length"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    none = F.lit(None).cast("struct<length:int,rule:string,verdict:string>")
    return F.array_max(F.array(none, *fits))


def _strength(units: DataFrame, cap: float) -> float:
    """Strength a + b of a beta prior with the moments of the units' shares: E[p] = sum k / sum n,
    E[p^2] = sum k(k-1) / sum n(n-1). Without spread between units (or without pairs) it is the cap."""
    big = "decimal(38,0)"
    pair = lambda c: F.sum((F.col(c) * (F.col(c) - 1)).cast(big)).cast("double")
    k, n, kk, nn = units.agg(F.sum("k").cast("double"), F.sum("n").cast("double"), pair("k"), pair("n")).first()
    if not n or not nn:
        return cap
    mean, square = k / n, kk / nn
    spread = square - mean * mean
    return min(max((mean - square) / spread, 1.0), cap) if spread > 0 else cap


def reputation(pages: DataFrame, outcomes: DataFrame, z: float = 1.645, cap: float = 1000.0) -> DataFrame:
    """One row per host of ``pages`` (page_id, host): n, k, posterior mean and lower bound of its share of bad pages.

    ``outcomes`` (page_id, bad) labels pages. Counts are combined before each shuffle, so a host with a third of all
    pages costs one row per task.
    """
    bad = (outcomes.where("page_id IS NOT NULL AND bad IS NOT NULL").groupBy("page_id")
           .agg(F.max(F.col("bad").cast("int")).alias("bad")))
    hosts = stored(
        pages.select("page_id", "host").join(bad, "page_id", "left")
        .groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("bigint").alias("k"))
        .withColumn("domain", F.regexp_extract("host", r"([^.]*\.)?[^.]*$", 0))
        .withColumn("suffix", F.regexp_extract("host", r"[^.]*$", 0)), "hosts")
    up = lambda key: hosts.groupBy(key).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    total = hosts.agg(F.sum("k").cast("double"), F.sum("n").cast("double")).first()
    base = total[0] / total[1] if total[1] else 0.0
    s_suffix, s_domain, s_host = (_strength(u, cap) for u in (up("suffix"), up("domain"), hosts))
    suffix = up("suffix").select("suffix", ((F.col("k") + s_suffix * base) / (F.col("n") + s_suffix)).alias("p_suffix"))
    domain = (hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).join(suffix, "suffix")
              .select("domain", ((F.col("k") + s_domain * F.col("p_suffix")) / (F.col("n") + s_domain)).alias("p_domain")))
    a = F.col("k") + s_host * F.col("p_domain")
    size = F.col("n") + s_host
    mean = F.col("a") / F.col("size")
    return (hosts.join(domain, "domain").withColumn("a", a).withColumn("size", size).withColumn("bad_mean", mean)
            .select("host", "n", "k", "bad_mean", (F.col("bad_mean") - z * F.sqrt(
                F.col("bad_mean") * (1.0 - F.col("bad_mean")) / (F.col("size") + 1.0))).alias("bad_low")))


def judge(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str]], max_bad: float = 0.3,
          z: float = 1.645, url: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict of every row of ``pages``: the longest rule's verdict, else the method's.

    The reputation table is stored, so the join sees its size: small ones are broadcast, otherwise both sides are
    shuffled and a hot host is split by adaptive execution.
    """
    parts = pages.select("page_id", url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    scores = stored(reputation(parts, outcomes, z).select(
        "host", F.when(F.col("bad_low") > max_bad, "block").otherwise("allow").alias("by_host")), "reputation")
    return (parts.join(scores, "host", "left").withColumn("fit", longest_rule(F.col("host"), F.col("path"), rules))
            .select("page_id", "host", "path", F.col("fit.rule").alias("rule"),
                    F.coalesce("fit.verdict", "by_host").alias("verdict")))
