"""URL filter: fixed rules, then empirical-Bayes reputation of the host.

A rule names a host and a path prefix and fits that host and its subdomains; the
longest fitting rule decides.  All other pages are judged by their host: labelled
page outcomes (good or not) are shrunk top-down from all pages to suffix, registered
domain and host.  On each level the prior is a beta distribution around the parent's
posterior mean; its strength comes from how far the level's rates scatter beyond
chance (beta-binomial moments).  A host is blocked if even the upper posterior bound
of its share of good pages, mean + Z standard deviations, is below ``LEAST_GOOD``.

Plan: DataFrame functions only.  Outcomes are counted per host with map-side combine,
so a host with a third of all pages is one row per task; all higher levels are
aggregates of that table.  The verdicts join the pages on the host; Spark broadcasts
the host table if its size allows, else splits the hot host's partition.

Defined results: a null url, or one without ``://``, has empty host and path; equal
rows are judged alike, each counts as a labelled page; labels with nulls do not
count; without any label every host is allowed; other columns are not read; an empty
table gives an empty result.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_GOOD = 0.5
Z = 2.0
# Registries under which names are given out on the third level.
TWO_LEVEL = ("ac.uk", "co.uk", "gov.uk", "org.uk", "co.jp", "com.au", "com.br", "co.nz")
LEVELS = ("suffix", "domain", "host")


def parts(url) -> tuple:
    """(host, path) expressions of a url column."""
    pattern = r"(?s)://([^/?#]*)([^?#]*)"
    get = lambda k: F.coalesce(F.regexp_extract(url, pattern, k), F.lit(""))
    return F.translate(get(1), string.ascii_uppercase, string.ascii_lowercase), get(2)


def rule_of(host, path, rules):
    """Struct (rule, verdict) of the longest fitting rule, null if none fits.

    ``rules`` is a short list of (verdict, "host/path")."""
    chain = None
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        at = rule.index("/")
        fits = ((host == rule[:at]) | host.endswith("." + rule[:at])) & path.startswith(rule[at:])
        hit = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        chain = F.when(fits, hit) if chain is None else chain.when(fits, hit)
    return chain


def _levels(hosts: DataFrame) -> DataFrame:
    """hosts with suffix and domain."""
    labels = F.split(F.regexp_replace("host", r":\d*$", ""), r"\.")
    last = lambda n: F.array_join(F.slice(labels, F.greatest(
        F.size(labels) - n + 1, F.lit(1)), F.lit(n)), ".")
    two = last(2).isin(*TWO_LEVEL)
    return hosts.select("*", F.when(two, last(2)).otherwise(last(1)).alias("suffix"),
                        F.when(two, last(3)).otherwise(last(2)).alias("domain"))


def _shrink(level: str, groups: DataFrame, parents: DataFrame, parent: str | None) -> DataFrame:
    """(level, n, k, strength, prior, mean): groups shrunk towards their parents' means."""
    prior = parents.select(*([parent] if parent else []), F.col("mean").alias("prior"))
    g = groups.join(prior, parent) if parent else groups.crossJoin(prior)   # one row
    # scatter beyond chance: sum n (k/n - p)^2 / (p (1-p)) = groups + rho sum (n - 1)
    seen = F.col("n") > 0
    spread = F.pow(F.col("k") / F.col("n") - F.col("prior"), 2) * F.col("n") / (
        F.col("prior") * (1 - F.col("prior")))
    rho = ((F.sum(F.when(seen, spread)) - F.count(F.when(seen, 1)))
           / F.sum(F.when(F.col("n") > 1, F.col("n") - 1)))
    strength = g.agg(F.least(F.greatest(F.coalesce(rho, F.lit(0.0)), F.lit(1e-3)), F.lit(0.5))
                     .alias("rho")).select(((1 - F.col("rho")) / F.col("rho")).alias("strength"))
    return g.crossJoin(strength).withColumn(                                # one row
        "mean", (F.col("k") + F.col("strength") * F.col("prior"))
        / (F.col("n") + F.col("strength")))


def reputation(outcomes: DataFrame, least_good: float = LEAST_GOOD, z: float = Z) -> DataFrame:
    """(host, labelled, good, verdict) from (host, good boolean; null: not labelled)."""
    hosts = _levels(outcomes.groupBy("host").agg(
        F.count("good").alias("n"), F.count_if("good").alias("k")))
    count = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    # one good and one bad page more, so that the overall share is never 0 or 1
    parents = hosts.agg(((F.coalesce(F.sum("k"), F.lit(0)) + 1)
                         / (F.coalesce(F.sum("n"), F.lit(0)) + 2)).alias("mean"))
    parent = None
    for level in LEVELS:
        keep = [parent] if parent else []
        groups = hosts.groupBy(level, *keep).agg(*count)
        parents = _shrink(level, groups, parents, parent)
        parent = level
    a = F.col("k") + F.col("strength") * F.col("prior")
    b = F.col("n") - F.col("k") + F.col("strength") * (1 - F.col("prior"))
    upper = F.col("mean") + z * F.sqrt(a * b / (F.pow(a + b, 2) * (a + b + 1)))
    return parents.select("host", F.col("n").alias("labelled"), F.col("k").alias("good"),
                          F.when(upper < least_good, "block").otherwise("allow").alias("verdict"))


def judge(pages: DataFrame, outcomes: DataFrame, rules, page_id: str = "page_id",
          url: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, labelled, good per row of ``pages``.

    ``outcomes``: (host, good) of all pages, good null where not labelled."""
    host, path = parts(F.col(url))
    rows = (pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
            .withColumn("__rule", rule_of(F.col("host"), F.col("path"), rules)))
    known = reputation(outcomes).withColumnRenamed("verdict", "__by_host")
    return rows.join(known, "host", "left").select(
        "page_id", "host", "path", F.col("__rule.rule").alias("rule"),
        F.coalesce("__rule.verdict", "__by_host", F.lit("allow")).alias("verdict"),
        F.coalesce("labelled", F.lit(0)).cast("long").alias("labelled"),
        F.coalesce("good", F.lit(0)).cast("long").alias("good"))
