"""URL filter by rules and by empirical-Bayes host reputation, native expressions only.

Labelled outcomes of pages are counted per host, registered domain and suffix. Each level is
shrunk towards the one above it through a beta-binomial prior, whose strength is estimated by the
method of moments from how much the groups of the level differ. A host passes if the lower bound
of its posterior is high enough; a host without labels has its domain's posterior, and so on.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.llm.base import written

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Reputation:
    """``z`` standard deviations below the posterior mean have to reach ``threshold``."""

    z: float = 1.645
    threshold: float = 0.5
    least_strength: float = 2.0
    most_strength: float = 1000.0


def url_host(url: str = "url") -> Column:
    found = F.coalesce(F.regexp_extract(url, URL, 1), F.lit(""))
    return F.translate(found, UPPER, LOWER)


def url_path(url: str = "url") -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def host_suffix(host: str = "host") -> Column:
    return F.substring_index(host, ".", -1)


def registered_domain(host: str = "host") -> Column:
    """The last two labels."""
    return F.substring_index(host, ".", -2)


def _strength(groups: DataFrame, by: Reputation) -> tuple[float, float]:
    """The prior strength that the differences between the groups speak for, and their mean."""
    sums = groups.agg(
        F.sum("n").cast("double").alias("n"), F.sum("good").cast("double").alias("good"),
        F.sum(F.col("good") * F.col("good") / F.col("n")).alias("squares"),
        F.count(F.lit(1)).cast("double").alias("groups"))
    mean = F.col("good") / F.col("n")
    spread = F.col("squares") / F.col("n") - mean * mean
    chance = mean * (1 - mean) * (F.col("groups") - 1) / F.col("n")
    between = spread - chance
    strength = F.when(between > 0, F.least(F.lit(by.most_strength), F.greatest(
        F.lit(by.least_strength), mean * (1 - mean) / between - 1))).otherwise(by.most_strength)
    return tuple(sums.select(F.coalesce(strength, F.lit(by.most_strength)),
                             F.coalesce(mean, F.lit(0.5))).first())


def host_reputation(hosts: DataFrame, outcomes: DataFrame,
                    by: Reputation = Reputation()) -> DataFrame:
    """``host, n_labelled, posterior_mean, posterior_bound`` of every host.

    ``hosts`` has distinct hosts, ``outcomes`` has ``host, n, good`` of hosts with labels. Without
    any label the mean is 0.5 under the strongest prior. Two numbers a level reach the driver.
    """
    levels = hosts.join(outcomes, "host", "left").select(
        "host", registered_domain().alias("domain"), host_suffix().alias("suffix"),
        F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("good", F.lit(0)).alias("good"))
    levels = written(levels, "host-outcomes")
    domains = levels.groupBy("domain", "suffix").agg(
        F.sum("n").alias("dn"), F.sum("good").alias("dgood"))
    suffixes = domains.groupBy("suffix").agg(F.sum("dn").alias("sn"), F.sum("dgood").alias("sgood"))
    (of_suffixes, overall), (of_domains, _), (of_hosts, _) = (
        _strength(groups.where("n > 0"), by)
        for groups in (suffixes.select(F.col("sn").alias("n"), F.col("sgood").alias("good")),
                       domains.select(F.col("dn").alias("n"), F.col("dgood").alias("good")),
                       levels.select("n", "good")))

    def shrunk(strength: float, mean: Column, good: str, n: str) -> Column:
        return (F.lit(strength) * mean + F.col(good)) / (F.lit(strength) + F.col(n))

    suffixes = suffixes.withColumn(
        "suffix_mean", shrunk(of_suffixes, F.lit(overall), "sgood", "sn"))
    domains = domains.join(suffixes, "suffix").withColumn(
        "domain_mean", shrunk(of_domains, F.col("suffix_mean"), "dgood", "dn")).drop("suffix")
    mean = shrunk(of_hosts, F.col("domain_mean"), "good", "n")
    deviation = F.sqrt(mean * (1 - mean) / (F.lit(of_hosts) + F.col("n") + 1))
    return levels.join(domains, "domain").select(
        "host", F.col("n").alias("n_labelled"), mean.alias("posterior_mean"),
        (mean - F.lit(by.z) * deviation).alias("posterior_bound"))


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, rules`` of hosts under a rule: an array of ``(size, rule, verdict, path)`` from the
    longest rule down, ties by the rule's text. A host has as many keys to look up as labels."""
    at = F.instr("rule", "/")
    keyed = rules.where("rule is not null").distinct().select(
        F.when(at > 0, F.substring_index("rule", "/", 1)).otherwise(F.col("rule")).alias("key"),
        F.struct(F.length("rule").alias("size"), "rule", "verdict",
                 F.when(at > 0, F.expr("substring(rule, instr(rule, '/'))")).otherwise("")
                 .alias("path")).alias("found"))
    labels = F.split("host", r"\.")
    keys = F.transform(F.sequence(F.lit(1), F.size(labels)),
                       lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))
    return (
        hosts.select("host", F.explode(keys).alias("key"))
        .join(keyed, "key")
        .groupBy("host").agg(F.sort_array(F.collect_list("found"), asc=False).alias("rules"))
    )


def judge_pages(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str]],
                by: Reputation = Reputation()) -> DataFrame:
    """``page_id, host, path, rule, verdict, posterior_bound`` of every page.

    ``labels`` has ``page_id, good`` (0 or 1; rows with a null count for nothing), one outcome per
    row. ``rules`` are pairs of a verdict and ``host/path``. A null url, or one without ``://``, has
    an empty host and path; its verdict is the prior's. Repeated pages are judged each; other
    columns play no part; no pages give no rows.
    """
    spark = pages.sparkSession
    parsed = pages.select("page_id", url_host().alias("host"), url_path().alias("path"))
    outcomes = (
        parsed.join(labels.where("good is not null"), "page_id")
        .groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum("good").cast("long").alias("good"))
    )
    hosts = parsed.select("host").distinct()
    rule_table = spark.createDataFrame(list(rules) or [(None, None)], "verdict string, rule string")
    known = host_reputation(hosts, outcomes, by)
    table = written(known.join(host_rules(known.select("host"), rule_table), "host", "left"),
                    "host-reputation")
    fitting = F.get(F.filter("rules", lambda r: F.col("path").startswith(r["path"])), F.lit(0))
    method = F.when(F.col("posterior_bound") >= by.threshold, "allow").otherwise("block")
    return (
        parsed.join(table, "host", "left")
        .withColumn("fit", fitting)
        .select("page_id", "host", "path", F.col("fit.rule").alias("rule"),
                F.coalesce("fit.verdict", method).alias("verdict"),
                F.round("posterior_bound", 9).alias("posterior_bound"))
    )
