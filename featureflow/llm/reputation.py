"""Verdicts on page urls: rules first, else the reputation of the host.

Reputation is the share of bad pages among a host's labelled ones, shrunk step by step: a suffix's share
towards that of all pages, a registered domain's towards its suffix's, a host's towards its domain's.
Each step is a beta-binomial update whose prior has the parent's mean; how strongly it pulls follows
from how much the shares of that step scatter around their parents beyond chance. A host is blocked if
even the lower bound of its posterior lies above the share that is tolerated.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featureflow.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rules are a configuration of moderate size; each becomes one condition.
Rule = tuple[str, str]


@dataclass(frozen=True)
class Settings:
    #: Share of bad pages that is tolerated, and standard deviations from the mean to the lower bound.
    tolerated: float = 0.25
    deviations: float = 1.645
    #: Suffixes of two labels under which names are registered.
    second_level: tuple[str, ...] = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "co.nz", "com.br", "co.in", "co.za")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_after_scheme(url), "^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def with_levels(hosts: DataFrame, settings: Settings) -> DataFrame:
    """``hosts`` with ``domain`` and ``suffix``; an address of digits, or a bare name, is its own domain."""
    name = F.regexp_replace(F.regexp_replace("host", "^.*@", ""), ":[0-9]*$", "")
    labels = F.split("_name", "\\.")
    n = F.size("_labels")
    last = lambda k: F.array_join(F.slice("_labels", F.greatest(n - k + 1, F.lit(1)), F.least(n, k)), ".")
    depth = F.when(last(F.lit(2)).isin(*settings.second_level), 2).otherwise(1)
    alone = F.col("_name").rlike("^[0-9.]*$|^\\[") | (n <= F.col("_depth"))
    return (
        hosts.withColumn("_name", name)
        .withColumn("_labels", labels)
        .withColumn("_depth", depth)
        .withColumn("domain", F.when(alone, F.col("_name")).otherwise(last(F.col("_depth") + 1)))
        .withColumn("suffix", F.when(alone, "").otherwise(last(F.col("_depth"))))
        .drop("_name", "_labels", "_depth")
    )


def outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, n, bad): labelled pages of each host and the bad ones among them; hosts without labels too.

    A label belongs to the page whose page_id is its doc_id. A page is bad if any of its labels says
    quality 0 or toxic; labels that say neither are no labels.
    """
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"))
    marks = (
        labels.where("doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)")
        .groupBy(F.col("doc_id").alias("page_id"))
        .agg(F.max(F.when((F.col("quality") <= 0) | (F.col("toxic") > 0), 1).otherwise(0)).alias("bad"))
    )
    labelled = urls.where("page_id IS NOT NULL").join(marks, "page_id").groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
    zero = F.lit(0).cast("long")
    every = urls.groupBy("host").agg(zero.alias("n"), zero.alias("bad"))
    return every.unionByName(labelled).groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))


def strength(groups: DataFrame) -> float:
    """How many pages the parent's mean ``m`` counts for, from the scatter of (n, bad) around it.

    The correlation within groups is estimated by moments and kept within [0.0001, 0.9999].
    """
    spread = F.col("m") * (1 - F.col("m"))
    row = (
        groups.where((F.col("n") > 0) & (spread > 0))
        .agg(
            F.sum(F.pow(F.col("bad") - F.col("n") * F.col("m"), 2) / spread).alias("seen"),
            F.sum("n").alias("n"),
            F.sum(F.col("n") * (F.col("n") - 1)).alias("pairs"),
        )
        .first()
    )
    if not row["pairs"]:
        return 1.0
    within = min(0.9999, max(0.0001, (row["seen"] - row["n"]) / row["pairs"]))
    return 1 / within - 1


def reputations(pages: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(host, domain, suffix, n, bad, share, bound) of every host that occurs."""
    hosts = stored(with_levels(outcomes(pages, labels), settings), "host-outcomes")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    # One bad and one good page more than seen, so that the mean is never 0 or 1.
    level: DataFrame = None
    m: Column = F.lit(((total["bad"] or 0) + 1) / ((total["n"] or 0) + 2))
    for keys in (["suffix"], ["domain", "suffix"], ["host", "domain", "suffix"]):
        groups = hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        groups = groups.withColumn("m", m) if level is None else groups.join(level, keys[1:])
        groups = stored(groups, "reputation-" + keys[0])
        pull = strength(groups)
        a = F.lit(pull) * F.col("m") + F.col("bad")
        b = F.lit(pull) * (1 - F.col("m")) + F.col("n") - F.col("bad")
        groups = groups.withColumn("a", a).withColumn("b", b).withColumn("share", F.col("a") / (F.col("a") + F.col("b")))
        level = groups.select(*keys, F.col("share").alias("m"))
    deviation = F.sqrt(F.col("share") * (1 - F.col("share")) / (F.col("a") + F.col("b") + 1))
    bound = F.col("share") - settings.deviations * deviation
    return groups.select("host", "domain", "suffix", "n", "bad", "share", bound.alias("bound"))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Longest rule that fits and its verdict, both null if none does.

    Rules are (verdict, `host/path`). Of equally long ones the one with the longer host wins, then block.
    """
    order = sorted(rules, key=lambda r: (-len(r[1]), -r[1].index("/"), r[0] != "block", r[1]))
    name = verdict = F.lit(None).cast("string")
    for said, rule in reversed(order):
        end, start = rule.split("/", 1)[0], "/" + rule.split("/", 1)[1]
        fits = ((host == end) | host.endswith("." + end)) & path.startswith(start)
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, said).otherwise(verdict)
    return name, verdict


def judge(pages: DataFrame, labels: DataFrame, rules: Sequence[Rule] = (), settings: Settings = Settings()) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, n, bad, share and bound of its host.

    A url that is null or without `://` has an empty host and path, no rule, and the reputation of all
    pages with an empty host. Repeated rows repeat the result; without labels no host is blocked.
    """
    known = stored(reputations(pages, labels, settings), "reputations").withColumnRenamed("host", "_host")
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    # Two plain scans, so that a host with very many pages can be split when joined.
    urls = urls.select("page_id", F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"))
    rows = urls.join(known, F.col("host") == F.col("_host"), "left")
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bound") > settings.tolerated, "block").otherwise("allow")
    return rows.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(said, own).alias("verdict"), "n", "bad", "share", "bound")
