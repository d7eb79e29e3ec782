"""URL filter by host reputation, with rules for hosts and paths on top.

Labelled outcomes of pages (bad or not) are counted per host. A beta-binomial
prior is fitted by moments at each level and shrinks the level below it: all
pages to suffix, suffix to registered domain, domain to host. A host is blocked
if the lower bound of its posterior share of bad pages, mean less ``Z`` standard
deviations, is above ``limit``; a host without labelled pages has its domain's
mean as prior, and so on up. Only counts per host are shuffled after the join
with the outcomes.

Defined cases: null urls and urls without ``://`` have empty host and path and
are judged like any host; hosts without a dot are their own domain and suffix; a
page without outcome counts in no share; repeated rows count, and are judged,
each; no outcomes at all block nothing.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import stored

# Fixed value: standard deviations between mean and lower bound (one-sided 95 percent).
Z = 1.645
MAX_RULES = 1000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def domain_of(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def rule_for(host: Column, path: Column, rules: Iterable[tuple[str, str, str]]) -> Column:
    """(rule, verdict) of the longest rule (verdict, host, path) that fits, else null."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    if len(ordered) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    fits = [
        F.when(
            ((host == name) | host.endswith(f".{name}")) & path.startswith(start),
            F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict")),
        )
        for verdict, name, start in ordered
    ]
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule: string, verdict: string>")


def _strength(groups: DataFrame, parent: str) -> Column:
    """Prior strength by moments: how much the groups' shares spread around their parents' means."""
    spread = F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col(parent), 2) / (F.col(parent) * (1 - F.col(parent)))
    over = groups.where("n > 0").agg(
        (F.sum(spread) - F.count("*")).alias("over"), F.sum(F.col("n") - 1).alias("room")
    )
    rho = F.when(F.col("room") > 0, F.col("over") / F.col("room")).otherwise(0.0)
    rho = F.greatest(F.lit(0.001), F.least(F.lit(0.999), rho))
    return over.select(1 / rho - 1).scalar()


def reputations(outcomes: DataFrame) -> DataFrame:
    """Rows (host, n, bad) of each host with the posterior ``bound`` of its share of bad pages."""
    hosts = stored(
        outcomes.groupBy("host").agg(
            F.count("bad").alias("n"), F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0)).alias("bad")
        ),
        "hosts",
    )
    hosts = hosts.withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
    everything = hosts.agg(((F.sum("bad") + 0.5) / (F.sum("n") + 1)).alias("mean")).scalar()
    parent = {"suffix": None, "domain": "suffix", "host": "domain"}
    means: dict[str, DataFrame] = {}
    for level, above in parent.items():
        keys = [level] + ([above] if above else [])
        groups = hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        if above:
            groups = groups.join(means[above], above).withColumnRenamed(f"{above}_mean", "prior")
        else:
            groups = groups.withColumn("prior", everything)
        groups = groups.withColumn("strength", _strength(groups, "prior"))
        a = F.col("bad") + F.col("strength") * F.col("prior")
        both = F.col("n") + F.col("strength")
        if level == "host":
            share = a / both
            return groups.select("host", "n", "bad", (share - Z * F.sqrt(share * (1 - share) / (both + 1))).alias("bound"))
        means[level] = groups.select(level, (a / both).alias(f"{level}_mean"))
    raise AssertionError("no host level")


def judge(
    pages: DataFrame, outcomes: DataFrame, rules: Iterable[tuple[str, str, str]] = (), limit: float = 0.5
) -> DataFrame:
    """Verdicts on ``pages`` (page_id, url) given ``outcomes`` (url, bad), ``bad`` null where unknown.

    Every host of ``pages`` should be in ``outcomes``; a host that is not gets its verdict from no label: allow.
    """
    scored = reputations(outcomes.select(host_of(F.col("url")).alias("host"), F.col("bad")))
    rows = pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    ).withColumn("found", rule_for(F.col("host"), F.col("path"), rules))
    by_host = F.when(F.col("bound") > limit, "block").otherwise("allow")
    return rows.join(scored, "host", "left").select(
        "page_id",
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", by_host).alias("verdict"),
        F.coalesce("n", F.lit(0)).alias("host_labelled"),
        F.coalesce("bad", F.lit(0)).alias("host_bad"),
    )


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, bad) of all pages: a page shows the document whose number ends its path.

    ``bad`` is 1 if any label of the document says toxic or low quality, 0 if none does, null without label.
    """
    number = F.regexp_extract(path_of(F.col("url")), r"/([0-9]{1,18})(\.[a-z]+)?/?$", 1)
    numbered = pages.select("url", number.try_cast("long").alias("doc_id"))
    bad = F.coalesce(F.col("toxic") == 1, F.lit(False)) | F.coalesce(F.col("quality") == 0, F.lit(False))
    known = (
        labels.where(F.col("doc_id").isNotNull() & (F.col("toxic").isNotNull() | F.col("quality").isNotNull()))
        .groupBy("doc_id")
        .agg(F.max(bad.cast("int")).alias("bad"))
    )
    labelled = numbered.where("doc_id is not null").join(known, "doc_id", "left").select("url", "bad")
    return labelled.unionByName(numbered.where("doc_id is null").select("url", F.lit(None).cast("int").alias("bad")))
