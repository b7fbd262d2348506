"""URL filters: explicit rules, then host reputation by empirical Bayes. DataFrame functions only.

Labelled page outcomes are counted per host, registered domain and suffix. From the suffix down every
level's bad rate is shrunk towards its parent's with a beta-binomial prior whose strength is
estimated from how much the level's rates differ beyond chance; a host without labels has its domain's
rate, with the prior's uncertainty. A page is blocked if even the lower posterior bound of its host's
bad rate is above a limit.

Counts combine map-side, so a host may hold any share of the pages; the per-level totals that give the
prior strengths are one row, and the per-level tables are written, so that no plan repeats another. Hosts are joined back to pages by Spark's choice of join (with skewed
partitions split).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEVELS = ("suffix", "domain", "host")
# Labels under which two-letter country domains register names (``co.uk``, ``com.au``, ``or.jp``).
SECOND_LEVEL = ("ac", "co", "com", "edu", "go", "gob", "gov", "ltd", "mil", "ne", "net", "or", "org", "plc", "sch")
# Bounds of the estimated correlation of outcomes within a group; strength = 1 / rho - 1.
RHO_LEAST, RHO_MOST = 1e-4, 0.5


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else ''."""
    return F.translate(F.coalesce(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; '' for a null URL or one without ``://``."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def _by_labels(host: Column, n: int, second_level: Sequence[str]) -> Column:
    """The last ``n`` labels, one more where names are registered under two; a numeric address as it is."""
    last = F.substring_index(host, ".", -n)
    if second_level:
        two = host.rlike(rf"(?:^|\.)(?:{'|'.join(second_level)})\.[a-z][a-z]$")
        last = F.when(two, F.substring_index(host, ".", -n - 1)).otherwise(last)
    return F.when(host.rlike(r"^[0-9.:\[\]]*$"), host).otherwise(last)


def domain_of(host: Column, second_level: Sequence[str] = SECOND_LEVEL) -> Column:
    """The suffix and one label; a numeric address, a suffix or a single label is its own domain."""
    return _by_labels(host, 2, second_level)


def suffix_of(host: Column, second_level: Sequence[str] = SECOND_LEVEL) -> Column:
    """The last label, or two such as ``co.uk``; a numeric address is its own suffix."""
    return _by_labels(host, 1, second_level)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does.

    A rule is (``host/path``, verdict); it fits its host and all subdomains of it where the path starts
    with the rule's. A list of some hundred rules at most: the rules become one expression.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, outcome in sorted(rules, key=lambda r: len(r[0])):
        of, slash, start = text.partition("/")
        fits = ((host == of) | host.endswith(f".{of}")) & path.startswith(slash + start)
        rule = F.when(fits, text).otherwise(rule)
        verdict = F.when(fits, outcome).otherwise(verdict)
    return rule, verdict


def reputation(outcomes: DataFrame) -> DataFrame:
    """Posterior bad rate per host from (host, bad) rows, ``bad`` 0 or 1.

    Columns: host, domain, suffix, n, n_bad, and per level the shrunk rate (``suffix_rate``,
    ``domain_rate``, ``host_rate``) and the weight of evidence behind it (``*_weight``: labels plus prior
    strength), as well as ``all_rate``.
    """
    hosts = outcomes.filter(F.col("bad").isNotNull()).groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").alias("n_bad"))
    hosts = hosts.withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
    hosts = materialise(hosts, "url-hosts")
    prior = hosts.agg((F.coalesce(F.sum("n_bad"), F.lit(0)) + 1).alias("b"), (F.coalesce(F.sum("n"), F.lit(0)) + 2).alias("a"))
    table = hosts.crossJoin(prior.select((F.col("b") / F.col("a")).alias("all_rate")))  # one row
    parent = "all"
    for level in LEVELS:
        groups = table.groupBy(level, f"{parent}_rate").agg(F.sum("n").alias("_n"), F.sum("n_bad").alias("_bad"))
        groups = materialise(groups, f"url-{level}")
        rate, n = F.col(f"{parent}_rate"), F.col("_n")
        chance = rate * (1 - rate) * n
        moments = groups.agg(
            F.sum(F.pow(F.col("_bad") - n * rate, 2) - chance).alias("_beyond"),
            F.sum(chance * (n - 1)).alias("_pairs"),
        )
        rho = F.when(F.col("_pairs") > 0, F.col("_beyond") / F.col("_pairs")).otherwise(F.lit(RHO_LEAST))
        strength = moments.select((1 / F.greatest(F.lit(RHO_LEAST), F.least(F.lit(RHO_MOST), rho)) - 1).alias("_strength"))
        shrunk = groups.crossJoin(strength).select(  # one row
            level,
            ((F.col("_bad") + F.col("_strength") * rate) / (n + F.col("_strength"))).alias(f"{level}_rate"),
            (n + F.col("_strength")).alias(f"{level}_weight"),
            F.col("_strength").alias(f"{level}_strength"),
        )
        table = materialise(table.join(shrunk, level), f"url-rated-{level}")
        parent = level
    return table


def lower_bound(rate: Column, weight: Column, z: float) -> Column:
    """Lower posterior bound of a beta distribution with this mean and weight, by its deviation."""
    return F.greatest(F.lit(0.0), rate - z * F.sqrt(rate * (1 - rate) / (weight + 1)))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], outcomes: DataFrame, limit: float = 0.5, z: float = 1.645) -> DataFrame:
    """One row per page (page_id, url): host, path, rule, verdict, and the reputation behind it.

    ``outcomes`` are (host, bad) rows of labelled pages. A null URL, or one without ``://``, has empty host
    and path, which is a host like any other. A host without labels is judged by the rate of its domain,
    then its suffix, then of all; with no labels at all the rate is 1/2 and its bound too low to block.
    Repeated rows are judged alike; other columns are ignored.
    """
    url = F.col("url")
    judged = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    rule, rule_verdict = matching_rule(F.col("host"), F.col("path"), rules)
    judged = judged.withColumns({"rule": rule, "_rule_verdict": rule_verdict})
    known = reputation(outcomes)
    hosts = judged.select("host").distinct().withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
    by_host = known.select("host", "host_rate", "host_weight")
    by_domain = known.select("domain", "domain_rate", "host_strength").distinct()
    by_suffix = known.select("suffix", "suffix_rate", "domain_strength").distinct()
    rated = hosts.join(by_suffix, "suffix", "left").join(by_domain, "domain", "left").join(by_host, "host", "left")
    rate = F.coalesce("host_rate", "domain_rate", "suffix_rate", F.lit(0.5))
    weight = F.coalesce("host_weight", "host_strength", "domain_strength", F.lit(0.0))
    rated = rated.select("host", rate.alias("bad_rate"), lower_bound(rate, weight, z).alias("bad_rate_least"))
    verdict = F.coalesce("_rule_verdict", F.when(F.col("bad_rate_least") > limit, "block").otherwise("allow"))
    return judged.join(rated, "host", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"), "bad_rate", "bad_rate_least")
