"""URL filter: rules first, then the host's empirical-Bayes reputation (DataFrame functions only).

Rules (``host/path`` with a verdict) fit a host and its subdomains where the
url's path starts with the rule's; the longest wins.  Pages that a rule judges
are the labelled outcomes.  For the rest, block rates are shrunk down the chain
suffix, registered domain, host: each level's rate has a beta prior with the
parent's posterior mean, whose strength is fitted to the spread of the level's
rates by moments and bounded by the evidence behind the parent's rate.  A page is blocked where the lower ``z`` bound of its host's
posterior block rate exceeds ``limit``; a host without labelled pages, in its
domain or suffix either, has only wide priors and is allowed.

Counts are pre-aggregated per host, so a hot host is one row per task; the
rates then go back by a join on the host.

Edge cases: null urls and urls without ``://`` have an empty host and path and
no rule; ports and user names stay in the host and are cut for the domain; IP
addresses are their own domain; ties between equally long rules go to block;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnscope.llm.wrappers import host_of
from txnscope.session import materialize

#: Second-level names under which domains are registered.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; '' without ``://``."""
    at = F.locate("://", url)
    rest = F.substring(url, at + 3, F.length(url))
    return F.coalesce(F.when(at > 0, F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)), F.lit(""))


def split_host(host: Column) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host."""
    bare = F.regexp_replace(F.regexp_replace(host, r"\A.*@", ""), r"(:[0-9]*|\.)\z", "")
    labels = F.split(bare, r"\.")
    n = F.size(labels)
    second = F.get(labels, n - 2).isin(*SECOND_LEVEL) & (F.length(F.get(labels, n - 1)) == 2) & (n >= 3)
    keep = F.when(second, 3).otherwise(2)
    is_ip = bare.rlike(r"\A([0-9.]+|\[.*\])\z")
    domain = F.when(is_ip | (n <= 1), bare).otherwise(F.array_join(F.slice(labels, F.greatest(n - keep + 1, F.lit(1)), keep), "."))
    suffix = F.when(is_ip | (n <= 1), F.lit("")).otherwise(
        F.array_join(F.slice(labels, F.greatest(n - keep + 2, F.lit(1)), keep - 1), "."))
    return domain, suffix


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """struct<size, verdict, rule> of the longest rule that fits, null if none does.  ``rules``: (verdict, 'host/path')."""
    hits = []
    for verdict, rule in rules:
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        hits.append(F.when(fits, F.struct(F.lit(len(rule)).alias("size"), F.lit(verdict).alias("verdict"),
                                          F.lit(rule).alias("rule"))))
    if not hits:
        return F.lit(None).cast("struct<size:int,verdict:string,rule:string>")
    return F.greatest(*hits) if len(hits) > 1 else hits[0]


def strength(groups: DataFrame, n: str, k: str, mean: str, most: float = 1e4) -> float:
    """Concentration of the beta prior of a level, from groups with ``n`` outcomes, ``k`` blocked and prior mean ``mean``."""
    m = F.col(mean)
    got = groups.where(F.col(n) > 0).agg(
        F.sum(F.col(n) * F.pow(F.col(k) / F.col(n) - m, 2)), F.sum(m * (1 - m)), F.sum(F.col(n) * m * (1 - m))).first()
    if not got[0] or not got[2] or got[2] <= got[1]:
        return 2.0
    share = min(max((got[0] - got[1]) / (got[2] - got[1]), 1 / (most + 1)), 0.99)    # between-group share of the variance
    return max(1 / share - 1, 2.0)                  # at least as strong as a uniform prior


def reputation(outcomes: DataFrame, z: float = 1.96) -> DataFrame:
    """host, n, blocked, rate (posterior mean), bound (lower) for each host of ``outcomes`` (host, n, blocked)."""
    domain, suffix = split_host(F.col("host"))
    hosts = outcomes.select("host", "n", "blocked", domain.alias("domain"), suffix.alias("suffix"))
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n_d"), F.sum("blocked").alias("k_d"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n_d").alias("n_s"), F.sum("k_d").alias("k_s"))
    n, k = suffixes.agg(F.coalesce(F.sum("n_s"), F.lit(0)), F.coalesce(F.sum("k_s"), F.lit(0))).first()
    suffixes = suffixes.withColumn("m", F.lit((k + 0.5) / (n + 1))).withColumn("c", F.lit(float(n + 1)))
    levels = []
    for groups, keys, nn, kk, below in ((suffixes, None, "n_s", "k_s", domains), (None, "suffix", "n_d", "k_d", hosts),
                                        (None, "domain", "n", "blocked", None)):
        groups = levels[-1] if groups is None else groups
        s = strength(groups, nn, kk, "m")
        # A prior is no stronger than what its parent's rate rests on.
        prior = F.least(F.lit(s), F.col("c"))
        posterior = groups.withColumn("a", F.col("m") * prior + F.col(kk)) \
            .withColumn("b", (1 - F.col("m")) * prior + F.col(nn) - F.col(kk)) \
            .withColumn("c", F.col("a") + F.col("b")).withColumn("m", F.col("a") / F.col("c"))
        if below is not None:
            on = ["suffix"] if below is domains else ["suffix", "domain"]
            levels.append(below.join(posterior.select(*on, "m", "c"), on))
        else:
            total = F.col("a") + F.col("b")
            sd = F.sqrt(F.col("a") * F.col("b") / (total * total * (total + 1)))
            return posterior.select("host", "n", "blocked", F.col("m").alias("rate"),
                                    F.greatest(F.col("m") - z * sd, F.lit(0.0)).alias("bound"))
    raise AssertionError


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], limit: float = 0.5, z: float = 1.96,
          url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule and verdict (allow or block).  A rule list is small: it becomes one expression."""
    u = F.col(url).cast("string")
    cols = [F.col(c).alias(f"__in_{c}") for c in pages.columns]
    rows = pages.select(*cols, host_of(u).alias("host"), path_of(u).alias("path"))
    rows = rows.withColumn("__r", rule_for(F.col("host"), F.col("path"), rules))
    seen = F.col("__r").isNotNull().cast("bigint")
    outcomes = rows.groupBy("host").agg(
        F.sum(seen).alias("n"), F.sum(F.coalesce((F.col("__r")["verdict"] == "block").cast("bigint"), F.lit(0))).alias("blocked"))
    # One narrow row a host; every level reads these, not the pages.
    outcomes = materialize(outcomes, "host-outcomes")
    rates = reputation(outcomes, z).select("host", F.col("bound").alias("__bound"))
    own = F.when(F.col("__bound") > limit, "block").otherwise("allow")
    out = rows.join(rates, "host", "left")
    have = [F.col(f"__in_{c}").alias(c) for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    return out.select(*have, "host", "path", F.col("__r")["rule"].alias("rule"),
                      F.coalesce(F.col("__r")["verdict"], own).alias("verdict"))


def judge_sql(rules: Sequence[tuple[str, str]], limit: float = 0.5, z: float = 1.96) -> str:
    """The same verdicts of the table ``pages`` in DuckDB."""
    def fits(rule: str) -> str:
        name, _, rest = rule.partition("/")
        return f"(host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '/{rest}')"
    hits = ", ".join(f"CASE WHEN {fits(r)} THEN {{'size': {len(r)}, 'verdict': '{v}', 'rule': '{r}'}} END" for v, r in rules)
    second = ", ".join(f"'{x}'" for x in SECOND_LEVEL)

    def level(name: str, groups: str, n: str, k: str) -> str:
        """Posterior mean m and weight c of the groups, from their prior m and c."""
        return f"""{name}_sums AS (SELECT sum({n} * power({k} / {n}::DOUBLE - m, 2)) AS s1, sum(m * (1 - m)) AS s2,
          sum({n} * m * (1 - m)) AS s3 FROM {groups} WHERE {n} > 0),
        {name}_strength AS (SELECT CASE WHEN coalesce(s1, 0) = 0 OR coalesce(s3, 0) = 0 OR s3 <= s2 THEN 2.0::DOUBLE ELSE greatest(
          1 / least(greatest((s1 - s2) / (s3 - s2), 1 / 10001.0::DOUBLE), 0.99::DOUBLE) - 1, 2.0::DOUBLE) END AS s FROM {name}_sums),
        {name}_ab AS (SELECT g.* EXCLUDE (m, c), m * least(s, c) + {k} AS a, (1 - m) * least(s, c) + {n} - {k} AS b
          FROM {groups} g, {name}_strength),
        {name} AS (SELECT * EXCLUDE (a, b), a, b, a + b AS c, a / (a + b) AS m FROM {name}_ab)"""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""WITH cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) END AS rest FROM pages),
        parts AS (SELECT page_id, coalesce(translate(regexp_extract(rest, '(?s)\A([^/?#]*)', 1), '{upper}', '{lower}'), '') AS host,
          coalesce(regexp_extract(rest, '(?s)\A[^/?#]*([^?#]*)', 1), '') AS path FROM cut),
        ruled AS (SELECT *, list_max([{hits}]) AS r FROM parts),
        outcomes AS (SELECT host, count(r) AS n, count(*) FILTER (WHERE r.verdict = 'block') AS blocked FROM ruled GROUP BY host),
        bare AS (SELECT *, regexp_replace(regexp_replace(host, '\A.*@', ''), '(:[0-9]*|\.)\z', '') AS bare FROM outcomes),
        labels AS (SELECT *, string_split(bare, '.') AS l, len(string_split(bare, '.')) AS k FROM bare),
        named AS (SELECT *, regexp_matches(bare, '\A([0-9.]+|\[.*\])\z') OR k <= 1 AS whole,
          CASE WHEN k >= 3 AND l[k - 1] IN ({second}) AND length(l[k]) = 2 THEN 3 ELSE 2 END AS keep FROM labels),
        hosts AS (SELECT host, n, blocked, CASE WHEN whole THEN bare ELSE array_to_string(l[greatest(k - keep + 1, 1):k], '.') END AS domain,
          CASE WHEN whole THEN '' ELSE array_to_string(l[greatest(k - keep + 2, 1):k], '.') END AS suffix FROM named),
        domains0 AS (SELECT suffix, domain, sum(n) AS n_d, sum(blocked) AS k_d FROM hosts GROUP BY suffix, domain),
        suffixes0 AS (SELECT suffix, sum(n_d) AS n_s, sum(k_d) AS k_s FROM domains0 GROUP BY suffix),
        top AS (SELECT (coalesce(sum(k_s), 0) + 0.5) / (coalesce(sum(n_s), 0) + 1)::DOUBLE AS m, (coalesce(sum(n_s), 0) + 1)::DOUBLE AS c
          FROM suffixes0),
        suffixes1 AS (SELECT s.*, m, c FROM suffixes0 s, top),
        {level("suffixes", "suffixes1", "n_s", "k_s")},
        domains1 AS (SELECT d.*, s.m, s.c FROM domains0 d JOIN suffixes s USING (suffix)),
        {level("domains", "domains1", "n_d", "k_d")},
        hosts1 AS (SELECT h.*, d.m, d.c FROM hosts h JOIN domains d USING (suffix, domain)),
        {level("rated", "hosts1", "n", "blocked")},
        bounds AS (SELECT host, greatest(m - {z} * sqrt(a * b / (c * c * (c + 1))), 0) AS bound FROM rated)
        SELECT page_id, p.host, path, r.rule AS rule, coalesce(r.verdict, CASE WHEN bound > {limit} THEN 'block' ELSE 'allow' END) AS verdict
        FROM ruled p JOIN bounds b ON p.host = b.host"""
