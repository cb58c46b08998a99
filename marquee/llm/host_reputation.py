"""URL filtering by rules and by empirical-Bayes reputation of hosts.

Labelled page outcomes are counted per host. Hosts shrink towards their registered domain,
domains towards their suffix, suffixes towards all pages: each level's beta prior has the mean
of the level above and a concentration fitted by moments, from how far siblings differ beyond
what counting noise explains. A host is blocked when the lower bound of its posterior rate of
bad pages exceeds what is tolerated, so that few or no labels never block a host by themselves.

Counts are combined before they are shuffled; pages meet their host's verdict in a join that
adaptive execution broadcasts if measured small, and splits at a hot host if not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import lower_ascii, written


def url_host(url: Column) -> Column:
    """Lower-cased (A-Z) host after the first ``://``; empty without one or for null."""
    return _after_scheme(url, r"^([^/?#]*)", lower=True)


def _after_scheme(url: Column, pattern: str, lower: bool = False) -> Column:
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    found = F.regexp_extract(rest, pattern, 1)
    found = lower_ascii(found) if lower else found
    return F.when(at > 0, found).otherwise("")


def url_path(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty without ``://`` or for null."""
    return _after_scheme(url, r"^[^/?#]*(/[^?#]*)")


def suffix_and_domain(host: Column, double_suffixes: Sequence[str] = ()) -> tuple[Column, Column]:
    """A host's suffix (its last label, or the longest fitting one of those given) and its registered
    domain, which has one label more. A host of too few labels is its own domain. A port belongs to
    neither. An IP address is its own domain; all addresses share a suffix that no name has."""
    name = F.regexp_replace(host, r":[0-9]*$", "")
    suffix = F.substring_index(name, ".", -1)
    domain = F.substring_index(name, ".", -2)
    for labels in sorted({longer.count(".") + 1 for longer in double_suffixes}):
        end = F.substring_index(name, ".", -labels)
        fits = end.isin([longer for longer in double_suffixes if longer.count(".") + 1 == labels])
        suffix = F.when(fits, end).otherwise(suffix)
        domain = F.when(fits, F.substring_index(name, ".", -labels - 1)).otherwise(domain)
    address = F.regexp_like(name, F.lit(r"^([0-9]{1,3}(\.[0-9]{1,3}){3}|\[.*\])$"))
    return F.when(address, "[ip]").otherwise(suffix), F.when(address, name).otherwise(domain)


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule of ``(verdict, host/path)``, and its verdict; null if none fits.

    A rule fits its host and all subdomains if the path starts with the rule's path. Of rules of
    one length the first given wins.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, text in sorted(rules, key=lambda r: len(r[1])):
        own, slash, rest = text.partition("/")
        fits = ((host == own) | F.endswith(host, F.lit("." + own))) & F.startswith(path, F.lit(slash + rest))
        rule = F.when(fits, text).otherwise(rule)
        verdict = F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def _concentration(children: DataFrame, parent: list[str]) -> float:
    """Prior weight of the parents' rate for their children, by the moments of the beta-binomial.

    Without spread beyond counting noise it is at its upper bound of 10,000 observations.
    """
    labelled = children.filter("n > 0")
    sums = labelled.groupBy(*parent).agg(
        F.sum("n").alias("total"),
        F.sum("bad").alias("total_bad"),
        F.sum(F.col("n") * F.col("n")).alias("squares"),
        F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("bad_squares"),
        F.count("*").alias("kids"),
    )
    rate = F.col("total_bad") / F.col("total")
    mixed = sums.filter((rate > 0) & (rate < 1))
    spread = (F.col("bad_squares") - F.col("total_bad") * rate) / (rate * (1 - rate))
    free = F.col("kids") - 1
    excess, room = mixed.agg(
        F.sum(spread - free), F.sum(F.col("total") - F.col("squares") / F.col("total") - free)
    ).first()
    if not excess or not room or room <= 0:
        return 10_000.0
    share = min(max(excess / room, 1e-4), 0.999)
    return 1 / share - 1


def host_posteriors(outcomes: DataFrame, double_suffixes: Sequence[str] = ()) -> DataFrame:
    """Posterior of the rate of bad pages per host.

    ``outcomes`` has ``host``, ``n`` labelled pages and ``bad`` ones among them, a row per host;
    hosts without labels get their domain's rate as mean. Returns ``host``, ``n``, ``bad``,
    ``alpha``, ``beta``.
    """
    suffix, domain = suffix_and_domain(F.col("host"), double_suffixes)
    hosts = written(
        outcomes.select("host", "n", "bad", domain.alias("domain"), suffix.alias("suffix")), "hosts"
    )
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = hosts.groupBy("suffix", "domain").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)
    n, bad = suffixes.agg(F.sum("n"), F.sum("bad")).first()
    overall = ((bad or 0) + 0.5) / ((n or 0) + 1)

    def pooled(frame: DataFrame, keys: list[str], weight: Column) -> DataFrame:
        """Rate of each group under its parent's ``prior``, and the weight behind that rate: what
        is known of the parent bounds what the prior weighs."""
        known = weight + F.col("n")
        rate = (F.col("bad") + F.col("prior") * weight) / known
        return frame.select(*keys, rate.alias("prior"), known.alias("known"))

    def under(weight: float) -> Column:
        return 1 / (1 / F.lit(weight) + 1 / F.col("known"))

    top = _concentration(suffixes.withColumn("every", F.lit(1)), ["every"])
    everywhere = suffixes.withColumns({"prior": F.lit(overall), "known": F.lit((n or 0) + 1.0)})
    rated = pooled(everywhere, ["suffix"], under(top))
    weight = under(_concentration(domains, ["suffix"]))
    rated = pooled(domains.join(rated, "suffix"), ["suffix", "domain"], weight)
    weight = under(_concentration(hosts, ["suffix", "domain"]))
    return hosts.join(rated, ["suffix", "domain"]).select(
        "host",
        "n",
        "bad",
        (F.col("bad") + F.col("prior") * weight).alias("alpha"),
        (F.col("n") - F.col("bad") + (1 - F.col("prior")) * weight).alias("beta"),
    )


def lower_bound(alpha: Column, beta: Column, z: float) -> Column:
    """``z`` standard deviations below the mean of a beta distribution, 0 at least."""
    total = alpha + beta
    return F.greatest(F.lit(0.0), alpha / total - z * F.sqrt(alpha * beta / (total * total * (total + 1))))


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[tuple[str, str]] = (),
    id_column: str = "page_id",
    url_column: str = "url",
    tolerated: float = 0.25,
    z: float = 1.64,
    double_suffixes: Sequence[str] = (),
) -> DataFrame:
    """Verdict per page: the longest fitting rule's, else by the host's reputation.

    ``outcomes`` holds labelled pages as ``page_id`` and boolean ``bad``; repeated rows count
    each, rows with a null in either are left out. Returns id, ``host``, ``path``, ``rule``,
    ``verdict`` and ``bad_bound``, the lower posterior bound of the host's rate of bad pages.
    Pages with null or odd urls have empty host and path, share the reputation of the empty host
    and are kept; repeated rows stay; an empty table gives no rows; other columns are ignored.
    """
    located = pages.select(
        F.col(id_column).alias("page_id"),
        url_host(F.col(url_column)).alias("host"),
        url_path(F.col(url_column)).alias("path"),
    )
    marks = (
        outcomes.filter("page_id is not null and bad is not null")
        .groupBy("page_id")
        .agg(F.count("*").alias("n"), F.count_if("bad").alias("bad"))
    )
    none = F.lit(0).cast("long")
    labelled = located.select("page_id", "host").join(marks, "page_id").select("host", "n", "bad")
    every = located.select("host", none.alias("n"), none.alias("bad"))
    counts = every.unionByName(labelled).groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    bounds = host_posteriors(counts, double_suffixes).select(
        "host", lower_bound(F.col("alpha"), F.col("beta"), z).alias("bad_bound")
    )
    rule, ruled = longest_rule(F.col("host"), F.col("path"), rules)
    learnt = F.when(F.col("bad_bound") > tolerated, "block").otherwise("allow")
    return located.join(bounds, "host").select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(ruled, learnt).alias("verdict"),
        "bad_bound",
    )
