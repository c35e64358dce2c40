"""URL filters: rules by host and path, and a reputation of hosts learnt from labelled pages.

The share of bad pages of a host is shrunk towards that of its registered domain, the domain's
towards that of its suffix, and the suffix's towards that of all labelled pages. Each level is a
beta-binomial model: its prior mean is the posterior mean one level up, its prior weight comes
from the spread of the level's own counts (method of moments). A host is blocked if the lower
bound of its posterior is beyond the accepted share: few bad pages alone block nothing.

DataFrame functions only. Pages are read for their id and url; counts are summed in the map
tasks; the tables of hosts and of domains are stored, so that Spark can split a hot host or
domain when they are joined.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.llm.common import stored

MOST_RULES = 1_000
# A host goes if, with the given number of deviations to spare, more than this share is bad.
ACCEPTED_SHARE = 0.3
DEVIATIONS = 1.645
# Limits of the correlation of two pages of one group; it stands for the prior's weight.
CORRELATIONS = (0.001, 0.999)
# Second-level names below which a country's registry gives out domains.
REGISTRY_NAMES = ("ac", "co", "com", "edu", "gov", "net", "org")


class Rule(NamedTuple):
    """A verdict on the pages of a host and its subdomains whose path starts with `path`."""
    verdict: str
    host: str
    path: str


# The rules of the registered query.
RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"),
         Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands after the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case, and
    what follows it up to `?`, `#` or the end. Both are empty without `://` or without a url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return _lower(host), path


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null where none does.

    Of rules of one length that with the longer host counts, and of equal ones the blocking one.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules; up to {MOST_RULES} become part of the plan")
    ordered = sorted(rules, key=lambda r: (-len(r.host) - len(r.path), -len(r.host), r.verdict != "block"))
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in reversed(ordered):
        fits = (host == rule.host) | host.endswith(f".{rule.host}")
        fits = fits & path.startswith(rule.path)
        text = F.when(fits, F.lit(rule.host + rule.path)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def domain_and_suffix(host: Column) -> tuple[Column, Column]:
    """The registered domain and the suffix of a host.

    The suffix is the last label, or the last two if a country's registry gives out domains
    there; the domain has one label more. User, port and a final dot are left aside. A number
    address is its own domain, and its suffix is empty; so is a name without a dot.
    """
    name = F.regexp_replace(host, r"^.*@|:[0-9]*$", "")
    name = F.regexp_replace(name, r"\.$", "")
    suffix = F.regexp_extract(
        name, rf"(?:^|\.)((?:(?:{'|'.join(REGISTRY_NAMES)})\.[a-z]{{2}})|[^.]+)$", 1)
    number = name.rlike(r"^[0-9.]+$|^\[") | ~F.contains(name, F.lit("."))
    below = F.substr(name, F.lit(1), F.greatest(F.length(name) - F.length(suffix) - 1, F.lit(0)))
    domain = F.concat(F.regexp_extract(below, r"[^.]*$", 0), F.lit("."), suffix)
    own = number | (below == "")
    return F.when(own, name).otherwise(domain), F.when(own, F.lit("")).otherwise(suffix)


def outcomes(labels: DataFrame) -> DataFrame:
    """One row for each labelled id: whether a label calls it poor or toxic.

    Rows without id, or with neither label, say nothing; repeated ids are bad if any row is.
    """
    bad = F.greatest((F.col("quality") == 0).cast("int"), (F.col("toxic") == 1).cast("int"))
    return (labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
            .where(F.col("page_id").isNotNull() & F.col("bad").isNotNull())
            .groupBy("page_id").agg(F.max("bad").alias("bad")))


def _precision(groups: DataFrame, mean: Column) -> float:
    """The prior's weight, in pages, from how far the groups' counts spread around `mean`.

    A count of n pages has variance n·p·q·(1 + (n - 1)·r), where r is the correlation of two
    pages of a group; r follows from sums over all groups, and the weight is 1/r - 1.
    """
    p, n, k = F.col("_mean"), F.col("pages"), F.col("bad")
    chance = n * p * (F.lit(1.0) - p)
    sums = groups.withColumn("_mean", mean).agg(
        F.sum((k - n * p) * (k - n * p)).alias("spread"), F.sum(chance).alias("chance"),
        F.sum(chance * (n - F.lit(1))).alias("pairs")).first()
    low, high = CORRELATIONS
    if not sums["pairs"]:
        return 1.0 / high - 1.0
    correlation = min(max((sums["spread"] - sums["chance"]) / sums["pairs"], low), high)
    return 1.0 / correlation - 1.0


def _shrunk(weight: float, mean: Column) -> Column:
    return (mean * F.lit(weight) + F.col("bad")) / (F.lit(weight) + F.col("pages"))


def host_reputation(judged: DataFrame) -> DataFrame:
    """Posterior share of bad pages of every host in `judged` (host string, bad int or null).

    A row for each host, also for those without a labelled page: pages (labelled), bad, share
    (posterior mean) and bound (lower). Without any labelled page all shares and bounds are 0.
    """
    counts = judged.groupBy("host").agg(F.count("bad").alias("pages"),
                                        F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    domain, suffix = domain_and_suffix(F.col("host"))
    hosts = stored(counts.select("host", domain.alias("domain"), suffix.alias("suffix"),
                                 "pages", "bad"), "hosts")

    def summed(rows: DataFrame, *keys: str) -> DataFrame:
        return rows.groupBy(*keys).agg(F.sum("pages").alias("pages"), F.sum("bad").alias("bad"))

    whole = hosts.agg(F.sum("pages").alias("pages"), F.sum("bad").alias("bad")).first()
    overall = F.lit(whole["bad"] / whole["pages"] if whole["pages"] else 0.0)

    suffixes = stored(summed(hosts, "suffix"), "suffixes")
    weight = _precision(suffixes, overall)
    suffixes = suffixes.select("suffix", _shrunk(weight, overall).alias("prior"))

    domains = stored(summed(hosts, "domain", "suffix").join(suffixes, "suffix"), "domains")
    weight = _precision(domains, F.col("prior"))
    domains = domains.select("domain", "suffix", _shrunk(weight, F.col("prior")).alias("prior"))

    hosts = stored(hosts.join(domains, ["domain", "suffix"]), "hosts-prior")
    weight = _precision(hosts, F.col("prior"))
    share = _shrunk(weight, F.col("prior"))
    size = F.lit(weight) + F.col("pages") + F.lit(1.0)
    deviation = F.sqrt(share * (F.lit(1.0) - share) / size)
    return hosts.select("host", "domain", "suffix", "pages", "bad", share.alias("share"),
                        F.greatest(share - F.lit(DEVIATIONS) * deviation, F.lit(0.0)).alias("bound"))


def judge(pages: DataFrame, labelled: DataFrame, rules: Sequence[Rule] = RULES,
          accepted: float = ACCEPTED_SHARE) -> DataFrame:
    """Host, path, rule and verdict of every page, by the longest rule or else by reputation.

    `labelled` has one row (page_id, bad) for each page whose outcome is known. A null url has an
    empty host and path, and such pages share one reputation. Every row of `pages` comes out once,
    repeated ids and null ids too (these have no outcome); other columns are not read. Empty
    tables give no rows; without labels nothing is blocked but by rules.
    """
    host, path = host_and_path(F.col("url"))
    found = pages.select(F.col("page_id"), host.alias("host"), path.alias("path"))
    known = found.select("page_id", "host").join(labelled.select("page_id", "bad"), "page_id", "left")
    hosts = host_reputation(known)
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    by_host = F.when(F.col("bound") > F.lit(accepted), "block").otherwise("allow")
    return found.join(hosts, "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_host).alias("verdict"),
        F.col("pages").alias("host_pages"), F.col("bad").alias("host_bad"),
        F.round("share", 6).alias("host_share"), F.round("bound", 6).alias("host_bound"))
