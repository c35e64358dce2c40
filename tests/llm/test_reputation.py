"""URL filters, against a plain version of the same rules and counts."""

import math
import random

import pytest

from tidewatch.llm import reputation
from tidewatch.llm.reputation import Rule

SHAPE = "page_id long, url string"


def _host_and_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
    path = rest[end:]
    path = path[:min([path.find(c) for c in "?#" if c in path] + [len(path)])]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end]), path


def _rule(host, path, rules):
    fitting = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fitting, key=lambda r: (len(r.host + r.path), len(r.host), r.verdict == "block"), default=None)


def _bounds(counts):
    """Host -> lower bound, from host -> (pages, bad, domain, suffix)."""
    def grouped(place):
        found = {}
        for n, k, *names in counts.values():
            key = tuple(names) if place is None else names[place]
            a, b = found.get(key, (0, 0))
            found[key] = a + n, b + k
        return found

    def shrunk(groups, prior):
        spread = chance = pairs = 0.0
        for key, (n, k) in groups.items():
            p = prior(key)
            spread += (k - n * p) ** 2
            chance += n * p * (1 - p)
            pairs += n * p * (1 - p) * (n - 1)
        low, high = reputation.CORRELATIONS
        r = min(max((spread - chance) / pairs, low), high) if pairs else high
        w = 1 / r - 1
        return w, {key: (prior(key) * w + k) / (w + n) for key, (n, k) in groups.items()}

    n, k = (sum(c[i] for c in counts.values()) for i in (0, 1))
    overall = k / n if n else 0.0
    _, suffixes = shrunk(grouped(1), lambda key: overall)
    _, domains = shrunk(grouped(None), lambda key: suffixes[key[1]])
    w, hosts = shrunk({h: c[:2] for h, c in counts.items()}, lambda h: domains[counts[h][2:]])
    return {h: max(m - reputation.DEVIATIONS * math.sqrt(m * (1 - m) / (w + counts[h][0] + 1)), 0)
            for h, m in hosts.items()}


def test_verdicts_equal_a_plain_version(spark):
    draw = random.Random(5)
    sites = {"a.bad.example.com": (0.95, "bad.example.com"[4:], "com"), "good.example.com": (0.05, "example.com", "com"),
             "x.shop.co.uk": (0.9, "shop.co.uk", "co.uk"), "y.shop.co.uk": (0.9, "shop.co.uk", "co.uk"),
             "one.org": (0.1, "one.org", "org"), "z.two.org": (0.5, "two.org", "org")}
    rows, labelled = [], []
    for i in range(600):
        host = draw.choice(["a.bad.example.com"] * 6 + list(sites))
        scheme, upper = draw.choice(["http", "HTTPS"]), draw.random() < 0.3
        path = draw.choice(["", "/", "/de/a", "/fr/", "/en/x?q=/de/", "?u=http://n.net/", "#/fr/"])
        rows.append((i, f"{scheme}://{host.upper() if upper else host}{path}"))
        if draw.random() < 0.6:
            labelled.append((i, int(draw.random() < sites[host][0])))
    rules = [*reputation.RULES, Rule("block", "one.org", "/fr/"), Rule("allow", "one.org", "/fr/"), Rule("block", "uk", "/de/")]
    got = {r["page_id"]: r for r in reputation.judge(
        spark.createDataFrame(rows, SHAPE), spark.createDataFrame(labelled, "page_id long, bad int"), rules).collect()}
    known, counts = dict(labelled), {}
    for i, url in rows:
        host, _ = _host_and_path(url)
        n, k, *_ = counts.get(host, (0, 0))
        counts[host] = n + (i in known), k + known.get(i, 0), sites[host][1], sites[host][2]
    bounds = _bounds(counts)
    assert len(got) == len(rows)
    for i, url in rows:
        host, path = _host_and_path(url)
        rule = _rule(host, path, rules)
        row = got[i]
        assert (row["host"], row["path"]) == (host, path)
        assert row["rule"] == (rule and rule.host + rule.path)
        assert row["host_bound"] == pytest.approx(bounds[host], abs=2e-6)
        wanted = rule.verdict if rule else "block" if bounds[host] > reputation.ACCEPTED_SHARE else "allow"
        assert row["verdict"] == wanted
    assert bounds["a.bad.example.com"] > reputation.ACCEPTED_SHARE > bounds["good.example.com"]


def test_few_bad_pages_are_shrunk_towards_their_neighbours(spark):
    """One bad page of a new host is judged by its domain; one among many good hosts blocks nothing."""
    hosts = [f"h{i}.{d}.org" for d in ("fine", "foul") for i in range(40)]
    rows = [(10 * i + j, f"http://{host}/") for i, host in enumerate(hosts) for j in range(5)]
    labelled = [(i, int("foul" in url)) for i, url in rows] + [(9_000, 1), (9_001, 1)]
    rows += [(9_000, "http://new.foul.org/"), (9_001, "http://new.fine.org/")]
    got = reputation.judge(spark.createDataFrame(rows, SHAPE),
                           spark.createDataFrame(labelled, "page_id long, bad int"), rules=())
    verdicts = {r["page_id"]: r["verdict"] for r in got.collect()}
    assert (verdicts[9_000], verdicts[9_001]) == ("block", "allow")


@pytest.mark.parametrize("host, domain, suffix", [
    ("a.b.example.com", "example.com", "com"), ("example.com", "example.com", "com"),
    ("com", "com", ""), ("www.shop.co.uk:80", "shop.co.uk", "co.uk"), ("co.uk", "co.uk", ""),
    ("me@a.net.", "a.net", "net"), ("10.0.0.1:8080", "10.0.0.1", ""), ("[::1]", "[::1]", ""), ("", "", ""),
    ("x.co", "x.co", "co"), ("a..b", ".b", "b")])
def test_domains(spark, host, domain, suffix):
    from pyspark.sql import functions as F
    parts = reputation.domain_and_suffix(F.col("host"))
    assert tuple(spark.createDataFrame([(host,)], "host string").select(*parts).first()) == (domain, suffix)


def test_awkward_rows(spark):
    """Nulls, repeated rows and ids, very long urls, no tables at all, clashing columns."""
    long_url = "http://" + "a." * 40_000 + "net/" + "x" * 100_000
    rows = [(1, None), (1, None), (None, "http://A.org/fr/1"), (None, "no scheme"), (2, ""), (3, long_url),
            (3, "://"), (4, "http://x.net"), (5, "http://x.net/ "), (6, "http://é.COM/de/?a"), (6, "http://é.COM/de/?a")]
    pages = spark.createDataFrame(rows, SHAPE).selectExpr(
        "*", "'c' AS host", "1 AS bad", "2 AS pages", "'v' AS verdict", "0 AS prior")
    labels = spark.createDataFrame([(1, 0, 0), (1, 1, 0), (None, 0, 1), (2, None, None), (3, 1, None), (9, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    labelled = reputation.outcomes(labels)
    assert sorted(map(tuple, labelled.collect())) == [(1, 1), (3, 0), (9, 1)]
    got = reputation.judge(pages, labelled).collect()
    assert len(got) == len(rows)
    shown = sorted(((r["page_id"] or 0, r["host"][:6], r["path"][:4], r["rule"], r["host_pages"]) for r in got), key=str)
    assert shown == sorted([
        (1, "", "", None, 3), (1, "", "", None, 3), (0, "a.org", "/fr/", "org/fr/", 0), (0, "", "", None, 3),
        (2, "", "", None, 3), (3, "a.a.a.", "/xxx", "net/", 1), (3, "", "", None, 3), (4, "x.net", "", None, 0),
        (5, "x.net", "/ ", "net/", 0), (6, "é.com", "/de/", None, 0), (6, "é.com", "/de/", None, 0)], key=str)
    empty = reputation.judge(pages.limit(0), labelled)
    assert empty.count() == 0
    unlabelled = reputation.judge(pages, labelled.limit(0)).collect()
    assert {r["verdict"] for r in unlabelled if r["rule"] is None} == {"allow"}
    with pytest.raises(ValueError, match="rules"):
        reputation.judge(pages, labelled, [Rule("block", "a", "/")] * 1_001)
