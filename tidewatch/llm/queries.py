"""Registered queries of the training-data operators, and their SQL counterparts."""

from __future__ import annotations

import corpus_pipeline
from tidewatch.llm import (
    alignment, chat, contamination, fingerprints, hmm, html, near, packing, quality, reputation, suffixes, warc,
    whitening,
)
from tidewatch.llm.common import table

QUERIES = {}
SQL = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_decontamination(spark, sf_dir):
    return contamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op2_suffixes(spark, sf_dir):
    return suffixes.dedup_digests(table(spark, sf_dir, "documents"))


@query
def op3_fingerprints(spark, sf_dir):
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


@query
def op4_hmm(spark, sf_dir):
    return hmm.score(table(spark, sf_dir, "documents"))


@query
def op5_chat(spark, sf_dir):
    conversations = chat.with_probe(table(spark, sf_dir, "conversations"))
    read = chat.digests(chat.format_conversations(conversations))
    return read.drop("n_ids", "n_loss_ids")


@query
def op6_quality(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op8_near_duplicates(spark, sf_dir):
    return near.near_groups(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "copy_id", "n_links")


@query
def op9_html(spark, sf_dir):
    return html.extract(table(spark, sf_dir, "pages"))


@query
def op10_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query
def op11_alignment(spark, sf_dir):
    return alignment.align(table(spark, sf_dir, "documents"))


@query
def op12_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op13_reputation(spark, sf_dir):
    """The label of a page is that of its id."""
    labelled = reputation.outcomes(table(spark, sf_dir, "labels"))
    return reputation.judge(table(spark, sf_dir, "pages"), labelled)


SQL["op10_warc"] = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
), d AS (
  SELECT page_id, octet_length(body) AS n, sha1(body) AS digest FROM p
), k AS (
  SELECT page_id, n, digest,
         max(page_id) OVER (PARTITION BY digest, n) AS kept FROM d
)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND kept <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND kept <> page_id THEN kept END AS refers_to
FROM k
"""


def _escaped_length(text: str) -> str:
    marks = ("chr(92)", "'<s>'", "'</s>'", "'[INST]'", "'[/INST]'")
    counts = [f"(length({text}) - length(replace({text}, {m}, ''))) // length({m})" for m in marks]
    return f"(length({text}) + " + " + ".join(counts) + ")"


SQL["op5_chat"] = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS whole,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS learned,
         CAST(sum(20 + {_escaped_length('role')} + {_escaped_length('text')}) AS BIGINT) AS formatted_chars
  FROM c GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(learned) AS loss_chars,
       sha256(learned) AS loss_sha256, formatted_chars
FROM g
"""

@query
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL is not None:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

SQL["op1_decontamination"] = f"""
WITH b AS (
  SELECT item_id, {_WORDS} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
        FROM b WHERE len(w) > 0)
), d AS (
  SELECT doc_id, {_WORDS} AS w FROM documents
), places AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
), found AS (
  SELECT doc_id, item_id, i, n FROM places JOIN windows USING (n, phrase)
), hits AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS word FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

SQL["op2_suffixes"] = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents
), w AS (
  SELECT r, p, md5(b[p:p + 199]) AS h FROM (SELECT r, b, unnest(range(1, octet_length(b) - 198)) AS p FROM d)
), hits AS (
  SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY h) AS n FROM w) WHERE n > 1
), marked AS (
  SELECT r, p, sum(CASE WHEN gap IS NULL OR gap > 200 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY p) AS span
  FROM (SELECT r, p, p - lag(p) OVER (PARTITION BY r ORDER BY p) AS gap FROM hits)
), spans AS (
  SELECT r, span, min(p) AS a, max(p) + 199 AS z FROM marked GROUP BY r, span
), edges AS (
  SELECT r, list(a ORDER BY a) AS a, list(z ORDER BY a) AS z, count(*) AS n_spans, sum(z - a + 1) AS n_removed
  FROM spans GROUP BY r
), kept AS (
  SELECT r, string_agg(part, '' ORDER BY k) AS kept
  FROM (SELECT r, k, hex(b[(CASE WHEN k = 1 THEN 1 ELSE z[k - 1] + 1 END):(CASE WHEN k > n_spans THEN octet_length(b) ELSE a[k] - 1 END)]) AS part
        FROM (SELECT r, b, a, z, n_spans, unnest(range(1, n_spans + 2)) AS k FROM d JOIN edges USING (r)))
  GROUP BY r
)
SELECT doc_id, octet_length(b) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       CASE WHEN n_spans IS NULL THEN sha256(b) ELSE sha256(unhex(kept)) END AS kept_sha256
FROM d LEFT JOIN edges USING (r) LEFT JOIN kept USING (r)
"""

SQL["op8_near_duplicates"] = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents
), sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN ['=' || text] ELSE list_transform(
    range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS s FROM w
), classes AS (
  SELECT min(doc_id) AS copy_id, s, len(s) AS n FROM sets GROUP BY s
), items AS (
  SELECT copy_id, n, unnest(s) AS x FROM classes
), links AS (
  SELECT a.copy_id AS a, b.copy_id AS b FROM items a JOIN items b ON a.x = b.x AND a.copy_id <> b.copy_id
  GROUP BY a.copy_id, b.copy_id, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*))
), reached AS (
  SELECT copy_id AS a, copy_id AS b FROM classes UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), roots AS (
  SELECT a AS copy_id, min(b) AS class_id FROM reached GROUP BY a
), degrees AS (
  SELECT a AS copy_id, count(*) AS n_links FROM links GROUP BY a
)
SELECT doc_id, class_id, copy_id, coalesce(n_links, 0) AS n_links
FROM sets JOIN classes USING (s) JOIN roots USING (copy_id) LEFT JOIN degrees USING (copy_id)
"""


def _weight(level: str, mean: str) -> str:
    """The prior's weight of one level: groups `level` with pages and bad, whose prior mean is `mean`."""
    low, high = reputation.CORRELATIONS
    return f"""(
  SELECT 1 / CASE WHEN coalesce(pairs, 0) = 0 THEN {high}
                  ELSE least(greatest((spread - chance) / pairs, {low}), {high}) END - 1 AS w
  FROM (SELECT sum((bad - pages * m) * (bad - pages * m)) AS spread, sum(pages * m * (1 - m)) AS chance,
               sum(pages * m * (1 - m) * (pages - 1)) AS pairs
        FROM (SELECT pages, bad, CAST({mean} AS DOUBLE) AS m FROM {level})))"""


_REGISTRY = "|".join(reputation.REGISTRY_NAMES)

SQL["op13_reputation"] = rf"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0
                       THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
), l AS (
  SELECT doc_id AS page_id, max(greatest(CAST(quality = 0 AS INT), CAST(toxic = 1 AS INT))) AS bad
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), c AS (
  SELECT host, count(bad) AS pages, coalesce(sum(bad), 0) AS bad,
         regexp_replace(regexp_replace(host, '^.*@|:[0-9]*$', '', 'g'), '\.$', '') AS name
  FROM p LEFT JOIN l USING (page_id) GROUP BY host
), s AS (
  SELECT *, regexp_extract(name, '(?:^|\.)((?:(?:{_REGISTRY})\.[a-z]{{2}})|[^.]+)$', 1) AS ending FROM c
), b AS (
  SELECT *, substr(name, 1, greatest(length(name) - length(ending) - 1, 0)) AS below,
         regexp_matches(name, '^[0-9.]+$|^\[') OR NOT contains(name, '.') AS alone FROM s
), h AS (
  SELECT host, pages, bad, CASE WHEN alone OR below = '' THEN name
                                ELSE regexp_extract(below, '[^.]*$') || '.' || ending END AS domain,
         CASE WHEN alone OR below = '' THEN '' ELSE ending END AS suffix FROM b
), overall AS (
  SELECT CASE WHEN sum(pages) > 0 THEN sum(bad) / sum(pages) ELSE 0 END AS share FROM h
), x AS (
  SELECT suffix, sum(pages) AS pages, sum(bad) AS bad FROM h GROUP BY suffix
), xs AS (
  SELECT suffix, (share * w + bad) / (w + pages) AS prior
  FROM x, overall, {_weight("x, overall", "share")}
), d AS (
  SELECT domain, suffix, any_value(prior) AS prior, sum(pages) AS pages, sum(bad) AS bad
  FROM h JOIN xs USING (suffix) GROUP BY domain, suffix
), ds AS (
  SELECT domain, suffix, (prior * w + bad) / (w + pages) AS prior FROM d, {_weight("d", "prior")}
), hp AS (
  SELECT host, pages, bad, prior FROM h JOIN ds USING (domain, suffix)
), hs AS (
  SELECT host, pages, bad, w + pages + 1 AS size, (prior * w + bad) / (w + pages) AS share
  FROM hp, {_weight("hp", "prior")}
), r AS (
  SELECT host, pages, bad, share,
         greatest(share - {reputation.DEVIATIONS} * sqrt(share * (1 - share) / size), 0) AS bound FROM hs
), f AS (
  SELECT *, (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' AS net,
         (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' AS net_en,
         (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' AS com_de,
         (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' AS org_fr
  FROM p JOIN r USING (host)
)
SELECT page_id, host, path,
       CASE WHEN net_en THEN 'example.net/en/' WHEN com_de THEN 'example.com/de/'
            WHEN org_fr THEN 'org/fr/' WHEN net THEN 'net/' END AS rule,
       CASE WHEN net_en THEN 'allow' WHEN com_de THEN 'block' WHEN org_fr THEN 'allow' WHEN net THEN 'block'
            WHEN bound > {reputation.ACCEPTED_SHARE} THEN 'block' ELSE 'allow' END AS verdict,
       pages AS host_pages, CAST(bad AS BIGINT) AS host_bad,
       round(share, 6) AS host_share, round(bound, 6) AS host_bound
FROM f
"""
