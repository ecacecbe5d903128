"""DuckDB SQL for the queries SQL can express, on the whole tables."""

from __future__ import annotations

from collections.abc import Sequence

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _resolved(path: str) -> str:
    kept = (f"list_reduce(list_prepend('', string_split(({path})[2:], '/')), "
            "lambda d, x: CASE x WHEN '.' THEN d WHEN '..' THEN regexp_replace(d, '/[^/]*$', '') ELSE d || '/' || x END)")
    return (f"CASE WHEN {path} = '' THEN '/' WHEN regexp_matches({path}, '/[.][.]?(/|$)') "
            f"THEN {kept} || CASE WHEN regexp_matches({path}, '/[.][.]?$') THEN '/' ELSE '' END ELSE {path} END")


def _parts(url: str) -> str:
    host = f"COALESCE(translate(regexp_extract({url}, '^.*?://([^/?#]*)', 1, 's'), '{UPPER}', '{LOWER}'), '')"
    path = f"COALESCE(regexp_extract({url}, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '')"
    return f"{host} AS host, {path} AS path, {host} || ({_resolved(path)}) || COALESCE(regexp_extract({url}, '^.*?://[^?#]*([?][^#]*)', 1, 's'), '') AS node"


def url_filter(rules: Sequence[tuple[str, str]]) -> str:
    values = ", ".join(f"('{verdict}', '{rule}', '{rule.partition('/')[0]}', '/{rule.partition('/')[2]}')" for verdict, rule in rules)
    space = r"[ \t\n\f\r]"
    attribute = r"""([^ \t\n\f\r"''<>/=]+)[ \t\n\f\r]*=[ \t\n\f\r]*("[^"<>]*"|''[^''<>]*''|[^ \t\n\f\r"''<>]+)"""
    value = "trim(vals[list_position(names, '{0}')], '\"'' \t\n\f\r')"
    target = rf"""trim(regexp_extract({value.format('content')}, '^[0-9.]*[ \t\n\f\r;,]*url{space}*={space}*["'']?([^"'']+)', 1, 'is'), '"'' {chr(9)}{chr(10)}{chr(12)}{chr(13)}')"""
    return f"""WITH RECURSIVE page AS (SELECT page_id, url, html, {_parts('url')} FROM pages),
rules(verdict, rule, rule_host, rule_path) AS (VALUES {values}),
tags AS (SELECT url, UNNEST(t) AS tag, generate_subscripts(t, 1) AS i FROM (SELECT DISTINCT url, html,
  regexp_extract_all(regexp_replace(html, '<!--.*?(-->|$)', '', 'gs'), '<(?:link|meta)\\b[^<>]*>', 0, 'is') AS t FROM page WHERE contains(url, '://'))),
attributes AS (SELECT url, i, lower(tag[1:5]) AS kind, list_transform(regexp_extract_all(tag, '{attribute}', 1), lambda x: lower(x)) AS names,
  regexp_extract_all(tag, '{attribute}', 2) AS vals FROM tags),
found AS (SELECT url, i, kind, CASE
  WHEN kind = '<link' AND list_contains(regexp_split_to_array(lower({value.format('rel')}), '{space}+'), 'canonical') THEN {value.format('href')}
  WHEN kind = '<meta' AND lower({value.format('http-equiv')}) = 'refresh' THEN {target} END AS h FROM attributes),
hrefs AS (SELECT DISTINCT host, path, node, replace(h, '&amp;', '&') AS h FROM (
  SELECT url, h FROM found WHERE h <> '' QUALIFY row_number() OVER (PARTITION BY url, kind ORDER BY i) = 1) JOIN page USING (url)),
full_urls AS (SELECT node AS source, CASE
  WHEN regexp_matches(h, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN h WHEN regexp_matches(h, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
  WHEN h LIKE '//%' THEN 'http:' || h WHEN h LIKE '/%' THEN 'http://' || host || h
  WHEN h LIKE '?%' THEN 'http://' || host || path || h WHEN h LIKE '#%' THEN NULL
  ELSE 'http://' || host || regexp_replace(CASE WHEN path = '' THEN '/' ELSE path END, '[^/]*$', '') || h END AS target FROM hrefs),
links AS (SELECT DISTINCT source, host, {_resolved('path')} AS path, node FROM (SELECT source, {_parts('target')} FROM full_urls WHERE target IS NOT NULL)),
places AS (SELECT DISTINCT host, path, node FROM page UNION SELECT host, path, node FROM links),
said AS (SELECT host, path, rule, verdict FROM (SELECT DISTINCT host, path FROM places) JOIN rules
  ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  QUALIFY row_number() OVER (PARTITION BY host, path ORDER BY length(rule) DESC, verdict) = 1),
reach(a, b) AS (SELECT node, node FROM places WHERE node IN (SELECT source FROM links UNION SELECT node FROM links)
  UNION SELECT r.a, e.b FROM reach r JOIN (SELECT source AS a, node AS b FROM links UNION SELECT node, source FROM links) e ON r.b = e.a),
blocked AS (SELECT a FROM reach JOIN places ON b = node JOIN said USING (host, path) WHERE a IN (SELECT source FROM links WHERE source <> node UNION SELECT node FROM links WHERE source <> node)
  GROUP BY a HAVING bool_or(verdict = 'block') AND NOT bool_or(verdict = 'allow'))
SELECT page_id, host, path, rule, COALESCE(verdict, CASE WHEN a IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM page LEFT JOIN said USING (host, path) LEFT JOIN blocked ON page.node = blocked.a"""


def near_duplicates(words: int, percent: int) -> str:
    return f"""WITH RECURSIVE split AS (SELECT doc_id, list_filter(regexp_split_to_array(
    translate(COALESCE(text, ''), '{UPPER}', '{LOWER}'), '[ \\t-\\r]+'), lambda x: x <> '') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(w) - {words - 1}, 1) + 1),
    lambda i: array_to_string(w[i:i + {words - 1}], ' '))) END AS s FROM split),
one AS (SELECT doc_id, len(s) AS n, UNNEST(s) AS v FROM sets),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM one a JOIN one b ON a.v = b.v AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * COUNT(*) >= {percent} * (a.n + b.n - COUNT(*))),
reach(a, b) AS (SELECT DISTINCT a, a FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, MIN(b) AS c FROM reach GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, COALESCE(c, doc_id) AS component_id, COALESCE(c, doc_id) = doc_id AS kept
FROM sets LEFT JOIN least ON doc_id = a"""


def near_vectors(cosine: float) -> str:
    """All pairs.  The operator finds pairs through filters, on tables of any size: at the threshold exactly it may
    miss one in a hundred, and hardly any at higher cosines."""
    return f"""WITH RECURSIVE unit AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: COALESCE(isfinite(x), false))) AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  AND list_cosine_similarity(a.v, b.v) >= {cosine}),
reach(a, b) AS (SELECT DISTINCT a, a FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, MIN(b) AS c FROM reach GROUP BY a), counts AS (SELECT a, COUNT(*) AS n FROM links GROUP BY a)
SELECT vec_id, COALESCE(n, 0) AS n_links, COALESCE(c, vec_id) AS component_id, COALESCE(c, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN least ON vec_id = least.a LEFT JOIN counts ON vec_id = counts.a"""
