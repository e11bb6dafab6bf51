"""SQL counterparts (DuckDB) of the queries that SQL can express."""

from __future__ import annotations

from tidemark.llm import url_rules

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lower(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{_UPPER}', '{_UPPER.lower()}')"


_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_QUINTET = f"substr('{_BASE32}', 1 + CAST((five >> shift) & 31 AS INTEGER), 1)"

WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
digests AS (
  SELECT hex, string_agg({_QUINTET}, '' ORDER BY i, shift DESC) AS digest
  FROM (SELECT hex, i, CAST('0x' || substr(hex, 5 * i + 1, 5) AS BIGINT) AS five
        FROM (SELECT DISTINCT hex FROM p), unnest(range(0, 8)) t(i)), unnest([15, 10, 5, 0]) s(shift)
  GROUP BY hex
)
SELECT page_id, strlen(payload) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM (SELECT *, min(page_id) OVER (PARTITION BY payload) AS first FROM p) JOIN digests USING (hex)
"""

_COMPONENTS = """
reach AS (
  SELECT node, node AS other FROM nodes
  UNION
  SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.other
)"""

JACCARD = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_lower('text')}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
),
grams AS (
  SELECT DISTINCT doc_id, w[i:i + least(3, len(w)) - 1] AS gram
  FROM w, unnest(range(1, greatest(len(w) - 3, 0) + 2)) t(i) WHERE len(w) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY 1),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM grams x JOIN grams y USING (gram)
  WHERE x.doc_id <> y.doc_id GROUP BY 1, 2
),
links AS (
  SELECT a, b FROM shared JOIN sizes sa ON sa.doc_id = a JOIN sizes sb ON sb.doc_id = b
  WHERE 100 * shared.n >= 90 * (sa.n + sb.n - shared.n)
),
nodes AS (SELECT DISTINCT a AS node FROM links),{_COMPONENTS}
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(root, doc_id) AS component_id
FROM documents LEFT JOIN sizes USING (doc_id)
LEFT JOIN (SELECT node, min(other) AS root FROM reach GROUP BY 1) ON node = doc_id
"""

_WORDS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_WORDS.format(_lower('text'))} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS.format(_lower('text'))} AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (
  SELECT DISTINCT item, least(13, len(w)) AS n, w[i:i + least(13, len(w)) - 1] AS phrase
  FROM b, unnest(range(1, greatest(len(w) - 13, 0) + 2)) t(i) WHERE len(w) > 0
),
dw AS (
  SELECT doc_id, i, n, w[i:i + n - 1] AS phrase
  FROM d, (SELECT DISTINCT n FROM bw), unnest(range(1, len(w) - n + 2)) t(i)
),
hits AS (SELECT doc_id, i, dw.n AS n, item FROM dw JOIN bw ON bw.phrase = dw.phrase),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY 1),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY 1
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""


def url_verdicts(rules: list[tuple[str, str]]) -> str:
    """Verdicts with blocks carried over normal forms and the links that pages name."""
    cases, verdicts = "", ""
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        name, _, rest = rule.partition("/")
        fits = f"(host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '/{rest}')"
        cases += f" WHEN {fits} THEN '{rule}'"
        verdicts += f" WHEN '{rule}' THEN '{verdict}'"
    rest = "CASE WHEN contains(u, '://') THEN substr(u, strpos(u, '://') + 3) END"

    def parts(source: str) -> str:
        return f"""SELECT *, {_lower("regexp_extract(rest, '^[^/?#]*')")} AS host,
  coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
  regexp_replace(regexp_replace(regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1),
    '(?:^|&){url_rules.TRACKING}=[^&]*', '', 'g'), '^&', '') AS query
  FROM (SELECT *, {rest} AS rest FROM {source})"""

    form = "CASE WHEN host <> '' THEN host || regexp_replace(path, '/+$', '') || CASE WHEN query <> '' THEN '?' || query ELSE '' END END"
    return f"""
WITH RECURSIVE p AS (SELECT *, {form} AS form FROM ({parts("(SELECT page_id, url AS u, html FROM pages)")})),
ruled AS (SELECT *, CASE{cases} END AS rule FROM p),
own AS (SELECT *, CASE rule{verdicts} END AS own FROM ruled),
named AS (
  SELECT form AS s, host AS h, path AS p, u AS page, unnest(list_concat(
    list_transform(coalesce(regexp_extract_all(html, '(?is)<link\\b[^>]*\\brel\\s*=\\s*["'']?canonical\\b[^>]*>'), []),
      lambda x: replace(regexp_extract(x, '(?is)\\bhref\\s*=\\s*["'']?([^"''\\s>]+)', 1), '&amp;', '&')),
    list_transform(coalesce(regexp_extract_all(html, '(?is)<meta\\b[^>]*\\bhttp-equiv\\s*=\\s*["'']?refresh\\b[^>]*>'), []),
      lambda x: replace(regexp_extract(x, '(?is)\\burl\\s*=\\s*["'']?([^"''\\s>;]+)', 1), '&amp;', '&'))
  )) AS t FROM p WHERE form IS NOT NULL
),
cut AS (
  SELECT *, regexp_extract(t, '^[^?#]*') AS c,
         CASE WHEN starts_with(t, '/') THEN '' WHEN p = '' THEN '/' ELSE regexp_replace(p, '[^/]*$', '') END AS folder
  FROM named WHERE t <> ''
),
joined AS (
  SELECT *, substr(t, length(c) + 1) AS tail,
         array_to_string(list_reduce(list_transform(string_split(folder || c, '/'), lambda x: [x]),
           lambda a, b: CASE b[1] WHEN '.' THEN a WHEN '..' THEN a[:greatest(len(a) - 1, 1)] ELSE list_concat(a, b) END), '/') AS whole
  FROM cut
),
targets AS (
  SELECT s, CASE WHEN contains(t, '://') THEN t WHEN starts_with(t, '//') THEN 'http:' || t
                 WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.\\-]*:') THEN NULL
                 WHEN starts_with(t, '?') THEN 'http://' || h || p || t WHEN starts_with(t, '#') THEN page
                 ELSE 'http://' || h || whole || tail END AS u FROM joined
),
edges AS (SELECT s, {form} AS t FROM ({parts("targets")})),
links AS (SELECT s AS a, t AS b FROM edges WHERE t IS NOT NULL UNION SELECT t, s FROM edges WHERE t IS NOT NULL),
nodes AS (SELECT DISTINCT a AS node FROM links),{_COMPONENTS},
placed AS (
  SELECT own.*, coalesce(root, form) AS root FROM own
  LEFT JOIN (SELECT node, min(other) AS root FROM reach GROUP BY 1) ON node = form
),
groups AS (SELECT root, bool_or(own = 'block') AND NOT coalesce(bool_or(own = 'allow'), false) AS carried FROM placed WHERE root IS NOT NULL GROUP BY 1)
SELECT page_id, coalesce(host, '') AS host, path, rule, coalesce(own, CASE WHEN carried THEN 'block' END, 'allow') AS verdict
FROM placed LEFT JOIN groups ON groups.root = placed.root
"""
