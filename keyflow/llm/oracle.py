"""DuckDB SQL for the operators that SQL can express.

The others cannot be: boosted trees and merge-type or byte-level tokenisers are
no SQL; fingerprints need XXH64 with a seed; approximate neighbours and the mix
depend on centroids and hash orders. They are tested against brute force or the
public libraries in ``tests/llm``.
"""

from keyflow.llm.divergence import MIN_DOCS, SCALE, SMOOTH, TOP_TERMS
from keyflow.llm.urlfilter import RULES, TRACKING
from keyflow.llm.warc import MIN_REVISIT

_SHAPE = "(?s)^.*?://([^/?#]*)([^?#]*)"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_RULES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)

ORACLE_SQL = {
    "op5_warc_bundles": f"""WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS h FROM p),
f AS (SELECT h, min(page_id) AS low FROM d WHERE n >= {MIN_REVISIT} GROUP BY h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d.h AS payload_digest,
       CASE WHEN low <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN low <> page_id THEN low END AS refers_to
FROM d LEFT JOIN f ON d.h = f.h AND n >= {MIN_REVISIT}""",
    "op8_url_filter": f"""WITH u AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
h AS (SELECT page_id,
        translate(regexp_extract(url, '{_SHAPE}', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(url, '{_SHAPE}', 2) AS path, regexp_matches(url, '{TRACKING}') AS tracks FROM u),
r(verdict, rhost, rpath) AS (VALUES {_RULES}),
m AS (SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
             arg_max(verdict, length(rhost || rpath)) AS verdict
      FROM h JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id),
l AS (SELECT host, avg(CAST(tracks AS INT)) > 1.0 / 3 AS bad FROM h WHERE host <> '' GROUP BY host)
SELECT h.page_id, h.host, h.path, m.rule, coalesce(l.bad, false) AS listed,
       coalesce(m.verdict, CASE WHEN coalesce(l.bad, false) THEN 'block' ELSE 'allow' END) AS verdict
FROM h LEFT JOIN m USING (page_id) LEFT JOIN l ON h.host = l.host""",
    "op11_radix_dedup": f"""WITH t AS (SELECT doc_id, {_LOWER.format("coalesce(text, '')")} AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t.text) AS text_sha256
FROM t JOIN g ON t.text = g.text""",
    "op13_divergence_audit": f"""WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         {_LOWER.format("coalesce(text, '')")} AS text FROM documents),
w AS (SELECT rid, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
k AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT rid) >= {MIN_DOCS}),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS MATERIALIZED (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
s AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL),
p AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS cnt,
         1 + (CAST({SCALE} AS HUGEINT) * (coalesce(c.n, 0) + {SMOOTH})) // (coalesce(s.n, 0) + {SMOOTH} * v.v) AS p,
         1 + (CAST({SCALE} AS HUGEINT) * (k.n + {SMOOTH})) // (v.n + {SMOOTH} * v.v) AS q
  FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
  LEFT JOIN s ON s.lang = g.lang AND s.source = g.source),
i AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
    SELECT x.lang, x.source AS a, y.source AS b, sum(abs(x.p - y.p)) AS value
    FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) f
  ON f.lang = a.lang AND f.a = a.source AND f.b = b.source
  UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p WHERE cnt > 0 AND p > q)
SELECT lang, source, part, item, value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM i QUALIFY part = 'pair' OR rank <= {TOP_TERMS}""",
}
