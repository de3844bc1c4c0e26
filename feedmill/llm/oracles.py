"""DuckDB SQL for the queries of this folder that SQL can express."""

from __future__ import annotations

_WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body FROM pages
), b AS (
  SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS payload_digest FROM p
), g AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM b
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < top THEN top END AS refers_to
FROM g
"""

_JACCARD = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+') IF x <> ''] AS words
  FROM documents
), s AS (
  SELECT doc_id, list_distinct([array_to_string(words[i:i + 2], ' ')
           FOR i IN range(1, greatest(len(words) - 1, 2))]) AS grams
  FROM w WHERE len(words) > 0
), g AS (
  SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM s
), l AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), r(x, y) AS (
  SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x
), c AS (
  SELECT x, min(y) AS y FROM r GROUP BY x
), k AS (
  SELECT x, count(*) AS n FROM l GROUP BY x
)
SELECT d.doc_id, coalesce(len(s.grams), 0) AS n_shingles,
       least(d.doc_id, coalesce(c.y, d.doc_id)) AS component_id,
       coalesce(k.n, 0) AS n_links
FROM documents d LEFT JOIN s USING (doc_id)
LEFT JOIN c ON c.x = d.doc_id LEFT JOIN k ON k.x = d.doc_id
"""

_FILL_IN_MIDDLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), u AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS l,
         [CAST('0x' || h[8 * k + 1:8 * k + 8] AS BIGINT) FOR k IN range(4)] AS h
  FROM d
), c AS (
  SELECT *, len(l) AS n, least(h[1] % (len(l) + 1), h[2] % (len(l) + 1)) AS a,
         greatest(h[1] % (len(l) + 1), h[2] % (len(l) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 100 THEN 'plain'
              WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM u
), p AS (
  SELECT *, coalesce(array_to_string(l[1:a], ''), '') AS prefix, coalesce(array_to_string(l[a + 1:b], ''), '') AS middle,
         coalesce(array_to_string(l[b + 1:], ''), '') AS suffix
  FROM c
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""

_FILTER_AUDIT = r"""
WITH t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS x,
         regexp_extract_all(coalesce(text, ''), '[^ 	-]+') AS w
  FROM documents
), m AS (
  SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic
  FROM labels GROUP BY doc_id
), f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
         100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 2 * length(x) AS c,
         regexp_matches(x, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY x), false) AS e
  FROM t LEFT JOIN m USING (doc_id)
), g AS (
  SELECT part, a, b, c, d, e, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL
), s AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS k
), o AS (
  SELECT v.k || w.k || x.k || y.k || z.k AS filter_order FROM s v, s w, s x, s y, s z
  WHERE len(list_distinct([v.k, w.k, x.k, y.k, z.k])) = 5
), r AS (
  SELECT *, least(CASE WHEN a THEN instr(filter_order, 'A') ELSE 6 END, CASE WHEN b THEN instr(filter_order, 'B') ELSE 6 END,
                  CASE WHEN c THEN instr(filter_order, 'C') ELSE 6 END, CASE WHEN d THEN instr(filter_order, 'D') ELSE 6 END,
                  CASE WHEN e THEN instr(filter_order, 'E') ELSE 6 END) AS gone
  FROM g, o
), q AS (
  SELECT r.*, step, filter_order[step] AS k,
         CASE filter_order[step] WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END AS fails,
         CAST(a AS INTEGER) + CAST(b AS INTEGER) + CAST(c AS INTEGER) + CAST(d AS INTEGER) + CAST(e AS INTEGER) AS bits
  FROM r, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS step)
), z AS (
  SELECT part, filter_order, step, any_value(k) AS k,
         CAST(coalesce(sum(n) FILTER (gone > step), 0) AS BIGINT) AS kept,
         CAST(coalesce(sum(n) FILTER (gone = step), 0) AS BIGINT) AS removed,
         CAST(coalesce(sum(n) FILTER (fails AND gone < step), 0) AS BIGINT) AS redundant,
         CAST(coalesce(sum(n) FILTER (fails AND bits = 1), 0) AS BIGINT) AS unique_fails,
         CAST(coalesce(sum(good) FILTER (gone = step), 0) AS BIGINT) AS good_lost,
         CAST(coalesce(sum(toxic) FILTER (gone = step), 0) AS BIGINT) AS toxic_lost
  FROM q GROUP BY part, filter_order, step
)
SELECT * EXCLUDE (k), CAST(sum(removed) OVER (PARTITION BY part, k) AS BIGINT) AS shapley FROM z
"""

ORACLES = {
    "op2_warc": _WARC,
    "op9_ngram_jaccard": _JACCARD,
    "op11_fill_in_middle": _FILL_IN_MIDDLE,
    "op13_filter_audit": _FILTER_AUDIT,
}
