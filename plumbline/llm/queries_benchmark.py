"""The decontamination query."""

from __future__ import annotations

from .decontaminate import op6_decontamination

QUERIES = {"op6_decontamination": op6_decontamination}

ORACLE_SQL = {
    "op6_decontamination": r"""
WITH i AS (
  SELECT DISTINCT item_id, text FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), iw AS (
  SELECT item_id, text, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM i
), half AS (
  SELECT max(len(ws)) + 8 AS s FROM iw
), ig AS (
  SELECT DISTINCT item_id, text, unnest(list_transform(range(1, greatest(len(ws) - 3, 2)), lambda k: array_to_string(ws[k:least(k + 4, len(ws))], ' '))) AS g,
         least(len(ws), 5) AS k
  FROM iw WHERE len(ws) > 0
), n AS (
  SELECT item_id, text, count(*) AS n FROM ig GROUP BY ALL
), ia AS (
  SELECT DISTINCT item_id, text, unnest(ws[len(ws) - greatest(1, len(ws) // 3) + 1:]) AS w FROM iw WHERE len(ws) > 0
), na AS (
  SELECT item_id, text, count(*) AS n FROM ia GROUP BY ALL
), dw AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), p AS (
  SELECT r, doc_id, ws, unnest(range(0, len(ws))) AS pos FROM dw
), k AS (
  SELECT DISTINCT k FROM ig
), g AS (
  SELECT r, doc_id, pos, k.k, array_to_string(ws[pos + 1:pos + k.k], ' ') AS g, len(ws) AS m FROM p, k WHERE pos + k.k <= len(ws)
), w AS (
  SELECT r, doc_id, len(ws) AS m, unnest(range(0, greatest(1, ((len(ws) + (SELECT s FROM half) - 1) // (SELECT s FROM half)) - 1))) * (SELECT s FROM half) AS a FROM dw
), h AS (
  SELECT w.r, w.doc_id, w.a, ig.item_id, ig.text, count(DISTINCT g.g) AS shared
  FROM ig JOIN g ON g.g = ig.g AND g.k = ig.k
  JOIN w ON w.r = g.r AND g.pos >= w.a AND g.pos + g.k <= w.a + 2 * (SELECT s FROM half)
  GROUP BY ALL
), c AS (
  SELECT h.*, n.n FROM h JOIN n USING (item_id, text) WHERE 4 * shared >= 3 * n.n
), v AS (
  SELECT c.r, c.a, c.item_id, c.text, count(DISTINCT ia.w) AS q
  FROM c JOIN p ON p.r = c.r AND p.pos >= c.a AND p.pos < c.a + 2 * (SELECT s FROM half)
  JOIN ia ON ia.item_id = c.item_id AND ia.text = c.text AND ia.w = p.ws[p.pos + 1]
  GROUP BY ALL
)
SELECT c.doc_id, c.item_id, max(c.shared)::BIGINT AS shared, max(c.shared / c.n) AS similarity
FROM c JOIN v ON v.r = c.r AND v.a = c.a AND v.item_id = c.item_id AND v.text = c.text
JOIN na ON na.item_id = c.item_id AND na.text = c.text
WHERE 4 * v.q >= 3 * na.n
GROUP BY ALL
""",
}
