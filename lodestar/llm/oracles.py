"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

FILL_IN_MIDDLE = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS toks,
    sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex
  FROM documents),
drawn AS (
  SELECT *, len(toks) AS n,
    CAST('0x' || hex[1:8] AS BIGINT) AS h1, CAST('0x' || hex[9:16] AS BIGINT) AS h2,
    CAST('0x' || hex[17:24] AS BIGINT) AS h3, CAST('0x' || hex[25:32] AS BIGINT) AS h4
  FROM cut),
formed AS (
  SELECT *,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
         WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
    least(h1 % (n + 1), h2 % (n + 1)) AS c1, greatest(h1 % (n + 1), h2 % (n + 1)) AS c2
  FROM drawn),
pieces AS (
  SELECT *, array_to_string(toks[1:c1], '') AS p, array_to_string(toks[c1 + 1:c2], '') AS m,
    array_to_string(toks[c2 + 1:], '') AS s
  FROM formed)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
         ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM pieces
"""

SOURCE_DIVERGENCE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
groups AS (SELECT DISTINCT lang, source FROM docs),
found AS (
  SELECT id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS total FROM found GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
whole AS (SELECT lang, count(*) AS V, sum(total) AS total FROM kept GROUP BY lang),
cells AS (SELECT f.lang, f.source, f.term, count(*) AS n FROM found f JOIN kept USING (lang, term) GROUP BY ALL),
sizes AS (SELECT lang, source, sum(n) AS N FROM cells GROUP BY ALL),
dense AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(z.N, 0) + 5 * w.V) AS p,
    1 + (1000000000::HUGEINT * (k.total + 5)) // (w.total + 5 * w.V) AS q
  FROM groups g JOIN kept k USING (lang) JOIN whole w USING (lang)
  LEFT JOIN cells c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
  LEFT JOIN sizes z ON z.lang = g.lang AND z.source = g.source),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM dense WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50
"""

ORACLE: dict[str, str] = {
    "op11_fill_in_middle": FILL_IN_MIDDLE,
    "op13_source_divergence": SOURCE_DIVERGENCE,
}
