"""DuckDB SQL for those queries of this subpackage that SQL can express."""

OP3_MIX_SOURCES = r"""
WITH sized AS (
  SELECT doc_id, COALESCE('0' || source, '1') AS src,
         CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         ((('0x' || substr(md5(concat_ws(':', '7', CAST(doc_id AS VARCHAR), md5(text))), 1, 13))::BIGINT)::DOUBLE + 0.5)
           / 4503599627370496.0 AS u
  FROM documents),
sizes AS (SELECT src, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY src),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY src) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w,
         source_size * 2.0::DOUBLE AS cap
  FROM sizes),
filled AS (
  SELECT *, (CAST(sum(source_size) OVER () AS BIGINT) * 1.5::DOUBLE
      - COALESCE(sum(cap) OVER (ORDER BY cap / w, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
      / sum(w) OVER (ORDER BY cap / w, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
aimed AS (SELECT src, source_size, least(cap, max(level) OVER () * w) AS target FROM filled),
targets AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM aimed),
keyed AS (
  SELECT doc_id, src, size, source_size, target, whole, u, target - whole * source_size AS need,
         CASE WHEN source_size > 0 THEN (target - whole * source_size) / source_size ELSE 0.0::DOUBLE END AS p
  FROM sized JOIN targets USING (src)),
ranked AS (
  SELECT *, CASE WHEN p > 0 THEN ((u / (1 - u)) / (p / (1 - p))) / (1 + (u / (1 - u)) / (p / (1 - p))) END AS k FROM keyed),
running AS (
  SELECT *, sum(size) OVER (PARTITION BY src ORDER BY k, COALESCE(doc_id, -9223372036854775808)
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
  FROM ranked),
drawn AS (
  SELECT *, whole + CASE WHEN k IS NULL OR need <= 0 THEN 0 WHEN run - size / 2.0::DOUBLE <= need THEN 1 ELSE 0 END AS copies
  FROM running)
SELECT doc_id, size, source_size, target, CAST(copies * size AS BIGINT) AS taken, CAST(copies AS BIGINT) AS copies
FROM drawn
"""


OP12_SOURCE_DIVERGENCE = r"""
WITH d AS (SELECT COALESCE(text, '') AS text, COALESCE(lang, '') AS lang, COALESCE(source, '') AS source FROM documents),
found AS (
  SELECT row_number() OVER () AS id, lang, source, regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM d),
tokens AS (
  SELECT id, lang, source, translate(unnest(terms), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM found),
kept AS (SELECT lang, term, count(*) AS total FROM tokens GROUP BY lang, term HAVING count(DISTINCT id) >= 10),
grp AS (SELECT DISTINCT lang, source FROM d),
counted AS (SELECT lang, source, term, count(*) AS count FROM tokens JOIN kept USING (lang, term) GROUP BY ALL),
vocabulary AS (SELECT lang, count(*) AS v, CAST(sum(total) AS BIGINT) AS n FROM kept GROUP BY lang),
sizes AS (SELECT lang, source, CAST(sum(count) AS BIGINT) AS n FROM counted GROUP BY ALL),
dense AS (
  SELECT g.lang, g.source, k.term, COALESCE(c.count, 0) AS count,
         1 + (1000000000 * (COALESCE(c.count, 0) + 2)) // (COALESCE(s.n, 0) + 2 * v.v) AS p,
         1 + (1000000000 * (k.total + 2)) // (v.n + 2 * v.v) AS q
  FROM grp g JOIN kept k ON g.lang = k.lang JOIN vocabulary v ON g.lang = v.lang
  LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
  LEFT JOIN sizes s ON s.lang = g.lang AND s.source = g.source),
sums AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS BIGINT) AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, COALESCE(s.value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM dense WHERE count > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

OP13_FILL_IN_MIDDLE = r"""
WITH d AS (
  SELECT doc_id, COALESCE(text, '') AS text, sha256('42:' || COALESCE(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(COALESCE(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents),
drawn AS (
  SELECT *, CAST(len(units) AS BIGINT) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM d),
cuts AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM drawn),
parts AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:n], '') AS suffix,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM cuts)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_mix_sources": OP3_MIX_SOURCES,
        "op12_source_divergence": OP12_SOURCE_DIVERGENCE,
        "op13_fill_in_middle": OP13_FILL_IN_MIDDLE,
    }
