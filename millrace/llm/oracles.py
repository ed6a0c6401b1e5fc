"""DuckDB SQL for the queries that SQL can express."""

OP2_SQL = r"""
WITH RECURSIVE parts AS (
  SELECT page_id, coalesce(url, '') AS url,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), tokened AS (
  SELECT *, row_number() OVER () AS rid, list_sort(list_distinct(list_filter(list_concat(
      ['host=' || host, 'tld=' || string_split(host, '.')[-1]],
      list_transform(string_split(host, '.'), lambda x: 'label=' || x),
      ['dir=' || regexp_extract(path, '(?s)^/([^/]*)/', 1), 'end=' || regexp_extract(path, '(?s)\.([A-Za-z0-9]{1,8})$', 1),
       CASE WHEN length(path) > 1 AND ends_with(path, '/') THEN 'slash=yes' END, CASE WHEN contains(url, '#') THEN 'fragment=yes' END],
      list_transform(string_split(regexp_extract(url, '(?s)^[^?#]*\?([^#]*)', 1), '&'), lambda p: 'query=' || regexp_extract(p, '(?s)^([^=]*)', 1))
    ), lambda t: t IS NOT NULL AND NOT ends_with(t, '=')))) AS tokens,
    CASE WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
      WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
      WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
      WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
      WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM parts
), labelled AS (
  SELECT row_number() OVER () AS lid, tokens, quality = 0 AS bad FROM tokened JOIN labels ON page_id = doc_id WHERE quality IS NOT NULL
), tok AS (
  SELECT lid, bad, unnest(tokens) AS t FROM labelled
), sets(lid, bad, s) AS (
  SELECT lid, bad, [t] FROM tok
  UNION ALL SELECT a.lid, a.bad, list_append(a.s, b.t) FROM sets a JOIN tok b ON a.lid = b.lid AND a.s[-1] < b.t
), totals AS (
  SELECT CAST(count(*) AS DOUBLE) AS n, CAST(count_if(bad) AS DOUBLE) AS b FROM labelled
), counted AS (
  SELECT s, CAST(count(*) AS DOUBLE) AS n, CAST(count_if(bad) AS DOUBLE) AS b FROM sets GROUP BY s
), rules AS (
  SELECT s, c.b / c.n AS confidence, c.b / t.n AS support, array_to_string(s, ' ') AS mined FROM counted c, totals t
  WHERE c.b >= ceil(0.002 * t.n) AND c.b > 0 AND c.b / c.n >= 0.35 AND (c.b / c.n) / (t.b / t.n) >= 2.0
    AND (c.b / c.n + 1.645 * 1.645 / (2 * c.n) - 1.645 * sqrt((c.b / c.n) * (1 - c.b / c.n) / c.n + 1.645 * 1.645 / (4 * c.n * c.n))) / (1 + 1.645 * 1.645 / c.n) >= 0.25
), best AS (
  SELECT rid, max({'confidence': confidence, 'support': support, 'mined': mined}) AS r FROM tokened JOIN rules ON list_has_all(tokens, s) WHERE rule IS NULL GROUP BY rid
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL OR r IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict, r.mined AS mined_rule
FROM tokened LEFT JOIN best USING (rid)
"""

OP10_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
    CASE WHEN source IS NULL THEN '-' ELSE '+' || source END AS src,
    md5(concat_ws('|', '20240131', coalesce(CAST(doc_id AS VARCHAR), '-'), coalesce(md5(text), '-'))) AS k
  FROM documents
), sources AS (
  SELECT src, CAST(sum(size) AS BIGINT) AS s,
    CASE (row_number() OVER (ORDER BY src = '-', src) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w,
    row_number() OVER (ORDER BY src = '-', src) AS ord
  FROM sized GROUP BY src
), room AS (
  SELECT *, 2 * s / CAST(w AS DOUBLE) AS ratio, row_number() OVER (ORDER BY 2 * s / CAST(w AS DOUBLE), ord) AS place FROM sources
), levels AS (
  SELECT *, 1.5 * (SELECT sum(s) FROM sources) - coalesce(sum(2 * s) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
    (SELECT sum(w) FROM sources) - coalesce(sum(w) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS heavy
  FROM room
), first_open AS (
  SELECT min(place) AS place FROM levels WHERE CAST(remaining AS DOUBLE) / heavy * w <= 2 * s
), targets AS (
  SELECT src, s, CASE WHEN f.place IS NULL OR l.place < f.place THEN 2.0 * s
    ELSE (SELECT CAST(remaining AS DOUBLE) / heavy FROM levels x WHERE x.place = f.place) * w END::DOUBLE AS target
  FROM levels l, first_open f
), keyed AS (
  SELECT src, k, sum(size) AS size FROM sized GROUP BY src, k
), ranked AS (
  SELECT src, k, size, sum(size) OVER (PARTITION BY src ORDER BY k) - size AS before_ FROM keyed
), plan AS (
  SELECT *, CASE WHEN s > 0 THEN CAST(floor(target / s + 1e-9) AS BIGINT) ELSE 0 END AS passes FROM targets
), cuts AS (
  SELECT src, max(k) AS upto FROM ranked JOIN plan USING (src)
  WHERE s > 0 AND target - passes * s > 0 AND before_ + size / 2.0 <= target - passes * s GROUP BY src
)
SELECT doc_id, CAST(size AS BIGINT) AS size, s AS source_size, target,
  CAST(size * (passes + CASE WHEN upto IS NOT NULL AND k <= upto THEN 1 ELSE 0 END) AS BIGINT) AS taken, source
FROM sized JOIN plan USING (src) LEFT JOIN cuts USING (src)
"""

OP6_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, text, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS ws FROM documents WHERE text IS NOT NULL
), shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) = 0 THEN 'text:' || text WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 4], ' ') END AS s
  FROM worded, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) r(i)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE c * 10 >= 8 * (p.n + q.n - c)
), reach(x, y) AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), classes AS (
  SELECT x, min(y) AS least FROM reach GROUP BY x
), degrees AS (
  SELECT x, count(*) AS n FROM links GROUP BY x
), copies AS (
  SELECT doc_id, count(*) OVER (PARTITION BY CASE WHEN len(ws) = 0 THEN 'text:' || text ELSE array_to_string(ws, ' ') END) - 1 AS n FROM worded
)
SELECT d.doc_id, least(d.doc_id, coalesce(k.least, d.doc_id)) AS class_id, coalesce(g.n, 0) AS n_links, coalesce(c.n, 0) AS n_copies
FROM documents d LEFT JOIN classes k ON k.x = d.doc_id LEFT JOIN degrees g ON g.x = d.doc_id LEFT JOIN copies c ON c.doc_id = d.doc_id
"""
