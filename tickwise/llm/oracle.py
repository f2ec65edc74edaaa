"""DuckDB SQL for the queries that SQL can express, written from the contracts."""

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATE = rf"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS rid,
         coalesce(regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL
),
sized AS (SELECT item, w, least(13, len(w)) AS m FROM items WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item, m, array_to_string(w[i:i + m - 1], ' ') AS win
  FROM (SELECT item, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i FROM sized)
),
places AS (
  SELECT rid, i, m, array_to_string(w[i:i + m - 1], ' ') AS win
  FROM (SELECT rid, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i
        FROM docs, (SELECT DISTINCT m FROM sized) WHERE len(w) >= m)
),
found AS (SELECT rid, i, places.m, item FROM places JOIN windows USING (m, win)),
hit AS (
  SELECT rid, count(DISTINCT p) AS n_hit
  FROM (SELECT rid, unnest(generate_series(i, i + m - 1)) AS p FROM found) GROUP BY rid
),
named AS (
  SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids
  FROM found GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit USING (rid) LEFT JOIN named USING (rid)"""

URL_FILTER = """
WITH rules(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
rest AS (
  SELECT page_id, row_number() OVER () AS rid,
         CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
  FROM pages
),
cut AS (
  SELECT page_id, rid, r, regexp_extract(r, '^[^/?#]*') AS raw,
         translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host
  FROM rest
),
parts AS (
  SELECT page_id, rid, host, regexp_extract(substr(r, length(raw) + 1), '^[^?#]*') AS path FROM cut
),
best AS (
  SELECT rid, arg_max(h || p, length(h || p) * 10000 + length(h)) AS rule,
         arg_max(v, length(h || p) * 10000 + length(h)) AS v
  FROM parts, rules
  WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY rid
)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM parts LEFT JOIN best USING (rid)"""

LINE_DEDUP = r"""
WITH docs AS (
  SELECT doc_id, source, row_number() OVER () AS rid, string_split(text, chr(10)) AS lines FROM documents
),
pages AS (SELECT source, count(*) AS pages FROM docs WHERE source IS NOT NULL GROUP BY source),
held AS (
  SELECT source, line, count(*) AS n
  FROM (SELECT DISTINCT source, rid, trim(line, ' ' || chr(9) || chr(13)) AS line
        FROM (SELECT source, rid, unnest(lines) AS line FROM docs WHERE source IS NOT NULL))
  WHERE line <> '' GROUP BY source, line
),
boilerplate AS (
  SELECT source, line FROM held JOIN pages USING (source)
  WHERE n >= 2 AND n / pages > 0.1
),
numbered AS (
  SELECT rid, source, unnest(lines) AS raw, unnest(generate_series(1, len(lines))) AS i FROM docs
),
marked AS (
  SELECT rid, i, raw, b.line IS NOT NULL AS dropped
  FROM numbered AS l
  LEFT JOIN boilerplate AS b ON l.source = b.source AND trim(l.raw, ' ' || chr(9) || chr(13)) = b.line
)
SELECT doc_id, CAST(coalesce(len(lines), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(n_dropped, 0) AS BIGINT) AS n_dropped,
       CASE WHEN lines IS NOT NULL THEN sha256(coalesce(kept, '')) END AS text_sha256
FROM docs LEFT JOIN (
  SELECT rid, count(*) FILTER (WHERE dropped) AS n_dropped,
         string_agg(raw, chr(10) ORDER BY i) FILTER (WHERE NOT dropped) AS kept
  FROM marked GROUP BY rid
) USING (rid)"""

LEXICAL_SEARCH = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents WHERE text IS NOT NULL
),
corpus AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS words FROM docs WHERE len(w) > 0),
held AS (
  SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(w) AS term FROM docs) GROUP BY rid, term
),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM held, corpus GROUP BY term
),
lengths AS (SELECT rid, doc_id, 100 - 90 + (90 * CAST(len(w) AS BIGINT) * docs) // words AS m FROM docs, corpus WHERE len(w) > 0),
items AS (
  SELECT DISTINCT q, item_id, term FROM (
    SELECT row_number() OVER () AS q, item_id,
           unnest(regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark WHERE text IS NOT NULL)
),
scored AS (
  SELECT q, item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM items JOIN weights USING (term) JOIN held USING (term) JOIN lengths USING (rid)
  GROUP BY q, item_id, rid, doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10"""

SQL = {"op2_decontaminate": DECONTAMINATE, "op4_url_filter": URL_FILTER, "op5_line_dedup": LINE_DEDUP,
       "op11_lexical_search": LEXICAL_SEARCH}
