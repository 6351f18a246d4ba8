"""DuckDB SQL for the queries that SQL can express."""

from gridpulse.llm.spotsigs import ANCHORS

ORACLE_SQL = {
    "op1_warc_index": r"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages
), d AS (
  SELECT page_id, url, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p
), f AS (
  SELECT payload_digest AS dg, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100
  GROUP BY payload_digest HAVING count(*) > 1
), k AS (
  SELECT d.*, CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to,
    CASE WHEN url = '' THEN '' ELSE
      array_to_string(list_reverse(string_split(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#:]*)', 1)), '.')), ',')
      || ')' || regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^#]*)', 1) END AS urlkey,
    strftime(TIMESTAMP '2024-01-01' + to_seconds(coalesce(page_id, 0)), '%Y-%m-%dT%H:%M:%SZ') AS capture_time
  FROM d LEFT JOIN f ON dg = payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to, urlkey, capture_time,
  row_number() OVER (ORDER BY urlkey, capture_time, page_id NULLS LAST) - 1 AS position
FROM k
""",
    "op3_benchmark_decontamination": r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS m, array_to_string(w[i:i + 9], ' ') AS s
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM iw WHERE len(w) > 0)
), spots AS (
  SELECT doc_id, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i
  FROM dw, (SELECT DISTINCT m FROM win) WHERE len(w) >= m
), hit AS (
  SELECT a.doc_id, a.i, a.m, win.item_id FROM spots a JOIN win ON win.m = a.m AND win.s = array_to_string(a.w[a.i:a.i + a.m - 1], ' ')
), pos AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + m - 1)) AS p FROM hit) GROUP BY doc_id
), its AS (
  SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids FROM hit GROUP BY doc_id
)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
""",
    "op7_spot_signatures": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
    coalesce(lead(coalesce(text, '')) OVER w, first_value(coalesce(text, '')) OVER w) AS nxt
  FROM documents WINDOW w AS (ORDER BY doc_id NULLS FIRST, text NULLS FIRST)
), e AS (
  SELECT *, substr(text, 1, CAST(length(text) - length(text) // 2 AS BIGINT)) || substr(nxt, 1, CAST(length(text) // 2 AS BIGINT)) AS edited FROM d
), t AS (
  SELECT row_number() OVER () AS r, doc_id, text, edited, nxt FROM e
), parts AS (
  SELECT r, 'own' AS kind, text AS body FROM t UNION ALL SELECT r, 'changed', edited FROM t UNION ALL SELECT r, 'following', nxt FROM t
), words AS (
  SELECT r, kind, body, list_filter(regexp_split_to_array(lower(body), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM parts
), places AS (
  SELECT *, list_filter(range(1, len(w) + 1), lambda i: length(w[i]) <= 2 OR list_contains([%s], w[i])) AS spots FROM words
), sigs AS (
  SELECT r, kind, CASE WHEN len(w) > 0 THEN
      list_transform(CASE WHEN len(spots) > 0 THEN spots ELSE range(1, len(w) + 1) END,
        lambda i: array_to_string(list_concat([w[i]], list_filter(w[i + 1:i + 6], lambda x: NOT (length(x) <= 2 OR list_contains([%s], x)))[1:2]), ':'))
    WHEN body = '' THEN CAST([] AS VARCHAR[]) ELSE [body] END AS s FROM places
), marks AS (
  SELECT r, kind, list_sort(list_distinct(list_transform(s, lambda x: substr(md5(x), 1, 8)))) AS m FROM sigs
), wide AS (
  SELECT r, max(m) FILTER (kind = 'own') AS a, max(m) FILTER (kind = 'changed') AS b, max(m) FILTER (kind = 'following') AS c
  FROM marks GROUP BY r
)
SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256,
  array_to_string(a, ' ') AS fingerprint, array_to_string(b, ' ') AS edited_fingerprint,
  CASE WHEN len(a) + len(b) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(a, b))::DOUBLE / (len(a) + len(b) - len(list_intersect(a, b))) END AS near_edited,
  CASE WHEN len(a) + len(c) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(a, c))::DOUBLE / (len(a) + len(c) - len(list_intersect(a, c))) END AS near_next
FROM t JOIN wide USING (r)
""" % ((", ".join(f"'{w}'" for w in ANCHORS),) * 2),
    "op5_ngram_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 3))) AS i FROM w WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
), l AS (
  SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * k >= 85 * (nx.n + ny.n - k)
), reach(x, y) AS (
  SELECT x, y FROM l UNION SELECT reach.x, l.y FROM reach JOIN l ON reach.y = l.x
), least_id AS (
  SELECT x, min(y) AS m FROM reach GROUP BY x
), degree AS (
  SELECT x, count(*) AS n_links FROM l GROUP BY x
)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(w.doc_id, coalesce(m, w.doc_id)) AS component_id,
  CAST(coalesce(n_links, 0) AS BIGINT) AS n_links
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN least_id ON least_id.x = w.doc_id LEFT JOIN degree ON degree.x = w.doc_id
""",
    "op4_stupid_backoff": r"""
WITH w AS (
  SELECT doc_id, row_number() OVER () AS r, list_concat(['<s>'], regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM documents
), p AS (
  SELECT doc_id, w[i] AS v, w[i + 1] AS w FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM w)
), pc AS (
  SELECT v, w, count(*) AS n FROM p GROUP BY ALL
), wc AS (
  SELECT w, count(*) AS n FROM p GROUP BY ALL
), vc AS (
  SELECT w, n FROM wc UNION ALL SELECT '<s>', count(*) FROM w WHERE len(w) > 1
), s AS (
  SELECT p.doc_id, count(*) AS n, sum(CASE WHEN pc.n >= 1 THEN ln(pc.n) - ln(vc.n)
    ELSE ln(0.4) - ln((SELECT count(*) FROM p)) + ln(wc.n) END) AS score
  FROM p JOIN pc ON pc.v = p.v AND pc.w = p.w JOIN wc ON wc.w = p.w JOIN vc ON vc.w = p.v GROUP BY p.doc_id
)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_tokens, round(coalesce(score, 0.0), 3) AS score,
  round(score / n, 6) AS mean_log_score
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN s ON s.doc_id = d.doc_id
""",
    "op12_exact_dedup": r"""
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY x) AS keep_id, count(*) OVER (PARTITION BY x) AS group_size,
  row_number() OVER (PARTITION BY x ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(x) AS text_sha256
FROM t
""",
    "op13_lexical_search": r"""
WITH d AS (
  SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), i AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark
), r AS (
  SELECT item_id, t, count(*) AS r FROM i GROUP BY ALL
), s AS (
  SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS total FROM d WHERE len(w) > 0
), f AS (
  SELECT d, doc_id, n, t, count(*) AS tf FROM (SELECT d, doc_id, len(w) AS n, unnest(w) AS t FROM d)
  WHERE t IN (SELECT t FROM r) GROUP BY ALL
), g AS (
  SELECT t, CAST(floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS weight FROM f, s GROUP BY t
), c AS (
  SELECT d, doc_id, t, weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * docs) // total)))) AS gain
  FROM f JOIN g USING (t), s
), p AS (
  SELECT item_id, d, doc_id, CAST(sum(r * gain) AS BIGINT) AS score FROM c JOIN r USING (t) GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER w AS INTEGER) AS rank, doc_id, score FROM p WHERE score > 0
WINDOW w AS (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) QUALIFY rank <= 10
""",
}
