"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE_SQL["op8_decontamination"] = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
  items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
  windows AS (SELECT DISTINCT item_id, w[i + 1:i + least(13, len(w))] AS win
    FROM items, unnest(range(0, greatest(1, len(w) - 12))) AS t(i) WHERE len(w) > 0),
  sizes AS (SELECT DISTINCT len(win) AS n FROM windows),
  grams AS (SELECT rid, i, n, w[i + 1:i + n] AS gram FROM (SELECT rid, w, n, unnest(range(0, len(w) - n + 1)) AS i FROM docs, sizes)),
  found AS (SELECT rid, i, n, item_id FROM grams JOIN windows ON gram = win),
  hits AS (SELECT rid, COUNT(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT rid, i, n FROM found)) GROUP BY rid),
  named AS (SELECT rid, COUNT(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT rid, item_id FROM found) GROUP BY rid)
SELECT doc_id, len(w) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items, sha256(COALESCE(ids, '')) AS items_sha256,
  COALESCE(n_hit, 0) > 0 AND 20 * COALESCE(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hits USING (rid) LEFT JOIN named USING (rid)"""

# base32 of a SHA-1: each five bytes are eight letters
_DIGITS = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(h, {10 * part + 1}, 10) AS BIGINT) >> {35 - 5 * k}) & 31 AS INTEGER) + 1, 1)"
    for part in range(4) for k in range(8))
ORACLE_SQL["op4_warc"] = f"""
WITH p AS (SELECT page_id, COALESCE(html, '') AS t, sha1(COALESCE(html, '')) AS h, MIN(page_id) OVER (PARTITION BY COALESCE(html, '')) AS f FROM pages)
SELECT page_id, CAST(strlen(t) AS BIGINT) AS payload_bytes, {_DIGITS} AS payload_digest,
  CASE WHEN page_id IS DISTINCT FROM f AND f IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM f THEN f END AS refers_to
FROM p"""

_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE_SQL["op13_ranked_search"] = f"""
WITH docs AS (SELECT * FROM (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS t FROM documents) WHERE len(t) > 0),
  items AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
  tfs AS (SELECT rid, term, COUNT(*) AS tf FROM (SELECT rid, unnest(t) AS term FROM docs) WHERE term IN (SELECT term FROM items) GROUP BY rid, term),
  size AS (SELECT COUNT(*) AS big_n, CAST(SUM(len(t)) AS BIGINT) AS big_l FROM docs),
  weights AS (SELECT term, CAST(floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * COUNT(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM tfs, size GROUP BY term, big_n),
  lengths AS (SELECT rid, doc_id, 100 - 50 + (50 * len(t) * big_n) // big_l AS m FROM docs, size),
  scores AS (SELECT item_id, rid, CAST(SUM(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
    FROM items JOIN tfs USING (term) JOIN weights USING (term) JOIN lengths USING (rid) GROUP BY item_id, rid),
  ranked AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
    FROM scores JOIN lengths USING (rid) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50"""

ORACLE_SQL["op11_collocations"] = """
WITH texts AS (SELECT COALESCE(lang, 'und') AS lang, translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
  pieces AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS w FROM texts),
  totals AS (SELECT lang, CAST(SUM(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
  grams AS (SELECT lang, w[i:i + k - 1] AS p FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, (VALUES (1), (2), (3)) AS t(k))),
  f AS MATERIALIZED (SELECT lang, p, COUNT(*) AS a FROM grams GROUP BY lang, p HAVING COUNT(*) >= 10),
  cut AS MATERIALIZED (SELECT lang, p, a, k, p[1:k] AS p1, p[k + 1:] AS p2 FROM f, (VALUES (1), (2)) AS t(k) WHERE k < len(p)),
  cuts AS (SELECT c.lang, c.p, c.a, k, l.a AS l, r.a AS r, (1000000 * c.a::HUGEINT * c.a) // (l.a::HUGEINT * r.a) AS score
    FROM cut c JOIN f l ON l.lang = c.lang AND l.p = p1 JOIN f r ON r.lang = c.lang AND r.p = p2),
  best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
  longer AS (SELECT lang, p, MAX(a) AS most FROM (SELECT lang, unnest([p[1:2], p[2:3]]) AS p, a FROM f WHERE len(p) = 3) GROUP BY lang, p),
  kept AS (SELECT b.*, array_to_string(b.p, ' ') AS phrase FROM best b LEFT JOIN longer USING (lang, p) WHERE most IS NULL OR 100 * most < 50 * b.a),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept),
  first AS (SELECT * FROM ranked WHERE rank <= 2000)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM first JOIN totals USING (lang)"""
