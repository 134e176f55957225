"""DuckDB SQL of the queries that SQL can express."""

SQL: dict[str, str] = {}

SQL["op5_substring_dedup"] = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g
  FROM w, unnest(range(1, len(ws) - 11)) AS u(i)
), low AS (
  SELECT g, min(doc_id) AS lowest FROM win GROUP BY g HAVING count(DISTINCT doc_id) > 1
), gone AS (
  SELECT DISTINCT doc_id, p FROM (
    SELECT win.doc_id, unnest(range(i, i + 13)) AS p FROM win JOIN low USING (g) WHERE win.doc_id > lowest)
), tok AS (
  SELECT doc_id, p, ws[p] AS t FROM w, unnest(range(1, len(ws) + 1)) AS u(p)
), kept AS (
  SELECT tok.doc_id, string_agg(t, ' ' ORDER BY p) AS s, count(*) AS n
  FROM tok ANTI JOIN gone ON gone.doc_id = tok.doc_id AND gone.p = tok.p GROUP BY tok.doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(s, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

SQL["op2_ngram_jaccard_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), sh AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 2], ' ') AS g
  FROM w, unnest(range(1, greatest(len(ws) - 1, CASE WHEN len(ws) > 0 THEN 2 ELSE 1 END))) AS u(i)
), n AS (
  SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * common >= 90 * (nx.n + ny.n - common)
), edges AS (
  SELECT x, y FROM links UNION SELECT y, x FROM links
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, edges.y FROM reach JOIN edges ON edges.x = reach.b
)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, (SELECT min(b) FROM reach WHERE a = w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id)
"""

_VECTORS = """
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0"""

#: Exact search: the query equals it where every part is asked, as on small tables.
SQL["op7_nearest_neighbours"] = f"""
WITH v AS ({_VECTORS}
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""

SQL["op9_embedding_near_dedup"] = f"""
WITH RECURSIVE v AS ({_VECTORS} AND label IS NOT NULL
), edges AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v)) / sqrt(list_dot_product(b.v, b.v)) >= 0.98
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT reach.a, edges.y FROM reach JOIN edges ON edges.x = reach.b
)
SELECT e.vec_id, (SELECT count(*) FROM edges WHERE x = e.vec_id) AS n_links,
       (SELECT min(b) FROM reach WHERE a = e.vec_id) AS component_id,
       e.vec_id = (SELECT min(b) FROM reach WHERE a = e.vec_id) AS kept
FROM embeddings e
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL["op12_phrase_collocations"] = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
), total AS (
  SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang
), f AS (
  SELECT lang, array_to_string(ws[i:i + k - 1], ' ') AS phrase, k, count(*) AS f
  FROM w, unnest(range(1, 6)) AS u(k), unnest(range(1, len(ws) - k + 2)) AS v(i) GROUP BY ALL HAVING count(*) >= 100
), cand AS (
  SELECT lang, phrase, k AS words, f AS a FROM f WHERE k >= 2
), inside AS (
  SELECT c.lang, array_to_string(string_split(c.phrase, ' ')[s:s + m - 1], ' ') AS phrase, max(c.a) AS longer
  FROM cand c, unnest(range(2, c.words)) AS u(m), unnest(range(1, c.words - m + 2)) AS v(s) GROUP BY ALL
), free AS (
  SELECT c.* FROM cand c LEFT JOIN inside i ON i.lang = c.lang AND i.phrase = c.phrase WHERE i.longer IS NULL OR 100 * i.longer < 100 * c.a
), cuts AS (
  SELECT c.lang, c.phrase, c.a, total.n, cut, l.f AS l, r.f AS r,
         CAST((CAST(1000 AS HUGEINT) * c.a * total.n) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM free c, unnest(range(1, c.words)) AS u(cut), f l, f r, total
  WHERE total.lang = c.lang AND l.lang = c.lang AND r.lang = c.lang
    AND l.phrase = array_to_string(string_split(c.phrase, ' ')[1:cut], ' ')
    AND r.phrase = array_to_string(string_split(c.phrase, ' ')[cut + 1:], ' ')
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000
"""

SQL["op13_exact_dedup"] = f"""
WITH d AS (SELECT doc_id, {_LOWER} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""
