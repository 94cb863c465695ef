"""SQL counterparts of the queries that SQL can express."""

_LINES = """
parts AS (
  SELECT doc_id, source, pos, line, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS bare
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)
),
spread AS (SELECT bare FROM parts WHERE bare <> '' AND source IS NOT NULL GROUP BY bare HAVING count(DISTINCT source) >= 10),
marked AS (SELECT p.doc_id, p.pos, p.line, length(p.bare) AS n, s.bare IS NOT NULL AS hit FROM parts p LEFT JOIN spread s ON p.bare = s.bare),
judged AS (
  SELECT doc_id, count(*) FILTER (hit) AS hits,
         count(*) FILTER (NOT hit AND n > 0) > 0 AS cut,
         string_agg(line, chr(10) ORDER BY pos) FILTER (NOT hit) AS rest
  FROM marked GROUP BY doc_id
)
"""

ORACLE: dict[str, str] = {
    "op3_line_dedup": f"""
WITH {_LINES}
SELECT d.doc_id, CASE WHEN j.cut THEN j.hits ELSE 0 END::BIGINT AS n_removed,
       CASE WHEN j.cut AND j.hits > 0 THEN coalesce(j.rest, '') ELSE d.text END AS text
FROM documents d LEFT JOIN judged j ON d.doc_id = j.doc_id
""",
    "op4_minhash": r"""
WITH RECURSIVE tokens AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents
),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
         ELSE list_transform(generate_series(1, len(w) - 3), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM tokens
),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
),
links AS (SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.x, reach.r FROM reach JOIN links l ON l.y = reach.doc_id WHERE reach.r < l.x)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) m ON m.doc_id = d.doc_id
""",
    "op6_impact_search": """
WITH fine AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM fine q JOIN fine c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, rank, vec_id, score
FROM (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank FROM scored) WHERE rank <= 20
""",
    "op8_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5('mix:' || doc_id) AS k
  FROM documents
),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, source) AS r FROM sized GROUP BY source
),
weighed AS (SELECT *, [3.0, 1.0, 2.0][((r - 1) % 3 + 1)::INT]::DOUBLE AS w, source_size::DOUBLE * 2.0::DOUBLE AS cap FROM sources),
levels AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
            - coalesce(sum(cap) OVER (ORDER BY cap / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
         / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) AS level
  FROM weighed
),
aims AS (
  SELECT source, source_size, coalesce(least(cap, w * (max(level) OVER ())), cap) AS target FROM levels
),
running AS (
  SELECT s.doc_id, s.size, a.source_size, a.target, round(a.target)::BIGINT AS budget,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) - s.size AS before
  FROM sized s JOIN aims a ON s.source IS NOT DISTINCT FROM a.source
)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size = 0 THEN 0
             ELSE size * (budget // source_size) + least(greatest(budget % source_size - before, 0), size) END)::BIGINT AS taken
FROM running
""",
    "op9_passages": r"""
WITH tokens AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM tokens WHERE len(w) >= 13)
),
firsts AS (SELECT s, min(doc_id) AS first_id FROM windows GROUP BY s HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT DISTINCT doc_id, i + j AS p
  FROM (SELECT v.doc_id, v.i, unnest(generate_series(0, 12)) AS j FROM windows v JOIN firsts f ON v.s = f.s AND f.first_id < v.doc_id)
),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM tokens),
kept AS (
  SELECT w.doc_id, count(g.p) AS n, string_agg(w.word, ' ' ORDER BY w.p) FILTER (g.p IS NULL) AS rest
  FROM words w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.p = g.p GROUP BY w.doc_id
)
SELECT t.doc_id, len(t.w)::BIGINT AS n_words, coalesce(k.n, 0)::BIGINT AS n_removed, sha256(coalesce(k.rest, '')) AS kept_sha256
FROM tokens t LEFT JOIN kept k ON k.doc_id = t.doc_id
""",
    "op13_ranked_search": r"""
WITH held AS (
  SELECT d.doc_id, d.row, t.term
  FROM (SELECT doc_id, row_number() OVER () AS row,
               regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents) d,
       unnest(d.terms) AS t(term)
),
lengths AS (SELECT row, any_value(doc_id) AS doc_id, count(*)::BIGINT AS n FROM held GROUP BY row),
totals AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM lengths),
asked AS (
  SELECT item_id, term, count(*)::BIGINT AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY item_id, term
),
postings AS (
  SELECT row, term, count(*)::BIGINT AS tf FROM held WHERE term IN (SELECT term FROM asked) GROUP BY row, term
),
weights AS (SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM postings, totals GROUP BY term, nn),
impacts AS (
  SELECT p.row, l.doc_id, p.term, w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (100 - 75 + (75 * l.n * nn) // ll))) AS impact
  FROM postings p JOIN lengths l USING (row) JOIN weights w USING (term), totals
),
scores AS (
  SELECT a.item_id, i.row, i.doc_id, sum(a.times * i.impact)::BIGINT AS score FROM asked a JOIN impacts i USING (term) GROUP BY a.item_id, i.row, i.doc_id
)
SELECT item_id, rank, doc_id, score
FROM (SELECT *, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST))::INT AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
""",
}
