"""SQL (DuckDB) that states the result of each registered query on the supplied tables."""

from __future__ import annotations

from checks.queries import EDGE_WEIGHT, TOP_TAGS, WORD_PATTERNS
from qaspark.fixed_values import NOISE_LABEL
from qaspark.functions.text import WHITESPACE, default_stopwords
from qaspark.sources.adapters import BRAND_OF, COLOR_OF, PRIORITIES

SPACE = WHITESPACE


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def string_list(items) -> str:
    return "[" + ", ".join(quoted(x) for x in items) + "]"


def values(rows) -> str:
    return ", ".join("(" + ", ".join("NULL" if x is None else quoted(x) for x in row) + ")" for row in rows)


# --- the adapters -------------------------------------------------------------------

Q0 = """q AS (SELECT o_orderkey AS question_id, o_orderpriority AS language,
  CAST(year(o_orderdate) AS INTEGER) AS year, o_orderdate AS creation_date, o_totalprice AS score,
  o_custkey AS view_count, o_orderstatus = 'F' AS is_answered FROM orders)"""

QT = """tagged AS (SELECT o_orderkey AS question_id, o_orderpriority AS language, o_orderdate AS creation_date,
  coalesce(t.tags, []) AS tags
  FROM orders LEFT JOIN (SELECT l_orderkey, list_sort(list(DISTINCT p_name)) AS tags
    FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1) t ON l_orderkey = o_orderkey)"""

V = """v AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_custkey AS respondent,
  list_sort(list(DISTINCT p_brand)) AS have,
  list_sort(list(DISTINCT p_brand) FILTER (WHERE l_returnflag = 'R')) AS want
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)"""

TAGS = """tag_stats AS (SELECT p_brand AS name, o_orderpriority AS language, count(*) AS count
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)"""

LANGS = f"langs(language, display_name, color) AS (VALUES {values((p, BRAND_OF[p], COLOR_OF.get(p)) for p in PRIORITIES)})"

YEARLY = f"""{Q0}, yearly AS (SELECT language, year, count(question_id) AS sample_count,
  round_even(median(score), 2) AS median_score, round_even(median(CAST(view_count AS DOUBLE)), 2) AS median_views,
  round_even(avg(CAST(is_answered AS DOUBLE)), 2) AS answer_rate FROM q GROUP BY 1, 2)"""

SURVEY = f"""{V}, {LANGS}, per_year AS (SELECT year, count(have) AS respondents, count(want) AS wanting FROM v GROUP BY 1),
shares AS (SELECT p.year, l.language, l.display_name, p.respondents,
  round_even(CAST((SELECT count(*) FROM v WHERE v.year = p.year AND list_contains(v.have, l.display_name)) AS DOUBLE)
    / p.respondents * 100, 2) AS usage_pct,
  round_even(CAST((SELECT count(*) FROM v WHERE v.year = p.year AND list_contains(v.want, l.display_name)) AS DOUBLE)
    / p.wanting * 100, 2) AS want_pct
  FROM per_year p, langs l),
survey AS (SELECT *, CASE WHEN want_pct <> 0 AND usage_pct > 0 THEN round_even(want_pct / usage_pct, 3) END AS aspiration
  FROM shares)"""

TRENDS = f"""{YEARLY}, {SURVEY}, trends AS (SELECT year, language, sample_count, median_score, median_views, answer_rate,
  display_name, respondents, usage_pct, want_pct, aspiration FROM yearly LEFT JOIN survey USING (year, language))"""

TOTALS = f"""{TAGS}, totals AS (SELECT l.language, coalesce(arg_min(t.count, t.language), 0) AS total_questions
  FROM langs l LEFT JOIN tag_stats t ON t.name = l.display_name GROUP BY 1)"""

# The payloads know the tags by their language, whose own row comes first.
OWN_TOTALS = TOTALS.replace("arg_min(t.count, t.language)", "arg_min(t.count, CASE WHEN t.language = l.language THEN '0' ELSE '1' END || t.language)")


def figures(value: str, order: str = "year") -> str:
    return f"string_agg(coalesce(CAST(CAST({value} AS DECIMAL(18,3)) AS VARCHAR), 'null'), ',' ORDER BY {order})"


# --- texts ---------------------------------------------------------------------------

def unescape(text: str) -> str:
    """The entities found in the supplied pages, also cut off before their semicolon; the ampersand comes last."""
    for name, char in (("middot", "·"), ("copy", "©"), ("quot", '"'), ("lt", "<"), ("amp", "&")):
        text = f"regexp_replace({text}, '&{name};?', {quoted(char)}, 'g')"
    return text


def strip(text: str) -> str:
    return f"regexp_replace({text}, {quoted(f'^[{SPACE}]+|[{SPACE}]+$')}, '', 'g')"


def visible_text(html: str) -> str:
    text = html
    for pattern in (
        r"(?is)<script[^>]*>.*?</script[^>]*>", r"(?is)<style[^>]*>.*?</style[^>]*>",
        r"(?is)<template[^>]*>.*?</template[^>]*>", r"(?s)<!--.*?-->", r"<!?/?[A-Za-z][^>]*>",
    ):
        text = f"regexp_replace({text}, {quoted(pattern)}, ' ', 'g')"
    return strip(f"regexp_replace({unescape(text)}, {quoted(f'[{SPACE}]+')}, ' ', 'g')")


def word_list(text: str) -> str:
    text = f"lower(regexp_replace({text}, '`[^`]+`', ' ', 'g'))"
    text = f"""regexp_replace({text}, {quoted('([,:;@#$%&?!()' + chr(92) + '[' + chr(92) + ']{}<>"]|--)')}, ' \\1 ', 'g')"""
    contraction = quoted(r"(n't|'s|'m|'d|'ll|'re|'ve)([^\p{L}\p{N}_]|$)")
    text = f"regexp_replace({text}, {contraction}, ' \\1\\2', 'g')"
    parts = f"regexp_split_to_array({text}, {quoted(f'[{SPACE}]+')})"
    ends = quoted(r"""[.'"]+$""")
    trimmed = f"list_transform({parts}, lambda w: regexp_replace(w, {ends}, ''))"
    return f"list_filter({trimmed}, lambda w: regexp_full_match(w, {quoted(chr(92) + 'p{L}+')}))"


STOP = string_list(default_stopwords())
D = "d AS (SELECT doc_id, lang AS language, text, source AS cluster_id FROM documents)"


def without(words: str) -> str:
    return f"list_filter({words}, lambda w: NOT list_contains({STOP}, w))"


def kept_words(text: str) -> str:
    pattern = quoted(r"[\p{L}\p{N}_]{2,}")
    return without(f"regexp_extract_all(lower({text}), {pattern})")


def counts(name: str, source: str) -> str:
    """CTEs for term counts of ``source(language, doc_id, text)``."""
    return f"""{name}_w AS (SELECT language, doc_id, {kept_words("text")} AS w FROM {source}),
{name}_t AS (SELECT language, doc_id, unnest(w) AS term FROM {name}_w
  UNION ALL SELECT language, doc_id, w[i] || ' ' || w[i + 1]
  FROM (SELECT language, doc_id, w, unnest(range(1, len(w))) AS i FROM {name}_w)),
{name} AS (SELECT language, doc_id, term, count(*) AS tf FROM {name}_t GROUP BY 1, 2, 3)"""


VOCAB = f"""{D}, {counts("c", "d")}, n_docs AS (SELECT language, count(*) AS n FROM d GROUP BY 1),
per_term AS (SELECT language, term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS ctf FROM c GROUP BY 1, 2 HAVING count(*) >= 3),
vocab AS (SELECT language, term, df, ctf, ln((1 + n) / (1 + df)) + 1 AS idf
  FROM (SELECT *, row_number() OVER (PARTITION BY language ORDER BY ctf DESC, term) AS rk FROM per_term)
  JOIN n_docs USING (language) WHERE rk <= 5000)"""


def weights(name: str, source: str) -> str:
    return f"""{name}_raw AS (SELECT language, doc_id, term, tf, (1 + ln(tf)) * idf AS w FROM {source} JOIN vocab USING (language, term)),
{name} AS (SELECT language, doc_id, term, tf, w / sqrt(sum(w * w) OVER (PARTITION BY language, doc_id)) AS weight FROM {name}_raw)"""


# --- graph ---------------------------------------------------------------------------

FREQUENCY = f"""{QT}, frequency AS (SELECT language, tag, count(*) AS frequency
  FROM (SELECT language, unnest(tags) AS tag FROM tagged) GROUP BY 1, 2)"""


def ranked(columns: str, source: str, keys: str, order: str, n: int, keep_rank: bool = True) -> str:
    tail = ", CAST(rk AS INTEGER) AS rank" if keep_rank else ""
    return f"""SELECT {columns}{tail} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rk
  FROM {source}) WHERE rk <= {n}"""


GRAPH = f"""{FREQUENCY}, top AS ({ranked("language, tag, frequency", "frequency", "language", "frequency DESC, tag", TOP_TAGS, False)}),
kept AS (SELECT question_id, language, tag FROM (SELECT question_id, language, unnest(tags) AS tag FROM tagged) JOIN top USING (language, tag)),
edges AS (SELECT a.language, a.tag AS source, b.tag AS target, count(*) AS weight
  FROM kept a JOIN kept b ON a.question_id = b.question_id AND a.tag < b.tag GROUP BY 1, 2, 3 HAVING count(*) >= {EDGE_WEIGHT}),
sides AS (SELECT language, source AS id, target AS other FROM edges UNION ALL SELECT language, target, source FROM edges),
nodes AS (SELECT language, tag AS id, frequency FROM top WHERE (language, tag) IN (SELECT (language, id) FROM sides))"""

DEGREE = f"""{GRAPH}, raw_degree AS (SELECT language, id, count(*) AS degree FROM sides GROUP BY 1, 2),
degree AS (SELECT language, id, degree,
  round_even(CASE WHEN count(*) OVER (PARTITION BY language) <= 1 THEN 1
    ELSE CAST(degree AS DOUBLE) / (count(*) OVER (PARTITION BY language) - 1) END, 4) AS degree_centrality FROM raw_degree)"""

def shortest_paths(weight: str, rounds: int = 12) -> str:
    """Betweenness of every node of the graph: distances and path counts over at most ``rounds`` hops.

    Rounds are written out one after the other; paths through v are those with
    d(s, v) + d(v, t) = d(s, t).
    """
    steps = [f"links AS (SELECT language, source AS u, target AS v, CAST({weight} AS DOUBLE) AS w FROM edges UNION ALL "
             f"SELECT language, target, source, CAST({weight} AS DOUBLE) FROM edges)",
             "d0 AS (SELECT language, id AS s, id AS v, CAST(0 AS DOUBLE) AS d FROM nodes)"]
    for i in range(rounds):
        steps.append(f"""d{i + 1} AS MATERIALIZED (SELECT language, s, v, min(d) AS d FROM (SELECT * FROM d{i} UNION ALL
  SELECT x.language, x.s, l.v, x.d + l.w FROM d{i} x JOIN links l ON l.language = x.language AND l.u = x.v) GROUP BY 1, 2, 3)""")
    steps.append(f"""tight AS MATERIALIZED (SELECT a.language, a.s, a.v AS u, b.v FROM d{rounds} a
  JOIN links l ON l.language = a.language AND l.u = a.v
  JOIN d{rounds} b ON b.language = a.language AND b.s = a.s AND b.v = l.v WHERE a.d + l.w = b.d)""")
    steps.append("p0 AS (SELECT language, id AS s, id AS v, CAST(1 AS DOUBLE) AS n FROM nodes)")
    for i in range(rounds):
        steps.append(f"""p{i + 1} AS MATERIALIZED (SELECT t.language, t.s, t.v, sum(n) AS n FROM p{i} p
  JOIN tight t ON t.language = p.language AND t.s = p.s AND t.u = p.v GROUP BY 1, 2, 3)""")
    counted = " UNION ALL ".join(f"SELECT * FROM p{i}" for i in range(rounds + 1))
    steps.append(f"""paths AS MATERIALIZED (SELECT language, s, v, sum(n) AS n, any_value(d) AS d FROM ({counted})
  JOIN d{rounds} USING (language, s, v) GROUP BY 1, 2, 3)""")
    steps.append("""through AS (SELECT a.language, a.v AS id, sum(a.n * b.n / c.n) AS total FROM paths a
  JOIN paths b ON b.language = a.language AND b.s = a.v JOIN paths c ON c.language = a.language AND c.s = a.s AND c.v = b.v
  WHERE a.s <> a.v AND b.s <> b.v AND a.s <> b.v AND a.d + b.d = c.d GROUP BY 1, 2)""")
    steps.append("sizes AS (SELECT language, count(*) AS n FROM nodes GROUP BY 1)")
    steps.append("""between_nodes AS (SELECT x.language, x.id,
  round_even(coalesce(total, 0) * CASE WHEN n > 2 THEN 1.0 / ((n - 1) * (n - 2)) ELSE 0 END, 4) AS betweenness_centrality
  FROM nodes x JOIN sizes s USING (language) LEFT JOIN through t ON t.language = x.language AND t.id = x.id)""")
    return ", ".join(steps)


def network(weight: str = "weight") -> str:
    """Nodes with degree, betweenness and a community given by the first letter."""
    return f"""{DEGREE}, {shortest_paths(weight)}, full_nodes AS (SELECT language, id, frequency, CAST(ascii(id) % 4 AS INTEGER) AS community,
  degree_centrality, betweenness_centrality FROM nodes JOIN degree USING (language, id) JOIN between_nodes USING (language, id))"""


def trimmed(weight: str = "weight") -> str:
    return f"""{network(weight)}, chosen AS ({ranked("*", "full_nodes", "language", "betweenness_centrality DESC, id", 15, False)}),
inner_edges AS (SELECT language, source, target, weight FROM edges
  WHERE (language, source) IN (SELECT (language, id) FROM chosen) AND (language, target) IN (SELECT (language, id) FROM chosen))"""


NEAR = """pairs AS MATERIALIZED (SELECT a.vec_id, b.vec_id AS nbr,
  list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS d
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
near AS MATERIALIZED (SELECT vec_id, nbr, d, rk FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, nbr) AS rk FROM pairs) WHERE rk <= 3),
cores AS (SELECT vec_id, d AS core FROM near WHERE rk = 3)"""

# --- patterns -------------------------------------------------------------------------

CQ = """cq AS (SELECT doc_id AS question_id, lang AS language, source AS cluster_id, n_chars AS score,
  doc_id % 1000 AS view_count, n_chars % 3 > 0 AS is_answered FROM documents)"""

PATTERNS = f"""{CQ}, profiles AS (SELECT language, cluster_id, count(*) AS size, median(CAST(score AS DOUBLE)) AS ms,
  median(CAST(view_count AS DOUBLE)) AS mv, avg(CAST(is_answered AS DOUBLE)) AS ar FROM cq GROUP BY 1, 2 HAVING count(*) <= 200),
patterns AS (SELECT language, cluster_id,
  CASE WHEN cluster_id = 'src0' THEN 'cluster_src0' ELSE cluster_id || ' / x' END AS label, size,
  round_even(ms, 2) AS median_score, round_even(mv, 1) AS median_views, round_even(ar, 3) AS answer_rate, rank
  FROM ({ranked("*", "profiles", "language", "size DESC, cluster_id", 20)}))"""

EXAMPLES = f"""examples AS ({ranked("language, cluster_id, question_id, score", "cq", "language, cluster_id", "score DESC, question_id", 3)})"""

# Cluster ids hold no blank, so only the words "Cluster" and the id get a capital.
READABLE = """CASE WHEN label LIKE 'cluster%' THEN 'Cluster Src0'
  ELSE upper(split_part(label, ' / ', 1)[1]) || substr(split_part(label, ' / ', 1), 2) END"""

# The cleaning input: events as raw questions.
RAW = """raw AS (SELECT event_id, event_type AS language, user_id * 10 + event_id % 7 AS question_id,
  CASE WHEN value < 2 THEN NULL WHEN value < 4 THEN '  ' || chr(10) || ' '
    ELSE ' ' || event_type || ' &amp;lt; &quot;' || props || '&quot; ' || chr(10) END AS title,
  ['' || event_type, 'user-' || (user_id % 5)] AS tags,
  CAST(floor(epoch(ts)) AS BIGINT) * 100000 + event_id AS creation_order FROM events)"""
CLEANED = f"""{RAW}, titled AS (SELECT * REPLACE ({strip("replace(replace(title, '&quot;', '" + chr(34) + "'), '&amp;', '&')")} AS title)
  FROM raw WHERE title IS NOT NULL),
cleaned AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY
    CASE language WHEN 'view' THEN 1 WHEN 'purchase' THEN 2 WHEN 'click' THEN 3 ELSE 4 END, creation_order) AS rk
  FROM titled WHERE length(title) > 0) WHERE rk = 1)"""

ORACLE = {
    "yearly_counts": f"WITH {YEARLY} SELECT * FROM yearly",
    "survey_trend": f"WITH {SURVEY} SELECT year, language, display_name, respondents, usage_pct, want_pct, aspiration FROM survey",
    "trends_merged": f"WITH {TRENDS} SELECT * FROM trends",
    "total_questions": f"""WITH {LANGS}, {TOTALS} SELECT display_name AS language, total_questions,
        round_even(total_questions / 1e6, 6) AS millions FROM totals JOIN langs USING (language)""",
    "answer_rate_by_language": f"""WITH {Q0} SELECT language, round_even(avg(CAST(is_answered AS DOUBLE)), 9) AS answer_rate
        FROM q GROUP BY 1 ORDER BY 2, 1""",
    "mean_of_yearly": f"""WITH {YEARLY} SELECT language, round_even(avg(median_score), 6) AS mean_median_score,
        round_even(avg(answer_rate), 6) AS mean_answer_rate FROM yearly GROUP BY 1""",
    "distinct_years": f"WITH {Q0} SELECT DISTINCT year FROM q ORDER BY 1",
    "trends_payload": f"""WITH {TRENDS}, {OWN_TOTALS},
        years AS (SELECT DISTINCT year FROM trends),
        cells AS (SELECT l.language, y.year, t.* EXCLUDE (language, year) FROM langs l CROSS JOIN years y LEFT JOIN trends t
          ON t.language = l.language AND t.year = y.year)
        SELECT l.language, l.display_name, coalesce(l.color, '#888888') AS color, s.total_questions,
          (SELECT string_agg(CAST(year AS VARCHAR), ',' ORDER BY year) FROM years) AS years,
          (SELECT string_agg(CAST(year AS VARCHAR), ',' ORDER BY year)
            FROM (SELECT DISTINCT year FROM trends WHERE usage_pct IS NOT NULL)) AS survey_years,
          {figures("median_score")} AS median_score, {figures("round_even(median_views, 0)")} AS median_views,
          {figures("answer_rate")} AS answer_rate,
          {figures("usage_pct")} FILTER (WHERE usage_pct IS NOT NULL) AS usage_pct,
          {figures("want_pct")} FILTER (WHERE usage_pct IS NOT NULL) AS want_pct
        FROM langs l JOIN totals s ON s.language = l.language
        JOIN cells c ON c.language = l.language GROUP BY 1, 2, 3, 4""",
    "survey_payload": f"""WITH {SURVEY}, {OWN_TOTALS}
        SELECT l.language, l.display_name, coalesce(l.color, '#888888') AS color, s.total_questions,
          string_agg(CAST(year AS VARCHAR), ',' ORDER BY year) AS years,
          {figures("usage_pct")} AS usage_pct, {figures("want_pct")} AS want_pct
        FROM langs l JOIN totals s ON s.language = l.language JOIN survey v ON v.language = l.language GROUP BY 1, 2, 3, 4""",
    "survey_files": f"""WITH {V} SELECT year, array_to_string(have, ';') AS have,
        CASE WHEN year <> 1998 THEN array_to_string(want, ';') END AS want FROM v""",
    "landed_pages": f"""WITH {Q0} SELECT question_id, language, year, CAST(creation_date AS TIMESTAMP) AS creation_date,
        CAST(trunc(score) AS BIGINT) AS score, view_count, is_answered, 'a|' || language AS tags FROM q""",
    "stored_table": f"WITH {Q0} SELECT question_id, language, year, creation_date, score, view_count, is_answered FROM q",
    "stored_documents": f"""WITH {FREQUENCY} {ranked("language, tag, frequency", "frequency", "language", "frequency DESC, tag", 20, False)}""",
    "landed_chains": """WITH p AS (SELECT o_orderpriority AS tag, date_trunc('month', o_orderdate) AS m, day(o_orderdate) AS page, o_orderstatus,
          count(*) AS items, min(o_custkey) AS quota FROM orders GROUP BY 1, 2, 3, 4),
        c AS (SELECT tag, m, count(DISTINCT page) AS pages, count(*) - count(DISTINCT page) AS repeats, min(page) FILTER (WHERE page >= 28) AS last_page,
          max(page) AS top, CAST(sum(items) AS BIGINT) AS items, min(quota) AS quota_left, list(DISTINCT page) AS seen FROM p GROUP BY 1, 2),
        g AS (SELECT *, list_filter(range(1, coalesce(last_page, top)), lambda x: NOT list_contains(seen, x)) AS gaps FROM c)
        SELECT tag, CAST(epoch(m) AS BIGINT) AS fromdate, CAST(epoch(m + INTERVAL 1 MONTH) AS BIGINT) - 1 AS todate, pages, repeats, last_page,
          CAST(len(gaps) AS BIGINT) AS missing, gaps[1] AS first_gap, CAST(len(list_filter(seen, lambda x: x > last_page)) AS BIGINT) AS beyond, items, quota_left,
          last_page IS NOT NULL AND len(gaps) = 0 AS complete FROM g""",
    "upserted_log": """SELECT user_id, event_type, event_id, ts FROM (SELECT *, row_number() OVER (
        PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rk FROM events)
        WHERE rk = 1 AND TIMESTAMP '2024-01-31' - ts <= INTERVAL 10 DAY""",
    "rewritten_table": f"WITH {Q0} SELECT question_id, language, view_count * 2 AS view_count FROM q WHERE is_answered",
    "gated_counts": f"""WITH {Q0}, {FREQUENCY}, n AS (SELECT 'questions' AS name, language, count(*) AS n FROM q GROUP BY 2
          UNION ALL SELECT 'tagged', language, count(*) FROM q GROUP BY 2 UNION ALL SELECT 'tags', language, count(*) FROM frequency GROUP BY 2)
        SELECT name, language, coalesce(n, 0) AS n_rows FROM (SELECT name, unnest({string_list(PRIORITIES)}) AS language
          FROM (SELECT unnest(['questions', 'tagged', 'tags']) AS name)) LEFT JOIN n USING (name, language)""",
    "clean_questions": f"""WITH {CLEANED} SELECT question_id, title, array_to_string(tags, '|') AS tags, language, event_id FROM cleaned""",
    "cleaning_report": f"""WITH {CLEANED} SELECT (SELECT count(*) FROM raw) AS n_before, count(*) AS n_after,
        (SELECT count(*) FROM raw) - count(*) AS n_dropped FROM cleaned""",
    "clean_titles": f"""SELECT * FROM (SELECT page_id, {strip(unescape("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)"))} AS title
        FROM pages) WHERE length(title) > 0""",
    "epoch_to_ts": "SELECT event_id, date_trunc('second', ts) AS creation_date FROM events",
    "parse_tags": f"WITH {RAW} SELECT event_id, CAST(2 AS INTEGER) AS n_tags, array_to_string(tags, '|') AS tags FROM raw",
    "dedupe_first": """SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (
        PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rk FROM events) WHERE rk = 1""",
    "html_to_text": f"SELECT page_id, {visible_text('html')} AS text FROM pages",
    "clean_body": f"""SELECT page_id, {strip(visible_text("html") + " || ' &lt;'")} AS text FROM pages""",
    "text_combined": f"""WITH {QT} SELECT question_id, 'Order ' || question_id || ' ' ||
        coalesce(array_to_string(list_transform(tags, lambda t: replace(t, ' ', '_')), ' '), '') AS text_combined FROM tagged""",
    "tagged_between": f"""WITH {QT} SELECT question_id, language, creation_date FROM tagged WHERE list_contains(tags, 'small ring')
        AND creation_date BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1998-06-30' ORDER BY creation_date, question_id""",
    "year_bounds": f"""WITH {Q0} SELECT DISTINCT year, CAST(epoch(make_timestamp(year, 1, 1, 0, 0, 0)) AS BIGINT) AS start_ts,
        CAST(epoch(make_timestamp(year, 12, 31, 23, 59, 59)) AS BIGINT) AS end_ts FROM q""",
    "sample_per_year": f"""WITH {Q0} {ranked("language, year, question_id, creation_date",
        "q WHERE year BETWEEN 1996 AND 2000", "language, year", "creation_date, question_id", 100, False)}""",
    "latest_within_ttl": """SELECT user_id, event_type, event_id, ts FROM (SELECT *, row_number() OVER (
        PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rk FROM events)
        WHERE rk = 1 AND TIMESTAMP '2024-01-31' - ts <= INTERVAL 3 DAY""",
    "describe": " UNION ALL ".join(
        f"""SELECT '{c}' AS column, count({e}) AS count, round_even(avg({e}), 1) AS mean, round_even(stddev_samp({e}), 1) AS std,
        round_even(min({e}), 1) AS min, round_even(quantile_cont({e}, 0.25), 1) AS q25, round_even(quantile_cont({e}, 0.5), 1) AS q50,
        round_even(quantile_cont({e}, 0.75), 1) AS q75, round_even(max({e}), 1) AS max FROM orders"""
        for c, e in (
            ("score", "o_totalprice"), ("view_count", "CAST(o_custkey AS DOUBLE)"), ("year", "CAST(year(o_orderdate) AS DOUBLE)"),
        )
    ),
    "null_profile": f"""WITH {V} SELECT * FROM (SELECT 'want' AS column, CAST(count_if(want IS NULL) AS BIGINT) AS nulls FROM v) WHERE nulls > 0""",
    "count_pivot": f"WITH {Q0} SELECT year, "
    + ", ".join(f"CAST(nullif(count_if(language = '{p}'), 0) AS BIGINT) AS p{p[0]}" for p in PRIORITIES)
    + " FROM q GROUP BY 1",
    "box_stats": """WITH x AS (SELECT event_type AS language, least(greatest(value, -5), 20) AS value FROM events),
        b AS (SELECT language, quantile_cont(value, 0.25) AS q1, median(value) AS median, quantile_cont(value, 0.75) AS q3 FROM x GROUP BY 1),
        r AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM b)
        SELECT language, round_even(q1, 6) AS q1, round_even(median, 6) AS median, round_even(q3, 6) AS q3,
          round_even(min(value) FILTER (WHERE value BETWEEN lo AND hi), 6) AS whisker_low,
          round_even(max(value) FILTER (WHERE value BETWEEN lo AND hi), 6) AS whisker_high,
          CAST(count_if(NOT value BETWEEN lo AND hi) AS BIGINT) AS outliers
        FROM x JOIN r USING (language) GROUP BY language, q1, median, q3""",
    "cluster_quality": """WITH x AS (SELECT CAST(vec_id % 3 AS VARCHAR) AS language, CASE WHEN label = 0 THEN -1 ELSE label END AS c FROM embeddings)
        SELECT language, count(DISTINCT c) FILTER (WHERE c <> -1) AS n_clusters,
          round_even(avg(CASE WHEN c = -1 THEN 1.0 ELSE 0.0 END), 9) AS noise_ratio FROM x GROUP BY 1""",
    "rows_per_language": f"WITH {Q0} SELECT language, count(*) AS n_rows FROM q GROUP BY 1",
    "extract_errors": f"SELECT doc_id, array_to_string(regexp_extract_all(text, {quoted('|'.join(WORD_PATTERNS))}), '|') AS errors FROM documents",
    "tokenize": f"SELECT doc_id, array_to_string({without(word_list('text'))}, ' ') AS tokens FROM documents",
    "removed_words": f"""SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter({word_list('text')},
        lambda w: list_contains({STOP}, w)))), ' ') AS removed FROM documents""",
    "top_words": f"""WITH w AS (SELECT lang AS language, unnest({without(word_list('text'))}) AS word FROM documents),
        n AS (SELECT language, word, count(*) AS n FROM w GROUP BY 1, 2)
        {ranked("language, word, n", "n", "language", "n DESC, word", 15)}""",
    "term_counts": f"WITH {D}, {counts('c', 'd')} SELECT * FROM c",
    "vocabulary": f"WITH {VOCAB} SELECT language, term, df, ctf, round_even(idf, 9) AS idf FROM vocab",
    "tfidf": f"WITH {VOCAB}, {weights('x', 'c')} SELECT language, doc_id, term, tf, round_even(weight, 9) AS weight FROM x",
    "tfidf_transform": f"""WITH {VOCAB}, turns AS (SELECT 'en' AS language, conv_id * 1000 + turn AS doc_id, text FROM conversations),
        {counts('tc', 'turns')}, {weights('x', 'tc')}
        SELECT language, doc_id, term, tf, round_even(weight, 9) AS weight FROM x""",
    "cluster_labels": f"""WITH {VOCAB}, {weights('x', 'c')},
        sizes AS (SELECT language, cluster_id, count(*) AS size FROM d GROUP BY 1, 2),
        means AS (SELECT language, cluster_id, term, sum(weight) / any_value(size) AS m
          FROM x JOIN d USING (language, doc_id) JOIN sizes USING (language, cluster_id) GROUP BY 1, 2, 3),
        names(language, w) AS (VALUES ('en', ['anon', 'thion']), ('fr', ['eau', 'les'])),
        usable AS (SELECT m.* FROM means m LEFT JOIN names n ON n.language = m.language
          WHERE length(term) > 1 AND (w IS NULL OR NOT (list_has_all(w, string_split(term, ' '))
            OR (contains(term, ' ') AND list_contains(w, split_part(term, ' ', 1)))))),
        best AS ({ranked("language, cluster_id, term", "usable", "language, cluster_id", "round_even(m, 12) DESC, term", 5)})
        SELECT s.language, s.cluster_id, CASE WHEN s.cluster_id = '-1' THEN '{NOISE_LABEL}' ELSE
          coalesce(string_agg(term, ' / ' ORDER BY rank), 'cluster_' || s.cluster_id) END AS label
        FROM sizes s LEFT JOIN best b ON b.language = s.language AND b.cluster_id = s.cluster_id GROUP BY 1, 2""",
    "tag_frequency": f"WITH {FREQUENCY} SELECT * FROM frequency",
    "top_tags": f"WITH {FREQUENCY} {ranked('language, tag, frequency', 'frequency', 'language', 'frequency DESC, tag', 20, False)}",
    "top_cotags": f"""WITH {FREQUENCY}, others AS (SELECT * FROM frequency WHERE tag NOT IN ('small ring', 'red widget'))
        {ranked("language, tag, frequency", "others", "language", "frequency DESC, tag", 10)}""",
    "tag_pairs": f"""WITH {QT}, t AS (SELECT question_id, language, unnest(tags) AS tag FROM tagged)
        SELECT a.language, a.tag AS source, b.tag AS target, count(*) AS weight
        FROM t a JOIN t b ON a.question_id = b.question_id AND a.tag < b.tag GROUP BY 1, 2, 3""",
    "cooccurrence_nodes": f"WITH {GRAPH} SELECT * FROM nodes",
    "cooccurrence_edges": f"WITH {GRAPH} SELECT * FROM edges",
    "degree_centrality": f"WITH {DEGREE} SELECT * FROM degree",
    "neighbors": f"WITH {GRAPH} SELECT DISTINCT language, id, other AS neighbor FROM sides",
    "network_nodes": f"WITH {network()} SELECT * FROM full_nodes",
    "top_nodes": f"WITH {network()} {ranked('language, id, betweenness_centrality', 'full_nodes', 'language', 'betweenness_centrality DESC, id', 10)}",
    "trim_network": f"WITH {trimmed()} SELECT * FROM inner_edges",
    "trim_unweighted": f"WITH {trimmed('1')} SELECT * FROM inner_edges",
    "network_summary": f"""WITH {network()}, e AS (SELECT language, count(*) AS edges FROM edges GROUP BY 1)
        SELECT language, count(*) AS nodes, any_value(e.edges) AS edges, count(DISTINCT community) AS communities
        FROM full_nodes JOIN e USING (language) GROUP BY 1""",
    "community_profile": f"""WITH {network()}, best AS ({ranked("language, community, id, frequency", "full_nodes", "language, community",
        "frequency DESC, id", 5)}), peopled AS (SELECT language, community, count(*) AS size FROM full_nodes GROUP BY 1, 2)
        SELECT language, community, any_value(size) AS size, string_agg(id || '(' || frequency || ')', ', ' ORDER BY rank) AS members
        FROM best JOIN peopled USING (language, community) GROUP BY 1, 2""",
    "network_payload": f"""WITH {trimmed()}, n AS (SELECT language, string_agg(id || ':' || frequency || ':' || community || ':' ||
          CAST(CAST(degree_centrality AS DECIMAL(18,4)) AS VARCHAR) || ':' || CAST(CAST(betweenness_centrality AS DECIMAL(18,4)) AS VARCHAR),
          '|' ORDER BY id) AS nodes FROM chosen GROUP BY 1),
        c AS (SELECT language, string_agg('コミュニティ ' || community, '|' ORDER BY community) AS communities
          FROM (SELECT DISTINCT language, community FROM chosen) GROUP BY 1),
        l AS (SELECT language, string_agg(source || ':' || target || ':' || weight, '|' ORDER BY source, target) AS links FROM inner_edges GROUP BY 1)
        SELECT language, nodes, links, communities FROM n LEFT JOIN l USING (language) JOIN c USING (language)""",
    "display_scales": f"""WITH {GRAPH}, s AS (SELECT language, id AS item, 'radius' AS scale,
          5 + least(greatest((sqrt(frequency) - 1) / (sqrt(max(frequency) OVER (PARTITION BY language)) - 1), 0), 1) * 25 AS value FROM nodes
        UNION ALL SELECT language, source || ' - ' || target, 'width',
          0.5 + (weight - 1) / (max(weight) OVER (PARTITION BY language) - 1) * 3.5 FROM edges
        UNION ALL SELECT language, source || ' - ' || target, 'length', greatest(55, 90 - weight * 1.5) FROM edges)
        SELECT language, item, scale, round_even(CAST(value AS DOUBLE), 6) AS value FROM s""",
    "betweenness": f"WITH {GRAPH}, {shortest_paths('weight')} SELECT * FROM between_nodes",
    "betweenness_unweighted": f"WITH {GRAPH}, {shortest_paths('1')} SELECT * FROM between_nodes",
    "network_centrality": f"""WITH {DEGREE}, {shortest_paths('weight')} SELECT language, id AS tag, frequency,
        CAST(0 AS INTEGER) AS community, degree_centrality, betweenness_centrality
        FROM nodes JOIN degree USING (language, id) JOIN between_nodes USING (language, id)""",
    "modularity": f"""WITH {GRAPH}, s AS (SELECT language, ascii(id) % 4 AS c, ascii(other) % 4 AS o, weight
          FROM sides JOIN (SELECT language, source AS id, target AS other, weight FROM edges
            UNION ALL SELECT language, target, source, weight FROM edges) USING (language, id, other)),
        m AS (SELECT language, c, sum(weight) AS degree, sum(CASE WHEN c = o THEN weight ELSE 0 END) AS inner_weight,
          sum(sum(weight)) OVER (PARTITION BY language) AS two_m FROM s GROUP BY 1, 2)
        SELECT language, round_even(sum(inner_weight / two_m - (degree / two_m) * (degree / two_m)), 9) AS modularity FROM m GROUP BY 1""",
    "l2_normalize": """WITH x AS (SELECT vec_id AS doc_id, unnest(CAST(embedding AS DOUBLE[])) AS value,
          generate_subscripts(embedding, 1) - 1 AS position FROM embeddings)
        SELECT doc_id, CAST(position AS INTEGER) AS position,
          round_even(value / sqrt(sum(value * value) OVER (PARTITION BY doc_id)), 9) AS value FROM x""",
    "core_distance": f"WITH {NEAR} SELECT vec_id, round_even(core, 9) AS core FROM cores",
    "mutual_reachability": f"""WITH {NEAR} SELECT n.vec_id, nbr, round_even(greatest(a.core, b.core, d), 9) AS reachability
        FROM near n JOIN cores a ON a.vec_id = n.vec_id JOIN cores b ON b.vec_id = n.nbr""",
    "top_patterns": f"WITH {PATTERNS} SELECT * FROM patterns",
    "representatives": f"WITH {CQ}, {EXAMPLES} SELECT * FROM examples",
    "pattern_summary": f"""WITH {PATTERNS} SELECT language, arg_min(label, rank) AS largest, arg_min(size, rank) AS largest_size,
        arg_min(label, answer_rate * 1000000 + rank) AS hardest, min(answer_rate) AS hardest_rate
        FROM patterns WHERE rank <= 15 GROUP BY 1""",
    "patterns_payload": f"""WITH {PATTERNS}, {EXAMPLES},
        e AS (SELECT language, cluster_id, string_agg(CAST(question_id AS VARCHAR), ',' ORDER BY rank) AS ids FROM examples GROUP BY 1, 2)
        SELECT language, string_agg(label || ':' || size || ':' || ids, '|' ORDER BY rank) AS patterns
        FROM patterns JOIN e USING (language, cluster_id) GROUP BY 1""",
    "clean_label": """WITH x AS (SELECT p_partkey, lower(p_name) AS n FROM part)
        SELECT p_partkey, CASE WHEN n = 'red widget' THEN 'Red Widgets!' ELSE
          upper(n[1]) || substr(split_part(n, ' ', 1), 2) || ' ' || upper(split_part(n, ' ', 2)[1]) || substr(split_part(n, ' ', 2), 2)
        END AS label FROM x""",
    "display_columns": f"""WITH {PATTERNS} SELECT language, cluster_id, rank, size, answer_rate,
        {READABLE} AS label,
        round_even(0.45 + (1 - answer_rate) * 0.55, 9) AS shade,
        CASE language WHEN 'en' THEN '#3776AB' WHEN 'fr' THEN '#F7DF1E' ELSE '#4f8ef7' END
          || lower(lpad(to_hex(CAST(floor((0.45 + (1 - answer_rate) * 0.55) * 255 + 0.5) AS BIGINT)), 2, '0')) AS color,
        CAST(floor(answer_rate * 100 + 0.5) AS BIGINT) AS answer_pct
        FROM patterns WHERE rank <= 15""",
}
