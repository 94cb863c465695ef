"""One query per operator, over the whole supplied tables.

Lists are shown as delimited text and unrounded figures with fixed digits, so that two
engines can be compared value by value.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qaspark.fixed_values import SURVEY_FILE_NAMES, SURVEY_HAVE_COLUMN, SURVEY_WANT_COLUMN
from qaspark.functions import text
from qaspark.functions.numbers import round_even
from qaspark.operators import centrality, cleaning, communities as community, density, graph, neighbors as near, patterns
from qaspark.operators import payload, profile, tfidf, trend, vectors
from qaspark.plans.micro import text_clusters as cluster_texts
from qaspark.session import checkpoint_folder, write_through
from qaspark.sources import adapters as a
from qaspark.sources.responses import latest_within_ttl, page_chains, read_questions, read_requests
from qaspark.sources.survey import read_survey
from qaspark.sources.tables import read_table, write_documents, write_table
from qaspark.sources.versions import read_current, read_version, replace_table, upsert

# The supplied documents hold no programming errors; this pattern hits their words.
WORD_PATTERNS = ["[A-Z][a-z]+tion", "[A-Z][a-z]+ent"]
EDGE_WEIGHT = 18
TOP_TAGS = 50


def _listed(c: Column | str, separator: str = "|") -> Column:
    return F.array_join(c, separator)


def _figures(c: Column | str) -> Column:
    """A list of numbers as text with three decimals."""
    return F.array_join(
        F.transform(c, lambda x: F.coalesce(x.cast("decimal(18,3)").cast("string"), F.lit("null"))), ","
    )


# --- macro -----------------------------------------------------------------------

def yearly_counts(spark: SparkSession, d: str) -> DataFrame:
    return trend.yearly_counts(a.questions(spark, d))


def survey_trend(spark, d):
    return trend.survey_trend(a.survey(spark, d), a.BRAND_OF)


def _trends(spark, d):
    return trend.merge_survey(yearly_counts(spark, d), survey_trend(spark, d))


def total_questions(spark, d):
    totals = trend.total_questions(
        a.tag_statistics(spark, d), a.languages(spark).withColumn("language", F.col("display_name"))
    )
    return totals.withColumn("millions", round_even("millions", 6))


def answer_rate_by_language(spark, d):
    return trend.answer_rate_by_language(a.questions(spark, d)).withColumn("answer_rate", round_even("answer_rate", 9))


def mean_of_yearly(spark, d):
    means = trend.mean_of_yearly(yearly_counts(spark, d))
    return means.select("language", *[round_even(c, 6).alias(c) for c in ("mean_median_score", "mean_answer_rate")])


def distinct_years(spark, d):
    return trend.distinct_years(a.questions(spark, d))


def _payload_tags(spark, d):
    """Tag counts under the language keys used by the payloads."""
    keys = F.create_map(*[F.lit(x) for k, v in a.BRAND_OF.items() for x in (v, k)])
    tags = a.tag_statistics(spark, d)
    return tags.withColumn("name", F.coalesce(F.try_element_at(keys, F.col("name")), F.col("name")))


def trends_payload(spark, d):
    trends = write_through(_trends(spark, d), "trends")
    p = payload.trends_payload(trends, _payload_tags(spark, d), a.languages(spark))
    return p.select(
        "language", "display_name", "color", "total_questions",
        _listed("years", ",").alias("years"), _listed("survey_years", ",").alias("survey_years"),
        *[_figures(f"yearly.{c}").alias(c) for c in ("median_score", "median_views", "answer_rate")],
        *[_figures(f"survey.{c}").alias(c) for c in ("usage_pct", "want_pct")],
    )


def survey_payload(spark, d):
    asked = write_through(survey_trend(spark, d), "survey")
    p = payload.survey_payload(asked, _payload_tags(spark, d), a.languages(spark))
    return p.select(
        "language", "display_name", "color", "total_questions", _listed("years", ",").alias("years"),
        _figures("usage_pct").alias("usage_pct"), _figures("want_pct").alias("want_pct"),
    )


# --- stored and read back ------------------------------------------------------------

def _place(spark, name):
    return f"{checkpoint_folder(spark)}/qaspark/{name}-{uuid.uuid4().hex}"


def survey_files(spark, d):
    """The survey as one CSV per year under either name, one year without the wish column, read as one table."""
    root = _place(spark, "survey")
    answers = write_through(a.survey(spark, d), "answers")
    years = sorted(r["year"] for r in answers.select("year").distinct().collect())
    for year in years:
        wide = answers.where(F.col("year") == year).select("respondent", F.col("have").alias(SURVEY_HAVE_COLUMN), F.col("want").alias(SURVEY_WANT_COLUMN))
        wide = wide.drop(SURVEY_WANT_COLUMN) if year == 1998 else wide
        wide.write.csv(f"{root}/{year}/{SURVEY_FILE_NAMES[year % 2]}", header=True, quote='"', escape='"')
    return read_survey(spark, root, [years[0] - 1, *years] if years else [])


def landed_pages(spark, d):
    """Questions as JSON pages of at most 100 items under language folders, read and flattened."""
    path = _place(spark, "pages")
    item = F.struct(
        "question_id", F.unix_timestamp("creation_date").alias("creation_date"), F.col("score").cast("long").alias("score"), "view_count", "is_answered",
        F.array(F.lit("a"), F.col("language")).alias("tags"),
    )
    number = F.floor(F.col("question_id") / 100).alias("page")
    pages = a.questions(spark, d).groupBy("language", number).agg(F.collect_list(item).alias("items"))
    pages.select("language", "items", F.lit(True).alias("has_more"), F.lit(5).alias("quota_remaining")).write.partitionBy("language").json(path)
    rows = read_questions(spark, path)
    return rows.select("question_id", "language", "year", "creation_date", "score", "view_count", "is_answered", _listed("tags").alias("tags"))


def stored_table(spark, d):
    """Questions written as Parquet by language and read again."""
    path = _place(spark, "stored")
    write_table(a.questions(spark, d), path)
    return read_table(spark, path).select("question_id", "language", "year", "creation_date", "score", "view_count", "is_answered")


def stored_documents(spark, d):
    """The top tags of each language as one JSON document per language, written and read again."""
    path = _place(spark, "documents")
    best = top_tags(spark, d)
    write_documents(best.groupBy("language").agg(F.sort_array(F.collect_list(F.struct("frequency", "tag"))).alias("tags")), path)
    back = spark.read.schema("language string, tags array<struct<frequency long, tag string>>").json(path)
    return back.select("language", F.explode("tags").alias("t")).select("language", "t.tag", "t.frequency")


def landed_chains(spark, d):
    """One request per language and month, its days as pages: days without questions are gaps, days of several states repeats."""
    path = _place(spark, "requests")
    q = a.table(spark, d, "orders")
    day = F.col("o_orderdate")
    month = F.date_trunc("month", day)
    asked = [
        F.col("o_orderpriority").alias("tag"), F.unix_timestamp(month).alias("fromdate"),
        (F.unix_timestamp(F.add_months(month, 1).cast("timestamp")) - 1).alias("todate"), F.dayofmonth(day).cast("long").alias("page"),
    ]
    item = F.struct(F.col("o_orderkey").alias("question_id"))
    pages = q.groupBy(*asked, "o_orderstatus").agg(F.collect_list(item).alias("items"), F.min("o_custkey").alias("quota_remaining"))
    pages.withColumn("has_more", F.col("page") < 28).drop("o_orderstatus").write.json(path)
    return page_chains(read_requests(spark, path))


def upserted_log(spark, d):
    """Events set in a keyed table in three batches, the middle one last, and what is not older than ten days read from it."""
    root = _place(spark, "keyed")
    log = a.table(spark, d, "events")
    now = F.lit("2024-01-31 00:00:00").cast("timestamp")
    day = F.dayofmonth("ts")
    for batch in (log.where(day <= 12), log.where(day > 21), log.where((day > 12) & (day <= 21)), log.where(F.col("ts").isNull())):
        upsert(batch, root, now, ["user_id", "event_type"], "ts", ttl_days=10, tie_break=["event_id"])
    return read_current(spark, root, now, "ts", ttl_days=10).select("user_id", "event_type", "event_id", "ts")


def rewritten_table(spark, d):
    """Questions stored, then rewritten twice from their own table: views doubled, then only the answered ones."""
    root = _place(spark, "rewritten")
    replace_table(a.questions(spark, d).select("question_id", "language", "view_count", "is_answered"), root)
    replace_table(read_version(spark, root).withColumn("view_count", F.col("view_count") * 2), root)
    replace_table(read_version(spark, root).where("is_answered"), root)
    return read_version(spark, root).select("question_id", "language", "view_count")


def gated_counts(spark, d):
    """Edges, nodes and clusters per language as counted by the jobs that wrote them, each behind a gate."""
    tables = {"questions": a.questions(spark, d), "tagged": a.tagged_questions(spark, d).select("question_id", "language"), "tags": tag_frequency(spark, d)}
    rows = []
    for name, df in tables.items():
        counts = replace_table(df, _place(spark, name), "language", {p: 0 for p in a.PRIORITIES})
        rows += [(name, language, n) for language, n in counts.items()]
    return spark.createDataFrame(rows, "name string, language string, n_rows long")


# --- cleaning --------------------------------------------------------------------

def _raw_questions(spark, d):
    """Events as raw questions: ids repeat, titles hold entities and blanks, dates are seconds."""
    kind = F.col("event_type")
    title = (
        F.when(F.col("value") < 2, F.lit(None).cast("string"))
        .when(F.col("value") < 4, F.lit("  \n "))
        .otherwise(F.concat(F.lit(" "), kind, F.lit(" &amp;lt; &quot;"), F.col("props"), F.lit("&quot; \n")))
    )
    return a.table(spark, d, "events").select(
        (F.col("user_id") * 10 + F.col("event_id") % 7).alias("question_id"),
        title.alias("title"),
        F.concat(F.lit("['"), kind, F.lit("', 'user-"), (F.col("user_id") % 5).cast("string"), F.lit("']")).alias("tags"),
        F.unix_timestamp("ts").alias("creation_date"),
        kind.alias("language"),
        "event_id",
    )


def clean_questions(spark, d):
    raw = _raw_questions(spark, d).withColumn("creation_date", F.col("creation_date") * 100000 + F.col("event_id"))
    cleaned = cleaning.clean_questions(
        raw.withColumn("creation_date", F.col("creation_date") / 100000), ["view", "purchase", "click"]
    )
    return cleaned.select("question_id", "title", _listed("tags").alias("tags"), "language", "event_id")


def cleaning_report(spark, d):
    raw = _raw_questions(spark, d)
    return cleaning.cleaning_report(raw, cleaning.clean_questions(raw))


def clean_titles(spark, d):
    title = F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1)
    return cleaning.clean_titles(a.pages(spark, d).select("page_id", title.alias("title")))


def epoch_to_ts(spark, d):
    events = a.table(spark, d, "events").select("event_id", F.unix_timestamp("ts").alias("creation_date"))
    return cleaning.epoch_to_timestamp(events)


def parse_tags(spark, d):
    raw = _raw_questions(spark, d).select("event_id", "tags")
    return cleaning.tags_to_list(raw).select("event_id", F.size("tags").alias("n_tags"), _listed("tags").alias("tags"))


def dedupe_first(spark, d):
    events = a.table(spark, d, "events").select(
        F.col("event_id"), F.struct("user_id", "event_type").alias("question_id"), F.col("ts").alias("creation_date")
    )
    return cleaning.dedupe(events).select(
        F.col("question_id.user_id").alias("user_id"), F.col("question_id.event_type").alias("event_type"), "event_id"
    )


def html_to_text(spark, d):
    return a.pages(spark, d).select("page_id", text.html_to_text("html").alias("text"))


def clean_body(spark, d):
    body = F.concat(F.lit("  "), F.col("html"), F.lit("\n<p>&amp;lt;</p>\t"))
    return a.pages(spark, d).select("page_id", text.clean_body(body).alias("text"))


def text_combined(spark, d):
    q = a.tagged_questions(spark, d).withColumn("title", F.concat(F.lit("Order "), F.col("question_id").cast("string")))
    q = q.withColumn("tags", F.transform("tags", lambda t: F.replace(t, F.lit(" "), F.lit("-"))))
    return cleaning.with_text_combined(q).select("question_id", "text_combined")


def tagged_between(spark, d):
    q = a.tagged_questions(spark, d)
    found = cleaning.tagged_between(q, "small ring", "1997-01-01 00:00:00", "1998-06-30 00:00:00")
    return found.select("question_id", "language", "creation_date")


def year_bounds(spark, d):
    return cleaning.with_year_bounds(trend.distinct_years(a.questions(spark, d)))


def sample_per_year(spark, d):
    sampled = cleaning.sample_per_year(a.questions(spark, d), 100, 1996, 2000)
    return sampled.select("language", "year", "question_id", "creation_date")


def latest_response(spark, d):
    log = a.table(spark, d, "events")
    now = F.lit("2024-01-31 00:00:00").cast("timestamp")
    newest = latest_within_ttl(log, now, ["user_id", "event_type"], "ts", ttl_days=3, tie_break=["event_id"])
    return newest.select("user_id", "event_type", "event_id", "ts")


# --- profiles --------------------------------------------------------------------

def describe(spark, d):
    return profile.describe(a.questions(spark, d), ["score", "view_count", "year"])


def null_profile(spark, d):
    return profile.null_profile(a.survey(spark, d)).select("column", "nulls")


def count_pivot(spark, d):
    pivot = profile.count_pivot(a.questions(spark, d), a.PRIORITIES)
    return pivot.select("year", *[F.col(f"`{p}`").alias("p" + p[0]) for p in a.PRIORITIES])


def box_stats(spark, d):
    events = a.table(spark, d, "events").select(F.col("event_type").alias("language"), F.col("value").alias("score"))
    stats = profile.box_stats(events)
    figures = ("q1", "median", "q3", "whisker_low", "whisker_high")
    return stats.select("language", *[round_even(c, 6).alias(c) for c in figures], "outliers")


def cluster_quality(spark, d):
    assigned = a.table(spark, d, "embeddings").select(
        (F.col("vec_id") % 3).cast("string").alias("language"),
        F.when(F.col("label") == 0, -1).otherwise(F.col("label")).alias("cluster_id"),
    )
    return profile.cluster_quality(assigned).withColumn("noise_ratio", round_even("noise_ratio", 9))


def rows_per_language(spark, d):
    return profile.rows_per_language(a.questions(spark, d))


# --- text ------------------------------------------------------------------------

def extract_errors(spark, d):
    docs = a.documents(spark, d)
    return docs.select("doc_id", _listed(text.error_names("text", WORD_PATTERNS)).alias("errors"))


def tokenize(spark, d):
    return a.documents(spark, d).select("doc_id", _listed(text.tokenize("text"), " ").alias("tokens"))


def removed_words(spark, d):
    gone = F.array_sort(text.removed_words("text"))
    return a.documents(spark, d).select("doc_id", _listed(gone, " ").alias("removed"))


def top_words(spark, d):
    return tfidf.top_words(a.documents(spark, d))


def term_counts(spark, d):
    return tfidf.term_counts(a.documents(spark, d))


def vocabulary(spark, d):
    docs = a.documents(spark, d)
    vocab = tfidf.vocabulary(tfidf.term_counts(docs), docs)
    return vocab.withColumn("idf", round_even("idf", 9))


def tfidf_weights(spark, d):
    _, weights = tfidf.fit(a.documents(spark, d))
    return weights.withColumn("weight", round_even("weight", 9))


def tfidf_transform(spark, d):
    """Conversations weighed with the vocabulary of the documents."""
    vocab, _ = tfidf.fit(a.documents(spark, d))
    turns = a.table(spark, d, "conversations").select(
        F.lit("en").alias("language"), (F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"), "text"
    )
    weights = tfidf.transform(tfidf.term_counts(turns), vocab)
    return weights.withColumn("weight", round_even("weight", 9))


def cluster_labels(spark, d):
    docs = a.documents(spark, d)
    _, weights = tfidf.fit(docs)
    # Words stand in for language names so that the filters act.
    return patterns.cluster_labels(docs, weights, language_words={"en": ["anon", "thion"], "fr": ["eau", "les"]})


# --- graph -----------------------------------------------------------------------

def _tagged(spark, d):
    return write_through(a.tagged_questions(spark, d).select("question_id", "language", "tags"), "tagged")


def _graph(spark, d):
    return graph.cooccurrence_graph(_tagged(spark, d), EDGE_WEIGHT, TOP_TAGS)


def tag_frequency(spark, d):
    return graph.tag_frequency(a.tagged_questions(spark, d))


def top_tags(spark, d):
    return graph.top_tags(graph.tag_frequency(a.tagged_questions(spark, d)), 20)


def top_cotags(spark, d):
    return graph.top_cotags(a.tagged_questions(spark, d), 10, ["small ring", "red widget"])


def tag_pairs(spark, d):
    return graph.tag_pairs(a.tagged_questions(spark, d))


def cooccurrence_nodes(spark, d):
    return _graph(spark, d)[0]


def cooccurrence_edges(spark, d):
    return _graph(spark, d)[1]


def degree_centrality(spark, d):
    return graph.degree_centrality(_graph(spark, d)[1])


def neighbors(spark, d):
    return graph.neighbors(_graph(spark, d)[1])


def _network(spark, d, weighted=True):
    """Nodes with degree and betweenness, their community given by the first letter, and the edges."""
    nodes, edges = _graph(spark, d)
    edges = write_through(edges, "edges")
    given = nodes.select("language", "id", (F.ascii("id") % 4).alias("community"))
    between = centrality.betweenness_centrality(edges, weighted)
    joined = graph.network_nodes(nodes, given, graph.degree_centrality(edges), between)
    return write_through(joined, "nodes"), edges


def network_nodes(spark, d):
    return _network(spark, d)[0]


def top_nodes(spark, d):
    nodes, _ = _network(spark, d)
    return graph.top_nodes(nodes, n=10).select("language", "id", "betweenness_centrality", "rank")


def trim_network(spark, d):
    return graph.trim_network(*_network(spark, d), 15)[1]


def trim_unweighted(spark, d):
    """The graph trimmed by betweenness over hops instead of weights."""
    return graph.trim_network(*_network(spark, d, weighted=False), 15)[1]


def network_summary(spark, d):
    return graph.network_summary(*_network(spark, d))


def community_profile(spark, d):
    return graph.community_profile(_network(spark, d)[0])


def network_payload(spark, d):
    p = payload.network_payload(*graph.trim_network(*_network(spark, d), 15))
    number = lambda c: c.cast("decimal(18,4)").cast("string")
    shown = F.transform(
        "nodes",
        lambda n: F.concat_ws(
            ":", n["id"], n["frequency"].cast("string"), n["community"].cast("string"),
            number(n["degree_centrality"]), number(n["betweenness_centrality"]),
        ),
    )
    links = F.transform("links", lambda e: F.concat_ws(":", e["source"], e["target"], e["weight"].cast("string")))
    names = F.transform("communities", lambda c: c["name"])
    return p.select("language", _listed(shown).alias("nodes"), _listed(links).alias("links"), _listed(names).alias("communities"))


def display_scales(spark, d):
    nodes, edges = _graph(spark, d)
    radius = payload.node_radius(nodes).select("language", F.col("id").alias("item"), F.lit("radius").alias("scale"), F.col("radius").alias("value"))
    links = payload.link_scales(edges).select(
        "language",
        F.concat_ws(" - ", "source", "target").alias("item"),
        F.explode(F.array(F.struct(F.lit("width").alias("scale"), F.col("width").alias("value")), F.struct(F.lit("length").alias("scale"), F.col("length").alias("value")))).alias("_s"),
    ).select("language", "item", "_s.*")
    return radius.unionByName(links).withColumn("value", round_even("value", 6))


def betweenness(spark, d):
    return centrality.betweenness_centrality(_graph(spark, d)[1])


def betweenness_unweighted(spark, d):
    return centrality.betweenness_centrality(_graph(spark, d)[1], weighted=False)


def modularity(spark, d):
    nodes, edges = _graph(spark, d)
    labels = nodes.select("language", "id", (F.ascii("id") % 4).alias("community"))
    return community.modularity(edges, labels).withColumn("modularity", round_even("modularity", 9))


def communities(spark, d):
    return community.communities(_graph(spark, d)[1])


def network_centrality(spark, d):
    nodes, edges = _graph(spark, d)
    full = graph.network_nodes(
        nodes, community.communities(edges, "none"), graph.degree_centrality(edges), centrality.betweenness_centrality(edges)
    )
    return graph.network_centrality(full)


# --- vectors ---------------------------------------------------------------------

def _embeddings(spark, d):
    return a.table(spark, d, "embeddings").select(
        F.lit("all").alias("language"), F.col("vec_id").alias("doc_id"), F.col("embedding").cast("array<double>").alias("vector")
    )


def l2_normalize(spark, d):
    unit = _embeddings(spark, d).select("doc_id", F.posexplode(vectors.l2_normalize("vector")).alias("position", "value"))
    return unit.withColumn("value", round_even("value", 9))


def _near(spark, d):
    points = write_through(density.distinct_points(_embeddings(spark, d)), "points")
    found = near.nearest_neighbors(near.lay_out(points), 3)
    return found, write_through(near.core_distances(points, found, 3), "cores")


def core_distance(spark, d):
    return _near(spark, d)[1].select(F.col("pid").alias("vec_id"), round_even("core", 9).alias("core"))


def mutual_reachability(spark, d):
    """The three nearest neighbours of each vector with their mutual reachability distance."""
    found, cores = _near(spark, d)
    other = cores.select(F.col("pid").alias("nbr"), F.col("core").alias("other_core"))
    joined = found.join(cores.select("pid", "core"), "pid").join(other, "nbr")
    reach = round_even(F.greatest("core", "other_core", "d"), 9)
    return joined.select(F.col("pid").alias("vec_id"), "nbr", reach.alias("reachability"))


def mst(spark, d):
    points = write_through(density.distinct_points(_embeddings(spark, d)), "points")
    layout = near.lay_out(points)
    found = near.nearest_neighbors(layout, 3)
    return near.spanning_tree(layout, found, write_through(near.core_distances(points, found, 3), "cores"))


def density_clusters(spark, d):
    return density.density_clusters(_embeddings(spark, d), min_cluster_size=10)


def svd_energy(spark, d):
    vocab, weights = tfidf.fit(a.documents(spark, d))
    return vectors.svd_energy(write_through(weights, "weights"), vocab)


def text_clusters(spark, d):
    """Documents of each language in clusters of similar text."""
    return cluster_texts(a.documents(spark, d).select("language", "doc_id", "text"), min_cluster_size=5)[0]


# --- patterns --------------------------------------------------------------------

def _patterns(spark, d):
    q = a.clustered_questions(spark, d)
    labels = q.select("language", "cluster_id").distinct().withColumn("label", F.concat("cluster_id", F.lit(" / x")))
    labels = labels.where(F.col("cluster_id") != "src0")
    return patterns.top_patterns(q, labels, 20, max_cluster_size=200)


def top_patterns(spark, d):
    return _patterns(spark, d)


def representatives(spark, d):
    best = patterns.representatives(a.clustered_questions(spark, d))
    return best.select("language", "cluster_id", "question_id", "score", "rank")


def pattern_summary(spark, d):
    return patterns.pattern_summary(_patterns(spark, d))


def patterns_payload(spark, d):
    examples = patterns.representatives(a.clustered_questions(spark, d))
    p = payload.patterns_payload(_patterns(spark, d), examples)
    shown = F.transform(
        "patterns",
        lambda x: F.concat_ws(
            ":", x["label"], x["size"].cast("string"),
            F.array_join(F.transform(x["examples"], lambda e: e["question_id"].cast("string")), ","),
        ),
    )
    return p.select("language", _listed(shown).alias("patterns"))


def clean_label(spark, d):
    raw = F.concat(F.lower(F.replace("p_name", F.lit(" "), F.lit("_"))), F.lit(" / "), F.col("p_type"))
    return a.table(spark, d, "part").select("p_partkey", payload.clean_label(raw, {"red_widget": "Red Widgets!"}).alias("label"))


def display_columns(spark, d):
    shown = payload.display_columns(_patterns(spark, d), colors={"en": "#3776AB", "fr": "#F7DF1E"})
    return shown.withColumn("shade", round_even("shade", 9))


QUERIES = {
    f.__name__: f
    for f in (
        yearly_counts, survey_trend, total_questions, answer_rate_by_language, mean_of_yearly, distinct_years,
        trends_payload, survey_payload, survey_files, landed_pages, stored_table, stored_documents,
        landed_chains, upserted_log, rewritten_table, gated_counts,
        clean_questions, cleaning_report, clean_titles, epoch_to_ts, parse_tags, dedupe_first, html_to_text, clean_body,
        text_combined, tagged_between, year_bounds, sample_per_year,
        describe, null_profile, count_pivot, box_stats, cluster_quality, rows_per_language,
        extract_errors, tokenize, removed_words, top_words, term_counts, vocabulary, tfidf_transform, cluster_labels,
        tag_frequency, top_tags, top_cotags, tag_pairs, cooccurrence_nodes, cooccurrence_edges, degree_centrality,
        neighbors, network_nodes, top_nodes, trim_network, trim_unweighted, network_summary, community_profile, network_payload,
        display_scales, betweenness, betweenness_unweighted, modularity, communities, network_centrality,
        l2_normalize, core_distance, mutual_reachability, mst, density_clusters, svd_energy, text_clusters,
        top_patterns, representatives, pattern_summary, patterns_payload, clean_label, display_columns,
    )
}
QUERIES["latest_within_ttl"] = latest_response
QUERIES["trends_merged"] = _trends
QUERIES["tfidf"] = tfidf_weights
