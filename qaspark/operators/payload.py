"""Nested documents for the web page, and the numbers its charts need.

Every document has one row per language; the lists inside are bounded by the number of
years or by a top-n.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaspark.fixed_values import COMMUNITY_LABELS, COMMUNITY_PREFIX, DEFAULT_COLOR, LANGUAGES, READABLE_LABELS
from qaspark.functions.numbers import round_even, round_half_up
from qaspark.operators.trend import total_questions


def _by_year(df: DataFrame, *columns: Column) -> DataFrame:
    """One map ``year -> figures`` per language; the rows are one per language and year."""
    entry = F.struct("year", F.struct(*columns))
    return df.groupBy("language").agg(F.map_from_entries(F.collect_list(entry)).alias("_by_year"))


def _years(df: DataFrame) -> Column:
    """All years of the table in order, as one value usable next to any row."""
    return df.agg(F.sort_array(F.collect_set("year"))).scalar()


def _figures(years: Column | str, name: str) -> Column:
    """The figure of every year in ``years``, null where the language has none."""
    by_year = F.col("_by_year")
    return F.transform(years, lambda y: F.try_element_at(by_year, y)[name])


def _named(tags: DataFrame, languages: DataFrame) -> DataFrame:
    named = languages.select(
        "language",
        F.coalesce("display_name", "language").alias("display_name"),
        F.coalesce("color", F.lit(DEFAULT_COLOR)).alias("color"),
    )
    return named.join(total_questions(tags, languages).select("language", "total_questions"), "language")


def trends_payload(trends: DataFrame, tags: DataFrame, languages: DataFrame) -> DataFrame:
    """All years, survey years, and per language the yearly and survey lists.

    The yearly lists are as long as the list of years, with null where a year is missing;
    the survey lists hold the years with a usage share.
    """
    body = _by_year(
        trends,
        round_even("median_score", 2).alias("median_score"),
        round_even("median_views", 0).alias("median_views"),
        round_even("answer_rate", 3).alias("answer_rate"),
        F.col("usage_pct"),
        F.col("want_pct"),
    )
    rows = (
        _named(tags, languages)
        .join(body, "language", "left")
        .withColumn("years", _years(trends))
        .withColumn("survey_years", _years(trends.where(F.col("usage_pct").isNotNull())))
    )
    own = F.sort_array(
        F.transform(
            F.filter(F.map_entries("_by_year"), lambda e: e["value"]["usage_pct"].isNotNull()), lambda e: e["key"]
        )
    )
    yearly = [_figures("years", n).alias(n) for n in ("median_score", "median_views", "answer_rate")]
    empty = F.array().cast("array<double>")
    asked = [F.coalesce(_figures(own, n), empty).alias(n) for n in ("usage_pct", "want_pct")]
    return rows.select(
        "language", "display_name", "color", "total_questions", "years", "survey_years",
        F.struct(*yearly).alias("yearly"), F.struct(*asked).alias("survey"),
    )


def survey_payload(survey: DataFrame, tags: DataFrame, languages: DataFrame) -> DataFrame:
    """The survey lists of each language over the years it was asked."""
    body = _by_year(survey, F.col("usage_pct"), F.col("want_pct"))
    rows = _named(tags, languages).join(body, "language", "left").withColumn("years", _years(survey))
    own = F.sort_array(F.map_keys("_by_year"))
    empty = F.array().cast("array<double>")
    return rows.select(
        "language", "display_name", "color", "years",
        *[F.coalesce(_figures(own, n), empty).alias(n) for n in ("usage_pct", "want_pct")],
        "total_questions",
    )


def network_payload(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes, links and the names of the communities of each language's trimmed graph."""
    fields = ["id", "frequency", "community", "degree_centrality", "betweenness_centrality"]
    named = F.sort_array(F.collect_set(F.struct("community", community_name("language", "community").alias("name"))))
    names = nodes.groupBy("language").agg(named.alias("communities"))
    listed = nodes.groupBy("language").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("nodes"))
    links = edges.groupBy("language").agg(
        F.sort_array(F.collect_list(F.struct("source", "target", "weight"))).alias("links")
    )
    return listed.join(links, "language", "left").join(names, "language")


def patterns_payload(patterns: DataFrame, examples: DataFrame) -> DataFrame:
    """Patterns of each language by rank, each with its example questions."""
    key = ["language", "cluster_id"]
    shown = F.struct("rank", "question_id", "title", "score", "view_count")
    # The patterns are a top-n, so only their clusters' examples take part.
    wanted = examples.join(patterns.select(*key), key, "left_semi")
    listed = wanted.groupBy(*key).agg(F.sort_array(F.collect_list(shown)).alias("_e"))
    fields = ["question_id", "title", "score", "view_count"]
    clean = F.transform("_e", lambda e: F.struct(*[e[f].alias(f) for f in fields]))
    rows = patterns.join(listed, key, "left").withColumn("examples", clean)
    columns = ["cluster_id", "label", "size", "median_score", "median_views", "answer_rate", "examples"]
    packed = F.sort_array(F.collect_list(F.struct("rank", F.struct(*columns).alias("p"))))
    return rows.groupBy("language").agg(F.transform(packed, lambda s: s["p"]).alias("patterns"))


def clean_label(raw: Column | str, names: dict[str, str] = READABLE_LABELS) -> Column:
    """Readable form of the first term of a label."""
    raw = F.col(raw) if isinstance(raw, str) else raw
    first = F.lower(F.trim(F.element_at(F.split(raw, " / "), 1)))
    known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    # A capital after every break between words, as in "node.js" -> "Node.Js".
    pieces = F.regexp_extract_all(F.replace(first, F.lit("_"), F.lit(" ")), F.lit(r"([A-Za-z0-9]+|[^A-Za-z0-9]+)"), 1)
    raised = F.array_join(
        F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substr(p, F.lit(2)))), ""
    )
    return F.coalesce(F.try_element_at(known, first), raised)


def display_columns(patterns: DataFrame, n: int = 15, colors: dict[str, str] | None = None) -> DataFrame:
    """The first ``n`` patterns with readable label, percentage and colour, last one first."""
    colors = {x["language"]: x["color"] for x in LANGUAGES} if colors is None else colors
    shade = F.lit(0.45) + (1 - F.col("answer_rate")) * F.lit(0.55)
    base = F.try_element_at(F.create_map(*[F.lit(x) for pair in colors.items() for x in pair]), F.col("language"))
    alpha = F.lower(F.lpad(F.hex(round_half_up(shade * 255)), 2, "0"))
    return (
        patterns.where(F.col("rank") <= n)
        .select(
            "language", "cluster_id", "rank", "size", "answer_rate",
            clean_label("label").alias("label"),
            shade.alias("shade"),
            F.concat(F.coalesce(base, F.lit("#4f8ef7")), alpha).alias("color"),
            round_half_up(F.col("answer_rate") * 100).alias("answer_pct"),
        )
        .orderBy("language", F.desc("rank"))
    )


def rate_percentages(yearly: DataFrame) -> DataFrame:
    """Answer rate as a whole percentage; null stays null."""
    return yearly.withColumn("answer_pct", round_half_up(F.col("answer_rate") * 100))


def node_radius(nodes: DataFrame) -> DataFrame:
    """Square-root scale from [1, largest frequency] to [5, 30], clamped."""
    largest = nodes.groupBy("language").agg(F.max("frequency").alias("_max"))
    span = F.sqrt(F.col("_max").cast("double")) - 1
    share = F.coalesce(F.try_divide(F.sqrt(F.col("frequency").cast("double")) - 1, span), F.lit(0.5))
    clamped = F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0))
    return nodes.join(largest, "language").withColumn("radius", F.lit(5.0) + clamped * 25).drop("_max")


def link_scales(edges: DataFrame) -> DataFrame:
    """Line width, linear from [1, largest weight] to [0.5, 4], and wanted link length."""
    largest = edges.groupBy("language").agg(F.max("weight").alias("_max"))
    share = F.coalesce(F.try_divide((F.col("weight") - 1).cast("double"), (F.col("_max") - 1).cast("double")), F.lit(0.5))
    return (
        edges.join(largest, "language")
        .withColumn("width", F.lit(0.5) + share * 3.5)
        .withColumn("length", F.greatest(F.lit(55.0), F.lit(90.0) - F.col("weight") * F.lit(1.5)))
        .drop("_max")
    )


def community_name(language: Column | str, community: Column | str) -> Column:
    """Display name of a community; a numbered one where none is set."""
    language = F.col(language) if isinstance(language, str) else language
    community = F.col(community) if isinstance(community, str) else community
    names = F.create_map(
        *[x for k, v in COMMUNITY_LABELS.items() for x in (F.lit(k), F.array(*[F.lit(n) for n in v]))]
    )
    position = (community + 1).cast("int")
    known = F.when(position > 0, F.try_element_at(F.try_element_at(names, language), position))
    return F.coalesce(known, F.concat(F.lit(COMMUNITY_PREFIX), community.cast("string")))
