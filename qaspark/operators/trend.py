"""Macro level: yearly figures per language and survey shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaspark.fixed_values import LANGUAGES
from qaspark.functions.numbers import ratio, round_even
from qaspark.operators.quantiles import aggregate_with_quantiles
from qaspark.schemas import require_columns

DISPLAY_NAMES = {x["language"]: x["display_name"] for x in LANGUAGES}


def yearly_counts(df: DataFrame) -> DataFrame:
    """Sample size, median score, median views and answer rate per language and year."""
    require_columns(df, "question_id", "language", "year", "score", "view_count", "is_answered")
    keys = ["language", "year"]
    aggregates = [F.count("question_id").alias("sample_count"), F.avg(F.col("is_answered").cast("double")).alias("answer_rate")]
    full = aggregate_with_quantiles(df, keys, aggregates, {"median_score": ("score", 0.5), "median_views": ("view_count", 0.5)})
    return full.select(
        *keys,
        "sample_count",
        round_even("median_score", 2).alias("median_score"),
        round_even("median_views", 2).alias("median_views"),
        round_even("answer_rate", 2).alias("answer_rate"),
    )


def survey_trend(survey: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Usage share, wish share and their ratio per year and language, in one pass.

    ``survey`` has ``year``, ``have`` and ``want`` (lists joined by semicolons, nullable);
    ``names`` maps the language key to the spelling used in the survey.
    """
    require_columns(survey, "year", "have", "want")
    names = DISPLAY_NAMES if names is None else names
    keys = list(names)

    def named(column: str, name: str) -> Column:
        return F.sum(F.array_contains(column, name).cast("long"))

    answers = survey.select("year", F.split("have", ";").alias("have"), F.split("want", ";").alias("want"))
    per_year = answers.groupBy("year").agg(
        F.count("have").alias("respondents"),
        F.count("want").alias("_wanting"),
        *[named("have", names[k]).alias(f"_have_{i}") for i, k in enumerate(keys)],
        *[named("want", names[k]).alias(f"_want_{i}") for i, k in enumerate(keys)],
    )
    cells = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(k).alias("language"),
                    F.lit(names[k]).alias("display_name"),
                    F.coalesce(f"_have_{i}", F.lit(0)).alias("have"),
                    F.coalesce(f"_want_{i}", F.lit(0)).alias("want"),
                )
                for i, k in enumerate(keys)
            ]
        )
    )
    shares = per_year.select("year", "respondents", "_wanting", cells.alias("_c")).select(
        "year",
        F.col("_c.language").alias("language"),
        F.col("_c.display_name").alias("display_name"),
        "respondents",
        round_even(ratio(F.col("_c.have"), F.col("respondents")) * 100, 2).alias("usage_pct"),
        round_even(ratio(F.col("_c.want"), F.col("_wanting")) * 100, 2).alias("want_pct"),
    )
    rated = (F.col("want_pct") != 0) & (F.col("usage_pct") > 0)
    return shares.withColumn(
        "aspiration", F.when(rated, round_even(ratio(F.col("want_pct"), F.col("usage_pct")), 3))
    )


def merge_survey(yearly: DataFrame, survey: DataFrame) -> DataFrame:
    """Yearly figures with the survey shares of the same year and language, if any."""
    return yearly.join(survey, ["year", "language"], "left")


def total_questions(tags: DataFrame, languages: DataFrame) -> DataFrame:
    """Question total of each language's own tag; 0 where the tag table has none.

    Of several rows with the name, the one listed under the language itself counts, else the first by language.
    """
    first = tags.groupBy("name").agg(F.min_by("count", F.struct(F.col("language") != F.col("name"), F.col("language"))).alias("_count"))
    total = F.coalesce("_count", F.lit(0).cast("long"))
    return (
        languages.select("language", F.col("language").alias("name"))
        .join(first, "name", "left")
        .select("language", total.alias("total_questions"), (total / F.lit(1e6)).alias("millions"))
    )


def answer_rate_by_language(df: DataFrame) -> DataFrame:
    rates = df.groupBy("language").agg(F.avg(F.col("is_answered").cast("double")).alias("answer_rate"))
    return rates.orderBy("answer_rate", "language")


def mean_of_yearly(yearly: DataFrame) -> DataFrame:
    """Mean over the years of the yearly medians and rates."""
    return yearly.groupBy("language").agg(
        F.avg("median_score").alias("mean_median_score"), F.avg("answer_rate").alias("mean_answer_rate")
    )


def distinct_years(df: DataFrame) -> DataFrame:
    return df.select("year").where(F.col("year").isNotNull()).distinct().orderBy("year")
