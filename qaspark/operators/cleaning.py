"""Cleaning of raw question rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qaspark.functions import dates, text
from qaspark.operators.ranking import first_per_key, top_per_group
from qaspark.schemas import require_columns


def language_rank(order: list[str] | None) -> Column:
    """Position of the language in ``order``; unknown languages come last."""
    if not order:
        return F.lit(0)
    position = F.array_position(F.array(*[F.lit(x) for x in order]), F.col("language"))
    return F.when(position > 0, position).otherwise(len(order) + 1)


def clean_titles(df: DataFrame, column: str = "title") -> DataFrame:
    """Drop null titles, decode entities, strip, drop blank titles."""
    decoded = df.where(F.col(column).isNotNull()).withColumn(column, text.strip(text.unescape_html(column)))
    return decoded.where(F.length(column) > 0)


def epoch_to_timestamp(df: DataFrame, column: str = "creation_date") -> DataFrame:
    return df.withColumn(column, dates.to_timestamp(df, column))


def tags_to_list(df: DataFrame, column: str = "tags") -> DataFrame:
    """Bracketed strings become lists; lists pass through; other types give empty lists."""
    kind = df.schema[column].dataType
    empty = F.array().cast("array<string>")
    if isinstance(kind, T.StringType):
        return df.withColumn(column, text.parse_tags(column))
    if isinstance(kind, T.ArrayType):
        return df.withColumn(column, F.coalesce(F.col(column).cast("array<string>"), empty))
    return df.withColumn(column, empty)


def dedupe(df: DataFrame, key: str = "question_id", language_order: list[str] | None = None) -> DataFrame:
    """One row per id: the one of the first language, then the oldest."""
    content = F.xxhash64(*[c for c in df.columns if c != key])
    return first_per_key(df, [key], [language_rank(language_order), F.col("creation_date"), content])


def clean_questions(df: DataFrame, language_order: list[str] | None = None) -> DataFrame:
    require_columns(df, "question_id", "title", "tags", "creation_date", "language")
    df = tags_to_list(epoch_to_timestamp(clean_titles(df)))
    return dedupe(df, language_order=language_order)


def cleaning_report(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Rows before, rows after and rows dropped."""
    n_after = cleaned.agg(F.count(F.lit(1))).scalar()
    counts = raw.agg(F.count(F.lit(1)).alias("n_before")).withColumn("n_after", n_after)
    return counts.withColumn("n_dropped", F.col("n_before") - F.col("n_after"))


def with_text_combined(df: DataFrame, column: str = "text_combined") -> DataFrame:
    return df.withColumn(column, text.text_combined("title", "tags"))


def tagged_between(df: DataFrame, tag: str, first: str, last: str) -> DataFrame:
    """Questions with the tag whose date lies in the range, both ends included, oldest first."""
    # Bounds of the column's own type: a cast of the column would keep the filter from the scan.
    kind = df.schema["creation_date"].dataType
    between = F.col("creation_date").between(F.lit(first).cast(kind), F.lit(last).cast(kind))
    return df.where(between & F.array_contains("tags", tag)).orderBy("creation_date", "question_id")


def with_year_bounds(df: DataFrame, year: str = "year") -> DataFrame:
    """First and last UNIX second of each year (UTC)."""
    return df.withColumn("start_ts", dates.year_start(F.col(year))).withColumn("end_ts", dates.year_end(F.col(year)))


def sample_per_year(df: DataFrame, n: int, first_year: int | None = None, last_year: int | None = None) -> DataFrame:
    """The ``n`` oldest questions of each language and year."""
    if first_year is not None:
        df = df.where(F.col("year") >= first_year)
    if last_year is not None:
        df = df.where(F.col("year") <= last_year)
    return top_per_group(
        df, ["language", "year"], [F.col("creation_date"), F.col("question_id")], n, salt_on=["question_id"]
    )
