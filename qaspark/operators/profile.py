"""Table profiles: describe, null counts, box plots, pivots, row counts of results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaspark.functions.numbers import clip, round_even
from qaspark.operators.quantiles import aggregate_with_quantiles, rank_bracket, ranked_values, sketched


def describe(df: DataFrame, columns: list[str], digits: int = 1) -> DataFrame:
    """Count, mean, deviation, minimum, quartiles and maximum, one row per column."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    long = df.select(F.explode(F.array(*cells)).alias("_x")).select("_x.*").where(F.col("value").isNotNull())
    aggregates = [
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    ]
    quartiles = {"q25": ("value", 0.25), "q50": ("value", 0.5), "q75": ("value", 0.75)}
    full = aggregate_with_quantiles(long, ["column"], aggregates, quartiles)
    figures = ["mean", "std", "min", "q25", "q50", "q75", "max"]
    return full.select("column", "count", *[round_even(c, digits).alias(c) for c in figures])


def null_profile(df: DataFrame) -> DataFrame:
    """Type and number of nulls of every column that has any, from one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    types = dict(df.dtypes)
    cells = [F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("type"), F.col(c).alias("nulls")) for c in df.columns]
    return counts.select(F.explode(F.array(*cells)).alias("_x")).select("_x.*").where(F.col("nulls") > 0)


def count_pivot(df: DataFrame, languages: list[str]) -> DataFrame:
    """Questions per year, one column per language; an absent cell stays null."""
    counts = df.groupBy("year", "language").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("year").pivot("language", languages).agg(F.first("n"))


def box_stats(df: DataFrame, column: str = "score", low: float = -5, high: float = 20) -> DataFrame:
    """Quartiles, whiskers and outlier count of the clipped values per language.

    Whiskers end at the furthest value within 1.5 quartile distances of the box.
    """
    clipped = df.select("language", clip(F.col(column).cast("double"), low, high).alias("value"))
    clipped = clipped.where(F.col("value").isNotNull() & F.col("language").isNotNull())
    keys, columns = ["language"], ["value"]
    table, groups = sketched(clipped, keys, columns, [F.lit(1).alias("_one")])
    # The sketch already tells between which values the fences lie; those are kept with the quartiles in the second read.
    (q1_low, q1_high), (q3_low, q3_high) = rank_bracket(0, 0.25), rank_bracket(0, 0.75)
    least, most = (q3_low - q1_high) * 1.5, (q3_high - q1_low) * 1.5
    fences = [("floor", 0, q1_low - most, q1_high - least), ("roof", 0, q3_low + least, q3_high + most)]
    wanted = {"q1": ("value", 0.25), "median": ("value", 0.5), "q3": ("value", 0.75)}
    box, found = ranked_values(table, clipped, keys, columns, groups, wanted, fences)
    reach = (F.col("q3") - F.col("q1")) * 1.5
    floor, roof = (F.col("q") == 3) & (F.col("least") >= F.col("q1") - reach), (F.col("q") == 4) & (F.col("most") <= F.col("q3") + reach)
    under, over = (F.col("q") == 3) & (F.col("most") < F.col("q1") - reach), (F.col("q") == 4) & (F.col("least") > F.col("q3") + reach)
    return found.join(box, keys).groupBy("language", "q1", "median", "q3").agg(
        F.min(F.when(floor, F.col("least"))).alias("whisker_low"),
        F.max(F.when(roof, F.col("most"))).alias("whisker_high"),
        F.coalesce(F.sum(F.when(under | over, F.col("rows"))), F.lit(0).cast("long")).alias("outliers"),
    )


def cluster_quality(df: DataFrame) -> DataFrame:
    """Number of clusters and share of noise per language (noise is -1)."""
    sizes = df.groupBy("language", "cluster_id").agg(F.count(F.lit(1)).alias("_n"))
    noise = F.col("cluster_id") == -1
    return sizes.groupBy("language").agg(
        F.count_if(~noise).alias("n_clusters"),
        (F.sum(F.when(noise, F.col("_n")).otherwise(0)) / F.sum("_n")).alias("noise_ratio"),
    )


def rows_per_language(df: DataFrame) -> DataFrame:
    return df.groupBy("language").agg(F.count(F.lit(1)).alias("n_rows"))


def require_languages(df: DataFrame, languages: list[str]) -> DataFrame:
    """Rows per language for the expected languages, 0 where the result has none."""
    expected = df.sparkSession.createDataFrame([(x,) for x in languages], "language string")
    counts = expected.join(rows_per_language(df), "language", "left")
    return counts.select("language", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))
