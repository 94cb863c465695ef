"""Micro level: labels, profiles and examples of text clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaspark.fixed_values import LANGUAGE_STOPWORDS, NOISE_LABEL, PATTERN_TOP_N
from qaspark.functions.numbers import round_even
from qaspark.operators.quantiles import aggregate_with_quantiles
from qaspark.operators.ranking import top_per_group
from qaspark.session import write_through

_CLUSTER = ["language", "cluster_id"]
_NOISE = -1


def _default_label() -> Column:
    return F.concat(F.lit("cluster_"), F.col("cluster_id").cast("string"))


def cluster_labels(
    assigned: DataFrame,
    weights: DataFrame,
    n: int = 5,
    language_words: dict[str, list[str]] = LANGUAGE_STOPWORDS,
) -> DataFrame:
    """Label of each cluster: its ``n`` heaviest terms by mean weight, joined by `` / ``.

    ``assigned`` is ``(language, doc_id, cluster_id)``; documents without the term count as 0
    in the mean. Terms made of language names, pairs that begin with one and terms of one
    letter are skipped.
    """
    assigned = assigned.select("language", "doc_id", "cluster_id")
    sizes = assigned.groupBy(*_CLUSTER).agg(F.count(F.lit(1)).alias("_size"))
    # The number of documents in the cluster is the same for all its terms, so ordering by
    # the sum would do; the mean is kept because callers can read it.
    summed = (
        weights.join(assigned, ["language", "doc_id"]).where(F.col("cluster_id").cast("string") != str(_NOISE))
        .groupBy(*_CLUSTER, "term").agg(F.sum("weight").alias("_sum"))
    )
    named = F.coalesce(
        F.try_element_at(F.create_map(*[x for k, v in language_words.items() for x in (F.lit(k), F.array(*map(F.lit, v)))]), F.col("language"))
        if language_words
        else F.lit(None).cast("array<string>"),
        F.array().cast("array<string>"),
    )
    parts = F.split(F.lower("term"), " ")
    only_names = F.forall(parts, lambda w: F.array_contains(named, w))
    starts_with_name = (F.size(parts) > 1) & F.array_contains(named, parts[0])
    usable = summed.where(~only_names & ~starts_with_name & (F.length("term") > 1))
    means = usable.join(sizes, _CLUSTER).withColumn("mean_weight", F.col("_sum") / F.col("_size"))
    best = top_per_group(means, _CLUSTER, [round_even("mean_weight", 12).desc(), F.col("term")], n, rank="_r")
    listed = best.groupBy(*_CLUSTER).agg(F.sort_array(F.collect_list(F.struct("_r", "term"))).alias("_l"))
    label = F.array_join(F.transform("_l", lambda s: s["term"]), " / ")
    noise = F.col("cluster_id").cast("string") == str(_NOISE)
    return sizes.join(listed, _CLUSTER, "left").select(
        *_CLUSTER, F.when(noise, F.lit(NOISE_LABEL)).otherwise(F.coalesce(label, _default_label())).alias("label")
    )


def top_patterns(
    df: DataFrame, labels: DataFrame, n: int = PATTERN_TOP_N, max_cluster_size: int | None = None
) -> DataFrame:
    """Profile of the ``n`` largest clusters per language; noise and oversized ones left out.

    A missing score, view or answer column gives 0.
    """
    for name in ("score", "view_count", "is_answered"):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(0.0))
    rows = df.where(F.col("cluster_id").cast("string") != str(_NOISE))
    plain = rows.groupBy(*_CLUSTER).agg(
        F.count(F.lit(1)).alias("size"), F.avg(F.col("is_answered").cast("double")).alias("answer_rate")
    )
    if max_cluster_size is not None:
        plain = plain.where(F.col("size") <= max_cluster_size)
    best = top_per_group(plain, ["language"], [F.desc("size"), F.col("cluster_id")], n, rank="rank")
    best = write_through(best, "best-clusters")
    medians = {"median_score": ("score", 0.5), "median_views": ("view_count", 0.5)}
    found = aggregate_with_quantiles(rows.join(best.select(*_CLUSTER), _CLUSTER, "left_semi"), _CLUSTER, [F.lit(1).alias("_one")], medians).drop("_one")
    full = best.join(found, _CLUSTER, "left").join(labels, _CLUSTER, "left")
    return full.select(
        *_CLUSTER,
        F.coalesce("label", _default_label()).alias("label"),
        "size",
        round_even("median_score", 2).alias("median_score"),
        round_even("median_views", 1).alias("median_views"),
        round_even("answer_rate", 3).alias("answer_rate"),
        "rank",
    )


def representatives(df: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` best-scored questions of each cluster (by id where there is no score)."""
    order = [F.desc("score"), F.col("question_id")] if "score" in df.columns else [F.col("question_id")]
    return top_per_group(df, _CLUSTER, order, n, rank="rank")


def pattern_summary(patterns: DataFrame, n: int = 15) -> DataFrame:
    """Per language the largest cluster and the one least often answered, among the first ``n``."""
    shown = patterns.where(F.col("rank") <= n)
    return shown.groupBy("language").agg(
        F.min_by("label", F.col("rank")).alias("largest"),
        F.min_by("size", F.col("rank")).alias("largest_size"),
        F.min_by("label", F.struct("answer_rate", "rank")).alias("hardest"),
        F.min_by("answer_rate", F.struct("answer_rate", "rank")).alias("hardest_rate"),
    )
