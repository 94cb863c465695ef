"""Micro level: on what people get stuck."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaspark.fixed_values import LANGUAGE_STOPWORDS, MAX_CLUSTER_SIZE, PATTERN_TOP_N
from qaspark.operators import patterns, payload, tfidf
from qaspark.operators.cleaning import with_text_combined
from qaspark.operators.density import MIN_CLUSTER_SIZE, MIN_SAMPLES, density_clusters
from qaspark.operators.vectors import vectorize
from qaspark.session import write_through


@dataclass
class Micro:
    clusters: DataFrame
    patterns: DataFrame
    documents: DataFrame


def text_clusters(
    docs: DataFrame,
    max_features: int = 5000,
    n_components: int = 50,
    min_df: int = 3,
    min_cluster_size: int = MIN_CLUSTER_SIZE,
    min_samples: int = MIN_SAMPLES,
    method: str = "density",
) -> tuple[DataFrame, DataFrame]:
    """``(assigned, weights)`` of ``docs(language, doc_id, text)``: cluster ids and TF-IDF."""
    vocab, weights = tfidf.fit(docs, min_df=min_df, max_features=max_features)
    weights = write_through(weights, "weights")
    vectors = vectorize(docs, vocab, weights, n_components)
    if method == "density":
        vectors = write_through(vectors, "vectors")
    return write_through(density_clusters(vectors, min_cluster_size, min_samples, method), "assigned"), weights


def run_micro(
    questions: DataFrame,
    n: int = PATTERN_TOP_N,
    max_cluster_size: int | None = MAX_CLUSTER_SIZE,
    language_words: dict[str, list[str]] = LANGUAGE_STOPWORDS,
    **options,
) -> Micro:
    """Clusters of titles with tags, their profiles, and the documents for the web page."""
    questions = with_text_combined(questions)
    docs = questions.select("language", F.col("question_id").alias("doc_id"), F.col("text_combined").alias("text"))
    assigned, weights = text_clusters(docs, **options)
    labels = patterns.cluster_labels(assigned, weights, language_words=language_words)
    clusters = questions.join(assigned.withColumnRenamed("doc_id", "question_id"), ["language", "question_id"])
    clusters = write_through(clusters, "clusters")
    best = write_through(patterns.top_patterns(clusters, labels, n, max_cluster_size), "patterns")
    examples = patterns.representatives(clusters.join(best.select("language", "cluster_id"), ["language", "cluster_id"], "left_semi"))
    return Micro(clusters, best, payload.patterns_payload(best, examples))
