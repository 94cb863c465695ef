"""All three levels from stored tables to stored results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from qaspark.operators.cleaning import clean_questions
from qaspark.operators.profile import require_languages
from qaspark.plans.macro import run_macro
from qaspark.plans.meso import run_meso
from qaspark.plans.micro import run_micro
from qaspark.session import write_through
from qaspark.sources.survey import read_survey
from qaspark.sources.tables import languages_table, read_table, write_documents, write_table


def run_all(
    spark: SparkSession,
    questions: str | DataFrame,
    tags: str | DataFrame,
    survey: str | DataFrame,
    output: str,
    languages: DataFrame | None = None,
    survey_years: list[int] = (2022, 2023, 2024),
    names: dict[str, str] | None = None,
    meso: dict | None = None,
    micro: dict | None = None,
) -> DataFrame:
    """Clean, analyse and store; returns the rows per language of every stored table.

    Tables go to ``<output>/tables/<name>`` as Parquet, documents to ``<output>/documents/<name>``
    as JSON. Paths stand for stored tables, for the survey for the folder of yearly files.
    """
    questions = read_table(spark, questions) if isinstance(questions, str) else questions
    tags = read_table(spark, tags) if isinstance(tags, str) else tags
    survey = read_survey(spark, survey, list(survey_years)) if isinstance(survey, str) else survey
    languages = languages_table(spark) if languages is None else languages
    keys = [r["language"] for r in languages.select("language").collect()]  # the configured dimension

    cleaned = write_through(clean_questions(questions, keys), "questions")
    macro_result = run_macro(cleaned, survey, tags, languages, names)
    meso_result = run_meso(cleaned, **(meso or {}))
    micro_result = run_micro(cleaned, **(micro or {}))
    tables = {
        "questions": cleaned,
        "trends": macro_result.trends,
        "network_centrality": meso_result.nodes.withColumnRenamed("id", "tag"),
        "network_edges": meso_result.edges,
        "network_summary": meso_result.summary,
        "clusters": micro_result.clusters,
        "pitfalls": micro_result.patterns,
    }
    documents = {"trends": macro_result.documents, "networks": meso_result.documents, "pitfalls": micro_result.documents}
    counts = None
    for name, df in tables.items():
        write_table(df, f"{output}/tables/{name}")
        stored = require_languages(read_table(spark, f"{output}/tables/{name}"), keys)
        stored = stored.selectExpr(f"'{name}' AS table", "language", "n_rows")
        counts = stored if counts is None else counts.unionByName(stored)
    for name, df in documents.items():
        write_documents(df, f"{output}/documents/{name}")
    return counts
