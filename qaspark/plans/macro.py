"""Macro level: how languages rise and fall."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from qaspark.operators import payload, trend
from qaspark.session import write_through


@dataclass
class Macro:
    trends: DataFrame
    documents: DataFrame


def run_macro(questions: DataFrame, survey: DataFrame, tags: DataFrame, languages: DataFrame, names: dict[str, str] | None = None) -> Macro:
    """Yearly figures joined with survey shares, and the document for the web page."""
    trends = trend.merge_survey(trend.yearly_counts(questions), trend.survey_trend(survey, names))
    # One row per language and year from here on.
    trends = write_through(trends, "trends")
    return Macro(trends, payload.trends_payload(trends, tags, languages))
