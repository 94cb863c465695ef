"""Yearly survey files: ``<root>/<year>/<one of two names>``, wide CSV."""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaspark.fixed_values import SURVEY_FILE_NAMES, SURVEY_HAVE_COLUMN, SURVEY_WANT_COLUMN

log = logging.getLogger(__name__)


def read_survey_year(spark: SparkSession, root: str, year: int) -> DataFrame:
    """The wide file of one year, every column a string; the first name that exists wins."""
    for name in SURVEY_FILE_NAMES:
        try:
            # Column names come from the header; without schema inference no data is read here.
            return spark.read.csv(f"{root}/{year}/{name}", header=True, multiLine=True, quote='"', escape='"')
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"no survey file of {year} in {root}: expected one of {SURVEY_FILE_NAMES}")


def read_survey(spark: SparkSession, root: str, years: list[int]) -> DataFrame:
    """``(year, have, want)`` of all years that have a file and a have-column."""
    parts = []
    for year in years:
        try:
            wide = read_survey_year(spark, root, year)
        except FileNotFoundError as e:
            log.warning("%s", e)
            continue
        if SURVEY_HAVE_COLUMN not in wide.columns:
            log.warning("survey of %s has no column %s", year, SURVEY_HAVE_COLUMN)
            continue
        want = F.col(SURVEY_WANT_COLUMN) if SURVEY_WANT_COLUMN in wide.columns else F.lit(None).cast("string")
        parts.append(wide.select(F.lit(year).alias("year"), F.col(SURVEY_HAVE_COLUMN).alias("have"), want.alias("want")))
    if not parts:
        return spark.createDataFrame([], "year int, have string, want string")
    return reduce(lambda a, b: a.unionByName(b), parts)
