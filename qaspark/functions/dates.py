"""Date column expressions; the session time zone is expected to be UTC."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_timestamp(df: DataFrame, column: str) -> Column:
    """UNIX seconds become a timestamp; a timestamp is passed through."""
    if isinstance(df.schema[column].dataType, T.NumericType):
        return F.timestamp_seconds(F.col(column))
    return F.col(column)


def year_start(year: Column) -> Column:
    """UNIX second at which the year begins."""
    return F.unix_timestamp(F.make_timestamp(year, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0), F.lit("UTC")))


def year_end(year: Column) -> Column:
    """UNIX second just before the next year begins."""
    return F.unix_timestamp(F.make_timestamp(year, F.lit(12), F.lit(31), F.lit(23), F.lit(59), F.lit(59), F.lit("UTC")))
