"""One fixed StructType per table, and the guard that checks for columns."""

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_STRINGS = T.ArrayType(T.StringType())

QUESTION = T.StructType(
    [
        T.StructField("question_id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("tags", _STRINGS),
        T.StructField("creation_date", T.LongType()),
        T.StructField("score", T.LongType()),
        T.StructField("view_count", T.LongType()),
        T.StructField("answer_count", T.LongType()),
        T.StructField("is_answered", T.BooleanType()),
    ]
)

QUESTION_WITH_BODY = T.StructType(QUESTION.fields + [T.StructField("body", T.StringType())])


def api_page(with_body: bool = False) -> T.StructType:
    """One landed response: a page of questions and the paging fields."""
    item = QUESTION_WITH_BODY if with_body else QUESTION
    return T.StructType(
        [
            T.StructField("items", T.ArrayType(item)),
            T.StructField("has_more", T.BooleanType()),
            T.StructField("quota_remaining", T.LongType()),
            T.StructField("backoff", T.IntegerType()),
        ]
    )


def request_page(with_body: bool = False) -> T.StructType:
    """A landed response beside what was asked for: the tag, the range of dates (epoch seconds) and the page."""
    asked = [T.StructField("tag", T.StringType()), *(T.StructField(n, T.LongType()) for n in ("fromdate", "todate", "page"))]
    return T.StructType(asked + api_page(with_body).fields)


LANGUAGE = T.StructType(
    [
        T.StructField("language", T.StringType(), False),
        T.StructField("tag", T.StringType()),
        T.StructField("display_name", T.StringType()),
        T.StructField("color", T.StringType()),
        T.StructField("related_tags", _STRINGS),
    ]
)


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """Return ``df`` unchanged, or fail early and name what is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the table has {df.columns}")
    return df
