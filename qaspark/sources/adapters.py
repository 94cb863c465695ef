"""Views of the supplied warehouse tables in the shapes the operators expect.

Orders stand for questions, their priority for the language, the names of their parts for
tags, customers of a year for survey respondents, documents for post texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qaspark.sources.tables import languages_table, read_table

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
BRAND_OF = {
    "1-URGENT": "Brand#1",
    "2-HIGH": "Brand#17",
    "3-MEDIUM": "Brand#2",
    "4-NOT SPECIFIED": "Brand#25",
    "5-LOW": "Brand#9",
}
COLOR_OF = {"1-URGENT": "#d62728", "2-HIGH": "#ff7f0e", "3-MEDIUM": "#2ca02c", "4-NOT SPECIFIED": "#1f77b4"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, f"{folder}/{name}.parquet")


def _question_columns() -> list[Column]:
    return [
        F.col("o_orderkey").alias("question_id"),
        F.col("o_orderpriority").alias("language"),
        F.year("o_orderdate").alias("year"),
        F.col("o_orderdate").alias("creation_date"),
        F.col("o_totalprice").alias("score"),
        F.col("o_custkey").alias("view_count"),
        (F.col("o_orderstatus") == "F").alias("is_answered"),
    ]


def questions(spark: SparkSession, folder: str) -> DataFrame:
    """Questions without tags: one scan, no join."""
    return table(spark, folder, "orders").select(*_question_columns())


def _named_lines(spark: SparkSession, folder: str, part_column: str, *line_columns: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", *line_columns)
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), part_column)
    return lines.join(parts, "l_partkey")


def tagged_questions(spark: SparkSession, folder: str) -> DataFrame:
    """Questions with their sorted tag set; orders without lines have no tags."""
    tags = (
        _named_lines(spark, folder, "p_name")
        .groupBy(F.col("l_orderkey").alias("question_id"))
        .agg(F.sort_array(F.collect_set("p_name")).alias("tags"))
    )
    joined = questions(spark, folder).join(tags, "question_id", "left")
    return joined.withColumn("tags", F.coalesce("tags", F.array().cast("array<string>")))


def survey(spark: SparkSession, folder: str) -> DataFrame:
    """``(year, respondent, have, want)``: a customer's brands of the year as ``;`` lists."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.year("o_orderdate").alias("year"), F.col("o_custkey").alias("respondent")
    )
    lines = _named_lines(spark, folder, "p_brand", "l_returnflag").join(orders, "l_orderkey")
    returned = F.when(F.col("l_returnflag") == "R", F.col("p_brand"))
    grouped = lines.groupBy("year", "respondent").agg(
        F.sort_array(F.collect_set("p_brand")).alias("_have"), F.sort_array(F.collect_set(returned)).alias("_want")
    )
    listed = lambda c: F.when(F.size(c) > 0, F.array_join(c, ";"))
    return grouped.select("year", "respondent", listed("_have").alias("have"), listed("_want").alias("want"))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    # Dealt by document once: counts per document need no further shuffle of the words.
    docs = table(spark, folder, "documents").repartition("doc_id")
    return docs.select("doc_id", F.col("lang").alias("language"), "text", F.col("source").alias("cluster_id"))


def pages(spark: SparkSession, folder: str) -> DataFrame:
    # Markup is dear to parse: dealing the pages out evenly costs less than waiting for the largest file.
    return table(spark, folder, "pages").select("page_id", "html").repartition("page_id")


def clustered_questions(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as questions of given clusters (the source), with score and views."""
    docs = table(spark, folder, "documents")
    return docs.select(
        F.col("doc_id").alias("question_id"),
        F.col("lang").alias("language"),
        F.col("source").alias("cluster_id"),
        F.concat(F.lit("Post "), F.col("doc_id").cast("string")).alias("title"),
        F.col("n_chars").alias("score"),
        (F.col("doc_id") % 1000).alias("view_count"),
        (F.col("n_chars") % 3 > 0).alias("is_answered"),
    )


def tag_statistics(spark: SparkSession, folder: str) -> DataFrame:
    """``(name, count, language)``: lines per brand and order priority."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("language")
    )
    lines = _named_lines(spark, folder, "p_brand").join(orders, "l_orderkey")
    return lines.groupBy(F.col("p_brand").alias("name"), "language").agg(F.count(F.lit(1)).alias("count"))


def languages(spark: SparkSession) -> DataFrame:
    rows = [
        {"language": p, "tag": BRAND_OF[p], "display_name": BRAND_OF[p], "color": COLOR_OF.get(p), "related_tags": []}
        for p in PRIORITIES
    ]
    return languages_table(spark, rows)
