"""Stored tables: Parquet in and out, nested JSON out, the language dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaspark.fixed_values import LANGUAGES
from qaspark.schemas import LANGUAGE


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, partition_by: str | None = "language") -> None:
    """Overwrite ``path`` with ``df``, one folder per language where it has one.

    ``path`` must not be among the files that ``df`` reads.
    """
    writer = df.write.mode("overwrite")
    if partition_by and partition_by in df.columns and len(df.columns) > 1:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def write_documents(df: DataFrame, path: str) -> None:
    """Overwrite ``path`` with one JSON document per row, nulls written out."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def languages_table(spark: SparkSession, languages: list[dict] = LANGUAGES) -> DataFrame:
    """The language dimension: a handful of configured rows."""
    return spark.createDataFrame([tuple(x[n] for n in LANGUAGE.names) for x in languages], LANGUAGE)


def read_languages(spark: SparkSession, path: str) -> DataFrame:
    """The language dimension from a YAML file ``languages: {key: {tag, display_name, ...}}``."""
    import yaml

    with open(path, encoding="utf-8") as f:
        configured = yaml.safe_load(f)["languages"]
    rows = [
        {
            "language": key,
            "tag": entry.get("tag", key),
            "display_name": entry.get("display_name", key),
            "color": entry.get("color"),
            "related_tags": entry.get("related_tags", []),
        }
        for key, entry in configured.items()
    ]
    return languages_table(spark, rows)


def expand_tags(languages: DataFrame) -> DataFrame:
    """The tags whose statistics are asked for: each language's own and its related ones."""
    own = F.array(F.col("tag"))
    return languages.select("language", F.explode(F.concat(own, F.coalesce("related_tags", F.array()))).alias("name"))
