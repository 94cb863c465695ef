"""A training-corpus pipeline over ``documents``: five stages, each written as Parquet and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaspark.llm import language_id, line_dedup, minhash, mixing, packing
from qaspark.llm.components import sized
from qaspark.session import measured_write, write_through

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sets ``lang`` to the language found; documents without letters or without a clear language go.

    The model learns from the documents that carry a label. A document goes if its text is null or has no letters, if
    the best language has less than half of the posterior, or if its n-grams fit that language worse than the
    labelled rows do (``bounds`` of the model): gibberish and languages that were not learned. With no label at all nothing can be
    told, and every document with a letter would be ``und``: then all stay.
    """
    model = language_id.train(docs, bounded=True)
    if not model["languages"]:
        return docs.select(*COLUMNS)
    found = language_id.identify(docs.select(*COLUMNS), model, fit=True)
    least = F.lit(float("-inf"))
    for language, bound in model["bounds"].items():
        least = F.when(F.col("lang_pred") == language, F.lit(bound)).otherwise(least)
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= 0.5) & (F.col("fit") >= least)).withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def remove_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes cross-site boilerplate lines out of the texts; documents stay, ``n_chars`` follows the text."""
    cut = line_dedup.remove_boilerplate(docs.select(*COLUMNS))
    return cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 80 % of their five-word shingles, the one with the smallest id stays."""
    found = minhash.near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias("_id")).distinct()
    dropped, seen = measured_write(found, "near-duplicates", rows=F.count(F.lit(1)))
    return docs.select(*COLUMNS).join(sized(dropped, seen["rows"]), F.col("doc_id") == F.col("_id"), "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out whole documents so that every source comes to its budget of words.

    A document stands as often as the mix takes it; the one at a source's cut stands once more if at least half of it
    falls inside, so a source differs from its budget by less than one document. Documents without words stay once.
    Rows that share an id are repeated alike.
    """
    taken = mixing.mix(docs).groupBy(F.col("doc_id").alias("_id")).agg(F.sum("taken").alias("_taken"), F.sum("size").alias("_size"))
    copies = F.when(F.col("_size") == 0, F.lit(1)).otherwise(F.floor(F.col("_taken") / F.col("_size") + 0.5)).cast("int")
    joined = docs.select(*COLUMNS).join(taken.select("_id", copies.alias("_copies")), F.col("doc_id").eqNullSafe(F.col("_id"))).where(F.col("_copies") > 0)
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*COLUMNS)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048, each filled with the lexical neighbours of its first document."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", remove_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage reads what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_through(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


ORACLE_SQL = None  # packing is not expressible in SQL
