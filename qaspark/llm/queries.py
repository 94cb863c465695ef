"""The registered queries of this package, one per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qaspark.llm import (
    byte_bpe,
    class_model,
    collision_search,
    conversation_repair,
    impact_search,
    language_id,
    line_dedup,
    minhash,
    mixing,
    packing,
    passages,
    ranked_search,
    token_frames,
)
from qaspark.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/embeddings.parquet")


def _every_20th() -> Column:
    return F.col("id") % 20 == 0


def op1_collision_search(spark: SparkSession, folder: str) -> DataFrame:
    return collision_search.nearest(embeddings(spark, folder), _every_20th())


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text", "lang")
    held = F.coalesce(language_id.remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    model = language_id.train(docs.where(~held))
    return language_id.identify(docs.select("doc_id", "text", held.alias("held_out")), model).drop("text")


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.remove_boilerplate(documents(spark, folder).select("doc_id", "text", "source")).select("doc_id", "n_removed", "text")


def op4_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, folder).select("doc_id", "text"), n=4)


def op5_token_frames(spark: SparkSession, folder: str) -> DataFrame:
    files = token_frames.write_tokens(documents(spark, folder), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_frames.read_tokens(files).drop("ids")


def op6_impact_search(spark: SparkSession, folder: str) -> DataFrame:
    return impact_search.top_k(embeddings(spark, folder), _every_20th())


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"), end_id=1)


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(documents(spark, folder)).select("doc_id", "size", "source_size", "target", "taken")


def op9_passages(spark: SparkSession, folder: str) -> DataFrame:
    cut = passages.remove_passages(documents(spark, folder))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op10_class_model(spark: SparkSession, folder: str) -> DataFrame:
    return class_model.score_texts(documents(spark, folder), language_id.remainder(F.col("doc_id"), 5) == 1)


def op11_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.encode_texts(documents(spark, folder), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_repair.repair_conversations(spark.read.parquet(f"{folder}/conversations.parquet"))


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.rank_documents(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_collision_search": op1_collision_search,
    "op2_language_id": op2_language_id,
    "op3_line_dedup": op3_line_dedup,
    "op4_minhash": op4_minhash,
    "op5_token_frames": op5_token_frames,
    "op6_impact_search": op6_impact_search,
    "op7_packing": op7_packing,
    "op8_mixing": op8_mixing,
    "op9_passages": op9_passages,
    "op10_class_model": op10_class_model,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_ranked_search": op13_ranked_search,
}
