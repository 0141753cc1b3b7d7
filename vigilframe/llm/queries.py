"""The registered queries of this subpackage, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from vigilframe.llm import (
    chat, exact_dedup, langid, minhash, mixing, neighbours, packing, pages, pii, repair, repeats, toxicity, vectorcodes)
from vigilframe.llm.common import table


def op1_page_text(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract(table(spark, folder, "pages"))


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, folder, "documents")).drop("row")


def op3_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.with_copies(table(spark, folder, "documents").select("doc_id", "source", "text"))
    return mixed.select(
        "doc_id", F.col("_mix_size").alias("size"), F.col("_mix_source_size").alias("source_size"),
        F.col("_mix_target").alias("target"), (F.col("_mix_copies") * F.col("_mix_size")).alias("taken"))


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    found = langid.identify(docs, langid.fit(docs, ~held_out))
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op6_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_groups(table(spark, folder, "documents"))


def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pii.find(docs, pii.fit(docs))


def op8_repeated_strings(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, folder, "documents"))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = toxicity.fit(docs, table(spark, folder, "labels"), ~held_out)
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.report(repair.damage(table(spark, folder, "conversations")))


def op12_chat_examples(spark: SparkSession, folder: str) -> DataFrame:
    return chat.digest(chat.examples(chat.with_control_strings(table(spark, folder, "conversations"))))


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vectorcodes.compress(table(spark, folder, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_page_text": op1_page_text,
        "op2_exact_dedup": op2_exact_dedup,
        "op3_neighbours": op3_neighbours,
        "op4_source_mix": op4_source_mix,
        "op5_language_id": op5_language_id,
        "op6_near_dedup": op6_near_dedup,
        "op7_pii": op7_pii,
        "op8_repeated_strings": op8_repeated_strings,
        "op9_toxicity": op9_toxicity,
        "op10_packing": op10_packing,
        "op11_conversation_repair": op11_conversation_repair,
        "op12_chat_examples": op12_chat_examples,
        "op13_vector_codes": op13_vector_codes,
    }
