"""From raw documents to packed sequences: language ID, exact dedup, near dedup, mixing, packing.

Every stage works on all rows that the one before it kept. ``run`` writes each result below
the shared folder and reads it again as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vigilframe.llm import exact_dedup, langid, minhash, mixing, packing
from vigilframe.llm.common import table
from vigilframe.session import settle


def identify_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Rows whose language can be told. The automata learn from the same rows as in the query."""
    may_learn = F.crc32(F.col("doc_id").cast("string")) % 5 != 0
    return langid.keep_identified(docs, langid.fit(docs, may_learn))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One row of every group of equal texts."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of every group of near-duplicates."""
    return minhash.drop_near(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Rows as often as the mix takes them."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of all rows with their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("source mix", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None
"""Trained automata, shingle sets and a tokenizer can't be stated in SQL; tests compare every stage with brute force."""


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, folder), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, folder)
