"""Latest row per key, and keyed upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order.

    ``row_number() = 1`` makes Spark keep one row per key in every map task before
    the shuffle (WindowGroupLimit), so a key that holds a large part of the table
    sends one row per task instead of all of them.
    """
    ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", ranked).filter("_rank = 1").drop("_rank")


def newest_first(df: DataFrame) -> list[Column]:
    """Order of versions of one event: ingest time, then file, then content.

    All events of one file share an ingest time; the content hash makes the choice
    the same on every run.
    """
    content = [c for c in df.columns if c not in ("_ingested_at", "_source_file")]
    return [F.desc("_ingested_at"), F.desc("_source_file"), F.desc(F.xxhash64(*content))]


def dedup_events(df: DataFrame) -> DataFrame:
    return latest_per_key(df, ["event_id"], newest_first(df))


def newer_than(df: DataFrame, target: DataFrame, column: str = "_ingested_at") -> DataFrame:
    """Rows strictly newer than everything in ``target`` (all rows if it is empty).

    The maximum is an uncorrelated scalar subquery: one value, computed once.
    """
    high = target.agg(F.max(column).alias("high")).scalar()
    return df.filter(high.isNull() | (F.col(column) > high))


def same_keys(target: DataFrame, keys: list[str]) -> Column:
    """Whether a target row has the key in ``_key_0``, ``_key_1`` ...; NULL equals NULL."""
    condition = F.lit(True)
    for i, key in enumerate(keys):
        condition = condition & target[key].eqNullSafe(F.col(f"_key_{i}"))
    return condition


def merge_upsert(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``batch`` replace rows of ``target`` with the same key, NULL included.

    ``batch`` must hold each key once (see ``latest_per_key``). Only the key columns
    of the batch take part in the anti join, so a small batch is broadcast by AQE and
    the target is not shuffled.
    """
    held = batch.select(*(F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)))
    return target.join(held, same_keys(target, keys), "left_anti").unionByName(batch, allowMissingColumns=True)
