"""Tables bucketed by key, in the session's catalog: a merge shuffles its batch, not the table.

A table is a view on its newest generation, which is a catalog table bucketed and sorted by the key. A
merge reads the generation bucket by bucket, deals the batch over the same buckets, keeps the newest version of each key, and
writes the next generation, one file per bucket; then the view moves on. The one before stays for
readers that have begun. Files, buckets and the switch are Spark's and the catalog's.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vigilframe.operators.dedup import latest_per_key
from vigilframe.session import work_path
from vigilframe.sources import files


def _generations(spark: SparkSession, name: str) -> list[int]:
    shown = spark.sql(f"SHOW TABLES LIKE '{name}_g*'").collect()
    return sorted(int(r["tableName"].rsplit("_g", 1)[1]) for r in shown if re.fullmatch(f"{name}_g[0-9]+", r["tableName"]))


def _write_next(rows: DataFrame, name: str, keys: list[str], buckets: int, path: str, number: int) -> None:
    spark = rows.sparkSession
    rows.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", f"{path}/g{number}").saveAsTable(f"{name}_g{number}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {name}_g{number}")
    for old in _generations(spark, name)[:-2]:
        spark.sql(f"DROP TABLE {name}_g{old}")
        files.remove(spark, f"{path}/g{old}")


def _location(spark: SparkSession, name: str, generation: int) -> str:
    shown = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}_g{generation}").collect()}
    return shown["Location"].rsplit("/", 1)[0]


def create(rows: DataFrame, name: str, keys: list[str], order: list[Column], buckets: int = 64, path: str | None = None) -> None:
    """A new bucketed table with the newest version of each key of ``rows``; NULL keys are equal.

    ``path`` is a folder that every executor reaches, below the session's shared one unless given.
    """
    spark = rows.sparkSession
    first = latest_per_key(rows.repartition(buckets, *keys), keys, order)
    _write_next(first, name, keys, buckets, path or work_path(spark, name), 0)


def merged(target: DataFrame, batch: DataFrame, keys: list[str], order: list[Column], buckets: int) -> DataFrame:
    """The newest version of each key of both; ``target`` is bucketed by the keys and isn't shuffled.

    The batch is reduced to one row per key in every map task before it is dealt out.
    """
    fresh = latest_per_key(batch.select(*target.columns), keys, order).repartition(buckets, *keys)
    return latest_per_key(target.unionAll(fresh), keys, order)


def merge(batch: DataFrame, name: str, keys: list[str], order: list[Column]) -> None:
    """Rows of ``batch`` into the table, where they are the newest of their key."""
    spark = batch.sparkSession
    last = _generations(spark, name)[-1]
    shown = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}_g{last}").collect()}
    buckets = int(shown["Num Buckets"])
    rows = merged(spark.table(f"{name}_g{last}"), batch, keys, order, buckets)
    _write_next(rows, name, keys, buckets, _location(spark, name, last), last + 1)


def drop(spark: SparkSession, name: str) -> None:
    """The view, its generations and their files."""
    spark.sql(f"DROP VIEW IF EXISTS {name}")
    for number in _generations(spark, name):
        path = f"{_location(spark, name, number)}/g{number}"
        spark.sql(f"DROP TABLE {name}_g{number}")
        files.remove(spark, path)
