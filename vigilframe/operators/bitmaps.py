"""Exact distinct counts that merge: sets of addresses as bitmaps, sets of texts as rows.

A distinct count of a day can't be added to that of the next; a set can be united with it.
Addresses become numbers, of which 32,768 neighbours share a bitmap of 4 KB, so the addresses of a
network are a few rows however often they occur. Other values are kept as one row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_OCTET = 10 + 100 + 1000


def address_number(address: Column) -> Column:
    """A number for an address of four parts of one to three digits, NULL for any other text.

    Different texts have different numbers, also where they differ in leading zeros or parts go beyond 255, and addresses
    that differ in the last part are neighbours.
    """
    number = F.lit(0).cast("long")
    for i in range(1, 5):
        part = F.split_part(address, F.lit("."), F.lit(i))
        before = F.when(F.length(part) == 1, 0).when(F.length(part) == 2, 10).otherwise(110)
        number = number * _OCTET + before + part.try_cast("long")
    return F.when(address.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}\z"), number)


def number_sets(rows: DataFrame, keys: list[Column], number: Column) -> DataFrame:
    """One bitmap per keys and block of 32,768 numbers; NULLs are left out."""
    numbered = rows.select(*keys, number.alias("_n")).filter("_n IS NOT NULL")
    names = [c for c in numbered.columns if c != "_n"]
    return numbered.groupBy(*names, F.bitmap_bucket_number("_n").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_n")).alias("bits"))


def count_numbers(sets: DataFrame, keys: list[Column], name: str) -> DataFrame:
    """How many different numbers the united sets hold, per (coarser) keys."""
    kept = sets.select(*keys, "block", "bits")
    names = [c for c in kept.columns if c not in ("block", "bits")]
    united = kept.groupBy(*names, "block").agg(F.bitmap_or_agg("bits").alias("bits"))
    return united.groupBy(*names).agg(F.sum(F.bitmap_count("bits")).alias(name))


def value_sets(rows: DataFrame, keys: list[Column], value: str) -> DataFrame:
    """One row per keys and different value; NULLs are left out."""
    return rows.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("value")).distinct()


def count_values(sets: DataFrame, keys: list[Column], name: str) -> DataFrame:
    """How many different values the united sets hold, per (coarser) keys.

    Two steps, so that a busy key is spread over its values first.
    """
    kept = sets.select(*keys, "value").distinct()
    return kept.groupBy(*[c for c in kept.columns if c != "value"]).agg(F.count("*").alias(name))
