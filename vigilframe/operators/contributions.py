"""Which feature makes an anomalous row anomalous, by permutation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vigilframe.operators.forest import Scorer

_BITS = 10


def _hash_rank(rows: DataFrame, groups: list[str], number: str, out: str) -> DataFrame:
    """Position of each row by the 64-bit hash in ``number``, within its group.

    Hashes are spread evenly, so ranking within 1,024 ranges of the hash and adding the
    counts of the ranges below keeps every task small.
    """
    ranged = rows.withColumn("_range", F.shiftright(number, 64 - _BITS))
    counts = ranged.groupBy(*groups, "_range").agg(F.count("*").alias("_n"))
    below = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*groups, "_range", F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_below"))
    within = F.row_number().over(Window.partitionBy(*groups, "_range").orderBy(number, "_key"))
    return (
        ranged.join(offsets, [*groups, "_range"])
        .withColumn(out, F.col("_below") + within)
        .drop("_range", "_below")
    )


def feature_importances(
    anomalous: DataFrame, scorer: Scorer, key: str, score: str = "raw_score", seed: int = 42
) -> DataFrame:
    """(key, importances): the score gained when one feature is exchanged among the rows.

    Two hash orders of the rows, one for reading and one for writing, make a random
    permutation per feature. Rows with one feature exchanged are scored like any others.
    """
    columns = scorer.columns
    long = anomalous.select(
        F.col(key).alias("_key"),
        F.col(score).alias("_score"),
        F.array(*[F.col(c).cast("double") for c in columns]).alias("_values"),
    ).select(
        "_key", "_score", "_values", F.posexplode("_values").alias("_feature", "_value")
    )
    hashed = long.withColumn("_from", F.xxhash64(F.lit(seed), "_feature", F.lit("from"), "_key")).withColumn(
        "_to", F.xxhash64(F.lit(seed), "_feature", F.lit("to"), "_key")
    )
    readers = _hash_rank(hashed.select("_key", "_feature", "_score", "_values", "_from"), ["_feature"], "_from", "_rank")
    givers = _hash_rank(hashed.select("_key", "_feature", "_value", "_to"), ["_feature"], "_to", "_rank")
    exchanged = readers.join(givers.select("_feature", "_rank", "_value"), ["_feature", "_rank"])

    swapped = [
        F.when(F.col("_feature") == i, F.col("_value")).otherwise(F.col("_values")[i]) for i in range(len(columns))
    ]
    gains = exchanged.select("_key", "_feature", (scorer(*swapped) - F.col("_score")).alias("_gain"))
    # One value per feature and row: ten cells, turned into an array in feature order.
    cells = [F.max(F.when(F.col("_feature") == i, F.col("_gain"))) for i in range(len(columns))]
    return gains.groupBy(F.col("_key").alias(key)).agg(F.array(*cells).alias("importances"))


def top_feature(importances: Column, columns: list[str]) -> Column:
    """Name of the largest importance; the first wins a tie."""
    at = F.array_position(importances, F.array_max(importances)).cast("int")
    return F.element_at(F.array(*[F.lit(c) for c in columns]), at)


def top_features(importances: Column, columns: list[str], n: int = 3) -> Column:
    """Names of the ``n`` largest importances, largest first."""
    names = F.array(*[F.lit(c) for c in columns])
    pairs = F.transform(
        importances, lambda gain, i: F.struct((-gain).alias("g"), i.alias("i"))
    )
    return F.transform(F.slice(F.array_sort(pairs), 1, n), lambda p: F.element_at(names, p["i"] + 1))
