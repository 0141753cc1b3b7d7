"""The most frequent values of any period, from daily sketches and an exact recount.

A day's sketch holds at most a fixed number of values. Sketches of the days of a period merge; the values
they name are candidates, and only these are counted again, so counts are exact. What a sketch may have missed has a bounded count: if the last value that is listed
is above it, the list is proved to be the right one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

TRACKED = 10_000
_LOAD, _ERROR = 0.75, 3.5
"""Fill of a sketch's map, and its error times its size over its weight: fixed values of the sketch."""


def top_sketches(rows: DataFrame, period: Column, value: str, tracked: int = TRACKED) -> DataFrame:
    """One sketch of the values per period, with the number of rows in it; NULLs are left out."""
    return rows.filter(F.col(value).isNotNull()).groupBy(period.alias("period")).agg(
        F.count("*").alias("n"), F.expr(f"approx_top_k_accumulate(`{value}`, {tracked})").alias("sketch"))


def error_share(tracked: int = TRACKED) -> float:
    """No estimate of a sketch is wrong by more than this share of its rows."""
    return _ERROR / (1 << max(3, (int(tracked / _LOAD) - 1).bit_length()))


def top_values(
    sketches: DataFrame, rows: DataFrame, period: Column, value: str, merged: Column, k: int = 10, tracked: int = TRACKED,
    candidates: int | None = None,
) -> DataFrame:
    """The ``k`` most frequent values per merged period with exact counts, ties in order of values.

    ``merged`` is the coarser period of a sketch's ``period``; ``period`` is that of a row
    in the same terms. ``is_complete`` says that no value outside can belong into the list.
    ``candidates`` (ten times ``k``) values per period are recounted.
    """
    wanted = candidates or min(10 * k, tracked)
    whole = sketches.groupBy(merged.alias("period")).agg(
        F.sum("n").alias("_n"), F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {tracked}), {wanted})").alias("_top"))
    error = F.col("_n") * error_share(tracked)
    last = F.array_min(F.transform("_top", lambda t: t["count"]))
    # A value that isn't named is estimated below the last one named; if all are named, below the error.
    missed = F.when(F.size("_top") < wanted, 2 * error).otherwise(F.greatest(last, error) + error)
    named = whole.select("period", missed.alias("_missed"), F.explode("_top").alias("t")).select("period", "_missed", F.col("t.item").alias(value))
    # As many rows as periods times candidates.
    counted = rows.withColumn("period", period).join(named, ["period", value]).groupBy("period", value, "_missed").agg(F.count("*").alias("count"))
    order = Window.partitionBy("period").orderBy(F.desc("count"), value)
    ranked = counted.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    least = F.min("count").over(Window.partitionBy("period"))
    return ranked.select("period", "rank", value, "count", (least > F.col("_missed")).alias("is_complete"))
