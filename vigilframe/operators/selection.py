"""Exact quantiles of columns with any number of different values, without sorting them.

``percentile`` keeps an entry per different value. Here a sketch with a guaranteed rank error
brackets the wanted ranks, the rows below and at the ends of the bracket are counted exactly, and what
lies inside, a thousandth or so of the rows, is bracketed again until it is small.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

ACCURACY = 4_000
"""Ranks of the sketch are wrong by at most one part in so many."""

SMALL = 20_000
"""So many rows are sorted and looked at."""


def values_at(rows: DataFrame, column: str, ranks: list[int], accuracy: int = ACCURACY, small: int = SMALL) -> list[float]:
    """The values at these ranks (from 0) of the sorted column, NULLs left out.

    Every round scans the column twice and leaves at most a fixed share of the rows, whatever
    their distribution and ties; only two ends and four counts per round reach the driver, and
    ``small`` values at the end.
    """
    values = rows.select(F.col(column).cast("double").alias("x")).filter("x IS NOT NULL")
    found: dict[int, float] = {}
    inside, before, n = values, 0, values.count()
    if any(not 0 <= r < n for r in ranks):
        raise ValueError(f"ranks must lie in 0 to {n - 1}")
    open_ranks = sorted(set(ranks))
    while open_ranks:
        if n <= small:
            left = [r["x"] for r in inside.orderBy("x").collect()]
            found |= {r: left[r - before] for r in open_ranks}
            break
        margin = 2 / accuracy
        ends = [max(0.0, (open_ranks[0] - before) / n - margin), min(1.0, (open_ranks[-1] - before + 1) / n + margin)]
        low, high = inside.agg(F.percentile_approx("x", ends, accuracy).alias("e")).first()["e"]
        below, at_low, at_high, above = inside.agg(
            F.count_if(F.col("x") < low), F.count_if(F.col("x") == low),
            F.count_if((F.col("x") == high) & (F.col("x") > low)), F.count_if(F.col("x") > high)).first()
        first_inside, first_high, first_above = before + below + at_low, before + n - above - at_high, before + n - above
        if open_ranks[0] < before + below or open_ranks[-1] >= first_above:
            raise ArithmeticError("the bracket misses a rank")
        found |= {r: low for r in open_ranks if r < first_inside}
        found |= {r: high for r in open_ranks if r >= first_high and r not in found}
        open_ranks = [r for r in open_ranks if r not in found]
        inside = inside.filter((F.col("x") > low) & (F.col("x") < high))
        before, n = first_inside, first_high - first_inside
    return [found[r] for r in ranks]


def exact_percentile(rows: DataFrame, column: str, share: float, **options) -> float | None:
    """What ``percentile`` gives: the value at ``share`` of the sorted column, between two ranks in proportion."""
    n = rows.filter(F.col(column).isNotNull()).count()
    if not n:
        return None
    position = (n - 1) * share
    low, high = math.floor(position), math.ceil(position)
    a, b = values_at(rows, column, [low, high], **options)
    return a if low == high or a == b else (high - position) * a + (position - low) * b
