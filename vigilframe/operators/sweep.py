"""What happened within a bounded time before a moment, without pairing rows up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def bucket_of(at: Column, width_us: int) -> Column:
    return F.floor(at / F.lit(width_us)).cast("long")


def look_back(moments: DataFrame, keys: list[str], min_us: int, max_us: int, groups: DataFrame | None = None) -> DataFrame:
    """For each asking moment: how many starts lie ``min_us`` to ``max_us`` before it, and the latest.

    ``moments`` holds each (keys, _t) once, with ``_n`` starts at that time and ``_ask``,
    whether its values are wanted. Returns (keys, _t, _n, live, latest) of the asking ones.

    A start counts from ``min_us`` after it until ``max_us`` after it, so the number at a
    moment is a running sum of +n and -n marks. Time is cut into buckets a little longer
    than ``max_us``, and a start is marked in every bucket (one or two) it can still count
    in; the running sum then needs one (keys, bucket) only. However many rows a key has,
    what a task sorts together is bounded by the clock. ``groups`` restricts the work to
    some (keys, _bucket).
    """
    width = max_us + 1
    begin, end = F.col("_t") + min_us, F.col("_t") + max_us
    first, last = bucket_of(begin, width), bucket_of(end, width)

    def mark(at: Column, change: Column, seen: Column, ask: bool) -> Column:
        return F.struct(
            at.alias("_at"), change.cast("long").alias("_d"), seen.cast("long").alias("_seen"), F.lit(ask).alias("_asks")
        )

    none = F.lit(None)
    starting = F.transform(
        F.sequence(first, last), lambda b: F.struct(b.alias("_bucket"), mark(begin, F.col("_n"), F.col("_t"), False).alias("m"))
    )
    stopping = F.array(F.struct(last.alias("_bucket"), mark(end + 1, -F.col("_n"), none, False).alias("m")))
    asking = F.array(F.struct(bucket_of(F.col("_t"), width).alias("_bucket"), mark(F.col("_t"), F.lit(0), none, True).alias("m")))
    nothing = F.filter(asking, lambda _: F.lit(False))
    marks = F.concat(
        F.when(F.col("_n") > 0, F.concat(starting, stopping)).otherwise(nothing),
        F.when(F.col("_ask"), asking).otherwise(nothing),
    )
    spread = moments.select(*keys, "_n", F.explode(marks).alias("e")).select(*keys, "_n", "e._bucket", "e.m.*")
    if groups is not None:
        spread = spread.join(groups, [*keys, "_bucket"], "left_semi")
    upto = (
        Window.partitionBy(*keys, "_bucket").orderBy("_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        spread.withColumns({"live": F.sum("_d").over(upto), "latest": F.max("_seen").over(upto)})
        .filter("_asks")
        .select(*keys, F.col("_at").alias("_t"), "_n", "live", "latest")
    )
