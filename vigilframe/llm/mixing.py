"""Mixing sources to target weights.

Words are summed per source, targets follow from the weights, and every document is taken
floor(rate) times plus once more with the probability of the remaining fraction, drawn
from a hash of its id. Nothing but DataFrame expressions runs here.

Edge cases: a null text has no words; a null source is a source of its own, after all
others; a source without words has target and rate 0; rows with one id share their draw;
an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vigilframe.llm.common import WORD
from vigilframe.session import settle

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(key: Column, seed: str) -> Column:
    """A number in [0, 1) from the first 52 bits of MD5 of seed and key."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def source_targets(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size, target: words that the mix should take of every source.

    Filling by weight with a ceiling has a closed form. In order of ceiling / weight, a
    source reaches its ceiling exactly if its part of what the sources before it left
    over is no smaller. The two windows run over one row per source, never over documents.
    """
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = sizes.select(
        "source", "source_size",
        (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1).alias("nth"),
    ).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("nth") % len(weights) + 1).cast("double"))
    ranked = ranked.withColumn("ceiling", F.col("source_size") * F.lit(most))
    before = Window.orderBy(F.col("ceiling") / F.col("weight"), "nth").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    filled = ranked.select(
        "*",
        F.coalesce(F.sum("ceiling").over(before), F.lit(0.0)).alias("ceilings_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0.0)).alias("weights_before"),
        (F.sum("source_size").over(whole) * F.lit(share)).alias("wanted"),
        F.sum("weight").over(whole).alias("weights"),
    )
    filled = filled.withColumn("full", F.col("ceiling") * (F.col("weights") - F.col("weights_before"))
                               <= F.col("weight") * (F.col("wanted") - F.col("ceilings_before")))
    rest = F.col("wanted") - F.sum(F.when(F.col("full"), F.col("ceiling")).otherwise(0.0)).over(whole)
    open_ = F.col("weights") - F.sum(F.when(F.col("full"), F.col("weight")).otherwise(0.0)).over(whole)
    return filled.withColumn("rest", rest).withColumn("open", open_).select(
        "source", "source_size",
        F.when(F.col("full"), F.col("ceiling")).otherwise(F.col("weight") * F.col("rest") / F.col("open")).alias("target"),
    )


def with_copies(docs: DataFrame, seed: str = "mix", **kw) -> DataFrame:
    """``docs`` with _mix_size, _mix_source_size, _mix_target and _mix_copies, how often the mix takes the row."""
    sized = docs.withColumn("_mix_size", words_in(F.col("text")))
    targets = settle(source_targets(sized.select("source", F.col("_mix_size").alias("size")), **kw), "targets").select(
        F.col("source").alias("_mix_of"), F.col("source_size").alias("_mix_source_size"), F.col("target").alias("_mix_target"))
    rate = F.when(F.col("_mix_source_size") > 0, F.col("_mix_target") / F.col("_mix_source_size")).otherwise(0.0)
    more = draw(F.col("doc_id"), seed) < rate - F.floor(rate)
    return (
        sized.join(targets, F.col("source").eqNullSafe(F.col("_mix_of"))).drop("_mix_of")
        .withColumn("_mix_copies", F.floor(rate) + more.cast("long"))
    )


def mix(docs: DataFrame, seed: str = "mix", **kw) -> DataFrame:
    """The mixed rows themselves, with the columns of ``docs``."""
    taken = with_copies(docs, seed, **kw)
    copies = F.explode(F.array_repeat(F.lit(1), F.col("_mix_copies").cast("int")))
    return taken.withColumn("_mix_copy", copies).select(*docs.columns)
