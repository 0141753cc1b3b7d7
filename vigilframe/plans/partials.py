"""Rollups that answer every measure exactly: distinct counts, averages, ratios and deviations.

A stored average or distinct count can't be merged. What is stored here can: sums with their numbers,
means with their squared deviations (merged by the formula of Chan, Golub and LeVeque), and sets.
Coarser periods are computed from these rows alone; no event is read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from vigilframe.functions.events import micros, ratio
from vigilframe.operators.bitmaps import address_number, count_numbers, count_values, number_sets, value_sets
from vigilframe.plans.gold import SLA_MINUTES

_MINUTE = 60_000_000
MEASURED = {"rank": "severity_rank", "response": "response_minutes"}
"""Columns of which mean and deviation are stored."""


def _day() -> Column:
    return F.window("event_time", "1 day")["start"].alias("period")


def _between(start: str, end: str) -> Column:
    return micros(F.col(end)) - micros(F.col(start))


def build_partials(silver: DataFrame, dimensions: tuple[str, ...] = ()) -> DataFrame:
    """Counts, sums and deviations per day and dimensions, with the month for partitioning."""
    response = _between("detection_time", "resolution_time")
    rows = silver.withColumns({
        "_detect": _between("event_time", "detection_time"), "_respond": response, "response_minutes": response / float(_MINUTE)})
    moments = [c for name, column in MEASURED.items() for c in (
        F.count(column).alias(f"{name}_n"), F.coalesce(F.avg(column), F.lit(0.0)).alias(f"{name}_mean"),
        F.coalesce(F.var_pop(column) * F.count(column), F.lit(0.0)).alias(f"{name}_m2"))]
    total = lambda name: F.coalesce(F.sum(F.col(name).cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)")
    return rows.groupBy(_day(), *dimensions).agg(
        F.count("*").alias("event_count"), F.count_if("is_attack_event").alias("attack_count"),
        F.count_if(F.col("event_type") == "failed_login").alias("failed_login_count"),
        F.count_if(F.col("event_type") == "successful_login").alias("successful_login_count"),
        F.count_if(~F.col("is_business_hours")).alias("off_hours_count"),
        F.count("_detect").alias("detect_n"), total("_detect").alias("detect_sum"),
        F.count("_respond").alias("respond_n"), total("_respond").alias("respond_sum"),
        F.count_if(F.col("_respond") <= SLA_MINUTES * _MINUTE).alias("in_sla_n"), F.count("resolution_time").alias("resolved_n"),
        *moments).withColumn("month", F.trunc("period", "month"))


def coarser(grain: str) -> Column:
    """The day, week, month ... a stored day lies in."""
    return F.date_trunc(grain, "period").cast("timestamp_ntz").alias("period")


def query_partials(partials: DataFrame, grain: str, dimensions: tuple[str, ...] = ()) -> DataFrame:
    """KPIs per coarser period: counts, rates, averages."""
    sums = ["event_count", "attack_count", "failed_login_count", "successful_login_count", "off_hours_count",
            "detect_n", "detect_sum", "respond_n", "respond_sum", "in_sla_n", "resolved_n", "rank_n"]
    weighted = F.sum(F.col("rank_n") * F.col("rank_mean")).alias("_ranks")
    merged = partials.groupBy(coarser(grain), *dimensions).agg(*[F.sum(c).alias(c) for c in sums], weighted)
    minutes = lambda name: F.col(f"{name}_sum").cast("double") / F.nullif(F.col(f"{name}_n"), F.lit(0)) / _MINUTE
    return merged.select(
        "period", *dimensions, "event_count", "attack_count",
        ratio(F.col("failed_login_count"), F.col("failed_login_count") + F.col("successful_login_count")).alias("failed_login_rate"),
        minutes("detect").alias("avg_mttd_minutes"), minutes("respond").alias("avg_mttr_minutes"),
        ratio(F.col("in_sla_n"), F.col("resolved_n")).alias("sla_compliance"),
        (F.col("_ranks") / F.nullif(F.col("rank_n"), F.lit(0))).alias("avg_severity_rank"),
        ratio(F.col("off_hours_count"), F.col("event_count")).alias("off_hours_ratio"))


def merge_moments(partials: DataFrame, measured: str, grain: str, dimensions: tuple[str, ...] = ()) -> DataFrame:
    """Number, mean and sample deviation of a measured column per coarser period.

    The squared deviations of the parts and of their means from the common mean add up to
    those of the whole; no difference of large squares is taken.
    """
    n, mean, m2 = (F.col(f"{measured}_{x}") for x in ("n", "mean", "m2"))
    parts = partials.select(coarser(grain), *dimensions, n.alias("n"), mean.alias("mean"), m2.alias("m2")).filter("n > 0")
    whole = Window.partitionBy("period", *dimensions)
    common = F.sum(F.col("n") * F.col("mean")).over(whole) / F.sum("n").over(whole)
    return parts.withColumn("_mean", common).groupBy("period", *dimensions).agg(
        F.sum("n").alias("n"), F.first("_mean").alias("mean"),
        F.sum(F.col("m2") + F.col("n") * F.pow(F.col("mean") - F.col("_mean"), 2)).alias("_m2")
    ).select("period", *dimensions, "n", "mean", F.sqrt(F.col("_m2") / F.nullif(F.col("n") - 1, F.lit(0))).alias("deviation"))


def country_scores(partials: DataFrame, grain: str) -> DataFrame:
    """How far each country's attacks in a period lie from its mean over all periods with attacks, in deviations.

    ``partials`` have the country as a dimension. The window sees one row per country and period.
    """
    counts = partials.groupBy(coarser(grain), "country").agg(F.sum("attack_count").alias("attack_count")).filter("attack_count > 0")
    country = Window.partitionBy("country")
    mean, spread = F.avg("attack_count").over(country), F.stddev_samp("attack_count").over(country)
    score = (F.col("attack_count") - mean) / F.nullif(spread, F.lit(0.0))
    return counts.withColumn("z_score", F.round(F.coalesce(score, F.lit(0.0)), 6))


SETS = {"addresses": "src_ip", "users": "username", "countries": "country"}


def build_sets(silver: DataFrame, which: str, dimensions: tuple[str, ...] = ()) -> DataFrame:
    """The set of a column's values per day and dimensions, as ``SETS`` names it, with the month."""
    keys = [_day(), *[F.col(d) for d in dimensions]]
    if which == "addresses":
        rows = number_sets(silver, keys, address_number(F.col(SETS[which])))
    else:
        rows = value_sets(silver, keys, SETS[which])
    return rows.withColumn("month", F.trunc("period", "month"))


def count_sets(sets: DataFrame, which: str, grain: str, dimensions: tuple[str, ...] = ()) -> DataFrame:
    """Exact number of different values per coarser period: ``unique_addresses`` and so on."""
    keys = [coarser(grain), *[F.col(d) for d in dimensions]]
    return (count_numbers if which == "addresses" else count_values)(sets, keys, f"unique_{which}")


def write_by_month(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").partitionBy("month").parquet(path)


def read_by_month(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
