"""Materialised daily and hourly rollups with mergeable distinct counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vigilframe.plans.cubes import CUBES, Measure

_GRAINS = {"hour": "1 hour", "day": "1 day"}
_SKETCHES = {"ips_sketch": "src_ip", "users_sketch": "username"}


def build_rollup(silver: DataFrame, grain: str = "day", dimensions: tuple[str, ...] = ()) -> DataFrame:
    """Counts and HyperLogLog sketches per period (and dimension), with the month for partitioning.

    Sketches are binary values of bounded size that merge; a stored distinct count would not.
    """
    start = F.window("event_time", _GRAINS[grain])["start"]
    return (
        silver.groupBy(start.alias("period"), *dimensions)
        .agg(
            F.count("*").alias("event_count"),
            F.count_if("is_attack_event").alias("attack_count"),
            F.count_if(F.col("event_type") == "failed_login").alias("failed_login_count"),
            *[F.hll_sketch_agg(column, 14).alias(name) for name, column in _SKETCHES.items()],
        )
        .withColumn("month", F.trunc("period", "month"))
    )


def write_rollup(silver: DataFrame, path: str, grain: str = "day", dimensions: tuple[str, ...] = ()) -> None:
    build_rollup(silver, grain, dimensions).write.mode("overwrite").partitionBy("month").parquet(path)


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def query_rollup(rollup: DataFrame, by: tuple[str, ...] = ("month",)) -> DataFrame:
    """Coarser totals from a rollup: exact counts, estimated distinct counts.

    Group by ``month``, ``period`` or any dimension of the rollup; no event is read.
    """
    return rollup.groupBy(*by).agg(
        F.sum("event_count").alias("event_count"),
        F.sum("attack_count").alias("attack_count"),
        F.sum("failed_login_count").alias("failed_login_count"),
        F.hll_sketch_estimate(F.hll_union_agg("ips_sketch")).alias("approx_unique_ips"),
        F.hll_sketch_estimate(F.hll_union_agg("users_sketch")).alias("approx_unique_users"),
    )


def _mergeable(measure: Measure) -> Column:
    if measure.kind == "countDistinct":
        return F.hll_sketch_agg(measure.column, 14)
    if measure.kind == "avg":
        return F.struct(F.sum(measure.column).alias("total"), F.count(measure.column).alias("n"))
    return measure.expression()


def pre_aggregate(table: DataFrame, cube: str, name: str, spec: dict | None = None) -> DataFrame:
    """The rollup a cube declares: one row per period with every measure of the cube.

    Counts, sums and maxima are stored as they are, an average as its sum and number, a
    distinct count as a sketch. A monthly partitioned rollup also gets its ``month``. ``spec`` (time, granularity,
    partition) describes a rollup that the cube doesn't declare.
    """
    spec = spec or CUBES[cube].pre_aggregations[name]
    time = F.col(CUBES[cube].dimensions[spec["time"]].column).cast("timestamp_ntz")
    stored = [_mergeable(m).alias(member) for member, m in CUBES[cube].measures.items()]
    rows = table.groupBy(F.window(time, _GRAINS[spec["granularity"]])["start"].alias("period")).agg(*stored)
    return rows.withColumn("month", F.trunc("period", "month")) if spec.get("partition") == "month" else rows


def query_pre_aggregate(rollup: DataFrame, cube: str, measures: list[str], granularity: str) -> DataFrame:
    """Measures of a cube per coarser period, from its rollup instead of its table.

    Averages come from stored sums and numbers; distinct counts are estimates (exact ones: ``plans.partials``).
    """
    values = []
    for member in measures:
        kind = CUBES[cube].measures[member].kind
        if kind in ("count", "sum"):
            values.append(F.sum(member).alias(member))
        elif kind in ("max", "number"):
            values.append(F.max(member).alias(member))
        elif kind == "avg":
            part = F.col(member)
            values.append((F.sum(part["total"]) / F.nullif(F.sum(part["n"]), F.lit(0))).alias(member))
        elif kind == "countDistinct":
            values.append(F.hll_sketch_estimate(F.hll_union_agg(member)).alias(member))
        else:
            raise ValueError(f"{cube}.{member} ({kind}) cannot be computed from a rollup")
    return rollup.groupBy(F.date_trunc(granularity, "period").cast("timestamp_ntz").alias("period")).agg(*values)
