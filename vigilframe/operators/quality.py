"""Data-quality checks; each gives rows (check, table, column, failing_rows, passed)."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from vigilframe.sources.contracts import contract_violations

_RESULT = "check string, table string, column string, failing_rows bigint, passed boolean"


def _result(df: DataFrame, check: str | Column, table: str) -> DataFrame:
    """Label (column, failing_rows) rows."""
    return df.select(
        (check if isinstance(check, Column) else F.lit(check)).alias("check"),
        F.lit(table).alias("table"),
        F.col("column"),
        F.coalesce("failing_rows", F.lit(0)).cast("long").alias("failing_rows"),
        (F.coalesce("failing_rows", F.lit(0)) == 0).alias("passed"),
    )


def row_checks(df: DataFrame, table: str, checks: list[tuple[str, str, Column]]) -> DataFrame:
    """Count the rows for which each (check, column, condition) holds, all in one pass over ``df``."""
    names = [f"_{i}" for i in range(len(checks))]
    counted = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, (_, _, c) in zip(names, checks)])
    cells = F.array(*[
        F.struct(F.lit(check).alias("check"), F.lit(column).alias("column"), F.col(n).alias("failing_rows"))
        for n, (check, column, _) in zip(names, checks)
    ])
    return _result(counted.select(F.explode(cells).alias("c")).select("c.*"), F.col("check"), table)


def not_null(columns: list[str]) -> list[tuple[str, str, Column]]:
    return [("not_null", c, F.col(c).isNull()) for c in columns]


def accepted_values(allowed: dict[str, tuple]) -> list[tuple[str, str, Column]]:
    return [("accepted_values", c, ~F.col(c).isin(*v)) for c, v in allowed.items()]


def in_range(ranges: dict[str, tuple[float, float]]) -> list[tuple[str, str, Column]]:
    """NULL is not out of range."""
    return [("range", c, ~F.col(c).between(*r)) for c, r in ranges.items()]


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Number of values that occur more than once."""
    repeated = df.filter(F.col(column).isNotNull()).groupBy(column).count().filter("count > 1")
    return _result(repeated.agg(F.count("*").alias("failing_rows")).withColumn("column", F.lit(column)), "unique", table)


def relationship(child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose value does not occur in the parent."""
    known = parent.select(F.col(parent_column).alias(column)).distinct()
    orphans = child.filter(F.col(column).isNotNull()).join(known, column, "left_anti")
    return _result(orphans.agg(F.count("*").alias("failing_rows")).withColumn("column", F.lit(column)), "relationship", table)


def conforms(df: DataFrame, table: str, contract: T.StructType) -> DataFrame:
    """One row per schema problem, or one passing row; reads no data."""
    found = contract_violations(df, contract)
    rows = [(f"contract: {problem}", table, name, 1, False) for name, problem in found]
    return df.sparkSession.createDataFrame(rows or [("contract", table, "*", 0, True)], _RESULT)


# Minutes within which each layer has to be fresh.
FRESHNESS_MINUTES = {"bronze": 5, "silver": 10, "gold": 15, "anomaly": 20}


def freshness(layers: dict[str, tuple[DataFrame, str]], as_of: datetime) -> DataFrame:
    """Age of each layer's newest row at ``as_of`` against its limit.

    ``layers`` maps a layer to its table and time column.
    """
    now = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    rows = []
    for layer, (df, column) in layers.items():
        limit = FRESHNESS_MINUTES[layer]
        age = F.timestamp_diff("MICROSECOND", F.col("latest"), now) / F.lit(60_000_000.0)
        rows.append(
            df.agg(F.max(F.col(column).cast("timestamp_ntz")).alias("latest")).select(
                F.lit(layer).alias("layer"),
                "latest",
                F.round(age, 3).alias("age_minutes"),
                F.lit(limit).alias("limit_minutes"),
                F.coalesce(age <= limit, F.lit(False)).alias("fresh"),
            )
        )
    return reduce(DataFrame.unionByName, rows)


def anomaly_share(results: DataFrame, low: float = 1.0, high: float = 15.0) -> DataFrame:
    """Whether the flagged share of windows lies in the expected percentage."""
    share = results.agg((F.count_if("is_anomaly") / F.nullif(F.count("*"), F.lit(0)) * 100).alias("p"))
    outside = F.coalesce(~F.col("p").between(low, high), F.lit(True))
    return _result(
        share.select(F.lit("is_anomaly").alias("column"), outside.cast("long").alias("failing_rows")),
        "anomaly_share", "gold.anomaly_results",
    )


def slow_stages(runs: DataFrame) -> DataFrame:
    """Runs that noted a stage above the duration limit."""
    return runs.filter(F.col("slow_stages").isNotNull())


def report(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)
