"""Hourly feature vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vigilframe.functions.events import distinct_count, ratio
from vigilframe.sources.contracts import FEATURES


def hourly_features(silver: DataFrame, fill_gaps: bool = False, approximate: bool = False) -> DataFrame:
    """Ten features per non-empty hour, in one aggregate.

    For the three distinct counts Spark expands every row to four inside its task, then combines
    there: what is shuffled is one row per (hour, value), so a busy hour is spread over its
    values. ``approximate`` estimates them instead, without expanding.
    """
    total = F.count("*")
    failed = F.count_if(F.col("event_type") == "failed_login")
    rows = (
        silver.groupBy(F.window("event_time", "1 hour").alias("w"))
        .agg(
            total.alias("total_event_count"),
            distinct_count("src_ip", approximate).alias("unique_src_ips"),
            distinct_count("username", approximate).alias("unique_users"),
            failed.alias("failed_login_count"),
            ratio(failed, total).alias("failed_login_ratio"),
            F.count_if("is_attack_event").alias("attack_event_count"),
            F.avg("severity_rank").alias("avg_severity_rank"),
            F.count_if(F.col("severity") == "critical").alias("critical_event_count"),
            distinct_count("country", approximate).alias("unique_countries"),
            ratio(F.count_if(~F.col("is_business_hours")), total).alias("events_outside_business_hours_ratio"),
        )
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *FEATURES)
    )
    if fill_gaps:
        rows = _with_empty_hours(rows)
    return rows.na.fill(0.0, list(FEATURES))


def _with_empty_hours(rows: DataFrame) -> DataFrame:
    """Zero rows for the hours without events between the first and the last window."""
    span = rows.agg(F.min("window_start").alias("a"), F.max("window_start").alias("b"))
    hours = span.filter("a IS NOT NULL").select(
        F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 HOUR"))).alias("window_start")
    )
    return hours.join(rows, "window_start", "left").select(
        "window_start",
        (F.col("window_start") + F.expr("INTERVAL 1 HOUR")).alias("window_end"),
        *[F.coalesce(F.col(c), F.lit(0)).cast(rows.schema[c].dataType).alias(c) for c in FEATURES],
    )


def check_feature_columns(df: DataFrame, windows: bool = True) -> None:
    """Schema check only; runs no job."""
    missing = sorted(set(FEATURES) - set(df.columns))
    if missing:
        raise ValueError(f"no column for the features {missing}")
    if windows:
        for name in ("window_start", "window_end"):
            if name not in df.columns:
                raise ValueError(f"no column {name}")


def validate_features(df: DataFrame, min_windows: int = 1) -> int:
    """Number of rows; raises when columns are missing, rows are absent or values are NULL or NaN."""
    check_feature_columns(df)
    bad = [F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))).alias(c) for c in FEATURES]
    found = df.agg(F.count("*").alias("_rows"), *bad).first()
    if found["_rows"] == 0:
        raise ValueError("there are no feature rows")
    with_nan = {c: found[c] for c in FEATURES if found[c]}
    if with_nan:
        raise ValueError(f"NULL or NaN in the features {with_nan}")
    if found["_rows"] < min_windows:
        raise ValueError(f"{found['_rows']} windows, at least {min_windows} are needed")
    return found["_rows"]
