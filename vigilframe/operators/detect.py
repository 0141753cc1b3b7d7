"""Detectors over Silver: bursts, off-hours escalation, watch-list, lockouts, sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from vigilframe.functions.events import from_micros, micros
from vigilframe.operators.sweep import bucket_of, look_back
from vigilframe.sources.contracts import WATCHLIST_COUNTRIES

_SECOND = 1_000_000


def burst_moments(
    silver: DataFrame,
    threshold: int = 50,
    minutes: int = 5,
    event_type: str = "failed_login",
) -> DataFrame:
    """Every moment at which a source has ``threshold`` or more events in the trailing window.

    One row per (src_ip, event_time). Counting per source and pair of neighbouring time
    buckets comes first: only where that reaches the threshold can a window reach it, so
    the events themselves are shuffled for those few groups alone.
    """
    window_us = minutes * 60 * _SECOND
    failures = silver.filter(F.col("event_type") == event_type).select(
        "src_ip", micros(F.col("event_time")).alias("_t")
    )
    own = bucket_of(F.col("_t"), window_us + 1)
    paired = failures.withColumn("_bucket", F.explode(F.array(own, own + 1)))
    busy = paired.groupBy("src_ip", "_bucket").agg(F.count("*").alias("_n")).filter(F.col("_n") >= threshold)
    busy = busy.select("src_ip", "_bucket")
    moments = (
        paired.join(busy, ["src_ip", "_bucket"], "left_semi")
        .groupBy("src_ip", "_t")
        .agg(F.countDistinct("_bucket").alias("_b"), F.count("*").alias("_all"))
        # An event kept through both of its buckets is still one event.
        .select("src_ip", "_t", F.expr("_all DIV _b").alias("_n"), F.lit(True).alias("_ask"))
    )
    return (
        look_back(moments, ["src_ip"], 0, window_us, busy)
        .filter(F.col("live") >= threshold)
        .select("src_ip", from_micros(F.col("_t")).alias("event_time"), F.col("live").alias("events_in_window"))
    )


def burst_sources(silver: DataFrame, threshold: int = 50, minutes: int = 5) -> DataFrame:
    """One row per source that burst: first and last such moment, highest count."""
    return (
        burst_moments(silver, threshold, minutes)
        .groupBy("src_ip")
        .agg(
            F.min("event_time").alias("first_burst"),
            F.max("event_time").alias("last_burst"),
            F.max("events_in_window").alias("peak_events"),
        )
    )


def off_hours_escalation(silver: DataFrame) -> DataFrame:
    """Privilege escalation outside 09:00 to 17:00, per user and source."""
    return (
        silver.filter((F.col("event_type") == "privilege_escalation") & ~F.col("is_business_hours"))
        .groupBy("username", "src_ip")
        .agg(
            F.count("*").alias("escalations"),
            F.max("severity_rank").alias("max_severity_rank"),
            F.min("event_time").alias("first_seen"),
            F.max("event_time").alias("last_seen"),
        )
    )


def watchlist_events(silver: DataFrame, countries: tuple[str, ...] = WATCHLIST_COUNTRIES) -> DataFrame:
    """High and critical attack events from the listed countries."""
    return silver.filter(
        F.col("is_attack_event")
        & F.col("country").isin(*countries)
        & F.col("severity").isin("high", "critical")
    )


def watchlist_summary(silver: DataFrame, countries: tuple[str, ...] = WATCHLIST_COUNTRIES) -> DataFrame:
    return (
        watchlist_events(silver, countries)
        .groupBy("country", "event_type", "severity")
        .agg(
            F.count("*").alias("attack_count"),
            F.countDistinct("src_ip").alias("unique_ips"),
            F.max("event_time").alias("last_seen"),
        )
    )


def lockout_correlation(
    silver: DataFrame, min_seconds: int = 60, max_seconds: int = 299
) -> DataFrame:
    """Lockouts that follow a brute-force attempt on the same user, source and host.

    One row per lockout, with the number of attempts between ``min_seconds`` and
    ``max_seconds`` before it and the latest of them. Attempts and lockouts are reduced to
    moments and swept in time order; they are never paired up.
    """
    keys = ["username", "src_ip", "hostname"]
    kinds = silver.filter(F.col("event_type").isin("brute_force_attempt", "account_lockout"))
    for key in keys:
        kinds = kinds.filter(F.col(key).isNotNull())
    kinds = kinds.withColumn("_t", micros(F.col("event_time")))
    moments = kinds.groupBy(*keys, "_t").agg(
        F.count_if(F.col("event_type") == "brute_force_attempt").alias("_n"),
        F.bool_or(F.col("event_type") == "account_lockout").alias("_ask"),
    )
    found = look_back(moments, keys, min_seconds * _SECOND, max_seconds * _SECOND).filter("live > 0")
    # Several lockouts may share one moment; each gets that moment's values back.
    return (
        kinds.filter("event_type = 'account_lockout'")
        .select("event_id", "event_time", *keys, "_t")
        .join(found.drop("_n"), [*keys, "_t"])
        .select(
            F.col("event_id").alias("lockout_id"), *keys,
            F.col("event_time").alias("lockout_time"),
            from_micros(F.col("latest")).alias("last_attempt_time"),
            ((F.col("_t") - F.col("latest")) / _SECOND).alias("delay_seconds"),
            F.col("live").alias("attempt_count"),
        )
    )


def failure_sessions(silver: DataFrame, gap_minutes: int = 5) -> DataFrame:
    """Runs of failed logins of one source with at most ``gap_minutes`` between neighbours.

    The result of ``session_window``, for sources of any size: failures of one source in
    one gap-wide time bucket always belong together, so they are first reduced to their
    first, last and number. What is chained per source is one row per bucket, bounded by
    the clock.
    """
    gap = gap_minutes * 60 * _SECOND
    failures = silver.filter("event_type = 'failed_login'").select("src_ip", micros(F.col("event_time")).alias("_t"))
    pieces = failures.groupBy("src_ip", bucket_of(F.col("_t"), gap).alias("_bucket")).agg(
        F.min("_t").alias("_first"), F.max("_t").alias("_last"), F.count("*").alias("_n")
    )
    in_time = Window.partitionBy("src_ip").orderBy("_bucket")
    previous = F.lag("_last").over(in_time)
    begins = F.when(previous.isNull() | (F.col("_first") - previous > gap), F.col("_first"))
    chained = pieces.withColumn("_begin", begins).withColumn("_start", F.max("_begin").over(in_time))
    return (
        chained.groupBy("src_ip", "_start")
        .agg(F.sum("_n").alias("failed_logins"), F.max("_last").alias("_end"))
        .select(
            "src_ip",
            from_micros(F.col("_start")).alias("session_start"),
            from_micros(F.col("_end") + gap).alias("session_end"),
            "failed_logins",
        )
    )
