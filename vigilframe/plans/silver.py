"""Silver: one clean, enriched row per event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vigilframe.functions import events as ev
from vigilframe.operators.dedup import dedup_events, merge_upsert, newer_than
from vigilframe.sources.contracts import BRONZE, SEVERITIES, SILVER


def staging_events(bronze: DataFrame) -> DataFrame:
    """The 17 Bronze columns in contract order."""
    return bronze.select(*BRONZE.fieldNames())


def accept(normalize_case: bool = False) -> Column:
    """Rows Silver keeps: readable time, IPv4-shaped source, known severity.

    Severity is compared as written ('HIGH' is rejected) unless ``normalize_case``.
    """
    severity = F.lower("severity") if normalize_case else F.col("severity")
    return (
        ev.parse_time(F.col("event_time")).isNotNull()
        & ev.looks_like_ipv4(F.col("src_ip"))
        & severity.isin(*SEVERITIES)
    )


def enrich(rows: DataFrame, *keep: str) -> DataFrame:
    """Cast the time, standardise case, add the seven derived columns; ``keep`` names further ones to keep."""
    timed = rows.withColumn("event_time", ev.parse_time(F.col("event_time")))
    ts, kind, ip = F.col("event_time"), F.col("event_type"), F.col("src_ip")
    derived = {
        "detection_time": _as_time(rows, "detection_time"),
        "resolution_time": _as_time(rows, "resolution_time"),
        "username": F.lower("username"),
        "hostname": F.upper("hostname"),
        "severity": F.lower("severity"),
        "severity_rank": ev.severity_rank(F.col("severity")),
        "hour_of_day": F.hour(ts),
        "day_of_week": ev.iso_weekday(ts),
        "is_business_hours": ev.in_business_hours(ts),
        "is_internal_ip": ev.is_rfc1918(ip),
        "is_attack_event": ev.is_attack(kind),
    }
    return timed.select(*[derived.get(n, F.col(n)).alias(n) for n in SILVER.fieldNames()], *keep)


def _as_time(rows: DataFrame, name: str) -> Column:
    """Bronze from JSON holds text; Bronze from a typed table holds timestamps."""
    kind = rows.schema[name].dataType.typeName()
    if kind == "string":
        return ev.parse_time(F.col(name))
    return F.col(name).cast("timestamp_ntz")


def silver_events(bronze: DataFrame, normalize_case: bool = False) -> DataFrame:
    """Deduplicate first, then validate, then enrich.

    If the newest version of an event is invalid the event is absent: older versions
    are not consulted.
    """
    return enrich(dedup_events(bronze).filter(accept(normalize_case)))


def incremental_silver(silver: DataFrame, bronze: DataFrame) -> DataFrame:
    """Silver after one incremental run: only Bronze rows newer than Silver are read."""
    fresh = silver_events(newer_than(bronze, silver))
    return merge_upsert(silver, fresh, ["event_id"])
