"""The standing checks of every layer."""

from __future__ import annotations

from pyspark.sql import DataFrame

from vigilframe.operators import quality as dq
from vigilframe.sources import contracts as c

_SILVER_REQUIRED = [f.name for f in c.SILVER if not f.nullable]


def silver_checks(silver: DataFrame) -> DataFrame:
    """Two passes: one for everything a row shows by itself, one for repeated ids."""
    name = "silver.silver_events"
    rows = (
        dq.not_null(_SILVER_REQUIRED)
        + dq.accepted_values({"event_type": c.EVENT_TYPES, "severity": c.SEVERITIES})
        + dq.in_range({"severity_rank": (1, 4)})
    )
    return dq.report(
        dq.unique(silver, name, "event_id"), dq.row_checks(silver, name, rows), dq.conforms(silver, name, c.SILVER)
    )


def kpi_checks(kpis: DataFrame) -> DataFrame:
    rows = dq.not_null(["total_attacks", "failed_login_rate"]) + dq.in_range(
        {"failed_login_rate": (0.0, 1.0), "sla_compliance": (0.0, 1.0)}
    )
    return dq.row_checks(kpis, "gold.kpi_summary", rows)


def gold_checks(by_day: DataFrame, by_country: DataFrame, hourly: DataFrame, silver: DataFrame) -> DataFrame:
    day, country, hour = "gold.attack_volume_by_day", "gold.attack_volume_by_country", "gold.hourly_event_summary"
    return dq.report(
        dq.unique(by_day, day, "event_date"),
        dq.row_checks(by_day, day, dq.not_null(by_day.columns)),
        dq.unique(by_country, country, "country"),
        dq.row_checks(by_country, country, dq.not_null(by_country.columns)),
        dq.row_checks(hourly, hour, dq.not_null(hourly.columns)),
        dq.relationship(by_country, country, "country", silver, "country"),
        dq.relationship(hourly, hour, "event_type", silver, "event_type"),
    )


def dq_report(silver: DataFrame, gold: dict[str, DataFrame]) -> DataFrame:
    """All standing checks; ``gold`` maps table names to tables."""
    return dq.report(
        silver_checks(silver),
        kpi_checks(gold["gold.kpi_summary"]),
        gold_checks(
            gold["gold.attack_volume_by_day"], gold["gold.attack_volume_by_country"],
            gold["gold.hourly_event_summary"], silver,
        ),
    )
