"""The six cubes: named measures and dimensions over the tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Measure:
    kind: str  # count, countDistinct, sum, avg, max, number
    column: str | None = None
    where: str | None = None

    def expression(self) -> Column:
        if self.kind == "count":
            return F.count_if(F.expr(self.where)) if self.where else F.count("*")
        # "number" passes a value of a one-row group through.
        function = {
            "countDistinct": F.countDistinct, "sum": F.sum, "avg": F.avg, "max": F.max, "number": F.max,
        }[self.kind]
        return function(self.column)


@dataclass(frozen=True)
class Dimension:
    column: str
    kind: str  # string, number, boolean, time
    primary_key: bool = False


@dataclass(frozen=True)
class Cube:
    table: str
    measures: dict[str, Measure]
    dimensions: dict[str, Dimension]
    pre_aggregations: dict[str, dict] = field(default_factory=dict)


# Cubes, members, columns and kinds are the interface.
CUBES: dict[str, Cube] = {
    "SecurityEvents": Cube(
        "silver.silver_events",
        {
            "count": Measure("count"),
            "attackCount": Measure("count", where="is_attack_event = TRUE"),
            "failedLoginCount": Measure("count", where="event_type = 'failed_login'"),
            "uniqueIps": Measure("countDistinct", "src_ip"),
            "uniqueUsers": Measure("countDistinct", "username"),
        },
        {
            "eventId": Dimension("event_id", "string", primary_key=True),
            "eventTime": Dimension("event_time", "time"),
            "username": Dimension("username", "string"),
            "srcIp": Dimension("src_ip", "string"),
            "destinationIp": Dimension("destination_ip", "string"),
            "hostname": Dimension("hostname", "string"),
            "eventType": Dimension("event_type", "string"),
            "severity": Dimension("severity", "string"),
            "severityRank": Dimension("severity_rank", "number"),
            "status": Dimension("status", "string"),
            "country": Dimension("country", "string"),
            "operatingSystem": Dimension("operating_system", "string"),
            "department": Dimension("department", "string"),
            "hourOfDay": Dimension("hour_of_day", "number"),
            "dayOfWeek": Dimension("day_of_week", "number"),
            "isBusinessHours": Dimension("is_business_hours", "boolean"),
            "isInternalIp": Dimension("is_internal_ip", "boolean"),
            "isAttackEvent": Dimension("is_attack_event", "boolean"),
        },
        {"daily": {"time": "eventTime", "granularity": "day", "partition": "month"}},
    ),
    "KpiSummary": Cube(
        "gold.kpi_summary",
        {
            "totalAttacks": Measure("number", "total_attacks"),
            "failedLoginRate": Measure("number", "failed_login_rate"),
            "avgMttdMinutes": Measure("number", "avg_mttd_minutes"),
            "avgMttrMinutes": Measure("number", "avg_mttr_minutes"),
            "slaCompliance": Measure("number", "sla_compliance"),
        },
        {
            "computedAt": Dimension("computed_at", "time"),
        },
    ),
    "AttackVolumeByDay": Cube(
        "gold.attack_volume_by_day",
        {
            "attackCount": Measure("sum", "attack_count"),
            "cumulativeAttackCount": Measure("max", "cumulative_attack_count"),
        },
        {
            "eventDate": Dimension("event_date", "time"),
        },
        {"daily": {"time": "eventDate", "granularity": "day"}},
    ),
    "AttackVolumeByCountry": Cube(
        "gold.attack_volume_by_country",
        {
            "attackCount": Measure("sum", "attack_count"),
            "percentageOfTotal": Measure("number", "percentage_of_total"),
        },
        {
            "country": Dimension("country", "string"),
        },
    ),
    "HourlyEventSummary": Cube(
        "gold.hourly_event_summary",
        {
            "eventCount": Measure("sum", "event_count"),
            "uniqueIps": Measure("sum", "unique_ips"),
            "uniqueUsers": Measure("sum", "unique_users"),
        },
        {
            "eventHour": Dimension("event_hour", "time"),
            "eventType": Dimension("event_type", "string"),
        },
        {"hourly": {"time": "eventHour", "granularity": "hour"}},
    ),
    "AnomalyResults": Cube(
        "gold.anomaly_results",
        {
            "count": Measure("count"),
            "anomalyScore": Measure("avg", "anomaly_score"),
            "anomalyCount": Measure("count", where="is_anomaly = TRUE"),
            "totalEventCount": Measure("sum", "total_event_count"),
        },
        {
            "windowStart": Dimension("window_start", "time", primary_key=True),
            "windowEnd": Dimension("window_end", "time"),
            "isAnomaly": Dimension("is_anomaly", "boolean"),
            "topContributingFeature": Dimension("top_contributing_feature", "string"),
            "modelVersion": Dimension("model_version", "string"),
        },
    ),
}
