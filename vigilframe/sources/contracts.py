"""Table contracts: column order, types, nullability, accepted values."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

# The event types, severities and lists the input format defines.
EVENT_TYPES = (
    "failed_login",
    "successful_login",
    "malware_alert",
    "privilege_escalation",
    "suspicious_ip_activity",
    "vpn_login",
    "account_lockout",
    "brute_force_attempt",
)
ATTACK_TYPES = (
    "malware_alert",
    "privilege_escalation",
    "suspicious_ip_activity",
    "brute_force_attempt",
)
SEVERITIES = ("low", "medium", "high", "critical")
REQUIRED_FIELDS = ("event_id", "event_time", "event_type")
WATCHLIST_COUNTRIES = ("KP", "IR", "SY")

# Category and attack flag of each event type.
EVENT_TYPE_CATEGORIES = (
    ("failed_login", "authentication", False),
    ("successful_login", "authentication", False),
    ("malware_alert", "threat", True),
    ("privilege_escalation", "threat", True),
    ("suspicious_ip_activity", "threat", True),
    ("vpn_login", "access", False),
    ("account_lockout", "authentication", False),
    ("brute_force_attempt", "threat", True),
)

FEATURES = (
    "total_event_count",
    "unique_src_ips",
    "unique_users",
    "failed_login_count",
    "failed_login_ratio",
    "attack_event_count",
    "avg_severity_rank",
    "critical_event_count",
    "unique_countries",
    "events_outside_business_hours_ratio",
)

# Types of the tables' columns.
STRING, INT, LONG = T.StringType(), T.IntegerType(), T.LongType()
FLOAT, DOUBLE, BOOL = T.FloatType(), T.DoubleType(), T.BooleanType()
TIME, DATE = T.TimestampNTZType(), T.DateType()

# Names, order, types and nullability of the fields below are the interface.

# The 14 fields of a raw record, in record order.
SOURCE_FIELDS = (
    "event_id", "event_time", "username", "src_ip", "destination_ip", "hostname",
    "event_type", "severity", "status", "country", "operating_system", "department",
    "detection_time", "resolution_time",
)

# Bronze keeps the text of every field (a bad time is rejected later, by Silver),
# so its three time fields are strings; nothing but the three required fields has
# been checked yet.
BRONZE = T.StructType([
    T.StructField("event_id", STRING, False),
    T.StructField("event_time", STRING, False),
    T.StructField("username", STRING, True),
    T.StructField("src_ip", STRING, True),
    T.StructField("destination_ip", STRING, True),
    T.StructField("hostname", STRING, True),
    T.StructField("event_type", STRING, False),
    T.StructField("severity", STRING, True),
    T.StructField("status", STRING, True),
    T.StructField("country", STRING, True),
    T.StructField("operating_system", STRING, True),
    T.StructField("department", STRING, True),
    T.StructField("detection_time", STRING, True),
    T.StructField("resolution_time", STRING, True),
    T.StructField("_ingested_at", TIME, False),
    T.StructField("_source_file", STRING, False),
    T.StructField("_batch_id", STRING, False),
])

DEAD_LETTER = T.StructType([
    T.StructField("event_id", STRING, True),
    T.StructField("raw_record", STRING, False),
    T.StructField("error_reason", STRING, False),
    T.StructField("rejected_at", TIME, False),
    T.StructField("_source_file", STRING, False),
    T.StructField("_batch_id", STRING, False),
])

SILVER = T.StructType([
    T.StructField("event_id", STRING, False),
    T.StructField("event_time", TIME, False),
    T.StructField("detection_time", TIME, True),
    T.StructField("resolution_time", TIME, True),
    T.StructField("username", STRING, False),
    T.StructField("src_ip", STRING, False),
    T.StructField("destination_ip", STRING, True),
    T.StructField("hostname", STRING, False),
    T.StructField("event_type", STRING, False),
    T.StructField("severity", STRING, False),
    T.StructField("severity_rank", INT, False),
    T.StructField("status", STRING, False),
    T.StructField("country", STRING, False),
    T.StructField("operating_system", STRING, False),
    T.StructField("department", STRING, False),
    T.StructField("hour_of_day", INT, False),
    T.StructField("day_of_week", INT, False),
    T.StructField("is_business_hours", BOOL, False),
    T.StructField("is_internal_ip", BOOL, False),
    T.StructField("is_attack_event", BOOL, False),
    T.StructField("_ingested_at", TIME, False),
    T.StructField("_source_file", STRING, False),
    T.StructField("_batch_id", STRING, False),
])

KPI_SUMMARY = T.StructType([
    T.StructField("total_attacks", LONG, False),
    T.StructField("failed_login_rate", FLOAT, True),
    T.StructField("avg_mttd_minutes", DOUBLE, True),
    T.StructField("avg_mttr_minutes", DOUBLE, True),
    T.StructField("sla_compliance", FLOAT, True),
    T.StructField("computed_at", TIME, False),
])
ATTACK_VOLUME_BY_DAY = T.StructType([
    T.StructField("event_date", DATE, False),
    T.StructField("attack_count", LONG, False),
    T.StructField("cumulative_attack_count", LONG, False),
])
ATTACK_VOLUME_BY_COUNTRY = T.StructType([
    T.StructField("country", STRING, False),
    T.StructField("attack_count", LONG, False),
    T.StructField("percentage_of_total", FLOAT, False),
])
HOURLY_EVENT_SUMMARY = T.StructType([
    T.StructField("event_hour", TIME, False),
    T.StructField("event_type", STRING, False),
    T.StructField("event_count", LONG, False),
    T.StructField("unique_ips", LONG, False),
    T.StructField("unique_users", LONG, False),
])
ANOMALY_RESULTS = T.StructType([
    T.StructField("window_start", TIME, False),
    T.StructField("window_end", TIME, False),
    T.StructField("anomaly_score", DOUBLE, False),
    T.StructField("is_anomaly", BOOL, False),
    T.StructField("top_contributing_feature", STRING, False),
    T.StructField("total_event_count", LONG, False),
    T.StructField("unique_src_ips", LONG, False),
    T.StructField("unique_users", LONG, False),
    T.StructField("failed_login_count", LONG, False),
    T.StructField("failed_login_ratio", FLOAT, False),
    T.StructField("attack_event_count", LONG, False),
    T.StructField("avg_severity_rank", DOUBLE, False),
    T.StructField("critical_event_count", LONG, False),
    T.StructField("unique_countries", LONG, False),
    T.StructField("events_outside_business_hours_ratio", FLOAT, False),
    T.StructField("model_version", STRING, False),
])
# The seven columns consumers are promised.
ANOMALY_VIEW = (
    "window_start", "window_end", "anomaly_score", "is_anomaly", "total_event_count",
    "top_contributing_feature", "model_version",
)
PIPELINE_RUNS = T.StructType([
    T.StructField("run_id", STRING, False),
    T.StructField("start_time", TIME, False),
    T.StructField("end_time", TIME, False),
    T.StructField("duration_seconds", DOUBLE, False),
    T.StructField("stages_completed", STRING, False),
    T.StructField("stages_failed", STRING, True),
    T.StructField("records_ingested", LONG, False),
    T.StructField("records_transformed", LONG, False),
    T.StructField("records_rejected", LONG, False),
    T.StructField("slow_stages", STRING, True),
])

TABLES = {
    "bronze.security_events": BRONZE,
    "bronze.dead_letter_events": DEAD_LETTER,
    "silver.silver_events": SILVER,
    "gold.kpi_summary": KPI_SUMMARY,
    "gold.attack_volume_by_day": ATTACK_VOLUME_BY_DAY,
    "gold.attack_volume_by_country": ATTACK_VOLUME_BY_COUNTRY,
    "gold.hourly_event_summary": HOURLY_EVENT_SUMMARY,
    "gold.anomaly_results": ANOMALY_RESULTS,
}


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Order and cast to the contract; a missing nullable column becomes NULL."""
    have = set(df.columns)
    missing = [f.name for f in contract if f.name not in have and not f.nullable]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in contract
        ]
    )


# Casts that never lose a value.
_WIDER = {
    "byte": {"short", "integer", "long", "float", "double"},
    "short": {"integer", "long", "float", "double"},
    "integer": {"long", "double"},
    "long": set(),
    "float": {"double"},
    "date": {"timestamp_ntz"},
}


def evolve(
    df: DataFrame,
    contract: T.StructType,
    renames: dict[str, str] | None = None,
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """Read rows written under an older contract as rows of ``contract``.

    Renames first, then drops; added columns read as NULL, order follows the new
    contract, and a changed type must be a widening of the old one. Nothing is
    rewritten: this is a projection over the old files.
    """
    for old, new in (renames or {}).items():
        df = df.withColumnRenamed(old, new)
    df = df.drop(*drop)
    for field in contract:
        if field.name in df.columns:
            was, now = df.schema[field.name].dataType, field.dataType
            if was != now and now.typeName() not in _WIDER.get(was.typeName(), set()):
                raise ValueError(
                    f"{field.name}: {was.simpleString()} to {now.simpleString()} is not a widening"
                )
    unknown = [c for c in df.columns if c not in contract.fieldNames()]
    if unknown:
        raise ValueError(f"columns not in the new contract (drop or rename them): {unknown}")
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in contract
        ]
    )


def contract_violations(df: DataFrame, contract: T.StructType) -> list[tuple[str, str]]:
    """(column, problem) pairs found in the schema alone; no job is run."""
    found = []
    actual = {f.name: f.dataType for f in df.schema}
    for field in contract:
        if field.name not in actual:
            found.append((field.name, "missing"))
        elif actual[field.name] != field.dataType:
            found.append(
                (field.name, f"is {actual[field.name].simpleString()}, expected {field.dataType.simpleString()}")
            )
    found += [(name, "not in contract") for name in actual if name not in contract.fieldNames()]
    expected_order = [f.name for f in contract if f.name in actual]
    if not found and [f.name for f in df.schema] != expected_order:
        found.append(("*", "column order differs"))
    return found
