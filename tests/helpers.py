"""Small hand-made tables."""

from __future__ import annotations

from datetime import datetime, timedelta

from vigilframe.sources.contracts import BRONZE, SILVER

BASE = datetime(2024, 1, 15, 12, 0, 0)


def at(seconds: float) -> datetime:
    return BASE + timedelta(seconds=seconds)


_BRONZE = {
    "event_id": "e1", "event_time": "2024-01-15T09:10:11Z", "username": "MKaya", "src_ip": "10.20.30.40",
    "destination_ip": None, "hostname": "lab-7", "event_type": "vpn_login", "severity": "medium",
    "status": "success", "country": "BR", "operating_system": "Fedora 40", "department": "Research",
    "detection_time": None, "resolution_time": None, "_ingested_at": datetime(2024, 1, 16), "_source_file": "day.jsonl",
    "_batch_id": "batch_20240117_001_0a1b2c3d",
}


def bronze(spark, *changes: dict):
    data = [tuple({**_BRONZE, **c}[f] for f in BRONZE.fieldNames()) for c in changes]
    schema = BRONZE
    for field in schema:
        field.nullable = True
    return spark.createDataFrame(data, schema)


_SILVER = {
    "event_id": "e1", "event_time": BASE, "detection_time": None, "resolution_time": None, "username": "jo",
    "src_ip": "10.0.0.1", "destination_ip": None, "hostname": "WS-1", "event_type": "failed_login", "severity": "low",
    "severity_rank": 1, "status": "failure", "country": "US", "operating_system": "RHEL 9", "department": "IT",
    "hour_of_day": 12, "day_of_week": 1, "is_business_hours": True, "is_internal_ip": True, "is_attack_event": False,
    "_ingested_at": datetime(2024, 1, 16), "_source_file": "a.jsonl", "_batch_id": "batch_20240116_001",
}


def silver(spark, *changes: dict):
    return spark.createDataFrame([tuple({**_SILVER, **c}[f] for f in SILVER.fieldNames()) for c in changes], SILVER)
