from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.helpers import at, silver
from vigilframe.operators import quality as dq
from vigilframe.plans import gold, quality
from vigilframe.sources import contracts as c


def incident(i, resolved_after=None, **changes):
    """Detected after ten minutes, resolved ``resolved_after`` minutes later."""
    return {"event_id": str(i), "event_type": "malware_alert", "is_attack_event": True, "detection_time": at(600),
            "resolution_time": None if resolved_after is None else at(600 + resolved_after * 60), **changes}


def test_kpis(spark):
    df = silver(
        spark, incident(1, 240), incident(2, 240.001), incident(3), {"event_id": "4"}, {"event_id": "5"},
        {"event_id": "6", "event_type": "successful_login"},
        {"event_id": "7", "detection_time": at(1200), "resolution_time": at(1260)},  # a failed login may carry times too
    )
    row = gold.kpi_summary(df).first()
    assert row["total_attacks"] == 3
    assert row["failed_login_rate"] == 0.75
    assert row["avg_mttd_minutes"] == pytest.approx((10 * 3 + 20) / 4)
    assert row["sla_compliance"] == pytest.approx(2 / 3)
    assert isinstance(row["computed_at"], datetime)
    assert c.contract_violations(gold.kpi_summary(df), c.KPI_SUMMARY) == []


def test_kpis_of_nothing(spark):
    row = gold.kpi_summary(silver(spark, {}).filter("false")).first()
    assert row["total_attacks"] == 0 and row["failed_login_rate"] is None and row["sla_compliance"] is None


def test_running_total_and_share(spark):
    df = silver(spark, incident(1), incident(2, event_time=at(86400)), incident(3, event_time=at(86401), country="DE"), {"event_id": "4"})
    days = [tuple(r) for r in gold.attack_volume_by_day(df).orderBy("event_date").collect()]
    assert days == [(date(2024, 1, 15), 1, 1), (date(2024, 1, 16), 2, 3)]
    shares = {r["country"]: r["percentage_of_total"] for r in gold.attack_volume_by_country(df).collect()}
    assert shares == {"US": pytest.approx(2 / 3), "DE": pytest.approx(1 / 3)}
    for table, contract in ((gold.attack_volume_by_day(df), c.ATTACK_VOLUME_BY_DAY),
                            (gold.attack_volume_by_country(df), c.ATTACK_VOLUME_BY_COUNTRY),
                            (gold.hourly_event_summary(df), c.HOURLY_EVENT_SUMMARY)):
        assert c.contract_violations(table, contract) == []


def test_null_country_is_a_group(spark):
    df = silver(spark, incident(1)).withColumn("country", F.lit(None).cast("string"))
    assert [tuple(r) for r in gold.attack_volume_by_country(df).collect()] == [(None, 1, 1.0)]


def test_top_countries_ties(spark):
    by_country = spark.createDataFrame([(f"C{i:02d}", 1 if i else 5, 0.1) for i in range(12)], "country string, attack_count long, percentage_of_total float")
    assert [r["country"] for r in gold.top_countries(by_country).collect()] == [f"C{i:02d}" for i in range(10)]


def test_share_reuses_the_grouping(spark, folder):
    from checks.queries import silver as registered

    df = gold.attack_volume_by_country(registered(spark, folder))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan or "ReusedSubquery" in plan


def test_quality_of_bad_rows(spark):
    df = silver(spark, {}, {"severity": "HIGH", "severity_rank": 9, "username": "x"}).withColumn(
        "status", F.when(F.col("username") == "jo", F.col("status")))
    got = {(r["check"], r["column"]): r["failing_rows"] for r in quality.silver_checks(df).collect() if not r["passed"]}
    assert got == {("unique", "event_id"): 1, ("accepted_values", "severity"): 1, ("range", "severity_rank"): 1, ("not_null", "status"): 1}


def test_quality_of_kpis(spark):
    df = spark.createDataFrame([(1, 1.5, None)], "total_attacks long, failed_login_rate float, sla_compliance float")
    got = {(r["check"], r["column"]): r["passed"] for r in quality.kpi_checks(df).collect()}
    assert got[("range", "failed_login_rate")] is False and got[("range", "sla_compliance")] is True


def test_contract_check_and_relationship(spark):
    bad = silver(spark, {}).drop("country")
    assert [(r["check"], r["column"]) for r in dq.conforms(bad, "s", c.SILVER).collect()] == [("contract: missing", "country")]
    child = spark.createDataFrame([("US",), ("XX",), (None,)], "country string")
    assert dq.relationship(child, "t", "country", silver(spark, {}), "country").first()["failing_rows"] == 1


def test_freshness_limits(spark):
    df = silver(spark, {"event_time": at(0)})
    got = dq.freshness({"bronze": (df, "event_time"), "silver": (df, "event_time"), "gold": (df.filter("false"), "event_time")}, at(6 * 60))
    assert {r["layer"]: (r["age_minutes"], r["fresh"]) for r in got.collect()} == {
        "bronze": (6.0, False), "silver": (6.0, True), "gold": (None, False)}


def test_anomaly_share(spark):
    df = spark.range(100).select((F.col("id") < 5).alias("is_anomaly"))
    assert dq.anomaly_share(df).first()["passed"]
    assert not dq.anomaly_share(df.withColumn("is_anomaly", F.lit(True))).first()["passed"]
    assert not dq.anomaly_share(df.filter("false")).first()["passed"]
