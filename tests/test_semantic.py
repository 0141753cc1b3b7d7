from __future__ import annotations

from datetime import date

import pytest

from tests.helpers import at, silver
from vigilframe.operators.filters import FilterSpec, apply_filters, date_bounds
from vigilframe.plans import gold, rollups
from vigilframe.plans.cubes import CUBES
from vigilframe.plans.semantic import cube_meta, semantic_query


@pytest.fixture
def tables(spark):
    df = silver(
        spark,
        {"event_id": "1"}, {"event_id": "2", "country": "KP", "severity": "high", "is_attack_event": True, "event_type": "malware_alert"},
        {"event_id": "3", "event_time": at(86400), "username": "bo"},
    )
    return {"silver.silver_events": df, "gold.kpi_summary": gold.kpi_summary(df), "gold.attack_volume_by_day": gold.attack_volume_by_day(df)}


def test_names_and_values(tables):
    row = semantic_query(tables, {"measures": ["KpiSummary.totalAttacks", "KpiSummary.failedLoginRate"]}).first()
    assert row.asDict() == {"KpiSummary.totalAttacks": 1, "KpiSummary.failedLoginRate": 1.0}


def test_filters_are_anded_and_grouped(tables):
    query = {
        "measures": ["SecurityEvents.count", "SecurityEvents.attackCount"],
        "dimensions": ["SecurityEvents.country"],
        "filters": [
            {"member": "SecurityEvents.severity", "operator": "equals", "values": ["high", "critical"]},
            {"member": "SecurityEvents.isAttackEvent", "operator": "equals", "values": ["true"]},
        ],
    }
    assert [tuple(r) for r in semantic_query(tables, query).collect()] == [("KP", 1, 1)]


def test_granularity_order_limit(tables):
    query = {
        "measures": ["SecurityEvents.count"],
        "timeDimensions": [{"dimension": "SecurityEvents.eventTime", "granularity": "day"}],
        "order": {"SecurityEvents.eventTime": "desc"}, "limit": 1,
    }
    assert semantic_query(tables, query).first()["SecurityEvents.count"] == 1
    query["order"] = [["SecurityEvents.count", "desc"]]
    assert semantic_query(tables, query).first()["SecurityEvents.count"] == 2


def test_dimensions_only(tables):
    got = semantic_query(tables, {"dimensions": ["SecurityEvents.username"]}).collect()
    assert sorted(r[0] for r in got) == ["bo", "jo"]


def test_unknown_members(tables):
    with pytest.raises(ValueError, match=(
        "KpiSummary.medianAge not found. Available measures: KpiSummary.totalAttacks, KpiSummary.failedLoginRate, "
        "KpiSummary.avgMttdMinutes, KpiSummary.avgMttrMinutes, KpiSummary.slaCompliance"
    )):
        semantic_query(tables, {"measures": ["KpiSummary.medianAge"]})
    with pytest.raises(ValueError, match="Available dimensions: KpiSummary.computedAt"):
        semantic_query(tables, {"dimensions": ["KpiSummary.x"]})
    with pytest.raises(ValueError, match="Available cubes: SecurityEvents"):
        semantic_query(tables, {"measures": ["Nope.count"]})
    with pytest.raises(ValueError, match="exactly one cube"):
        semantic_query(tables, {"measures": ["KpiSummary.totalAttacks", "SecurityEvents.count"]})
    with pytest.raises(ValueError, match="operator"):
        semantic_query(tables, {"measures": ["SecurityEvents.count"], "filters": [{"member": "SecurityEvents.country", "operator": "like", "values": ["x"]}]})
    with pytest.raises(ValueError, match="order by"):
        semantic_query(tables, {"measures": ["SecurityEvents.count"], "order": {"SecurityEvents.country": "asc"}})
    with pytest.raises(ValueError, match="granularity"):
        semantic_query(tables, {"measures": ["SecurityEvents.count"], "timeDimensions": [{"dimension": "SecurityEvents.eventTime", "granularity": "eon"}]})


def test_only_used_columns_and_filters_reach_the_scan(spark, tables, tmp_path):
    path = str(tmp_path / "s")
    tables["silver.silver_events"].write.parquet(path)
    query = {
        "measures": ["SecurityEvents.attackCount"], "dimensions": ["SecurityEvents.country"],
        "timeDimensions": [{"dimension": "SecurityEvents.eventTime", "dateRange": ["2024-01-15", "2024-01-15"]}],
        "filters": [{"member": "SecurityEvents.severity", "operator": "equals", "values": ["high"]}],
    }
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    df = semantic_query({"silver.silver_events": spark.read.parquet(path)}, query)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_time:timestamp_ntz,severity:string,country:string,is_attack_event:boolean>" in plan
    assert "GreaterThanOrEqual(event_time" in plan and "EqualTo(severity,high)" in plan


def test_meta(spark):
    got = cube_meta(spark)
    assert got.select("cube").distinct().count() == 6
    counts = {(r["cube"], r["member_kind"]): r["count"] for r in got.groupBy("cube", "member_kind").count().collect()}
    assert counts[("SecurityEvents", "dimension")] == 18 and counts[("SecurityEvents", "measure")] == 5
    assert set(CUBES) == {c for c, _ in counts}


def test_date_bounds():
    assert date_bounds("Last 7 days", date(2024, 1, 31)) == (date(2024, 1, 24), date(2024, 1, 31))
    assert date_bounds(["2024-01-01", "2024-01-31"]) == (date(2024, 1, 1), date(2024, 2, 1))
    assert date_bounds("2024-01-05") == (date(2024, 1, 5), date(2024, 1, 6))


def test_filter_spec(tables):
    df = tables["silver.silver_events"]
    assert apply_filters(df, FilterSpec()).count() == 3
    assert apply_filters(df, FilterSpec(countries=("KP",), months=(1,), weekdays=(1,), hours=(12,))).count() == 1
    assert apply_filters(df, FilterSpec(date_range=("2024-01-16", "2024-01-16"))).count() == 1


def test_rollup_by_dimension_merges(spark, tmp_path):
    df = silver(spark, *[{"event_id": str(i), "event_time": at(i * 7200), "src_ip": f"10.0.0.{i % 50}",
                          "country": "US" if i % 2 else "DE", "username": f"u{i % 9}"} for i in range(400)])
    path = str(tmp_path / "r")
    rollups.write_rollup(df, path, "day", ("country",))
    total = rollups.query_rollup(rollups.read_rollup(spark, path), ("country",)).orderBy("country").collect()
    assert [(r["country"], r["event_count"], r["approx_unique_ips"], r["approx_unique_users"]) for r in total] == [
        ("DE", 200, 25, 9), ("US", 200, 25, 9)]
    months = rollups.query_rollup(rollups.read_rollup(spark, path)).collect()
    assert sum(r["event_count"] for r in months) == 400
