from __future__ import annotations

from datetime import datetime

from hypothesis import HealthCheck, given, settings, strategies as st

from tests.helpers import bronze
from vigilframe.operators.dedup import dedup_events
from vigilframe.plans.silver import incremental_silver, silver_events
from vigilframe.sources.contracts import ATTACK_TYPES, EVENT_TYPES, SEVERITIES, SILVER, contract_violations


def test_contract(spark):
    assert contract_violations(silver_events(bronze(spark, {})), SILVER) == []


def test_newest_version_wins(spark):
    df = bronze(spark, {"username": "old"}, {"username": "new", "_ingested_at": datetime(2024, 1, 17)})
    assert [r["username"] for r in silver_events(df).collect()] == ["new"]


def test_invalid_newest_version_removes_the_event(spark):
    df = bronze(spark, {}, {"src_ip": "bad", "_ingested_at": datetime(2024, 1, 17)})
    assert silver_events(df).count() == 0


def test_ties_do_not_depend_on_order_or_partitioning(spark):
    changes = [{"username": f"u{i}"} for i in range(20)]
    seen = set()
    for order in (changes, changes[::-1]):
        for parts in (1, 7):
            seen.add(dedup_events(bronze(spark, *order).repartition(parts)).first()["username"])
    assert len(seen) == 1


def test_severity_case(spark):
    df = bronze(spark, {"severity": "HIGH"})
    assert silver_events(df).count() == 0
    assert silver_events(df, normalize_case=True).first()["severity"] == "high"


def test_business_hours_and_weekday(spark):
    times = {"08:59:59": False, "09:00:00": True, "16:59:59": True, "17:00:00": False}
    df = bronze(spark, *[{"event_id": t, "event_time": f"2024-01-15 {t}"} for t in times])
    got = {r["event_id"]: r for r in silver_events(df).collect()}
    assert {k: r["is_business_hours"] for k, r in got.items()} == times
    assert all(r["day_of_week"] == 1 for r in got.values())  # a Monday
    assert silver_events(bronze(spark, {"event_time": "2024-01-21"})).first()["day_of_week"] == 7


def test_private_ranges(spark):
    expected = {
        "10.0.0.1": True, "172.15.0.1": False, "172.16.0.1": True, "172.31.255.1": True, "172.32.0.1": False,
        "192.168.0.1": True, "192.169.0.1": False, "11.0.0.1": False, "010.1.1.1": True,
    }
    df = bronze(spark, *[{"event_id": ip, "src_ip": ip} for ip in expected])
    assert {r["event_id"]: r["is_internal_ip"] for r in silver_events(df).collect()} == expected


octet = st.integers(0, 255)
event = st.fixed_dictionaries({
    "event_time": st.datetimes(datetime(2000, 1, 1), datetime(2040, 1, 1)).map(lambda d: d.isoformat()),
    "event_type": st.sampled_from(EVENT_TYPES),
    "severity": st.sampled_from(SEVERITIES),
    "src_ip": st.tuples(st.sampled_from([10, 172, 192, 8]), st.sampled_from([0, 15, 16, 31, 32, 168]), octet, octet).map(
        lambda o: ".".join(map(str, o))),
})


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(event, min_size=1, max_size=30))
def test_derived_fields(spark, events):
    df = bronze(spark, *[{**e, "event_id": str(i)} for i, e in enumerate(events)])
    got = {int(r["event_id"]): r for r in silver_events(df).collect()}
    assert len(got) == len(events)
    for i, e in enumerate(events):
        t, (a, b) = datetime.fromisoformat(e["event_time"]), map(int, e["src_ip"].split(".")[:2])
        r = got[i]
        assert r["event_time"] == t and r["hour_of_day"] == t.hour and r["day_of_week"] == t.isoweekday()
        assert r["is_business_hours"] == (9 <= t.hour <= 16)
        assert r["is_internal_ip"] == (a == 10 or (a == 172 and 16 <= b <= 31) or (a, b) == (192, 168))
        assert r["severity_rank"] == SEVERITIES.index(e["severity"]) + 1
        assert r["is_attack_event"] == (e["event_type"] in ATTACK_TYPES)


def test_incremental_is_strictly_newer(spark):
    first = silver_events(bronze(spark, {"event_id": "a"}))
    later = bronze(
        spark,
        {"event_id": "b"},  # same ingest time: not seen
        {"event_id": "a", "username": "changed", "_ingested_at": datetime(2024, 1, 17)},
        {"event_id": "c", "_ingested_at": datetime(2024, 1, 18)},
    )
    got = {r["event_id"]: r["username"] for r in incremental_silver(first, later).collect()}
    assert got == {"a": "changed", "c": "mkaya"}


def test_incremental_from_nothing(spark):
    empty = silver_events(bronze(spark, {})).filter("false")
    assert incremental_silver(empty, bronze(spark, {})).count() == 1


def test_hot_key_is_cut_before_the_shuffle(spark):
    plan = dedup_events(bronze(spark, {}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
