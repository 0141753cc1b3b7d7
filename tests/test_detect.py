from __future__ import annotations

import random
from collections import defaultdict
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import at, silver
from vigilframe.functions.events import from_micros, micros
from vigilframe.operators import detect
from vigilframe.operators.sweep import look_back


def logins(spark, times, ip="10.0.0.1", kind="failed_login"):
    return silver(spark, *[{"event_id": f"{ip}{i}", "event_time": at(t), "src_ip": ip, "event_type": kind} for i, t in enumerate(times)])


def test_micros_round_trip(spark):
    df = silver(spark, {"event_time": at(0.123456)})
    assert df.select(from_micros(micros(F.col("event_time")))).first()[0] == at(0.123456)


def test_burst_of_fifty(spark):
    df = logins(spark, [i * 6 for i in range(50)])  # 50 within 294 s
    assert [tuple(r) for r in detect.burst_moments(df).collect()] == [("10.0.0.1", at(294), 50)]
    assert detect.burst_moments(logins(spark, [i * 6 for i in range(49)])).count() == 0


def test_burst_window_is_closed(spark):
    assert detect.burst_moments(logins(spark, [0, 300]), threshold=2).count() == 1
    assert detect.burst_moments(logins(spark, [0, 300.000001]), threshold=2).count() == 0


def test_burst_sources(spark):
    df = logins(spark, [0, 1, 2, 900, 901]).union(logins(spark, [0], ip="10.0.0.2"))
    assert [tuple(r) for r in detect.burst_sources(df, threshold=2).collect()] == [("10.0.0.1", at(1), at(901), 3)]


def brute_bursts(events, threshold, seconds):
    by_ip = defaultdict(list)
    for ip, t in events:
        by_ip[ip].append(t)
    found = set()
    for ip, times in by_ip.items():
        for t in times:
            n = sum(t - seconds <= u <= t for u in times)
            if n >= threshold:
                found.add((ip, at(t), n))
    return found


def test_bursts_against_brute_force_with_a_hot_source(spark):
    rng = random.Random(1)
    events = [("10.0.0.1" if rng.random() < 0.5 else f"10.0.0.{rng.randrange(2, 9)}", rng.randrange(0, 4000)) for _ in range(400)]
    df = silver(spark, *[{"event_id": str(i), "event_time": at(t), "src_ip": ip} for i, (ip, t) in enumerate(events)])
    got = {tuple(r) for r in detect.burst_moments(df, threshold=4).collect()}
    assert got == brute_bursts(events, 4, 300) and got


@pytest.mark.parametrize("lo, hi", [(0, 50), (7, 60), (40, 45)])
def test_look_back(spark, lo, hi):
    rng = random.Random(hi)
    data = {(rng.choice("ab"), rng.randrange(0, 2000)): (rng.randrange(0, 4), rng.random() < 0.5) for _ in range(200)}
    df = spark.createDataFrame([(k, t, n, a) for (k, t), (n, a) in data.items()], "k string, _t long, _n long, _ask boolean")
    got = {(r["k"], r["_t"]): (r["live"], r["latest"]) for r in look_back(df, ["k"], lo, hi).collect()}
    assert set(got) == {kt for kt, (_, ask) in data.items() if ask}
    for (key, t), (live, latest) in got.items():
        near = {u: n for (k, u), (n, _) in data.items() if k == key and n and t - hi <= u <= t - lo}
        assert live == sum(near.values())
        assert not near or latest == max(near)


def chains(spark, events):
    return silver(spark, *[
        {"event_id": str(i), "event_time": at(t), "event_type": kind, "username": user, "src_ip": "10.1.1.1", "hostname": host}
        for i, (kind, user, host, t) in enumerate(events)
    ])


B, L = "brute_force_attempt", "account_lockout"


def test_lockout_bounds(spark):
    events = [(B, "u", "h", 0)] + [(L, "u", "h", t) for t in (59, 60, 299, 300)] + [(L, "other", "h", 100), (L, "u", "h2", 100)]
    got = detect.lockout_correlation(chains(spark, events)).orderBy("lockout_time").collect()
    assert [(r["lockout_id"], r["delay_seconds"], r["attempt_count"]) for r in got] == [("2", 60.0, 1), ("3", 299.0, 1)]


def test_lockouts_against_brute_force(spark):
    rng = random.Random(3)
    events = [(rng.choice([B, B, L]), "hot" if rng.random() < 0.6 else f"u{rng.randrange(5)}", "h", rng.randrange(0, 3000)) for _ in range(300)]
    got = {r["lockout_id"]: (r["last_attempt_time"], r["attempt_count"]) for r in detect.lockout_correlation(chains(spark, events)).collect()}
    want = {}
    for i, (kind, user, _, t) in enumerate(events):
        tries = [u for k, n, _, u in events if k == B and n == user and t - 299 <= u <= t - 60]
        if kind == L and tries:
            want[str(i)] = (at(max(tries)), len(tries))
    assert got == want and len(want) > 20


def test_null_keys_never_match(spark):
    df = silver(
        spark, {"event_id": "b", "event_type": B, "username": "x"}, {"event_id": "l", "event_type": L, "event_time": at(100), "username": "x"}
    ).withColumn("username", F.lit(None).cast("string"))
    assert detect.lockout_correlation(df).count() == 0


@pytest.mark.parametrize("seed", [4, 5])
def test_sessions_equal_session_window(spark, seed):
    rng = random.Random(seed)
    df = silver(spark, *[
        {"event_id": str(i), "event_time": at(rng.randrange(0, 20000)), "src_ip": rng.choice(["10.0.0.1", "10.0.0.1", "10.0.0.2"])}
        for i in range(200)
    ]).union(logins(spark, [50000, 50300, 50600.000001], ip="10.0.0.3"))  # exactly five minutes apart
    want = (
        df.groupBy("src_ip", F.session_window(F.col("event_time").cast("timestamp"), "5 minutes").alias("w"))
        .agg(F.count("*").alias("n")).select("src_ip", F.col("w.start").cast("timestamp_ntz"), F.col("w.end").cast("timestamp_ntz"), "n")
    )
    got = detect.failure_sessions(df)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_off_hours(spark):
    rows = [{"event_id": str(h), "event_type": "privilege_escalation", "event_time": at(0) + timedelta(hours=h),
             "is_business_hours": 9 <= (12 + h) % 24 <= 16} for h in range(24)]
    assert detect.off_hours_escalation(silver(spark, *rows)).first()["escalations"] == 16


def test_watchlist(spark):
    keep = {"country": "KP", "is_attack_event": True, "severity": "high", "event_type": "malware_alert"}
    df = silver(spark, {**keep}, {**keep, "event_id": "2", "country": "US"}, {**keep, "event_id": "3", "severity": "low"},
                {**keep, "event_id": "4", "is_attack_event": False})
    assert [r["event_id"] for r in detect.watchlist_events(df).collect()] == ["e1"]
    assert detect.watchlist_summary(df, ("US",)).first()["attack_count"] == 1
