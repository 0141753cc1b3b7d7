"""Streams whose results equal batch, over several micro-batches."""

from __future__ import annotations

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import BASE, at, bronze, silver
from tests.test_streaming import events, inbox, out  # noqa: F401
from vigilframe.operators.detect import burst_moments
from vigilframe.plans.features import hourly_features
from vigilframe.plans.gold import hourly_event_summary
from vigilframe.plans.silver import silver_events
from vigilframe.sources.contracts import BRONZE
from vigilframe.streaming import exact, sinks

YEAR = 365 * 86_400


def text(seconds: float) -> str:
    return at(seconds).isoformat()


def event(i, seconds, version=1, **more):
    return {"event_id": f"e{i}", "event_time": text(seconds), "_ingested_at": BASE + timedelta(days=version), **more}


def everything(spark, path):
    return spark.read.parquet(path)


def test_corrections_in_any_order(spark, inbox, out):  # noqa: F811
    first = [event(i, 60 * i, username=f"u{i % 3}", src_ip=f"10.0.0.{i % 4}") for i in range(12)]
    inbox(bronze(spark, *first, event(20, 0, 3, username="new")))
    inbox(bronze(
        spark, event(0, 0, 2, severity="unknown"), event(1, 4000, 2), event(2, 120, 0, username="older"), event(20, 0, 1, username="old"),
        event(3, 180, 2, src_ip="not an address"), event(3, 180, 3), event(4, 0, 2, event_time="no time")))
    inbox(bronze(spark, event(0, 0, 2, severity="unknown"), event(3, 180, 4, severity="HIGH"), *first[5:7]))
    rows = events(spark, inbox, BRONZE)
    names = ["username", "src_ip", "severity"]
    sinks.log_stream(exact.versions(rows, names, horizon=YEAR), *out).awaitTermination()
    left = everything(spark, out[0]).groupBy("event_id", "_t", *names).agg(F.sum("sign").alias("n")).filter("n <> 0")
    want = silver_events(spark.read.schema(BRONZE).parquet(inbox.folder))
    assert sorted((r.event_id, r.username, r.src_ip, r.n) for r in left.collect()) == sorted(
        (r.event_id, r.username, r.src_ip, 1) for r in want.collect())
    assert {r.event_id for r in left.collect()}.isdisjoint({"e0", "e3", "e4"})


def test_hourly_tables_equal_batch(spark, inbox, out):  # noqa: F811
    r = random.Random(1)
    kinds = ["failed_login", "vpn_login", "malware_alert"]
    for _ in range(3):
        inbox(bronze(spark, *[event(
            r.randrange(80), r.randrange(4 * 3600), r.randrange(4), username=r.choice(["a", "b", None]), country=r.choice(["US", "FR"]),
            src_ip=r.choice(["10.0.0.1", "10.0.0.2", "8.8.8.8", None]), event_type=r.choice(kinds), severity=r.choice(["low", "critical", "odd"]))
            for _ in range(60)]))
    done = silver_events(spark.read.schema(BRONZE).parquet(inbox.folder))
    signed = lambda: exact.versions(events(spark, inbox, BRONZE), exact.FEATURE_COLUMNS, horizon=YEAR)
    sinks.log_stream(exact.hourly_features(signed(), horizon=YEAR), *out).awaitTermination()
    got, want = sinks.newest_rows(spark, out[0], ["window_start"], "total_event_count"), hourly_features(done)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    path, check = (p + "-summary" for p in out)
    sinks.log_stream(exact.hourly_summary(signed(), horizon=YEAR, shards=1), path, check).awaitTermination()
    got, want = sinks.newest_rows(spark, path, ["event_hour", "event_type"], "event_count"), hourly_event_summary(done)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_rows_beyond_the_horizon_change_nothing(spark, inbox, out):  # noqa: F811
    day = 86_400
    inbox(bronze(spark, event(1, 0), event(2, 0)))
    inbox(bronze(spark, event(3, 30 * day)))
    inbox(bronze(spark, event(1, 0, 2, username="late"), event(4, 0), event(5, 29 * day)))
    sinks.log_stream(exact.versions(events(spark, inbox, BRONZE), ["username"], horizon=7 * day), *out).awaitTermination()
    signs = sorted((r.event_id, r.username, r.sign) for r in everything(spark, out[0]).collect())
    assert [s for s in signs if s[0] in ("e2", "e3", "e5")] == [(i, "mkaya", 1) for i in ("e2", "e3", "e5")]
    assert sum(s for i, _, s in signs if i == "e1") == 1 and [s for i, _, s in signs if i == "e4"] == [0]


def test_late_rows_come_after_the_watermark_closed_their_hour(spark, inbox, out):  # noqa: F811
    for batch in ([0, 100, 3000], [8000, 50, 7300], [3500, 3599, 3601, 9000, 8001], [7100, 7201, 20_000]):
        inbox(silver(spark, *[{"event_id": f"e{s}", "event_time": at(s)} for s in batch]))
    rows = events(spark, inbox).select("event_id", "ts")
    sinks.log_stream(exact.route_late(rows), *out, partition="is_late").awaitTermination()
    routed = {r.event_id: str(r.is_late) == "true" for r in everything(spark, out[0]).collect()}
    dropped = {k for k, late in routed.items() if late}
    assert len(routed) == 14 and dropped == {"e3500", "e3599"}


@pytest.mark.parametrize("threshold, minutes", [(3, 5)])
def test_bursts_are_found_at_their_moment(spark, inbox, out, threshold, minutes):  # noqa: F811
    r = random.Random(2)
    times = sorted(r.choice([r.randrange(7200), 1800 + r.randrange(300)]) for _ in range(160))
    batches = [times[:60], times[50:110] + [times[10]], times[110:]]
    rows = [{"event_id": f"e{b}-{i}", "event_time": at(s), "src_ip": r.choice(["10.0.0.1", "10.0.0.2"])} for b, part in enumerate(batches) for i, s in enumerate(part)]
    for b in range(3):
        inbox(silver(spark, *[x for x in rows if x["event_id"].startswith(f"e{b}-")]))
    inbox(silver(spark, {"event_id": "last", "event_time": at(100_000), "src_ip": "9.9.9.9"}))
    stream = events(spark, inbox)
    stream = exact._with_watermark(stream, F.col("ts"), "2 hours").select(
        "src_ip", "event_type", F.unix_micros("ts").alias("_t"), F.lit(1).alias("sign"))
    sinks.log_stream(exact.burst_moments(stream, threshold, minutes), *out).awaitTermination()
    got = sorted((x.src_ip, x.event_time, x.events_in_window) for x in everything(spark, out[0]).collect())
    want = sorted(map(tuple, burst_moments(silver(spark, *rows), threshold, minutes).collect()))
    assert got == want and len(got) > 20


def test_settings_of_the_session_come_back(spark):
    key = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
    before = spark.conf.get(key, None)
    with sinks._keyed_state(spark):
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key, None) == before
