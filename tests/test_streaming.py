from __future__ import annotations

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import BASE, at, bronze, silver
from tests.test_ingest import bronze as read_bronze, dead as read_dead, record
from vigilframe.operators.detect import failure_sessions, lockout_correlation
from vigilframe.plans.ingest import ingest
from vigilframe.plans.silver import silver_events
from vigilframe.sources.contracts import BRONZE, SILVER
from vigilframe.sources.tables import read_table, scan, table_path
from vigilframe.streaming import sinks, sources, windows


@pytest.fixture
def out(tmp_path):
    return str(tmp_path / "out"), str(tmp_path / "checkpoint")


@pytest.fixture
def inbox(spark, tmp_path):
    """A folder of Parquet files that a stream reads one at a time, oldest first."""
    folder = str(tmp_path / "inbox")
    os.mkdir(folder)
    clock = iter(range(1_600_000_000, 1_700_000_000, 10))

    def put(df):
        part = f"{tmp_path}/part"
        df.coalesce(1).write.mode("overwrite").parquet(part)
        made = next(f for f in os.listdir(part) if f.endswith(".parquet"))
        when = next(clock)
        target = f"{folder}/{when}.parquet"
        os.rename(f"{part}/{made}", target)
        os.utime(target, (when, when))

    put.folder = folder
    return put


def events(spark, inbox, schema=SILVER):
    rows = sources.stream_table(spark, inbox.folder, schema, max_files=1)
    return rows.withColumn("ts", F.col("event_time").cast("timestamp")) if schema is SILVER else rows


def ingest_once(spark, folder, base, check):
    sinks.ingest_stream(sources.stream_lines(spark, str(folder)), base, check).awaitTermination()


def test_ingest_continues_where_it_stopped(spark, tmp_path):
    folder, base, check = tmp_path / "in", str(tmp_path / "base"), str(tmp_path / "check")
    folder.mkdir()
    (folder / "a.jsonl").write_text("\n".join([record(1), record(2), "broken", ""]))
    ingest_once(spark, folder, base, check)
    (folder / "b.jsonl").write_text("\n".join([record(3), '{"event_id":"x"}']))
    (folder / "skip.txt").write_text(record(9))
    ingest_once(spark, folder, base, check)
    ingest_once(spark, folder, base, check)
    got = {r["event_id"]: r["_batch_id"] for r in read_bronze(spark, base).collect()}
    assert set(got) == {"id-1", "id-2", "id-3"}
    assert [got[k].split("_")[2] for k in ("id-1", "id-3")] == ["001", "002"]
    assert len({x.split("_")[3] for x in got.values()}) == 1
    assert sorted(r["event_id"] for r in read_dead(spark, base).collect()) == ["unknown", "x"]


def lose_commit(check, number):
    for name in (f"{number}", f".{number}.crc"):
        os.remove(f"{check}/commits/{name}")


@pytest.mark.parametrize("far_off", [False, True])
def test_replayed_ingest_batch_writes_once(spark, tmp_path, far_off):
    """The tables were written but the stream's commit was lost; a file's time may lie in the future."""
    folder, base, check = tmp_path / "in", str(tmp_path / "base"), str(tmp_path / "check")
    folder.mkdir()
    (folder / "a.jsonl").write_text("\n".join([record(1), "broken"]))
    if far_off:
        os.utime(folder / "a.jsonl", (4_000_000_000, 4_000_000_000))
    ingest_once(spark, folder, base, check)
    lose_commit(check, 0)
    ingest_once(spark, folder, base, check)
    assert read_bronze(spark, base).count() == 1 and read_dead(spark, base).count() == 1


def test_an_append_that_was_cut_off_starts_over(spark, tmp_path, monkeypatch):
    folder, base, check = tmp_path / "in", str(tmp_path / "base"), str(tmp_path / "check")
    folder.mkdir()
    (folder / "a.jsonl").write_text("\n".join([*map(record, range(8)), "broken"]))
    with monkeypatch.context() as m:
        m.setattr(sinks, "append_dead_letters", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception, match="lost"):
            ingest_once(spark, folder, base, check)
    assert read_bronze(spark, base).count() == 8
    ingest_once(spark, folder, base, check)
    assert read_bronze(spark, base).count() == 8 and read_dead(spark, base).count() == 1


def test_streams_and_batch_runs_into_one_base_lose_nothing(spark, tmp_path):
    base = str(tmp_path / "base")
    for k in range(3):
        folder = tmp_path / f"in{k}"
        folder.mkdir()
        (folder / "a.jsonl").write_text("\n".join([record(10 * k + i) for i in range(k + 2)] + [f"broken {k}"]))
        if k == 0:
            ingest(spark, str(folder), base)
        else:
            ingest_once(spark, folder, base, str(tmp_path / f"check{k}"))
    assert read_bronze(spark, base).count() == 2 + 3 + 4 and read_dead(spark, base).count() == 3
    assert len({r["_batch_id"] for r in read_bronze(spark, base).collect()}) == 3


def test_an_older_version_that_comes_later_changes_nothing(spark, inbox, out):
    for day, name in ((2, "new"), (1, "old")):
        inbox(bronze(spark, {"event_id": "e", "username": name, "_ingested_at": at(86400 * day)}))
    sinks.silver_stream(events(spark, inbox, BRONZE), *out).awaitTermination()
    got = read_table(spark, table_path(out[0], "silver.silver_events"), SILVER).collect()
    assert [r["username"] for r in got] == ["new"]


def test_silver_stream_equals_batch(spark, inbox, out):
    rng = random.Random(1)
    everything = []
    for day in range(3):
        batch = bronze(spark, *[
            {"event_id": f"e{rng.randrange(40)}", "username": f"d{day}n{i}", "event_time": f"2024-01-{15 + rng.randrange(3)} 10:00:00",
             "_ingested_at": at(86400 * day + i)} for i in range(30)])
        everything.append(batch)
        inbox(batch)
    for _ in range(2):  # the second run finds nothing new
        sinks.silver_stream(events(spark, inbox, BRONZE), *out).awaitTermination()
    got = read_table(spark, table_path(out[0], "silver.silver_events"), SILVER)
    want = silver_events(everything[0].union(everything[1]).union(everything[2]))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("day_of", [None, "event_hour"])
def test_hourly_updates_accumulate(spark, inbox, out, day_of):
    inbox(silver(spark, {"event_time": at(0)}, {"event_time": at(10), "src_ip": "10.0.0.2"}))
    inbox(silver(spark, {"event_time": at(20), "username": "bo"}, {"event_time": at(3600)}))
    rows = windows.hourly_stream(events(spark, inbox))
    sinks.upsert_stream(rows, *out, ["event_hour", "event_type"], day_of).awaitTermination()
    got = scan(spark, out[0]).drop("day").orderBy("event_hour").collect()
    assert [tuple(r) for r in got] == [(at(0), "failed_login", 3, 2, 2), (at(3600), "failed_login", 1, 1, 1)]


def test_bursts(spark, inbox, out):
    inbox(silver(spark, *[{"event_time": at(i * 4)} for i in range(30)]))
    inbox(silver(spark, *[{"event_time": at(120 + i * 4)} for i in range(30)], {"event_time": at(150), "src_ip": "10.0.0.9"}))
    sinks.upsert_stream(windows.burst_stream(events(spark, inbox)), *out, ["src_ip", "window_start"]).awaitTermination()
    got = scan(spark, out[0])
    assert {r["src_ip"] for r in got.collect()} == {"10.0.0.1"}
    assert got.agg(F.max("failed_logins")).first()[0] == 60


def test_sessions_close_behind_the_watermark(spark, inbox, out):
    early = [0, 100, 399, 1000]
    inbox(silver(spark, *[{"event_time": at(t)} for t in early]))
    inbox(silver(spark, {"event_time": at(86400), "src_ip": "10.9.9.9"}))
    sinks.append_stream(windows.failure_session_stream(events(spark, inbox)), *out).awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(out[0]).collect()))
    batch = failure_sessions(silver(spark, *[{"event_time": at(t)} for t in early]))
    assert got == sorted(map(tuple, batch.collect())) and len(got) == 2


def test_lockouts_equal_batch(spark, inbox, out):
    rng = random.Random(2)
    rows = [{"event_id": str(i), "event_time": at(rng.randrange(0, 3000)), "username": f"u{rng.randrange(3)}",
             "event_type": rng.choice(["brute_force_attempt", "account_lockout"])} for i in range(120)]
    for part in (rows[:60], rows[60:]):
        inbox(silver(spark, *part))
    stream = windows.lockout_stream(events(spark, inbox), events(spark, inbox), delay="1 day")
    sinks.append_stream(stream, *out).awaitTermination()
    got = sorted(r["lockout_id"] for r in spark.read.parquet(out[0]).collect())
    want = sorted(r["lockout_id"] for r in lockout_correlation(silver(spark, *rows)).collect())
    assert got == want and len(got) > 10


def test_dedup_across_batches(spark, inbox, out):
    inbox(silver(spark, {"event_id": "a"}, {"event_id": "a"}, {"event_id": "b"}))
    inbox(silver(spark, {"event_id": "a", "event_time": at(60)}, {"event_id": "c"}))
    sinks.append_stream(windows.dedup_stream(events(spark, inbox)), *out).awaitTermination()
    assert sorted(r["event_id"] for r in spark.read.parquet(out[0]).collect()) == ["a", "b", "c"]


def test_late_rows(spark, inbox, out):
    inbox(silver(spark, {"event_id": "a", "event_time": at(10_000)}, {"event_id": "b", "event_time": at(0)}))
    inbox(silver(spark, {"event_id": "c", "event_time": at(6_401)}, {"event_id": "d", "event_time": at(6_399)}))
    inbox(silver(spark, {"event_id": "e", "event_time": at(20_000)}, {"event_id": "f", "event_time": at(6_400)}))
    sinks.split_late(events(spark, inbox).select("event_id", "ts"), *out).awaitTermination()
    ids = lambda name: sorted(r["event_id"] for r in spark.read.parquet(f"{out[0]}/{name}").collect())
    assert ids("on_time") == ["a", "b", "c", "e", "f"] and ids("late") == ["d"]


def test_feature_stream_matches_batch_counts(spark, inbox, out):
    from vigilframe.plans.features import hourly_features

    rows = [{"event_id": str(i), "event_time": at(i * 600), "src_ip": f"10.0.0.{i % 5}"} for i in range(30)]
    inbox(silver(spark, *rows[:17]))
    inbox(silver(spark, *rows[17:]))
    sinks.upsert_stream(windows.feature_stream(events(spark, inbox)), *out, ["window_start"]).awaitTermination()
    got = scan(spark, out[0])
    want = hourly_features(silver(spark, *rows))
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_lines_keep_their_file(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.jsonl").write_text(json.dumps({"event_id": "é"}))
    stream = sources.stream_lines(spark, str(folder))
    sinks.append_stream(stream, str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    row = spark.read.parquet(str(tmp_path / "o")).first()
    assert row["_source_file"].endswith("/a.jsonl") and row["_file_time"] is not None and BASE
