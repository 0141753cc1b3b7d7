"""Streams in parts: what keyed state is asked for doesn't grow with the rows, and micro-batches have several files."""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark.sql import functions as F

from checks import queries
from tests.helpers import bronze
from vigilframe.streaming import exact


class Handle:
    """State of one key in memory, which counts the calls."""

    def __init__(self):
        self.value, self.values, self.calls, self.timers = None, [], 0, []

    def getValueState(self, name, schema):
        return self

    getListState = getValueState

    def registerTimer(self, at):
        self.timers.append(at)

    def get(self):
        self.calls += 1
        return self.value if self.value is not None else iter(self.values) if self.values else None

    def update(self, value):
        self.calls, self.value = self.calls + 1, value

    def exists(self):
        return bool(self.values)

    def appendValue(self, value):
        self.calls += 1
        self.values.append(value)

    def clear(self):
        self.value, self.values = None, []


class Timers:
    def __init__(self, watermark):
        self.watermark = watermark

    def getCurrentWatermarkInMs(self):
        return self.watermark


def part(**columns):
    return {"part": exact._bytes_of(pa.table(columns))}


def versions_of(n, day, ok=True):
    return part(
        event_id=[f"e{i}" for i in range(n)], _rank_at=pa.array([day] * n, pa.int64()), _rank_file=["f"] * n, _rank_content=list(range(n)),
        _ok=[ok] * n, _at=pa.array([1000] * n, pa.int64()))


def signs(out):
    rows = [r for x in out for r in exact._table_of(x["part"]).to_pylist()]
    return sorted((r["event_id"], r["_rank_at"], r["sign"]) for r in rows)


def test_versions_ask_the_state_twice_however_many_rows():
    handle, processor = Handle(), exact._Versions(10_000)
    processor.init(handle)
    first = signs(processor.handleInputRows((0,), [versions_of(300, 1), versions_of(400, 2), versions_of(2, 0)], Timers(0)))
    assert len(first) == 400 and {x[1:] for x in first} == {(2, 1)} and handle.calls == 2 and len(handle.timers) == 1
    second = signs(processor.handleInputRows((0,), [versions_of(3, 3, ok=False), versions_of(400, 1)], Timers(0)))
    assert second == [(f"e{i}", 2, -1) for i in range(3)] and handle.calls == 4


def test_bursts_write_once_a_micro_batch():
    handle, processor = Handle(), exact._Bursts(3, 10)
    processor.init(handle)
    for _ in range(2):
        rows = [part(src_ip=[ip] * 40, _t=list(range(40)), sign=[1] * 40) for ip in ("a", "b")]
        assert list(processor.handleInputRows((0, 0), rows, Timers(-1))) == []
    assert handle.calls == 2 and len(handle.timers) == 1
    found = exact._table_of(next(processor.handleExpiredTimer((0, 0), Timers(10**9), None))["part"]).to_pylist()
    assert [r["events_in_window"] for r in found if r["src_ip"] == "b"] == [2 * min(t + 1, 11) for t in range(1, 40)]


def test_parts_hold_all_rows_of_a_lot(spark):
    rows = spark.range(0, 5000, 1, 2).select((F.col("id") % 7).cast("int").alias("k"), F.col("id").cast("string").alias("v"))
    parts = exact._packed(rows, {"k": "int"}, lambda t: t)
    assert parts.count() == 14
    assert sorted(r.v for r in exact._unpacked(parts, "v string").collect()) == sorted(str(i) for i in range(5000))


def test_micro_batches_have_several_files(spark, monkeypatch):
    monkeypatch.setattr(queries, "_FILE_ROWS", 4)
    rows = bronze(spark, *[{"event_id": f"e{i}"} for i in range(12)], {"event_id": "none"})
    number = F.when(F.col("event_id") == "e0", 1).when(F.col("event_id") != "none", 3)
    path = {}
    monkeypatch.setattr(queries.stream, "stream_table", lambda spark, folder, schema, max_files: path.update(at=folder, files=max_files))
    queries._dealt(spark, "", 4, number, rows)
    found = [os.path.join(path["at"], n) for n in os.listdir(path["at"]) if n.endswith(".parquet")]
    found.sort(key=os.path.getmtime)
    assert path["files"] == 3 and len(found) == 12
    read = [sorted(r.event_id for r in spark.read.parquet(*found[i:i + 3]).collect()) for i in range(0, 12, 3)]
    assert read == [[], ["e0"], [], sorted(f"e{i}" for i in range(1, 12))]


def test_state_has_no_more_partitions_than_cores(spark, folder, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        for wanted, expected in ((None, spark.sparkContext.defaultParallelism), (3, 3)):
            signed = exact.versions(queries._dealt(spark, folder, 1, F.lit(0)), ["src_ip"])
            path, checkpoint = str(tmp_path / f"out-{wanted}"), str(tmp_path / f"check-{wanted}")
            queries.sinks.log_stream(signed, path, checkpoint, state_partitions=wanted).awaitTermination()
            assert len([n for n in os.listdir(f"{checkpoint}/state/0") if n.isdigit()]) == expected
            assert spark.read.parquet(path).count() > 0
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
