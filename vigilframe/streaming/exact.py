"""Stream results that equal the batch tables: corrections, exact distinct counts, late rows, burst moments.

Spark's own streaming aggregates count every version of an event and can't count distinct values.
The operators here keep what is needed in keyed state and pass signed rows on: a
newer version of an event first takes its predecessor out (sign -1) and then counts itself
(sign +1), in whatever order versions come and however they are spread over micro-batches.

State is bounded by event time: timers remove what lies more than ``horizon`` behind the watermark, and
rows that old, about which nothing is known any more, come out with sign 0. A busy key is
spread: versions of one id are reduced before they are shuffled, values of one hour dealt over ``shards``.

A call to keyed state costs as much as hundreds of rows. So rows travel in parts, Arrow tables of all rows
with one key in a lot of a task's input; the state of a key is one such table, read and written once per micro-batch.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor

from vigilframe.functions.events import from_micros, micros, ratio
from vigilframe.operators.sweep import bucket_of
from vigilframe.plans.silver import accept, enrich

# Processors travel to the workers whole, so these needn't have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HORIZON = 7 * 86_400
SHARDS = 16
BUCKETS = 256
LOT_ROWS, LOT_BYTES = 1 << 17, 32 << 20
"""Rows, and bytes of them, that a task reduces at once."""
_HOUR = 3_600_000_000
_DAY = 24 * _HOUR


def _with_watermark(rows: DataFrame, at: Column, delay: str) -> DataFrame:
    """``rows`` with a watermark on ``at`` that drops nothing by itself.

    The watermark column is left out again: Spark filters late rows on that column before an
    operator sees them, but here late rows are the operator's to judge.
    """
    marked = rows.withColumn("_watermark", at).withWatermark("_watermark", delay)
    # A filter on the column keeps it in the plan.
    return marked.filter("_watermark IS NULL OR _watermark IS NOT NULL").drop("_watermark")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def _bytes_of(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _table_of(part: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(part)).read_all()


def _joined(parts: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(parts).combine_chunks()


def _lots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """A task's input in tables of bounded size."""
    held: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in batches:
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= LOT_ROWS or size >= LOT_BYTES:
            yield pa.Table.from_batches(held).combine_chunks()
            held, rows, size = [], 0, 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def _packed(rows: DataFrame, keys: dict[str, str], reduce: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """``keys`` (whole numbers) and ``part``: each lot, reduced, as one Arrow table per key."""
    names = list(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lot in _lots(batches):
            table = reduce(lot)
            if not table.num_rows:
                continue
            table = table.take(pc.sort_indices(table, sort_keys=[(k, "ascending") for k in names])).combine_chunks()
            held = [table[k].to_numpy() for k in names]
            starts = np.flatnonzero(np.concatenate([[True], np.any([k[1:] != k[:-1] for k in held], axis=0)]))
            rest = table.drop_columns(names)
            parts = [_bytes_of(rest.slice(a, b - a)) for a, b in zip(starts, [*starts[1:], table.num_rows])]
            first = [table[k].combine_chunks().take(pa.array(starts)) for k in names]
            yield pa.RecordBatch.from_arrays([*first, pa.array(parts, pa.binary())], [*names, "part"])

    return rows.mapInArrow(run, ", ".join(f"{k} {t}" for k, t in keys.items()) + ", part binary")


def _unpacked(parts: DataFrame, schema: str) -> DataFrame:
    """The rows of all parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.column(0):
                yield from _table_of(part.as_buffer()).to_batches(max_chunksize=LOT_ROWS)

    return parts.select("part").mapInArrow(run, schema)


def _summed(table: pa.Table, by: list[str], numbers: list[str]) -> pa.Table:
    """``numbers`` added up per ``by``, NULL a value like others; columns in the order of ``table``."""
    got = table.group_by(by, use_threads=False).aggregate([(n, "sum") for n in numbers])
    return got.rename_columns([c.removesuffix("_sum") if c not in by else c for c in got.column_names]).select(
        [c for c in table.column_names if c in {*by, *numbers}])


def _newest(rows: pa.Table) -> pa.Table:
    """The newest version of every id."""
    codes = pc.dictionary_encode(rows["event_id"].combine_chunks()).indices.to_numpy()
    several = np.bincount(codes)[codes] > 1 if len(codes) else np.zeros(0, bool)
    if not several.any():
        return rows
    again = rows.filter(pa.array(several))
    again = again.take(pc.sort_indices(again, sort_keys=[(c, "ascending") for c in ("event_id", *_RANK)])).combine_chunks()
    ids = again["event_id"].combine_chunks()
    last = np.append(pc.not_equal(ids[:-1], ids[1:]).to_numpy(zero_copy_only=False), True)
    return _joined([rows.filter(pa.array(~several)), again.filter(pa.array(last))])


_RANK = ("_rank_at", "_rank_file", "_rank_content")


def _no_newer(a: pa.Table, b: pa.Table) -> np.ndarray:
    """Whether each row of ``b`` is no newer a version than the row of ``a`` beside it."""
    done = np.zeros(a.num_rows, bool)
    tied = np.ones(a.num_rows, bool)
    for c in _RANK:
        done |= tied & pc.greater(a[c], b[c]).to_numpy()
        tied &= pc.equal(a[c], b[c]).to_numpy()
    return done | tied


class _Versions(StatefulProcessor):
    """Keeps the newest version of every id of a bucket and emits the signed changes.

    Rows have ``_rank_...``, by which versions are compared, ``_ok``, whether the version counts,
    and ``_at``, its time in milliseconds. Whatever is ``horizon_ms`` older than the watermark
    changes nothing any more; a sweep removes it from the state now and then.
    """

    def __init__(self, horizon_ms: int):
        self.horizon_ms = horizon_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getValueState("newest", "part binary")

    def _plan_sweep(self, watermark: int) -> None:
        self.handle.registerTimer(max(watermark, 0) + self.horizon_ms // 4 + 1)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        oldest = watermark - self.horizon_ms
        new = _newest(_joined([_table_of(row["part"]) for row in rows]))
        held = self.held.get()
        if held is None:
            self._plan_sweep(watermark)
        known = new.slice(0, 0) if held is None else _table_of(held[0])
        places = pc.fill_null(pc.index_in(new["event_id"].combine_chunks(), known["event_id"].combine_chunks()), -1).to_numpy()
        stale = places >= 0
        stale[stale] = _no_newer(known.take(pa.array(places[stale])), new.filter(pa.array(stale)))
        new, places = new.filter(pa.array(~stale)), places[~stale]
        lately = new["_at"].to_numpy() > oldest

        replaced = known.take(pa.array(places[places >= 0]))
        for rows, sign in ((replaced, -1), (new, 1)):
            rows = rows.filter(rows["_ok"])
            if rows.num_rows:
                signs = np.where(rows["_at"].to_numpy() > oldest, sign, 0).astype("i4")
                yield Row(part=_bytes_of(rows.append_column("sign", pa.array(signs))))
        if lately.any():
            stays = np.ones(known.num_rows, bool)
            stays[places[lately & (places >= 0)]] = False
            self.held.update((_bytes_of(_joined([known.filter(pa.array(stays)), new.filter(pa.array(lately))])),))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        held = self.held.get()
        if held is not None:
            rows = _table_of(held[0])
            rows = rows.filter(pc.greater(rows["_at"], watermark - self.horizon_ms))
            if rows.num_rows:
                self.held.update((_bytes_of(rows.combine_chunks()),))
                self._plan_sweep(watermark)
            else:
                self.held.clear()
        return iter([])

    def close(self) -> None:
        pass


def versions(
    bronze: DataFrame, columns: list[str], delay: str = "1 hour", horizon: int = HORIZON, buckets: int = BUCKETS
) -> DataFrame:
    """A stream of Bronze rows as signed Silver rows: ``event_id``, ``_t`` (event time in
    microseconds), ``columns`` and ``sign``.

    The sum of signs of an event is 1 if its newest version is valid, else 0, as in batch
    Silver. ``horizon`` is in seconds of event time. Ids are dealt over ``buckets`` by their hash; versions of
    one id are reduced to the newest before they are shuffled.
    """
    content = [c for c in bronze.columns if c not in ("_ingested_at", "_source_file")]
    rank = (
        F.coalesce(micros(F.col("_ingested_at")), F.lit(-(1 << 63))), F.coalesce("_source_file", F.lit("")), F.xxhash64(*content))
    extra = {**dict(zip(_RANK, rank)), "_ok": F.coalesce(accept(), F.lit(False))}
    rows = enrich(bronze.withColumns(extra), *extra)
    at = F.coalesce(F.col("event_time"), F.col("_ingested_at"))
    rows = rows.select(
        "event_id", micros(F.col("event_time")).alias("_t"), *columns, *extra, F.unix_millis(at.cast("timestamp")).alias("_at"))
    rows = _with_watermark(rows.filter("event_id IS NOT NULL AND _at IS NOT NULL"), F.timestamp_millis("_at"), delay)
    bucketed = rows.withColumn("_bucket", F.pmod(F.xxhash64("event_id"), F.lit(buckets)).cast("int"))
    signed = _packed(bucketed, {"_bucket": "int"}, _newest).groupBy("_bucket").transformWithState(
        _Versions(horizon * 1000), "part binary", "Append", "EventTime")
    return _unpacked(signed, f"{_ddl(rows)}, sign int").select("event_id", "_t", *columns, "sign")


def _close_ms(key) -> int:
    """End of the day that is the first part of a key, in milliseconds."""
    return (key[0] + 1) * _DAY // 1000


def _changes_of(keys: list[str], sums: list[str], distincts: int) -> Callable[[pa.Table], pa.Table]:
    """Signed rows as sums per hour and ``keys`` (``_kind`` -1), and per hour, ``keys`` and value (``_kind`` 0, 1 ...) the sum of signs."""
    names = ["_day", "_shard", *keys, "_kind", "_value", *sums]

    def run(rows: pa.Table) -> pa.Table:
        def part(kind: int, value: str | None) -> pa.Table:
            shard = "_shard_sum" if value is None else f"_shard_{kind}"
            by, numbers = ["_day", shard, *keys], sums if value is None else sums[:1]
            chosen = rows
            if value is not None:
                chosen = rows.filter(pc.is_valid(rows[value])).drop_columns(sums)
                chosen, by = chosen.append_column(sums[0], chosen["sign"].cast(pa.int64())), [*by, value]
            got = _summed(chosen, by, numbers)
            n = got.num_rows
            more = {"_kind": pa.array(np.full(n, kind, "i4"))} | {s: pa.array(np.zeros(n, "i8")) for s in sums if s not in numbers}
            more["_value"] = got[value] if value else pa.nulls(n, pa.string())
            more["_shard"] = got[shard]
            return pa.table({c: more[c] if c in more else got[c] for c in names})

        return _joined([part(-1, None), *[part(i, f"_value_{i}") for i in range(distincts)]])

    return run


class _DistinctChanges(StatefulProcessor):
    """Per day and shard, for every hour: sums of signed rows, and by how many the numbers of distinct values change."""

    def __init__(self, keys: list[str], sums: list[str], distincts: int, clear_after_ms: int):
        self.keys, self.sums, self.distincts, self.clear_after_ms = keys, sums, distincts, clear_after_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.counts = handle.getValueState("counts", "part binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        values = [*self.keys, "_kind", "_value"]
        came = _summed(_joined([_table_of(row["part"]) for row in rows]), values, self.sums)
        one = came.filter(pc.less(came["_kind"], 0)).drop_columns(["_kind", "_value"])
        numbers = self.sums + [f"_distinct_{i}" for i in range(self.distincts)]
        out = [self._wide(one, numbers, {})]

        n = came[self.sums[0]]
        change = came.filter(pc.and_(pc.greater_equal(came["_kind"], 0), pc.not_equal(n, 0))).select([*values, self.sums[0]])
        change = change.rename_columns([*values, "change"])
        if change.num_rows:
            change = change.append_column("n", pa.array(np.zeros(change.num_rows, "i8")))
            held = self.counts.get()
            if held is None:
                self.handle.registerTimer(_close_ms(key) + self.clear_after_ms)
            else:
                known = _table_of(held[0])
                change = _joined([change, known.append_column("change", pa.array(np.zeros(known.num_rows, "i8"))).select(change.column_names)])
            both = _summed(change, values, ["change", "n"])
            before, after = both["n"].to_numpy(), both["n"].to_numpy() + both["change"].to_numpy()
            gain = (after > 0).astype("i8") - (before > 0)
            left = both.select(values).append_column("n", pa.array(after)).filter(pa.array(after != 0))
            self.counts.update((_bytes_of(left.combine_chunks()),))
            kinds = both["_kind"].to_numpy()
            for i in range(self.distincts):
                chosen = pa.array((kinds == i) & (gain != 0))
                out.append(self._wide(both.select(self.keys).filter(chosen), numbers, {f"_distinct_{i}": pa.array(gain).filter(chosen)}))
        changes = _nonzero(_summed(_joined(out), self.keys, numbers), numbers)
        if changes.num_rows:
            yield Row(_day=key[0], part=_bytes_of(changes))

    def _wide(self, rows: pa.Table, numbers: list[str], given: dict[str, pa.Array]) -> pa.Table:
        """``rows`` with all ``numbers``, 0 where there is none."""
        zero = pa.array(np.zeros(rows.num_rows, "i8"))
        return pa.table({c: given[c] if c in given else rows[c] if c in rows.column_names else zero for c in [*self.keys, *numbers]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.counts.clear()
        return iter([])

    def close(self) -> None:
        pass


def _nonzero(rows: pa.Table, numbers: list[str]) -> pa.Table:
    """Rows in which a number isn't 0."""
    return rows.filter(pa.array(np.any([rows[n].to_numpy() != 0 for n in numbers], axis=0))).combine_chunks()


class _Totals(StatefulProcessor):
    """Running totals of a day's hours; a row with all of them whenever they change."""

    def __init__(self, keys: list[str], numbers: list[str], clear_after_ms: int):
        self.keys, self.numbers, self.clear_after_ms = keys, numbers, clear_after_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", "part binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        came = _summed(_joined([_table_of(row["part"]) for row in rows]), self.keys, self.numbers)
        came = _nonzero(came, self.numbers)
        held = self.totals.get()
        if held is None:
            self.handle.registerTimer(_close_ms(key) + self.clear_after_ms)
        if came.num_rows:
            marked = [came.append_column("changed", pa.array(np.ones(came.num_rows, "i8")))]
            if held is not None:
                known = _table_of(held[0])
                marked.append(known.append_column("changed", pa.array(np.zeros(known.num_rows, "i8"))))
            totals = _summed(_joined(marked), self.keys, [*self.numbers, "changed"])
            changed = pc.greater(totals["changed"], 0)
            totals = totals.drop_columns(["changed"])
            self.totals.update((_bytes_of(totals),))
            yield Row(part=_bytes_of(totals.filter(changed)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.totals.clear()
        return iter([])

    def close(self) -> None:
        pass


def hourly_totals(
    signed: DataFrame, keys: list[str], sums: dict[str, Column], distincts: dict[str, str],
    horizon: int = HORIZON, shards: int = SHARDS,
) -> DataFrame:
    """Exact totals per hour and ``keys`` of signed rows: a row with all of them whenever they change.

    ``sums`` are whole numbers per row, ``distincts`` name columns whose different values
    are counted, NULLs left out. Values of one day are dealt over ``shards`` by
    their hash, sums by hour, after a reduction per lot, so a busy hour is several states, each as large as its number of
    different values; a micro-batch reads and writes a state it touches once. What meets per day is
    one small table per shard and micro-batch.
    """
    key_names, numbers = ["_hour", *keys], [f"_sum_{i}" for i in range(len(sums))]
    shard = lambda *of: F.pmod(F.xxhash64(*of), F.lit(shards)).cast("int")
    told = signed.filter("sign <> 0").withColumn("_hour", F.col("_t") - F.pmod(F.col("_t"), F.lit(_HOUR)))
    told = told.select(
        F.floor(F.col("_hour") / F.lit(_DAY)).alias("_day"), *key_names, "sign", shard(*key_names).alias("_shard_sum"),
        *[(c.cast("long") * F.col("sign")).alias(n) for n, c in zip(numbers, sums.values())],
        *[F.col(c).cast("string").alias(f"_value_{i}") for i, c in enumerate(distincts.values())],
        *[shard(F.col(c).cast("string")).alias(f"_shard_{i}") for i, c in enumerate(distincts.values())])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in told.schema if f.name in key_names)
    clear_after_ms = horizon * 1000
    dealt = _packed(told, {"_day": "long", "_shard": "int"}, _changes_of(key_names, numbers, len(distincts)))
    changes = dealt.groupBy("_day", "_shard").transformWithState(
        _DistinctChanges(key_names, numbers, len(distincts), clear_after_ms), "_day long, part binary", "Append", "EventTime")
    all_numbers = numbers + [f"_distinct_{i}" for i in range(len(distincts))]
    totals = changes.groupBy("_day").transformWithState(
        _Totals(key_names, all_numbers, clear_after_ms), "part binary", "Append", "EventTime")
    totals = _unpacked(totals, ", ".join([schema, *[f"{n} long" for n in all_numbers]]))
    named = [F.col(n).alias(name) for n, name in zip(all_numbers, [*sums, *distincts])]
    return totals.select(from_micros(F.col("_hour")).alias("hour"), *keys, *named)


SUMMARY_COLUMNS = ["event_type", "src_ip", "username"]
FEATURE_COLUMNS = ["event_type", "src_ip", "username", "country", "severity", "severity_rank", "is_attack_event", "is_business_hours"]


def hourly_summary(signed: DataFrame, **options) -> DataFrame:
    """Changes of the hourly summary; ``sinks.newest_rows`` by event_hour and event_type is the table."""
    totals = hourly_totals(
        signed, ["event_type"], {"event_count": F.lit(1)}, {"unique_ips": "src_ip", "unique_users": "username"}, **options)
    return totals.withColumnRenamed("hour", "event_hour")


def hourly_features(signed: DataFrame, **options) -> DataFrame:
    """Changes of the hourly features; ``sinks.newest_rows`` by window_start is the table."""
    one = lambda condition: F.when(condition, 1).otherwise(0)
    totals = hourly_totals(
        signed, [],
        {"total_event_count": F.lit(1), "failed_login_count": one(F.col("event_type") == "failed_login"),
         "attack_event_count": one(F.col("is_attack_event")), "_ranks": F.coalesce("severity_rank", F.lit(0)),
         "_ranked": one(F.col("severity_rank").isNotNull()), "critical_event_count": one(F.col("severity") == "critical"),
         "_outside": one(~F.col("is_business_hours"))},
        {"unique_src_ips": "src_ip", "unique_users": "username", "unique_countries": "country"}, **options)
    total = F.col("total_event_count")
    return totals.select(
        F.col("hour").alias("window_start"), (F.col("hour") + F.expr("INTERVAL 1 HOUR")).alias("window_end"),
        "total_event_count", "unique_src_ips", "unique_users", "failed_login_count",
        ratio(F.col("failed_login_count"), total).alias("failed_login_ratio"), "attack_event_count",
        F.coalesce(F.col("_ranks") / F.nullif(F.col("_ranked"), F.lit(0)), F.lit(0.0)).alias("avg_severity_rank"),
        "critical_event_count", "unique_countries", ratio(F.col("_outside"), total).alias("events_outside_business_hours_ratio"))


class _LateRouter(StatefulProcessor):
    """Marks rows whose window the query's watermark had closed when they came."""

    def __init__(self, names: list[str]):
        self.names = names

    def init(self, handle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        closed_us = timerValues.getCurrentWatermarkInMs() * 1000
        for row in rows:
            yield Row(**{n: row[n] for n in self.names}, is_late=row["_closes"] <= closed_us)

    def close(self) -> None:
        pass


def route_late(rows: DataFrame, window: str = "1 hour", delay: str = "1 hour", shards: int = 64) -> DataFrame:
    """``rows`` (with ``ts``) and ``is_late``: whether the watermark had passed the end of the
    row's ``window`` when it came.

    Judged by the watermark of the very query, in the micro-batch that holds the row; kept and late
    rows together are all rows. (Spark's own aggregates still take rows by the watermark of the
    micro-batch before, so they may hold a few rows that are late here.)
    """
    names = rows.columns
    closes = F.unix_micros(F.window("ts", window)["end"])
    timed = _with_watermark(rows.filter("ts IS NOT NULL").withColumn("_closes", closes), F.col("ts"), delay)
    dealt = timed.withColumn("_shard", F.pmod(F.xxhash64(*names), F.lit(shards)).cast("int"))
    return dealt.groupBy("_shard").transformWithState(_LateRouter(names), f"{_ddl(rows)}, is_late boolean", "Append", "EventTime")


class _Bursts(StatefulProcessor):
    """Times of a shard's sources in one time bucket and the bucket before; counted when the watermark closes the bucket."""

    def __init__(self, threshold: int, window_us: int):
        self.threshold, self.window_us = threshold, window_us

    def init(self, handle) -> None:
        self.handle = handle
        self.times = handle.getListState("times", "part binary")

    def _ends_ms(self, bucket: int) -> int:
        return -(-(bucket + 1) * (self.window_us + 1) // 1000)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        ends = self._ends_ms(key[0])
        if ends <= timerValues.getCurrentWatermarkInMs():
            return iter([])
        changes = _met([_table_of(row["part"]) for row in rows])
        if changes.num_rows:
            if not self.times.exists():
                self.handle.registerTimer(ends)
            self.times.appendValue((_bytes_of(changes),))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        met = _met([_table_of(part) for part, in self.times.get()])
        met = met.filter(pc.greater(met["sign"], 0))
        met = met.take(pc.sort_indices(met, sort_keys=[("src_ip", "ascending"), ("_t", "ascending")]))
        sources, times, counts = (met[c].to_pylist() for c in ("src_ip", "_t", "sign"))
        begin, found, lives = key[0] * (self.window_us + 1), [], []
        first, live = 0, 0
        for i, t in enumerate(times):
            if i and sources[i] != sources[i - 1]:
                first, live = i, 0
            live += counts[i]
            while times[first] < t - self.window_us:
                live -= counts[first]
                first += 1
            if t >= begin and live >= self.threshold:
                found.append(i)
                lives.append(live)
        self.times.clear()
        if found:
            moments = met.select(["src_ip", "_t"]).take(pa.array(found)).append_column("events_in_window", pa.array(lives, pa.int64()))
            yield Row(part=_bytes_of(moments.combine_chunks()))

    def close(self) -> None:
        pass


def _met(parts: list[pa.Table]) -> pa.Table:
    """How many events there are of each source at each time, where that isn't 0."""
    rows = _summed(_joined(parts), ["src_ip", "_t"], ["sign"])
    return rows.filter(pc.not_equal(rows["sign"], 0)).combine_chunks()


def burst_moments(
    signed: DataFrame, threshold: int = 50, minutes: int = 5, event_type: str = "failed_login", shards: int = SHARDS
) -> DataFrame:
    """Every moment at which a source has ``threshold`` or more events in the trailing window,
    once the watermark has closed the moment's time bucket (at most a window later).

    An event is kept with its own bucket and the next, the only ones whose windows reach it, so state is
    bounded by the clock. Sources are dealt over ``shards``. Corrections count as far as they come before the bucket closes.
    """
    window_us = minutes * 60_000_000
    own = bucket_of(F.col("_t"), window_us + 1)
    kept = signed.filter((F.col("event_type") == event_type) & (F.col("sign") != 0) & F.col("src_ip").isNotNull()).select(
        F.explode(F.array(own, own + 1)).alias("_bucket"), F.pmod(F.xxhash64("src_ip"), F.lit(shards)).cast("int").alias("_shard"),
        "src_ip", "_t", F.col("sign").cast("long").alias("sign"))
    reduced = lambda rows: _summed(rows, ["_bucket", "_shard", "src_ip", "_t"], ["sign"])
    found = _packed(kept, {"_bucket": "long", "_shard": "int"}, reduced).groupBy("_bucket", "_shard").transformWithState(
        _Bursts(threshold, window_us), "part binary", "Append", "EventTime")
    return _unpacked(found, "src_ip string, _t long, events_in_window long").select(
        "src_ip", from_micros(F.col("_t")).alias("event_time"), "events_in_window")
