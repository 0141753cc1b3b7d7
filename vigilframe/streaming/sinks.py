"""Stream sinks that give the same tables when a batch is replayed."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from vigilframe.operators.dedup import latest_per_key, newest_first
from vigilframe.operators.validate import parse_lines
from vigilframe.plans.ingest import append_dead_letters, bronze_rows, dead_letters
from vigilframe.plans.silver import silver_events
from vigilframe.sources import bucketed, files
from vigilframe.sources.tables import merge_table, table_path, write_table


def _start(
    stream: DataFrame, checkpoint: str, mode: str, each: Callable[[DataFrame, int], None], interval: str | None
) -> StreamingQuery:
    """Without an interval: take what is there now, then stop."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(each)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def append_stream(stream: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Rows that never change, to a Parquet directory (the sink's log makes it exactly once)."""
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).format("parquet")
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start(path)


def upsert_stream(
    stream: DataFrame, path: str, checkpoint: str, keys: list[str],
    day_of: str | None = None, interval: str | None = None,
) -> StreamingQuery:
    """Changed aggregate rows, merged by key.

    ``day_of`` names a time column among the keys: the table is then partitioned by its
    ``day``, and a micro-batch rewrites only the days it changes.
    """

    def each(batch: DataFrame, _: int) -> None:
        rows = batch.withColumn("day", F.to_date(day_of)) if day_of else batch
        merge_table(rows, path, keys, None, "day" if day_of else None, key_keeps_partition=True)

    return _start(stream, checkpoint, "update", each, interval)


def log_stream(
    stream: DataFrame, path: str, checkpoint: str, interval: str | None = None, partition: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Every micro-batch as a directory of its own, which a replay writes over: each row exactly once.

    ``state_partitions`` holds for the life of the checkpoint; without it there are as many as the cluster has cores now,
    and no more than shuffles have.
    """

    def each(batch: DataFrame, number: int) -> None:
        writer = batch.write.mode("overwrite")
        (writer.partitionBy(partition) if partition else writer).parquet(f"{path}/stream_batch={number}")

    with _keyed_state(stream.sparkSession, state_partitions):
        return _start(stream, checkpoint, "append", each, interval)


@contextmanager
def _keyed_state(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Queries that start inside keep keyed state in RocksDB and write changes of it, not copies.

    A partition of state costs a Python worker's start and a commit per operator and micro-batch, however few rows it has, and
    tasks go through a partition key by key. So there are no more than can be worked on at once.
    """
    shuffles = "spark.sql.shuffle.partitions"
    state, before = "spark.sql.streaming.stateStore.", {}
    wanted = {
        f"{state}providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        f"{state}rocksdb.changelogCheckpointing.enabled": "true",
        shuffles: str(partitions or min(int(spark.conf.get(shuffles)), spark.sparkContext.defaultParallelism)),
    }
    for key, value in wanted.items():
        before[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def keyed_stream(
    stream: DataFrame, name: str, checkpoint: str, keys: list[str], order: list[Column], buckets: int = 64, interval: str | None = None
) -> StreamingQuery:
    """Micro-batches merged into a bucketed catalog table; a replay changes nothing, as the newest version of a key stays."""

    def each(batch: DataFrame, _: int) -> None:
        if batch.sparkSession.catalog.tableExists(name):
            bucketed.merge(batch, name, keys, order)
        else:
            bucketed.create(batch, name, keys, order, buckets)

    return _start(stream, checkpoint, "append", each, interval)


def newest_rows(spark: SparkSession, path: str, keys: list[str], present: str | None = None) -> DataFrame:
    """The last row of each key in what ``log_stream`` wrote, if its count ``present`` isn't 0."""
    logged = latest_per_key(spark.read.parquet(path), keys, [F.desc("stream_batch")]).drop("stream_batch")
    return logged.filter(F.col(present) > 0) if present else logged


def stream_identity(spark, checkpoint: str) -> str:
    """A random name of this stream, kept in its checkpoint from the first start on."""
    path = f"{checkpoint}/identity"
    if not files.exists(spark, path):
        files.create(spark, path, uuid.uuid4().hex[:8])
    return files.text_of(spark, path)


def ingest_stream(lines: DataFrame, base: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Raw lines to Bronze and dead letters.

    A micro-batch is parsed once into a staging copy and appended to both tables, under a
    name of the stream's identity and the micro-batch's number, both of which a replay
    repeats: what was committed is not appended again, what was cut off starts over, and no
    other stream or run has the name. Versions of one event are resolved by Silver, not
    looked up in all of Bronze per micro-batch.
    """
    identity = stream_identity(lines.sparkSession, checkpoint)

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        name = f"stream-{identity}-{number}"
        staging = table_path(base, f"_staging.{name}")
        newest = batch.agg(F.max("_file_time")).first()[0]
        if newest is None:
            return
        batch_id = f"batch_{newest:%Y%m%d}_{number + 1:03d}_{identity}"
        stamped = (
            parse_lines(batch.drop("_file_time").withColumn("_batch_id", F.lit(batch_id)))
            .withColumn("_ingested_at", F.current_timestamp().cast("timestamp_ntz"))
            .withColumn("_ok", F.col("error_reason") == "")
        )
        stamped.write.mode("overwrite").partitionBy("_ok").parquet(staging)
        staged = spark.read.schema(stamped.schema).parquet(staging)
        rows = bronze_rows(staged.filter("_ok").drop("_ok")).withColumn("ingest_date", F.to_date("_ingested_at"))
        write_table(rows, table_path(base, "bronze.security_events"), "append", partition="ingest_date", name=name)
        append_dead_letters(dead_letters(staged.filter("NOT _ok").drop("_ok")), base, name)
        files.remove(spark, staging)

    return _start(lines, checkpoint, "append", each, interval)


def silver_stream(
    bronze: DataFrame, base: str, checkpoint: str, interval: str | None = None, event_time_is_fixed: bool = False
) -> StreamingQuery:
    """Bronze rows to Silver by upsert; the newest version of an event stays, in whatever
    order versions come, and repeating a micro-batch changes nothing.

    ``event_time_is_fixed`` promises that versions of an event share its date, so that only
    the dates of the micro-batch are looked at.
    """
    path = table_path(base, "silver.silver_events")

    def each(batch: DataFrame, _: int) -> None:
        fresh = silver_events(batch)
        merge_table(
            fresh.withColumn("event_date", F.to_date("event_time")), path, ["event_id"], newest_first(fresh),
            partition="event_date", key_keeps_partition=event_time_is_fixed,
        )

    return _start(bronze, checkpoint, "append", each, interval)


def split_late(
    rows: DataFrame, path: str, checkpoint: str, delay_seconds: int = 3600, interval: str | None = None
) -> StreamingQuery:
    """Write on-time and late rows to ``path/on_time`` and ``path/late``.

    A row is late when its ``ts`` is more than the delay behind the newest time of earlier
    micro-batches. Each micro-batch owns one directory per output and notes the newest
    time so far, so a replay overwrites its own output and decides the same way.
    """

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        earlier = [int(n.split("=")[1]) for n in files.children(spark, f"{path}/marks") if "=" in n]
        earlier = sorted(n for n in earlier if n < number)
        high = spark.read.parquet(f"{path}/marks/stream_batch={earlier[-1]}").first()[0] if earlier else None
        late = F.lit(False) if high is None else F.col("ts") < F.lit(high) - F.make_dt_interval(secs=F.lit(delay_seconds))
        batch.filter(~late).write.mode("overwrite").parquet(f"{path}/on_time/stream_batch={number}")
        batch.filter(late).write.mode("overwrite").parquet(f"{path}/late/stream_batch={number}")
        newest = F.greatest(F.max("ts"), F.lit(high).cast("timestamp"))
        batch.agg(newest.alias("high")).write.mode("overwrite").parquet(f"{path}/marks/stream_batch={number}")
        for old in earlier[:-1]:
            files.remove(spark, f"{path}/marks/stream_batch={old}")

    return _start(rows, checkpoint, "append", each, interval)
