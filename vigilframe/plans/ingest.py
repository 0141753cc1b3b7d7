"""Batch ingest of JSON-lines files into Bronze and dead letters."""

from __future__ import annotations

import re
import time
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from vigilframe.operators.dedup import newest_first
from vigilframe.operators.validate import parse_lines, rejected_rows, valid_rows
from vigilframe.session import use_utc
from vigilframe.sources import files
from vigilframe.sources.contracts import BRONZE, DEAD_LETTER, conform
from vigilframe.sources.tables import merge_table, read_table, snapshot, table_path, write_table

FILES_AT_ONCE = 50_000
"""Files of one read; their batch ids are a broadcast of about 10 MB."""

FileInfo = tuple[str, int, int]
_FILE = "path string, length long, modified long, _batch_id string"


@dataclass(frozen=True)
class IngestResult:
    records_ingested: int
    records_rejected: int
    elapsed_seconds: float
    records_per_second: float
    batch_id: str


def read_lines(spark: SparkSession, folder: str, pattern: str = "*.jsonl") -> DataFrame:
    """Lines of all matching files directly in ``folder`` with their file; none if there are none."""
    use_utc(spark)
    if not files.exists(spark, folder):
        return spark.createDataFrame([], "value string, _source_file string")
    lines = spark.read.option("pathGlobFilter", pattern).text(folder)
    return lines.select("value", F.col("_metadata.file_path").alias("_source_file"))


def batch_ids(found: list[FileInfo], day: str, run: str) -> list[tuple]:
    """(path, length, modified, id) of every file; the id is ``batch_YYYYMMDD_NNN_run``, NNN the file's position in path order."""
    return [(*info, f"batch_{day}_{n:03d}_{run}") for n, info in enumerate(sorted(found), 1)]


def lines_with_ids(spark: SparkSession, named: list[tuple]) -> DataFrame:
    """Lines of these files (path, length, modified, id) with their file and batch id.

    Raw lines are never shuffled: files are read in lots, each joined with its own ids, whose number is bounded.
    """
    use_utc(spark)
    lines = None
    for at in range(0, len(named), FILES_AT_ONCE):
        lot = named[at:at + FILES_AT_ONCE]
        paths = [re.sub(r"([\\*?\[\]{}])", r"\\\1", row[0]) for row in lot]  # names aren't patterns
        ids = spark.createDataFrame(lot, _FILE).select(_one_slash(F.col("path")).alias("_path"), "_batch_id")
        part = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("_source_file"))
        # A scan shows a file's URI, with escapes, a listing its path.
        unescaped = F.url_decode(F.replace(_one_slash(F.col("_source_file")), F.lit("+"), F.lit("%2B")))
        part = part.join(F.broadcast(ids), unescaped == F.col("_path")).drop("_path")
        lines = part if lines is None else lines.unionAll(part)
    return spark.createDataFrame([], "value string, _source_file string, _batch_id string") if lines is None else lines


def _one_slash(path):
    """With one slash after the scheme, where a listing and a scan write different numbers of them."""
    return F.regexp_replace(path, "^([a-z0-9]+:)/+", "$1/")


def stamped_records(lines: DataFrame, now: datetime, extra: dict[str, str] | None = None) -> DataFrame:
    """Every non-blank line, parsed and validated, with the run's ingest time."""
    stamp = F.lit(now.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
    return parse_lines(lines, extra).withColumn("_ingested_at", stamp)


def bronze_rows(parsed: DataFrame, extra: dict[str, str] | None = None) -> DataFrame:
    good = valid_rows(parsed)
    return conform(good, BRONZE).select(*BRONZE.fieldNames()) if not extra else good.select(
        *BRONZE.fieldNames(), *extra
    )


def dead_letters(parsed: DataFrame) -> DataFrame:
    return conform(rejected_rows(parsed.withColumnRenamed("_ingested_at", "_rejected_at")).withColumnRenamed(
        "_rejected_at", "rejected_at"
    ), DEAD_LETTER)


def ingest(
    spark: SparkSession,
    folder: str,
    base: str,
    now: datetime | None = None,
    extra: dict[str, str] | None = None,
    append_once: bool = False,
    pattern: str = "*.jsonl",
    only_new: bool = False,
) -> IngestResult:
    """Load the matching files of ``folder`` into the tables below ``base``.

    ``only_new`` leaves out files that an earlier such run has loaded, by path, length and
    modification time. A run that was cut off is finished first, with its own files and ids,
    and what it had appended already is not appended again.
    """
    now = now or datetime.now(timezone.utc)
    found = files.listing(spark, folder, pattern)
    if not only_new:
        named = batch_ids(found, now.strftime("%Y%m%d"), uuid.uuid4().hex[:8])
        return ingest_lines(spark, lines_with_ids(spark, named), base, now, extra, append_once)
    ledger, pending = (table_path(base, f"bronze.{n}") for n in ("ingested_files", "pending_files"))
    schema = spark.createDataFrame([], _FILE).schema
    results = []
    held = [tuple(r) for r in read_table(spark, pending, schema).collect()]
    if held:
        results.append(_load(spark, held, base, now, extra, ledger, pending))
    offered = spark.createDataFrame(found, "path string, length long, modified long")
    known = read_table(spark, ledger, schema).select("path", "length", "modified")
    fresh = [tuple(r) for r in offered.join(known, ["path", "length", "modified"], "left_anti").collect()]
    if fresh:
        named = batch_ids(fresh, now.strftime("%Y%m%d"), uuid.uuid4().hex[:8])
        write_table(spark.createDataFrame(named, _FILE), pending)
        results.append(_load(spark, named, base, now, extra, ledger, pending))
    ok, bad, seconds = (sum(getattr(r, f) for r in results) for f in ("records_ingested", "records_rejected", "elapsed_seconds"))
    return IngestResult(ok, bad, round(seconds, 3), round(ok / seconds, 2) if seconds else 0.0, results[-1].batch_id if results else "")


def _load(spark: SparkSession, named: list[tuple], base: str, now: datetime, extra, ledger: str, pending: str) -> IngestResult:
    """One run over pending files; they are in the ledger once both tables hold them."""
    run = named[0][3].rpartition("_")[2]
    result = ingest_lines(spark, lines_with_ids(spark, named), base, now, extra, run=run)
    rows = spark.createDataFrame(named, _FILE)
    write_table(rows, ledger, "append", name=f"run-{run}")
    write_table(rows.limit(0), pending)
    return result


def ingest_lines(
    spark: SparkSession,
    lines: DataFrame,
    base: str,
    now: datetime | None = None,
    extra: dict[str, str] | None = None,
    append_once: bool = False,
    run: str | None = None,
) -> IngestResult:
    """Load lines (value, _source_file, _batch_id): valid rows merge by event_id, others are appended.

    The raw text is read and parsed once, into a staging copy split by outcome; both
    tables are filled from that copy and the run's counts come from the same pass.
    Running again with the same files leaves Bronze unchanged but for the newer ingest time;
    dead letters are appended again unless ``append_once``, which skips a (file, record) that
    is already there, or unless the append has the name of an earlier ``run``.
    ``extra`` names further fields to keep, with their types.
    """
    started, now = time.time(), now or datetime.now(timezone.utc)
    staging = table_path(base, f"_staging.ingest_{run or uuid.uuid4().hex}")
    seen = Observation("ingest")
    parsed = stamped_records(lines, now, extra)
    ok = F.col("error_reason") == ""
    (
        parsed.observe(
            seen,
            F.count_if(ok).alias("ok"),
            F.count_if(~ok).alias("bad"),
            F.max_by("_batch_id", F.split_part("_batch_id", F.lit("_"), F.lit(3)).cast("long")).alias("batch"),
        )
        .withColumn("_ok", ok)
        .write.mode("overwrite").partitionBy("_ok").parquet(staging)
    )
    counts = seen.get
    staged = spark.read.schema(parsed.schema.add("_ok", "boolean")).parquet(staging)
    if counts["ok"]:
        rows = bronze_rows(staged.filter("_ok").drop("_ok"), extra)
        merge_table(
            rows.withColumn("ingest_date", F.to_date("_ingested_at")),
            table_path(base, "bronze.security_events"), ["event_id"], newest_first(rows),
            partition="ingest_date",
        )
    if counts["bad"]:
        rows = dead_letters(staged.filter("NOT _ok").drop("_ok"))
        append_dead_letters(_unknown_only(spark, rows, base) if append_once else rows, base, run and f"run-{run}")
    files.remove(spark, staging)
    elapsed = time.time() - started
    return IngestResult(
        counts["ok"], counts["bad"], round(elapsed, 3),
        round(counts["ok"] / elapsed, 2) if elapsed > 0 else 0.0, counts["batch"] or "",
    )


def clear_staging(spark: SparkSession, base: str) -> None:
    """Remove the staging copies of runs that failed; call when no run is under way."""
    files.remove(spark, f"{base.rstrip('/')}/_staging")


def _batch_day(batch_id: str = "_batch_id"):
    """The date inside ``batch_YYYYMMDD_NNN_run``."""
    return F.to_date(F.substring(batch_id, 7, 8), "yyyyMMdd")


def append_dead_letters(rows: DataFrame, base: str, name: str | None = None) -> None:
    path = table_path(base, "bronze.dead_letter_events")
    write_table(rows.withColumn("reject_date", _batch_day()), path, "append", partition="reject_date", name=name)


def _unknown_only(spark: SparkSession, rows: DataFrame, base: str) -> DataFrame:
    """Dead letters whose (file, record) is not stored yet."""
    path = table_path(base, "bronze.dead_letter_events")
    if not snapshot(spark, path).directories:
        return rows
    known = read_table(spark, path, DEAD_LETTER).select("_source_file", "raw_record")
    return rows.join(known, ["_source_file", "raw_record"], "left_anti")
