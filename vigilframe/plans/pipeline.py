"""One full run: raw files to Bronze, Silver, Gold, anomalies, with a run record."""

from __future__ import annotations

import time
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from vigilframe.operators.dedup import newest_first
from vigilframe.plans import gold
from vigilframe.plans.ingest import ingest
from vigilframe.plans.silver import silver_events, staging_events
from vigilframe.session import size_shuffles
from vigilframe.sources import files
from vigilframe.sources.contracts import ANOMALY_VIEW, BRONZE, PIPELINE_RUNS, SILVER, TABLES, conform
from vigilframe.sources.tables import merge_table, read_table, replace_from, row_count, snapshot, table_path, write_table

SLOW_STAGE_SECONDS = 300


def refresh_silver(spark: SparkSession, base: str, event_time_is_fixed: bool = False) -> DataFrame:
    """Bring Silver up to date from Bronze rows newer than anything it holds.

    ``event_time_is_fixed`` promises that all versions of an event share its date; replaced
    rows are then looked for in the dates of the new rows only.

    The newest ingest time that Silver has seen is kept with its snapshot. It prunes Bronze's
    date directories and Parquet row groups as a literal.
    """
    bronze_path, silver_path = (table_path(base, n) for n in ("bronze.security_events", "silver.silver_events"))
    rows = read_table(spark, bronze_path, BRONZE, "ingest_date")
    seen = snapshot(spark, silver_path).marks.get("ingested_at")
    if seen:
        mark = F.lit(seen).cast("timestamp_ntz")
        rows = rows.filter((F.col("ingest_date") >= F.to_date(mark)) & (F.col("_ingested_at") > mark))
    newest = rows.agg(F.max("_ingested_at")).first()[0]
    if newest is not None:
        fresh = silver_events(rows.drop("ingest_date"))
        merge_table(
            fresh.withColumn("event_date", F.to_date("event_time")), silver_path, ["event_id"], newest_first(fresh),
            partition="event_date", key_keeps_partition=event_time_is_fixed, marks={"ingested_at": newest.isoformat(sep=" ")},
        )
    return read_table(spark, silver_path, SILVER)


def refresh_gold(spark: SparkSession, base: str, silver: DataFrame) -> dict[str, DataFrame]:
    """Full refresh of the four Gold tables."""
    plans = {
        "gold.kpi_summary": gold.kpi_summary,
        "gold.attack_volume_by_day": gold.attack_volume_by_day,
        "gold.attack_volume_by_country": gold.attack_volume_by_country,
        "gold.hourly_event_summary": gold.hourly_event_summary,
    }
    return {name: replace_from(spark, base, name, lambda plan=plan: plan(silver)) for name, plan in plans.items()}


def run_pipeline(
    spark: SparkSession, folder: str, base: str, slow_after: float = SLOW_STAGE_SECONDS, pattern: str = "*.jsonl"
) -> dict:
    """Run all stages in order; append a record to ``pipeline_runs`` whether or not one fails."""
    from vigilframe.plans.anomalies import detect_anomalies

    size_shuffles(spark, files.total_bytes(spark, folder))
    state: dict = {}

    def do_ingest():
        state["ingest"] = ingest(spark, folder, base, pattern=pattern, only_new=True)

    def do_silver():
        state["silver"] = refresh_silver(spark, base)

    def do_gold():
        state["gold"] = refresh_gold(spark, base, state["silver"])

    def do_anomalies():
        state["anomalies"] = detect_anomalies(spark, base, state["silver"])

    begun, done, failed, slow, error = datetime.now(timezone.utc), [], [], [], None
    for name, stage in (("ingest", do_ingest), ("silver", do_silver), ("gold", do_gold), ("anomalies", do_anomalies)):
        started = time.time()
        try:
            stage()
            done.append(name)
        except Exception as problem:  # recorded, then raised again below
            failed.append(name)
            error = problem
        if time.time() - started > slow_after:
            slow.append(name)
        if error:
            break
    ingested = state.get("ingest")
    state["run"] = record_run(
        spark, base, begun, done, failed, slow,
        ingested.records_ingested if ingested else 0,
        row_count(spark, table_path(base, "silver.silver_events")) if "silver" in done else 0,
        ingested.records_rejected if ingested else 0,
    )
    if error:
        raise error
    return state


def record_run(
    spark: SparkSession, base: str, begun: datetime, done: list[str], failed: list[str], slow: list[str],
    ingested: int, transformed: int, rejected: int,
) -> str:
    """Append one row to ``pipeline_runs``; returns the run id."""
    run_id, ended = uuid.uuid4().hex, datetime.now(timezone.utc)
    row = [(
        run_id, begun.replace(tzinfo=None), ended.replace(tzinfo=None), (ended - begun).total_seconds(),
        ",".join(done), ",".join(failed) or None, ingested, transformed, rejected, ",".join(slow) or None,
    )]
    record = conform(spark.createDataFrame(row, PIPELINE_RUNS), PIPELINE_RUNS).coalesce(1)
    write_table(record, table_path(base, "pipeline_runs"), "append")
    return run_id


def stored_tables(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """All contract tables below ``base`` by name, as ``semantic_query`` takes them.

    Silver also shows its partition column ``event_date``, so date ranges skip directories.
    """
    return {
        name: read_table(spark, table_path(base, name), contract, "event_date" if contract is SILVER else None)
        for name, contract in TABLES.items()
    }


def register_views(spark: SparkSession, base: str) -> list[str]:
    """Temporary views over all tables below ``base``, for use in ``spark.sql``.

    Each is named like its table; ``stg_security_events`` is the staging projection of
    Bronze and ``anomaly_view`` the seven promised columns of the anomaly results.
    """
    views = {name.split(".")[1]: df for name, df in stored_tables(spark, base).items()}
    views["stg_security_events"] = staging_events(views["security_events"])
    views["anomaly_view"] = views["anomaly_results"].select(*ANOMALY_VIEW)
    views["pipeline_runs"] = read_table(spark, table_path(base, "pipeline_runs"), PIPELINE_RUNS)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)
