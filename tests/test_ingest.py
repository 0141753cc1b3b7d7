from __future__ import annotations

import json
import re
from datetime import datetime, timedelta

import pytest

from tests.test_validate import GOOD
from vigilframe.plans.ingest import ingest
from vigilframe.plans.pipeline import refresh_silver, register_views, run_pipeline, stored_tables
from vigilframe.plans.semantic import semantic_query
from vigilframe.sources import files
from vigilframe.sources.contracts import BRONZE, DEAD_LETTER, PIPELINE_RUNS, TABLES
from vigilframe.sources.tables import read_table, row_count, scan, table_path


def record(i, **changes):
    return json.dumps({**GOOD, "event_id": f"id-{i}", **changes})


@pytest.fixture
def base(tmp_path):
    return str(tmp_path / "base")


@pytest.fixture
def write(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()

    def put(name, *lines):
        (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
        return str(folder)

    return put


def bronze(spark, base):
    return read_table(spark, table_path(base, "bronze.security_events"), BRONZE)


def dead(spark, base):
    return read_table(spark, table_path(base, "bronze.dead_letter_events"), DEAD_LETTER)


def mixed():
    good = [record(i) for i in range(10)]
    no_id, no_type = json.loads(record(10)), json.loads(record(11))
    del no_id["event_id"], no_type["event_type"]
    return [*good, json.dumps(no_id), json.dumps(no_type), record(12, event_type="invalid_type"), "this is not json", ""]


def test_counts_and_metrics(spark, write, base):
    result = ingest(spark, write("a.jsonl", *mixed()), base)
    assert (result.records_ingested, result.records_rejected) == (10, 4)
    assert result.elapsed_seconds > 0 and result.records_per_second > 0
    assert bronze(spark, base).count() == 10 and dead(spark, base).count() == 4
    reasons = {r["event_id"]: r["error_reason"] for r in dead(spark, base).collect() if r["event_id"] != "unknown"}
    assert set(reasons) == {"id-11", "id-12"}


def test_fields_and_metadata(spark, write, base):
    write("b.jsonl", record(2))
    folder = write("a.jsonl", record(1, destination_ip=None, hostname="WS-É"))
    ingest(spark, folder, base, now=datetime(2024, 1, 15, 8))
    got = {r["event_id"]: r for r in bronze(spark, base).collect()}
    assert got["id-1"]["hostname"] == "WS-É" and got["id-1"]["username"] == GOOD["username"]
    assert [got[k]["_batch_id"][:18] for k in ("id-1", "id-2")] == ["batch_20240115_001", "batch_20240115_002"]
    for r in got.values():
        assert r["_ingested_at"] == datetime(2024, 1, 15, 8) and r["_source_file"].endswith(".jsonl")
        assert re.fullmatch(r"batch_\d{8}_\d{3}_[0-9a-f]{8}", r["_batch_id"])


@pytest.mark.parametrize("times", [2, 3])
def test_again_changes_nothing_in_bronze(spark, write, base, times):
    folder = write("a.jsonl", *mixed())
    for day in range(times):
        ingest(spark, folder, base, now=datetime(2024, 1, 15) + timedelta(days=day))
    assert bronze(spark, base).count() == 10
    assert dead(spark, base).count() == 4 * times  # append only


def test_dead_letters_once(spark, write, base):
    folder = write("a.jsonl", *mixed())
    for _ in range(2):
        ingest(spark, folder, base, append_once=True)
    assert dead(spark, base).count() == 4


def test_nothing_to_read(spark, tmp_path, write, base):
    assert ingest(spark, str(tmp_path / "missing"), base).records_ingested == 0
    folder = write("note.txt", record(1))
    assert ingest(spark, folder, base).records_ingested == 0
    assert row_count(spark, table_path(base, "bronze.security_events")) == 0


def test_extra_field_is_kept_and_survives_later_runs(spark, write, base):
    ingest(spark, write("a.jsonl", record(1, score=5)), base, extra={"score": "int"})
    ingest(spark, write("a.jsonl", record(2)), base)
    stored = scan(spark, table_path(base, "bronze.security_events"))
    assert {r["event_id"]: r["score"] for r in stored.collect()} == {"id-1": 5, "id-2": None}


def full(i, kind, minute=0, **changes):
    t = datetime(2024, 1, 15 + i % 3, i % 24, minute)
    return record(
        i, event_time=t.isoformat() + "Z", event_type=kind, severity="high", username=f"u{i % 4}", hostname="ws", country="US",
        status="s", operating_system="x", department="IT", src_ip=f"10.0.0.{i % 7}",
        detection_time=(t + timedelta(minutes=5)).isoformat(), resolution_time=(t + timedelta(minutes=245)).isoformat(), **changes,
    )


def test_whole_pipeline_twice(spark, write, base):
    kinds = ("failed_login", "successful_login", "malware_alert", "brute_force_attempt")
    folder = write("a.jsonl", *[full(i, kinds[i % 4]) for i in range(60)], "broken")
    counts = []
    for _ in range(2):
        again = run_pipeline(spark, folder, base)
        counts.append(again["silver"].count())
    assert counts == [60, 60]
    kpi = again["gold"]["gold.kpi_summary"].first()
    assert kpi["total_attacks"] == 30 and kpi["failed_login_rate"] == 0.5
    assert kpi["avg_mttd_minutes"] == 5.0 and kpi["avg_mttr_minutes"] == 240.0 and kpi["sla_compliance"] == 1.0
    for name in TABLES:
        assert read_table(spark, table_path(base, name), TABLES[name]).count() > 0, name
    assert len(register_views(spark, base)) == len(TABLES) + 3
    joined = spark.sql("""
        SELECT k.total_attacks, s.n, a.windows FROM kpi_summary k
        CROSS JOIN (SELECT count(*) AS n FROM silver_events WHERE is_attack_event) s
        CROSS JOIN (SELECT count(*) AS windows FROM anomaly_view) a
    """).first()
    assert tuple(joined)[:2] == (30, 30) and joined["windows"] > 0
    query = {
        "measures": ["SecurityEvents.count"],
        "timeDimensions": [{"dimension": "SecurityEvents.eventTime", "dateRange": ["2024-01-15", "2024-01-15"]}],
    }
    day = semantic_query(stored_tables(spark, base), query)
    assert day.first()["SecurityEvents.count"] == 20
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "(event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert spark.table("stg_security_events").columns == BRONZE.fieldNames()
    runs = read_table(spark, table_path(base, "pipeline_runs"), PIPELINE_RUNS).collect()
    assert len(runs) == 2 and {r["stages_completed"] for r in runs} == {"ingest,silver,gold,anomalies"}
    assert sorted((r["records_ingested"], r["records_rejected"]) for r in runs) == [(0, 0), (60, 1)]
    assert all(r["stages_failed"] is None for r in runs)
    top = scan(spark, table_path(base, "gold.anomaly_top_features"))
    flagged = read_table(spark, table_path(base, "gold.anomaly_results"), TABLES["gold.anomaly_results"]).filter("is_anomaly")
    assert {r["window_start"] for r in top.collect()} == {r["window_start"] for r in flagged.collect()}
    assert all(len(r["top_features"]) == 3 for r in top.collect())


def test_a_run_takes_new_files_only(spark, write, base):
    run = lambda folder: ingest(spark, folder, base, only_new=True)
    first = run(write("a.jsonl", *[full(i, "failed_login") for i in range(40)], "broken"))
    stamp = {r["event_id"]: r["_ingested_at"] for r in bronze(spark, base).collect()}
    silver_before = refresh_silver(spark, base).count()
    second = run(write("b c+%[1].jsonl", full(1, "malware_alert"), full(99, "failed_login")))
    third = run(write("skip.txt", "x"))
    assert [(r.records_ingested, r.records_rejected) for r in (first, second, third)] == [(40, 1), (2, 0), (0, 0)]
    got = {r["event_id"]: r for r in bronze(spark, base).collect()}
    assert len(got) == 41 and got["id-1"]["event_type"] == "malware_alert" and dead(spark, base).count() == 1
    assert all(got[k]["_ingested_at"] == t for k, t in stamp.items() if k != "id-1")
    assert refresh_silver(spark, base).count() == silver_before + 1


def test_a_run_that_was_cut_off_is_finished_first(spark, write, base, monkeypatch):
    from vigilframe.plans import ingest as module

    folder = write("a.jsonl", record(1), record(2), "broken")
    real = module.write_table
    with monkeypatch.context() as m:
        def dying(df, path, *a, **kw):
            if path.endswith("ingested_files"):
                raise RuntimeError("lost")
            real(df, path, *a, **kw)

        m.setattr(module, "write_table", dying)
        with pytest.raises(RuntimeError):
            ingest(spark, folder, base, only_new=True)
    ids = {r["_batch_id"] for r in bronze(spark, base).collect()}
    write("b.jsonl", record(3))
    ingest(spark, folder, base, only_new=True)
    got = bronze(spark, base).collect()
    assert len(got) == 3 and dead(spark, base).count() == 1 and ids < {r["_batch_id"] for r in got}
    assert ingest(spark, folder, base, only_new=True).records_ingested == 0


def test_the_last_batch_id_is_by_number(spark, write, base):
    from vigilframe.plans.ingest import batch_ids, ingest_lines

    names = batch_ids([(f"f{i:05d}", 1, 1) for i in range(1002)], "20240201", "0a0a0a0a")
    lines = spark.createDataFrame([(record(i), n[0], n[3]) for i, n in enumerate(names[-5:])], "value string, _source_file string, _batch_id string")
    assert ingest_lines(spark, lines, base).batch_id == "batch_20240201_1002_0a0a0a0a"


def test_no_exchange_above_the_text_scan(spark, tmp_path, monkeypatch):
    from vigilframe.plans import ingest as module

    monkeypatch.setattr(module, "FILES_AT_ONCE", 2)
    for i in range(5):
        (tmp_path / f"{i}.jsonl").write_text(record(i))
    found = files.listing(spark, str(tmp_path), "*.jsonl")
    lines = module.lines_with_ids(spark, module.batch_ids(found, "20240201", "0a0a0a0a"))
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 3 and plan.count("BroadcastHashJoin") == 3
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert lines.count() == 5


def test_failed_stage_is_recorded(spark, write, base):
    folder = write("a.jsonl", record(1, severity="nope"))  # nothing reaches Silver
    with pytest.raises(ValueError, match="no feature rows"):
        run_pipeline(spark, folder, base, slow_after=0.0)
    run = read_table(spark, table_path(base, "pipeline_runs"), PIPELINE_RUNS).first()
    assert run["stages_failed"] == "anomalies" and run["slow_stages"].startswith("ingest")


def test_shuffle_size_follows_the_input(spark):
    from vigilframe.session import size_shuffles

    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")}
    try:
        assert size_shuffles(spark, 10) == 8
        assert size_shuffles(spark, 100 << 30) == 200
        assert size_shuffles(spark, 1 << 30) == 200  # never lowered
        assert size_shuffles(spark, 100 << 40) == 40_000
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(512 << 20)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
