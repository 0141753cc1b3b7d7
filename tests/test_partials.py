"""Exact rollups, selection and heavy hitters against plain computations."""

from __future__ import annotations

import math
import random
import statistics
from datetime import timedelta

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tests.helpers import BASE, at, silver as filled
from vigilframe.operators import bitmaps, heavy, selection
from vigilframe.plans import cubes, gold, partials, rollups


def silver(spark, *rows):
    """Empty users and ranks of 0 stand for missing ones."""
    return filled(spark, *rows).withColumns({
        "username": F.nullif("username", F.lit("")), "severity_rank": F.nullif("severity_rank", F.lit(0))})


def made_up(n, seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        when = BASE + timedelta(hours=r.randrange(24 * 45))
        found = when + timedelta(seconds=r.randrange(7200)) if r.random() < 0.7 else None
        done = (found or when) + timedelta(seconds=r.randrange(30_000)) if r.random() < 0.6 else None
        rows.append({
            "event_id": f"e{i}", "event_time": when, "detection_time": found, "resolution_time": done, "severity_rank": r.randrange(1, 5),
            "event_type": r.choice(["failed_login", "successful_login", "malware_alert"]), "country": r.choice(["US", "FR", "DE"]),
            "src_ip": r.choice([f"10.0.{r.randrange(3)}.{r.randrange(40)}", f"{r.randrange(1000)}.7.8.9", "10.0.0.01"]),
            "username": r.choice(["a", "b", "", f"u{r.randrange(30)}"]), "is_attack_event": r.random() < 0.5})
    return rows


def test_numbers_of_addresses_differ_as_texts_do(spark):
    texts = ["1.2.3.4", "1.2.3.04", "01.2.3.4", "001.2.3.4", "1.2.3.40", "999.999.999.999", "0.0.0.0", "00.0.0.0", "10.0.0.9", "10.0.0.10"]
    odd = [None, "", "1.2.3", "1.2.3.4.5", "1.2.3.4\n", "a.b.c.d", "1.2.3.1234", " 1.2.3.4"]
    df = spark.createDataFrame([(t,) for t in texts + odd], "ip string")
    got = {r.ip: r.n for r in df.select("ip", bitmaps.address_number(F.col("ip")).alias("n")).collect()}
    assert len({got[t] for t in texts}) == len(texts) and all(got[t] is None for t in odd)
    many = spark.range(1000).select(F.concat(F.lit("10.0.0."), F.col("id")).alias("ip")).union(
        spark.range(256).select(F.concat(F.col("id"), F.lit(".10.999.7")).alias("ip")))
    assert many.select(bitmaps.address_number(F.col("ip")).alias("n")).distinct().count() == 1256


@pytest.mark.parametrize("grain", ["day", "week", "month"])
def test_sets_count_what_count_distinct_counts(spark, grain):
    rows = silver(spark, *made_up(400))
    for which, column in partials.SETS.items():
        period = F.date_trunc(grain, "event_time").cast("timestamp_ntz").alias("period")
        want = rows.groupBy(period, "country").agg(F.countDistinct(column).alias("n")).filter("n > 0")
        got = partials.count_sets(partials.build_sets(rows, which, ("country",)), which, grain, ("country",))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_no_set_is_expanded(spark):
    rows = silver(spark, *made_up(10))
    plan = partials.build_sets(rows, "addresses")._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Exchange") == 1


def test_kpis_of_all_days_are_the_kpis(spark):
    rows = silver(spark, *made_up(500), {"event_id": "alone", "event_time": BASE + timedelta(days=4000), "severity_rank": 0})
    got = partials.query_partials(partials.build_partials(rows.filter("event_id <> 'alone'")), "century").first()
    want = gold.kpi_summary(rows.filter("event_id <> 'alone'")).first()
    assert got.attack_count == want.total_attacks
    for name in ("failed_login_rate", "avg_mttd_minutes", "avg_mttr_minutes", "sla_compliance"):
        assert math.isclose(got[name], want[name], rel_tol=1e-9)
    alone = partials.query_partials(partials.build_partials(rows.filter("event_id = 'alone'")), "day").first()
    assert alone.avg_mttd_minutes is None and alone.sla_compliance is None and alone.avg_severity_rank is None


def test_moments_merge_without_losing_digits(spark):
    r = random.Random(3)
    values = [1e9 + r.random() for _ in range(600)]
    rows = silver(spark, *[{"event_id": str(i), "event_time": at(86_400 * (i % 7)), "detection_time": BASE, "resolution_time": BASE} for i in range(600)])
    df = rows.withColumn("severity_rank", F.element_at(F.array(*[F.lit(v) for v in values]), F.col("event_id").cast("int") + 1))
    got = partials.merge_moments(partials.build_partials(df), "rank", "year").first()
    assert got.n == 600 and math.isclose(got["mean"], statistics.fmean(values), rel_tol=1e-12)
    assert math.isclose(got.deviation, statistics.stdev(values), rel_tol=1e-6)
    one = partials.merge_moments(partials.build_partials(rows.limit(1)), "response", "day").first()
    assert (one.n, one["mean"], one.deviation) == (1, 0.0, None)


def test_scores_equal_the_daily_table(spark):
    rows = silver(spark, *made_up(500))
    got = partials.country_scores(partials.build_partials(rows, ("country",)), "day")
    want = gold.geographic_anomaly_score(rows)
    day = lambda r: (r["country"], r["attack_count"], r["z_score"])
    assert sorted(map(day, got.collect())) == sorted(map(day, want.collect()))


def test_averages_come_from_a_pre_aggregate(spark):
    rows = spark.createDataFrame(
        [(at(3600 * i), float(i % 5) if i % 4 else None, i % 7 == 0, i) for i in range(100)],
        "window_start timestamp_ntz, anomaly_score double, is_anomaly boolean, total_event_count long")
    stored = rollups.pre_aggregate(rows, "AnomalyResults", "", {"time": "windowStart", "granularity": "day"})
    got = rollups.query_pre_aggregate(stored, "AnomalyResults", ["anomalyScore", "totalEventCount"], "month").collect()
    want = rows.agg(F.avg("anomaly_score"), F.sum("total_event_count")).first()
    assert [(r.anomalyScore, r.totalEventCount) for r in got] == [tuple(want)] and "AnomalyResults" in cubes.CUBES


@settings(max_examples=8, deadline=None)
@given(st.lists(st.sampled_from([0.0, -1.5, 3.25, 1e300, -1e300, 7.0]) | st.floats(-1e6, 1e6), min_size=1, max_size=300), st.floats(0, 1))
def test_selected_percentiles(spark, values, share):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    want = df.agg(F.percentile("x", share)).first()[0]
    assert math.isclose(selection.exact_percentile(df, "x", share, accuracy=20, small=5), want, rel_tol=1e-12, abs_tol=1e-300)


def test_selection_where_few_values_hold_most_rows(spark):
    df = spark.range(40_000).select(F.when(F.col("id") % 5 < 2, 1.0).when(F.col("id") % 5 < 4, 2.0).otherwise(1 + F.col("id") / 40_000).alias("x"))
    ranks = [0, 15_999, 16_000, 16_001, 20_000, 23_999, 24_000, 39_999]
    want = sorted(r.x for r in df.collect())
    assert selection.values_at(df, "x", ranks, accuracy=100, small=50) == [want[r] for r in ranks]
    assert selection.exact_percentile(df.filter("x > 9"), "x", 0.5) is None
    with pytest.raises(ValueError):
        selection.values_at(df, "x", [40_000])


def test_top_values_of_merged_periods(spark):
    r = random.Random(4)
    rows = [(d, "hot" if r.random() < 0.3 else f"u{int(r.random() ** 4 * 400)}") for d in range(6) for _ in range(2000)] + [(0, None)]
    df = spark.createDataFrame(rows, "d int, v string")
    sketches = heavy.top_sketches(df, F.col("d"), "v", 500)
    got = heavy.top_values(sketches, df, F.expr("d DIV 3"), "v", F.expr("period DIV 3"), 5, 500).orderBy("period", "rank").collect()
    for p in (0, 1):
        counts = {}
        for d, v in rows:
            if d // 3 == p and v:
                counts[v] = counts.get(v, 0) + 1
        want = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:5]
        assert [(g.v, g["count"]) for g in got if g.period == p] == want
    assert all(g.is_complete for g in got)


def test_an_unproved_list_says_so(spark):
    df = spark.range(5000).select(F.lit(0).alias("d"), F.concat(F.lit("u"), F.col("id") % 2500).alias("v"))
    sketches = heavy.top_sketches(df, F.col("d"), "v", 50)
    got = heavy.top_values(sketches, df, F.lit(0), "v", F.lit(0), 5, 50).collect()
    assert not any(g.is_complete for g in got)
