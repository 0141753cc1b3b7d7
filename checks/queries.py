"""Registered Spark queries; each takes (spark, folder of the tables)."""

from __future__ import annotations

import functools
import math
import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from vigilframe.functions import events as ev
from vigilframe.operators import dedup, detect, evaluate, forest, heavy, quality, selection, validate
from vigilframe.operators.filters import FilterSpec, apply_filters
from vigilframe.plans import anomalies, features, gold, ingest, partials, pipeline, rollups
from vigilframe.plans import quality as quality_plan, semantic as semantic_plan, silver as silver_plan
from vigilframe.session import settle, use_utc, work_path
from vigilframe.sources import bridge, bucketed, contracts, files, tables
from vigilframe.streaming import exact, sinks, sources as stream, windows

Query = Callable[[SparkSession, str], DataFrame]


def bronze(spark: SparkSession, folder: str) -> DataFrame:
    return bridge.bronze_from_events(bridge.read_events(use_utc(spark), folder))


def silver(spark: SparkSession, folder: str) -> DataFrame:
    return silver_plan.silver_events(bronze(spark, folder))


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    """Averages differ in their last bits between engines; six places do not."""
    return df.withColumns({n: F.round(n, 6) for n in names})


def _on_silver(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: plan(silver(spark, folder))


def _kpis(rows: DataFrame) -> DataFrame:
    kpis = gold.kpi_summary(rows).drop("computed_at")
    return _rounded(kpis, "avg_mttd_minutes", "avg_mttr_minutes")


def core() -> dict[str, Query]:
    return {
        "bridge_bronze": bronze,
        "staging_events": lambda s, d: silver_plan.staging_events(bronze(s, d)),
        "silver_dedup_latest": lambda s, d: dedup.dedup_events(bronze(s, d)),
        "silver_events": silver,
        "kpi_summary": _on_silver(_kpis),
        "kpi_cards": _on_silver(lambda v: gold.kpi_cards(_kpis(v))),
        "attack_volume_by_day": _on_silver(gold.attack_volume_by_day),
        "attack_timeline": _on_silver(lambda v: gold.attack_timeline(gold.attack_volume_by_day(v))),
        "attack_volume_by_country": _on_silver(gold.attack_volume_by_country),
        "hourly_event_summary": _on_silver(gold.hourly_event_summary),
        "hourly_features": _on_silver(lambda v: _rounded(features.hourly_features(v), "avg_severity_rank")),
        "events_by_type": _on_silver(gold.events_by_type),
        "severity_distribution": _on_silver(gold.severity_distribution),
        "hourly_activity": _on_silver(gold.hourly_activity),
        "top_countries": _on_silver(lambda v: gold.top_countries(gold.attack_volume_by_country(v))),
        "top_targeted_users": _on_silver(gold.top_targeted_users),
        "attack_severity_distribution": _on_silver(gold.attack_severity_distribution),
        "repeat_offender_ips": _on_silver(gold.repeat_offender_ips),
        "department_risk_score": _on_silver(gold.department_risk_score),
        "login_failure_by_hour": _on_silver(gold.login_failure_by_hour),
        "geographic_anomaly_score": _on_silver(gold.geographic_anomaly_score),
        "events_by_category": _on_silver(gold.events_by_category),
    }


def _silver_incremental(spark: SparkSession, folder: str) -> DataFrame:
    rows = bronze(spark, folder)
    first = silver_plan.silver_events(rows.filter("_ingested_at <= TIMESTAMP_NTZ '2024-01-15 00:00:00'"))
    return silver_plan.incremental_silver(first, rows)


def _merge_upsert(spark: SparkSession, folder: str) -> DataFrame:
    rows = bronze(spark, folder)
    names = ["event_id", "event_time", "username", "src_ip", "_ingested_at"]
    first = rows.filter(F.col("_batch_id").endswith("_001")).select(names)
    second = rows.filter(F.col("_batch_id").endswith("_002")).select(names)
    return dedup.merge_upsert(first, second, ["event_id"])


def _table_name() -> str:
    return f"keyed_{uuid.uuid4().hex[:12]}"


def _merge_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """A bucketed table from the second versions, into which the first ones and all once more are merged."""
    rows, name = bronze(spark, folder), _table_name()
    order = dedup.newest_first(rows)
    bucketed.create(rows.filter(F.col("_batch_id").endswith("_002")), name, ["event_id"], order, 8)
    bucketed.merge(rows.filter(F.col("_batch_id").endswith("_001")), name, ["event_id"], order)
    bucketed.merge(rows, name, ["event_id"], order)
    return spark.table(name)


def incremental() -> dict[str, Query]:
    return {
        "silver_incremental": _silver_incremental, "merge_upsert": _merge_upsert,
        "merge_bucketed": _merge_bucketed, "merge_older_last": _merge_older_last, "incremental_ingest": _incremental_ingest,
    }


def _lockouts(rows: DataFrame) -> DataFrame:
    """Chains by country, department and system: the table's users have no second-scale chains."""
    chained = rows.select(
        "event_id", "event_type", "event_time",
        F.col("country").alias("username"), F.col("department").alias("src_ip"),
        F.col("operating_system").alias("hostname"),
    )
    return detect.lockout_correlation(chained, min_seconds=60, max_seconds=86_400)


def detectors() -> dict[str, Query]:
    days = 24 * 60
    return {
        "burst_logins": _on_silver(lambda v: detect.burst_moments(v, threshold=2, minutes=5 * days)),
        "burst_sources": _on_silver(lambda v: detect.burst_sources(v, threshold=2, minutes=5 * days)),
        "off_hours_escalation": _on_silver(detect.off_hours_escalation),
        "watchlist_countries": _on_silver(detect.watchlist_summary),
        "watchlist_events": _on_silver(detect.watchlist_events),
        "lockout_correlation": _on_silver(_lockouts),
        "failure_sessions": _on_silver(lambda v: detect.failure_sessions(v, gap_minutes=2 * days)),
    }


def validate_events(spark: SparkSession, folder: str) -> DataFrame:
    """Every raw JSON line of the table's events with its error text."""
    parsed = _parsed(spark, folder)
    return parsed.select("raw_record", "event_id", "error_reason")


def _parsed(spark: SparkSession, folder: str) -> DataFrame:
    return validate.parse_lines(bridge.raw_json_lines(bridge.read_events(use_utc(spark), folder)))


def _route_valid(spark: SparkSession, folder: str) -> DataFrame:
    return validate.valid_rows(_parsed(spark, folder)).select("event_id", "event_time", "event_type", "username")


def _route_dead_letter(spark: SparkSession, folder: str) -> DataFrame:
    return validate.rejected_rows(_parsed(spark, folder)).select("event_id", "raw_record", "error_reason")


def _address_checks(spark: SparkSession, folder: str) -> DataFrame:
    ip = F.col("src_ip")
    return bronze(spark, folder).select(
        "event_id", "_batch_id", "src_ip",
        ev.looks_like_ipv4(ip).alias("ipv4_shape"), ev.is_strict_ipv4(ip).alias("strict_ipv4"),
        ev.is_uuid_v4(F.col("event_id")).alias("uuid_v4"),
    )


def _failing_fields(spark: SparkSession, folder: str) -> DataFrame:
    return validate.failing_fields(bronze(spark, folder)).groupBy("failing_fields").agg(F.count("*").alias("n")).select(
        F.concat_ws(",", "failing_fields").alias("failing_fields"), "n"
    )


def _internal_split(rows: DataFrame) -> DataFrame:
    return rows.groupBy("is_internal_ip").agg(F.count("*").alias("event_count"))


def _ingest_jsonl(spark: SparkSession, folder: str) -> DataFrame:
    """Write the events as files of raw lines, ingest them twice, show Bronze."""
    raw, base = work_path(spark, "raw"), work_path(spark, "base")
    bridge.raw_json_lines(bridge.read_events(use_utc(spark), folder)).write.text(raw)
    for _ in range(2):
        ingest.ingest(spark, raw, base, now=datetime(2024, 2, 1), pattern="*.txt")
    rows = tables.read_table(spark, tables.table_path(base, "bronze.security_events"), contracts.BRONZE)
    return rows.select(
        "event_id", "event_time", "event_type", "username", "_ingested_at",
        F.col("_source_file").endswith(".txt").alias("file_is_named"),
        F.col("_batch_id").rlike("^batch_20240201_[0-9]{3,}_[0-9a-f]{8}$").alias("batch_is_named"),
    )


def ingesting() -> dict[str, Query]:
    return {
        "validate_events": validate_events,
        "route_valid": _route_valid,
        "route_dead_letter": _route_dead_letter,
        "ingest_jsonl": _ingest_jsonl,
        "address_checks": _address_checks,
        "strict_schema": _failing_fields,
        "internal_ip_split": _on_silver(_internal_split),
    }


def _flagged(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Windows with four or more attacks, and windows with an off-hours escalation."""
    results = features.hourly_features(rows).select(
        "window_start", (F.col("attack_event_count") >= 4).alias("is_anomaly")
    )
    known = rows.filter("event_type = 'privilege_escalation' AND NOT is_business_hours").select(
        ev.hour_start(F.col("event_time")).alias("window_start")
    )
    return results, known


def _minmax(spark: SparkSession, folder: str) -> DataFrame:
    rows = bridge.read_events(use_utc(spark), folder).select("event_id", "value")
    return _rounded(forest.minmax_scores(rows, "value", "score"), "score")


def _forest_parts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = settle(features.hourly_features(silver(spark, folder)), "features")
    features.validate_features(rows)
    nodes = settle(forest.fit(rows, list(contracts.FEATURES), "window_start"), "forest")
    return rows, nodes


def _walked(rows: DataFrame, nodes: DataFrame, *keys: str) -> DataFrame:
    """Keys (window_start unless named) and raw score by another way: rows walk the trees by joins with the node table."""
    keys = keys or ("window_start",)
    size = nodes.agg(F.max("sample_size")).first()[0]
    trees = nodes.select("tree").distinct().count()
    usual = 2.0 * (math.log(size - 1.0) + 0.5772156649015329) - 2.0 * (size - 1.0) / size
    steps = nodes.select("tree", "node", "feature", "threshold", "left", "right", "path_length")
    at = rows.select(
        *keys, F.array(*[F.col(c).cast("double") for c in contracts.FEATURES]).alias("v"),
        F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), F.lit(0).alias("node"))
    leaf = F.col("feature") < 0
    for _ in range(math.ceil(math.log2(max(size, 2)))):
        goes_left = F.element_at("v", F.greatest(F.col("feature"), F.lit(0)) + 1) <= F.col("threshold")
        at = at.join(steps, ["tree", "node"]).select(
            *keys, "v", "tree", F.when(leaf, F.col("node")).when(goes_left, F.col("left")).otherwise(F.col("right")).alias("node"))
    return at.join(steps, ["tree", "node"]).groupBy(*keys).agg((-F.pow(F.lit(2.0), -F.avg("path_length") / usual)).alias("walked"))


def _near(a, b) -> Column:
    return F.abs(a - b) < 1e-9


def _iforest_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Every window, and whether its score and flag are those of the second way."""
    rows, nodes = _forest_parts(spark, folder)
    walked = settle(_walked(rows, nodes), "walked")
    low, high = walked.agg(F.min("walked"), F.max("walked")).first()
    again = (F.col("walked") - low) * 2.0 / (high - low) - 1.0
    return anomalies.score_windows(rows, nodes).join(walked, "window_start").select(
        "window_start", "total_event_count", _near(F.col("anomaly_score"), again).alias("score_agrees"),
        (F.col("is_anomaly") == (again < -0.5)).alias("flag_agrees"))


def _grown_trees(spark: SparkSession, folder: str) -> DataFrame:
    return grown(*_forest_parts(spark, folder))


def grown(rows: DataFrame, nodes: DataFrame, n_trees: int = 100) -> DataFrame:
    """Every tree, with the number of rows it was grown from and what must hold of its nodes.

    The sample is stated anew: the rows with the least hashes of seed, tree and key. It goes down the
    stored tree level by level, so every node is held against the rows that reach it.
    """
    columns, size = list(contracts.FEATURES), min(256, rows.count())
    steps = nodes.select("tree", "node", "feature", "threshold", "left", "right", "path_length")
    order = Window.partitionBy("tree").orderBy(F.xxhash64(F.lit(42), "tree", "window_start"), "window_start")
    at = rows.select(
        F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))).alias("tree"), "window_start", F.array(*[F.col(c).cast("double") for c in columns]).alias("v")
    ).withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= size).select("tree", F.lit(0).alias("node"), "v")
    limit, levels = math.ceil(math.log2(max(size, 2))), []
    cells = [F.struct(F.min(F.col("v")[i]).alias("low"), F.max(F.col("v")[i]).alias("high")) for i in range(len(columns))]
    for depth in range(limit + 1):
        at = settle(at.join(steps, ["tree", "node"]), "level")
        levels.append(at.groupBy("tree", "node", "feature", "threshold", "path_length").agg(
            F.lit(depth).alias("depth"), F.count("*").alias("n"), F.array(*cells).alias("bounds")))
        inner = at.filter("feature >= 0")
        at = inner.select("tree", F.when(F.element_at("v", F.col("feature") + 1) <= F.col("threshold"), F.col("left")).otherwise(F.col("right")).alias("node"), "v")
    reached = functools.reduce(DataFrame.unionByName, levels)
    usual = F.when(F.col("n") <= 1, 0.0).when(F.col("n") == 2, 1.0).otherwise(
        2.0 * (F.log(F.col("n") - 1.0) + 0.5772156649015329) - 2.0 * (F.col("n") - 1.0) / F.col("n"))
    own = F.element_at("bounds", F.greatest(F.col("feature"), F.lit(0)) + 1)
    constant = F.forall("bounds", lambda b: b["low"] == b["high"])
    leaf = F.col("feature") < 0
    ended = (F.col("depth") == limit) | (F.col("n") == 1) | constant
    counted = nodes.groupBy("tree").agg(F.count("*").alias("n_nodes"))
    return reached.groupBy("tree").agg(
        F.sum(F.when(leaf, F.col("n")).otherwise(0)).alias("n_sampled"), F.count("*").alias("n_reached"),
        F.bool_and(leaf == ended).alias("ends_where_due"),
        F.bool_and(leaf | ((F.col("threshold") >= own["low"]) & (F.col("threshold") < own["high"]))).alias("cuts_in_range"),
        F.bool_and(~leaf | _near(F.col("path_length"), F.col("depth") + usual)).alias("paths_agree"),
    ).join(counted, "tree").select(
        "tree", "n_sampled", (F.col("n_reached") == F.col("n_nodes")).alias("all_reached"), "ends_where_due", "cuts_in_range", "paths_agree")


def _gains(spark: SparkSession, folder: str) -> DataFrame:
    """Every window, whether the gains of its features are those of values exchanged by plain sorting, and its name the largest's."""
    rows, nodes = _forest_parts(spark, folder)
    scorer, columns = anomalies.scorer_of(nodes), list(contracts.FEATURES)
    scored = settle(anomalies.score_windows(rows, scorer), "scored")
    explained = settle(anomalies.explain_windows(scored, scorer), "explained")
    named = anomalies.with_top_feature(scored, explained).select("window_start", "is_anomaly", "top_contributing_feature")
    flagged = scored.filter("is_anomaly").select("window_start", *columns)
    long = flagged.select("*", F.posexplode(F.array(*[F.col(c).cast("double") for c in columns])).alias("f", "value"))

    def ranked(which: str) -> Column:
        return F.row_number().over(Window.partitionBy("f").orderBy(F.xxhash64(F.lit(42), "f", F.lit(which), "window_start"), "window_start"))

    given = long.select("f", "value", ranked("to").alias("nth"))
    exchanged = long.drop("value").withColumn("nth", ranked("from")).join(given, ["f", "nth"]).select(
        "window_start", "f", *[F.when(F.col("f") == i, F.col("value")).otherwise(F.col(c)).alias(c) for i, c in enumerate(columns)])
    again = settle(_walked(settle(exchanged, "exchanged"), nodes, "window_start", "f"), "again")
    gains = again.join(_walked(flagged, nodes).withColumnRenamed("walked", "before"), "window_start").groupBy("window_start").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("f", (F.col("walked") - F.col("before")).alias("gain")))), lambda x: x["gain"]).alias("gains"))
    place = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("top_contributing_feature")).cast("int")
    same = (F.size("gains") == F.size("importances")) & F.forall(F.zip_with("gains", "importances", _near), lambda x: x)
    largest = F.when(place > 0, _near(F.element_at("gains", place), F.array_max("gains")))
    return named.join(explained, "window_start", "left").join(gains, "window_start", "left").select(
        "window_start",
        F.when(F.col("is_anomaly"), F.coalesce(same, F.lit(False))).otherwise(F.col("gains").isNull()).alias("gains_agree"),
        F.when(F.col("is_anomaly"), F.coalesce(largest, F.lit(False))).otherwise(F.col("top_contributing_feature") == "none").alias("largest_is_named"))


def _contributions(spark: SparkSession, folder: str) -> DataFrame:
    rows, nodes = _forest_parts(spark, folder)
    return anomalies.predict_anomalies(rows, nodes)


def _contributions_named(spark: SparkSession, folder: str) -> DataFrame:
    """Every window with its features, and whether a feature is named exactly where the window is flagged."""
    why = F.col("top_contributing_feature")
    return _rounded(_contributions(spark, folder), "avg_severity_rank").select(
        "window_start", "window_end", *contracts.FEATURES,
        F.when(F.col("is_anomaly"), why.isin(*contracts.FEATURES)).otherwise(why == "none").alias("named_where_flagged"))


def _top_contributors(spark: SparkSession, folder: str) -> DataFrame:
    """Whether each flagged window, and no other, has three different features, the first being the one named for it."""
    rows, nodes = _forest_parts(spark, folder)
    scorer = anomalies.scorer_of(nodes)
    scored = settle(anomalies.score_windows(rows, scorer), "scored")
    named = anomalies.predict_anomalies(rows, scorer).filter("is_anomaly").select("window_start", "top_contributing_feature")
    top = anomalies.top_contributors(scored, scorer)
    both = named.join(top, "window_start", "full_outer")
    return both.agg(
        (F.count("*") > 0).alias("some"),
        F.bool_and(F.coalesce(F.size(F.array_distinct("top_features")) == 3, F.lit(False))).alias("three_each"),
        F.bool_and(F.coalesce(F.element_at("top_features", 1) == F.col("top_contributing_feature"), F.lit(False))).alias("first_is_named"))


def _forest_invariants(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold for any forest: range, threshold, names, one row per window."""
    results = _contributions(spark, folder)
    why = F.col("top_contributing_feature")
    named = F.when(F.col("is_anomaly"), why.isin(*contracts.FEATURES)).otherwise(why == "none")
    return results.agg(
        F.count("*").alias("n_windows"),
        F.countDistinct("window_start").alias("n_distinct_windows"),
        F.min("anomaly_score").alias("lowest"),
        F.max("anomaly_score").alias("highest"),
        F.bool_and(F.col("is_anomaly") == (F.col("anomaly_score") < -0.5)).alias("flags_match"),
        F.bool_and(named).alias("names_match"),
    )


def _anomaly_timeline(spark: SparkSession, folder: str) -> DataFrame:
    """Every hour, and whether its score on the chart is that of the second way."""
    rows, nodes = _forest_parts(spark, folder)
    walked = settle(_walked(rows, nodes), "walked")
    low, high = walked.agg(F.min("walked"), F.max("walked")).first()
    chart = gold.anomaly_timeline(anomalies.score_windows(rows, nodes))
    return chart.join(walked, chart["bucket"] == walked["window_start"], "full_outer").select(
        F.coalesce("bucket", "window_start").alias("bucket"),
        F.coalesce(_near(F.col("anomaly_score"), (F.col("walked") - low) * 2.0 / (high - low) - 1.0), F.lit(False)).alias("score_agrees"))


def _training_cut(spark: SparkSession, folder: str) -> DataFrame:
    """The number of windows, and whether the cut is the one that sorted scores of the second way give."""
    rows, nodes = _forest_parts(spark, folder)
    cut = forest.contamination_cut(settle(forest.Scorer(nodes, list(contracts.FEATURES)).add(rows), "scores"), 0.05)
    scores = settle(_walked(rows, nodes), "walked")
    n = scores.count()
    at = 0.05 * (n - 1)
    nth = F.row_number().over(Window.orderBy("walked")) - 1
    low, high = (r[0] for r in scores.withColumn("nth", nth).where(F.col("nth").isin(int(at), int(at) + 1)).orderBy("nth").select("walked").collect())
    below = scores.where(F.col("walked") < low + (at - int(at)) * (high - low) - 1e-12).count()
    return cut.select(
        "n_samples", (F.col("n_anomalies") == below).alias("cut_agrees"),
        (F.abs(F.col("anomaly_percentage") - below / n * 100) <= 0.005001).alias("percentage_agrees"))


def _response_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    """Exact quantiles of the response time, selected in rounds of brackets."""
    minutes = ev.minutes_between(F.col("detection_time"), F.col("resolution_time"))
    rows = settle(silver(spark, folder).select(minutes.alias("minutes")).filter("minutes IS NOT NULL"), "minutes")
    found = [(q, selection.exact_percentile(rows, "minutes", q, accuracy=200, small=100)) for q in (0.0, 0.05, 0.5, 0.95, 1.0)]
    return _rounded(spark.createDataFrame(found, "share double, minutes double"), "minutes")


def _top_users_by_month(spark: SparkSession, folder: str) -> DataFrame:
    """The most attacked users per month: candidates from stored daily sketches, counts exact."""
    path = work_path(spark, "top-users")
    attacks = settle(silver(spark, folder).filter("is_attack_event").select("username", "event_time"), "attacks")
    heavy.top_sketches(attacks, F.to_date("event_time"), "username").write.parquet(path)
    month = lambda column: F.to_date(F.trunc(column, "month"))
    found = heavy.top_values(spark.read.parquet(path), attacks, month("event_time"), "username", month("period"))
    return found.withColumnRenamed("count", "attack_count")


def _summary_of_flags(rows: DataFrame) -> DataFrame:
    flags = features.hourly_features(rows).withColumn("is_anomaly", F.col("attack_event_count") >= 4)
    return gold.anomaly_summary(flags)


def models() -> dict[str, Query]:
    return {
        "minmax_scores": _minmax,
        "confusion_matrix": _on_silver(lambda v: evaluate.confusion_matrix(*_flagged(v))),
        "evaluate_anomalies": _on_silver(lambda v: evaluate.evaluate_anomalies(*_flagged(v))),
        "anomaly_summary": _on_silver(_summary_of_flags),
        "iforest_scores": _iforest_scores,
        "iforest_training_cut": _training_cut,
        "iforest_growth": _grown_trees,
        "response_percentiles": _response_percentiles,
        "anomaly_contributions": _contributions_named,
        "anomaly_top_features": _top_contributors,
        "anomaly_gains": _gains,
        "anomaly_timeline": _anomaly_timeline,
        "iforest_invariants": _forest_invariants,
    }


def _table_of(rows: DataFrame) -> Callable[[str], DataFrame]:
    """Tables by name, derived on demand from Silver."""
    plans = {
        "silver.silver_events": lambda: rows,
        "gold.kpi_summary": lambda: _kpis(rows),
        "gold.attack_volume_by_day": lambda: gold.attack_volume_by_day(rows),
        "gold.attack_volume_by_country": lambda: gold.attack_volume_by_country(rows),
        "gold.hourly_event_summary": lambda: gold.hourly_event_summary(rows),
        "gold.anomaly_results": lambda: features.hourly_features(rows).select(
            "window_start", "window_end", (F.col("attack_event_count") >= 4).alias("is_anomaly"),
            F.round("avg_severity_rank", 6).alias("anomaly_score"), "total_event_count",
            F.lit("attack_event_count").alias("top_contributing_feature"), F.lit("fixed").alias("model_version"),
        ),
    }
    return lambda name: plans[name]()


AS_OF = date(2024, 1, 31)

SEMANTIC = {
    "semantic_kpi": {"measures": ["KpiSummary.slaCompliance", "KpiSummary.avgMttrMinutes"]},
    "semantic_by_day": {
        "measures": ["AttackVolumeByDay.attackCount"],
        "timeDimensions": [{"dimension": "AttackVolumeByDay.eventDate", "granularity": "day",
                            "dateRange": ["2024-01-05", "2024-01-20"]}],
        "order": {"AttackVolumeByDay.eventDate": "asc"},
    },
    "semantic_top_countries": {
        "measures": ["AttackVolumeByCountry.attackCount"],
        "dimensions": ["AttackVolumeByCountry.country"],
        "order": {"AttackVolumeByCountry.attackCount": "asc", "AttackVolumeByCountry.country": "asc"},
        "limit": 4,
    },
    "semantic_hourly": {
        "measures": ["HourlyEventSummary.eventCount", "HourlyEventSummary.uniqueUsers"],
        "timeDimensions": [{"dimension": "HourlyEventSummary.eventHour", "granularity": "day",
                            "dateRange": "Last 14 days"}],
        "filters": [{"member": "HourlyEventSummary.eventType", "operator": "equals", "values": ["vpn_login", "account_lockout"]}],
    },
    "semantic_events": {
        "measures": ["SecurityEvents.count", "SecurityEvents.attackCount"],
        "dimensions": ["SecurityEvents.operatingSystem", "SecurityEvents.dayOfWeek"],
        "filters": [
            {"member": "SecurityEvents.department", "operator": "equals", "values": ["IT", "Legal", "Sales"]},
            {"member": "SecurityEvents.isInternalIp", "operator": "equals", "values": ["true"]},
        ],
        "timeDimensions": [{"dimension": "SecurityEvents.eventTime", "dateRange": "Last 20 days"}],
    },
    "semantic_distinct": {
        "measures": ["SecurityEvents.uniqueIps", "SecurityEvents.uniqueUsers", "SecurityEvents.failedLoginCount"],
        "dimensions": ["SecurityEvents.department", "SecurityEvents.isBusinessHours"],
    },
    "semantic_anomalies": {
        "measures": ["AnomalyResults.count", "AnomalyResults.anomalyCount"],
        "timeDimensions": [{"dimension": "AnomalyResults.windowStart", "granularity": "day"}],
    },
    "semantic_date_filter": {
        "measures": ["AttackVolumeByDay.attackCount", "AttackVolumeByDay.cumulativeAttackCount"],
        "timeDimensions": [{"dimension": "AttackVolumeByDay.eventDate", "granularity": "day"}],
        "filters": [
            {"member": "AttackVolumeByDay.eventDate", "operator": "afterDate", "values": ["2024-01-01"]},
            {"member": "AttackVolumeByDay.eventDate", "operator": "beforeDate", "values": ["2024-01-31"]},
        ],
    },
}


def _semantic(query: dict) -> Query:
    return lambda s, d: semantic_plan.semantic_query(_table_of(silver(s, d)), query, as_of=AS_OF, sep="__")


def _dashboard(rows: DataFrame) -> DataFrame:
    """All multi-select filters at once, then a chart."""
    spec = FilterSpec(
        event_types=("malware_alert", "failed_login", "vpn_login"), severities=("low", "high"),
        countries=("US", "GB", "KP"), date_range="Last 30 days", as_of=AS_OF,
    )
    return gold.events_by_type(apply_filters(rows, spec))


def _calendar(rows: DataFrame) -> DataFrame:
    spec = FilterSpec(departments=("IT", "Legal"), hours=(9, 10, 22), weekdays=(1, 7), months=(1,))
    return gold.hourly_activity(apply_filters(rows, spec))


def _rollup(rows: DataFrame) -> DataFrame:
    return rollups.build_rollup(rows, "day", ("event_type",)).drop("ips_sketch", "users_sketch")


def _stored_rollup(spark: SparkSession, folder: str) -> DataFrame:
    path = work_path(spark, "rollup")
    rollups.write_rollup(silver(spark, folder), path)
    return rollups.query_rollup(rollups.read_rollup(spark, path))


def _is_near(estimate: str, true: str) -> Column:
    """Within 3 %, or by one."""
    return F.abs(F.col(estimate) - F.col(true)) <= F.greatest(F.col(true) * 0.03, F.lit(1))


def _exact(rows: DataFrame, period: Column, name: str, **extra: str) -> DataFrame:
    wanted = {"ips": "src_ip", "users": "username"} | extra
    return rows.groupBy(period.alias(name)).agg(*[F.countDistinct(c).alias(n) for n, c in wanted.items()])


def _rollup_error(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly totals from the stored daily rollup; estimates as "near the exact count"."""
    exact = _exact(silver(spark, folder), F.to_date(F.trunc("event_time", "month")), "month")
    return _stored_rollup(spark, folder).join(exact, "month").select(
        "month", "event_count", "attack_count", "failed_login_count",
        _is_near("approx_unique_ips", "ips").alias("ips_are_near"),
        _is_near("approx_unique_users", "users").alias("users_are_near"),
    )


def _daily_rollup_error(spark: SparkSession, folder: str) -> DataFrame:
    """The same by day, as stored."""
    path = work_path(spark, "rollup")
    rollups.write_rollup(silver(spark, folder), path)
    days = rollups.query_rollup(rollups.read_rollup(spark, path), ("period",))
    return days.join(_exact(silver(spark, folder), F.date_trunc("day", "event_time").cast("timestamp_ntz"), "period"), "period").select(
        "period", "event_count", "attack_count", "failed_login_count",
        _is_near("approx_unique_ips", "ips").alias("ips_are_near"),
        _is_near("approx_unique_users", "users").alias("users_are_near"),
    )


def _preagg_distinct(spark: SparkSession, folder: str) -> DataFrame:
    """Weekly distinct counts from the stored pre-aggregate, as "near the exact count"."""
    weeks = _stored_pre_aggregate("SecurityEvents", "daily", ["uniqueIps", "uniqueUsers"], "week")(spark, folder)
    exact = _exact(silver(spark, folder), F.date_trunc("week", "event_time").cast("timestamp_ntz"), "period")
    return weeks.join(exact, "period").select(
        "period", _is_near("uniqueIps", "ips").alias("ips_are_near"), _is_near("uniqueUsers", "users").alias("users_are_near"))


def _stored_pre_aggregate(cube: str, name: str, measures: list[str], granularity: str) -> Query:
    """Store a cube's rollup, then answer a coarser question from it."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        path = work_path(spark, "pre-aggregate")
        table = _table_of(silver(spark, folder))(semantic_plan.CUBES[cube].table)
        rows = rollups.pre_aggregate(table, cube, name)
        writer = rows.write.partitionBy("month") if "month" in rows.columns else rows.write
        writer.parquet(path)
        return rollups.query_pre_aggregate(rollups.read_rollup(spark, path), cube, measures, granularity)

    return run


def _partials(dimensions: tuple[str, ...], then: Callable[[DataFrame], DataFrame]) -> Query:
    """Store the daily partial states, then answer from the stored rows alone."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        path = work_path(spark, "partials")
        partials.write_by_month(partials.build_partials(silver(spark, folder), dimensions), path)
        return then(partials.read_by_month(spark, path))

    return run


def _kpis_by_week(stored: DataFrame) -> DataFrame:
    return _rounded(partials.query_partials(stored, "week"), "avg_mttd_minutes", "avg_mttr_minutes", "avg_severity_rank")


def _monthly_moments(stored: DataFrame) -> DataFrame:
    """Of both measured columns by department, from the days of a month."""
    found = [partials.merge_moments(stored, m, "month", ("department",)).withColumn("measured", F.lit(m)) for m in partials.MEASURED]
    return _rounded(found[0].unionByName(found[1]), "mean", "deviation")


def _exact_distinct(spark: SparkSession, folder: str) -> DataFrame:
    """Different addresses, users and countries per day, week and month, from stored daily sets."""
    events, found = settle(silver(spark, folder), "silver"), []
    for which in partials.SETS:
        path = work_path(spark, f"sets-{which}")
        partials.write_by_month(partials.build_sets(events, which), path)
        sets = partials.read_by_month(spark, path)
        for grain in ("day", "week", "month"):
            counted = partials.count_sets(sets, which, grain).withColumnRenamed(f"unique_{which}", "unique_values")
            found.append(counted.withColumns({"grain": F.lit(grain), "which": F.lit(which)}))
    return functools.reduce(DataFrame.unionByName, found)


def _round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Silver written in three formats and read again: its rows once per format."""
    rows, base = settle(silver(spark, folder), "silver"), work_path(spark, "export")
    paths = tables.export(rows, base, ("jsonl", "parquet", "csv"))
    back = {
        "jsonl": tables.read_jsonl(spark, paths["jsonl"], contracts.SILVER), "parquet": spark.read.parquet(paths["parquet"]),
        "csv": tables.read_csv(spark, paths["csv"], contracts.SILVER)}
    found = [df.select(*contracts.SILVER.fieldNames(), F.lit(kind).alias("format")) for kind, df in back.items()]
    return functools.reduce(DataFrame.unionByName, found)


def _mart_from_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Attack volume by country, exported as one sorted CSV file and read with its contract."""
    path = work_path(spark, "mart")
    tables.export_mart(gold.attack_volume_by_country(silver(spark, folder)), path, [F.desc("attack_count"), "country"])
    return tables.read_csv(spark, path, contracts.ATTACK_VOLUME_BY_COUNTRY)


def _evolved(spark: SparkSession, folder: str) -> DataFrame:
    """Files of an older contract (a name, a narrower type, a column more, one less) read as today's."""
    old = silver(spark, folder).select(
        F.col("event_id").alias("id"), F.to_date("event_time").alias("event_time"), "severity_rank", "username", "country")
    path = work_path(spark, "older")
    old.write.parquet(path)
    today = contracts.T.StructType([
        contracts.T.StructField("event_id", contracts.T.StringType()), contracts.T.StructField("event_time", contracts.T.TimestampNTZType()),
        contracts.T.StructField("severity_rank", contracts.T.LongType()), contracts.T.StructField("country", contracts.T.StringType()),
        contracts.T.StructField("department", contracts.T.StringType())])
    return contracts.evolve(spark.read.parquet(path), today, {"id": "event_id"}, ("username",))


def _dispositions(spark: SparkSession, folder: str) -> DataFrame:
    """Rows in a table after each way to write it: absent, replaced, appended, merged, replaced by less."""
    rows, path = settle(silver(spark, folder), "silver"), work_path(spark, "dispositions")
    early = rows.filter("event_time < TIMESTAMP_NTZ '2024-01-15 00:00:00'")
    order, steps = dedup.newest_first(rows), [("absent", None, None)]
    steps += [("replace", early, None), ("append", rows, None), ("merge", rows, ["event_id"]), ("replace again", early, None)]
    counts = []
    for step, df, keys in steps:
        if df is not None:
            tables.write_table(df, path, step.split()[0], keys, order if keys else None)
        counts.append((step, tables.row_count(spark, path)))
    return spark.createDataFrame(counts, "step string, row_count long")


def _stored_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    """Checked features with stand-in flags, stored as anomaly results under a version and read back."""
    rows, base = settle(features.hourly_features(silver(spark, folder)), "features"), work_path(spark, "anomalies")
    checked = features.validate_features(rows, min_windows=24)
    results = rows.withColumns({
        "anomaly_score": F.col("attack_event_count") / -100.0, "is_anomaly": F.col("attack_event_count") >= 4,
        "top_contributing_feature": F.when(F.col("attack_event_count") >= 4, "attack_event_count").otherwise("none")})
    for version in ("v1", "v2"):
        written = anomalies.persist_results(results, base, version)
    return _rounded(tables.read_table(spark, tables.table_path(base, "gold.anomaly_results"), contracts.ANOMALY_RESULTS), "avg_severity_rank").withColumns(
        {"rows_checked": F.lit(checked).cast("long"), "rows_written": F.lit(written).cast("long")})


def storing() -> dict[str, Query]:
    return {
        "export_round_trip": _round_trip, "mart_from_csv": _mart_from_csv, "evolved_events": _evolved,
        "run_history": _run_history, "write_dispositions": _dispositions, "stored_anomalies": _stored_anomalies,
    }


def semantic() -> dict[str, Query]:
    found = {name: _semantic(query) for name, query in SEMANTIC.items()}
    return found | {
        "dashboard_filters": _on_silver(_dashboard),
        "calendar_filters": _on_silver(_calendar),
        "rollup_daily": _on_silver(_rollup),
        "approx_daily_rollup": _daily_rollup_error,
        "rollup_monthly": _rollup_error,
        "preagg_attack_volume": _stored_pre_aggregate(
            "AttackVolumeByDay", "daily", ["attackCount", "cumulativeAttackCount"], "week"),
        "preagg_hourly_summary": _stored_pre_aggregate(
            "HourlyEventSummary", "hourly", ["eventCount", "uniqueIps", "uniqueUsers"], "day"),
        "preagg_security_events": _stored_pre_aggregate(
            "SecurityEvents", "daily", ["count", "attackCount", "failedLoginCount"], "month"),
        "preagg_security_distinct": _preagg_distinct,
        "rollup_exact_distinct": _exact_distinct,
        "rollup_top_users": _top_users_by_month,
        "rollup_kpis": _partials((), _kpis_by_week),
        "rollup_moments": _partials(("department",), _monthly_moments),
        "rollup_country_scores": _partials(("country",), lambda p: partials.country_scores(p, "week")),
    }


def _dq_bronze(spark: SparkSession, folder: str) -> DataFrame:
    rows = bronze(spark, folder)
    name = "bronze.security_events"
    return quality.report(
        quality.unique(rows, name, "event_id"),
        quality.row_checks(
            rows, name,
            quality.not_null(["event_id", "event_time", "src_ip", "destination_ip", "detection_time"])
            + quality.accepted_values({"event_type": contracts.EVENT_TYPES, "severity": contracts.SEVERITIES}),
        ),
        quality.relationship(rows, name, "event_id", silver(spark, folder), "event_id"),
    )


def _gate(rows: DataFrame) -> DataFrame:
    """Whether the share of flagged windows is plausible, for a lax, the usual and a strict flag."""
    windows_ = settle(features.hourly_features(rows), "windows")
    flags = {"lax": 1, "usual": 4, "strict": 1_000_000}
    return quality.report(*[
        quality.anomaly_share(windows_.withColumn("is_anomaly", F.col("attack_event_count") >= n)).withColumn("flag", F.lit(name))
        for name, n in flags.items()])


def _dq_report(spark: SparkSession, folder: str) -> DataFrame:
    """The checks read stored tables, so Silver is stored first."""
    rows = settle(silver(spark, folder), "silver")
    table = _table_of(rows)
    names = ("kpi_summary", "attack_volume_by_day", "attack_volume_by_country", "hourly_event_summary")
    return quality_plan.dq_report(rows, {f"gold.{n}": table(f"gold.{n}") for n in names})


def _freshness(spark: SparkSession, folder: str) -> DataFrame:
    rows = silver(spark, folder)
    layers = {
        "bronze": (bronze(spark, folder), "_ingested_at"),
        "silver": (rows, "event_time"),
        "gold": (gold.hourly_event_summary(rows), "event_hour"),
    }
    return quality.freshness(layers, datetime(2024, 1, 31, 0, 4))


def checking() -> dict[str, Query]:
    return {
        "dq_bronze": _dq_bronze,
        "dq_silver": _on_silver(lambda v: quality_plan.silver_checks(v).filter("check <> 'contract'")),
        "dq_report": _dq_report,
        "anomaly_gate": _on_silver(_gate),
        "freshness": _freshness,
    }


def _bronze_stream(spark: SparkSession, folder: str) -> DataFrame:
    schema = bridge.read_events(use_utc(spark), folder).schema
    return bridge.bronze_from_events(stream.stream_table(spark, folder, schema, "events.parquet"))


def _drained(spark: SparkSession, name: str, start: Callable[[str, str], object]) -> str:
    """Run a stream until its input is used up; returns the output path."""
    path = work_path(spark, name)
    start(path, f"{path}-checkpoint").awaitTermination()
    return path


def _stream_upsert(
    build: Callable[[DataFrame], DataFrame], keys: list[str], name: str, day_of: str | None = None
) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        rows = build(stream.stream_clean(_bronze_stream(spark, folder)))
        path = _drained(spark, name, lambda p, c: sinks.upsert_stream(rows, p, c, keys, day_of))
        return tables.scan(spark, path).select(*rows.columns)

    return run


def _stream_append(build: Callable[[DataFrame], DataFrame], name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        rows = build(_bronze_stream(spark, folder))
        path = _drained(spark, name, lambda p, c: sinks.append_stream(rows, p, c))
        return spark.read.schema(rows.schema).parquet(path)

    return run


def _stream_lockouts(rows: DataFrame) -> DataFrame:
    clean = stream.stream_clean(rows)
    return windows.lockout_stream(clean, clean, 60, 86_400, keys=("country", "department", "operating_system"))


def _stream_silver(spark: SparkSession, folder: str) -> DataFrame:
    rows = _bronze_stream(spark, folder)
    base = _drained(spark, "stream-silver", lambda p, c: sinks.silver_stream(rows, p, c))
    return tables.read_table(spark, tables.table_path(base, "silver.silver_events"), contracts.SILVER)


def _stream_late(spark: SparkSession, folder: str) -> DataFrame:
    rows = stream.readable_times(_bronze_stream(spark, folder)).select("event_id", "_batch_id", "ts")
    path = _drained(spark, "stream-late", lambda p, c: sinks.split_late(rows, p, c))
    kept = spark.read.parquet(f"{path}/on_time").select("event_id", F.lit("on_time").alias("outcome"))
    return kept.unionByName(spark.read.parquet(f"{path}/late").select("event_id", F.lit("late").alias("outcome")))


def _stream_hourly(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly rows of the stream; estimates as "near the exact count"."""
    got = _stream_upsert(windows.hourly_stream, ["event_hour", "event_type"], "stream-hourly", day_of="event_hour")(spark, folder)
    exact = stream.stream_clean(bronze(spark, folder)).groupBy(
        F.date_trunc("hour", "event_time").cast("timestamp_ntz").alias("event_hour"), "event_type").agg(
        F.countDistinct("src_ip").alias("ips"), F.countDistinct("username").alias("users"))
    return got.join(exact, ["event_hour", "event_type"]).select(
        "event_hour", "event_type", "event_count",
        _is_near("approx_unique_ips", "ips").alias("ips_are_near"), _is_near("approx_unique_users", "users").alias("users_are_near"))


_YEAR = 365 * 86_400


_FILE_ROWS = 1 << 17


def _dealt(spark: SparkSession, folder: str, batches: int, batch: Column, rows: DataFrame | None = None) -> DataFrame:
    """All Bronze rows as a stream of so many micro-batches; ``batch`` numbers them from 0.

    Every micro-batch has the same number of files, about _FILE_ROWS rows each in the largest: a stream takes
    files by their age, so many at a time.
    """
    rows, path = bronze(spark, folder) if rows is None else rows, work_path(spark, "dealt")
    rows.withColumn("_number", batch.cast("int")).filter(F.col("_number").between(0, batches - 1)).write.partitionBy(
        "_number").parquet(f"{path}/all")
    dealt = spark.read.schema(f"{exact._ddl(rows)}, _number int").parquet(f"{path}/all")
    counts = {r["_number"]: r["count"] for r in dealt.groupBy("_number").count().collect()}
    each = max(1, -(-max(counts.values(), default=0) // _FILE_ROWS))
    none = spark.createDataFrame([], rows.schema).coalesce(1)
    for n in range(batches):
        kept = dealt.filter(F.col("_number") == n).select(*rows.columns)
        if counts.get(n):
            kept.repartition(min(each, counts[n])).write.mode("append").parquet(f"{path}/files")
        while len(_part_files(spark, f"{path}/files")) < each * (n + 1):
            none.write.mode("append").parquet(f"{path}/files")
    return stream.stream_table(spark, f"{path}/files", rows.schema, max_files=each)


def _part_files(spark: SparkSession, path: str) -> list[str]:
    return [n for n in files.children(spark, path) if n.startswith("part-")]


def _mixed(batches: int) -> Column:
    """Versions of an event fall into any micro-batches, the older one sometimes into the later."""
    return F.pmod(F.xxhash64("event_id", "_batch_id"), F.lit(batches))


def _logged(spark: SparkSession, stream_rows: DataFrame, name: str) -> str:
    return _drained(spark, name, lambda p, c: sinks.log_stream(stream_rows, p, c))


def _stream_features(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly features over five micro-batches that versions of events are scattered over."""
    signed = exact.versions(_dealt(spark, folder, 5, _mixed(5)), exact.FEATURE_COLUMNS, horizon=_YEAR)
    path = _logged(spark, exact.hourly_features(signed, horizon=_YEAR), "stream-features")
    return _rounded(sinks.newest_rows(spark, path, ["window_start"], "total_event_count"), "avg_severity_rank")


def _stream_hourly_table(spark: SparkSession, folder: str) -> DataFrame:
    """The hourly summary, likewise."""
    signed = exact.versions(_dealt(spark, folder, 5, _mixed(5)), exact.SUMMARY_COLUMNS, horizon=_YEAR)
    path = _logged(spark, exact.hourly_summary(signed, horizon=_YEAR), "stream-table")
    return sinks.newest_rows(spark, path, ["event_hour", "event_type"], "event_count")


def _stream_corrections(spark: SparkSession, folder: str) -> DataFrame:
    """Signed rows added up: what is left of every event is its newest version, if that is valid."""
    columns = ["username", "src_ip", "event_type", "severity_rank"]
    signed = exact.versions(_dealt(spark, folder, 3, _mixed(3)), columns, horizon=_YEAR)
    logged = spark.read.parquet(_logged(spark, signed, "stream-corrections"))
    return logged.groupBy("event_id", *columns).agg(F.sum("sign").alias("n")).filter("n <> 0")


def _stream_keyed_table(spark: SparkSession, folder: str) -> DataFrame:
    """The newest version of every event in a bucketed table that three micro-batches are merged into."""
    rows, name = _dealt(spark, folder, 3, _mixed(3)), _table_name()
    _drained(spark, name, lambda p, c: sinks.keyed_stream(rows, name, c, ["event_id"], dedup.newest_first(rows), 8))
    return spark.table(name)


def _in_time_order(batches: int, days: int) -> Column:
    """By the day a row arrived; every tenth key comes one micro-batch late."""
    late = F.when(F.pmod(F.regexp_extract("event_id", "[0-9]+", 0).cast("long"), F.lit(10)) == 0, 1).otherwise(0)
    first = F.floor(F.datediff(F.to_date("_ingested_at"), F.lit("2024-01-01").cast("date")) / days)
    return F.least(F.lit(batches - 1), F.greatest(F.lit(0), first) + late)


def _stream_late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows over five micro-batches in time order, some behind; late ones by the query's own watermark."""
    rows = stream.readable_times(_dealt(spark, folder, 5, _in_time_order(5, 6))).select("event_id", "_batch_id", "ts")
    path = _drained(spark, "stream-late-rows", lambda p, c: sinks.log_stream(exact.route_late(rows), p, c, partition="is_late"))
    return spark.read.parquet(path).select(
        "event_id", "_batch_id", F.col("stream_batch").cast("long").alias("stream_batch"), F.col("is_late").cast("boolean").alias("is_late"))


def _stream_burst_moments(spark: SparkSession, folder: str) -> DataFrame:
    """Moments with two failed logins within a day, from five micro-batches in time order."""
    columns = ["src_ip", "event_type"]
    signed = exact.versions(_dealt(spark, folder, 5, _in_time_order(5, 6)), columns, delay="10 days", horizon=_YEAR)
    path = _logged(spark, exact.burst_moments(signed, threshold=2, minutes=24 * 60), "stream-moments")
    return spark.read.parquet(path).drop("stream_batch")


def _full_lines(spark: SparkSession, folder: str, path: str, files: int, mode: str = "append", where: str = "true") -> None:
    """Whole records, all 14 fields, as files of lines."""
    chosen = bridge.read_events(use_utc(spark), folder).where(where)
    bridge.raw_records(chosen).repartition(files).write.mode(mode).text(path)


def _stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """All records through the ingest stream, a file per micro-batch, stopped and started once: Bronze."""
    path = work_path(spark, "stream-ingest")
    for _ in range(2):
        _full_lines(spark, folder, f"{path}/raw", 2, where="event_id % 2 = " + str(_))
        lines = stream.stream_lines(spark, f"{path}/raw", max_files=1, pattern="*.txt")
        sinks.ingest_stream(lines, f"{path}/base", f"{path}/check").awaitTermination()
    return tables.read_table(spark, tables.table_path(f"{path}/base", "bronze.security_events"), contracts.BRONZE).select(
        *contracts.SOURCE_FIELDS, F.col("_batch_id").rlike("^batch_[0-9]{8}_00[1-4]_[0-9a-f]{8}$").alias("batch_is_named"))


def _stream_dead_letters(spark: SparkSession, folder: str) -> DataFrame:
    """Broken lines through the ingest stream, a file per micro-batch: dead letters."""
    path = work_path(spark, "stream-dead")
    bridge.raw_json_lines(bridge.read_events(use_utc(spark), folder)).repartition(3).write.text(f"{path}/raw")
    lines = stream.stream_lines(spark, f"{path}/raw", max_files=1, pattern="*.txt")
    sinks.ingest_stream(lines, f"{path}/base", f"{path}/check").awaitTermination()
    stored = tables.read_table(spark, tables.table_path(f"{path}/base", "bronze.dead_letter_events"), contracts.DEAD_LETTER)
    return stored.select("event_id", "raw_record", "error_reason")


def _incremental_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs over a folder that grows: each takes its new files only, as the ingest times show."""
    path = work_path(spark, "incremental")
    for day in (1, 2, 3):
        if day < 3:
            _full_lines(spark, folder, f"{path}/raw", 2, where=f"event_id % 2 = {day - 1}")
        ingest.ingest(spark, f"{path}/raw", f"{path}/base", now=datetime(2024, 2, day), pattern="*.txt", only_new=True)
    return tables.read_table(spark, tables.table_path(f"{path}/base", "bronze.security_events"), contracts.BRONZE).select(
        *contracts.SOURCE_FIELDS, "_ingested_at")


def _run_history(spark: SparkSession, folder: str) -> DataFrame:
    """What is noted of two whole runs over a folder that grows; the second counts every stage as slow."""
    path = work_path(spark, "history")
    for odd, limit in ((0, 1e9), (1, 0.0)):
        _full_lines(spark, folder, f"{path}/raw", 2, where=f"event_id % 2 = {odd}")
        pipeline.run_pipeline(spark, f"{path}/raw", f"{path}/base", slow_after=limit, pattern="*.txt")
    runs = tables.read_table(spark, tables.table_path(f"{path}/base", "pipeline_runs"), contracts.PIPELINE_RUNS)
    slow = quality.slow_stages(runs).select("run_id", F.lit(True).alias("is_slow"))
    return runs.join(slow, "run_id", "left").select(
        F.row_number().over(Window.orderBy("start_time")).alias("run"), "stages_completed", "stages_failed",
        "records_ingested", "records_transformed", "records_rejected", "slow_stages", F.coalesce("is_slow", F.lit(False)).alias("is_slow"),
        (F.col("end_time") >= F.col("start_time")).alias("ends_after_start"))


def _merge_older_last(spark: SparkSession, folder: str) -> DataFrame:
    """Second versions are merged first, first versions last: the newest of each event stays."""
    rows, path = bronze(spark, folder), work_path(spark, "older-last")
    for version in ("_002", "_001"):
        part = rows.filter(F.col("_batch_id").endswith(version)).withColumn("day", F.to_date("_ingested_at"))
        tables.write_table(part, path, "merge", ["event_id"], dedup.newest_first(rows), partition="day")
    return tables.scan(spark, path).select(*rows.columns)


def streams() -> dict[str, Query]:
    return {
        "stream_hourly": _stream_hourly,
        "stream_ingest": _stream_ingest,
        "stream_dead_letters": _stream_dead_letters,
        "stream_hourly_counts": _stream_upsert(
            lambda r: windows.hourly_stream(r).drop("approx_unique_ips", "approx_unique_users"),
            ["event_hour", "event_type"], "stream-counts", day_of="event_hour"),
        "stream_features": _stream_features,
        "stream_features_exact": _stream_upsert(
            lambda r: windows.feature_stream(r).drop("unique_src_ips", "unique_users", "unique_countries")
            .withColumn("avg_severity_rank", F.round("avg_severity_rank", 6)),
            ["window_start"], "stream-features"),
        "stream_bursts": _stream_upsert(
            lambda r: windows.burst_stream(r, threshold=2, window="12 hours", slide="3 hours"),
            ["src_ip", "window_start"], "stream-bursts"),
        "stream_sessions": _stream_append(
            lambda r: windows.failure_session_stream(stream.stream_clean(r), gap="2 days"), "stream-sessions"),
        "stream_lockouts": _stream_append(_stream_lockouts, "stream-lockouts"),
        "stream_dedup": _stream_append(
            lambda r: windows.dedup_stream(stream.readable_times(r)).select("event_id", "event_type"), "stream-dedup"),
        "stream_hourly_table": _stream_hourly_table,
        "stream_corrections": _stream_corrections,
        "stream_keyed_table": _stream_keyed_table,
        "stream_late_rows": _stream_late_rows,
        "stream_burst_moments": _stream_burst_moments,
        "stream_silver": _stream_silver,
        "stream_late_split": _stream_late,
    }
