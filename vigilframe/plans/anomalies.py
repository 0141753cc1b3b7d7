"""Train, score, explain and store hourly anomalies."""

from __future__ import annotations

import time
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from vigilframe.operators import forest
from vigilframe.operators.contributions import feature_importances, top_feature, top_features
from vigilframe.plans.features import check_feature_columns, hourly_features, validate_features
from vigilframe.session import settle
from vigilframe.sources import files
from vigilframe.sources.contracts import ANOMALY_RESULTS, ANOMALY_VIEW, FEATURES, conform
from vigilframe.sources.tables import read_table, row_count, table_path, write_table

KEY = "window_start"
KEEP_MODELS = 5


@dataclass(frozen=True)
class TrainingConfig:
    n_estimators: int = 100
    contamination: float = 0.05
    random_state: int = 42
    max_samples: int = 256


@dataclass(frozen=True)
class TrainingResult:
    model_path: str
    model_version: str
    n_samples_trained: int
    n_anomalies_detected: int
    anomaly_percentage: float
    training_duration_seconds: float
    contamination_parameter: float
    n_estimators: int
    within_expected_range: bool


def train_model(
    features: DataFrame, model_dir: str, config: TrainingConfig = TrainingConfig(), now: datetime | None = None
) -> TrainingResult:
    """Fit a forest, store its node table under a version, report the contamination cut."""
    check_feature_columns(features, windows=False)
    spark, started = features.sparkSession, time.time()
    version = (now or datetime.now(timezone.utc)).strftime("%Y%m%d_%H%M%S")
    path = f"{model_dir.rstrip('/')}/isolation_forest_v{version}"
    forest.fit(
        features, list(FEATURES), KEY, config.n_estimators, config.max_samples, config.random_state
    ).write.mode("overwrite").parquet(path)
    seconds = time.time() - started
    _drop_old_models(spark, model_dir)
    scored = settle(forest.Scorer(load_model(spark, path), list(FEATURES)).add(features).select("raw_score"), "training-scores")
    found = forest.contamination_cut(scored, config.contamination).first()
    return TrainingResult(
        path, version, found["n_samples"], found["n_anomalies"], found["anomaly_percentage"],
        round(seconds, 3), config.contamination, config.n_estimators,
        1.0 <= found["anomaly_percentage"] <= 15.0,
    )


def _drop_old_models(spark: SparkSession, model_dir: str, keep: int = KEEP_MODELS) -> None:
    versions = [n for n in files.children(spark, model_dir) if n.startswith("isolation_forest_v")]
    for name in versions[:-keep]:
        files.remove(spark, f"{model_dir.rstrip('/')}/{name}")


def load_model(spark: SparkSession, path: str) -> DataFrame:
    if not files.is_complete(spark, path):
        raise FileNotFoundError(f"no finished model at {path}")
    return spark.read.schema(forest.NODE_SCHEMA).parquet(path)


def scorer_of(nodes: DataFrame | forest.Scorer) -> forest.Scorer:
    """A forest read and shipped once; the functions below take one in place of its nodes."""
    return nodes if isinstance(nodes, forest.Scorer) else forest.Scorer(nodes, list(FEATURES))


def score_windows(features: DataFrame, nodes: DataFrame | forest.Scorer, threshold: float = -0.5) -> DataFrame:
    """Features plus ``anomaly_score`` in [-1, 1] and ``is_anomaly`` (strictly below the threshold)."""
    check_feature_columns(features)
    raw = settle(scorer_of(nodes).add(features), "scores")
    scored = forest.minmax_scores(raw, "raw_score", "anomaly_score")
    return scored.withColumn("is_anomaly", F.col("anomaly_score") < threshold)


def explain_windows(scored: DataFrame, nodes: DataFrame | forest.Scorer, seed: int = 42) -> DataFrame:
    """(window_start, importances) of the anomalous windows."""
    return feature_importances(scored.filter("is_anomaly"), scorer_of(nodes), KEY, seed=seed)


def predict_anomalies(features: DataFrame, nodes: DataFrame | forest.Scorer, threshold: float = -0.5) -> DataFrame:
    """Scored windows with their top contributing feature ("none" where not anomalous)."""
    scorer = scorer_of(nodes)
    scored = score_windows(features, scorer, threshold)
    return with_top_feature(scored, explain_windows(scored, scorer))


def with_top_feature(scored: DataFrame, explained: DataFrame) -> DataFrame:
    why = explained.select(KEY, top_feature(F.col("importances"), list(FEATURES)).alias("top_contributing_feature"))
    return scored.join(why, KEY, "left").select(
        "window_start", "window_end", "anomaly_score", "is_anomaly",
        F.coalesce("top_contributing_feature", F.lit("none")).alias("top_contributing_feature"),
        *FEATURES,
    )


def top_contributors(scored: DataFrame, nodes: DataFrame | forest.Scorer, n: int = 3) -> DataFrame:
    """The ``n`` features that contribute most to each anomalous window."""
    return top_of(explain_windows(scored, nodes), n)


def top_of(explained: DataFrame, n: int = 3) -> DataFrame:
    return explained.select(KEY, top_features(F.col("importances"), list(FEATURES), n).alias("top_features"))


def persist_results(results: DataFrame, base: str, version: str) -> int:
    """Replace ``gold.anomaly_results``; returns the rows written."""
    path = table_path(base, "gold.anomaly_results")
    rows = conform(results.withColumn("model_version", F.lit(version)), ANOMALY_RESULTS)
    write_table(rows, path)
    return row_count(results.sparkSession, path)


def detect_anomalies(
    spark: SparkSession, base: str, silver: DataFrame,
    config: TrainingConfig = TrainingConfig(), threshold: float = -0.5,
) -> dict:
    """Features, training, scoring and storing in one go.

    The results go to ``gold.anomaly_results``, the three features that contribute most to
    each anomalous window to ``gold.anomaly_top_features``.
    """
    features = settle(hourly_features(silver), "features")
    validate_features(features)
    trained = train_model(features, f"{base.rstrip('/')}/models", config)
    scorer = scorer_of(load_model(spark, trained.model_path))
    scored = settle(score_windows(features, scorer, threshold), "scored")
    explained = settle(explain_windows(scored, scorer), "explained")
    written = persist_results(with_top_feature(scored, explained), base, trained.model_version)
    write_table(top_of(explained), table_path(base, "gold.anomaly_top_features"))
    return {"training": trained, "rows_written": written}


def anomaly_view(spark: SparkSession, base: str) -> DataFrame:
    """The seven promised columns of ``gold.anomaly_results``."""
    return read_table(spark, table_path(base, "gold.anomaly_results"), ANOMALY_RESULTS).select(*ANOMALY_VIEW)
