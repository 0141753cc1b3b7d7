from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from checks.queries import grown
from tests.helpers import BASE, at, silver
from vigilframe.operators import evaluate, forest
from vigilframe.operators.contributions import top_feature, top_features
from vigilframe.plans import anomalies as an
from vigilframe.plans.features import hourly_features, validate_features
from vigilframe.plans.gold import anomaly_summary
from vigilframe.session import settle
from vigilframe.sources import files
from vigilframe.sources.contracts import ANOMALY_RESULTS, ANOMALY_VIEW, FEATURES, contract_violations
from vigilframe.sources.tables import read_table, table_path

N, PLANTED = 300, (17, 101, 230)


@pytest.fixture(scope="module")
def features(spark):
    """300 ordinary hours and three in which everything is far too large."""
    rng = random.Random(7)
    rows = []
    for i in range(N):
        big = 20 if i in PLANTED else 1
        start = BASE + timedelta(hours=i)
        rows.append((start, start + timedelta(hours=1), *[
            float((rng.random() * 0.5 + 0.1) if "ratio" in c else big * rng.randrange(20, 40)) for c in FEATURES
        ]))
    names = ", ".join(f"{c} double" for c in FEATURES)
    return settle(spark.createDataFrame(rows, f"window_start timestamp_ntz, window_end timestamp_ntz, {names}"), "t")


@pytest.fixture(scope="module")
def nodes(features):
    return settle(forest.fit(features, list(FEATURES), "window_start", n_trees=50), "t")


@pytest.fixture(scope="module")
def results(features, nodes):
    return settle(an.predict_anomalies(features, nodes), "t")


def test_planted_outliers_rank_lowest(results):
    lowest = results.orderBy("anomaly_score").limit(3).collect()
    assert {r["window_start"] for r in lowest} == {BASE + timedelta(hours=i) for i in PLANTED}
    assert all(r["is_anomaly"] and r["top_contributing_feature"] in FEATURES for r in lowest)


def test_score_range_and_flag(results):
    rows = results.collect()
    assert len(rows) == N
    assert min(r["anomaly_score"] for r in rows) == -1.0 and max(r["anomaly_score"] for r in rows) == 1.0
    for r in rows:
        assert r["is_anomaly"] == (r["anomaly_score"] < -0.5)
        assert (r["top_contributing_feature"] == "none") != r["is_anomaly"]


def test_same_forest_and_scores_however_partitioned(features, rows):
    forests = [forest.fit(features.repartition(p), list(FEATURES), "window_start", n_trees=5) for p in (1, 13)]
    assert rows(forests[0]) == rows(forests[1])
    other = forest.fit(features, list(FEATURES), "window_start", n_trees=5, seed=1)
    assert rows(other) != rows(forests[0])
    scorer = forest.Scorer(settle(forests[0], "t"), list(FEATURES))
    assert rows(scorer.add(features.repartition(1))) == rows(scorer.add(features.repartition(13)))


def test_forest_shape(nodes):
    stats = nodes.groupBy("tree").agg(F.count("*").alias("n"), F.sum((F.col("feature") < 0).cast("int")).alias("leaves")).collect()
    assert len(stats) == 50
    for s in stats:
        assert s["n"] == 2 * s["leaves"] - 1 and s["leaves"] <= 256
    assert nodes.agg(F.max("sample_size")).first()[0] == 256


def _judged(features, nodes):
    checks = ("all_reached", "ends_where_due", "cuts_in_range", "paths_agree")
    return {(r["tree"], c) for r in grown(features, nodes, 50).collect() for c in checks if not r[c]}


def test_trees_are_grown_from_the_rows_that_reach_their_nodes(features, nodes):
    for r in grown(features, nodes, 50).collect():
        assert r["n_sampled"] == 256 and r["all_reached"] and r["ends_where_due"] and r["cuts_in_range"] and r["paths_agree"]


def test_wrong_trees_are_seen(features, nodes):
    root, of = (F.col("tree") == 3) & (F.col("node") == 0), lambda column, value: F.when(root, value).otherwise(F.col(column))
    assert (3, "cuts_in_range") in _judged(features, nodes.withColumn("threshold", of("threshold", F.lit(-5.0))))
    longer = F.when((F.col("tree") == 4) & (F.col("feature") < 0), F.col("path_length") + 1).otherwise(F.col("path_length"))
    assert _judged(features, nodes.withColumn("path_length", longer)) == {(4, "paths_agree")}
    assert (3, "ends_where_due") in _judged(features, nodes.withColumn("feature", of("feature", F.lit(-1))))


def test_sampling_gives_every_tree_its_rows(spark):
    big = spark.range(20_000).select("id", *[F.rand(i).alias(c) for i, c in enumerate(FEATURES)])
    drawn = forest.sample_for_trees(big, list(FEATURES), "id", 20, 64, 42, 20_000)
    assert {r["count"] for r in drawn.groupBy("tree").count().collect()} == {64}


def test_not_a_forest(spark, nodes):
    with pytest.raises(ValueError, match="not a forest"):
        forest.Scorer(nodes.union(nodes).union(nodes), list(FEATURES))


def test_constant_rows_score_zero(spark):
    one = spark.createDataFrame([(at(i), at(i + 1), *[1.0] * 10) for i in range(5)],
                                f"window_start timestamp_ntz, window_end timestamp_ntz, {', '.join(f'{c} double' for c in FEATURES)}")
    fitted = forest.fit(one, list(FEATURES), "window_start", n_trees=3)
    got = an.predict_anomalies(one, fitted).collect()
    assert {r["anomaly_score"] for r in got} == {0.0} and {r["top_contributing_feature"] for r in got} == {"none"}


def test_single_anomaly_has_the_first_feature(features, nodes):
    """A permutation of one row changes nothing, so all importances are equal."""
    scored = an.score_windows(features, nodes)
    lowest = scored.agg(F.min("anomaly_score")).first()[0]
    only = scored.withColumn("is_anomaly", F.col("anomaly_score") == lowest)
    why = an.explain_windows(only, nodes).collect()
    assert len(why) == 1 and why[0]["importances"] == [0.0] * 10
    assert an.top_contributors(only, nodes).first()["top_features"] == list(FEATURES[:3])


def test_importances_exchange_values_within_the_anomalous_rows(features, nodes):
    scored = an.score_windows(features, nodes, threshold=0.0)
    why = an.explain_windows(scored, nodes)
    assert why.count() == scored.filter("is_anomaly").count()
    again = an.explain_windows(scored.repartition(9), nodes)
    assert sorted(map(tuple, why.collect())) == sorted(map(tuple, again.collect()))


def test_argmax(spark):
    df = spark.createDataFrame([([1.0, 5.0, 5.0],), ([-3.0, -2.0, -4.0],)], "i array<double>")
    names = ["a", "b", "c"]
    got = df.select(top_feature(F.col("i"), names), top_features(F.col("i"), names, 2)).collect()
    assert [tuple(r) for r in got] == [("b", ["b", "c"]), ("b", ["b", "a"])]


def test_training_result_and_versions(spark, features, tmp_path):
    base = str(tmp_path)
    for second in range(7):
        trained = an.train_model(features, base, an.TrainingConfig(n_estimators=10), now=datetime(2024, 1, 1, 0, 0, second))
    assert trained.model_version == "20240101_000006" and trained.model_path.endswith("isolation_forest_v20240101_000006")
    assert trained.n_samples_trained == N and trained.within_expected_range
    assert trained.n_anomalies_detected == 15 and trained.anomaly_percentage == 5.0
    assert len(files.children(spark, base)) == 5
    assert an.load_model(spark, trained.model_path).count() > 0
    with pytest.raises(FileNotFoundError, match="no finished model"):
        an.load_model(spark, base + "/nothing")


def test_persist_round_trip(spark, results, tmp_path):
    base = str(tmp_path)
    assert an.persist_results(results, base, "v1") == N == an.persist_results(results, base, "v2")
    back = read_table(spark, table_path(base, "gold.anomaly_results"), ANOMALY_RESULTS)
    assert contract_violations(back, ANOMALY_RESULTS) == []
    assert {r["model_version"] for r in back.select("model_version").distinct().collect()} == {"v2"}
    assert an.anomaly_view(spark, base).columns == list(ANOMALY_VIEW)
    a = {r["window_start"]: r["anomaly_score"] for r in results.collect()}
    assert {r["window_start"]: r["anomaly_score"] for r in back.collect()} == a


def test_input_errors(spark, features, nodes):
    with pytest.raises(ValueError, match=r"features \['unique_users'\]"):
        an.score_windows(features.drop("unique_users"), nodes)
    with pytest.raises(ValueError, match="no feature rows|at least one row"):
        forest.fit(features.filter("false"), list(FEATURES), "window_start")
    with pytest.raises(ValueError, match="no feature rows|at least one row"):
        validate_features(features.filter("false"))
    with pytest.raises(ValueError, match="window_end"):
        validate_features(features.drop("window_end"))
    with pytest.raises(ValueError, match="NaN.*unique_users"):
        validate_features(features.withColumn("unique_users", F.lit(float("nan"))))
    with pytest.raises(ValueError, match="at least 1000"):
        validate_features(features, min_windows=1000)
    assert validate_features(features) == N


def test_hourly_features(spark):
    df = silver(
        spark,
        {"event_id": "1", "event_time": at(0)},
        {"event_id": "2", "event_time": at(60), "username": "bo", "severity": "critical", "severity_rank": 4, "is_attack_event": True,
         "event_type": "malware_alert", "country": "DE", "is_business_hours": False},
        {"event_id": "3", "event_time": at(3 * 3600), "event_type": "vpn_login"},
    )
    got = hourly_features(df).orderBy("window_start").collect()
    assert [r["window_start"] for r in got] == [at(0), at(3 * 3600)]
    assert tuple(got[0])[2:] == (2, 1, 2, 1, 0.5, 1, 2.5, 1, 2, 0.5)
    estimated = hourly_features(df, approximate=True).orderBy("window_start").collect()
    assert [tuple(r) for r in estimated] == [tuple(r) for r in got]
    filled = hourly_features(df, fill_gaps=True).orderBy("window_start").collect()
    assert [r["total_event_count"] for r in filled] == [2, 0, 0, 1]
    assert filled[1]["window_end"] == at(2 * 3600) and filled[1]["failed_login_ratio"] == 0.0


def windows(spark, *pairs):
    return spark.createDataFrame([(at(i * 3600), f) for i, f in pairs], "window_start timestamp_ntz, is_anomaly boolean")


def test_evaluation(spark):
    results = windows(spark, (0, True), (1, True), (2, False), (3, False), (1, False))
    known = windows(spark, (1, True), (3, True), (9, True), (9, True))
    assert tuple(evaluate.confusion_matrix(results, known).first()) == (1, 1, 1, 2)
    row = evaluate.evaluate_anomalies(results, known).first()
    assert (row["precision"], row["recall"], row["precision_meets_target"]) == (0.5, 0.3333, False)


def test_evaluation_of_nothing(spark):
    none, some = windows(spark, (0, False)), windows(spark, (1, True))
    row = evaluate.evaluate_anomalies(none, some).first()
    assert (row["precision"], row["recall"]) == (0.0, 0.0)
    assert evaluate.evaluate_anomalies(some, none.filter("false")).first()["recall"] == 0.0
    with pytest.raises(ValueError, match="is_anomaly"):
        evaluate.confusion_matrix(none.drop("is_anomaly"), some)
    with pytest.raises(ValueError, match="known"):
        evaluate.confusion_matrix(none, some.drop("window_start"))


def test_anomaly_summary(spark):
    df = windows(spark, (0, True), (1, False), (2, False)).withColumn("window_end", F.col("window_start"))
    assert tuple(anomaly_summary(df).first())[:3] == (1, 3, 33.33)
