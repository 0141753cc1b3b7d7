"""Flagged windows against known ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def _check(results: DataFrame, known: DataFrame, key: str) -> None:
    """Column names only; runs no job."""
    needed = {"results": (results, {key, "is_anomaly"}), "known windows": (known, {key})}
    for what, (rows, columns) in needed.items():
        absent = sorted(columns - set(rows.columns))
        if absent:
            raise ValueError(f"the {what} have no {' and no '.join(absent)}; their columns are {rows.columns}")


def confusion_matrix(results: DataFrame, known: DataFrame, key: str = "window_start") -> DataFrame:
    """One row of true and false positives and negatives over distinct windows.

    A known window absent from the results counts as a false negative; only windows in
    the results can be true negatives.
    """
    _check(results, known, key)
    flags = results.groupBy(key).agg(F.max("is_anomaly").alias("flagged"))
    truth = known.select(key).distinct().withColumn("true", F.lit(True))
    both = flags.join(truth, key, "full_outer").select(
        F.coalesce("flagged", F.lit(False)).alias("flagged"),
        F.coalesce("true", F.lit(False)).alias("true"),
    )
    flagged, true = F.col("flagged"), F.col("true")
    return both.agg(
        F.count_if(flagged & true).alias("true_positives"),
        F.count_if(flagged & ~true).alias("false_positives"),
        F.count_if(~flagged & ~true).alias("true_negatives"),
        F.count_if(~flagged & true).alias("false_negatives"),
    )


def evaluate_anomalies(
    results: DataFrame, known: DataFrame, key: str = "window_start",
    precision_target: float = 0.7, recall_target: float = 0.6,
) -> DataFrame:
    """Precision and recall to four places, 0 where nothing is flagged or known."""
    tp, fp, fn = F.col("true_positives"), F.col("false_positives"), F.col("false_negatives")

    def share(whole):
        return F.coalesce(tp / F.nullif(whole, F.lit(0)), F.lit(0.0))

    return confusion_matrix(results, known, key).select(
        F.bround(share(tp + fp), 4).alias("precision"),
        F.bround(share(tp + fn), 4).alias("recall"),
        (share(tp + fp) >= precision_target).alias("precision_meets_target"),
        (share(tp + fn) >= recall_target).alias("recall_meets_target"),
        (tp + fp).alias("n_flagged_windows"),
        (tp + fn).alias("n_true_anomaly_windows"),
        tp.alias("n_true_positives"),
    )
