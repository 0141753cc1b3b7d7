"""Isolation forest (Liu, Ting and Zhou, 2008) as Spark tables.

Trees are grown in parallel from bounded samples and kept as a table of nodes; rows are
scored in parallel against the whole forest. The sample, the trees and the scores depend
on the seed and the row keys only, not on how the rows are partitioned.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from vigilframe.operators.selection import exact_percentile

NODE_SCHEMA = (
    "tree int, node int, feature int, threshold double, left int, right int, "
    "path_length double, sample_size int"
)


def sample_for_trees(
    rows: DataFrame, columns: list[str], key: str, n_trees: int, sample_size: int, seed: int, n_rows: int
) -> DataFrame:
    """``sample_size`` rows for each tree: those with the smallest hash of (seed, tree, key).

    A row first passes a hash threshold set to let through about twice the rows needed, so
    only those (row, tree) pairs exist at all; the exact cut is made per tree afterwards.
    """
    share = min(1.0, 2.0 * sample_size / max(n_rows, 1))
    draw = lambda tree: F.xxhash64(F.lit(seed), tree, F.col(key))
    trees = F.sequence(F.lit(0), F.lit(n_trees - 1))
    if share < 1.0:
        limit = int(-(2**63) + share * 2**64)
        trees = F.filter(trees, lambda tree: draw(tree) < F.lit(limit))
    drawn = rows.select(
        F.explode(trees).alias("tree"), F.col(key).alias("_key"), *[F.col(c).cast("double").alias(c) for c in columns]
    )
    order = Window.partitionBy("tree").orderBy(F.xxhash64(F.lit(seed), "tree", "_key"), "_key")
    return (
        drawn.withColumn("_position", F.row_number().over(order))
        .filter(F.col("_position") <= sample_size)
        .drop("_key")
    )


def _tree_grower(columns: list[str], seed: int, sample_size: int):
    """The per-tree function; nested so that it travels to the executors by value."""

    def expected_path(size: int) -> float:
        if size <= 1:
            return 0.0
        if size == 2:
            return 1.0
        return 2.0 * (math.log(size - 1.0) + 0.5772156649015329) - 2.0 * (size - 1.0) / size

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        values = pdf.sort_values("_position")[columns].to_numpy(dtype=np.float64)
        rng = np.random.default_rng([seed, tree])
        depth_limit = math.ceil(math.log2(max(len(values), 2)))
        nodes: list[list] = []
        pending = [(np.arange(len(values)), 0, None, None)]  # rows, depth, parent, side
        while pending:
            rows, depth, parent, side = pending.pop()
            me = len(nodes)
            if parent is not None:
                nodes[parent][side] = me
            low, high = values[rows].min(axis=0), values[rows].max(axis=0)
            usable = np.flatnonzero(high > low)
            if depth >= depth_limit or len(rows) <= 1 or len(usable) == 0:
                nodes.append([tree, me, -1, 0.0, -1, -1, depth + expected_path(len(rows))])
                continue
            feature = int(rng.choice(usable))
            cut = float(rng.uniform(low[feature], high[feature]))
            goes_left = values[rows, feature] <= cut
            nodes.append([tree, me, feature, cut, -1, -1, 0.0])
            pending.append((rows[~goes_left], depth + 1, me, 5))
            pending.append((rows[goes_left], depth + 1, me, 4))
        out = pd.DataFrame(nodes, columns=["tree", "node", "feature", "threshold", "left", "right", "path_length"])
        out["sample_size"] = sample_size
        return out

    return grow


MOST_SAMPLED = 2_000_000
"""Trees times rows of a tree."""


def fit(
    rows: DataFrame,
    columns: list[str],
    key: str,
    n_trees: int = 100,
    max_samples: int = 256,
    seed: int = 42,
    n_rows: int | None = None,
) -> DataFrame:
    """The node table of a forest; ``key`` must identify a row.

    Trees times sampled rows is bounded, as scoring ships the whole forest to every task.
    """
    if n_trees * max_samples > MOST_SAMPLED:
        raise ValueError(f"{n_trees} trees of {max_samples} rows; their product may be {MOST_SAMPLED} at most")
    n_rows = rows.count() if n_rows is None else n_rows
    if n_rows == 0:
        raise ValueError("a forest needs at least one row")
    size = min(max_samples, n_rows)
    drawn = sample_for_trees(rows, columns, key, n_trees, size, seed, n_rows)
    return drawn.groupBy("tree").applyInPandas(_tree_grower(columns, seed, size), NODE_SCHEMA)


def _forest_arrays(nodes: DataFrame) -> dict:
    """The forest as flat arrays with global node numbers.

    A tree over s sampled rows has fewer than 2s nodes of about 50 bytes, so a forest takes
    at most about 200 MB, whatever the size of the data.
    """
    size = nodes.agg(
        F.countDistinct("tree").alias("t"), F.countDistinct("tree", "node").alias("d"),
        F.count("*").alias("n"), F.max("sample_size").alias("s"),
    ).first()
    bound = 2 * size["t"] * max(size["s"] or 0, 1)
    if not 0 < bound <= 2 * MOST_SAMPLED or size["n"] != size["d"] or size["n"] >= bound:
        raise ValueError(f"not a forest: {size['n']} nodes in {size['t']} trees of {size['s']} rows")
    pdf = nodes.toPandas().sort_values(["tree", "node"])
    starts = pdf["node"].to_numpy() == 0
    roots = np.flatnonzero(starts)
    base = roots[np.cumsum(starts) - 1]
    leaf = pdf["feature"].to_numpy() < 0
    here = np.arange(len(pdf))
    return {
        "roots": roots,
        "feature": np.where(leaf, 0, pdf["feature"].to_numpy()),
        "threshold": pdf["threshold"].to_numpy(),
        # A leaf points to itself, so walking on changes nothing.
        "left": np.where(leaf, here, base + pdf["left"].to_numpy()),
        "right": np.where(leaf, here, base + pdf["right"].to_numpy()),
        "path": pdf["path_length"].to_numpy(),
        "depth": math.ceil(math.log2(max(int(size["s"]), 2))),
        "sample_size": int(size["s"]),
    }


def _scorer(shared):
    """Vectorised scoring: all rows of an Arrow batch walk all trees together."""

    @F.pandas_udf("double")
    def score(*features: pd.Series) -> pd.Series:
        f = shared.value
        values = np.column_stack([c.to_numpy(dtype=np.float64) for c in features])
        s = f["sample_size"]
        usual = 2.0 * (math.log(s - 1.0) + 0.5772156649015329) - 2.0 * (s - 1.0) / s if s > 2 else float(max(s - 1, 0))
        out = np.empty(len(values))
        for start in range(0, len(values), 4096):
            block = values[start : start + 4096]
            at = np.broadcast_to(f["roots"], (len(block), len(f["roots"]))).copy()
            line = np.arange(len(block))[:, None]
            for _ in range(f["depth"]):
                goes_left = block[line, f["feature"][at]] <= f["threshold"][at]
                at = np.where(goes_left, f["left"][at], f["right"][at])
            mean = f["path"][at].mean(axis=1)
            out[start : start + 4096] = -np.exp2(-mean / usual) if usual > 0 else -1.0
        return pd.Series(out)

    return score


class Scorer:
    """A forest ready to score; the node arrays are broadcast once."""

    def __init__(self, nodes: DataFrame, columns: list[str]):
        self.columns = columns
        self._udf = _scorer(nodes.sparkSession.sparkContext.broadcast(_forest_arrays(nodes)))

    def __call__(self, *values: Column) -> Column:
        """Score of the given feature values, in [-1, 0]; higher is more normal."""
        return self._udf(*[v.cast("double") for v in values])

    def add(self, rows: DataFrame, name: str = "raw_score") -> DataFrame:
        return rows.withColumn(name, self(*[F.col(c) for c in self.columns]))


def contamination_cut(scored: DataFrame, contamination: float, score: str = "raw_score") -> DataFrame:
    """One row: the score below which the given share lies, how many lie there, of how many.

    The score is selected exactly, in a few passes; settle ``scored`` first, so that rows aren't
    scored in each of them.
    """
    flagged = F.count_if(F.col(score) < F.lit(exact_percentile(scored, score, contamination)))
    return scored.agg(
        F.count("*").alias("n_samples"),
        flagged.alias("n_anomalies"),
        F.bround(flagged / F.count("*") * 100, 2).alias("anomaly_percentage"),
    )


def minmax_scores(rows: DataFrame, column: str, out: str) -> DataFrame:
    """Scale ``column`` to [-1, 1] over all rows; all zero when it is constant."""
    bounds = rows.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi")).alias("b")).scalar()
    low, width = bounds["lo"], bounds["hi"] - bounds["lo"]
    return rows.withColumn(
        out, F.when(width > 0, (F.col(column) - low) * 2.0 / width - 1.0).otherwise(F.lit(0.0))
    )
