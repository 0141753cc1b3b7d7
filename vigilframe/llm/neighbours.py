"""Approximate nearest neighbours by a forest of hash prefixes.

A tree is a random rotation. A vector's hash string in it is the axis that the rotated
vector lies closest to, then the signs of the other coordinates; nearer vectors share longer
beginnings. A shard of rows keeps, per tree, the sorted strings. A search descends every
tree to the longest beginning that it shares with any string, then all trees ascend
together, one length after the other, until the rows met make up ``WANTED`` of the shard
(and no fewer than ``LEAST``).
These are scored exactly, in double precision.

Shards have a fixed number of rows, so recall doesn't fall as the table grows. Every query
visits every shard, in blocks: the work is queries times rows, a fixed small part of which
is scored; no pair is shuffled or written, only the nearest few of each shard.

Edge cases: vectors that are null, empty, zero or hold a null or non-finite component take
no part, neither do those of another length than a query's; of equal scores the smaller id
is nearer; rows that repeat an id are candidates each, but a query never finds its own id;
fewer candidates than asked for are all returned; an empty table gives no rows. Columns
other than those named are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from vigilframe.llm.common import ranges
from vigilframe.session import settle

TREES = 56
WANTED = 0.25
LEAST = 1024
"""Rows of a shard that an ascent meets at least; so few are scored in no time."""
SHARD = 8192
"""Rows of a shard, on average."""
BLOCK = 8192
"""Queries that visit a shard in one go, on average."""
NEAREST = 5
SEED = 7
#: Lengths of shared beginnings, in bits, at which an ascent stops to count. 7 or more bits name the axis.
_LENGTHS = (63, 48, 36, 28, 22, 18, 15, 13, 11, 10, 9, 8)


def rotations(width: int, trees: int, seed: int = SEED) -> np.ndarray:
    random = np.random.Generator(np.random.PCG64(seed))
    return np.stack([np.linalg.qr(random.normal(size=(width, width)))[0] for _ in range(trees)]).astype(np.float32)


def strings(vectors: np.ndarray, rotation: np.ndarray) -> np.ndarray:
    """Hash strings of unit vectors in one tree, as 63-bit numbers, the beginning in the highest bits."""
    turned = vectors @ rotation
    n, width = turned.shape
    axis = np.abs(turned).argmax(1)
    axes = max(1, (2 * width - 1).bit_length())
    out = (2 * axis + (turned[np.arange(n), axis] < 0)).astype(np.uint64)
    for j in range(min(width, 63 - axes)):
        out = (out << np.uint64(1)) | (turned[:, j] > 0).astype(np.uint64)
    return out << np.uint64(max(0, 63 - axes - width))


class Forest:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, trees: int = TREES, seed: int = SEED):
        self.ids, self.vectors = ids, vectors
        self.norms = np.sqrt((vectors * vectors).sum(1))
        self.unit = (vectors / self.norms[:, None]).astype(np.float32)
        self.rotations = rotations(vectors.shape[1], trees, seed)
        self.order, self.sorted = [], []
        for rotation in self.rotations:
            found = strings(self.unit, rotation)
            order = np.lexsort((ids, found))
            self.order.append(order)
            self.sorted.append(found[order])
        axes = max(1, (2 * vectors.shape[1] - 1).bit_length())
        self.lengths = [*(x for x in _LENGTHS if x > axes), axes, 0]

    def ranges_of(self, queries: np.ndarray) -> list[np.ndarray]:
        """For every length: (tree, query, 2), the places in a tree's order that share so long a beginning."""
        found = [np.empty((len(self.order), len(queries), 2), np.int64) for _ in self.lengths]
        for t, rotation in enumerate(self.rotations):
            own = strings(queries, rotation)
            for i, length in enumerate(self.lengths):
                rest = np.uint64((1 << (63 - length)) - 1)
                found[i][t, :, 0] = np.searchsorted(self.sorted[t], own & ~rest, "left")
                found[i][t, :, 1] = np.searchsorted(self.sorted[t], own | rest, "right")
        return found

    def search(self, query_ids: np.ndarray, queries: np.ndarray, nearest: int, wanted: float = WANTED) -> list[tuple[int, int, float]]:
        """(query id, id, score) of the ``nearest`` found for each query."""
        norms = np.sqrt((queries * queries).sum(1))
        places = self.ranges_of((queries / norms[:, None]).astype(np.float32))
        every, first, out = np.concatenate(self.order), np.arange(len(self.order)) * len(self.ids), []
        for q, query_id in enumerate(query_ids):
            seen = np.zeros(len(self.ids), bool)
            for place in places:  # all trees ascend together
                low, high = place[:, q, 0], place[:, q, 1]
                seen[every[ranges(first + low, high - low)]] = True
                if np.count_nonzero(seen) >= max(wanted * len(seen), min(LEAST, len(seen)), nearest + 1):
                    break
            rows = np.flatnonzero(seen & (self.ids != query_id))
            score = (self.vectors[rows] @ queries[q]) / (self.norms[rows] * norms[q])
            if len(rows) > nearest:
                # All that may tie with the last one are kept until the ids decide.
                least = np.partition(score, len(rows) - nearest)[len(rows) - nearest]
                rows = rows[score >= least - 1e-9]
            # A product of matrices rounds by a row's place in it; a sum of its own row doesn't.
            score = (self.vectors[rows] * queries[q]).sum(1) / (self.norms[rows] * norms[q])
            best = np.lexsort((self.ids[rows], -score))[:nearest]
            out += [(int(query_id), int(self.ids[rows[i]]), float(score[i])) for i in best]
        return out


def _vectors(table: pa.Table, id_column: str) -> tuple[np.ndarray, list[np.ndarray]]:
    held = table.column("vector").combine_chunks()
    widths = np.diff(held.offsets.to_numpy())
    flat = held.flatten().to_numpy()
    ids, ends = table.column(id_column).to_numpy(), np.cumsum(widths)
    return ids, [(w, ids[widths == w], flat[ranges((ends - widths)[widths == w], widths[widths == w])].reshape(-1, w)) for w in np.unique(widths)]


def _visit(nearest: int, trees: int, wanted: float, seed: int):
    def run(key: tuple, rows: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple[int, int, float]] = []
        if rows.num_rows and queries.num_rows:
            asked = {w: (ids, x) for w, ids, x in _vectors(queries, "query_id")[1]}
            for width, ids, x in _vectors(rows, "vec_id")[1]:
                if width in asked:
                    found += Forest(ids, x, trees, seed).search(*asked[width], nearest, wanted)
        a, b, c = zip(*found) if found else ((), (), ())
        return pa.table({"query_id": pa.array(a, pa.int64()), "vec_id": pa.array(b, pa.int64()), "score": pa.array(c, pa.float64())})

    return run


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector, in doubles, of the rows that can be compared."""
    vector = F.col("embedding").cast("array<double>")
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
        .where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists("vector", lambda x: x != 0))
    )


def nearest(vectors: DataFrame, is_query: Column, nearest: int = NEAREST, trees: int = TREES, wanted: float = WANTED, seed: int = SEED) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest found to every row for which ``is_query``, an expression of vec_id, holds."""
    held = settle(usable(vectors), "vectors")
    asked = held.where(is_query)
    shards, blocks = max(1, -(-held.count() // SHARD)), max(1, -(-asked.count() // BLOCK))

    def dealt(n: int, salt: str) -> Column:
        return F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("long")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    # A row's block of queries and a query's shard run over all: each pair of them meets in one task.
    rows = held.select(dealt(shards, "row").alias("shard"), every(blocks).alias("block"), "vec_id", "vector")
    queries = asked.select(every(shards).alias("shard"), dealt(blocks, "query").alias("block"), F.col("vec_id").alias("query_id"), "vector")
    met = rows.groupBy("shard", "block").cogroup(queries.groupBy("shard", "block")).applyInArrow(
        _visit(nearest, trees, wanted, seed), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")
