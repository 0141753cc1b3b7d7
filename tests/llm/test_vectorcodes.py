import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigilframe.llm import vectorcodes as V

SCHEMA = "vec_id long, embedding array<double>, label int, code string, error string, id int, parts string"


def plain(rows, parts=16, entries=64, rounds=2):
    """The same codes with whole numbers only, one part after the other."""
    good = [(i, v, l) for i, v, l in rows if v is not None and None not in v and all(map(math.isfinite, v))]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not good:
        return []
    size = len(good[0][1])
    good = [r for r in good if len(r[1]) == size]
    whole = [[math.floor(256 * x) for x in v] + [0] * (-size % parts) for _, v, _ in good]
    m = len(whole[0]) // parts
    cut = [[w[p * m:p * m + m] for w in whole] for p in range(parts)]
    books = [[list(x) for x in cut[p][:entries]] for p in range(parts)]

    def assign(p):
        return [min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p])) for x in cut[p]]

    for _ in range(rounds):
        for p in range(parts):
            at = assign(p)
            for k in range(len(books[p])):
                mine = [x for x, (_, j) in zip(cut[p], at) if j == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    final = [assign(p) for p in range(parts)]
    errors = [sum(final[p][n][0] for p in range(parts)) for n in range(len(good))]
    by_label = {}
    for (_, _, l), e in zip(good, errors):
        by_label[l] = by_label.get(l, 0) + e
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return [(i, "".join(f"{final[p][n][1]:02x}" for p in range(parts)), errors[n], by_label[l], digest)
            for n, (i, _, l) in enumerate(good)]


def found(spark, rows, **options):
    df = spark.createDataFrame([(i, v, l, "x", "y", 1, "z") for i, v, l in rows], SCHEMA)
    return [tuple(r) for r in V.compress(df, **options).collect()]


def same(spark, rows, **options):
    few = {k: v for k, v in options.items() if k != "bounds"}
    assert sorted(found(spark, rows, **options), key=repr) == sorted(plain(rows, **few), key=repr)


def vectors(seed, n, d=32, spread=1.0):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(9, d)) * spread
    return [(i, (centres[r.integers(9)] + r.normal(size=d) / 8).tolist(), int(r.integers(3))) for i in r.permutation(n).tolist()]


def test_equals_the_plain_version(spark):
    same(spark, vectors(1, 400))


@pytest.mark.parametrize("options", [{"bounds": 1}, {"bounds": 2, "rounds": 5}, {"bounds": 63, "rounds": 4}, {"entries": 5, "rounds": 6}, {"rounds": 1}])
def test_equals_the_plain_version_for_any_number_of_bounds(spark, options):
    same(spark, vectors(2, 150), **options)


def test_ties_and_repeated_rows(spark):
    few = [(i, [float(x % 3) / 256 for x in range(i, i + 16)], i % 2) for i in range(200)]
    same(spark, few + few[:50])


def test_odd_rows(spark):
    rows = vectors(3, 150, 20)
    rows += [(200, None, 1), (201, [], 1), (202, [float("nan")] + [0.0] * 19, 1), (203, [float("-inf")] + [0.0] * 19, None),
             (204, [None] + [0.5] * 19, 1), (205, [1.0, 2.0], 1), (None, [0.25] * 20, None), (206, [-0.001] * 20, None), (3, rows[4][1], None)]
    same(spark, rows)
    same(spark, rows[:1])
    same(spark, rows[:30])
    assert found(spark, []) == [] == found(spark, [(1, None, 2)])


def test_large_components_are_decided_by_whole_numbers(spark):
    r = np.random.default_rng(5)
    base = r.integers(-100_000, 100_000, size=(100, 16)).astype(float)
    rows = [(i, (base[i % 100] + r.integers(-2, 3, size=16) / 256).tolist(), 0) for i in range(400)]
    same(spark, rows)
    top = [(i, [x * 1e30 for x in v], l) for i, v, l in rows[:80]]
    assert len(found(spark, top)) == 80


def test_bounds_hold_and_save_work():
    r = np.random.default_rng(6)
    x, book = r.integers(-300, 300, size=(500, 4)), r.integers(-300, 300, size=(40, 4))
    near, lower, outer = V._nearest(x, book, 6)
    moved_book = book + r.integers(-4, 5, size=book.shape)
    moved = np.sqrt(((moved_book - book) ** 2).sum(1)) * (1 + 1e-12)
    near, lower, outer, need = V._again(x, moved_book, moved, near, V._down(lower), V._down(outer))
    d = ((x[:, None] - moved_book) ** 2).sum(2)
    assert (near[:, 0] == d.argmin(1)).all()
    true = np.sqrt(np.take_along_axis(d, near[:, 1:], 1))
    assert (lower <= true + 1e-9).all()
    left = np.ones_like(d, bool)
    np.put_along_axis(left, near, False, 1)
    assert (np.where(left, np.sqrt(d), np.inf).min(1) >= outer - 1e-9).all()
    assert (need == 0).mean() > 0.3 and (need == 7).mean() < 0.1


def test_b_shrinks():
    assert V.narrower([90, 9, 1, 0, 0], 3) == 1
    assert V.narrower([10, 10, 10, 10, 5], 3) == 3
    assert V.narrower([0, 0, 0, 7], 2) == 2


def test_many_labels_are_joined_without_broadcast(spark):
    codes = spark.createDataFrame([(i, None if i % 5 == 0 else i % 3, bytes([i]), i) for i in range(60)], "id long, label int, code binary, error long")
    assert sorted(map(tuple, V.errors_by_label(codes, 0).collect())) == sorted(map(tuple, V.errors_by_label(codes).collect()))


def test_whole_table(spark, folder):
    df = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = [(r.vec_id, [float(x) for x in r.embedding], r.label) for r in df.collect()]
    got = V.compress(df.withColumn("code", F.lit("taken")))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(plain(rows))
