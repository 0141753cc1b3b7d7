import numpy as np
from pyspark.sql import functions as F

from vigilframe.llm import neighbours as N

SCHEMA = "vec_id long, embedding array<double>, label int, score string, rank string"


def exact(rows, every, k=N.NEAREST):
    good = [(i, np.array(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    out = []
    for q, v in good:
        if q % every == 0:
            scored = sorted(((-(x @ v) / (np.sqrt((x * x).sum()) * np.sqrt((v * v).sum())), i) for i, x in good if i != q and len(x) == len(v)))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def found(spark, rows, every, **kw):
    df = spark.createDataFrame([(i, v, 0, "", "") for i, v in rows], SCHEMA)
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in N.nearest(df, F.col("vec_id") % every == 0, **kw).collect())


def test_odd_rows(spark):
    r = np.random.default_rng(3)
    rows = [(i, r.normal(size=8).tolist()) for i in range(30)] + [(i, [1.0] * 8) for i in range(30, 45)]
    rows += [(50, None), (60, []), (70, [0.0] * 8), (80, [1.0, None] * 4), (90, [float("nan")] * 8), (100, [float("inf")] + [1.0] * 7),
             (None, [1.0] * 8), (110, [1.0, 2.0]), (111, [2.0, 4.0]), (5, rows[5][1])]
    got, want = found(spark, rows, 10), exact(rows, 10)
    assert [x[:3] for x in got if x[0] < 110] == [x[:3] for x in want if x[0] < 110]
    assert np.allclose([x[3] for x in got], [x[3] for x in want])
    assert [x[:3] for x in got if x[0] == 110] == [(110, 1, 111)]
    assert found(spark, rows[:0], 10) == []


def test_recall_and_scores(spark, monkeypatch):
    monkeypatch.setattr(N, "SHARD", 1500)
    monkeypatch.setattr(N, "BLOCK", 20)
    r = np.random.default_rng(4)
    rows = [(i, x) for i, x in enumerate(r.normal(size=(4000, 64)).tolist())]
    rows += [(4000 + i, (np.array(rows[7][1]) + 0.01 * r.normal(size=64)).tolist()) for i in range(2000)]
    got, want = found(spark, rows, 50), {(q, i): s for q, _, i, s in exact(rows, 50)}
    hits = [x for x in got if (x[0], x[2]) in want]
    assert len(got) == len(want) and len(hits) >= 0.9 * len(want)
    assert np.allclose([x[3] for x in hits], [want[x[0], x[2]] for x in hits], rtol=1e-12)


def test_equal_vectors_come_in_order_of_ids():
    r = np.random.default_rng(8)
    for trial in range(400):
        n = int(r.integers(30, 200))
        ids, x = r.permutation(5 * n)[:n], r.normal(size=(n, 37))
        copies = r.choice(n, 12, replace=False)
        x[copies] = x[copies[0]]
        query = x[copies[0]] + r.normal(size=37) / 100
        got = [i for _, i, _ in N.Forest(ids, x, 4, 1).search(np.array([-1]), query[None], 12, 1.0)]
        assert got == sorted(ids[copies].tolist())


def test_recall_on_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = N.nearest(table, F.col("vec_id") % 50 == 0).collect()
    want = {(q, i) for q, _, i, _ in exact([(r.vec_id, [float(x) for x in r.embedding]) for r in table.collect()], 50)}
    assert len({(r.query_id, r.vec_id) for r in got} & want) >= 0.9 * len(want)
