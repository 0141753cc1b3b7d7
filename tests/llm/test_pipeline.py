import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from checks.compare import difference, duck
from tests.llm.helpers import documents
from tests.llm.test_minhash import corpus, shingles, roots
from tests.llm.test_packing import check as check_packing
from vigilframe.llm import mixing, queries, sql


def test_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in queries.queries()} == {f"op{k}" for k in range(1, 11)}
    assert set(queries.queries()) | {"pipeline"} <= set(names)
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(sql.oracle_sql()))
def test_matches_sql(spark, name):
    folder = "/root/testdata/sf0.01"
    assert difference(spark, duck(folder), folder, queries.queries()[name], sql.oracle_sql()[name]) is None


def test_every_stage_against_brute_force(spark, tmp_path):
    rows = corpus() + [(5000 + k, "12 34 !!", "en", "s") for k in range(3)]
    docs, seen = documents(spark, rows), {}
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name.replace(" ", "-"))
        stage(spark, before, "").write.parquet(path)
        seen[name] = (before, spark.read.parquet(path))
        before = seen[name][1]
        if name != "packing":
            assert before.columns == docs.columns

    def held(df):
        return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)

    given, left = map(held, seen["language ID"])
    assert left == [x for x in given if re.search(r"[^\W\d_]", x[1] or "")]
    given, left = map(held, seen["exact dedup"])
    normal = [re.sub(r"[\x20\x09-\x0D]", "", t) for _, t in given]
    assert sorted(re.sub(r"[\x20\x09-\x0D]", "", t) for _, t in left) == sorted(set(normal)) and set(left) <= set(given)
    given, left = map(held, seen["near dedup"])
    sets = [(i, shingles(t)) for i, t in given if i is not None]
    root = roots({i for i, _ in sets}, [(a, b) for k, (a, x) in enumerate(sets) for b, y in sets[:k] if 4 * len(x & y) >= 3 * len(x | y)])
    assert left == [x for x in given if x[0] is None or root[x[0]] == x[0]]
    given, left = seen["source mix"]
    copies = {(r.doc_id, r.text): r._mix_copies for r in mixing.with_copies(given).collect()}
    assert held(left) == sorted((k for k, n in copies.items() for _ in range(n)), key=repr)
    check_packing(seen["packing"][0], seen["packing"][1].collect())


def test_run(spark):
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert found.agg(F.max("length")).first()[0] <= 4096 and found.count() > 100
