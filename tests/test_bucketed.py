"""Bucketed catalog tables: the merge, its plan, and what is left behind."""

from __future__ import annotations

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from vigilframe.sources import bucketed

KEYS, SCHEMA = ["k"], "k long, v string, o int"


@pytest.fixture
def name(spark, request):
    table = re.sub(r"\W", "_", request.node.name).lower()
    yield table
    bucketed.drop(spark, table)


def order():
    return [F.desc("o"), F.desc("v")]


def newest(rows):
    best = {}
    for k, v, o in rows:
        best[k] = max(best.get(k, (o, v)), (o, v))
    return sorted(((k, v, o) for k, (o, v) in best.items()), key=repr)


def test_merges_keep_the_newest_version_whatever_comes_first(spark, name, tmp_path):
    r = random.Random(1)
    lots = [[(r.choice([None, *range(60)]), f"v{r.randrange(9)}", r.randrange(9)) for _ in range(n)] for n in (0, 80, 40, 1, 0, 80)]
    bucketed.create(spark.createDataFrame(lots[0], SCHEMA), name, KEYS, order(), 5, str(tmp_path / "t"))
    for lot in lots[1:]:
        for _ in range(2):  # once more changes nothing
            bucketed.merge(spark.createDataFrame(lot, SCHEMA), name, KEYS, order())
    got = sorted(map(tuple, spark.table(name).collect()), key=repr)
    assert got == newest([x for lot in lots for x in lot]) and (None in {k for k, _, _ in got})


def test_the_table_is_not_shuffled_and_stays_bucketed(spark, name):
    bucketed.create(spark.range(500).select(F.col("id").alias("k"), F.lit("a").alias("v"), F.lit(1).alias("o")), name, KEYS, order(), 4)
    batch = spark.range(400, 600).select(F.lit(2).alias("o"), F.col("id").alias("k"), F.lit("b").alias("v"), F.lit(0).alias("more"))
    for _ in range(2):
        last = bucketed._generations(spark, name)[-1]
        plan = bucketed.merged(spark.table(f"{name}_g{last}"), batch, KEYS, order(), 4)._jdf.queryExecution().executedPlan().toString()
        target = plan[plan.index("FileScan"):].split("\n")[0]
        assert plan.count("Exchange") == 1 and plan.index("FileScan") < plan.index("Exchange") and "Bucketed: true" in target
        bucketed.merge(batch, name, KEYS, order())
    assert len(spark.table(f"{name}_g2").inputFiles()) == 4
    assert spark.table(name).groupBy("v").count().orderBy("v").collect() == [("a", 400), ("b", 200)]


def test_two_generations_are_kept_and_drop_removes_all(spark, name, tmp_path):
    rows = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    bucketed.create(rows, name, KEYS, order(), 2, str(tmp_path / "t"))
    reader = spark.table(name)
    bucketed.merge(spark.createDataFrame([(1, "b", 2)], SCHEMA), name, KEYS, order())
    assert [r.v for r in reader.collect()] == ["a"]  # it began before the merge
    bucketed.merge(rows, name, KEYS, order())
    assert [r.v for r in spark.table(name).collect()] == ["b"]
    assert sorted(os.listdir(tmp_path / "t")) == ["g1", "g2"] == [f"g{n}" for n in bucketed._generations(spark, name)]
    bucketed.drop(spark, name)
    assert not spark.catalog.tableExists(name) and os.listdir(tmp_path / "t") == []


def test_a_merge_that_fails_leaves_the_table_as_it_was(spark, name):
    bucketed.create(spark.createDataFrame([(1, "a", 1)], SCHEMA), name, KEYS, order(), 2)
    broken = spark.createDataFrame([(2, "b", 1)], SCHEMA).withColumn("o", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        bucketed.merge(broken, name, KEYS, order())
    assert [tuple(r) for r in spark.table(name).collect()] == [(1, "a", 1)]
    bucketed.merge(spark.createDataFrame([(2, "b", 1)], SCHEMA), name, KEYS, order())
    assert spark.table(name).count() == 2
