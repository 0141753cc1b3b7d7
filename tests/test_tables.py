from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F, types as T

from tests.helpers import silver
from vigilframe.operators.dedup import merge_upsert
from vigilframe.sources import contracts as c, files, tables


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "t")


def dated(spark, *rows):
    return spark.createDataFrame(rows, "k string, v int, day date")


D1, D2, D3 = (date(2024, 1, d) for d in (1, 2, 3))


def test_merge_replaces_and_inserts(spark, path, rows):
    for batch in ([("a", 1, D1), ("b", 1, D1)], [("b", 2, D1), ("c", 2, D1)]):
        tables.write_table(dated(spark, *batch), path, "merge", ["k"], [F.desc("v")])
    assert rows(tables.scan(spark, path)) == [("a", 1, D1), ("b", 2, D1), ("c", 2, D1)]


@pytest.mark.parametrize("partition", [None, "day"])
def test_merge_moves_keys_between_partitions(spark, path, rows, partition):
    tables.merge_table(dated(spark, ("a", 1, D1), ("b", 1, D2)), path, ["k"], [F.desc("v")], partition)
    tables.merge_table(dated(spark, ("a", 2, D3)), path, ["k"], [F.desc("v")], partition)
    got = tables.scan(spark, path).select("k", "v", "day")
    assert rows(got) == [("a", 2, D3), ("b", 1, D2)]


def test_merge_leaves_other_partitions_alone(spark, path):
    tables.merge_table(dated(spark, ("a", 1, D1), ("b", 1, D2)), path, ["k"], [F.desc("v")], "day")
    before = tables.snapshot(spark, path).directories
    tables.merge_table(dated(spark, ("b", 2, D2)), path, ["k"], [F.desc("v")], "day")
    after = tables.snapshot(spark, path).directories
    assert {d for d in before if "01-01" in d} == {d for d in after if "01-01" in d}
    assert {d for d in before if "01-02" in d}.isdisjoint(after)


@pytest.mark.parametrize("partition", [None, "day"])
def test_an_older_version_that_comes_later_changes_nothing(spark, path, rows, partition):
    for batch in ([("a", 5, D2)], [("a", 3, D1), ("b", 1, D1)], [("a", 4, D3)]):
        tables.merge_table(dated(spark, *batch), path, ["k"], [F.desc("v")], partition)
    assert rows(tables.scan(spark, path).select("k", "v", "day")) == [("a", 5, D2), ("b", 1, D1)]


@pytest.mark.parametrize("order", [None, "v"])
@pytest.mark.parametrize("partition", [None, "day"])
def test_null_keys_are_one_key(spark, path, rows, partition, order):
    for v in (1, 2, 3):
        batch = dated(spark, (None, v, D1), ("x", v, None))
        tables.merge_table(batch, path, ["k"], [F.desc(order)] if order else None, partition)
    assert rows(tables.scan(spark, path).select("k", "v", "day")) == [("x", 3, None), (None, 3, D1)]


def test_merge_deduplicates_its_batch(spark, path, rows):
    tables.merge_table(dated(spark, ("a", 1, D1), ("a", 3, D1), ("a", 2, D1)), path, ["k"], [F.desc("v")])
    assert rows(tables.scan(spark, path)) == [("a", 3, D1)]


class Lost(RuntimeError):
    pass


def cut_off(monkeypatch, after: int):
    """The job dies at its n-th action on the file system, which isn't carried out."""
    left = [after]

    def dying(action):
        def run(*a, **kw):
            left[0] -= 1
            if left[0] < 0:
                raise Lost
            return action(*a, **kw)

        return run

    for name in ("create", "remove"):
        monkeypatch.setattr(files, name, dying(getattr(files, name)))
    monkeypatch.setattr(tables, "_write", dying(tables._write))


@pytest.mark.parametrize("partition", [None, "day"])
@pytest.mark.parametrize("write", ["replace", "append", "merge"])
def test_a_job_that_dies_anywhere_loses_nothing(spark, path, rows, monkeypatch, partition, write):
    old, new = [("a", 1, D1), ("b", 1, D2)], [("a", 2, D2), ("c", 2, D3)]
    whole = {"replace": new, "append": old + new, "merge": [("a", 2, D2), ("b", 1, D2), ("c", 2, D3)]}[write]
    read = lambda: rows(tables.scan(spark, path).select("k", "v", "day"))
    for step in range(20):
        where = f"{path}{step}"
        path, kept = where, path
        tables.write_table(dated(spark, ("z", 0, D1)), path, partition=partition)
        tables.write_table(dated(spark, *old), path, partition=partition)
        with monkeypatch.context() as m:
            cut_off(m, step)
            try:
                tables.write_table(dated(spark, *new), path, write, ["k"], [F.desc("v")], partition)
                died = False
            except Lost:
                died = True
        assert read() in (sorted(old), sorted(whole))
        tables.write_table(dated(spark, ("d", 9, D1)), path, "merge", ["k"], [F.desc("v")], partition)
        assert read() in (sorted([*old, ("d", 9, D1)]), sorted([*whole, ("d", 9, D1)]))
        path = kept
        if not died:
            break
    assert not died and step > 2


def test_a_snapshot_cut_off_in_its_writing_does_not_count(spark, path, rows):
    tables.write_table(dated(spark, ("a", 1, D1)), path)
    files.create(spark, f"{path}/_table/000000000002.json", '{"directories": ["gen')
    assert rows(tables.scan(spark, path)) == [("a", 1, D1)]
    tables.write_table(dated(spark, ("b", 1, D1)), path, "append")
    assert rows(tables.scan(spark, path)) == [("a", 1, D1), ("b", 1, D1)]


def test_readers_keep_their_snapshot_for_one_write(spark, path, rows):
    tables.write_table(dated(spark, ("a", 1, D1)), path)
    reader = tables.scan(spark, path)
    tables.write_table(dated(spark, ("b", 1, D1)), path)
    assert rows(reader) == [("a", 1, D1)]
    tables.write_table(dated(spark, ("c", 1, D1)), path)
    assert len([n for n in files.children(spark, path) if n.startswith("gen=")]) == 2


def test_a_named_append_happens_once(spark, path, rows):
    for v in (1, 2):
        tables.write_table(dated(spark, ("a", v, D1)), path, "append", name="batch-7")
    assert rows(tables.scan(spark, path)) == [("a", 1, D1)]


def test_merge_keeps_added_columns(spark, path, rows):
    tables.merge_table(dated(spark, ("a", 1, D1)).withColumn("note", F.lit("n")), path, ["k"], [F.desc("v")], "day")
    tables.merge_table(dated(spark, ("b", 1, D1)), path, ["k"], [F.desc("v")], "day")
    assert rows(tables.scan(spark, path).select("k", "note")) == [("a", "n"), ("b", None)]


def test_merge_of_nothing(spark, path):
    empty = dated(spark, ("a", 1, D1)).filter("false")
    tables.merge_table(empty, path, ["k"], None, "day")
    tables.merge_table(dated(spark, ("a", 1, D1)), path, ["k"], None, "day")
    tables.merge_table(empty, path, ["k"], None, "day")
    assert tables.row_count(spark, path) == 1


def test_merge_refuses_wide_partitions(spark, path):
    with pytest.raises(ValueError, match="date or an integer"):
        tables.merge_table(dated(spark, ("a", 1, D1)), path, ["k"], [], "k")


def test_dispositions(spark, path):
    df = dated(spark, ("a", 1, D1))
    tables.write_table(df, path, "append")
    tables.write_table(df, path, "append")
    assert tables.row_count(spark, path) == 2
    tables.write_table(df, path, "replace")
    assert tables.row_count(spark, path) == 1
    assert tables.row_count(spark, path + "-missing") == 0
    with pytest.raises(ValueError, match="disposition"):
        tables.write_table(df, path, "upsert")


def test_a_table_may_be_replaced_from_itself(spark, path):
    contract = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.IntegerType()), T.StructField("day", T.DateType())])
    tables.write_table(dated(spark, ("a", 3, D1)), path)
    bad = dated(spark, ("a", 2, D1)).withColumn("v", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        tables.write_table(bad, path)
    tables.write_table(tables.read_table(spark, path, contract).withColumn("v", F.col("v") + 1), path)
    assert [r["v"] for r in tables.read_table(spark, path, contract).collect()] == [4]


def test_merge_wants_an_order(spark, path):
    with pytest.raises(ValueError, match="order"):
        tables.write_table(dated(spark, ("a", 1, D1)), path, "merge", ["k"])


def test_upsert_with_new_column(spark, rows):
    old, new = dated(spark, ("a", 1, D1)), dated(spark, ("b", 2, D2)).withColumn("extra", F.lit(9))
    assert rows(merge_upsert(old, new, ["k"])) == [("a", 1, D1, None), ("b", 2, D2, 9)]


def test_read_missing_table(spark, path):
    assert tables.read_table(spark, path, c.SILVER).columns == c.SILVER.fieldNames()


def test_conform(spark):
    df = spark.createDataFrame([(1, "2024-01-01")], "attack_count int, event_date string")
    with pytest.raises(ValueError, match="cumulative_attack_count"):
        c.conform(df, c.ATTACK_VOLUME_BY_DAY)
    got = c.conform(df.withColumn("cumulative_attack_count", F.lit(1)), c.ATTACK_VOLUME_BY_DAY)
    assert got.schema.simpleString() == "struct<event_date:date,attack_count:bigint,cumulative_attack_count:bigint>"


def test_evolve(spark, path, rows):
    """Add, drop, rename, reorder, widen; files on disk stay as they are."""
    spark.createDataFrame([(1, "x", "gone")], "n int, src_ip string, old string").write.parquet(path)
    new = T.StructType([
        T.StructField("source_ip", T.StringType()), T.StructField("n", T.LongType()), T.StructField("score", T.FloatType()),
    ])
    got = c.evolve(spark.read.parquet(path), new, {"src_ip": "source_ip"}, ("old",))
    assert got.columns == new.fieldNames() and rows(got) == [("x", 1, None)]
    with pytest.raises(ValueError, match="not a widening"):
        c.evolve(got.select("n"), T.StructType([T.StructField("n", T.IntegerType())]))
    with pytest.raises(ValueError, match="drop or rename"):
        c.evolve(spark.read.parquet(path), new, {"src_ip": "source_ip"})


def test_contract_violations(spark):
    df = silver(spark, {}).drop("country").withColumn("severity_rank", F.lit("x")).withColumn("z", F.lit(1))
    assert c.contract_violations(df, c.SILVER) == [
        ("severity_rank", "is string, expected int"), ("country", "missing"), ("z", "not in contract"),
    ]


def test_export_round_trip(spark, tmp_path, rows):
    df = silver(
        spark, {"event_id": "a", "detection_time": datetime(2024, 1, 15, 12, 0, 0, 123456)}, {"event_id": "b", "destination_ip": "1.2.3.4"}
    )
    paths = tables.export(df, str(tmp_path), ("jsonl", "parquet", "csv"))
    assert set(paths) == {"jsonl", "parquet", "csv"}
    assert rows(spark.read.parquet(paths["parquet"])) == rows(df)
    assert rows(tables.read_jsonl(spark, paths["jsonl"], c.SILVER)) == rows(df)
    assert rows(tables.read_csv(spark, paths["csv"], c.SILVER)) == rows(df)
    line = spark.read.text(paths["jsonl"]).filter("value LIKE '%\"a\"%'").first()[0]
    assert '"event_time":"2024-01-15T12:00:00.000000"' in line and '"destination_ip":null' in line
    with pytest.raises(ValueError, match="unknown format"):
        tables.export(df, str(tmp_path), ("xml",))


def test_export_mart(spark, tmp_path):
    df = spark.createDataFrame([("US", 5, 0.5), ("DE", 7, 0.7)], "country string, attack_count long, percentage_of_total float")
    tables.export_mart(df, str(tmp_path / "m"), [F.desc("attack_count")])
    back = tables.read_csv(spark, str(tmp_path / "m"), c.ATTACK_VOLUME_BY_COUNTRY)
    assert [r["country"] for r in back.collect()] == ["DE", "US"]
