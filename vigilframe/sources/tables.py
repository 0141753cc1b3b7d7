"""Tables kept as Parquet directories, with a list of the directories that are the table.

Every write goes to a directory of its own, ``gen=...``, and then becomes visible at once by
a new snapshot: a small numbered file in ``_table`` that lists the directories. A job that
dies before leaves the table as it was; readers see the snapshot that they started with. The
directories of the two newest snapshots stay, older ones are removed. One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from vigilframe.operators.dedup import latest_per_key, same_keys
from vigilframe.sources import files
from vigilframe.sources.contracts import TABLES, conform

DISPOSITIONS = ("replace", "append", "merge")
_GENERATION = "gen"


def table_path(base: str, name: str) -> str:
    """One directory per table below a base URI: ``silver.silver_events`` -> ``base/silver/silver_events``."""
    return f"{base.rstrip('/')}/{name.replace('.', '/')}"


@dataclass(frozen=True)
class Snapshot:
    """What a table consists of: directories below its path, and notes of its writers."""

    number: int = 0
    directories: tuple[str, ...] = ()
    marks: dict = field(default_factory=dict)


def _snapshots(spark: SparkSession, path: str) -> list[Snapshot]:
    """All that were written completely, the newest first, with the number of every file."""
    found = []
    for name in sorted(files.children(spark, f"{path}/_table"), reverse=True):
        if not name.endswith(".json") or name.startswith("."):
            continue
        try:
            held = json.loads(files.text_of(spark, f"{path}/_table/{name}"))
            found.append(Snapshot(int(name[:-5]), tuple(held["directories"]), held["marks"]))
        except ValueError:  # its writer died
            found.append(Snapshot(int(name[:-5]), ("",)))
    return found


def snapshot(spark: SparkSession, path: str) -> Snapshot:
    """The table as it is now; number 0 and no directory if it has never been written."""
    return next((s for s in _snapshots(spark, path) if s.directories != ("",)), Snapshot())


def _commit(spark: SparkSession, path: str, directories: list[str], marks: dict) -> None:
    """Make these directories the table, and remove what neither this snapshot nor the one before holds."""
    before = _snapshots(spark, path)
    number = before[0].number + 1 if before else 1
    text = json.dumps({"directories": sorted(directories), "marks": marks})
    files.create(spark, f"{path}/_table/{number:012d}.json", text)
    last = next((s for s in before if s.directories != ("",)), Snapshot())
    for old in before:
        if old.number != last.number:
            files.remove(spark, f"{path}/_table/{old.number:012d}.json")
    held = {d.split("/")[0] for d in (*directories, *last.directories)}
    for name in files.children(spark, path):
        if name.startswith((f"{_GENERATION}=", "_work-")) and name not in held:
            files.remove(spark, f"{path}/{name}")


def _reader(spark: SparkSession, path: str):
    return spark.read.option("basePath", path)


def read_table(
    spark: SparkSession, path: str, contract: T.StructType, partition: str | None = None
) -> DataFrame:
    """The contract's columns of the table; an empty table when it has never been written.

    Files written before a column was added give NULL for it. ``partition`` names a date
    partition column to show as well, so that filters on it prune directories.
    """
    extra = [T.StructField(partition, T.DateType())] if partition else []
    schema = T.StructType(_nullable(contract).fields + extra)
    held = snapshot(spark, path).directories
    if not held:
        return spark.createDataFrame([], schema)
    return _reader(spark, path).schema(schema).parquet(*_paths(path, held)).select(*schema.fieldNames())


def scan(spark: SparkSession, path: str) -> DataFrame:
    """All columns that any file of the table has; an error if it has never been written."""
    held = snapshot(spark, path).directories
    if not held:
        raise ValueError(f"no table at {path}")
    return _reader(spark, path).option("mergeSchema", "true").parquet(*_paths(path, held)).drop(_GENERATION)


def _paths(path: str, directories) -> list[str]:
    return [f"{path}/{d}" for d in directories]


def _nullable(contract: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in contract])


def row_count(spark: SparkSession, path: str) -> int:
    """Rows in the table, 0 when it does not exist (answered from Parquet footers)."""
    held = snapshot(spark, path).directories
    return _reader(spark, path).schema("_any string").parquet(*_paths(path, held)).count() if held else 0


def write_table(
    df: DataFrame,
    path: str,
    disposition: str = "replace",
    keys: list[str] | None = None,
    order: list[Column] | None = None,
    partition: str | None = None,
    name: str | None = None,
    marks: dict | None = None,
) -> None:
    """Write with disposition ``replace``, ``append`` or ``merge`` (needs ``keys`` and ``order``).

    ``name`` makes an append repeatable: one of a name that the table holds already does
    nothing, and one that was cut off starts over. ``marks`` are kept with the snapshot.
    """
    if disposition not in DISPOSITIONS:
        raise ValueError(f"disposition must be one of {DISPOSITIONS}, got {disposition!r}")
    if disposition == "merge":
        if not keys or not order:
            raise ValueError("merge needs keys, and an order that decides between rows of one key")
        merge_table(df, path, keys, order, partition, marks=marks)
        return
    spark = df.sparkSession
    before = snapshot(spark, path)
    generation = f"{_GENERATION}={name or uuid.uuid4().hex}"
    if name and any(d.split("/")[0] == generation for d in before.directories):
        return
    _write(df, f"{path}/{generation}", partition)
    held = _written(spark, path, generation, partition)
    if disposition == "append":
        held = [*before.directories, *held]
    _commit(spark, path, held, before.marks | (marks or {}))


def merge_table(
    batch: DataFrame,
    path: str,
    keys: list[str],
    order: list[Column] | None,
    partition: str | None = None,
    key_keeps_partition: bool = False,
    marks: dict | None = None,
) -> None:
    """Upsert ``batch`` into the table at ``path``, rewriting only touched partitions.

    ``order`` decides among all rows of one key, those of the batch and the stored one, so an
    older version that comes late changes nothing. None says that the batch has each key
    once and always replaces what is stored, as a recomputed aggregate does. Keys may be
    NULL. With ``partition`` (a date or integer column) only partitions that hold a key of
    the batch or receive one are rewritten; ``key_keeps_partition`` says a key never changes
    partition, which saves looking the keys up in the whole table. Columns only the table
    or only the batch has are kept and read as NULL on the other side.

    A row of the batch is written twice, as the batch's own copy and to its partition.
    """
    spark = batch.sparkSession
    if partition and batch.schema[partition].dataType.typeName() not in ("date", "integer", "long"):
        raise ValueError(f"partition column {partition} must be a date or an integer")
    before = snapshot(spark, path)
    work = f"{path}/_work-{uuid.uuid4().hex}"
    _write(latest_per_key(batch, keys, order) if order else batch, work, None)
    fresh = spark.read.schema(batch.schema).parquet(work)
    if fresh.isEmpty():
        if marks:
            _commit(spark, path, list(before.directories), before.marks | marks)
        files.remove(spark, work)
        return
    kept, touched = [], list(before.directories)
    if partition and before.directories:
        values = _touched(spark, path, before.directories, fresh, keys, partition, key_keeps_partition)
        touched = [d for d in before.directories if d.rpartition("/")[2] in values]
        kept = [d for d in before.directories if d.rpartition("/")[2] not in values]
    rows = fresh
    if touched:
        target = _reader(spark, path).option("mergeSchema", "true").parquet(*_paths(path, touched)).drop(_GENERATION)
        if partition:
            target = target.withColumn(partition, F.col(partition).cast(batch.schema[partition].dataType))
        if order:
            rivals = target.join(fresh.select(*_renamed(keys)), same_keys(target, keys), "left_semi")
            rows = latest_per_key(rivals.unionByName(fresh, allowMissingColumns=True), keys, order)
        rest = target.join(fresh.select(*_renamed(keys)), same_keys(target, keys), "left_anti")
        rows = rest.unionByName(rows, allowMissingColumns=True)
    generation = f"{_GENERATION}={uuid.uuid4().hex}"
    _write(rows, f"{path}/{generation}", partition)
    _commit(spark, path, kept + _written(spark, path, generation, partition), before.marks | (marks or {}))
    files.remove(spark, work)


def _renamed(keys: list[str]) -> list[Column]:
    return [F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)]


def _touched(
    spark: SparkSession, path: str, directories, fresh: DataFrame, keys: list[str], partition: str, key_keeps_partition: bool
) -> set[str]:
    """Names of partitions to rewrite; their number is bounded by those of the table and the batch.

    Looking keys up reads the key columns only.
    """
    values = fresh.select(partition)
    if not key_keeps_partition:
        narrow = T.StructType([T.StructField(c, fresh.schema[c].dataType) for c in dict.fromkeys([*keys, partition])])
        held = _reader(spark, path).schema(narrow).parquet(*_paths(path, directories))
        found = held.join(fresh.select(*_renamed(keys)), same_keys(held, keys), "left_semi")
        values = values.union(found.select(partition))
    names = (row[0] for row in values.distinct().collect())
    return {f"{partition}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for v in names}


def _write(df: DataFrame, path: str, partition: str | None) -> None:
    """Overwrite. Rows of a partitioned table are first brought together by partition;
    AQE splits a large partition and merges small ones to its advisory size."""
    if partition:
        df.hint("rebalance", partition).write.mode("overwrite").partitionBy(partition).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def _written(spark: SparkSession, path: str, generation: str, partition: str | None) -> list[str]:
    """The directories of a generation that hold rows."""
    if not partition:
        return [generation]
    return [f"{generation}/{name}" for name in files.children(spark, f"{path}/{generation}") if name.startswith(f"{partition}=")]


def replace_from(
    spark: SparkSession, base: str, name: str, build: Callable[[], DataFrame]
) -> DataFrame:
    """Full refresh of a contract table: build, conform, overwrite, read back."""
    path = table_path(base, name)
    write_table(conform(build(), TABLES[name]), path)
    return read_table(spark, path, TABLES[name])


# Exchange formats.

_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def export(df: DataFrame, base: str, formats: tuple[str, ...] = ("jsonl", "parquet")) -> dict[str, str]:
    """Write ``df`` in each format below ``base``; returns format -> path.

    JSON lines carry ISO-8601 times and explicit nulls. All formats are written by the
    tasks that hold the rows.
    """
    paths = {}
    for fmt in formats:
        path = f"{base.rstrip('/')}/{fmt}"
        writer = df.write.mode("overwrite")
        if fmt == "jsonl":
            writer.option("timestampNTZFormat", _ISO).option("timestampFormat", _ISO + "XXX").option(
                "ignoreNullFields", "false"
            ).json(path)
        elif fmt == "parquet":
            writer.parquet(path)
        elif fmt == "csv":
            writer.option("header", "true").option("timestampNTZFormat", _ISO).csv(path)
        else:
            raise ValueError(f"unknown format {fmt!r}")
        paths[fmt] = path
    return paths


def export_mart(df: DataFrame, path: str, order: list) -> None:
    """One sorted CSV file of a finished mart (days, countries, one KPI row)."""
    df.orderBy(*order).coalesce(1).write.mode("overwrite").option("header", "true").csv(path)


def read_csv(spark: SparkSession, path: str, contract: T.StructType) -> DataFrame:
    """An exported mart; the contract gives the types, nothing is inferred."""
    return spark.read.option("header", "true").schema(_nullable(contract)).csv(path)


def read_jsonl(spark: SparkSession, path: str, contract: T.StructType) -> DataFrame:
    """Exported JSON lines back into typed rows."""
    return spark.read.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]").schema(
        _nullable(contract)
    ).json(path)
