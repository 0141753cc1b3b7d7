"""The few file-system questions Spark's readers do not answer, on any Hadoop path."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a Spark write to ``path`` was committed."""
    return exists(spark, f"{path}/_SUCCESS")


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _fs(spark, path)
    fs.delete(where, True)


def create(spark: SparkSession, path: str, text: str) -> None:
    """A small new file; an error if it is there already."""
    fs, where = _fs(spark, path)
    out = fs.create(where, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def text_of(spark: SparkSession, path: str) -> str:
    """All of a small file."""
    fs, where = _fs(spark, path)
    source = fs.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def children(spark: SparkSession, path: str) -> list[str]:
    fs, where = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def listing(spark: SparkSession, folder: str, pattern: str) -> list[tuple[str, int, int]]:
    """(path, length, modification time in ms) of the files directly in ``folder`` whose names match the glob.

    As long as Spark's own index of the files, which the driver holds for any read of them.
    """
    fs, where = _fs(spark, folder)
    if not fs.exists(where):
        return []
    found = fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where, pattern)) or []
    return sorted((s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in found if s.isFile() and s.getPath().getName()[0] not in "_.")


def total_bytes(spark: SparkSession, path: str) -> int:
    """Bytes below ``path``, 0 when it does not exist."""
    fs, where = _fs(spark, path)
    return fs.getContentSummary(where).getLength() if fs.exists(where) else 0
