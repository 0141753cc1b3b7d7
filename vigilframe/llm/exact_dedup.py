"""Exact dedup by composable polynomial fingerprints.

A text's bytes, without ASCII white space, are cut into chunks. The hash of a chunk is the
sum of (byte + 1) * BASE ** place modulo a prime, so hash(a + b) = hash(a) + BASE ** len(a)
* hash(b): chunks are hashed side by side and combined afterwards, also when a huge text
spans several slices. Two primes and the length make a fingerprint. Texts that share one
are compared chunk by chunk; should they differ after all, their SHA-256 tells them apart.

Edge cases: a null text equals the empty one; rows repeated with one id are told apart by
a row number, so that exactly one row of a group stays; a null id is the largest; an empty
table gives an empty result. Columns of the input other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vigilframe.llm.common import bytes_of, let_go, slices, small_batches
from vigilframe.session import settle

PRIMES = (2147483647, 2147483629)
BASES = (1000003, 69069)
CHUNK = 1024
SLICE = 1 << 20
COMPARED = 1 << 16
"""Bytes that are compared at a time."""

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _powers(prime: int, base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    for i in range(1, n):
        out[i] = int(out[i - 1]) * base % prime
    return out


_PLACES = [_powers(p, b, CHUNK) for p, b in zip(PRIMES, BASES)]


def combine(left: tuple[int, int, int], right: tuple[int, int, int]) -> tuple[int, int, int]:
    """Fingerprint (hash, hash, length) of two texts one after the other."""
    n = left[2]
    return (*((left[i] + pow(BASES[i], n, PRIMES[i]) * right[i]) % PRIMES[i] for i in (0, 1)), n + right[2])


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
    """One per value of ``offsets``; all chunks of all values are hashed at once."""
    lengths = np.diff(offsets)
    chunks = -(-lengths // CHUNK)
    out = np.zeros((len(lengths), 2), np.uint64)
    if len(data):
        first = np.cumsum(chunks) - chunks
        nth = np.arange(int(chunks.sum())) - np.repeat(first, chunks)
        starts = np.repeat(offsets[:-1], chunks) + nth * CHUNK
        place = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
        value = data.astype(np.uint64) + np.uint64(1)
        some = chunks > 0
        for i, (prime, base) in enumerate(zip(PRIMES, BASES)):
            p = np.uint64(prime)
            hashed = np.add.reduceat(value * _PLACES[i][place], starts) % p
            shift = _powers(prime, pow(base, CHUNK, prime), int(chunks.max()))
            out[some, i] = np.add.reduceat(hashed * shift[nth] % p, first[some]) % p
    return [(int(a), int(b), int(n)) for (a, b), n in zip(out, lengths)]


def _normal(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keep = ~_SPACE[data]
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(keep, out=before[1:])
    return data[keep], before[offsets]


def _values(column) -> Iterator[tuple[tuple[int, int, int], list[np.ndarray]]]:
    """Fingerprint and normal bytes, in pieces, of every value."""
    data, offsets = bytes_of(column)
    for at, to in slices(offsets, SLICE):
        low, high = offsets[at], offsets[to]
        if to == at + 1 and high - low > SLICE:
            print_, pieces = (0, 0, 0), []
            for start in range(low, high, SLICE):
                piece = data[start:min(start + SLICE, high)]
                piece = piece[~_SPACE[piece]]
                print_ = combine(print_, fingerprints(piece, np.array([0, len(piece)]))[0])
                pieces.append(piece)
            yield print_, pieces
        else:
            normal, ends = _normal(data[low:high], offsets[at:to + 1] - low)
            for i, print_ in enumerate(fingerprints(normal, ends)):
                yield print_, [normal[ends[i]:ends[i + 1]]]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    let_go()
    for batch in batches:
        prints, shas = [], []
        for print_, pieces in _values(batch.column("text")):
            sha = hashlib.sha256()
            for piece in pieces:
                sha.update(piece)
            prints.append(print_)
            shas.append(sha.hexdigest())
        a, b, n = zip(*prints) if prints else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("row"), batch.column("n_chars"),
             pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64()), pa.array(shas, pa.string())],
            ["doc_id", "row", "n_chars", "print_a", "print_b", "n_bytes", "text_sha256"])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for (a, b, n), pieces in _values(batch.column("text")):
            parts = [p[i:i + COMPARED].tobytes() for p in pieces for i in range(0, len(p), COMPARED)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x] * len(parts), pa.int64()) for x in (a, b, n)]
                + [pa.array(range(len(parts)), pa.int64()), pa.array(parts, pa.binary())],
                ["print_a", "print_b", "n_bytes", "nth", "chunk"])


PRINT = ["print_a", "print_b", "n_bytes"]


def digests(docs: DataFrame, row: str | None = None) -> DataFrame:
    """doc_id, row, n_chars (null: 0), print_a, print_b, n_bytes, text_sha256 of every row.

    ``row`` names a column that numbers the rows; without one they are numbered here.
    """
    read = small_batches(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.col(row) if row else F.monotonically_increasing_id()).alias("row"),
        F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"), F.col("text").cast("string").alias("text"))
    return read.mapInArrow(
        _digests, "doc_id long, row long, n_chars long, print_a long, print_b long, n_bytes long, text_sha256 string")


def unequal_prints(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Fingerprints that documents of ``ids`` share although their texts differ, by chunkwise comparison.

    The chunks of one place in a group are equal if the smallest is the largest. Both are
    kept per map task before the shuffle, however many copies a text has.
    """
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).alias("d").join(
        ids.alias("i"), F.col("d.doc_id").eqNullSafe(F.col("i.doc_id")), "left_semi").select("text")
    chunks = found.mapInArrow(_chunks, "print_a long, print_b long, n_bytes long, nth long, chunk binary")
    return (
        chunks.groupBy(*PRINT, "nth").agg(F.min("chunk").alias("low"), F.max("chunk").alias("high"))
        .where("low != high").select(*PRINT).distinct()
    )


def exact_groups(docs: DataFrame, row: str | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row.

    Of equal texts the row with the most code points stays, then the smallest id, then
    the first row. The rows of a hot group are counted per map task first, and join one
    row of their group; AQE splits the hot partition of that join.
    """
    held = settle(digests(docs, row), "digests")
    counted = held.groupBy(*PRINT).agg(F.count("*").alias("n")).where("n > 1")
    shared = settle(held.join(counted, PRINT, "left_semi").select("doc_id").distinct(), "shared-ids")
    unequal = settle(unequal_prints(docs, shared), "unequal-prints").withColumn("unequal", F.lit(True))
    keyed = held.join(unequal, PRINT, "left").withColumn(
        "apart", F.when(F.col("unequal"), F.col("text_sha256")).otherwise("")).drop("unequal")
    key = [*PRINT, "apart"]
    best = F.min(F.struct((-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    groups = settle(
        keyed.groupBy(*key).agg(best.alias("best"), F.count("*").alias("group_size")).where("group_size > 1")
        .select(*key, F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"), "group_size"), "groups")
    return keyed.join(groups, key, "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.coalesce("keep_row", "row") == F.col("row")).alias("kept"), "text_sha256", "row")


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``exact_groups`` doesn't keep.

    The numbered rows are written first: numbers of a second scan could differ, for example
    after the loss of an executor.
    """
    numbered = settle(docs.withColumn("_exact_row", F.monotonically_increasing_id()), "numbered")
    gone = exact_groups(numbered, "_exact_row").where("NOT kept").select(F.col("row").alias("_exact_row"))
    return numbered.join(settle(gone, "copies"), "_exact_row", "left_anti").select(*docs.columns)
