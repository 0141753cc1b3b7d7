"""Codes for vectors: a codebook per part, found with adaptive distance bounds.

Every component becomes an integer, floor(256 x). A vector is cut into equal parts, and the
parts at one position share a codebook. A round assigns every part to its nearest entry
and moves the entries. Between rounds each part keeps its nearest entry, the next b entries
with lower bounds of their distances in rising order, and one outer bound that holds
for all other entries (the adaptive bounds of Drake and Hamerly). When entries have moved,
bounds shrink by as much; only a part whose own distance isn't below its first bound looks at
entries again, at as many as its bounds leave open, and at all of them only beyond the outer
bound. Bounds are rounded to the safe side; what they leave open is decided by whole numbers.
After each round b shrinks to what nearly all parts needed.

Defined cases. Rows whose vector is null or holds a null or non-finite component take no
part. The row of the smallest id gives the number of components; rows with another number
take no part. A number that can't be divided into equal parts is filled up with zeros.
Repeated rows and ids count each; a null id comes last; rows with one id are ordered by their
components. With fewer rows than entries a codebook has one entry per row. Components of
huge size saturate (64 components: at 2^27, that is x = 524,288), so that distances fit
into 64 bits. An empty table gives an empty table. Other columns are ignored.

Scale: rows are written once per round with their bounds. What reaches the driver is
the codebooks and their sums: entries x components numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from vigilframe.llm.common import small_batches
from vigilframe.session import settle

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
COVER = 0.99
"""b shrinks to what this share of the parts needed."""

FEW_LABELS = 1_000_000
"""Sums of more labels than this aren't broadcast."""

SALTS = 16
SLICE = 4096
_SAFE = 2.0 ** -50
_STATE = "id {id}, label {label}, parts array<int>, near binary, lower binary, outer binary, used binary"


@dataclass(frozen=True)
class Codebooks:
    """``entries[part, entry]`` are the components of one entry; ``size`` is the vectors' own length."""

    entries: np.ndarray
    size: int

    @property
    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _limit(size: int) -> int:
    """The largest component at which a vector's squared distance stays below 2^62."""
    return 1 << ((62 - max(size - 1, 1).bit_length()) // 2 - 1)


def _is_good(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def whole_numbers(vector: Column, size: int, parts: int = PARTS) -> Column:
    """floor(256 x) of every component, filled up with zeros to equal parts."""
    top = float(_limit(size))
    scaled = F.transform(vector, lambda x: F.floor(
        F.greatest(F.lit(-top), F.least(F.lit(top), x.cast("double") * SCALE))).cast("int"))
    missing = -size % parts
    return F.concat(scaled, F.array_repeat(F.lit(0), missing)) if missing else scaled


def _nearest(x: np.ndarray, book: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For parts ``x`` at one position: the b + 1 closest entries, bounds of all but the first, and the outer bound."""
    n, k = len(x), len(book)
    xf, cf = x.astype(float), book.astype(float)
    x2, c2 = (xf * xf).sum(1), (cf * cf).sum(1)
    d = x2[:, None] - 2 * (xf @ cf.T) + c2
    size = float(x2.max(initial=0) + c2.max(initial=0))
    slack = 0.0 if size < 2.0 ** 49 else size * 2.0 ** -46
    best = d.argmin(1)
    if slack:
        open_rows = np.flatnonzero((d <= (d[np.arange(n), best] + 2 * slack)[:, None]).sum(1) > 1)
        for at in range(0, len(open_rows), 256):
            rows = open_rows[at:at + 256]
            best[rows] = ((x[rows][:, None, :] - book) ** 2).sum(2).argmin(1)
    d[np.arange(n), best] = -1
    low = np.sqrt(np.maximum(d - slack, 0)) * (1 - _SAFE)
    if b + 1 < k:
        part = np.argpartition(d, b + 1, axis=1)
        outer = low[np.arange(n), part[:, b + 1]]
        part = part[:, :b + 1]
    else:
        part, outer = np.broadcast_to(np.arange(k), (n, k)), np.full(n, np.inf)
    order = np.argsort(np.take_along_axis(d, part, 1), axis=1, kind="stable")
    near = np.take_along_axis(part, order, 1)
    return near, np.take_along_axis(low, near[:, 1:], 1), outer


def _down(bounds: np.ndarray) -> np.ndarray:
    """As 32-bit numbers that are never above."""
    short = bounds.astype(np.float32)
    return np.where(short > bounds, np.nextafter(short, np.float32(-np.inf)), short)


def _again(
    x: np.ndarray, book: np.ndarray, moved: np.ndarray, near: np.ndarray, lower: np.ndarray, outer: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """New ranks and bounds after entries moved; also how many ranks each part had to look at.

    ``b + 1`` of these says that the outer bound didn't hold and all entries were looked at.
    """
    n, b = lower.shape
    own = np.sqrt(((x - book[near[:, 0]]) ** 2).sum(1).astype(float)) * (1 + _SAFE)
    lower = (lower.astype(float) - moved[near[:, 1:]]) - np.abs(lower) * _SAFE
    outer = outer.astype(float) - moved.max(initial=0) - np.abs(np.where(np.isinf(outer), 0, outer)) * _SAFE
    bounds = np.column_stack([lower, outer])
    bounds = np.minimum.accumulate(bounds[:, ::-1], axis=1)[:, ::-1]
    holds = own[:, None] < bounds
    need = np.where(holds.any(1), holds.argmax(1), b + 1)
    lower, outer, near = bounds[:, :b].copy(), bounds[:, b].copy(), near.copy()
    for j in np.unique(need[(need > 0) & (need <= b)]):
        rows = np.flatnonzero(need == j)
        tried = near[rows, :j + 1]
        d = ((x[rows][:, None, :] - book[tried]) ** 2).sum(2)
        order = np.lexsort((tried, d), axis=1)
        near[rows, :j + 1] = np.take_along_axis(tried, order, 1)
        lower[rows, :j] = np.sqrt(np.take_along_axis(d, order, 1)[:, 1:].astype(float)) * (1 - _SAFE)
    rows = np.flatnonzero(need == b + 1)
    if len(rows):
        near[rows], lower[rows], outer[rows] = _nearest(x[rows], book, b)
    return near, lower, outer, need


def _ints(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def _raw(column: pa.Array, kind, *shape: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), *shape)


def _binary(values: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(values).reshape(len(values), -1)
    return pa.array([row.tobytes() for row in data], pa.binary())


def _first_round(book: np.ndarray, b: int):
    parts, k, m = book.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                rows = batch.slice(at, SLICE)
                x = _ints(rows.column("parts"), parts * m).reshape(-1, parts, m)
                found = [_nearest(x[:, p], book[p], b) for p in range(parts)]
                near, lower, outer = (np.stack([f[i] for f in found], 1) for i in range(3))
                yield _state(rows, near, lower, outer, np.zeros(near.shape[:2]))

    return run


def _state(rows: pa.RecordBatch, near, lower, outer, used) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [rows.column("id"), rows.column("label"), rows.column("parts"), _binary(near.astype(np.uint8)),
         _binary(_down(lower)), _binary(_down(outer)), _binary(used.astype(np.uint8))],
        ["id", "label", "parts", "near", "lower", "outer", "used"])


def _read_state(rows: pa.RecordBatch, parts: int, m: int, b: int, keep: int):
    """The state with the first ``keep`` of its ``b`` bounds; the next one becomes the outer bound."""
    x = _ints(rows.column("parts"), parts * m).reshape(-1, parts, m)
    near = _raw(rows.column("near"), np.uint8, parts, b + 1).astype(np.int64)
    lower = _raw(rows.column("lower"), np.float32, parts, b)
    outer = _raw(rows.column("outer"), np.float32, parts)
    if keep < b:
        outer = np.minimum(outer, lower[:, :, keep:].min(2))
    return x, near[:, :, :keep + 1], lower[:, :, :keep], outer


def _next_round(book: np.ndarray, moved: np.ndarray, b: int, keep: int, last: bool):
    parts, k, m = book.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                rows = batch.slice(at, SLICE)
                x, *held = _read_state(rows, parts, m, b, keep)
                found = [_again(x[:, p], book[p], moved[p], *(h[:, p] for h in held)) for p in range(parts)]
                near, lower, outer, used = (np.stack([f[i] for f in found], 1) for i in range(4))
                if not last:
                    yield _state(rows, near, lower, outer, used)
                    continue
                code = near[:, :, 0]
                error = ((x - book[np.arange(parts), code]) ** 2).sum((1, 2))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id"), rows.column("label"), _binary(code.astype(np.uint8)), pa.array(error, pa.int64())],
                    ["id", "label", "code", "error"])

    return run


def _partial_sums(parts: int, k: int, m: int, b: int):
    """Per task, the sum and number of the parts of every entry, and how often a number of ranks was looked at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, k, m), np.int64), np.zeros((parts, k), np.int64)
        used = np.zeros(b + 2, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                rows = batch.slice(at, SLICE)
                x = _ints(rows.column("parts"), parts * m).reshape(-1, parts, m)
                near = _raw(rows.column("near"), np.uint8, parts, b + 1)[:, :, 0].astype(np.int64)
                used += np.bincount(_raw(rows.column("used"), np.uint8, parts).ravel(), minlength=b + 2)
                for p in range(parts):
                    counts[p] += np.bincount(near[:, p], minlength=k)
                    order = np.argsort(near[:, p], kind="stable")
                    entries, starts = np.unique(near[order, p], return_index=True)
                    if m:
                        sums[p, entries] += np.add.reduceat(x[order, p], starts, axis=0)
        at = np.argwhere(counts > 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at[:, 0], pa.int32()), pa.array(at[:, 1], pa.int32()), pa.array(counts[counts > 0], pa.int64()),
             pa.array(sums[counts > 0].tolist(), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1] * (b + 2), pa.int32()), pa.array(range(b + 2), pa.int32()), pa.array(used, pa.int64()),
             pa.array([[]] * (b + 2), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])

    return run


def _moved_entries(state: DataFrame, book: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """The next codebooks, how far each entry moved (rounded up), and how many parts looked at 0, 1, ... ranks."""
    parts, k, m = book.shape
    partial = state.select("parts", "near", "used").mapInArrow(
        _partial_sums(parts, k, m, b), "part int, entry int, n long, sums array<long>")
    wide = partial.select("part", "entry", "n", F.posexplode_outer("sums").alias("place", "x"))
    total = wide.groupBy("part", "entry", "place").agg(
        F.sum(F.col("x").cast("decimal(20,0)")).alias("x"), F.sum("n").alias("n"))
    book2, used = book.copy(), [0] * (b + 2)
    for row in total.collect():
        if row.part < 0:
            used[row.entry] = row.n
        elif row.place is not None:
            book2[row.part, row.entry, row.place] = int(row.x) // row.n
    step = np.sqrt(((book2 - book) ** 2).sum(2).astype(float)) * (1 + _SAFE)
    return book2, step, used


def narrower(used: list[int], b: int, cover: float = COVER) -> int:
    """The smallest number of bounds that would have been enough for nearly all parts.

    Parts that had to look at all entries don't count: more of the bounds wouldn't have helped them.
    """
    settled = np.cumsum(used[:b + 1])
    if not settled[-1]:
        return b
    return min(b, max(1, int(np.searchsorted(settled, cover * settled[-1]))))


def fit(
    rows: DataFrame, column: str, id_column: str, label_column: str,
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, bounds: int | None = None,
) -> tuple[Codebooks, DataFrame] | None:
    """Codebooks and a table of id, label, code (a byte per part) and error; None for no rows.

    At most 256 ``entries``. ``bounds`` is the first b, an eighth of the entries unless given.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte: entries must lie in 1 to 256")
    vector = F.col(column)
    good = small_batches(rows).filter(_is_good(vector)).select(
        F.col(id_column).alias("id"), F.col(label_column).alias("label"), vector.alias("vector"))
    by_id = F.col("id").asc_nulls_last()
    first = good.orderBy(by_id, "vector").select(F.size("vector").alias("n")).first()
    if first is None:
        return None
    size = first["n"]
    good = good.filter(F.size("vector") == size).select("id", "label", whole_numbers(F.col("vector"), size, parts).alias("parts"))
    m = (size + -size % parts) // parts
    seeds = [r["parts"] for r in good.orderBy(by_id, "parts").select("parts").limit(entries).collect()]
    book = np.array(seeds, np.int64).reshape(len(seeds), parts, m).transpose(1, 0, 2).copy()
    b = keep = min(max(1, entries // 8) if bounds is None else bounds, len(seeds) - 1)
    types = {f.name: f.dataType.simpleString() for f in good.schema}
    schema = _STATE.format(**types)
    state = settle(good.mapInArrow(_first_round(book, b), schema), "vector-bounds")
    for number in range(1, rounds + 1):
        book, step, used = _moved_entries(state, book, b)
        keep = b if number == 1 else narrower(used, b)
        if number < rounds:
            state = settle(state.mapInArrow(_next_round(book, step, b, keep, False), schema), "vector-bounds")
            b = keep
    codes = state.mapInArrow(
        _next_round(book, step, b, keep, True), f"id {types['id']}, label {types['label']}, code binary, error long")
    return Codebooks(book, size), settle(codes, "vector-codes")


def errors_by_label(codes: DataFrame, few: int = FEW_LABELS) -> DataFrame:
    """``codes`` with ``label_error``, the sum of errors of all rows of the same label, nulls together.

    A sum beyond 64 bits saturates. Sums are broadcast up to ``few`` labels; beyond, rows of
    one label are dealt over several tasks and the sums repeated.
    """
    top = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    sums = settle(codes.groupBy("label").agg(
        F.least(F.sum(F.col("error").cast("decimal(20,0)")).cast("decimal(38,0)"), top).cast("long").alias("label_error")), "label-errors")
    same = F.col("a.label").eqNullSafe(F.col("s.label"))
    if sums.count() <= few:
        return codes.alias("a").join(F.broadcast(sums).alias("s"), same).select("a.*", "label_error")
    dealt = codes.withColumn("_salt", F.pmod(F.xxhash64("id", "code"), F.lit(SALTS)).cast("int"))
    sums = sums.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = dealt.alias("a").join(sums.alias("s"), same & (F.col("a._salt") == F.col("s._salt")))
    return joined.select("a.*", "label_error").drop("_salt")


def compress(
    rows: DataFrame, column: str = "embedding", id_column: str = "vec_id", label_column: str = "label", **options
) -> DataFrame:
    """id, code in hex digits, error, label_error and the digest of the codebooks of every kept row."""
    types = {f.name: f.dataType for f in rows.schema}
    found = fit(rows, column, id_column, label_column, **options)
    if found is None:
        return rows.sparkSession.range(0).select(
            F.lit(None).cast(types[id_column]).alias(id_column), F.lit("").alias("code"), F.col("id").alias("error"),
            F.col("id").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    books, codes = found
    return errors_by_label(codes).select(
        F.col("id").alias(id_column), F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(books.digest).alias("codebooks_sha256"))
