"""Near-duplicate documents: a multi-index Hamming join of MinHash signatures, confirmed on full sets.

A document is its set of distinct shingles of five words. Its signature has 48 MinHash
symbols in 12 chunks of 4. Two signatures that differ in less than 24 symbols agree, by
the pigeonhole principle, in a chunk but for one symbol at most; so every document is
filed under each chunk with each one symbol left out, and all pairs under that distance
share a bucket. At a similarity of 0.75 a pair shares none with a probability of 1e-7.

Equal sets are one class before anything is paired. Pairs are then found in two rounds that
lose no link and don't list a bucket's pairs: first every class is compared with the
smallest of its bucket; what links merges, and only classes of one bucket that are still in
different components are compared with each other, in the bucket's task and in blocks of
bounded size: by a sketch of 256 bytes first, which passes classes on and not pairs, then by
32 bits of each shingle's hash, where components that a link joins aren't compared further.
Links are confirmed on the full sets of 64-bit hashes. Components are found by
alternating stars.

Edge cases: a text without words, or null, has the empty set and links with nothing; one
with fewer than five words has a single shingle, the whole sequence; rows that repeat an id
are one document, linked by it; rows without an id link with nothing; an empty
table gives an empty result. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vigilframe.llm.common import bytes_of, let_go, ranges, release, slices, small_batches
from vigilframe.llm.graph import components
from vigilframe.session import settle

WORDS = 5
CHUNKS, WIDTH = 12, 4
SYMBOLS = CHUNKS * WIDTH
SIMILAR = 75
"""Hundredths of the union that two documents must share."""
AGREEING = 20
"""Symbols in which signatures must agree before sets are compared; at 0.75, fewer have a probability of 1e-7."""
BLOCK = 2048
"""Classes of a bucket that are compared with each other in one go."""
BINS = 256
"""Bins of a sketch: of the hashes with one upper byte, a byte of the least."""
FEW = 500_000
"""Ids, of 8 bytes, that are broadcast; more are joined by a shuffle."""
SLICE = 1 << 20

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_OF_BYTE = _RANDOM.integers(0, 1 << 63, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15
_PLACE = _RANDOM.integers(0, 1 << 63, WORDS, np.uint64) | np.uint64(1)
_XOR = _RANDOM.integers(0, 1 << 63, SYMBOLS, np.uint64)
_TIMES = _RANDOM.integers(0, 1 << 63, SYMBOLS, np.uint64) | np.uint64(1)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers after which all bits look random."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and, per value, how many it has."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    inside = ~_SPACE[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    borders = offsets[:-1][np.diff(offsets) > 0]
    starts[borders] = inside[borders]
    at = np.flatnonzero(starts)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    kept = np.flatnonzero(inside)
    nth = np.cumsum(starts)[kept] - 1
    place = kept - at[nth]
    powers = np.ones(int(place.max()) + 1, np.uint64)
    powers[1:] = np.uint64(_BASE)
    powers = np.multiply.accumulate(powers)
    first = np.searchsorted(kept, at)
    hashes = mixed(np.add.reduceat(_OF_BYTE[_LOWER[data[kept]]] * powers[place], first))
    return hashes, np.diff(np.searchsorted(at, offsets))


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all values, one after the other, and how many each value has."""
    words, many = word_hashes(data, offsets)
    first = np.cumsum(many) - many
    count = np.where(many >= WORDS, many - WORDS + 1, np.minimum(many, 1))
    start = ranges(first, count)
    size = np.repeat(np.minimum(many, WORDS), count)
    total = np.zeros(len(start), np.uint64)
    padded = np.concatenate([words, np.zeros(WORDS, np.uint64)])
    for i in range(WORDS):
        total += np.where(i < size, padded[start + i] * _PLACE[i], np.uint64(0))
    hashes = mixed(total + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    out, sizes, ends = [], np.zeros(len(many), np.int64), np.cumsum(count)
    for i in np.flatnonzero(count):
        own = np.unique(hashes[ends[i] - count[i]:ends[i]])
        sizes[i] = len(own)
        out.append(own)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), sizes


def signatures(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The MinHash symbols of every set, 0 for the empty one."""
    out = np.zeros((len(sizes), SYMBOLS), np.uint32)
    some = sizes > 0
    starts = (np.cumsum(sizes) - sizes)[some]
    if len(starts):
        for j in range(SYMBOLS):
            least = np.minimum.reduceat((hashes ^ _XOR[j]) * _TIMES[j], starts)
            out[some, j] = (mixed(least) >> np.uint64(32)).astype(np.uint32)
    return out


def sketches(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each bin of every set a byte of its least hash, 0 if the bin is empty."""
    out = np.zeros((len(sizes), BINS), np.uint8)
    place = np.repeat(np.arange(len(sizes)) * BINS, sizes) + (hashes >> np.uint64(56)).astype(np.int64)
    if len(place):
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        out.reshape(-1)[place[first]] = (hashes[first] >> np.uint64(40)) % np.uint64(255) + np.uint64(1)
    return out


def _binary(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as byte strings."""
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _matrix(column: pa.Array, kind=np.uint32, width: int = SYMBOLS) -> np.ndarray:
    return bytes_of(column)[0].view(kind).reshape(len(column), width)


def _each_slice(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = bytes_of(batch.column("text"))
    for at, to in slices(offsets, SLICE):
        yield at, to, data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    let_go()
    for batch in batches:
        for at, to, data, offsets in _each_slice(batch):
            hashes, sizes = shingle_sets(data, offsets)
            some, starts = sizes > 0, (np.cumsum(sizes) - sizes)
            names = np.zeros((2, len(sizes)), np.uint64)
            if some.any():
                names[0, some] = np.add.reduceat(hashes, starts[some])
                names[1, some] = np.add.reduceat(mixed(hashes ^ np.uint64(_BASE)), starts[some])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(at, to - at), pa.array(sizes), pa.array(names[0].view(np.int64)),
                 pa.array(names[1].view(np.int64)), _binary(signatures(hashes, sizes)), _binary(sketches(hashes, sizes))],
                ["doc_id", "n_shingles", "set_a", "set_b", "signature", "sketch"])
    release()


SET = ["set_a", "set_b", "n_shingles"]


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_a, set_b (a name of the set), signature and sketch of every row."""
    read = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return read.mapInArrow(_digests, "doc_id long, n_shingles long, set_a long, set_b long, signature binary, sketch binary")


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every chunk with each one of its symbols left out."""
    left_out = [[i for i in range(WIDTH) if i != out] for out in range(WIDTH)]
    for batch in batches:
        if not batch.num_rows:
            continue
        chunks = _matrix(batch.column("signature")).reshape(-1, CHUNKS, WIDTH).astype(np.uint64)
        keys = np.empty((len(chunks), CHUNKS, WIDTH), np.uint64)
        for out, kept in enumerate(left_out):
            total = np.arange(CHUNKS, dtype=np.uint64) * np.uint64(WIDTH) + np.uint64(out)
            for i in kept:
                total = mixed(total + chunks[:, :, i] * np.uint64(_BASE) + np.uint64(i))
            keys[:, :, out] = total
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.reshape(-1).view(np.int64)), pa.array(np.repeat(batch.column("node").to_numpy(), SYMBOLS))], ["key", "node"])
    release()


def _sets(short: bool):
    """Sets of documents: all hashes in full, or sorted 32-bit parts of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, offsets in _each_slice(batch):
                hashes, sizes = shingle_sets(data, offsets)
                some, starts = sizes > 0, np.cumsum(sizes) - sizes
                names = np.zeros((2, len(sizes)), np.uint64)
                if some.any():
                    names[0, some] = np.add.reduceat(hashes, starts[some])
                    names[1, some] = np.add.reduceat(mixed(hashes ^ np.uint64(_BASE)), starts[some])
                own = (hashes[a:a + n] for a, n in zip(starts, sizes))
                held = [(np.unique((x & np.uint64(0xFFFFFFFF)).astype(np.uint32)) if short else x).tobytes() for x in own]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc").slice(at, to - at), pa.array(names[0].view(np.int64)), pa.array(names[1].view(np.int64)),
                     pa.array(sizes), pa.array(held, pa.binary())], ["doc", *SET, "held"])
        release()

    return run


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures agree in enough symbols."""
    for batch in batches:
        same = (_matrix(batch.column("sig_a")) == _matrix(batch.column("sig_b"))).sum(1)
        yield batch.select(["a", "b"]).filter(pa.array(same >= AGREEING))


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """How many elements two sorted sets share."""
    if len(x) < len(y):
        x, y = y, x
    return int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sets share enough."""
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("set_of_a"), batch.column("set_of_b")):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            both = _common(x, y)
            keep.append(100 * both >= SIMILAR * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    release()


class _Bucket:
    """The rows of a bucket, or of two blocks of a large one; those of two blocks are compared across."""

    def __init__(self, rows: pa.Table):
        self.rows = rows
        self.block, self.node, label, self.size = (rows.column(c).to_numpy() for c in ("block", "node", "label", "n_shingles"))
        self.cross = rows.column("one")[0].as_py() != rows.column("two")[0].as_py()
        self.label = np.unique(label, return_inverse=True)[1]

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of different components whose sizes allow a link, a bounded number at a time."""
        n = len(self.node)
        for at in range(0, n, 128):
            own = np.arange(at, min(at + 128, n))[:, None]
            good = (self.label[own] != self.label) & (100 * np.minimum(self.size[own], self.size) >= SIMILAR * np.maximum(self.size[own], self.size))
            good &= self.block[own] < self.block if self.cross else self.node[own] < self.node
            i, j = np.nonzero(good)
            for k in range(0, len(i), 1 << 14):
                yield i[k:k + (1 << 14)] + at, j[k:k + (1 << 14)]

    def likely(self) -> pa.RecordBatch:
        """The rows that could have a link to another one, by their sketches.

        Among the bins that either set fills, the share with one least hash has the mean of
        the similarity; pairs more than five standard deviations below a link's are out.
        """
        sketch, wanted = _matrix(self.rows.column("sketch").combine_chunks(), np.uint8, BINS), SIMILAR / 100
        found = np.zeros(len(self.node), bool)
        for i, j in self.pairs():
            x, y = sketch[i], sketch[j]
            filled = np.count_nonzero(x | y, axis=1)
            same = np.count_nonzero((x == y) & (x > 0), axis=1)
            near = same >= wanted * filled - 5 * np.sqrt(wanted * (1 - wanted) * filled) - 1
            found[i[near]] = found[j[near]] = True
        kept = self.rows.select(_OPEN).filter(pa.array(found)).combine_chunks().to_batches()
        return kept[0] if kept else None

    def links(self) -> pa.RecordBatch:
        """Pairs that are links, enough of them to join all components that any link of the bucket joins.

        Parts of hashes agree by chance: in n * m / 2 ** 32 places, which is far below one but for the longest texts.
        """
        sets = [np.frombuffer(x.as_buffer(), np.uint32) for x in self.rows.column("held")]
        a, b = [], []
        for i, j in self.pairs():
            for k, m in zip(i, j):
                if self.label[k] != self.label[m]:
                    x, y = sets[k], sets[m]
                    both, margin = _common(x, y), len(x) * len(y) >> 30
                    either = len(x) + len(y) - both
                    if 100 * (both + margin) >= SIMILAR * (either - margin):
                        a.append(min(self.node[k], self.node[m]))
                        b.append(max(self.node[k], self.node[m]))
                        if 100 * (both - margin) >= SIMILAR * (either + margin):
                            self.label[self.label == self.label[m]] = self.label[k]
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]) if a else None


_OPEN = ["key", "one", "two", "block", "node", "label", "n_shingles"]


def _per_bucket(method: str):
    """A method of ``_Bucket`` over rows sorted by bucket and blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def made(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            if rows.num_rows > 1 and (found := getattr(_Bucket(rows), method)()) is not None:
                yield found

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if held is not None:
                rows = pa.concat_tables([held, rows])
            marks = [rows.column(c).to_numpy() for c in _OPEN[:3]]
            ends = np.flatnonzero(np.any([m[1:] != m[:-1] for m in marks], axis=0)) + 1
            at = 0
            for to in ends:
                yield from made(rows.slice(at, to - at))
                at = to
            held = rows.slice(at)
        if held is not None:
            yield from made(held)
        release()

    return run


def _sets_of(docs: DataFrame, classes: DataFrame, nodes: DataFrame, name: str, short: bool = False) -> DataFrame:
    """node and held, the set of every class in ``nodes``, from the document that gave the class its id."""
    wanted = settle(classes.select("node", "doc", *SET).join(nodes.distinct(), "node"), f"{name}-nodes")
    ids = wanted.select("doc").distinct()
    if wanted.count() <= FEW:  # then texts needn't be shuffled
        ids = F.broadcast(ids)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text")).join(ids, "doc")
    sets = texts.mapInArrow(_sets(short), "doc long, set_a long, set_b long, n_shingles long, held binary")
    return settle(sets.join(wanted, ["doc", *SET]).dropDuplicates(["node"]).select("node", "held"), f"{name}-sets")


def _confirmed(docs: DataFrame, classes: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """The pairs (a, b) of ``pairs`` that are links, by their full sets."""
    pairs = settle(pairs.distinct(), f"{name}-pairs")
    sets = _sets_of(docs, classes, pairs.select(F.explode(F.array("a", "b")).alias("node")), name)
    of_b = sets.select(F.col("node").alias("b"), F.col("held").alias("set_of_b"))
    of_a = sets.select(F.col("node").alias("a"), F.col("held").alias("set_of_a"))
    both = pairs.join(of_b, "b").join(of_a, "a").select("a", "b", "set_of_a", "set_of_b")
    return settle(both.mapInArrow(_similar, "a long, b long"), f"{name}-links")


def near_groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    held = settle(digests(docs), "signatures")
    usable = held.where("n_shingles > 0 AND doc_id IS NOT NULL")
    named = usable.groupBy(*SET).agg(F.min("doc_id").alias("doc"), F.first("signature").alias("signature"), F.first("sketch").alias("sketch"))
    classes = settle(named.withColumn("node", F.monotonically_increasing_id()), "classes")
    rows = settle(usable.select("doc_id", *SET).join(classes.select("node", *SET), SET).select("doc_id", "node", *SET), "rows")
    keys = classes.select("node", "signature").mapInArrow(_keys, "key long, node long")
    buckets = settle(keys.groupBy("key").agg(F.min("node").alias("leader"), F.count("*").alias("n")).where("n > 1"), "buckets")
    members = settle(keys.join(buckets, "key"), "members")

    # First round: every class with the smallest of its bucket.
    stars = members.where("node != leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    sided = [classes.select(F.col("node").alias(s), F.col("n_shingles").alias(f"n_{s}"), F.col("signature").alias(f"sig_{s}")) for s in "ab"]
    near = stars.join(sided[1], "b").join(sided[0], "a").where(100 * F.least("n_a", "n_b") >= SIMILAR * F.greatest("n_a", "n_b"))
    links = _confirmed(docs, classes, near.select("a", "b", "sig_a", "sig_b").mapInArrow(_agreeing, "a long, b long"), "near")
    # Classes that share an id.
    shared = rows.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("last")).where("a < last").select("doc_id", "a")
    links = settle(links.union(rows.join(settle(shared, "shared-ids"), "doc_id").where("a < node").select("a", F.col("node").alias("b"))), "first-links")

    # Second round: classes of a bucket that the first one didn't bring together.
    parents = components(links)
    labelled = members.join(parents, "node", "left").select("key", "n", "node", F.coalesce("parent", "node").alias("label"))
    open_ = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("key")
    rest = labelled.join(settle(open_, "open-buckets"), "key")
    blocks = F.ceil(F.col("n") / BLOCK)
    rest = rest.withColumn("block", F.pmod(F.xxhash64("node"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    rest = rest.select("key", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block", "node", "label")

    def together(rows: DataFrame) -> DataFrame:
        return rows.repartition("key", "one", "two").sortWithinPartitions("key", "one", "two")

    sketched = together(rest.join(classes.select("node", "n_shingles", "sketch"), "node"))
    likely = settle(sketched.mapInArrow(
        _per_bucket("likely"), "key long, one long, two long, block long, node long, label long, n_shingles long"), "likely")
    with_sets = likely.join(_sets_of(docs, classes, likely.select("node"), "open", short=True), "node")
    more = _confirmed(docs, classes, together(with_sets).mapInArrow(_per_bucket("links"), "a long, b long"), "across")
    parents = components(links.union(more)) if not more.isEmpty() else parents

    rooted = classes.select("node", "doc").join(parents, "node", "left").select("node", "doc", F.coalesce("parent", "node").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("doc").alias("component_id"))
    of_set = settle(classes.select("node", *SET).join(rooted, "node").join(smallest, "root").select(*SET, "component_id"), "of-set")
    found = held.select("doc_id", *SET).join(of_set, SET, "left")
    linked = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    return found.select(
        "doc_id", "n_shingles", F.when(linked, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents whose component has a smaller id."""
    gone = settle(near_groups(docs).where("NOT kept").select(F.col("doc_id").cast("long").alias("_near_id")).distinct(), "near-copies")
    return docs.join(gone, F.col("doc_id").cast("long") == F.col("_near_id"), "left_anti")
