"""Repeated byte strings across documents, by suffix arrays.

A byte goes if a string of 50 bytes that covers it also starts in a document with a smaller
id. Suffix arrays of shards of documents can't be merged pair by pair, as the pairs grow
with the square of the input, so the suffixes are dealt by content. Every window of 50
bytes has an anchor, the least of its 25 hashes of 26 bytes; equal windows have equal
anchors. Consecutive windows with one anchor are a piece of 50 to 74 bytes.

1. Every shard names its distinct anchors, to the merger that their hash belongs to.
2. Mergers find, by binary search in sorted arrays, the anchors that several shards have, and
   tell these.
3. For anchors that it shares, or has with several pieces, a shard names each distinct piece
   by its hash, with the smallest document that holds it.
4. Mergers answer with the smallest document of all, which removes the whole piece
   from every larger one, and ask for the bytes of a piece if its anchor has others too.
5. The shard of that smallest document sends the bytes.
6. Mergers sort the windows of these pieces by refinement as Larsson and Sadakane do: ranks
   of 8 bytes, then of 16 and 32 from pairs of ranks, where groups of one are left alone, and
   last of 50 from two overlapping ranks. Equal neighbours in that order share 50 bytes;
   only this one common prefix matters, so it is read off the ranks, and Kasai's scan for
   all lengths isn't needed. The answer says which windows of a piece a smaller document has.
7. Every shard joins the removed stretches of its documents.

However frequent a passage is, a shard names each of its pieces once. All steps use one
shuffle of the texts.

Edge cases: a null text is empty; texts under 50 bytes stay whole; rows that repeat an id
don't remove from each other; rows without an id neither lose nor remove anything; an empty
table gives an empty result. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vigilframe.llm.common import bytes_of, distinct, ranges, small_batches, text_bytes
from vigilframe.llm.minhash import mixed

LENGTH = 50
GRAM = 26
SHARD = 4 << 20
"""Bytes of text per shard of documents."""
MERGER = 8 << 20
"""Bytes of text whose anchors one merger is responsible for."""
STEP = 1 << 15
"""Windows whose anchors are found in one go, small enough for a cache."""
SORTED = 2 << 20
"""Bytes that a merger sorts in one go."""

_OF_BYTE = np.random.Generator(np.random.PCG64(50)).integers(0, 1 << 63, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_BASE, n, 1 << 64))


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of the 26 bytes from every place on, by doubling."""
    h = {1: _OF_BYTE[data]}
    for n in (1, 2, 4, 8):
        h[2 * n] = h[n][:-n] * _power(n) + h[n][n:]
    h24 = h[16][:-8] * _power(8) + h[8][16:]
    return mixed(h24[:-2] * _power(2) + h[2][24:len(h24) - 2 + 24])


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs of windows of 50 bytes of ``data`` with one anchor: first window, where the anchor starts, its hash.

    Of equal hashes the leftmost is the anchor. A hash's upper bits and its place make one
    number, so that a minimum over numbers finds the place as well.
    """
    windows = len(data) - LENGTH + 1
    low = np.uint64((1 << 24) - 1)
    firsts, places, names = [], [], []
    for at in range(0, windows, STEP):
        to = min(at + STEP, windows)
        hashes = _gram_hashes(data[at:to + LENGTH - 1])
        least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
        for n in (1, 2, 4, 8):
            least = np.minimum(least[:-n], least[n:])
        least = np.minimum(least[:-9], least[9:])
        first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        found = (least[first] & low).astype(np.int64)
        firsts.append(first + at)
        places.append(found + at)
        names.append(hashes[found])
    if not firsts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first, place, name = map(np.concatenate, (firsts, places, names))
    new = np.concatenate([[True], place[1:] != place[:-1]])  # a run may cross steps
    return first[new], place[new], name[new]


def equal_windows(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A number for each window that starts at ``starts``: its rank in the order of windows, equal for equal ones."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | padded[i:i + n]
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.concatenate([[True], key[1:] != key[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    del key
    for ahead in (8, 16, LENGTH - 32):
        sizes = np.bincount(rank, minlength=n)
        open_ = np.flatnonzero(sizes[rank] > 1)  # groups of one are in their final place
        if not len(open_):
            break
        pair = rank[open_] * (n + 1) + rank[np.minimum(open_ + ahead, n - 1)]
        by = np.argsort(pair, kind="stable")
        pair, own = pair[by], rank[open_[by]]
        new_group = np.concatenate([[True], own[1:] != own[:-1]])
        group_at = np.maximum.accumulate(np.where(new_group, np.arange(len(own)), 0))
        new_pair = np.concatenate([[True], pair[1:] != pair[:-1]])
        pair_at = np.maximum.accumulate(np.where(new_pair, np.arange(len(own)), 0))
        refined = rank.copy()
        refined[open_[by]] = own + (pair_at - group_at)
        rank = refined
    return rank[starts]


def _regions(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of consecutive windows."""
    breaks = np.flatnonzero(np.diff(windows) != 1) + 1
    return windows[np.concatenate([[0], breaks])], windows[np.concatenate([breaks - 1, [len(windows) - 1]])]


def smallest(data: np.ndarray, windows: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For each window (its start; in rising order), the smallest of ``docs`` among equal ones."""
    low, high = _regions(windows)
    sizes = high - low + LENGTH
    text = data[ranges(low, sizes)]
    of_region = np.repeat(np.cumsum(sizes) - sizes - low, high - low + 1)
    rank = equal_windows(text, windows + of_region)
    least = np.full(len(text), np.iinfo(np.int64).max)
    np.minimum.at(least, rank, docs)
    return least[rank]


class Shard:
    """The pieces of a shard's documents, which lie side by side."""

    def __init__(self, table: pa.Table):
        self.table = table
        self.data, self.offsets = bytes_of(table.column("text"))
        known = np.array(table.column("doc_id").is_valid().to_numpy())
        ids = table.column("doc_id").fill_null(0).to_numpy()
        first, _, name = anchors(self.data)
        # Runs end where documents do; windows across two documents don't count.
        starts = distinct(np.concatenate([first, self.offsets[:-1]]))
        starts = starts[starts < len(self.data) - LENGTH + 1] if len(first) else starts[:0]
        run = np.searchsorted(first, starts, "right") - 1
        row = np.searchsorted(self.offsets, starts, "right") - 1
        last = np.minimum(np.concatenate([starts[1:], [len(self.data) - LENGTH + 1]]) - 1, self.offsets[row + 1] - LENGTH)
        good = (last >= starts) & known[row]
        self.first, self.last, self.name, self.doc = starts[good], last[good], name[run[good]], ids[row[good]]

    def pick(self, chosen: np.ndarray) -> None:
        """Go on with some of the pieces only."""
        self.first, self.last, self.name, self.doc = self.first[chosen], self.last[chosen], self.name[chosen], self.doc[chosen]

    def hashes(self) -> np.ndarray:
        """A hash of each piece's bytes and the place of its anchor, as its anchor's hash goes in, from running sums."""
        n = len(self.data)
        power, back = np.full(n + 1, _BASE, np.uint64), np.full(n + 1, _INVERSE, np.uint64)
        power[0] = back[0] = 1
        np.multiply.accumulate(power, out=power)
        np.multiply.accumulate(back, out=back)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_OF_BYTE[self.data] * power[:n], out=sums[1:])
        size = self.last - self.first + LENGTH
        return mixed((sums[self.last + LENGTH] - sums[self.first]) * back[self.first] + size.astype(np.uint64) * self.name)

    def select(self, names: np.ndarray) -> np.ndarray:
        """Which pieces have an anchor among the sorted ``names``, or one that the shard has with several pieces."""
        order = np.argsort(self.name, kind="stable")
        own = self.name[order]
        twice = own[1:][own[1:] == own[:-1]]
        return _among(self.name, names) | _among(self.name, distinct(twice))


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which ``values`` are in the sorted array ``known``."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _groups(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]])) if len(sorted_values) else np.zeros(0, np.int64)


def _routed(hashes: np.ndarray, mergers: int) -> Iterator[tuple[int, np.ndarray]]:
    """(merger, places) for all mergers that the hashes belong to. Anchors are minima of hashes, so they are spread anew."""
    to = ((mixed(hashes) >> np.uint64(32)) * np.uint64(mergers) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    ends = np.searchsorted(to[order], np.arange(mergers + 1))
    for m in np.flatnonzero(np.diff(ends)):
        yield int(m), order[ends[m]:ends[m + 1]]


def _table(schema: str, rows: list[tuple]) -> pa.Table:
    kinds = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    return pa.table({name: pa.array([x.tobytes() if isinstance(x, np.ndarray) else x for x in column], pa.int64() if kind == "long" else pa.binary())
                     for (name, kind), column in zip(kinds, columns)})


def _arrays(table: pa.Table, column: str, kind=np.int64) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), kind) for x in table.column(column)]


def _joined(table: pa.Table, column: str, kind=np.int64) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *_arrays(table, column, kind)])


_NAMED = "merger long, part long, anchors binary"
_MET = "part long, anchors binary"
_OFFERED = "merger long, part long, anchors binary, pieces binary, docs binary"
_SENT = "merger long, part long, anchors binary, pieces binary, docs binary, sizes binary, text binary"
#: Of pieces: the smallest document that has them (larger ones lose the piece), whether their
#: bytes are asked for; or, for the smallest document, stretches that go, from the piece's start.
_ANSWERED = "part long, pieces binary, docs binary, asked binary, starts binary, ends binary"
_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _name(mergers: int):
    """Step 1."""
    def run(table: pa.Table) -> pa.Table:
        found, part = distinct(Shard(table).name), table.column("part")[0].as_py()
        return _table(_NAMED, [(m, part, found[i]) for m, i in _routed(found, mergers)])

    return run


def _meet(table: pa.Table) -> pa.Table:
    """Step 2. Every part's anchors come sorted."""
    own = _arrays(table, "anchors", np.uint64)
    every = np.sort(np.concatenate(own))
    several = distinct(every[1:][every[1:] == every[:-1]])
    rows = [(part, names[_among(names, several)]) for part, names in zip(table.column("part").to_pylist(), own)]
    return _table(_MET, [x for x in rows if len(x[1])])


def _distinct(shard: Shard) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the shard's pieces, and of the distinct ones the places of one piece each and the smallest document."""
    hashes = shard.hashes()
    order = np.lexsort((shard.doc, hashes))
    at = order[_groups(hashes[order])]
    return hashes, at, shard.doc[at]


def _offer(mergers: int):
    """Step 3."""
    def run(key: tuple, docs: pa.Table, met: pa.Table) -> pa.Table:
        rows = []
        if docs.num_rows:
            shard = Shard(docs)
            shard.pick(shard.select(np.sort(_joined(met, "anchors", np.uint64))))
            hashes, at, least = _distinct(shard)
            for m, i in _routed(shard.name[at], mergers):
                rows.append((m, key[0].as_py(), shard.name[at[i]], hashes[at[i]], least[i]))
        return _table(_OFFERED, rows)

    return run


def _answer(table: pa.Table) -> pa.Table:
    """Step 4."""
    held = {c: _arrays(table, c, k) for c, k in (("anchors", np.uint64), ("pieces", np.uint64), ("docs", np.int64))}
    part = np.repeat(np.arange(table.num_rows), [len(x) for x in held["docs"]])
    name, piece, doc = (np.concatenate(held[c]) for c in ("anchors", "pieces", "docs"))
    order = np.lexsort((doc, piece, name))
    begins = _groups(piece[order])  # a piece's hash holds its anchor's
    least = np.empty(len(doc), np.int64)
    least[order] = np.repeat(doc[order][begins], np.diff(np.append(begins, len(order))))
    names = name[order][begins]
    mixed_ = distinct(names[1:][names[1:] == names[:-1]])
    asked = _among(name, mixed_) & (doc == least)
    tell = np.flatnonzero(asked | (doc > least))
    rows, none = [], np.zeros(0, np.int64)
    for i in np.split(tell, _groups(part[tell])[1:]) if len(tell) else ():
        rows.append((table.column("part")[int(part[i[0]])].as_py(), piece[i], least[i], asked[i].astype(np.uint8), none, none))
    return _table(_ANSWERED, rows)


def _send(mergers: int):
    """Step 5."""
    def run(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        rows = []
        asked = np.sort(_joined(answers, "pieces", np.uint64)[_joined(answers, "asked", np.uint8) > 0])
        if docs.num_rows and len(asked):
            shard = Shard(docs)
            hashes, at, least = _distinct(shard)
            chosen = _among(hashes[at], asked)
            at, least = at[chosen], least[chosen]
            size = shard.last[at] - shard.first[at] + LENGTH
            for m, i in _routed(shard.name[at], mergers):
                text = shard.data[ranges(shard.first[at[i]], size[i])]
                rows.append((m, key[0].as_py(), shard.name[at[i]], hashes[at[i]], least[i], size[i].astype(np.int32), text))
        return _table(_SENT, rows)

    return run


def _sort(table: pa.Table) -> pa.Table:
    """Step 6."""
    part = np.repeat(table.column("part").to_numpy(), [len(x) for x in _arrays(table, "docs")])
    name, piece = (_joined(table, c, np.uint64) for c in ("anchors", "pieces"))
    doc, size = _joined(table, "docs"), _joined(table, "sizes", np.int32).astype(np.int64)
    data, _ = bytes_of(table.column("text"))
    at = np.cumsum(size) - size
    # Equal windows have one anchor, so pieces are sorted in lots of whole anchors.
    by = np.argsort(name, kind="stable")
    begins = _groups(name[by])
    lots = np.repeat(((np.cumsum(size[by]) - size[by])[begins]) // SORTED, np.diff(np.append(begins, len(by))))
    found: list[tuple] = []
    for lot in np.split(by, _groups(lots)[1:]):
        lot = np.sort(lot)
        many, begin = size[lot] - LENGTH + 1, np.cumsum(size[lot]) - size[lot]
        windows, of = ranges(begin, many), np.repeat(np.arange(len(lot)), many)
        gone = np.flatnonzero(doc[lot][of] > smallest(data[ranges(at[lot], size[lot])], windows, doc[lot][of]))
        if len(gone):
            low, high = _regions(windows[gone])
            i = np.searchsorted(begin, low, "right") - 1
            found.append((part[lot[i]], piece[lot[i]], low - begin[i], high - begin[i] + LENGTH))
    if not found:
        return _table(_ANSWERED, [])
    parts, pieces, starts, ends = map(np.concatenate, zip(*found))
    order, none = np.argsort(parts, kind="stable"), np.zeros(0, np.int64)
    return _table(_ANSWERED, [(int(parts[i[0]]), pieces[i], none, none, starts[i], ends[i]) for i in np.split(order, _groups(parts[order])[1:])])


def _finish(with_kept: bool):
    """Step 7."""
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        data, offsets = bytes_of(docs.column("text"))
        marks = np.zeros(len(data) + 1, np.int32)
        if docs.num_rows:
            shard = Shard(docs)
            hashes = shard.hashes()
            order = np.lexsort((shard.doc, hashes))
            begins = _groups(hashes[order])
            least = np.empty(len(hashes), np.int64)
            least[order] = np.repeat(shard.doc[order][begins], np.diff(np.append(begins, len(order))))
            whole, some = (answers.filter(pa.array([(len(x.as_buffer()) > 0) == w for x in answers.column("docs")], pa.bool_())) for w in (True, False))
            if whole.num_rows:
                told, told_doc = _joined(whole, "pieces", np.uint64), _joined(whole, "docs")
                by = np.argsort(told, kind="stable")
                place = np.minimum(np.searchsorted(told[by], hashes), len(told) - 1)
                least = np.where(told[by][place] == hashes, np.minimum(least, told_doc[by][place]), least)
            gone = shard.doc > least
            np.add.at(marks, shard.first[gone], 1)
            np.add.at(marks, shard.last[gone] + LENGTH, -1)
            if some.num_rows:
                told, starts, ends = _joined(some, "pieces", np.uint64), _joined(some, "starts"), _joined(some, "ends")
                low, high = np.searchsorted(hashes[order], told, "left"), np.searchsorted(hashes[order], told, "right")
                first = shard.first[order[ranges(low, high - low)]]
                np.add.at(marks, first + np.repeat(starts, high - low), 1)
                np.add.at(marks, first + np.repeat(ends, high - low), -1)
        removed = np.cumsum(marks[:-1]) > 0
        columns: list[list] = [[], [], [], [], []]
        for i in range(docs.num_rows):
            part, out = data[offsets[i]:offsets[i + 1]], removed[offsets[i]:offsets[i + 1]]
            n = int(np.count_nonzero(out))
            left = (part[~out] if n else part).tobytes()
            spans = int(out[0]) + int(np.count_nonzero(out[1:] & ~out[:-1])) if n else 0
            for column, value in zip(columns, (len(part), n, spans, hashlib.sha256(left).hexdigest(), left if with_kept else None)):
                column.append(value)
        return pa.table({
            "doc_id": docs.column("doc_id"), "n_bytes": pa.array(columns[0], pa.int64()), "n_removed": pa.array(columns[1], pa.int64()),
            "n_spans": pa.array(columns[2], pa.int64()), "kept_sha256": pa.array(columns[3], pa.string()), "kept": pa.array(columns[4], pa.binary())})

    return run


def remove_repeats(docs: DataFrame, with_kept: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row, and the remaining bytes if asked for."""
    total = text_bytes(docs)
    parts, mergers = max(1, -(-total // SHARD)), max(1, -(-total // MERGER))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    dealt = small_batches(docs).select(
        F.pmod(F.xxhash64(F.col("doc_id").cast("long"), text), F.lit(parts)).cast("long").alias("part"),
        F.col("doc_id").cast("long").alias("doc_id"), text.cast("binary").alias("text"))
    by_part = dealt.groupBy("part")
    met = by_part.applyInArrow(_name(mergers), _NAMED).groupBy("merger").applyInArrow(_meet, _MET)
    offered = by_part.cogroup(met.groupBy("part")).applyInArrow(_offer(mergers), _OFFERED)
    answered = offered.groupBy("merger").applyInArrow(_answer, _ANSWERED)
    sent = by_part.cogroup(answered.groupBy("part")).applyInArrow(_send(mergers), _SENT)
    stretches = sent.groupBy("merger").applyInArrow(_sort, _ANSWERED)
    out = by_part.cogroup(answered.union(stretches).groupBy("part")).applyInArrow(_finish(with_kept), _RESULT)
    return out if with_kept else out.drop("kept")
