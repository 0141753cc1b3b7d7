"""Packing token sequences, best fit decreasing.

Every document is tokenized once. Whole windows are cut off overlong documents first; what
is left of each is packed per bucket, longest piece first, into the open window with the
least remaining room that still holds it. A segment tree over remaining capacities finds
that window. Pieces are dealt to buckets of bounded size, so nothing is packed in one task
and padding is at most a few windows a bucket.

The tokenizer never merges across white space, so a text's ids are those of its words, and
the ids of a word are remembered (a bounded number of words per Python worker).

Edge cases: a null or empty text is the end token alone; repeated rows are packed each; a
null id stays null; an empty table gives no pieces. Columns other than doc_id and text are
not read.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vigilframe.llm.common import bytes_of, kept, release, slices, small_batches
from vigilframe.session import settle

WINDOW = 4096
END = 2
BUCKET = 1 << 16
"""Pieces per bucket, on average."""
SLICE = 1 << 19
REMEMBERED = 150_000
"""Words that a Python worker remembers, and as many that it may soon forget."""

_RUN = re.compile(r"[^a-zA-Z0-9\sÀ-ÖØ-öø-ÿ][.,] ")
_MARKED = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-`{-~]+)")

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Recent:
    """A bounded memory: what wasn't asked for since it last filled up is forgotten."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def known(self, words: set[str]) -> set[str]:
        """Keep what is remembered of ``words`` for another turn; returns the others.

        The difference with the dictionary itself looks up each word; one with its keys would pass over all that is remembered.
        """
        missing = words.difference(self.young)
        if self.old:
            again = {word: value for word in missing if (value := self.old.get(word)) is not None}
            self.young.update(again)
            missing.difference_update(again)
        return missing

    def add(self, words: list[str], values: list[bytes]) -> None:
        if len(self.young) + len(words) > self.most:
            self.young, self.old = {}, self.young
        self.young.update(zip(words, values))


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        # A task has one core; threads of its own would each hold memory for nothing.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.words = Recent(REMEMBERED)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _fresh(self, words: list[str]) -> list[bytes]:
        """Ids of each word. Words of letters only are encoded side by side, as each ends with an end-of-word token."""
        ids = np.zeros(0, np.uint32)
        if all(map(str.isalpha, words)):
            texts = [" ".join(words[i:i + 64]) for i in range(0, len(words), 64)]
            found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            ids = np.fromiter(chain.from_iterable(x.ids for x in found), np.uint32)
        ends = 4 * (np.flatnonzero(self.ends_word[ids]) + 1)
        if len(ends) == len(words):
            held = ids.astype("<u4").tobytes()
            return [held[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _learn(self, words: set[str]) -> None:
        """A word of letters and closing marks has the ids of its two parts, which are known more often."""
        plain = {x for x in words if x.isalpha()}
        split: dict[str, tuple[str, str]] = {}
        other: set[str] = set()
        for word in words - plain:
            m = _MARKED.fullmatch(word)
            if m and m[1].isalpha():
                split[word] = m.groups()
            else:
                other.add(word)
        parts = {x for both in split.values() for x in both}
        new = self.words.known(parts) | plain.difference(self.words.young) | other
        letters, rest = [], []
        for x in new:
            (letters if x.isalpha() else rest).append(x)
        known = self.words.young
        self.words.add(letters + rest, self._fresh(letters) + self._fresh(rest))
        if self.words.young is not known:  # it has just filled up
            self.words.known(parts)
        known = self.words.young
        self.words.add(list(split), [known[a] + known[b] for a, b in split.values()])

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [separated(x).split(" ") for x in texts]
        words = set().union(*split) - {""}
        while unknown := self.words.known(words):
            self._learn(unknown)
        known = self.words.young
        known[""] = b""
        return [b"".join(map(known.__getitem__, x)) for x in split]


def separated(text: str) -> str:
    """``text`` with the same tokens, in which more words are alike: one kind of white space, and, where that
    can't touch a run of marks, a special token or a letter with unusual cases, lower case and single marks apart."""
    text = text.replace("\n", " ").replace("\t", " ").replace("\r", " ")
    if "<|" in text or _RUN.search(text):
        return text
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text.lower().replace(". ", " . ").replace(", ", " , ")


def _pieces(path: str, window: int, end: int):
    tail = end.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        encoder = kept(f"encoder {path}", lambda: Encoder(path))
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            _, offsets = bytes_of(texts)
            for at, to in slices(offsets, SLICE):
                rows = ([], [], [], [], [])
                for doc, held in zip(ids.slice(at, to - at).to_pylist(), encoder.encode([x or "" for x in texts.slice(at, to - at).to_pylist()])):
                    held += tail
                    n = len(held) // 4
                    for start in range(0, n, window):
                        piece = held[4 * start:4 * (start + window)]
                        for column, value in zip(rows, (doc, start, len(piece) // 4, zlib.crc32(piece), n)):
                            column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in rows], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
            release()

    return cut


class OpenWindows:
    """Windows that still have room, by their remaining capacity."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.filled = [0] * (2 * self.leaves)
        self.at: list[list[int]] = [[] for _ in range(window + 1)]

    def _count(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.filled[node] += by
            node >>= 1

    def put(self, name: int, room: int) -> None:
        self.at[room].append(name)
        self._count(room, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """(window, its room) of the tightest one that holds ``length``, which is then no longer open."""
        node = length + self.leaves
        if not self.filled[node]:
            while node and (node & 1 or not self.filled[node + 1]):
                node >>= 1
            if not node:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.filled[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._count(room, -1)
        return self.at[room].pop(), room


def best_fit(lengths: list[int], window: int = WINDOW) -> tuple[list[int], list[int]]:
    """Window and offset of every piece, for lengths in falling order."""
    windows, offsets, open_, n = [], [], OpenWindows(window), 0
    for length in lengths:
        found = open_.take(length)
        if found is None:
            found, n = (n, window), n + 1
        name, room = found
        windows.append(name)
        offsets.append(window - room)
        if room > length:
            open_.put(name, room - length)
    return windows, offsets


def _pack(window: int):
    def pack(pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.sort_values(["length", "piece"], ascending=[False, True], kind="stable")
        windows, offsets = best_fit(pieces["length"].tolist(), window)
        pieces["sequence_id"] = pieces["bucket"] * (1 << 32) + windows
        pieces["offset"] = offsets
        return pieces[["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]].astype({"doc_id": "Int64"})

    return pack


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, end: int = END, bucket: int = BUCKET) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece."""
    read = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    cut = read.mapInArrow(_pieces(path or tokenizer_path(), window, end), PIECES)
    pieces = settle(cut.withColumn("piece", F.monotonically_increasing_id()), "pieces")
    buckets = max(1, -(-pieces.count() // bucket))
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("piece"), F.lit(buckets)))
    return dealt.groupBy("bucket").applyInPandas(_pack(window), PIECES + ", sequence_id long, offset long")
