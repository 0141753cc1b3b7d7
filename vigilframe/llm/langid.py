"""Language ID by cross-parsing.

For every language a suffix automaton of labelled text is built. An unknown text is cut
greedily into the longest phrases that occur in a language's text; the language that needs
the fewest phrases per byte explains the text best.

Texts are parsed as bytes (A to Z lower-cased) in blocks, every byte of them: a
phrase ends at the border of its block. All blocks of a slice step through all automata
side by side, so a step is a few numpy operations however long the texts are.

The labelled text of a language is bounded by ``SAMPLE`` bytes, taken from the documents
with the smallest hashes, ``EXCERPT`` characters of each; the table of all automata together by ``CELLS``.

Edge cases: a text that is null or has no letter is ``und`` with score 0, as is every text
when there is nothing to learn from; ties go to the smaller language name; rows with one id
are judged each on their own; an empty table gives an empty result. Columns other than
doc_id and text are not read, besides lang while learning.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from vigilframe.llm.common import bytes_of, let_go, ranges, slices, small_batches
from vigilframe.session import settle

SAMPLE = 24_000
EXCERPT = 400
CELLS = 16_000_000
BLOCK = 1024
SLICE = 2 << 20
UNKNOWN = "und"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 32


def folded(data: np.ndarray) -> np.ndarray:
    """Lower case; all ASCII that isn't a letter counts as a space."""
    return _FOLD[data]


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the minimal automaton of all substrings; state 0 is the empty one."""
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        new = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and c not in step[at]:
            step[at][c] = new
            at = link[at]
        if at >= 0:
            to = step[at][c]
            if length[to] == length[at] + 1:
                link[new] = to
            else:
                copy = len(step)
                step.append(dict(step[to]))
                link.append(link[to])
                length.append(length[at] + 1)
                while at >= 0 and step[at].get(c) == to:
                    step[at][c] = copy
                    at = link[at]
                link[to] = link[new] = copy
        last = new
    return step


class Parser:
    """Automata of several languages as one table of steps.

    Row of a state, column of a byte's class: the next row's start, with the lowest bit set
    where a new phrase begins, that is where the state had no such step.
    """

    def __init__(self, texts: dict[str, bytes]):
        self.names = sorted(texts)
        seen = sorted(set().union(*texts.values())) if texts else []
        self.classes = np.zeros(256, np.int32)
        self.classes[seen] = np.arange(1, len(seen) + 1)
        width, tables, self.starts, first = len(seen) + 1, [], [], 0
        for name in self.names:
            steps = suffix_automaton(texts[name])
            # Behind a byte that the language doesn't know, as at the start, whatever comes begins a phrase.
            lost = first + len(steps)
            of_lost = np.full(width, 2 * lost * width + 1, np.int64)
            for c, to in steps[0].items():
                of_lost[self.classes[c]] = 2 * (first + to) * width + 1
            rows = np.tile(of_lost, (len(steps) + 1, 1))
            for state, step in enumerate(steps):
                for c, to in step.items():
                    rows[state, self.classes[c]] = 2 * (first + to) * width
            tables.append(rows.ravel())
            self.starts.append(lost * width)
            first = lost + 1
        self.steps = np.concatenate(tables).astype(np.int32) if tables else np.zeros(0, np.int32)

    def phrases(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Phrases of every value (row) in every language (column)."""
        lengths = np.diff(offsets)
        blocks = -(-lengths // BLOCK)
        out = np.zeros((len(lengths), len(self.names)), np.int64)
        if not len(data):
            return out
        of = np.repeat(np.arange(len(lengths)), blocks)
        nth = ranges(np.zeros(len(blocks), np.int64), blocks)
        starts = offsets[of] + nth * BLOCK
        sizes = np.minimum(lengths[of] - nth * BLOCK, BLOCK)
        order = np.argsort(-sizes, kind="stable")
        starts, of, sizes = starts[order], of[order], sizes[order]
        classes = self.classes[folded(data)]
        alive = np.searchsorted(-sizes, -np.arange(BLOCK), "left")
        state = np.repeat(np.array(self.starts, np.int32)[:, None], len(starts), 1)
        count = np.zeros(state.shape, np.int32)
        for t in range(int(sizes[0])):
            n = alive[t]
            moved = self.steps[state[:, :n] + classes[starts[:n] + t]]
            count[:, :n] += moved & 1
            state[:, :n] = moved >> 1
        for j in range(len(self.names)):
            out[:, j] = np.bincount(of, count[j], len(lengths)).astype(np.int64)
        return out

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = bytes_of(batch.column("text"))
            names, scores = [], []
            lettered = batch.column("lettered").to_pylist()
            for at, to in slices(offsets, SLICE):
                ends = offsets[at:to + 1] - offsets[at]
                rate = self.phrases(data[offsets[at]:offsets[to]], ends) / np.maximum(np.diff(ends), 1)[:, None]
                best = rate.argmin(1) if self.names else np.zeros(to - at, int)
                # A share of votes in which 5 % more phrases halve a language's weight.
                weight = np.exp2(-(rate / np.maximum(rate.min(1, initial=np.inf, keepdims=True), 1e-9) - 1) / 0.05)
                top = 1 / np.maximum(weight.sum(1), 1)
                for i in range(to - at):
                    good = bool(self.names) and lettered[at + i]
                    names.append(self.names[best[i]] if good else UNKNOWN)
                    scores.append(float(top[i]) if good else 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])


def fit(docs: DataFrame, may_learn: Column, sample: int = SAMPLE, cells: int = CELLS) -> Parser:
    """Automata from rows for which ``may_learn`` holds, by their ``lang``; rows without one or without a letter don't count."""
    usable = docs.where(may_learn & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    excerpts = -(-sample // EXCERPT)
    # From the middle of a text: beginnings are often alike. Copies of a text count once.
    piece = F.substring(F.col("text"), F.greatest(F.lit(1), (F.length("text") / 2 - EXCERPT / 2).cast("int")), F.lit(EXCERPT))
    pieces = usable.select("lang", piece.alias("piece")).groupBy("lang", F.xxhash64("piece").alias("hash")).agg(F.min("piece").alias("piece"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("hash"))
    rows = pieces.withColumn("nth", nth).where(F.col("nth") <= excerpts).orderBy("lang", "nth").collect()
    texts: dict[str, bytes] = {}
    for row in rows:
        texts[row["lang"]] = texts.get(row["lang"], b"") + row["piece"].encode() + b" "
    texts = {k: folded(np.frombuffer(v, np.uint8)).tobytes() for k, v in texts.items()}
    width = 1 + len(set().union(*texts.values()))
    most = min(sample, cells // (2 * max(1, len(texts)) * width))
    return Parser({k: v[:most] for k, v in texts.items()})


def identify(docs: DataFrame, parser: Parser) -> DataFrame:
    """doc_id, lang_pred and score, from 0 to 1, of every row."""
    text = F.col("text").cast("string")
    read = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("lettered"))
    return read.mapInArrow(parser.run, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, parser: Parser) -> DataFrame:
    """``docs`` without the rows that are ``und``, with the language found as their ``lang``.

    Where nothing was learned, all with a letter stay, and their ``lang`` as it is.
    """
    columns = docs.columns
    lang = next((i for i, x in enumerate(columns) if x.lower() == "lang"), None)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            lettered, held = batch.column("_lang_lettered"), batch.select(columns)
            if parser.names:
                ids = pa.array(range(batch.num_rows), pa.int64())
                seen = pa.RecordBatch.from_arrays([ids, batch.column("text"), lettered], ["doc_id", "text", "lettered"])
                named = next(parser.run(iter([seen]))).column("lang_pred").to_pylist()
                lettered = pa.array([x != UNKNOWN for x in named], pa.bool_())
                if lang is not None:
                    held = held.set_column(lang, columns[lang], pa.array(named, held.schema.field(lang).type))
            yield held.filter(lettered)

    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return small_batches(docs).withColumn("_lang_lettered", lettered).mapInArrow(keep, docs.schema)
