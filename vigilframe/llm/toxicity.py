"""Toxicity: boosted trees over dense text features, calibrated by isotonic regression.

The features of a text are densities: words of a lexicon, such words near a second person,
capitals, punctuation and obfuscated words. The lexicon is learned too: whole words and
word beginnings that are far more frequent in toxic documents of the sample.

``SAMPLE`` bounds the labelled rows that a fit looks at (those with the smallest hashes of
their id); everything is scored on its whole text. Folds keep a row's own label out of the
lexicon that it is trained with.

Edge cases: null and empty texts have the features of no words and are scored; labels that
are null are not learned from, of repeated ones the largest counts; without a label every
score is the same; an empty table gives an empty result. Columns other than doc_id and
text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from vigilframe.llm.boosting import cross_fit
from vigilframe.llm.common import bytes_of, slices, small_batches
from vigilframe.session import settle

SAMPLE = 20_000
FOLDS = 3
LEXICON = 3000
"""Most entries of the lexicon, the most telling ones."""
NEAR = 5
SLICE = 2 << 20
REMEMBERED = 150_000

SECOND_PERSON = frozenset(
    "you your yours yourself yourselves u ur tu te toi ton ta tes vous votre vos tú ti usted ustedes su du dich dir "
    "dein deine ihr euch euer sie".split())
_MARKS = ".,;:!?\"'()[]{}<>*#%&|-_/=+"
_LOOKS_LIKE = str.maketrans("013457@$", "oieastas")


def core(token: str) -> str:
    """The word a token stands for: lower case, look-alike signs read as letters, edges stripped."""
    low = token.lower()
    if low.isalpha():
        return low
    low = low.strip(_MARKS)
    if not low.isalpha() and any(c.isalpha() for c in low):
        low = "".join(c for c in low.translate(_LOOKS_LIKE) if c.isalpha())
    return low if low.isalpha() else ""


def entries_of(word: str) -> list[str]:
    """Lexicon entries that a word can match: itself, and its beginnings."""
    return [word + "$", *(word[:n] for n in range(3, min(8, len(word)) + 1))] if word else []


def _words(text: str) -> list[str]:
    return text.split()


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found: dict[tuple[str, int], list[int]] = {}
        for text, toxic, fold in zip(batch["text"], batch["toxic"], batch["fold"]):
            entries = {e for word in {core(t) for t in set(_words(text or ""))} for e in entries_of(word)}
            for entry in entries:
                found.setdefault((entry, fold), [0, 0])[toxic] += 1
        yield pd.DataFrame([(e, f, n[1], n[0]) for (e, f), n in found.items()], columns=["entry", "fold", "toxic", "clean"])


def weigh(toxic: np.ndarray, clean: np.ndarray, n_toxic: float, n_clean: float) -> np.ndarray:
    """Log-odds of entries; 0 for those too rare or not telling."""
    odds = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    return np.where((toxic >= 3) & (odds > 1.5), odds, 0.0)


#: Sums over a text's words that the features are made of.
_SUMS = ("one", "weight", "hit", "strong", "person", "letters", "capitals", "shouted", "signs", "loud", "masked", "digits", "chars")
FEATURES = 17


class Words:
    """What every word adds to the features of its text, remembered per distinct word."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon, self.strong = lexicon, np.log(50.0)
        self._forget()

    def _forget(self, room: int = 0) -> None:
        self.known: dict[str, int] = {}
        self.rows = np.zeros((max(room, REMEMBERED), len(_SUMS)), np.float32)

    def _describe(self, token: str) -> tuple[float, ...]:
        inner = token.strip(_MARKS)
        if inner.isalpha():  # most words, and what is said below of the others holds at once
            word, letters, digits, masked = inner.lower(), len(inner), 0, 0.0
        else:
            word = core(token)
            letters, digits = sum(map(str.isalpha, token)), sum(map(str.isdigit, token))
            masked = float(bool(word))
        capitals = 0 if token.islower() else sum(map(str.isupper, token))
        weight, known = 0.0, self.lexicon
        for entry in entries_of(word):
            if entry in known and known[entry] > weight:
                weight = known[entry]
        return (1.0, weight, float(weight > 0), float(weight > self.strong), float(word in SECOND_PERSON), letters, capitals,
                float(letters > 1 and capitals == letters), len(token) - letters - digits, token.count("!") + token.count("?"),
                masked, digits, len(token))

    def features(self, texts: list[str]) -> np.ndarray:
        split = [_words(x) for x in texts]
        fresh = set().union(*split) - self.known.keys()
        if len(self.known) + len(fresh) > len(self.rows):
            fresh = set().union(*split)
            self._forget(len(fresh))
        for token in fresh:
            self.rows[len(self.known)] = self._describe(token)
            self.known[token] = len(self.known)
        known, of_word, lengths = self.known, self.rows, np.array([len(x) for x in split], np.int64)
        out = np.zeros((len(texts), FEATURES))
        total = int(lengths.sum())
        ids = np.fromiter((known[t] for words in split for t in words), np.int64, total)
        starts, some = np.cumsum(lengths) - lengths, lengths > 0
        if total:
            told = of_word[ids]
            sums, top = np.zeros((len(texts), len(_SUMS))), np.zeros(len(texts))
            sums[some] = np.add.reduceat(told, starts[some], axis=0, dtype=np.float64)
            top[some] = np.maximum.reduceat(told[:, 1], starts[some])
            hits = np.flatnonzero(told[:, 2])
            before = np.concatenate([[0], np.cumsum(told[:, 4])])
            doc = np.searchsorted(starts + lengths, hits, "right")
            low, high = np.maximum(hits - NEAR, starts[doc]), np.minimum(hits + NEAR + 1, starts[doc] + lengths[doc])
            near = np.bincount(doc, (before[high] - before[low]) > 0, len(texts))
            kinds = np.zeros(len(texts))
            if len(hits):
                pairs = np.unique(doc * (len(self.rows) + 1) + ids[hits])
                kinds = np.bincount(pairs // (len(self.rows) + 1), minlength=len(texts)).astype(float)
            one, chars = np.maximum(sums[:, 0], 1), np.maximum(sums[:, 12], 1)
            varied = np.array([len(set(x)) for x in split]) / one
            out = np.column_stack([
                np.log1p(sums[:, 0]), sums[:, 2] / one, sums[:, 1] / one, top, np.log1p(sums[:, 2]), np.log1p(kinds),
                np.log1p(sums[:, 3]), sums[:, 3] / one, near / one, sums[:, 4] / one, sums[:, 6] / np.maximum(sums[:, 5], 1),
                sums[:, 7] / one, sums[:, 8] / chars, sums[:, 9] / one, sums[:, 10] / one, sums[:, 11] / chars, varied])
        return out


def _texts(column) -> Iterator[tuple[int, int, list[str]]]:
    _, offsets = bytes_of(column)
    for at, to in slices(offsets, SLICE):
        yield at, to, [x or "" for x in column.slice(at, to - at).to_pylist()]


def _sample_features(lexicons: list[dict[str, float]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = [Words(x) for x in lexicons]
        for batch in batches:
            fold = batch.column("fold").to_numpy()
            for f in range(len(lexicons)):
                part = batch.filter(pa.array(fold == f))
                for at, to, texts in _texts(part.column("text")):
                    made = words[f].features(texts)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(c).slice(at, to - at) for c in ("key", "fold", "toxic")]
                        + [pa.FixedSizeListArray.from_arrays(pa.array(made.ravel()), FEATURES).cast(pa.list_(pa.float64()))],
                        ["key", "fold", "toxic", "features"])

    return run


class Scorer:
    """A fitted model: lexicon, trees and calibration."""

    def __init__(self, lexicon, trees, curve):
        self.lexicon, self.trees, self.curve = lexicon, trees, curve

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(self.lexicon)
        for batch in batches:
            for at, to, texts in _texts(batch.column("text")):
                score = np.clip(self.curve(self.trees.raw(words.features(texts))), 0, 1)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, to - at), pa.array(score)], ["doc_id", "score"])


def fit(docs: DataFrame, labels: DataFrame, may_learn: Column, sample: int = SAMPLE, folds: int = FOLDS) -> Scorer:
    """Learn from rows of ``labels`` (doc_id, toxic) for which ``may_learn``, an expression of doc_id, holds."""
    key, docs = F.xxhash64("doc_id"), small_batches(docs)
    chosen = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & may_learn)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
        .where("toxic IN (0, 1)").orderBy(key, "doc_id").limit(sample)
        .select("doc_id", "toxic", key.alias("key"), F.pmod(key, F.lit(folds)).cast("int").alias("fold"))
    )
    chosen = settle(chosen, "toxic-labels")
    texts = settle(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .join(F.broadcast(chosen), "doc_id").select("key", "fold", "toxic", "text"), "toxic-sample")
    per_fold = texts.groupBy("fold").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")).toPandas()
    n = np.zeros((folds, 2))
    for fold, toxic, clean in per_fold.itertuples(index=False):
        n[fold] = toxic, clean
    counted = texts.mapInPandas(_counts, "entry string, fold int, toxic long, clean long")
    wide = counted.groupBy("entry").agg(
        *(F.sum(F.when(F.col("fold") == f, F.col(c)).otherwise(0)).alias(f"{c}_{f}") for f in range(folds) for c in ("toxic", "clean")))
    all_toxic, all_clean = (sum(F.col(f"{c}_{f}") for f in range(folds)) for c in ("toxic", "clean"))
    odds = F.log((all_toxic + 0.5) / (n[:, 0].sum() + 1)) - F.log((all_clean + 0.5) / (n[:, 1].sum() + 1))
    found = wide.where((all_toxic >= 3) & (odds > 1.0)).orderBy(odds.desc(), "entry").limit(LEXICON).toPandas()

    def lexicon(use: list[int]) -> dict[str, float]:
        toxic, clean = (sum(found[f"{c}_{f}"].to_numpy(float) for f in use) for c in ("toxic", "clean"))
        weights = weigh(toxic, clean, n[use, 0].sum(), n[use, 1].sum())
        return {e: float(w) for e, w in zip(found["entry"], weights) if w > 0}

    every = list(range(folds))
    apart = [lexicon([f for f in every if f != out]) for out in every]
    made = texts.mapInArrow(_sample_features(apart), "key long, fold int, toxic int, features array<double>")
    made = made.orderBy("key").toPandas()
    rows = np.array(made["features"].tolist(), float).reshape(len(made), FEATURES)
    return Scorer(lexicon(every), *cross_fit(rows, made["toxic"].to_numpy(float), made["fold"].to_numpy()))


def score(docs: DataFrame, model: Scorer) -> DataFrame:
    """doc_id and score, from 0 to 1, of every row."""
    read = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return read.mapInArrow(model.run, "doc_id long, score double")
