import math

import numpy as np
import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from tests.llm.helpers import documents, odd_rows
from vigilframe.llm import boosting as B, toxicity as T


def test_core_and_entries():
    assert [T.core(x) for x in ("Idiot!!", "id1ot", "***", "42", "MORON's", "c@fé")] == ["idiot", "idiot", "", "", "morons", "café"]
    assert T.entries_of("scum") == ["scum$", "scu", "scum"]


LEXICON = {"idiot$": 2.0, "idi": 1.6, "scum": 4.5, "mor": 1.7, "moron$": 5.0, "traître$": 3.0}


def plain_features(text):
    """The features by their definitions, word by word and without memory."""
    tokens = text.split()
    n, person, weights = max(len(tokens), 1), [], []
    letters = capitals = shouted = digits = loud = masked = 0
    for token in tokens:
        own = [c for c in token if c.isalpha()]
        upper = [c for c in token if c.isupper()]
        letters, capitals = letters + len(own), capitals + len(upper)
        shouted += len(own) > 1 and len(own) == len(upper)
        digits += sum(c.isdigit() for c in token)
        loud += token.count("!") + token.count("?")
        word = T.core(token)
        masked += bool(word) and not token.strip(T._MARKS).isalpha()
        person.append(word in T.SECOND_PERSON)
        weights.append(max([LEXICON.get(e, 0.0) for e in T.entries_of(word)], default=0.0))
    chars = sum(map(len, tokens))
    hits = [i for i, w in enumerate(weights) if w > 0]
    strong = sum(w > math.log(50) for w in weights)
    near = sum(any(person[max(i - 5, 0):i + 6]) for i in hits)
    return [
        math.log1p(len(tokens)), len(hits) / n, sum(weights) / n, max(weights, default=0.0), math.log1p(len(hits)),
        math.log1p(len({tokens[i] for i in hits})), math.log1p(strong), strong / n, near / n, sum(person) / n,
        capitals / max(letters, 1), shouted / n, (chars - letters - digits) / max(chars, 1), loud / n, masked / n,
        digits / max(chars, 1), len(set(tokens)) / n]


TOKENS = st.one_of(
    st.sampled_from("You idiot IDIOT id1ot scum, scumbag moron! MORONS m0r@n tu vous traître the a town 42 *** !? x-y É ß".split()),
    st.text(st.sampled_from("aBé1@$!?.-_"), min_size=1, max_size=9))


@given(st.lists(st.lists(TOKENS, max_size=30).map(" ".join), max_size=8), st.integers(1, 60))
def test_features_are_those_of_a_plain_version(texts, room):
    remembered, T.REMEMBERED = T.REMEMBERED, room  # small enough to be forgotten between calls
    try:
        words = T.Words(LEXICON)
        for _ in range(2):
            found = words.features(texts)
            assert found.shape == (len(texts), T.FEATURES)
            for row, text in zip(found, texts):
                np.testing.assert_allclose(row, plain_features(text), rtol=1e-5, atol=1e-7)
    finally:
        T.REMEMBERED = remembered


def test_scores_are_those_of_plain_features(spark):
    r = np.random.default_rng(5)
    tokens = "you idiot moron town scum, the a M0RON! fine day SCUM".split()
    texts = ["", "   ", *(" ".join(r.choice(tokens, r.integers(1, 40))) for _ in range(200))]
    rows = np.array([plain_features(t) for t in texts])
    model, curve = B.cross_fit(rows, (rows[:, 1] > 0.2).astype(float), np.arange(len(rows)) % 3)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(900, None)], "doc_id long, text string").repartition(5)
    found = {x.doc_id: x.score for x in T.score(docs, T.Scorer(LEXICON, model, curve)).collect()}
    plain = np.clip(curve(model.raw(rows)), 0, 1)
    assert len(found) == len(texts) + 1 and found[900] == found[0]
    np.testing.assert_allclose([found[i] for i in range(len(texts))], plain, atol=1e-9)


def test_trees_learn_an_interaction():
    r = np.random.default_rng(1)
    rows = r.normal(size=(3000, 4))
    labels = ((rows[:, 0] > 0) ^ (rows[:, 1] > 0.5)).astype(float)
    model, curve = B.cross_fit(rows, labels, np.arange(3000) % 3)
    test = r.normal(size=(2000, 4))
    p = curve(model.raw(test))
    assert ((p > 0.5) == ((test[:, 0] > 0) ^ (test[:, 1] > 0.5))).mean() > 0.95


def test_isotonic_is_the_best_rising_fit():
    raw, labels = np.array([1.0, 2, 3, 4, 5, 6]), np.array([0.0, 1, 0, 1, 1, 1])
    curve = B.fit_isotonic(raw, labels)
    values = curve(np.linspace(0, 7, 50))
    assert (np.diff(values) >= 0).all() and 0 <= values.min() and values.max() <= 1
    assert abs(curve(np.array([2.0]))[0] - 0.5) < 0.1


@pytest.mark.parametrize("toxic", [[], [0, 0, 0], [1, 1, 1], [None, None, 1]])
def test_few_labels(spark, toxic):
    docs = documents(spark, odd_rows())
    labels = spark.createDataFrame([(i + 1, 0, y) for i, y in enumerate(toxic)], "doc_id long, quality int, toxic int")
    found = T.score(docs, T.fit(docs, labels, F.lit(True))).collect()
    assert len(found) == len(odd_rows()) and all(0 <= r.score <= 1 for r in found)


def test_held_out_labels_are_told(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = T.fit(docs.select("doc_id", "text"), labels, ~held_out)
    p = T.score(docs, model).join(labels, "doc_id").where(held_out).toPandas()
    y, s = p["toxic"].to_numpy(), p["score"].to_numpy()
    assert s[y == 1].mean() > 3 * s[y == 0].mean()
    assert ((s >= 0.3) & (y == 0)).sum() <= 0.05 * (y == 0).sum()
    assert T.score(docs.limit(0), model).count() == 0
