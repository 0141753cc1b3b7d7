import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tests.llm.helpers import documents, odd_rows
from vigilframe.llm import langid as L


@given(st.binary(max_size=40), st.binary(max_size=6))
def test_automaton_accepts_substrings_only(text, probe):
    steps, at = L.suffix_automaton(text), 0
    for c in probe:
        at = steps[at].get(c) if at is not None else None
    assert (at is not None) == (probe in text)
    assert len(steps) <= max(2 * len(text), 1)


def phrases(known: bytes, text: bytes) -> int:
    count = 0
    for block in (text[i:i + L.BLOCK] for i in range(0, len(text), L.BLOCK)):
        at = 0
        while at < len(block):
            to = at + 1
            while to < len(block) and block[at:to + 1] in known:
                to += 1
            count, at = count + 1, to
    return count


@settings(deadline=None)
@given(st.lists(st.text(st.sampled_from("abc d"), max_size=3000), min_size=1, max_size=4))
def test_phrases_are_the_longest_matches(texts):
    known = {"x": b"abacad abba", "y": b"cccd dc cad"}
    data = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, data)])
    found = L.Parser(known).phrases(np.frombuffer(b"".join(data), np.uint8), offsets)
    assert found.tolist() == [[phrases(known[k], d) for k in ("x", "y")] for d in data]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    found = L.identify(docs.where(held_out), L.fit(docs, ~held_out)).join(docs, "doc_id")
    right, all_ = found.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert right >= 0.95 * all_ and all_ > 100


def test_odd_rows(spark):
    docs = documents(spark, odd_rows())
    parser = L.fit(docs, F.lit(True))
    found = {(r.doc_id, r.lang_pred == "und") for r in L.identify(docs, parser).collect()}
    assert {i for i, und in found if und} == {3, 4, 5, 6}
    assert all(0 <= r.score <= 1 for r in L.identify(docs, parser).collect())
    kept = L.keep_identified(docs, parser)
    assert kept.columns == docs.columns and kept.count() == len(odd_rows()) - 4
    assert L.identify(docs.limit(0), parser).count() == 0


def test_nothing_to_learn_from(spark):
    docs = documents(spark, odd_rows())
    parser = L.fit(docs, F.lit(False))
    assert {r.lang_pred for r in L.identify(docs, parser).collect()} == {"und"}
    assert L.keep_identified(docs, parser).count() == len(odd_rows()) - 4


def test_kept_rows_have_the_language_that_was_found(spark):
    english, french = "the house on the hill and the tree ", "la maison sur la colline et un arbre "
    rows = [(k, english * 3 + "ab"[k % 2], "en", "s") for k in range(4)] + [(10 + k, french * 3 + "ab"[k % 2], "fr", "s") for k in range(4)]
    rows += [(20, english, "fr", "s"), (21, french, None, "s"), (22, "12 34", "en", "s")]
    docs = documents(spark, rows)
    kept = L.keep_identified(docs, L.fit(docs, F.col("doc_id") < 20))
    assert kept.schema == docs.schema
    assert {r.doc_id: r.lang for r in kept.collect()} == {k: "en" if "house" in t else "fr" for k, t, *_ in rows if k != 22}
