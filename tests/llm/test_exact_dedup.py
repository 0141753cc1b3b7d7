import hashlib
import re

import numpy as np
from hypothesis import given, strategies as st

from tests.llm.helpers import documents, odd_rows
from vigilframe.llm import exact_dedup as X


def one(data: bytes):
    return X.fingerprints(np.frombuffer(data, np.uint8), np.array([0, len(data)]))[0]


@given(st.binary(max_size=5000), st.binary(max_size=5000))
def test_fingerprints_compose(a, b):
    assert X.combine(one(a), one(b)) == one(a + b)


def test_fingerprint_is_the_polynomial():
    data = bytes(range(256)) * 9
    assert one(data)[:2] == tuple(sum((c + 1) * pow(b, i, p) for i, c in enumerate(data)) % p for p, b in zip(X.PRIMES, X.BASES))


def expected(rows):
    normal = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t, *_ in rows]
    best = {}
    for k, ((i, t, *_), n) in enumerate(zip(rows, normal)):
        rank = (-len(t or ""), i is None, i or 0, k)
        best[n] = min(best.get(n, (rank, i)), (rank, i), key=lambda x: x[0])
    return sorted(
        ((i, best[n][1], normal.count(n), best[n][0][3] == k, hashlib.sha256(n.encode()).hexdigest())
         for k, ((i, *_), n) in enumerate(zip(rows, normal))), key=repr)


def test_odd_rows(spark, rows):
    docs = documents(spark, odd_rows()).coalesce(1)
    found = X.exact_groups(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    got, want = rows(found), expected(odd_rows())
    # Which one of rows that agree in everything stays isn't fixed, only that one does.
    assert got == want


def test_a_text_longer_than_a_slice(spark, rows):
    text = "abcdefghij" * (X.SLICE // 8)
    docs = documents(spark, [(1, text, "en", "a"), (2, " ".join([text[:700], text[700:]]), "en", "a"), (3, text[:-1] + "x", "en", "a")])
    assert [(r[0], r[1], r[2]) for r in rows(X.exact_groups(docs).select("doc_id", "keep_id", "group_size"))] == [(1, 2, 2), (2, 2, 2), (3, 3, 1)]


def test_equal_texts_survive_the_comparison(spark):
    docs = documents(spark, odd_rows())
    assert X.unequal_prints(docs, docs.select("doc_id")).isEmpty()


def test_drop_copies_keeps_columns_and_one_row_each(spark):
    docs = documents(spark, odd_rows())
    left = X.drop_copies(docs)
    assert left.columns == docs.columns
    assert left.count() == len({re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t, *_ in odd_rows()})
    assert X.exact_groups(docs.limit(0)).count() == 0
