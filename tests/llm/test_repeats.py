import hashlib

import numpy as np
import pytest
from hypothesis import given, strategies as st

from tests.llm.helpers import documents, odd_rows, words
from vigilframe.llm import repeats as R


def expected(rows):
    texts = [(i, (t or "").encode()) for i, t, *_ in rows]
    first: dict[bytes, int] = {}
    for i, t in texts:
        if i is not None:
            for k in range(len(t) - 49):
                first[t[k:k + 50]] = min(first.get(t[k:k + 50], i), i)
    out = []
    for i, t in texts:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - 49 if i is not None else 0):
            if first[t[k:k + 50]] < i:
                gone[k:k + 50] = True
        left = bytes(np.frombuffer(t, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=repr)


def corpus():
    passage, line = words(5, 40), "Licensed under the same terms as everything else around here."
    rows = list(odd_rows())
    for k in range(60):
        text = words(100 + k, 30)
        if k % 3 == 0:
            text += " " + passage
        if k % 4 == 0:
            text = line + "\n" + text + "\n" + line
        if k % 5 == 0:
            text += words(7, 60)[k:]
        rows.append((1000 - k if k % 2 else 50 + k, text, "en", "s"))
    rows += [(3000 + k, "ab" * 60 + "x" * k, "en", "s") for k in range(3)] + [(3010, "é" * 70, "fr", "s"), (3011, "é" * 70, "fr", "s")]
    return rows


@pytest.mark.parametrize("shard", [R.SHARD, 6000])
def test_against_all_windows(spark, rows, monkeypatch, shard):
    monkeypatch.setattr(R, "SHARD", shard)
    monkeypatch.setattr(R, "MERGER", 2 * shard)
    found = R.remove_repeats(documents(spark, corpus()))
    assert rows(found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) == expected(corpus())


def test_remaining_bytes_and_empty(spark):
    docs = documents(spark, corpus())
    for r in R.remove_repeats(docs, with_kept=True).collect():
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and len(r.kept) == r.n_bytes - r.n_removed
    assert R.remove_repeats(docs.limit(0)).count() == 0


@given(st.text(st.sampled_from("ab"), min_size=50, max_size=400))
def test_equal_windows_have_equal_ranks_in_order(text):
    data = np.frombuffer(text.encode(), np.uint8)
    starts = np.arange(len(data) - 49)
    rank = R.equal_windows(data, starts)
    own = [text[i:i + 50] for i in starts]
    assert all((rank[i] < rank[j]) == (own[i] < own[j]) for i in starts[::7] for j in starts)


def anchor_of(data, window):
    first, place, name = R.anchors(data)
    run = np.searchsorted(first, window, "right") - 1
    return place[run] - window, name[run]


@given(st.text(st.sampled_from("abc"), min_size=26, max_size=60), st.text(st.sampled_from("abc"), max_size=30), st.integers(0, 70))
def test_equal_windows_have_one_anchor(a, b, shift):
    text = (a * 3)[:50]
    one, two = (np.frombuffer(x.encode(), np.uint8) for x in (text, b + text + a[:shift]))
    assert anchor_of(one, 0) == anchor_of(two, len(b))


def test_steps_meet(monkeypatch):
    data = np.frombuffer(words(3, 500).encode(), np.uint8)
    whole = R.anchors(data)
    monkeypatch.setattr(R, "STEP", 77)
    assert all(len(a) == len(b) and (a == b).all() for a, b in zip(whole, R.anchors(data)))


@given(st.lists(st.integers(0, 9)))
def test_distinct_values_rise(values):
    assert R.distinct(np.array(values, np.uint64)).tolist() == sorted(set(values))


def test_nothing_is_hashed_to_find_distinct_numbers(monkeypatch):
    monkeypatch.setattr(np, "unique", None)
    text = words(3, 300)
    table = R.pa.table({"part": [0, 0], "doc_id": [1, 2], "text": [text.encode()] * 2})
    named = R._name(1)(table)
    offered = R._offer(1)((R.pa.scalar(0),), table, R._meet(named))
    assert R._finish(False)(table, R._answer(offered)).column("n_removed").to_pylist() == [0, len(text.encode())]
