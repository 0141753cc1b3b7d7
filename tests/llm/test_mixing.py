import hashlib
import re

import pytest

from tests.llm.helpers import documents, odd_rows, words
from vigilframe.llm import mixing as M


def targets(sizes: dict, weights=(5, 2, 1), share=1.5, most=2.0):
    """By giving the rest out again until nobody is above the ceiling."""
    weight = {s: weights[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    full, out = set(), {}
    while True:
        rest = share * sum(sizes.values()) - sum(most * sizes[s] for s in full)
        open_ = sum(weight[s] for s in sizes if s not in full)
        out = {s: most * sizes[s] if s in full else rest * weight[s] / open_ for s in sizes}
        above = {s for s in sizes if s not in full and out[s] >= most * sizes[s]}
        if not above or not open_:
            return out
        full |= above


def check(spark, rows):
    sizes: dict = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = targets(sizes)
    got = M.with_copies(documents(spark, rows)).select("doc_id", "text", "source", "_mix_size", "_mix_target", "_mix_copies").collect()
    assert len(got) == len(rows)
    for r in got:
        assert r._mix_size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        assert r._mix_target == pytest.approx(want[r.source])
        rate = want[r.source] / sizes[r.source] if sizes[r.source] else 0
        draw = int(hashlib.md5(f"mix{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()[:13], 16) / (1 << 52)
        assert r._mix_copies == int(rate) + (draw < rate % 1) and r._mix_copies <= 2
    return {s: sum(r._mix_size * r._mix_copies for r in got if r.source == s) for s in sizes}, want


def test_odd_rows(spark):
    check(spark, odd_rows())


def test_taken_words_come_near_targets(spark):
    rows = [(i, words(i, 40 + i % 50), "en", f"s{0 if i % 3 == 0 else i % 7}") for i in range(6000)]
    taken, want = check(spark, rows)
    assert all(taken[s] == pytest.approx(want[s], rel=0.06) for s in want)


def test_mix_repeats_rows(spark):
    docs = documents(spark, [(i, words(i, 20), "en", f"s{i % 4}") for i in range(200)])
    mixed = M.mix(docs)
    copies = {r.doc_id: r._mix_copies for r in M.with_copies(docs).collect()}
    assert mixed.columns == docs.columns
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == {k: v for k, v in copies.items() if v}
    assert M.mix(docs.limit(0)).count() == 0
