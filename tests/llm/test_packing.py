import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, strategies as st

from tests.llm.helpers import documents, odd_rows
from vigilframe.llm import packing as P

ODD = [
    "İstanbul don't it's  x²  Ⅷ a\x1cb <|endoftext|> A<|startoftext|>b é ﬁ Σας ΟΔΟΣ. 1,234.5 a_b __ ''s 's'   !!?? ñ.. 日本語。テスト",
    "", " \n\t ", "Ünïcödé,,, \r\nx\x0by, (a). b.' c'. d_. e¼. f×. g", "of%%% athe*** end.*** no!!! WHAT. <|ENDOFTEXT|>",
]


def ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [P.END]


def test_words_have_the_ids_of_the_whole_text():
    encoder = P.Encoder(P.tokenizer_path())
    assert [np.frombuffer(x, "<u4").tolist() + [P.END] for x in encoder.encode(ODD)] == [ids(encoder.tokenizer, x) for x in ODD]


@given(st.lists(st.text(st.sampled_from("aB. ,'_!é²×\n<|ñΣ"), max_size=30), max_size=5))
def test_any_text_has_the_ids_of_the_whole(texts):
    encoder = _SHARED
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == [ids(encoder.tokenizer, x)[:-1] for x in texts]


_SHARED = P.Encoder(P.tokenizer_path())


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(P, "REMEMBERED", 4)
    encoder = P.Encoder(P.tokenizer_path())
    for _ in range(3):
        assert [np.frombuffer(x, "<u4").tolist() + [P.END] for x in encoder.encode(ODD)] == [ids(encoder.tokenizer, x) for x in ODD]


@given(st.lists(st.integers(1, 64), max_size=60))
def test_best_fit_takes_the_tightest_window(lengths):
    lengths = sorted(lengths, reverse=True)
    rooms: list[int] = []
    windows, offsets = P.best_fit(lengths, 64)
    for length, window, offset in zip(lengths, windows, offsets):
        fitting = [r for r in rooms if r >= length]
        if window == len(rooms):
            assert not fitting
            rooms.append(64)
        else:
            assert rooms[window] == min(fitting)
        assert offset == 64 - rooms[window]
        rooms[window] -= length


def check(docs, found, window=P.WINDOW):
    """Every id of every row in exactly one piece; sequences without gaps."""
    tokenizer = _SHARED.tokenizer
    want = []
    for r in docs.collect():
        held = ids(tokenizer, r.text)
        for start in range(0, len(held), window):
            piece = held[start:start + window]
            want.append((r.doc_id, start, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes()), len(held)))
    assert sorted(((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in found), key=repr) == sorted(want, key=repr)
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= window
    return len(sequences)


def test_odd_rows(spark):
    docs = documents(spark, odd_rows() + [(20 + i, x, "en", "a") for i, x in enumerate(ODD)])
    check(docs, P.pack(docs).collect())
    assert P.pack(docs.limit(0)).count() == 0


def test_many_buckets_pad_little(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = P.pack(docs, bucket=300).collect()
    sequences = check(docs, found)
    assert sum(r.length for r in found) / (sequences * P.WINDOW) > 0.98
