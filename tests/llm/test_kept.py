"""What Python workers remember: cheap to look up, and freed when they go on to other work."""

import subprocess
import sys

import pyarrow as pa

from vigilframe.llm import common, exact_dedup, minhash, packing as P


class Passed(dict):
    """A dictionary that fails when all of it is passed over."""

    def __iter__(self):
        raise AssertionError("passed over")

    keys = __iter__


def test_words_are_looked_up_one_by_one():
    recent = P.Recent(3)
    recent.young, recent.old = {"a": b"1"}, Passed(b=b"2", c=b"3")
    assert recent.known({"a", "b", "d"}) == {"d"}
    assert recent.young == {"a": b"1", "b": b"2"}


def test_other_operators_free_what_was_kept():
    made = []
    for _ in range(2):
        common.kept("test", lambda: made.append(1) or made)
    assert len(made) == 1
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1]), pa.array([1]), pa.array([1]), pa.array(["a b"])], ["doc_id", "row", "n_chars", "text"])
    list(exact_dedup._digests(iter([batch])))
    common.kept("test", lambda: made.append(1) or made)
    assert len(made) == 2
    common.let_go()


def test_the_tokenizer_has_no_threads():
    run = """if True:
        import os
        from vigilframe.llm import packing as P
        encoder = P.Encoder(P.tokenizer_path())
        before = len(os.listdir("/proc/self/task"))
        encoder.encode(["".join(chr(97 + i // k % 26) for k in (1, 26, 676)) for i in range(2000)])
        print(len(os.listdir("/proc/self/task")) - before)"""
    assert subprocess.run([sys.executable, "-c", run], capture_output=True, text=True, check=True).stdout == "0\n"


def test_tasks_give_memory_back(monkeypatch):
    given = []
    monkeypatch.setattr(minhash, "release", lambda: given.append("near"))
    monkeypatch.setattr(P, "release", lambda: given.append("pack"))
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["a b"])], ["doc_id", "text"])
    list(minhash._digests(iter([batch])))
    list(P._pieces(P.tokenizer_path(), 4096, 2)(iter([batch, batch])))
    assert given == ["near", "pack", "pack", "pack"]
    common.let_go()
