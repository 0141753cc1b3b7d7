import hashlib
import random
import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from vigilframe.llm import chat as C

COLUMNS = "conv_id long, turn long, role string, text string, example string, parts int, n int"
MARKS = ["<|turn|>", "<|text|>", "<|end|>", "<s>", "</s>", "[INST]", "[/INST]"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(rows, marks=MARKS):
    """What must be read back, from the rows themselves."""
    def escape(t):
        return re.sub("|".join(re.escape(m[0]) + r"\\*" + re.escape(m[1:]) for m in marks), lambda m: m[0][0] + "\\" + m[0][1:], t)

    out, convs = [], {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    for conv, turns in convs.items():
        turns.sort()
        replies = [t for _, _, r, t in turns if r == "assistant"]
        sizes = [sum(map(len, marks[:3])) + len(escape(r)) + len(escape(t)) for _, _, r, t in turns]
        ends = [i for i, t in enumerate(turns) if t[2] == "assistant" or i == len(turns) - 1]
        out.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for _, _, r, t in turns)), len("".join(replies)), sha("".join(replies)),
                    sum(sum(sizes[:e + 1]) for e in ends)))
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], COLUMNS)


def found(spark, rows):
    got = C.digest(C.examples(table(spark, rows).repartition(3)))
    return sorted(map(tuple, got.collect()), key=repr)


def test_read_back(spark):
    r = random.Random(1)
    bits = MARKS + ["<\\/s>", "<\\\\|end|>", "[\\INST]", "<", "[", "\\", "|end|>", "/s>", "$1", "é", "\U0001f600", "\n", "plain words"]
    rows = [(c, t, r.choice(["user", "assistant", "system", "<|text|>", "as\nsistant"]), "".join(r.choice(bits) for _ in range(r.randrange(8))))
            for c in range(150) for t in range(r.randrange(1, 9))]
    assert found(spark, rows) == plain(rows)


def test_odd_rows(spark):
    rows = [(None, 1, "user", "a"), (None, None, None, None), (None, 0, "assistant", None), (1, 0, "assistant", "only"), (2, 0, "user", ""), (3, 0, "system", "x"),
            (4, 2, "assistant", "b"), (4, 2, "assistant", "b"), (4, 2, "assistant", "a"), (4, None, "user", "first"), (5, 0, "user", "y" * 200_000), (5, 1, "assistant", "<s>" * 50_000)]
    assert found(spark, rows) == plain(rows)
    assert found(spark, []) == []


def test_examples(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi </s>"), (1, 2, "assistant", "Hello <|end|>!"), (1, 3, "user", "Bye"), (1, 4, "assistant", "Bye."), (1, 5, "user", "?")]
    got = C.examples(table(spark, rows)).orderBy("example").collect()
    assert [(g.example, g.is_last) for g in got] == [(1, False), (2, False), (3, True)]
    assert got[0].text == "<|turn|>system<|text|>Be kind.<|end|><|turn|>user<|text|>Hi <\\/s><|end|><|turn|>assistant<|text|>Hello <\\|end|>!<|end|>"
    assert [g.text[g.loss_start:g.loss_start + g.loss_length] for g in got] == ["Hello <\\|end|>!", "Bye.", ""]
    assert got[1].text.startswith(got[0].text) and got[2].text.startswith(got[1].text)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.text("<>[]/\\|sINSTtexnd", max_size=25), min_size=1, max_size=40))
def test_escapes_are_undone(spark, texts):
    t = C.Template()
    df = spark.createDataFrame([(x,) for x in texts], "x string").select("x", t.escaped(F.col("x")).alias("e"))
    for row in df.select("x", "e", t.plain(F.col("e")).alias("back")).collect():
        assert row.back == row.x and not any(m in row.e for m in MARKS)


def test_other_templates(spark):
    rows = [(1, 0, "user", "{e}#\\#x ##x"), (1, 1, "assistant", "<s>{b}")]
    with pytest.raises(ValueError):
        C.Template(others=("<<x>>",))
    with pytest.raises(ValueError):
        C.Template("{t}", "{b}", "{e}", ("##x",))
    t = C.Template("{t}", "{b}", "{e}", ("#x", "<s>"))
    got = C.examples(table(spark, rows), t).select(C.turns_in(F.col("text"), t).alias("turns")).collect()
    assert [(x.role, x.text) for x in got[0].turns] == [r[2:] for r in rows]


def test_no_python_and_one_shuffle(spark, folder):
    from vigilframe.llm.queries import op12_chat_examples

    plan = op12_chat_examples(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange") == 1
    got = {r.conv_id: r for r in op12_chat_examples(spark, folder).collect()}
    assert got[-7].n_turns == 2 and got[-7].loss_chars == len("</s>[INST] ok [/INST]")
    assert got[-7].loss_sha256 == sha("</s>[INST] ok [/INST]")
