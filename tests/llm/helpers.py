from __future__ import annotations

import random

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, size long, kept boolean, score string, node int"


def documents(spark, rows):
    """Rows of (doc_id, text, lang, source), with columns whose names operators use themselves."""
    return spark.createDataFrame([(i, t, lang, source, 0, 1, False, "x", 2) for i, t, lang, source in rows], COLUMNS)


def words(seed: int, n: int, vocabulary: int = 400) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def odd_rows():
    """Nulls, empty and blank texts, repeated rows and ids, a null id, a long text."""
    long = words(1, 30_000, 5000)
    return [
        (1, "one two  three\n", "en", "a"), (2, "one two three", "en", "a"), (2, "one two three", "en", "a"),
        (3, None, "en", "b"), (4, "", None, "b"), (5, " \t\n", "en", None), (6, "1 2 3 !!!", "en", None),
        (None, "one two three", "en", "c"), (7, long, "fr", "c"), (8, long + " more", "fr", "c"), (9, "é " * 50, "fr", "d"),
        (7, "another text under one id", "fr", "d"),
    ]
