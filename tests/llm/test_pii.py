import hashlib
import re

from hypothesis import given, strategies as st

from tests.llm.helpers import documents, odd_rows
from vigilframe.llm import pii as P

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    """The four patterns as stated, and then their checks."""
    def good(kind, found):
        digits = re.sub("[^0-9]", "", found)
        return {
            "email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in found.split(".")),
            "card": lambda: 16 <= len(digits) <= 19 and sum(
                sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(digits[::-1])) % 10 == 0,
            "phone": lambda: 8 <= len(digits) <= 15}[kind]()

    return {k: [m.span() for m in re.finditer(p, text) if good(k, m[0])] for k, p in PATTERNS.items()}


@given(st.lists(st.sampled_from(
    ["a", "b.c", "@", "x@y.zz", ".", "+", "1", "255", "256", "007", "1.2.3.4", " ", "-", "(", ")", "4111111111111111", "5500 0000 0000 0004", "+1 (017) 555-7713", "é", "%", "_"]),
    max_size=14).map("".join))
def test_base_spans(text):
    assert P.base_spans(text) == plain(text)


def test_long_runs_take_linear_time():
    for text in ("1" * 200_000, "a." * 100_000, "a@" * 100_000, "+1(" * 50_000, "1.1." * 50_000):
        P.candidates(text)
        P.base_spans(text)


def test_odd_rows(spark):
    rows = odd_rows() + [(30, "mail a.b@c.example now or call +1 (017) 555-7713; é 10.0.0.1, 4111 1111 1111 1111.", "en", "s")] * 2
    docs = documents(spark, rows)
    found = P.find(docs, P.fit(docs)).collect()
    assert len(found) == len(rows)
    texts = {i: t or "" for i, t, *_ in rows}
    for r in found:
        if r.doc_id in (30, 3, 4):
            base = plain(texts[r.doc_id])
            assert [r[f"n_{k}"] for k in P.KINDS] == [len(base[k]) for k in P.KINDS]
            assert r.base_sha256 == hashlib.sha256(P.written(base).encode()).hexdigest()
            assert set(filter(None, P.written(base).split(","))) <= set(r.spans.split(","))
    assert P.redact(texts[30], next(r.spans for r in found if r.doc_id == 30)) == "mail [EMAIL] now or call [PHONE]; é [IP], [CARD]."
    assert P.find(docs.limit(0), P.fit(docs.limit(0))).count() == 0


def test_added_spans_are_few_and_overlap_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    added = 0
    for r in P.find(docs, P.fit(docs)).collect():
        base = plain(texts[r.doc_id])
        spans = [(int(a), int(b)) for _, a, b in (x.split(":") for x in r.spans.split(",") if x)]
        own = sorted(x for k in base.values() for x in k)
        more = [x for x in spans if x not in own]
        assert not any(a < d and c < b for a, b in more for c, d in own)
        added += len(more)
    assert added <= 20


def planted(spark, n, first):
    """Documents with data in formats that the base patterns don't know, and with numbers that are no data."""
    import random

    r = random.Random(first)
    rows, want, clean = [], {}, set()
    for i in range(first, first + n):
        digits = [str(r.randrange(10)) for _ in range(15)]
        card = next("".join(digits) + str(c) for c in range(10) if P.luhn("".join(digits) + str(c)))
        name = "".join(r.choice("abcdefghij") for _ in range(6))
        datum = [f"{name}.{name[:3]} [at] {name}.example", ".".join(card[j:j + 4] for j in range(0, 16, 4)),
                 f"{r.randrange(1, 9)} ({r.randrange(100, 999)}) 555-{r.randrange(1000, 9999)}"][i % 3]
        kind = ["email", "card", "phone"][i % 3]
        noise = f"on 20{r.randrange(10, 30)}-0{r.randrange(1, 9)}-1{r.randrange(9)} for 1,{r.randrange(300, 999)},{r.randrange(300, 999)}.00 in lot {r.randrange(10**6)}"
        lead = f"words before {name} {noise} and "
        if i % 6 < 3:
            rows.append((i, lead + {"email": "mail ", "card": "card ", "phone": "call "}[kind] + datum + " please, more words", "en", "s"))
            want[i] = f"{kind}:{len(lead) + 5}:{len(lead) + 5 + len(datum)}"
        else:
            rows.append((i, lead + "nothing else", "en", "s"))
            clean.add(i)
    return rows, want, clean


def test_other_formats_are_found_also_where_they_are_common(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows, want, clean = planted(spark, 360, 10_000_000)
    more = documents(spark, rows).select("doc_id", "text")
    for table in (docs, docs.union(more)):
        model = P.fit(table)
        spans = {r.doc_id: r.spans for r in P.find(more, model).collect()}
        assert sum(w in spans[i].split(",") for i, w in want.items()) >= 0.9 * len(want)
        assert sum(spans[i] != "" for i in clean) <= 0.02 * len(clean)
        gained = sum(len(r.spans.split(",")) > r.n_email + r.n_ip + r.n_card + r.n_phone for r in P.find(docs, model).collect() if r.spans)
        assert gained <= 0.01 * len(spans)


def test_many_spans_in_one_text_take_little_more_than_linear_time():
    import time

    def seconds(n):
        text = " ".join(f"u{i}@h{i}.example" for i in range(n)) + " u [at] h.example"
        start = time.perf_counter()
        P.Finder(None).added([text], [P.base_spans(text)])
        return time.perf_counter() - start

    seconds(100)
    assert seconds(40_000) < 30 * max(seconds(4_000), 0.01)
