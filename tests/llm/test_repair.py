import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings, strategies as st

from vigilframe.llm import repair as R

COLUMNS = "conv_id long, turn long, role string, text string, cost string, _row int, gaps int"
GOOD = re.compile(r"(s?(ua)+)?\Z")
WHITE = "\x20\x09\x0A\x0B\x0C\x0D"


def every_way(pattern):
    """The least (cost, letters) by trying all edits that cost no more than deleting every row."""
    best, n = [(3 * len(pattern), "D" * len(pattern))], len(pattern)

    def go(i, roles, cost, letters):
        if (cost, letters) > best[0] and cost > best[0][0]:
            return
        if i == n and GOOD.match(roles):
            best[0] = min(best[0], (cost, letters))
        if i < n:
            go(i + 1, roles, cost + 3, letters + "D")
            if pattern[i] != "-":
                extra = int(pattern[i].isupper())
                go(i + 1, roles + pattern[i].lower(), cost + extra, letters + "K")
                for role in "ua":
                    go(i + 1, roles + role, cost + 2 + extra, letters + "R")
        for role in "ua":
            go(i, roles + role, cost + 2, letters + "I")

    go(0, "", 0, "")
    return best[0]


def state_of(roles):
    """0 to 3 as in the library, None if no repair begins like this."""
    if not roles or roles == "s":
        return len(roles)
    m = re.fullmatch(r"s?(ua)*(u?)", roles)
    return None if not m else 2 if m[2] else 3


NEXT = {(s, r): state_of(["", "s", "u", "ua"][s] + r) for s in range(4) for r in "sua"}


def forward(pattern):
    """The same by the best way to every state after every row, one row after the other."""
    def put(table, state, way):
        if state is not None and (state not in table or way < table[state]):
            table[state] = way

    def inserted(table):
        for _ in range(3):
            for s, (c, a) in list(table.items()):
                for r in "ua":
                    put(table, NEXT[s, r], (c + 2, a + "I"))
        return table

    table = inserted({0: (0, "")})
    for row in pattern:
        new = {}
        for s, (c, a) in table.items():
            put(new, s, (c + 3, a + "D"))
            if row != "-":
                t = int(row.isupper())
                if row.lower() in "sua":
                    put(new, NEXT[s, row.lower()], (c + t, a + "K"))
                for r in "ua":
                    put(new, NEXT[s, r], (c + 2 + t, a + "R"))
        table = inserted(new)
    return min(table[s] for s in (0, 3) if s in table)


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_search_tries_nothing_less_than_all_edits(n):
    letters = "suaxUA-"
    for k in range(len(letters) ** n):
        pattern = "".join(letters[k // len(letters) ** i % len(letters)] for i in range(n))
        assert R.search(pattern) == every_way(pattern) == forward(pattern)


@settings(max_examples=300, deadline=None)
@given(st.text("suaxSUAX-", max_size=60))
def test_search_is_exact(pattern):
    assert R.search(pattern) == forward(pattern)


@settings(max_examples=150, deadline=None)
@given(st.text("suaxSUAX-", max_size=40), st.integers(1, 7))
def test_blocks_give_what_the_whole_gives(pattern, block):
    blocks = [pattern[i:i + block] for i in range(0, len(pattern), block)]
    assert R.cheapest(blocks) == forward(pattern)


@pytest.mark.parametrize("pattern", ["u" * 5000, "s" * 5000, "a" * 5000, "-" * 5000, "x" * 5000, "usa" * 2000, "Sau-xA" * 1000])
def test_long_conversations(pattern):
    blocks = [pattern[i:i + R.BLOCK] for i in range(0, len(pattern), R.BLOCK)]
    assert R.cheapest(blocks)[0] == forward(pattern)[0]
    assert R.cheapest(blocks) == forward(pattern)


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        one = lambda x: " " if x is None else str(x)
        role, text = one(role), one(text)
        code = zlib.crc32(f"{one(conv)}:{one(turn)}".encode()) % 20
        if code == 1:
            text = ""
        if code == 2:
            text = re.sub("[.!?]", "", text)
        if code == 4:
            role = "user"
        kept += [(turn is not None, turn or 0, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    return {c: sorted(r) for c, r in out.items()}


def plain(rows):
    out = []
    for conv, kept in damaged(rows).items():
        seen, pattern, faults = set(), "", []
        for _, _, role, text in kept:
            bare = text.strip(WHITE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
            letter = role[:1] if role[:1] in ("s", "u", "a") else "x"
            pattern += "-" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(kept, kept[1:])]
        turns = [t for known, t, _, _ in kept if known]
        cost, audit = forward(pattern)
        made, state, at = [], 0, 0
        for letter in audit:
            role, text = ("", "") if letter == "I" else kept[at][2:]
            at += letter != "I"
            if letter == "D":
                continue
            if letter != "K":
                role = "assistant" if state == 2 else "user"
            state = NEXT[state, role[0]]
            made.append((role, text))
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
                    faults.count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows):
    df = spark.createDataFrame([(*r, "x", 7, 8) for r in rows], COLUMNS).repartition(5)
    return sorted(map(tuple, R.report(R.damage(df)).collect()), key=repr)


def made_up(seed, n):
    r = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(r.choice([1, 2, 3, 5, 8, 40])):
            rows.append((conv, turn + 2 * (r.random() < 0.1), r.choice(["user", "assistant", "user", "assistant", "system", "tool", ""]),
                         r.choice(["Yes.", "No", "Why?", "é!  \n", "", " \t", "a.b", f"t{r.randrange(9)}."])))
    return rows


def test_report_equals_the_plain_version(spark):
    rows = made_up(1, 300)
    assert found(spark, rows) == plain(rows)


def test_odd_rows(spark):
    rows = [(None, 1, "user", "a."), (None, None, None, "b."), (None, None, "assistant", None), (1, 5, "user", "x." * 50_000), (1, 9, "assistant", "y."),
            (2, None, "user", "q."), (2, None, "user", "q."), (3, 0, "user", " \n "), (4, -3, "assistant", " "), (4, 7, "uber", "A.\x0b")]
    lost = next(c for c in range(10, 10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((lost, 0, "user", "gone."))
    got = found(spark, rows)
    assert got == plain(rows)
    assert (lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in got
    assert found(spark, []) == []


def test_long_conversation_and_repaired_turns(spark, monkeypatch):
    monkeypatch.setattr(R, "BLOCK", 16)
    r = random.Random(2)
    rows = [(1, t, r.choice(["user", "assistant", "system"]), f"t{r.randrange(300)}{r.choice('.?x')}") for t in range(700)] + made_up(3, 20)[:50]
    assert found(spark, rows) == plain(rows)
    df = R.damage(spark.createDataFrame([(*x, "x", 7, 8) for x in rows], COLUMNS))
    turns = {}
    for t in R.repair(df).orderBy("conv_id", "place").collect():
        assert t.place == len(turns.setdefault(t.conv_id, []))
        turns[t.conv_id].append((t.role, t.text))
    for conv, *_, digest in plain(rows):
        kept = turns.get(conv, [])
        assert GOOD.match("".join(role[0] for role, _ in kept))
        assert hashlib.sha256("\n".join(f"{a}:{b}" for a, b in kept).encode()).hexdigest() == digest
