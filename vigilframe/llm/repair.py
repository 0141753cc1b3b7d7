"""Repair of the turns of conversations at the least cost, by depth-first branch and bound.

The roles of a repaired conversation begin with s, u and a in the order ``(s?(ua)+)?``. Edits go over the rows in
order: Keep (0), Rerole to user or assistant (2), Delete (3), Insert an empty user or
assistant turn anywhere (2). Blank rows and duplicates must be deleted; a truncated row that
isn't deleted adds 1. Of the cheapest ways the one whose edit letters come first in ASCII
order is taken.

The search keeps partial repairs on an explicit stack. A suffix lower bound, from a relaxed
problem that forgets what may end a conversation and in which way ties break, discards those
that can't beat the incumbent (cost, letters); a dominance table per node (rows done, state)
discards those that reach a node no better than an earlier one. The incumbent is
proved when the stack is empty. Long conversations are searched in blocks of rows, from every
state at a block's start to every state at its end, so time and memory grow with the rows.

Defined cases. Null role or text counts as one space. Rows are ordered by turn (nulls
first), then role, text; a null conversation id is one conversation. Roles other than the
three are judged by their first letter, an empty role by none. Repeated rows are duplicates.
Conversations that lost all rows have zeros and an empty repair. Other columns are ignored.

Scale: rows are shuffled once by conversation, searched by one letter per row, and
repaired as a stream of sorted rows: neither texts nor rows of a conversation are gathered
in memory, whatever its length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from vigilframe.llm.common import small_batches

BLANK = r"^[\x20\x09-\x0D]*\z"
CUT_OFF = r"[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*\z"
BLOCK = 256
"""Rows of a conversation that are searched at once."""

START, SYSTEM, WAITING, ANSWERED = range(4)
"""Nothing yet, a system turn only, a user turn without its answer, pairs that are complete."""

_FOLLOWS = {(START, "s"): SYSTEM, (START, "u"): WAITING, (SYSTEM, "u"): WAITING, (WAITING, "a"): ANSWERED, (ANSWERED, "u"): WAITING}
_MADE = {START: WAITING, SYSTEM: WAITING, WAITING: ANSWERED, ANSWERED: WAITING}
_ENDS = (START, ANSWERED)
_FAR = 1 << 60
MUST_GO = "-"


def damage(turns: DataFrame) -> DataFrame:
    """The rows of ``turns`` with faults that follow from their conversation and turn; ``_lost`` marks dropped ones."""
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    copies = F.array_repeat(F.lit(0), F.when(fault == 3, 2).otherwise(1))
    return turns.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(text("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text("text"), "[.!?]", "")).otherwise(text("text")).alias("text"),
        (fault == 0).alias("_lost"), F.explode(copies).alias("_copy"),
    ).drop("_copy")


def _suffix_bounds(pattern: str, ends: tuple[int, ...]) -> list[tuple[int, int, int, int]]:
    """For every number of rows done and every state, a cost below which the rest can't be finished."""
    late = [e for e in ends if e >= WAITING]
    waiting = min((0 if e == WAITING else 2 for e in late), default=_FAR)
    answered = min((0 if e == ANSWERED else 2 for e in late), default=_FAR)
    system = 0 if SYSTEM in ends else _FAR
    start = min(0 if START in ends else _FAR, 2 + waiting)
    rows = [(start, min(system, answered), waiting, answered)]
    for row in reversed(pattern):
        role, kept = row.lower(), _FAR if row == MUST_GO else int(row.isupper())
        asks, answers = kept + waiting + (0 if role == "u" else 2), kept + answered + (0 if role == "a" else 2)
        start = min(3 + start, asks, kept + min(system, answered) if role == "s" else _FAR)
        answered, waiting, system = min(3 + answered, asks), min(3 + waiting, answers), 3 + system
        answered, waiting = min(answered, 2 + waiting), min(waiting, 2 + answered)
        start = min(start, 2 + waiting)
        rows.append((start, min(system, answered), waiting, answered))
    return rows[::-1]


@lru_cache(maxsize=1 << 15)
def search(pattern: str, start: int = START, ends: tuple[int, ...] = _ENDS) -> tuple[int, str] | None:
    """The least (cost, letters) that leads from ``start`` to one of ``ends``; None if nothing does.

    One letter of ``pattern`` per row: the role's first letter, x for others, upper case if
    truncated, or - if the row must go.
    """
    bounds, n = _suffix_bounds(pattern, ends), len(pattern)
    best: tuple[int, str] | None = None
    reached: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, start, 0, "")]
    while stack:
        done, state, cost, letters = stack.pop()
        least = cost + bounds[done][state]
        if least >= _FAR or best and (least > best[0] or least == best[0] and letters > best[1][:len(letters)]):
            continue
        known = reached.get((done, state))
        if known is not None and known <= (cost, letters):
            continue
        reached[done, state] = cost, letters
        if done == n and state in ends and (best is None or (cost, letters) < best):
            best = cost, letters
        made = _MADE[state]
        steps = [(cost + 2 + bounds[done][made], "I", done, made, cost + 2)]
        if done < n:
            row = pattern[done]
            steps.append((cost + 3 + bounds[done + 1][state], "D", done + 1, state, cost + 3))
            if row != MUST_GO:
                here = cost + row.isupper()
                follows = _FOLLOWS.get((state, row.lower()))
                if follows is not None:
                    steps.append((here + bounds[done + 1][follows], "K", done + 1, follows, here))
                steps.append((here + 2 + bounds[done + 1][made], "R", done + 1, made, here + 2))
        steps.sort(reverse=True)  # the most promising on top
        stack.extend((at, to, spent, letters + letter) for _, letter, at, to, spent in steps)
    return best


def cheapest(blocks: list[str]) -> tuple[int, str]:
    """The least (cost, letters) of a whole conversation, given as the patterns of its blocks."""
    settled: list[str] = []
    paths = {START: (0, "")}
    for number, block in enumerate(blocks):
        goals = [_ENDS] if number == len(blocks) - 1 else [(s,) for s in range(4)]
        found: dict[int, tuple[int, str]] = {}
        for goal in goals:
            ways = [(c + way[0], done + way[1]) for s, (c, done) in paths.items() if s <= goal[-1] or goal[-1] >= WAITING
                    if (way := search(block, s, goal))]
            if ways:
                found[goal[-1]] = min(ways)
        same = commonprefix([done for _, done in found.values()])
        settled.append(same)
        paths = {s: (c, done[len(same):]) for s, (c, done) in found.items()}
    cost, rest = paths[ANSWERED] if blocks else paths[START]
    return cost, "".join(settled) + rest


def _faults(turns: DataFrame) -> DataFrame:
    """Rows with their number in the conversation, their letter for the search and their faults."""
    whole = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    rows = turns.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("null")).alias("_key"), "conv_id", "turn",
        whole("role").alias("role"), whole("text").alias("text"),
        (F.col("_lost") if "_lost" in turns.columns else F.lit(False)).alias("_lost"),
    ).repartition("_key")
    order = Window.partitionBy("_key").orderBy("_lost", F.col("turn").asc_nulls_first(), "role", "text")
    initial = F.left("role", F.lit(1))
    numbered = rows.select(
        "*", F.row_number().over(order).alias("_row"),
        F.concat(F.lag(initial).over(order), initial).alias("_pair"), F.lag("turn").over(order).alias("_before"))
    seen = F.row_number().over(Window.partitionBy("_key", "_lost", "role", "text").orderBy("_row")) > 1
    blank = F.col("text").rlike(BLANK)
    return numbered.withColumns({
        "_fault": F.when(blank, "blank").when(seen, "duplicate").when(F.col("text").rlike(CUT_OFF), "truncated"),
        "_initial": F.when(initial.isin("s", "u", "a"), initial).otherwise("x"),
    }).withColumn("_letter", F.when(F.col("_fault").isin("blank", "duplicate"), MUST_GO).when(
        F.col("_fault") == "truncated", F.upper("_initial")).otherwise(F.col("_initial")))


def _search_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [cheapest(blocks) for blocks in batch.column("_blocks").to_pylist()]
        names = [f.name for f in batch.schema if f.name != "_blocks"]
        yield pa.RecordBatch.from_arrays(
            [batch.column(n) for n in names] + [pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())],
            [*names, "cost", "audit"])


_COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _plans(rows: DataFrame) -> DataFrame:
    """One row per conversation with its counts and its cheapest repair."""
    held = ~F.col("_lost")
    fault = lambda name: F.count_if(held & (F.col("_fault") == name)).alias(name)
    new_turn = held & F.col("turn").isNotNull() & ((F.col("_row") == 1) | F.col("_before").isNull() | (F.col("_before") != F.col("turn")))
    letters = F.sort_array(F.collect_list(F.when(held, F.struct("_row", "_letter"))))
    # The id comes along so that this branch reads the same shuffled columns as the rows it is joined to.
    blocks = rows.groupBy("_key", F.floor((F.col("_row") - 1) / BLOCK).alias("_block")).agg(
        F.first("conv_id").alias("conv_id"), F.min(F.when(held, F.col("turn"))).alias("_low"), F.max(F.when(held, F.col("turn"))).alias("_high"),
        F.count_if(new_turn).alias("_turns"), fault("blank"), fault("duplicate"), fault("truncated"),
        F.count_if(held & (F.col("_row") > 1) & ~F.col("_pair").isin("su", "ua", "au")).alias("illegal"),
        F.array_join(F.transform(letters, lambda x: x["_letter"]), "").alias("_pattern"))
    whole = blocks.groupBy("_key").agg(
        F.first("conv_id").alias("_id"), F.coalesce(F.max("_high") - F.min("_low") + 1 - F.sum("_turns"), F.lit(0)).cast("long").alias("gaps"),
        *[F.sum(n).alias(n) for n in ("blank", "duplicate", "truncated", "illegal")],
        F.sort_array(F.collect_list(F.when(F.col("_pattern") != "", F.struct("_block", "_pattern")))).alias("_all"))
    id_type = rows.schema["conv_id"].dataType.simpleString()
    whole = whole.select("_key", "_id", "gaps", "blank", "duplicate", "truncated", "illegal",
                         F.transform("_all", lambda x: x["_pattern"]).alias("_blocks"))
    return whole.mapInArrow(_search_all, f"_key string, _id {id_type}, {_COUNTS}")


def _with_plans(turns: DataFrame) -> DataFrame:
    """Rows in order, the first one of every conversation with its plan."""
    rows = _faults(small_batches(turns))
    ordered = rows.select("_key", "conv_id", "_row", "_lost", "role", "text")
    plans = _plans(rows).withColumnRenamed("_key", "_of")
    joined = ordered.join(plans, (F.col("_key") == F.col("_of")) & (F.col("_row") == 1), "left")
    return joined.drop("_of", "_id").sortWithinPartitions("_key", "_row")


class _Repair:
    """Applies the letters of one conversation to its rows as they come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _insert(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at:self.at + 1] == "I":
            self.at, self.state = self.at + 1, _MADE[self.state]
            yield ("user" if self.state == WAITING else "assistant"), "", "I"

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self._insert()
        letter, self.at = self.audit[self.at], self.at + 1
        if letter == "R":
            self.state = _MADE[self.state]
            yield ("user" if self.state == WAITING else "assistant"), text, "R"
        elif letter == "K":
            self.state = _FOLLOWS[self.state, role[0]]
            yield role, text, "K"

    def end(self) -> Iterator[tuple[str, str, str]]:
        yield from self._insert()


def _walk(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, dict | None, list[tuple[str, str, str]]]]:
    """(number of the conversation, its first row or None, repaired turns) for every row and every end."""
    repair, number = None, -1
    for batch in batches:
        for row in batch.to_pylist():
            if row["_row"] == 1:
                if repair:
                    yield number, None, list(repair.end())
                repair, number = _Repair(row["audit"]), number + 1
            turns = [] if row["_lost"] else list(repair.row(row["role"], row["text"]))
            yield number, row if row["_row"] == 1 else None, turns
    if repair:
        yield number, None, list(repair.end())


def _turns_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, out, place, held = [], [], 0, 0
    names = ["conv_id", "place", "role", "text", "edit"]
    conv = None

    def flush():
        columns = [pa.array(ids), *(pa.array(list(c)) for c in zip(*out))]
        return pa.RecordBatch.from_arrays(columns, names)

    for _, first, turns in _walk(batches):
        if first:
            conv, place = first["conv_id"], 0
        for turn in turns:
            ids.append(conv)
            out.append((place, *turn))
            place, held = place + 1, held + len(turn[1])
        if held > 1 << 20 or len(out) > 10_000:
            yield flush()
            ids, out, held = [], [], 0
    if out:
        yield flush()


def _digests_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    done: list[tuple] = []
    current, digest, between = None, hashlib.sha256(), b""

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*done)], [*names, "repaired_sha256"])

    for _, first, turns in _walk(batches):
        if first:
            if current:
                done.append((*current, digest.hexdigest()))
            current, digest, between = tuple(first[n] for n in names), hashlib.sha256(), b""
            if len(done) > 5000:
                yield flush()
                done = []
        for role, text, _ in turns:
            digest.update(between + f"{role}:{text}".encode())
            between = b"\n"
    if current:
        done.append((*current, digest.hexdigest()))
    if done:
        yield flush()


def _typed(run, schema: str, id_type: str):
    """``run`` with its columns cast to what Spark expects, also where a batch holds only nulls."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    target = StructType.fromDDL(schema.format(id=id_type))

    def cast(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = to_arrow_schema(target)
        for batch in run(batches):
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(batch.columns, wanted)], schema=wanted)

    return cast, schema.format(id=id_type)


def repair(turns: DataFrame) -> DataFrame:
    """conv_id, place (from 0), role, text and edit (K, R or I) of the turns of every repaired conversation.

    Takes conv_id, turn, role and text; rows whose ``_lost`` is true, if there is such a column, are absent.
    """
    run, schema = _typed(_turns_of, "conv_id {id}, place long, role string, text string, edit string", _id_type(turns))
    return _with_plans(turns).mapInArrow(run, schema)


def report(turns: DataFrame) -> DataFrame:
    """One row per conversation: faults, cost and letters of the cheapest repair, and the hash of what ``repair`` gives.

    A conversation of which all rows are ``_lost`` has zeros and an empty repair.
    """
    run, schema = _typed(_digests_of, f"conv_id {{id}}, {_COUNTS}, repaired_sha256 string", _id_type(turns))
    return _with_plans(turns).mapInArrow(run, schema)


def _id_type(turns: DataFrame) -> str:
    return turns.schema["conv_id"].dataType.simpleString()
