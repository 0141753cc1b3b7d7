"""Personal data: spans by fixed patterns, and more by boosted trees over wide candidates.

The base spans are those of four patterns with their checks; they always stay. Generators
with high recall propose further, overlapping spans for each kind. Boosted trees judge a
candidate by its format (digits, groups, separators, check digit) and its context (cue
words, neighbours). They are trained without hand labels, on a bounded sample of documents.
Right are the base spans, as they are, with the marks hidden that the base pattern insists on (the plus
sign, the check digit, the @), and rewritten in their place into other formats (no plus, no country code, dots between
the digits of a card, commas in an address, [at]). Wrong are candidates that no base span covers and whose digits are grouped as in
none of the right ones, or that fail their check, and corrupted copies of base spans (a wrong check digit, parts beyond 255,
dates, numbers with separators). Candidates that could be data in another format are left without a label, so that
common ones aren't learned as wrong. An isotonic curve over
candidates of other folds gives probabilities; spans above a threshold are added, the most
probable first, where they overlap no span yet.

Positions are code points, ends exclusive. Edge cases: a null or empty text has no spans;
without candidates nothing is learned or added; rows with one id are treated each on their
own; an empty table gives an empty result. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vigilframe.llm.boosting import cross_fit
from vigilframe.llm.common import bytes_of, slices, small_batches
from vigilframe.session import settle

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 20_000
"""Documents with candidates that a fit looks at, those with the smallest hashes of their id."""
PER_DOCUMENT = 50
"""Candidates of one sampled document that a fit looks at, spread over its whole text."""
REWRITTEN = 8
"""Base spans of one sampled document that are rewritten and corrupted, likewise."""
THRESHOLD = 0.98
FOLDS = 3
SLICE = 2 << 20

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def emails(text: str) -> list[Span]:
    """Leftmost, non-overlapping. A local part is all that may stand before an @, back to the last span."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end()))
            free = domain.end()
        at = text.find("@", max(at + 1, free))
    return found


def base_spans(text: str) -> dict[str, list[Span]]:
    """Spans by kind. A match that fails its check is dropped, and its text isn't tried again."""
    found: dict[str, list[Span]] = {k: [] for k in KINDS}
    if "@" in text:
        found["email"] = emails(text)
    if _DIGIT.search(text):
        found["ip"] = [m.span() for m in _IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split("."))]
        for m in _CARD.finditer(text):
            if 16 <= m.end() - m.start() and 16 <= len(digits := _digits(m[0])) <= 19 and luhn(digits):
                found["card"].append(m.span())
        if "+" in text:
            found["phone"] = [m.span() for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return found


#: Fixed generators. They run from one kind of sign to the next and so take linear time.
_WIDE = {
    "email": re.compile(r"(?<![^\s<>()\[\],;:\"'])[^\s<>()\[\],;:\"'@]+(?:@| ?[\[(] ?at ?[\])] ?)[^\s<>()\[\],;:\"'@]{3,}", re.I),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?:[.,] ?[0-9]{1,3}){3}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}(?:[ .-]?[0-9]{4}){2}[ .-]?[0-9]{1,7}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9])(?:\+|00)?\(?[0-9]{1,4}[ ()./-]{0,3}[0-9]{2,4}(?:[) ./-]{1,2}[0-9]{2,4}){1,4}(?![0-9])"),
}
_CUES = {
    "email": re.compile(r"mail|contact|write|schreib|correo|courriel|@", re.I),
    "ip": re.compile(r"\bip\b|host|server|addr|login|from", re.I),
    "card": re.compile(r"card|visa|master|amex|karte|tarjeta|carte|credit", re.I),
    "phone": re.compile(r"phone|tel|call|fax|mobile|handy|anruf|llam|appel|\bt[ée]l", re.I),
}
_AT = re.compile(r"@| ?[\[(] ?at ?[\])] ?", re.I)
WIDTH = 22


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of everything that may be personal data; spans may overlap."""
    found = []
    digit = _DIGIT.search(text) is not None
    for k, kind in enumerate(KINDS):
        if digit if kind != "email" else "@" in text or " at" in text or "(at" in text or "[at" in text:
            found += [(k, *m.span()) for m in _WIDE[kind].finditer(text)]
    return found


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    span = text[start:end]
    digits = _digits(span)
    groups = [len(x) for x in re.findall(r"[0-9]+", span)]
    before, after = text[max(0, start - 30):start], text[end:end + 15]
    domain = _AT.split(span)[-1] if KINDS[kind] == "email" else ""
    return [
        kind, len(span), len(digits), len(groups), max(groups, default=0), min(groups, default=0),
        float(len(set(groups)) == 1), span.count("."), span.count("-"), span.count(" "), float("(" in span),
        float(span.startswith("+")), float(bool(digits) and luhn(digits)),
        float(KINDS[kind] == "ip" and all(int(x) <= 255 for x in re.findall(r"[0-9]+", span)[:4])),
        float("@" in span), float("." in domain and len(domain.rpartition(".")[2])), float(domain.count(".")),
        float(bool(_CUES[KINDS[kind]].search(before))), float(before[-1:].isalnum()), float(after[:1].isalnum()),
        float(len(_digits(before))), float(len(_digits(after))),
    ]


_HIDDEN = (11, 12, 14)
"""Features that the base patterns insist on: the plus sign, the check digit and the @."""


class _Taken:
    """Spans that are taken, as sorted ranges that don't touch each other."""

    def __init__(self, spans: Iterable[Span]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end in sorted(spans):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def overlaps(self, start: int, end: int) -> bool:
        i = bisect_right(self.ends, start)
        return i < len(self.starts) and self.starts[i] < end

    def add(self, start: int, end: int) -> None:
        i = bisect_right(self.ends, start)
        self.starts.insert(i, start)
        self.ends.insert(i, end)


def shape(kind: int, span: str) -> str:
    """How the digits of a candidate are grouped, or whether an address has a domain with a dot."""
    if KINDS[kind] == "email":
        return f"email {'@' if '@' in span else 'at'} {'.' in _AT.split(span)[-1]}"
    return f"{KINDS[kind]} {' '.join(str(len(g)) for g in re.findall('[0-9]+', span))}"


def fails(kind: int, span: str) -> bool:
    """Whether a candidate can't be what its kind says, in any format."""
    if KINDS[kind] == "ip":
        return any(int(x) > 255 for x in re.findall("[0-9]+", span))
    if KINDS[kind] == "phone":
        return not 8 <= len(_digits(span)) <= 15
    return KINDS[kind] == "card" and not luhn(_digits(span))


def rewritten(kind: int, span: str) -> list[str]:
    """The same datum in formats that the base pattern doesn't know."""
    if KINDS[kind] == "email":
        local, _, domain = span.rpartition("@")
        plain = (re.sub("[0-9]+", "", local).strip("._") or "name", ".".join(re.sub("[0-9]+", "", domain).split(".")[-2:]))
        pairs = [(local, domain), plain, (plain[0].split(".")[0] or "name", plain[1])]
        return [f"{a}{at}{b}" for (a, b), at in zip(pairs * 2, (" [at] ", "(at)", " (at) ", "[at]", " [at] ", "@"))]
    if KINDS[kind] == "ip":
        return [span.replace(".", ","), span.replace(".", ", ")]
    digits = _digits(span)
    if KINDS[kind] == "card":
        fours = re.findall("[0-9]{1,4}", digits)
        return [sign.join(fours) for sign in (".", "-", " ")]
    bare = span.lstrip("+")
    short = re.sub(r"^[0-9]{1,3}[ .-]+", "", bare)
    return [bare, f"00{bare}", re.sub(r"[ ().-]+", " ", bare).strip(), short, re.sub(r"[().]", "", short).replace(" ", "-")]


def corrupted(kind: int, span: str) -> list[str]:
    """Digits and words of about this look that are no personal data."""
    digits = _digits(span)
    if KINDS[kind] == "email":
        local, _, domain = span.rpartition("@")
        first = domain.split(".")[0]
        return ["meet [at] noon", f"{local} [at] {first}", f"{local.split('.')[0] or 'look'} (at) {re.sub('[0-9]+', '', first)}"]
    if KINDS[kind] == "ip":
        return [".".join(str(int(x) % 256 + 256) for x in span.split(".")), ", ".join(str(int(x) % 9 + 1) for x in span.split("."))]
    if KINDS[kind] == "card":
        wrong = digits[:-1] + str((int(digits[-1]) + 1) % 10)
        return [" ".join(re.findall("[0-9]{1,4}", wrong)), wrong]
    day = int(digits[-4:]) % 28 + 1
    return [f"{1990 + int(digits[:2]) % 40}-{day % 12 + 1:02d}-{day:02d}", f"{day:02d}.{day % 12 + 1:02d}.20{day:02d}", f"{digits[:2]} {digits[2:5]} {digits[5:8]}"]


_LEARNED = {"key": pa.int64(), "features": pa.binary(), "shape": pa.string(), "label": pa.int32()}


def examples(text: str) -> Iterator[tuple[list[float], str, int]]:
    """(features, shape, label) of a sampled document's candidates; 1 right, 0 wrong, -1 wrong unless its shape is one of the right ones."""
    found, base = candidates(text), base_spans(text)
    covered = {k: _Taken(base[k]) for k in KINDS}
    for i in sorted({j * len(found) // PER_DOCUMENT for j in range(PER_DOCUMENT)} if len(found) > PER_DOCUMENT else range(len(found))):
        kind, start, end = found[i]
        span = text[start:end]
        right = covered[KINDS[kind]].overlaps(start, end)
        if right or not any(t.overlaps(start, end) for t in covered.values()):
            yield features(text, kind, start, end), shape(kind, span), 1 if right else 0 if fails(kind, span) else -1
    spans = [(k, *s) for k, name in enumerate(KINDS) for s in base[name]]
    for i in sorted({j * len(spans) // REWRITTEN for j in range(REWRITTEN)} if len(spans) > REWRITTEN else range(len(spans))):
        kind, start, end = spans[i]
        before, after = text[max(0, start - 60):start], text[end:end + 60]
        for label, make in ((1, rewritten), (0, corrupted)):
            for other in make(kind, text[start:end]):
                around = before + other + after
                for k, a, b in candidates(around):
                    if a < len(before) + len(other) and len(before) < b and (k == kind or not label):
                        yield features(around, k, a, b), shape(k, around[a:b]) if label else "", label


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(key, np.array(f, np.float32).tobytes(), s, label)
                for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()) for f, s, label in examples(text)]
        columns = list(zip(*rows)) or [[]] * len(_LEARNED)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _LEARNED.values())], list(_LEARNED))


def fit(docs: DataFrame, sample: int = SAMPLE):
    """Trees and curve from the candidates of a bounded sample; None if there are none."""
    key, docs = F.xxhash64("doc_id", "text"), small_batches(docs)
    some = docs.where(F.col("text").rlike("[0-9@]|[\\[(] ?at ?[\\])]")).select(key.alias("key"))
    chosen = settle(some.distinct().orderBy("key").limit(sample), "pii-sample")
    texts = docs.select(key.alias("key"), "text").join(F.broadcast(chosen), "key").dropDuplicates(["key"])
    made = settle(texts.mapInArrow(_learn, "key long, features binary, shape string, label int"), "pii-candidates")
    known = made.where("label = 1").select("shape").distinct().withColumn("known", F.lit(True))
    # Shapes are no more than the rows of the bounded sample.
    made = made.join(known, "shape", "left").where("label >= 0 OR known IS NULL")
    made = made.select("key", "features", (F.col("label") == 1).cast("int").alias("right")).orderBy("key", "features", "right").toArrow()
    if not made.num_rows:
        return None
    rows = np.frombuffer(b"".join(made.column("features").to_pylist()), np.float32).reshape(made.num_rows, WIDTH).astype(float)
    right, keys = made.column("right").to_numpy().astype(float), made.column("key").to_numpy()
    fold = (keys % FOLDS).astype(int)
    hidden = rows[right == 1][::2].copy()
    hidden[:, _HIDDEN] = 0
    rows, fold = np.vstack([rows, hidden]), np.concatenate([fold, fold[right == 1][::2]])
    return cross_fit(rows, np.concatenate([right, np.ones(len(hidden))]), fold, trees=40)


class Finder:
    def __init__(self, model, threshold: float = THRESHOLD):
        self.model, self.threshold = model, threshold

    def added(self, texts: list[str], base: list[dict[str, list[Span]]]) -> None:
        """Append to ``base`` the candidates that the trees are sure of."""
        rows, where, taken = [], [], [_Taken(s for x in b.values() for s in x) for b in base]
        for i, text in enumerate(texts):
            for kind, start, end in candidates(text):
                if not fails(kind, text[start:end]) and not taken[i].overlaps(start, end):
                    rows.append(features(text, kind, start, end))
                    where.append((i, kind, start, end))
        if not rows or self.model is None:
            return
        trees, curve = self.model
        sure = curve(trees.raw(np.array(rows, float)))
        for j in np.lexsort((np.arange(len(sure)), -sure)):
            if sure[j] < self.threshold:
                break
            i, kind, start, end = where[j]
            if not taken[i].overlaps(start, end):
                taken[i].add(start, end)
                base[i][KINDS[kind]].append((start, end))

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = bytes_of(batch.column("text"))
            for at, to in slices(offsets, SLICE):
                texts = [x or "" for x in batch.column("text").slice(at, to - at).to_pylist()]
                found = [base_spans(x) for x in texts]
                counts = [[len(x[k]) for x in found] for k in KINDS]
                shas = [hashlib.sha256(written(x).encode()).hexdigest() for x in found]
                self.added(texts, found)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, to - at), *(pa.array(x, pa.int64()) for x in counts), pa.array(shas),
                     pa.array([written(x) for x in found], pa.string())],
                    ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])


def written(found: dict[str, list[Span]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in sorted(found[k]))


def find(docs: DataFrame, model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, base counts by kind, base_sha256 and spans of every row."""
    read = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return read.mapInArrow(Finder(model, threshold).run, "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")


def redact(text: str, spans: str) -> str:
    """``text`` with every span, as ``find`` writes them, replaced by its kind."""
    out, free = [], 0
    for start, end, kind in sorted((int(a), int(b), k) for k, a, b in (x.split(":") for x in spans.split(",") if x)):
        if start >= free:
            out += [text[free:start], f"[{kind.upper()}]"]
        free = max(free, end)
    return "".join(out) + text[free:]
