"""Main text of web pages by differencing with the page of the nearest URL.

A page becomes lines, one per block of its markup. Within a host the pages are in order of
their URL paths; each is paired with the page whose path shares the longest beginning, out of
the ``NEAR`` on either side and ``FAR`` drawn from the whole host by hash. The lines of the
two are aligned by a longest common subsequence, and shared lines are template: menus,
notices, anything the site repeats. Pages of a host with the same lines are one: they have
one place, that of the smallest path, and one text.

Differencing alone would err on two sides: adverts and footers that change from page to
page aren't shared, and two URLs of one article share all of it. So markup that says what
it is has the last word: lines in menus, headers, footers, sidebars, notices, adverts,
forms and comments go in any case; lines of an article (or main) element outside of those
stay. Lines that no markup places, those of a page without such an element, stay if
their page's pair doesn't share them. A copy is no pair: a page that shares nearly all of
them, also of those that most other pages in question don't share. So a menu may be much
longer than the text, as long as most of these pages have it. Where most are copies that
differ in a line, that line alone counts as text.

Edge cases: null html gives an empty text, a null or odd URL is on a host without name;
repeated pages are treated each; unclosed elements end with what holds them; a table
without rows gives none. Columns other than page_id, url and html are not read.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from vigilframe.llm.common import small_batches
from vigilframe.session import settle

COPY = 0.8
"""A neighbour that shares more than this part of a page's open lines, without those that most others share, is a copy of it."""
ROWS = 64
"""Pages of an output batch."""
NEAR, FAR = 2, 4
"""Pages on either side of a page, and pages of its whole host, that it may be paired with."""

_MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(script|style|noscript|template|svg|iframe|object|textarea|select|math|canvas|video|audio)\b[^>]*+>.*?(?:</\1\s*+>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^>])*+)>|<[!?][^>]*+>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)

# Elements that end a line, those that are never part of the main text, and
# names by which authors mark such parts.
_BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section summary table tbody td tfoot th thead title tr ul".split())
_DROPPED = frozenset("nav footer aside form head button menu dialog search fieldset".split())
_MAIN = frozenset(("article", "main"))
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_LOOSE = frozenset("p li dt dd tr td th option".split())
_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe subscription sidebar rail menu nav navbar navigation "
    "breadcrumb breadcrumbs share sharing social related recommended comment comments commentlist reply replies respond "
    "disqus footer masthead widget toolbar pagination pager login signup search skip skiplink".split())
# Words that also begin names of text; inside an article they count alone, at the end or before one of these.
_ALSO_TEXT = frozenset("social search related notice notices menu sharing share promotion promo banner subscription".split())
_PARTS = frozenset("bar block box button buttons container content icon icons items link links list media nav panel posts section stories widget wrap wrapper".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar toolbar".split())
_OUTER = frozenset(("header", "masthead", "topbar"))

OPEN, MAIN, DROPPED = 0, 1, 2
_MAYBE = 3
"""An article inside a part that is dropped by its name: main text only if the page has no other."""


def _marked(tag: str, attributes: str, inside: bool) -> bool:
    """Whether an element says by its name or attributes that it isn't main text."""
    if tag in _DROPPED or tag == "header" and not inside:
        return True
    if tag in ("html", "body", "main") or "=" not in attributes and "hidden" not in attributes:
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if name == "role" and value in _ROLES:
            return True
        if name in ("class", "id"):
            for word in value.split():
                parts = re.split(r"[-_]+", word)
                if parts[0] in ("has", "no", "with", "without", "is"):
                    continue
                named = {parts[0], parts[-1], word} & _NAMES
                if inside and named == {parts[0]} <= _ALSO_TEXT and len(parts) > 1 and not _PARTS.intersection(parts):
                    named = set()
                if named or not inside and word.endswith("header") and tag != "article":
                    return True
    return False


def lines(page: str) -> list[tuple[str, int]]:
    """(line, zone) of every block with text, in order; zone is OPEN, MAIN or DROPPED."""
    found: list[tuple[str, int]] = []
    stack: list[tuple[str, int]] = []  # open elements with the zone they set
    held: Counter[str] = Counter()  # how many of each tag are open
    parts: list[str] = []
    zone, at = OPEN, 0

    def end_line() -> None:
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                found.append((text, zone))
            parts.clear()

    def close() -> str:
        tag = stack.pop()[0]
        held[tag] -= 1
        return tag

    for m in _MARKUP.finditer(page):
        if m.start() > at:
            parts.append(page[at:m.start()])
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue
        block = tag in _BLOCKS
        if block:
            end_line()
        if m[2]:
            if held[tag]:
                end_line()
                while close() != tag:
                    pass
                zone = stack[-1][1] if stack else OPEN
            continue
        if block and tag not in _LOOSE | _VOID:
            while stack and stack[-1][0] == "p":
                close()
        elif tag in _LOOSE and stack and stack[-1][0] == tag:
            close()
        zone = stack[-1][1] if stack else OPEN
        if tag in _VOID or m[4].endswith("/") and not block:
            continue
        if zone != DROPPED and _marked(tag, m[4], zone in (MAIN, _MAYBE)):
            if not block:
                end_line()
            zone = DROPPED
        elif tag in _MAIN and not (zone == DROPPED and any(held[t] for t in _DROPPED)) and not _marked(tag, m[4], True):
            zone = _MAYBE if zone in (DROPPED, _MAYBE) else MAIN
        elif not block:
            continue
        stack.append((tag, zone))
        held[tag] += 1
    if at < len(page):
        parts.append(page[at:])
    end_line()
    rescued = DROPPED if any(z == MAIN for _, z in found) else MAIN
    return [(text, rescued if z == _MAYBE else z) for text, z in found]


def shared(own: list[str], other: list[str]) -> set[int]:
    """Places in ``own`` of a longest common subsequence with ``other``.

    Equal beginnings and ends are matched directly; in between, every line of ``own`` tries
    its places in ``other`` from the last to the first and extends the longest chain that
    ends before it.
    """
    low, most = 0, min(len(own), len(other))
    while low < most and own[low] == other[low]:
        low += 1
    tail = 0
    while tail < most - low and own[-1 - tail] == other[-1 - tail]:
        tail += 1
    kept = set(range(low)) | set(range(len(own) - tail, len(own)))
    places: dict[str, list[int]] = {}
    for j in range(len(other) - tail - 1, low - 1, -1):
        places.setdefault(other[j], []).append(j)
    ends: list[int] = []
    chains: list[tuple] = []
    for i in range(low, len(own) - tail):
        for j in places.get(own[i], ()):
            k = bisect_left(ends, j)
            chain = (i, chains[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                chains.append(chain)
            elif j < ends[k]:
                ends[k], chains[k] = j, chain
    chain = chains[-1] if chains else None
    while chain:
        kept.add(chain[0])
        chain = chain[1]
    return kept


def template(own: list, open_: set[int], others: list[list]) -> set[int]:
    """The open places of ``own`` that its pair shares: the first of ``others`` that is no copy.

    A copy shares nearly all open lines outside of those that most of the others share, too;
    without others it is one only if it shares every open line.
    """
    found = [shared(own, other) & open_ for other in others if other and other != own]
    votes = Counter(i for x in found for i in x)
    for x in found:
        # Lines of the page that no majority of the others has.
        rest = {i for i in open_ if 2 * (votes[i] - (i in x)) <= len(found) - 1}
        alike = len(found) > 1 and len(x & rest) > COPY * len(rest) or len(found) == 1 and x == open_
        if not alike:
            return x
    return set()


def main_text(page: list[tuple[str, int]], pairs: list[list[tuple[str, int]]]) -> str:
    """The main text of a page, as lines, given its neighbours, the nearest first."""
    if any(zone == MAIN for _, zone in page):
        return "\n".join(text for text, zone in page if zone == MAIN)
    open_ = {i for i, (_, zone) in enumerate(page) if zone == OPEN}
    gone = template([x for x, _ in page], open_, [[x for x, _ in other] for other in pairs])
    return "\n".join(page[i][0] for i in sorted(open_ - gone))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def _common(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The main text by markup; where that doesn't say, all open lines and ``open``, their places.

    ``codes`` has 64 bits of a hash for every line; ``alike`` names lines and zones of the whole page.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            texts, places, codes, alike = [], [], [], []
            for html in part.column("html").to_pylist():
                page = lines(html or "")
                open_ = [i for i, (_, zone) in enumerate(page) if zone == OPEN]
                unsaid = bool(open_) and not any(zone == MAIN for _, zone in page)
                texts.append(main_text(page, []))
                places.append(np.array(open_, np.int32).tobytes() if unsaid else None)
                codes.append(b"".join(blake2b(x.encode("utf-8", "replace"), digest_size=8).digest() for x, _ in page))
                alike.append(blake2b(codes[-1] + bytes(zone for _, zone in page), digest_size=16).digest())
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("page_id", "url", "host", "path")), pa.array(texts, pa.string()),
                 *(pa.array(x, pa.binary()) for x in (places, codes, alike))],
                ["page_id", "url", "host", "path", "text", "open", "codes", "alike"])


def _templates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which of its open lines every page loses, given the pages it may be paired with."""
    for batch in batches:
        gone = []
        for at, path, codes, places, others in zip(*(batch.column(c).to_pylist() for c in ("at", "path", "codes", "open", "others"))):
            others.sort(key=lambda x: (-_common(x["path"], path), abs(x["other"] - at), x["other"]))
            open_ = np.frombuffer(places, np.int32).tolist()
            found = template(np.frombuffer(codes, np.int64).tolist(), set(open_), [np.frombuffer(x["codes"], np.int64).tolist() for x in others])
            gone.append(np.array([k for k, i in enumerate(open_) if i in found], np.int32).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("alike"), pa.array(gone, pa.binary())], ["host", "alike", "gone"])


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist()):
            lost = set(np.frombuffer(gone or b"", np.int32).tolist())
            texts.append("\n".join(x for k, x in enumerate(text.split("\n")) if k not in lost))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def _placed(parsed: DataFrame) -> DataFrame:
    """The different pages of every host that needs pairs, numbered by ``at`` in order of host and path.

    Numbers run on across the borders of partitions, so places don't depend on them.
    """
    hosts = parsed.where("open IS NOT NULL").select("host").distinct()
    some = parsed.where(F.octet_length("codes") > 0).join(hosts, "host", "left_semi")
    different = some.groupBy("host", "alike").agg(F.min(F.struct("path", "page_id")).alias("least"), F.first("codes").alias("codes"), F.first("open").alias("open"))
    order = ["host", "path", "page_id", "alike"]
    sorted_ = different.select("host", "least.path", "least.page_id", "alike", "codes", "open").repartitionByRange(*order).sortWithinPartitions(*order)
    held = settle(sorted_.withColumn("place", F.monotonically_increasing_id()), "pages-placed")
    held = held.withColumn("part", F.shiftright("place", 33))
    many = sorted((r["part"], r["count"]) for r in held.groupBy("part").count().collect())
    firsts = [(part, end - n, part << 33) for (part, n), end in zip(many, accumulate(n for _, n in many))]
    firsts = parsed.sparkSession.createDataFrame(firsts, "part long, ahead long, zero long")
    return held.join(F.broadcast(firsts), "part").withColumn("at", F.col("place") - F.col("zero") + F.col("ahead")).drop("part", "place", "ahead", "zero")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    Pages are parsed where they lie. Pairs are sought by number, without text, so that a
    large host spreads over many tasks and no border of a partition parts neighbours; then
    only hashes of lines travel.
    """
    url = F.col("url").cast("string")
    read = small_batches(pages).select(
        F.col("page_id").cast("long").alias("page_id"), url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"),
        F.col("html").cast("string").alias("html"))
    parsed = settle(read.mapInArrow(
        _parse, "page_id long, url string, host string, path string, text string, open binary, codes binary, alike binary"), "pages-parsed")
    placed = _placed(parsed)
    unsaid = placed.where("open IS NOT NULL")
    needing = unsaid.select("host", "at")
    beside = F.explode(F.array(*(F.col("at") + d for d in range(-NEAR, NEAR + 1) if d)))
    near = needing.select("host", "at", beside.alias("other")).join(placed.select("host", F.col("at").alias("other")), ["host", "other"])
    nth = F.row_number().over(Window.partitionBy("host").orderBy("alike"))
    far = placed.select("host", "alike", F.col("at").alias("other")).withColumn("nth", nth).where(F.col("nth") <= FAR)
    far = needing.join(far.select("host", "other"), "host").where("at != other")
    pairs = near.select("at", "other").union(far.select("at", "other")).distinct()
    others = pairs.join(placed.select(F.col("at").alias("other"), "path", "codes"), "other")
    others = others.groupBy("at").agg(F.collect_list(F.struct("other", "path", "codes")).alias("others"))
    gone = unsaid.join(others, "at").select("host", "alike", "at", "path", "codes", "open", "others")
    gone = gone.mapInArrow(_templates, "host string, alike binary, gone binary")
    rest = parsed.where("open IS NOT NULL").join(gone, ["host", "alike"], "left").select("page_id", "url", "text", "gone")
    said = parsed.where("open IS NULL").select("page_id", "url", "text")
    return said.union(rest.mapInArrow(_without, "page_id long, url string, text string")).withColumn("n_chars", F.length("text").cast("long"))
