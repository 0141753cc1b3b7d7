import pytest
from hypothesis import given, strategies as st

from vigilframe.llm import pages as P


def kept(html, *others):
    return P.main_text(P.lines(html), [P.lines(x) for x in others])


@pytest.mark.parametrize("html, text", [
    ("", ""),
    ("just text &amp; more", "just text & more"),
    ("<article><h1>A&nbsp;&lt;b&gt;</h1><p><b>One\n\t two<br><p>Three</article><footer>x</footer>", "A <b>\nOne two\nThree"),
    ("<nav>Home</nav><main><p>Text<script>var t='</p>';</script> here</p><aside>see</aside></main>", "Text here"),
    ("<article><p>In</p><div class='comments'><p>nice</p></div><form><p>q</p></form><p>Out</p></article>", "In\nOut"),
    ("<article class=comment><p>mine</p></article><article><p>yours</p></article>", "yours"),
    ("<div id=page><header><h1>Site</h1></header><article><header><h1>Title</h1></header>x</article></div>", "Title\nx"),
    ("<article>a<!-- <p>no</p> -->b <style>p{}</style>c</article>", "ab c"),
    ("<article><p>unclosed <b>bold", "unclosed bold"),
    ("<article><p title=\"a > b\">x</p><p class='ad-box'>buy<p>y</article>", "x\ny"),
    ("<div class='sidebar'>s<article>main</article></div>", "main"),
    ("<article>Body</article><section id='comments'><article>reader comment</article></section>", "Body"),
    ("<div class='related'><article>other</article></div><main><p>Body</p></main>", "Body"),
    ("<div class='sidebar'><article>s</article></div><article>Body<div class='comments'><article>c</article></div></article>", "Body"),
    ("<main><div class='social-history'><p>The social history of Rome</p></div><div class='social-links'>follow</div></main>", "The social history of Rome"),
    ("<article><div class='search-and-rescue'>a</div><div class='related'>r</div><div class='post-share'>s</div>b</article>", "a\nb"),
    ("<article><p hidden>h</p><p style='display: none'>h</p><p>1 < 2</article>", "1 < 2"),
])
def test_lines_by_markup(html, text):
    assert kept(html) == text


def page(*body):
    return "<div>Our site</div>" + "".join(f"<p>{x}</p>" for x in body) + "<div>All rights</div>"


def test_shared_lines_are_template():
    assert kept(page("a", "b", "c"), page("d", "b2", "e")) == "a\nb\nc"
    assert kept(page("a"), page("a")) == "Our site\na\nAll rights"  # a copy is no pair
    assert kept(page("a", "b"), page("a", "b"), page("x", "y")) == "a\nb"


def longest(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row = [0] + [max(row[j + 1], 0) if x != y else row[j] + 1 for j, y in enumerate(b)]
        for j in range(1, len(row)):
            row[j] = max(row[j], row[j - 1])
    return row[-1]


@given(st.lists(st.sampled_from("abcd"), max_size=14), st.lists(st.sampled_from("abcd"), max_size=14))
def test_shared_is_a_longest_common_subsequence(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    found = sorted(P.shared(a, b))
    assert len(found) == table[-1][-1]
    rest = iter(b)
    assert all(a[i] in rest for i in found)


def test_pages_meet_their_neighbours(spark):
    rows = [(k, f"http://H.example/en/{k:03d}?x=1", page(f"text {k}", f"more {k}"), "clash") for k in range(40)]
    rows += [(100, None, None, ""), (101, "odd", "<p>alone</p>", ""), (102, "http://other.example/a", page("single"), "")]
    rows += [(k, "http://art.example/" + u, "<nav>n</nav><article><p>same</p></article>", "") for k, u in ((200, "a"), (201, "a#top"), (201, "a#top"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = {r.page_id: r for r in P.extract(pages).collect()}
    assert all(found[k].text == f"text {k}\nmore {k}" for k in range(40))
    assert found[100].text == "" and found[100].n_chars == 0 and found[101].text == "alone"
    assert found[102].text == "Our site\nsingle\nAll rights" and found[201].text == "same"
    assert P.extract(pages).count() == len(rows) and P.extract(pages.limit(0)).count() == 0


def test_whole_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = P.extract(pages).collect()
    assert len(found) == pages.count() and all(r.n_chars == len(r.text) > 0 for r in found)
    assert not any("<article>" in r.text or "&copy;" in r.text or "track(" in r.text for r in found)


def test_texts_do_not_depend_on_partitions(spark):
    rows = [(k, f"http://h{k % 3}.example/en/{k:03d}", page(f"text {k}", f"more {k}", f"last {k}")) for k in range(60)]
    pages, want = spark.createDataFrame(rows, "page_id long, url string, html string"), {k: f"text {k}\nmore {k}\nlast {k}" for k in range(60)}
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for partitions in (1, 7, 50):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            assert {r.page_id: r.text for r in P.extract(pages).collect()} == want
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def long_menu(*body):
    return "".join(f"<div>menu {k}</div>" for k in range(10)) + "".join(f"<p>{x}</p>" for x in body)


def test_a_short_text_under_a_long_menu():
    a, b, c, d = (long_menu(f"one {k}", f"two {k}") for k in range(4))
    assert kept(a, b) == kept(a, b, c) == kept(a, b, c, d) == "one 0\ntwo 0"
    assert kept(a, a, a, b) == "one 0\ntwo 0"  # between two copies
    assert kept(a, "<p>odd</p>", b, c, d) != "" and kept(a, b, "<p>odd</p>", c, d) == "one 0\ntwo 0"


def test_copies_that_differ_in_a_line_are_no_pair():
    text = [f"line {k}" for k in range(8)]
    copies = [long_menu(*text, f"advert {k}") for k in range(3)]
    others = [long_menu(*(f"{k} of {j}" for k in range(8))) for j in range(4)]
    assert kept(copies[0], copies[1], copies[2], *others) == "\n".join([*text, "advert 0"])
    assert kept(copies[0], copies[1], others[0]) == "\n".join([*text, "advert 0"])


def test_pairs_behind_many_copies(spark):
    rows = [(k, f"http://h.example/a/{k:03d}", long_menu("one", "two")) for k in range(30)]
    rows += [(100 + k, f"http://h.example/b/{k:03d}", long_menu(f"one {k}", f"two {k}")) for k in range(8)]
    found = {r.page_id: r.text for r in P.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(found[k] == "one\ntwo" for k in range(30))
    assert all(found[100 + k] == f"one {k}\ntwo {k}" for k in range(8)) and len(found) == 38


def test_unclosed_elements_take_linear_time():
    import time

    def seconds(n):
        start = time.perf_counter()
        P.lines("<div>" * n + "x</p>" * n)
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(100_000) < 40 * max(seconds(10_000), 0.005)


def test_pages_without_article_on_few_hosts(spark):
    """All that pages of a host share goes, all else stays; one host has a third of the pages."""
    import random

    r = random.Random(7)
    rows, want = [], {}
    for k in range(600):
        host = 0 if k % 3 == 0 else r.randrange(1, 6)
        own = [f"line {k} {i} {r.randrange(10**6)}" for i in range(r.randrange(1, 8))]
        menu = "".join(f"<div>menu {host} {i}</div>" for i in range(12))
        body = "".join(f"<p>{x}</p>" for x in own)
        rows.append((k, f"http://h{host}.example/{r.randrange(40)}/{k}", f"{menu}{body}<div>rights {host}</div>"))
        want[k] = "\n".join(own)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)
    assert {x.page_id: x.text for x in P.extract(pages).collect()} == want
