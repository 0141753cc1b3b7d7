import random
import re

import numpy as np
import pytest
from hypothesis import given, strategies as st

from tests.llm.helpers import documents, odd_rows, words
from vigilframe.llm import graph, minhash as M

_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOW))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def expected(rows):
    sets = [(i, shingles(t)) for i, t, *_ in rows]
    usable = [(i, s) for i, s in sets if s and i is not None]
    links = [(a, b) for k, (a, x) in enumerate(usable) for b, y in usable[:k] if 4 * len(x & y) >= 3 * len(x | y)]
    root = roots({i for i, _ in usable}, links)
    return sorted(((i, len(s), root[i] if s and i is not None else i, i is None or not s or root[i] == i) for i, s in sets), key=repr)


def found(docs):
    return sorted((tuple(r) for r in M.near_groups(docs).select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


@given(st.lists(st.text(st.sampled_from("aAbB \n\té"), max_size=60), max_size=6))
def test_sets_are_the_distinct_shingles(texts):
    data = [t.encode() for t in texts]
    hashes, sizes = M.shingle_sets(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    want = [shingles(t) for t in texts]
    assert sizes.tolist() == [len(x) for x in want]
    own = [set(x.tolist()) for x in np.split(hashes, np.cumsum(sizes)[:-1])] if texts else []
    assert all(len(a & b) == len(x & y) for a, x in zip(own, want) for b, y in zip(own, want))


def changed(text: str, seed: int, many: int) -> str:
    r, w = random.Random(seed), text.split()
    for _ in range(many):
        w[r.randrange(len(w))] = f"new{r.randrange(99)}"
    return " ".join(w)


def corpus():
    rows = list(odd_rows())
    for base in range(12):
        text = words(base, 120, 5000)
        rows += [(100 + 20 * base + k, changed(text, 31 * base + k, k % 7), "en", "s") for k in range(14)]
    shared = words(999, 60, 5000)  # a passage that many texts share
    rows += [(1000 + k, shared + " " + words(2000 + k, 40 + k, 5000), "en", "s") for k in range(40)]
    rows += [(2000 + k, "only four words here" if k % 2 else "ONLY four words\nhere", "en", "s") for k in range(5)]
    return rows


def test_all_links_are_found(spark):
    assert found(documents(spark, corpus())) == expected(corpus())


def test_blocks_of_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 3)
    assert found(documents(spark, corpus())) == expected(corpus())


def test_drop_near_and_empty(spark):
    docs = documents(spark, corpus())
    left = M.drop_near(docs)
    assert left.columns == docs.columns
    assert left.count() == sum(r[3] for r in expected(corpus()))
    assert M.near_groups(docs.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    r = random.Random(seed)
    links = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(200 + i, 201 + i) for i in range(40)] + [(300, 300)]
    want = {n: root for n, root in roots({x for l in links for x in l}, links).items() if n != root}
    got = graph.components(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.parent for r in got.collect()} == want


def chain(seed: int):
    """5 to 10 nodes in random order, each linked with the next."""
    r = random.Random(seed)
    nodes = r.sample(range(1, 40), r.randrange(5, 11))
    return list(zip(nodes, nodes[1:]))


@pytest.mark.parametrize("links", [[(1, 5), (5, 4), (4, 3), (3, 2)], *map(chain, (0, 1, 2, 18, 23, 34))])
def test_components_of_a_chain_alone(spark, links):
    nodes = {x for link in links for x in link}
    got = [(r.node, r.parent) for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()]
    assert sorted(got) == sorted((x, min(nodes)) for x in nodes - {min(nodes)})

