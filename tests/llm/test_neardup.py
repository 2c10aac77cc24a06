"""Links and classes against all pairs, on small fixtures and the documents."""

import random
import re

import numpy as np
import pytest
from glyphmill.llm import neardup
from glyphmill.llm.components import components


def sets_of(rows):
    out = []
    for k, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        out.append((k, frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()))
    return out


def plain(rows):
    sets, n = sets_of(rows), len(rows)
    parent, links = list(range(n)), [0] * n

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(n):
            a, b = sets[i][1], sets[j][1]
            both = len(a & b)
            if i != j and (a == b or (both and 5 * both >= 4 * (len(a) + len(b) - both))):
                links[i] += 1
                parent[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(sets):
        if k is not None:
            least[find(i)] = min(least.get(find(i), k), k)
    return sorted(((k, least.get(find(i)), links[i]) for i, (k, _) in enumerate(sets)), key=repr)


def near_copies(n, words, seed):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(400)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(0, 5)):
            copy[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("blocks", [None, 16])
def test_against_all_pairs(spark, monkeypatch, blocks):
    if blocks:
        monkeypatch.setattr(neardup, "NODE_BLOCK", blocks)
        monkeypatch.setattr(neardup, "CLUSTER_BLOCK", blocks)
    texts = near_copies(70, 120, 1) + near_copies(3, 40, 2) + near_copies(20, 9, 3)
    texts += ["", None, "one two", "one two", "one  two", "three", "a b c d e", "a b c d f"] + texts[:2]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (None, "only null"), (5, texts[5])]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, id int, root string")
    got = [(r.doc_id, r.class_id, r.n_links) for r in neardup.joined(docs).collect()]
    assert sorted(got, key=repr) == plain(rows)


def test_one_of_each_class_stays(spark):
    rows = [(i, t) for i, t in enumerate(near_copies(6, 60, 1))] + [(10, "solo text"), (11, None), (12, ""), (13, "solo  text"), (10, "solo text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((tuple(r) for r in neardup.first_of_each(docs).collect()), key=repr)
    want = {c for _, c, _ in plain(rows)}
    assert {k for k, _ in kept} == want and len(kept) == len(want)
    nulls = [(None, rows[0][1]), (None, "a text of its own"), (None, "another one"), (None, "another one"), *rows[:2]]
    kept = neardup.first_of_each(spark.createDataFrame(nulls, docs.schema)).collect()
    assert sorted(r.text for r in kept) == sorted(["a text of its own", "another one", rows[0][1]])
    assert [r.doc_id for r in kept if r.text == rows[0][1]] == [0]
    assert neardup.joined(docs.limit(0)).count() == 0


def test_prefixes_shorten_until_the_target(spark):
    assert neardup.shortest_prefix(0.8, 16, 8, 0.999) == 4
    assert neardup.shortest_prefix(0.8, 16, 8, 0.3) == 8


def test_documents_against_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = [(r.doc_id, r.class_id, r.n_links) for r in neardup.joined(docs).collect()]
    assert sorted(got, key=repr) == plain([tuple(r) for r in docs.collect()])


@pytest.mark.parametrize("seed", range(30))
def test_clusters_of_a_trie(seed):
    """Nodes opened from the longest prefix on give the clusters of all pairs with like sketches."""
    rng = np.random.default_rng(seed)
    n, needed = int(rng.integers(2, 60)), 11
    sketch = rng.integers(0, 2 + seed % 3, (n, 16), dtype=np.uint8)
    sketch = sketch[np.lexsort(sketch[:, 3::-1].T)]
    got = neardup._joined_in_trie(sketch[:, :4], sketch, needed)
    alike = (sketch[:, None] == sketch[None]).sum(2) >= needed
    want = np.arange(n)
    for _ in range(n):
        want = np.array([want[row].min() for row in alike])
    assert [got[:i + 1].tolist().index(c) for i, c in enumerate(got)] == want.tolist()


def test_settled_nodes_are_not_opened(monkeypatch):
    """Rows joined at the whole signature are not compared again at shorter prefixes."""
    opened = []
    connect = neardup._connect
    monkeypatch.setattr(neardup, "_connect", lambda left, *rest: (opened.append(len(left)), connect(left, *rest)))
    path = np.array([[1, 1], [1, 1], [1, 1], [1, 2], [2, 1]], np.uint8)
    sketch = np.repeat(np.array([[7], [7], [7], [7], [9]], np.uint8), 8, axis=1)
    assert neardup._joined_in_trie(path, sketch, 8).tolist() == [0, 0, 0, 0, 4]
    assert opened == [3, 4, 5]
    opened.clear()
    assert neardup._joined_in_trie(path[:3], sketch[:3], 8).tolist() == [0, 0, 0] and opened == [3]


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(60)] + [(7, 7)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect())
    parent = {x: x for p in links for x in p}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    assert got == {x: find(x) for a, b in links if a != b for x in (a, b)}
