"""Removed windows against a plain dictionary of windows."""

import hashlib
import random
import re

import pytest
from glyphmill.llm import repeats


def plain(rows, window=50):
    first, out = {}, []
    split = [(k, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, t in rows]
    order = lambda k: (k is None, k or 0)
    for k, ws in split:
        for i in range(len(ws) - window + 1):
            w = tuple(ws[i : i + window])
            first[w] = min(first.get(w, (True, 1 << 70)), order(k))
    for k, ws in split:
        gone = set()
        for i in range(len(ws) - window + 1):
            if first[tuple(ws[i : i + window])] < order(k):
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
        out.append((k, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def made_up():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(30)] + ["é", "the", "a"]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passages = [some(n) for n in (49, 50, 51, 55, 80, 120)] + [["a"] * 70, ["a", "b"] * 40, ["the"] * 24 + some(30)]
    rows = []
    for i in range(120):
        ws = some(rng.randrange(0, 90))
        for _ in range(rng.randrange(0, 3)):
            ws += rng.choice(passages) + some(rng.randrange(0, 30))
        rows.append((rng.randrange(200), " ".join(ws)))
    rows += [(500, rows[3][1]), (501, rows[3][1] + "  "), (7, "x " * 60), (8, "x\t" * 90), (9, "x " * 50 + "y"), (None, rows[5][1]), (None, None)]
    return rows + [(600, None), (601, ""), rows[10], rows[10]]


@pytest.mark.parametrize("block_chars", [3_000, 6_000_000])
def test_made_up(spark, block_chars):
    rows = made_up()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, block int, k1 string")
    assert sorted(map(tuple, repeats.removed(docs, block_chars=block_chars).collect()), key=repr) == plain(rows)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = sorted(map(tuple, repeats.query(spark, "/root/testdata/sf0.01").collect()), key=repr)
    assert got == plain([tuple(r) for r in docs.collect()])
    assert repeats.removed(docs.limit(0)).count() == 0
