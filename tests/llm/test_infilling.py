"""Boundary sets against plain lists, and outputs against a restatement text by text."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from glyphmill.llm import infilling
from hypothesis import given, settings, strategies as st

TOKEN = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


def ends_of(text):
    return [m.end() for m in TOKEN.finditer(text)]


def restated(doc_id, text):
    """The contract, read literally."""
    text = text or ""
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    tokens = TOKEN.findall(text)
    n = len(tokens)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(tokens[:low]), "".join(tokens[low:high]), "".join(tokens[high:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize(
    "offsets, kind",
    [
        (range(3, 60_000, 20), infilling.ArrayContainer),
        (range(1, 60_000, 3), infilling.BitmapContainer),
        ([*range(5, 9_000), *range(9_500, 50_000)], infilling.RunContainer),
        ([65_535], infilling.ArrayContainer),
        ([0, 65_535], infilling.ArrayContainer),
    ],
)
def test_containers(offsets, kind):
    offsets = np.array(offsets)
    found = infilling.container(offsets)
    assert type(found) is kind
    assert [found.select(k) for k in range(len(offsets))] == offsets.tolist()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 70_000), st.integers(1, 9000), st.integers(1, 30)), max_size=8))
def test_sets_of_any_shape(stretches):
    offsets = np.unique(np.cumsum(np.concatenate([[0], *[[gap, *[step] * n] for gap, n, step in stretches]]))).astype(np.int64)
    found = infilling.BoundarySet(offsets)
    for k in np.unique(np.linspace(0, len(offsets) - 1, 50).astype(int)):
        assert found.select(int(k)) == offsets[k]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.text(alphabet="ab é漢😀 \t\n\x0b\x1c\xa0", max_size=30), max_size=6))
def test_boundaries(texts):
    for text, found in zip(texts, infilling.boundary_sets(pa.array(texts, pa.string()))):
        assert [found.select(k) for k in range(found.size)] == ends_of(text)


EDGES = [(None, "null key stays a row"), (1, None), (2, ""), (3, " \t\n"), (4, "a"), (4, "a"), (5, "has <S> inside"), (6, "  lead and trail  "),
         (7, "漢字 и 😀 \x1c x " * 4000), (8, "<P" + " > x" * 9), (9, "word"), (10, "< < < <P <S <M > P> S> M>"), (11, "x y " * 200_000), (12, "y" * 300_000)]


def check(rows, texts):
    for r, (key, text) in zip(rows, texts):
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == restated(key, text)
        assert r.back == (text or "")


def test_edge_rows(spark):
    more = [(100 + i, "< <P> P> <S <M x" if i % 7 == 0 else "<P <S <M >P> S> M> < " * (i % 5 + 1)) for i in range(200)]
    data = [*EDGES, *more]
    docs = spark.createDataFrame([(i, k, t, "x", 1) for i, (k, t) in enumerate(data)], "place long, doc_id long, text string, row string, n int")
    out = infilling.fill_in_middle(docs).withColumn("back", infilling.restored(infilling.F.col("output"), infilling.F.col("form")))
    rows = sorted(out.collect(), key=lambda r: r.row.place)
    assert len(rows) == len(data) and {r.form for r in rows} == {"plain", "psm", "spm"}
    check(rows, data)
    assert infilling.fill_in_middle(docs.where("false")).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    query = infilling.query(spark, folder)
    assert query._jdf.queryExecution().executedPlan().toString().count("run(") == 1
    rows = query.collect()
    assert len(rows) == len(docs)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for r in rows:
        n, form, low, middle, output = restated(r.doc_id, docs[r.doc_id])
        assert tuple(r) == (r.doc_id, n, form, low, middle, sha(output), sha(docs[r.doc_id]))
