"""Scores against a plain model in dictionaries."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from glyphmill.llm import lm


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]


def plain(rows):
    held = {k: k is not None and zlib.crc32(str(k).encode()) % 7 == 2 for k, _ in rows}
    one, two = Counter(), Counter()
    for k, t in rows:
        if not held[k]:
            ts = tokens(t)
            one.update(ts)
            two.update(zip(ts, ts[1:]))
    n, v = sum(one.values()), len(one)
    n1, n2 = (sum(c == x for c in one.values()) for x in (1, 2))
    d = min(max(n1 / (n1 + 2 * n2) if n1 + n2 else 0.5, 0.05), 0.95)
    out = []
    for k, t in rows:
        ts, base, score = tokens(t), 0.0, 0.0
        for i, w in enumerate(ts):
            base += math.log10((one[w] + 1) / (n + v + 1))
            p = (one[w] - d) / n if one[w] else (d * v / n if n else 1.0)
            if i and one[ts[i - 1]]:
                c, left = two[ts[i - 1], w], one[ts[i - 1]]
                own = lm.OWN_WEIGHT * left / (left + lm.OWN_PRIOR)
                p = (1 - own) * p + (own * c / left if c >= lm.MIN_COUNT else 0)
            score += math.log10(p)
        out.append((k, held[k], len(ts), sum(one[w] > 0 for w in ts), n, base, score))
    return out


def same(got, want):
    by = lambda rows: sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[6]))
    got, want = by(got), by(want)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert tuple(g)[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9, abs=1e-9)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()] + [(900, None), (901, ""), (901, ""), (None, "The the"), (902, "A b A b A b")]
    more = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, block int, held_out string")
    got = lm.scored(more, block_chars=20_000).collect()
    same(got, plain(rows))
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert lm.scored(docs).count() == 0
    only = [(k, "a b") for k in range(40) if zlib.crc32(str(k).encode()) % 7 == 2]
    same(lm.scored(spark.createDataFrame(only, docs.schema)).collect(), plain(only))


def test_totals_beyond_32_bits():
    many = 2**31 - 1
    asked = pa.table(
        {
            "bucket": [0, 0, 0],
            "block": [0, 1, 2],
            "words": pa.array([[5, 6], [5], [5, 7]], pa.list_(pa.int64())),
            "word_n": pa.array([[many, 1], [many], [many, 0]], pa.list_(pa.int32())),
            "pairs": pa.array([[8], [8], []], pa.list_(pa.int64())),
            "pair_n": pa.array([[many], [1], []], pa.list_(pa.int32())),
        }
    )
    answers = lm._answers(lm.MIN_COUNT)(asked)
    assert lm._totals(answers, "word").tolist() == [3 * many, 1, 3 * many, 3 * many, 0]
    assert lm._totals(answers, "pair").tolist() == [2**31, 2**31]


def test_what_may_follow_a_state_sums_to_one():
    words, n = np.array([1, 2, 3], np.uint64), np.array([5, 4, 3])
    follows = {(1, 2): 3, (1, 3): 1, (1, 1): 1}
    ids = {p: lm._bigrams(np.array(p, np.uint64), np.array([2]))[0][0] for p in [(1, 1), (1, 2), (1, 3), (1, 99)]}
    pairs = np.array([ids[p] for p in follows]), np.array(list(follows.values()))
    model = lm.Automaton((words, n), pairs, {"tokens": 12, "types": 3, "once": 1, "twice": 1}, lm.OWN_WEIGHT, lm.OWN_PRIOR)
    weight = [10 ** model.traverse(np.array([1, w], np.uint64), np.array([2]))[1][1] for w in (1, 2, 3, 99)]
    assert sum(weight) == pytest.approx(1)


def test_a_failure_arc_costs_less_from_a_state_seldom_left():
    words, n = np.array([1, 2, 3], np.uint64), np.array([2, 200, 50])
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    model = lm.Automaton((words, n), none, {"tokens": 252, "types": 3, "once": 0, "twice": 1}, 0.4, 3.0)
    cost = [10 ** (np.diff(model.traverse(np.array([w, 3], np.uint64), np.array([2]))[1])[0]) * (c - model.discount) for w, c in ((1, 2), (2, 200))]
    assert cost[0] / cost[1] == pytest.approx((1 - 0.4 * 2 / 5) / (1 - 0.4 * 200 / 203))
