"""The mix: targets, closeness, bounds, and the same outcome however rows are dealt."""

import random
import re

import pytest
from glyphmill.llm import mixing
from pyspark.sql import functions as F


def words_in(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes):
    """Share by weight; who is above three times their size stops there; share the rest anew."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        left = total - sum(capped.values())
        open_weight = sum(weight[s] for s in order if s not in capped)
        share = {s: left * weight[s] / open_weight for s in order if s not in capped}
        over = [s for s in share if share[s] > 3 * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: 3 * sizes[s] for s in over}


def made_up():
    rng = random.Random(3)
    rows = []
    for i in range(900):
        source = "big" if i % 3 == 0 else rng.choice(["a", "b", "Z", "é", "tiny", None])
        if source == "tiny" and i > 30:
            source = "b"
        rows.append((i, " ".join("w" * rng.randrange(1, 4) for _ in range(rng.randrange(0, 60))), source))
    return rows + [(2000, None, "a"), (2001, "", None), (5, "same row", "a"), (5, "same row", "a"), (5, "same row", "a"), (None, "no key", "b")]


def test_targets_and_closeness(spark):
    rows = made_up()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, source string, size int, target string")
    got = mixing.mixed(docs).collect()
    assert len(got) == len(rows)
    sizes, taken, largest = {}, {}, {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + words_in(t)
        largest[s] = max(largest.get(s, 0), words_in(t))
    want = plain_targets(sizes)
    for r in got:
        assert 0 <= r.copies <= 3 and r.taken == r.size * r.copies and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6
    assert sorted(r.size for r in got) == sorted(words_in(t) for _, t, _ in rows)


def test_same_outcome_for_any_partitioning(spark):
    docs = spark.createDataFrame(made_up(), "doc_id long, text string, source string")
    once = sorted(map(tuple, mixing.mixed(docs.repartition(1)).collect()), key=repr)
    assert once == sorted(map(tuple, mixing.mixed(docs.repartition(7, "text")).collect()), key=repr)


def test_rows_come_as_often_as_they_are_taken(spark):
    docs = spark.createDataFrame(made_up(), "doc_id long, text string, source string")
    times = {tuple(r)[:2]: r.n for r in mixing.mixture(docs).groupBy("doc_id", "text").agg(F.count("*").alias("n")).collect()}
    texts = {r[:2] for r in made_up()}
    assert set(times) <= texts
    assert sum(times.values()) == mixing.mixed(docs).agg(F.sum("copies")).first()[0]
    assert mixing.mixture(docs).columns == docs.columns
    assert mixing.mixed(docs.limit(0)).count() == 0 and mixing.mixture(docs.limit(0)).count() == 0


def test_no_words_at_all(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [r.taken for r in mixing.mixed(docs).collect()] == [0, 0]
