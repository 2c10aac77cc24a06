"""Words, ids and pairs by whole columns: equal to plain restatements, and laid out to scale."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from glyphmill.functions import merging
from glyphmill.functions.text import WHITESPACE
from glyphmill.operators import batches as bt, ordering, scoring as sc, words as wd
from glyphmill.operators.tokenizer import Tokenizer, token_rows


def plain_words(text):
    return [w for w in text.translate({ord(c): " " for c in WHITESPACE}).split(" ") if w]


def odd_texts(n=3000):
    r = random.Random(7)
    # White space of one to three bytes, and characters that begin with the same bytes or are none.
    alphabet = WHITESPACE + "ab\u00c2\u00a3\u200b\u3001\u00e9\u1681\u2030\U0001f600\x1c\x1f\x00"
    return [None if r.random() < 0.1 else "".join(r.choice(alphabet) for _ in range(r.randrange(12))) for _ in range(n)]


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_split_words(kind):
    texts = odd_texts()
    expected = [None if t is None else plain_words(t) for t in texts]
    column = pa.array(texts, kind)
    assert merging.split_words(column).to_pylist() == expected
    assert merging.split_words(column.slice(17, 500)).to_pylist() == expected[17:517]
    assert merging.split_words(pa.array([], kind)).to_pylist() == []


def test_count_words_by_blocks(monkeypatch):
    monkeypatch.setattr(merging, "COUNT_BLOCK", 100)
    texts, found = odd_texts(), Counter()
    for part in merging.count_words([pa.RecordBatch.from_arrays([pa.array(texts)], ["t"])]):
        words = part.column("word").to_pylist()
        # A word is one row of a block, however often it is there.
        assert len(words) == len(set(words))
        found.update(dict(zip(words, part.column("freq").to_pylist())))
    assert found == Counter(w for t in texts if t for w in plain_words(t))


def test_encode_texts_as_lists(monkeypatch):
    monkeypatch.setattr(merging, "TEXT_BLOCK", 50)
    merger = merging.Merger(["aaX", "abY", "XaZ", "XXW", "XYa", "aaV"])
    texts = odd_texts(500) + ["aaaaab aaab abab", ""]
    lists = pa.array([None if t is None else plain_words(t) for t in texts], pa.list_(pa.string()))
    by_text = [x for part in merging.encode_texts(pa.array(texts), merger, 36) for x in part.to_pylist()]
    assert by_text == [x for part in merging.encode_lists(lists, merger, 36) for x in part.to_pylist()]


def test_only_places_of_rules_wait():
    """A block's first look takes the places where a rule may apply, not all of them."""
    merger = merging.Merger(["abX", "XcY"])
    row = np.array([ord(c) for c in "zzabcz" + "q" * 1000 + "bacX" + "\U0010ffff"])
    # "ab", and "ac": one rule's left beside another's right.
    assert merger.begun(row).tolist() == [2, 1007]
    assert merging.Merger([]).begun(row).tolist() == []


def plan_of(df):
    return df._jdf.queryExecution().analyzed().toString()


def test_words_are_not_exploded(spark):
    df = spark.createDataFrame([("a b\u3000a",), (None,), ("",), ("a a b",), ("a b\u3000a",)], "text string")
    counts = wd.word_frequency(df)
    assert "explode" not in plan_of(counts)
    assert {(r.word, r.freq) for r in counts.collect()} == {("a", 6), ("b", 3)}


def test_steps_make_no_structs(spark):
    rows = [(1, [2, 5, 6, 5, 3]), (1, [2, 5, 6, 5, 3]), (None, [7]), (3, []), (4, None), (5, [2, 0, 5, 6])]
    tokens = spark.createDataFrame(rows, "k int, token_ids array<int>")
    pairs, counts = bt.next_token_pairs(tokens, "k"), sc.next_token_counts(tokens, 2)
    assert "arrays_zip" not in plan_of(pairs) + plan_of(counts)
    expected = [
        (k, i, a, b) for k, ids in rows for i, (a, b) in enumerate(zip(ids or [], (ids or [])[1:])) if b != 0
    ]
    key = lambda x: tuple((v is not None, v) for v in x)
    assert sorted(map(tuple, pairs.collect()), key=key) == sorted(expected, key=key)
    steps = Counter((tuple(ids[i : i + 2]), ids[i + 2]) for _, ids in rows if ids for i in range(len(ids) - 2) if ids[i + 2] != 0)
    assert {(tuple(r.context), r.next): r.freq for r in counts.collect()} == steps


def test_encode_sends_texts(spark):
    """The words of a text are found in the worker: the JVM makes no row or array of them."""
    df = spark.createDataFrame([("ab\u00a0ab",), (None,), (" ",)], "text string")
    encoded = df.select(Tokenizer(((b"a", b"b"),)).encode("text").alias("ids"))
    assert "split" not in plan_of(encoded)
    assert [r.ids for r in encoded.collect()] == [[260, 36, 260], None, []]


@pytest.mark.parametrize("block", [10, 1 << 21])
def test_encode_each_as_lists(monkeypatch, block):
    monkeypatch.setattr(merging, "TEXT_BLOCK", block)
    merger = merging.Merger(["aaX", "abY", "XaZ", "XXW", "XYa", "aaV"])
    words = pa.array(["aab", None, "", "abab", "aab", "aaaaa", None, "é"] * 5, pa.string())
    lists = pa.array([None if w is None else [w] for w in words.to_pylist()], pa.list_(pa.string()))
    for rows in (slice(0, None), slice(3, 20), slice(1, 2), slice(0, 0)):
        each = [x for part in merging.encode_each(words[rows], merger, 36) for x in part.to_pylist()]
        assert each == [x for part in merging.encode_lists(lists[rows], merger, 36) for x in part.to_pylist()]


def test_a_word_is_sent_as_it_is(spark):
    df = spark.createDataFrame([("ab",), (None,), ("",), ("ab",)], "word string")
    encoded = df.select(Tokenizer(((b"a", b"b"),)).encode_word("word").alias("ids"))
    assert "array(word" not in plan_of(encoded)
    assert [r.ids for r in encoded.collect()] == [[260], None, [], [260]]


def test_token_rows_bound_batches(spark):
    """A worker's memory follows neither the number nor the length of a partition's texts."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(key)
    token_rows(spark.createDataFrame([(1, "a")], "k int, text string"), Tokenizer(), "k")
    assert int(spark.conf.get(key)) <= 4 << 20
    spark.conf.set(key, "1000")
    token_rows(spark.createDataFrame([(1, "a")], "k int, text string"), Tokenizer(), "k")
    assert spark.conf.get(key) == "1000"
    spark.conf.unset(key)


def test_windows_are_filled(spark):
    rows = [(n, list(range(1, n + 1))) for n in range(9)] + [(9, None)]
    df = spark.createDataFrame(rows, "n int, token_ids array<int>")
    for r in bt.model_rows(df, 5).collect():
        ids = rows[r.n][1]
        for got, by in ((r.input, 0), (r.target, 1)):
            assert got == (None if ids is None else ([*ids, *[0] * 9])[by : by + 5])


def test_a_shuffle_looks_for_no_bounds(spark, monkeypatch):
    """Hashes deal the rows: the order is that of the hash, and nothing is sorted by range."""
    monkeypatch.setattr(ordering, "_Sorted", None)
    keys = [None, *range(3000)]
    df = spark.createDataFrame([(k, 1) for k in keys], "k int, digits int")
    ranked = ordering.shuffled_rank(df, "k", 7).collect()
    order = sorted(keys, key=lambda k: hashlib.md5(f"7:{'' if k is None else k}".encode()).hexdigest())
    assert [r.k for r in sorted(ranked, key=lambda r: r.rn)] == order
    assert sorted(r.rn for r in ranked) == list(range(1, len(keys) + 1)) and all(r.digits == 1 for r in ranked)
