import random

import brute
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from glyphmill.functions import merging, symbols as sy
from glyphmill.operators.tokenizer import (
    Tokenizer,
    encode_words,
    occurrence_ids,
    round_trip,
    token_rows,
)
from glyphmill.operators import words as wd
from glyphmill.sources import tokenizer_files as tf

TEXTS = [
    None,
    "",
    " \t",
    "  the then  there ",
    "the\nend of the story",
    "پاکستان میں اردو",
    "naïve café \U0001f600",
    "<PAD> <BOS>",
    "th" * 200,
    "a\u001cb",
]
MERGES = tuple(
    (left, right) for left, right, _ in brute.train(brute.word_counts(TEXTS + ["the other then"] * 3), 30)
)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer(MERGES, 290)


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")


def many_rules(n):
    counts = brute.word_counts([" ".join(f"w{i * i % 977}x{i % 13}" for i in range(400)), *TEXTS])
    return tuple((left, right) for left, right, _ in brute.train(counts, n))


@pytest.mark.parametrize("n_rules", [0, 1, 33, 65, 300])
def test_encode_equals_brute_force(df, n_rules):
    merges = many_rules(n_rules)
    assert len(merges) == n_rules
    rows = df.select("id", Tokenizer(merges).encode("text").alias("ids")).collect()
    for row in rows:
        text = TEXTS[row.id]
        assert row.ids == (None if text is None else brute.encode(merges, text))


def test_decode_gives_back_the_words(df, tokenizer):
    rows = df.where("text is not null").select(
        "id", tokenizer.decode(tokenizer.encode_with_special("text")).alias("text")
    )
    for row in rows.collect():
        assert row.text == " ".join(brute.words(TEXTS[row.id]))


def test_framing(df, tokenizer):
    rows = token_rows(df, tokenizer, "id").collect()
    assert len(rows) == len(TEXTS) - 1
    for row in rows:
        assert row.token_ids == [2, *brute.encode(MERGES, TEXTS[row.id]), 3]
        assert row.n_tokens == len(row.token_ids)
    prompts = df.where("id = 3").select(tokenizer.encode_prompt("text").alias("ids"))
    assert prompts.first().ids == [2, *brute.encode(MERGES, TEXTS[3])]


def test_decode_drops_special_and_unknown_ids_and_repairs_utf8(spark, tokenizer):
    cases = [[0, 1, 2, 3], [4 + 0xC3], [4 + 0xC3, 4 + 0xA9, 9999, -5, 101], [4 + 0xE2, 4 + 0x82, 101], []]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, ids array<int>")
    got = {r.i: r.text for r in df.select("i", tokenizer.decode("ids").alias("text")).collect()}
    for i, ids in enumerate(cases):
        assert got[i] == brute.decode(MERGES, ids)


def test_id_to_string(spark, tokenizer):
    df = spark.createDataFrame([(0,), (101,), (4 + 0xC3,), (260,), (5000,), (-1,)], "id int")
    got = [r[0] for r in df.select(tokenizer.id_to_string("id")).collect()]
    assert got == ["<PAD>", "a", "�", (MERGES[0][0] + MERGES[0][1]).decode(), "<INVALID>", "<INVALID>"]


def test_vocabulary(spark, tokenizer):
    rows = tokenizer.vocabulary(spark).orderBy("id").collect()
    assert [r.id for r in rows] == list(range(260 + len(MERGES)))
    assert [bytes(r.token) for r in rows] == tokenizer.tokens
    assert [r.kind for r in rows].count("byte") == 256
    assert tokenizer.require_size(tokenizer.size()) is tokenizer
    with pytest.raises(ValueError, match="expected 10000"):
        tokenizer.require_size(10000)
    assert tokenizer.progress(spark, 10).count() == len(MERGES) // 10


def test_word_merging_follows_rank_order_for_any_rule_list():
    """Rules in orders no training would give: reused pairs, results that spell alike."""
    rng = random.Random(5)
    for _ in range(2000):
        pool = [b"a", b"b", b"c"]
        merges = []
        for _ in range(rng.choice([rng.randint(1, 12), rng.randint(60, 90)])):
            left, right = rng.choice(pool), rng.choice(pool)
            merges.append((left, right))
            if len(left + right) < 7 and left + right not in pool:
                pool.append(left + right)
        tokenizer = Tokenizer(tuple(merges))
        merger = merging.Merger(tokenizer.rules)
        text = "".join(rng.choice("abc") for _ in range(rng.randint(1, 20)))
        assert [ord(c) + 4 for c in merger.merge(text)] == brute.encode(merges, text)


def test_symbols_step_over_surrogates(spark):
    ids = [4, 259, 260, 0xD800 + 3, 0xD800 + 4, 0xD800 + 5, 70000]
    text = "".join(map(sy.symbol, ids))
    df = spark.createDataFrame([(text,)], "s string").select(
        sy.symbol_ids(F.col("s")).alias("ids"), sy.windows(F.col("s"), 2).alias("pairs")
    )
    row = df.first()
    assert row.ids == ids
    assert row.pairs == [text[i : i + 2] for i in range(len(text) - 1)]


def test_special_tokens_can_be_named(spark):
    named = Tokenizer((), special_tokens=("<p>", "<u>", "<b>", "<e>"))
    assert [bytes(r.token) for r in named.vocabulary(spark).where("kind = 'special'").orderBy("id").collect()] == [b"<p>", b"<u>", b"<b>", b"<e>"]
    row = spark.range(1).select(named.decode(F.array(F.lit(1), F.lit(2))).alias("t"), named.id_to_string(F.lit(3)).alias("s"))
    assert tuple(row.first()) == ("<u>", "<e>")
    with pytest.raises(ValueError, match="four different"):
        Tokenizer((), special_tokens=("a", "a", "b", "c"))


def test_occurrences_are_encoded_in_place(df, tokenizer):
    texts = df.where("text is not null")
    assert encode_words(wd.word_frequency(texts), tokenizer).where("token_ids is null").count() == 0
    got = occurrence_ids(wd.word_positions(texts, "id"), tokenizer).collect()
    assert len(got) == sum(len(brute.words(t)) for t in TEXTS if t)
    for row in got:
        assert row.word == brute.words(TEXTS[row.id])[row.pos]
        assert row.token_ids == brute.encode(MERGES, row.word)


def test_round_trip_report(df, tokenizer):
    rows = round_trip(df, tokenizer, "id").collect()
    assert {r.id: r.decoded for r in rows}[3] == "the then there"


def test_text_format(spark, tokenizer, tmp_path):
    path = str(tmp_path / "tokenizer")
    tf.export_text(tokenizer, spark, path)
    loaded = tf.import_text(spark, path)
    assert loaded == tokenizer and loaded.vocab_size == 290
    single = tmp_path / "one.bpe"
    single.write_text("300\n2\n74 68\n7468 65f\n")
    assert tf.import_text(spark, str(single)).merges == ((b"t", b"h"), (b"th", b"e"))
    tf.save_merges(tokenizer, spark, str(tmp_path / "merges"))
    assert tf.load_merges(spark, str(tmp_path / "merges"), 290) == tokenizer


@pytest.mark.parametrize(
    "content, message",
    [
        ("", "Missing vocab size"),
        ("300", "Missing merge count"),
        ("300\n2\n74 68\n", "Missing merge"),
        ("300\n1\n\n", "Missing left"),
        ("300\n1\n74\n", "Missing right"),
        ("300\n1\n74 zz\n", "Invalid hex"),
        ("many\n0\n", "invalid literal"),
    ],
)
def test_broken_tokenizer_files_are_refused(content, message):
    with pytest.raises(ValueError, match=message):
        tf.parse_tokenizer(content)


def test_memory_of_encoding_does_not_grow_with_a_batch(monkeypatch):
    """Lists of words are encoded some at a time, with the same ids wherever they are cut."""
    texts = [None, [], ["the", "then"], ["x"] * 50, ["there", "naïve", "\U0001f600"], None, ["th" * 300, "the"], []]
    rules, whole = Tokenizer(MERGES).rules, []
    for kind in (pa.list_(pa.string()), pa.large_list(pa.large_string())):
        for most in (1, 40, 1 << 20):
            monkeypatch.setattr(merging, "TEXT_BLOCK", most)
            monkeypatch.setattr(merging, "BLOCK", most)
            words = pa.array([["left", "out"], *texts], kind).slice(1)
            parts = list(merging.encode_lists(words, merging.Merger(rules), sy.SPACE_ID))
            assert (len(parts) == 1) == (most > 1000)
            whole.append([ids for part in parts for ids in part.to_pylist()])
    expected = [None if t is None else brute.encode(MERGES, " ".join(t)) for t in texts]
    assert whole == [expected] * 6
