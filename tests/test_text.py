import brute
import pytest
from pyspark.sql import functions as F

from glyphmill.functions import text as tx

TEXTS = [
    "",
    "   ",
    "  two  words ",
    "a\u00a0b\u3000c\u0085d",
    "not\u001csplit\u001fhere",
    "اردو زبان میں",
    "e\u0301 café",
    "\U0001f468\u200d\U0001f469\u200d\U0001f467 family",
    "\U0001f1e9\U0001f1ea flag",
    "line\r\nbreak\rx",
    "é" * 300,
    "x" * 500,
    "x" * 501,
]


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    out = df.select(
        "id",
        tx.words("text").alias("words"),
        tx.char_count("text").alias("chars"),
        tx.word_count("text").alias("n_words"),
        tx.grapheme_count("text").alias("graphemes"),
        F.regexp_count("text", F.lit(r"\X")).alias("plain_graphemes"),
        tx.preview("text").alias("preview"),
        tx.is_blank("text").alias("blank"),
        tx.chars("text").alias("char_list"),
    )
    return {TEXTS[r.id]: r for r in out.collect()}


def test_words_split_on_unicode_white_space_only(rows):
    for text, row in rows.items():
        assert row.words == brute.words(text)
        assert row.n_words == len(row.words)
        assert row.blank == (not row.words)


def test_lengths(rows):
    for text, row in rows.items():
        assert row.chars == len(text)
        assert row.char_list == list(text)
        assert row.graphemes == row.plain_graphemes


def test_grapheme_clusters(rows):
    assert rows["e\u0301 café"].graphemes == 6
    assert rows["\U0001f468\u200d\U0001f469\u200d\U0001f467 family"].graphemes == 8
    assert rows["\U0001f1e9\U0001f1ea flag"].graphemes == 6
    assert rows["line\r\nbreak\rx"].graphemes == 12


def test_preview_goes_by_bytes_but_cuts_characters(rows):
    assert rows["é" * 300].preview == "é" * 300 + "..."
    assert rows["x" * 500].preview == "x" * 500
    assert rows["x" * 501].preview == "x" * 500 + "..."


def test_char_label(spark):
    df = spark.createDataFrame([(" ",), ("\u00a0",), ("a",)], "c string")
    labels = [r[0] for r in df.select(tx.char_label("c")).collect()]
    assert labels == ["[space:U+20]", "[space:U+A0]", "a"]


def test_hex(spark):
    df = spark.createDataFrame([("c3a9",), ("C3A9f",), ("",)], "h string")
    assert [bytes(r[0]) for r in df.select(tx.from_hex("h")).collect()] == [
        b"\xc3\xa9",
        b"\xc3\xa9",
        b"",
    ]
    bad = spark.createDataFrame([("zz",)], "h string").select(tx.from_hex("h"))
    with pytest.raises(Exception, match="Invalid hex"):
        bad.collect()


def test_lossy_utf8_replaces_maximal_parts(spark):
    data = [b"ok", b"\xc3", b"a\xe2\x82b", b"\xff\xfe", b"\xf0\x9f\x98", b"\xed\xa0\x80", b"\xc0\xaf"]
    df = spark.createDataFrame([(bytearray(d),) for d in data], "b binary")
    got = [r[0] for r in df.select(tx.lossy_utf8("b")).collect()]
    assert got == [d.decode("utf-8", "replace") for d in data]


def test_percent_of_nothing_is_null(spark):
    assert spark.range(1).select(tx.percent(F.lit(0), F.lit(0))).first()[0] is None
