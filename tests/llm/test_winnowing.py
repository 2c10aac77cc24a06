"""Fingerprints against a plain restatement of the windows, and the order of documents."""

import hashlib
import random

import regex
from glyphmill.llm import winnowing
from pyspark.sql import functions as F

WORD_TEXT = " ".join(f"w{i % 40}x{i % 7}" for i in range(300))
ROWS = [
    (5, WORD_TEXT),
    (5, WORD_TEXT),
    (9, None),
    (7, ""),
    (6, "short é😀 text"),
    (1, WORD_TEXT[:700] + " and some other words follow here"),
    (None, "abc"),
    (3, "aaaa aaaa aaaa"),
    (-4, "ab"),
]


def edited_texts(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for i, (key, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        third = len(text) // 3
        out.append((key, text[: len(text) - third] + after[:third]))
    return out


def test_edited_texts_and_equal_fingerprints(spark):
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in ROWS], "doc_id long, text string, bucket string, h int")
    got = winnowing.compared(docs).select("doc_id", "edited", winnowing.digest(F.col("chosen")).alias("f")).collect()
    assert sorted(map(repr, [(r.doc_id, r.edited) for r in got])) == sorted(map(repr, edited_texts(ROWS)))
    assert len({r.f for r in got if r.doc_id == 5}) == 1
    assert winnowing.compared(docs.limit(0)).count() == 0


TOKEN = regex.compile(r"[\p{Lu}\p{Lt}]?[\p{Ll}\p{M}]{1,32}|[\p{Lu}\p{Lt}]{1,32}|\p{N}{1,32}|[^\x20\x09-\x0D]")


def chosen(text):
    """The grams that a plain reading of the windows takes, given the order of their hashes."""
    tokens = TOKEN.findall(text)
    return [tuple(tokens[i : i + winnowing.GRAM]) for i in range(max(len(tokens) - winnowing.GRAM + 1, 1))]


def plain(text, order):
    grams, places = chosen(text), set()
    for s in range(max(len(grams) - winnowing.WINDOW + 1, 1)):
        part = [order[g] for g in grams[s : s + winnowing.WINDOW]]
        places.add(s + max(i for i, x in enumerate(part) if x == min(part)))
    return [(order[grams[i]], i) for i in sorted(places)]


def hashes(spark, texts):
    """Hash of every gram of the texts, from grams as this test cuts them."""
    grams = sorted({g for t in texts for g in chosen(t)})
    rows = spark.createDataFrame([(list(g),) for g in grams], "g array<string>").select("g", F.xxhash64("g").alias("h"))
    return {tuple(r.g): r.h for r in rows.collect()}


def alike(a, b, order):
    a, b = ({h for h, _ in plain(t, order)} for t in (a, b))
    return len(a & b) / len(a | b)


def test_windows_and_likeness(spark):
    """Every window's rightmost smallest hash is chosen, and nothing else; likeness follows."""
    order = sorted(ROWS, key=lambda r: (r[0] is None, -(r[0] or 0)))
    texts = [t or "" for _, t in order]
    edited = [t for _, t in edited_texts(ROWS)]
    of = hashes(spark, texts + edited)
    docs = spark.createDataFrame([(t,) for t in texts + edited], "text string")
    for r in docs.select("text", winnowing.fingerprint(F.col("text")).alias("f")).collect():
        assert [(x.h, -x.back) for x in r.f] == plain(r.text, of), r.text[:40]
    like = winnowing.likeness
    rows = winnowing.compared(spark.createDataFrame(ROWS, "doc_id long, text string")).select(
        "doc_id", "edited", like(F.col("set"), F.col("edited_set")).alias("e"), like(F.col("set"), F.col("next_set")).alias("n")
    )
    want = [
        (k, e, alike(t or "", e, of), alike(t or "", texts[(i + 1) % len(texts)], of))
        for i, ((k, t), e) in enumerate(zip(order, edited))
    ]
    assert sorted(map(repr, map(tuple, rows.collect()))) == sorted(map(repr, want))


def test_copies_of_any_length_and_script(spark):
    short = " ".join(f"word{i}" for i in range(36))[:250]
    deal = random.Random(3)
    chinese = "".join(chr(0x4E00 + deal.randrange(3000)) for _ in range(1200))
    packed = "".join(hashlib.sha256(str(i).encode()).hexdigest() for i in range(60))
    long = " ".join(f"Term{i * i % 9973} of {i}" for i in range(20_000))
    pairs = [
        (short, short + " and 13 chars"),
        (chinese, chinese[:800] + chinese[:-401:-1]),
        (packed, "x" + packed),
        (long, long[: 2 * len(long) // 3]),
        ("m" * 5_000, "m" * 5_001),
    ]
    docs = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    sets = [winnowing.hash_set(winnowing.fingerprint(F.col(c))) for c in "ab"]
    got = {r.i: r for r in docs.select("i", winnowing.likeness(*sets).alias("like"), F.size(sets[0]).alias("n")).collect()}
    assert got[0].like > 0.8 and 0.4 < got[1].like < 0.6 and got[2].like > 0.9 and 0.6 < got[3].like < 0.7
    assert got[4].like > 0 and got[1].n > 300


def test_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = {k: hashlib.sha256(t.encode()).hexdigest() for k, t in edited_texts([tuple(r) for r in rows])}
    got = winnowing.query(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: r.edited_sha256 for r in got} == want and len(got) == len(rows)
    words = {r.doc_id: len(r.text.split()) for r in rows}
    assert all(r.near_edited > 0 for r in got if words[r.doc_id] >= 12)
    assert sum(r.near_edited for r in got) > 2 * sum(r.near_next for r in got)
