"""Automata against plain counts, and phrases against the contract read literally."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from glyphmill.llm import collocations as co
from hypothesis import given, settings, strategies as st


def words_of(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall("[^\x20\x09]+", piece) for piece in re.split("[.,;:!?\x0a-\x0d]", text)]


def restated(rows, least=10, first=2000):
    """``rows`` of text and language to the rows of the result."""
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in words_of(text):
            totals[lang] += len(piece)
            for n in (1, 2, 3):
                for i in range(len(piece) - n + 1):
                    counts[lang][tuple(piece[i : i + n])] += 1
    out = []
    for lang, f in counts.items():
        found = []
        for phrase, a in f.items():
            if len(phrase) == 1 or a < least:
                continue
            longer = [b for other, b in f.items() if len(other) > len(phrase) and b >= least and phrase in (other[:2], other[1:])]
            if any(100 * b >= 50 * a for b in longer):
                continue
            cuts = [(1000000 * a * a // (f[phrase[:k]] * f[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(phrase).encode(), f[phrase[:k]], f[phrase[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:first], 1):  # noqa: E741
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


texts_of = st.lists(st.text(alphabet="ab éÀB.,\n\x0b\t!", max_size=40), min_size=1, max_size=8)


@settings(max_examples=300, deadline=None)
@given(texts_of)
def test_words_and_pieces(texts):
    words, piece = co.phrase_words(pa.array([None, *texts], pa.string()))
    got = defaultdict(list)
    for word, p, doc in zip(words.texts(np.arange(len(words.starts))).to_pylist(), piece, words.doc):
        got[int(doc), int(p)].append(word)
    want = [[p for p in words_of(t) if p] for t in [None, *texts]]
    by_doc = defaultdict(list)
    for (doc, _), found in sorted(got.items()):
        by_doc[doc].append(found)
    assert [by_doc[i] for i in range(len(want))] == want


def plain(counts):
    name = counts.labels.tolist()
    pairs = {(name[a], name[b]): int(n) for a, b, n in zip(counts.first, counts.second, counts.weight)}
    starts = [(name[a], name[b]) for a, b in zip(counts.first, counts.second)]
    return pairs, {(*starts[o], name[c]): int(n) for o, c, n in zip(counts.owner, counts.third, counts.longer)}


sequences = st.lists(st.lists(st.integers(1, 4), max_size=12), min_size=1, max_size=6)


@settings(max_examples=300, deadline=None)
@given(st.lists(sequences, min_size=1, max_size=4), st.integers(1, 5))
def test_automata(shards, ranges):
    """Packed, dealt to ranges, united: the counts stay, and equal states are one."""
    pairs, longer, parts = Counter(), Counter(), defaultdict(list)
    for shard in shards:
        for s in shard:
            pairs.update(zip(s, s[1:]))
            longer.update(zip(s, s[1:], s[2:]))
        ids = np.array([x for s in shard for x in s], np.uint64)
        piece = np.repeat(np.arange(len(shard)), [len(s) for s in shard])
        for r, c in co.Counts.of_words(ids, piece).parts(ranges):
            parts[r].append(co.Automaton.unpack(co.Automaton.pack(c)))
    got_pairs, got_longer = {}, {}
    for r, found in parts.items():
        union = co.Counts.union(found)
        assert set(union.range_of(ranges)) <= {r}
        state, sizes, _ = co.Automaton.states(union)
        assert len(set(state[state > 0])) == len(sizes) - 1
        going_on = defaultdict(set)
        for o, c, n in zip(union.owner, union.third, union.longer):
            going_on[int(o)].add((int(c), int(n)))
        assert len({frozenset(x) for x in going_on.values()}) == len(sizes) - 1
        p, q = plain(union)
        assert not p.keys() & got_pairs.keys()
        got_pairs |= p
        got_longer |= q
    assert got_pairs == pairs and got_longer == longer


def collect(df):
    return sorted(tuple(r) for r in df.collect())


def test_small_tables(spark, monkeypatch):
    rng = np.random.default_rng(5)
    vocabulary = ["new", "york", "city", "of", "the", "Über", "x\xa0y", "a\x1c"]
    rows = []
    for i in range(120):
        words = rng.choice(vocabulary, size=rng.integers(0, 40), p=[0.2, 0.2, 0.1, 0.2, 0.15, 0.05, 0.05, 0.05])
        rows.append((" ".join(w + ("." if rng.random() < 0.1 else "") for w in words), ["en", "de", None, "und", ""][i % 5]))
    rows += [("alpha beta gamma " * 2000, "long"), (None, "en"), ("", None), (" . , ", "de"), ("New York\tCITY\x0bof", "en")] + [("same text here now", "la")] * 12
    df = spark.createDataFrame([(t, lang, 1, "w", 0) for t, lang in rows], "text string, lang string, n long, word string, id long").repartition(5)
    want = restated(rows)
    assert {r[0] for r in want} >= {"en", "de", "und", "", "long", "la"}
    assert collect(co.collocations(df)) == want
    # Many ranges reached by steps of few, and bounded groups in each step.
    monkeypatch.setattr(co, "STEP_BYTES", 300)
    assert collect(co.collocations(df, range_bytes=1000, fan_out=3, shard_bytes=500, first=4)) == [r for r in want if r[1] <= 4]
    assert collect(co.collocations(df.where("false"))) == []
    assert collect(co.collocations(df, least=10**6)) == []


def test_documents(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.text, r.lang) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = restated(rows)
    assert len(want) > 100 and collect(co.query(spark, folder)) == want


def test_products_beyond_64_bits(spark):
    """Scores of counts whose products need more than 64 bits are exact."""
    a, l, r = 9_999_999_967, 10_000_000_019, 12_345_678_901  # noqa: E741
    row = spark.sql(
        "SELECT (cast(cast(a AS decimal(19, 0)) * cast(a AS decimal(19, 0)) AS decimal(31, 0)) * cast(1000000 AS decimal(7, 0)))"
        f" div (cast(l AS decimal(19, 0)) * cast(r AS decimal(19, 0))) AS score FROM VALUES ({a}L, {l}L, {r}L) AS t(a, l, r)"
    ).first()
    assert row.score == 1000000 * a * a // (l * r)
