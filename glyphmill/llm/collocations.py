"""Phrase collocations from weighted acyclic automata.

A task turns each shard of text into sorted n-grams and these into automata, one per prefix range: a
path spells an n-gram word by word and the weights met give its count; states from which
the same words go on with the same weights are one. The automata of a range meet in one task, whose
union adds up weights, and every phrase counted often enough leaves with the weight of its prefix. The
weight of a phrase's other part is found by composing phrases with the counts again, on the words they
share.
"""

from __future__ import annotations

import io
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from glyphmill.llm.plan import small_batches, small_side, stored
from glyphmill.llm.tokens import Words, mix, runs, signed, slices

#: A phrase occurs at least so often.
LEAST = 10
#: A phrase goes if a longer one around it has this percentage of its occurrences.
COVERED = 50
#: Phrases returned for each language.
FIRST = 2000
#: About so much text is one shard, whose n-grams are sorted together; a longer text is one of its own.
SHARD_BYTES = 8 << 20
#: About so much text gives the n-grams of one prefix range.
RANGE_BYTES = 16 << 20
#: A task writes automata for at most so many ranges at a time; more are reached by steps.
FAN_OUT = 512
#: Automata of about so many bytes are united in one task of a step.
STEP_BYTES = 64 << 20
#: Rows are dealt to so many parts before the first of each language are taken of all.
SALTS = 64

_BREAKS = np.zeros(256, np.int64)
_BREAKS[[*b".,;:!?", *range(0x0A, 0x0E)]] = 1
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[ord("A") : ord("Z") + 1] += 32
_PLAIN[_BREAKS > 0] = 0x20


def phrase_words(texts: pa.Array) -> tuple[Words, np.ndarray]:
    """Words of lower-cased texts and the piece each word is in: breaks between words end pieces."""
    texts = texts.cast(pa.large_string()).fill_null("")
    texts = texts.take(pa.array(np.arange(len(texts))))
    _, offsets, raw = texts.buffers()
    data = np.frombuffer(raw, np.uint8) if raw else np.zeros(0, np.uint8)
    plain = pa.py_buffer(_PLAIN[data].tobytes())
    words = Words(pa.Array.from_buffers(pa.large_string(), len(texts), [None, offsets, plain]))
    breaks = np.concatenate([np.cumsum(_BREAKS[data]), [0]])
    return words, breaks[words.starts] + words.doc


def summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the weights of each added up."""
    if not len(keys):
        return keys, weights
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(weights[order], first)


def _within(sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


class Counts:
    """Counts of two- and three-word phrases, sorted.

    ``labels`` are the distinct word ids in order; a phrase's words are places in it. Pair ``p`` is
    ``first[p] second[p]`` with count ``weight[p]``; ``owner`` tells which pair a longer phrase begins
    with, ``third`` its last word and ``longer`` its count.
    """

    def __init__(self, labels, first, second, weight, owner, third, longer):
        self.labels, self.first, self.second, self.weight = labels, first, second, weight
        self.owner, self.third, self.longer = owner, third, longer

    @classmethod
    def of_words(cls, ids: np.ndarray, piece: np.ndarray) -> Counts:
        """From the word ids of texts in order; phrases do not leave their piece."""
        labels, place = np.unique(ids, return_inverse=True)
        n, v = len(ids), max(len(labels), 1)
        place = place.astype(np.int64)
        two = np.flatnonzero(piece[: n - 1] == piece[1:n]) if n > 1 else np.zeros(0, np.int64)
        pairs, inverse, weight = np.unique(place[two] * v + place[two + 1], return_inverse=True, return_counts=True)
        pair_at = np.full(n + 1, -1, np.int64)
        pair_at[two] = inverse
        three = two[piece[two] == piece[np.minimum(two + 2, n - 1)]] if n > 2 else np.zeros(0, np.int64)
        three = three[three + 2 < n]
        longer, counts = np.unique(pair_at[three] * v + place[three + 2], return_counts=True)
        return cls(labels, pairs // v, pairs % v, weight.astype(np.int64), longer // v, longer % v, counts.astype(np.int64))

    @classmethod
    def union(cls, parts: list[Counts]) -> Counts:
        """All phrases of the parts; the counts of a phrase are added up."""
        labels = np.unique(np.concatenate([p.labels for p in parts]))
        v = max(len(labels), 1)
        pair_keys, longer_owner, longer_third = [], [], []
        for p in parts:
            place = np.searchsorted(labels, p.labels)
            keys = place[p.first] * v + place[p.second]
            pair_keys.append(keys)
            longer_owner.append(keys[p.owner])
            longer_third.append(place[p.third])
        keys, weight = summed(np.concatenate(pair_keys), np.concatenate([p.weight for p in parts]))
        owner = np.searchsorted(keys, np.concatenate(longer_owner))
        longer, counts = summed(owner * v + np.concatenate(longer_third), np.concatenate([p.longer for p in parts]))
        return cls(labels, keys // v, keys % v, weight, longer // v, longer % v, counts)

    def range_of(self, ranges: int) -> np.ndarray:
        """The prefix range of each pair, out of ``ranges``: equal prefixes share one."""
        code = mix(self.labels[self.first] * np.uint64(0x9E3779B97F4A7C15) + mix(self.labels[self.second]))
        return ((code >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)

    def parts(self, ranges: int) -> Iterator[tuple[int, Counts]]:
        """The counts of each prefix range that has any."""
        at = self.range_of(ranges)
        order = np.argsort(at, kind="stable")
        place = np.zeros(len(order), np.int64)
        place[order] = np.arange(len(order))
        owner = place[self.owner]
        arcs = np.argsort(owner, kind="stable")
        owner, third, longer = owner[arcs], self.third[arcs], self.longer[arcs]
        at, first, second, weight = at[order], self.first[order], self.second[order], self.weight[order]
        starts = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1]) if len(at) else np.zeros(0, np.int64)
        stops = np.append(starts[1:], len(at))[: len(starts)]
        for s, e, a, b in zip(starts, stops, *np.searchsorted(owner, [starts, stops])):
            used, where = np.unique(np.concatenate([first[s:e], second[s:e], third[a:b]]), return_inverse=True)
            n = e - s
            yield int(at[s]), Counts(self.labels[used], where[:n], where[n : 2 * n], weight[s:e], owner[a:b] - s, where[2 * n :], longer[a:b])


class Automaton:
    """Counts as an acyclic automaton: word, word, word, with a count after the second and third.

    The states after two words are numbered; those with the same arcs are one state, and state
    0 has none.
    """

    @staticmethod
    def states(counts: Counts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The state after each pair, the size of each state, and the number of its first arc."""
        n = len(counts.first)
        sizes = np.bincount(counts.owner, minlength=n)
        starts = np.cumsum(sizes) - sizes
        arcs = mix(counts.third.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mix(counts.longer.astype(np.uint64)))
        total = np.zeros(len(arcs) + 1, np.uint64)
        np.cumsum(arcs, out=total[1:])
        marks = total[starts + sizes] - total[starts] + mix(sizes.astype(np.uint64))
        _, like, group = np.unique(marks, return_index=True, return_inverse=True)
        like = like[group]
        # Equal marks are only likely to be equal states: the arcs decide.
        same = sizes == sizes[like]
        places = _within(np.where(same, sizes, 0))
        owner = np.repeat(np.arange(n), np.where(same, sizes, 0))
        mine, other = starts[owner] + places, starts[like[owner]] + places
        differs = (counts.third[mine] != counts.third[other]) | (counts.longer[mine] != counts.longer[other])
        same[owner[differs]] = False
        kept = np.where(same, like, np.arange(n))
        own = np.flatnonzero((kept == np.arange(n)) & (sizes > 0))
        number = np.zeros(n, np.int64)
        number[own] = np.arange(1, len(own) + 1)
        return np.where(sizes > 0, number[kept], 0), np.concatenate([[0], sizes[own]]), np.concatenate([[0], starts[own]])

    @classmethod
    def pack(cls, counts: Counts) -> bytes:
        """The automaton of the counts as compressed bytes."""
        state, sizes, starts = cls.states(counts)
        arcs = np.repeat(starts, sizes) + _within(sizes)
        # States are numbered as pairs come to them, so the first way to a state needs no number.
        first = np.zeros(len(state), bool)
        first[np.unique(state, return_index=True)[1]] = True
        way = np.where(first & (state > 0), 0, state + 1)
        # Pairs are in order, so the first word is told by how many pairs it begins.
        arrays = [counts.labels, np.bincount(counts.first, minlength=len(counts.labels)), counts.second, counts.weight]
        arrays += [way, sizes, counts.third[arcs], counts.longer[arcs]]
        out = io.BytesIO()
        for a in arrays:
            most = int(a.max()) if len(a) else 0
            width = next(w for w in (1, 2, 3, 4, 5, 6, 7, 8) if most < 1 << 8 * w)
            out.write(np.array([len(a), width], "<i8").tobytes())
            # All lowest bytes, then all next ones: like stands with like.
            out.write(a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes())
        data = out.getvalue()
        return np.array([len(data)], "<i8").tobytes() + pa.compress(data, codec="zstd", asbytes=True)

    @staticmethod
    def unpack(packed: bytes) -> Counts:
        """The counts an automaton gives, read along all its paths."""
        data = pa.decompress(packed[8:], int(np.frombuffer(packed, "<i8", 1)[0]), codec="zstd", asbytes=True)
        arrays, at = [], 0
        for _ in range(8):
            n, width = map(int, np.frombuffer(data, "<i8", 2, at))
            wide = np.zeros((n, 8), np.uint8)
            wide[:, :width] = np.frombuffer(data, np.uint8, n * width, at + 16).reshape(width, n).T
            arrays.append(wide.reshape(-1).view("<u8" if not arrays else "<i8"))
            at += 16 + n * width
        labels, begins, second, weight, way, sizes, third, longer = arrays
        state = np.where(way == 0, np.cumsum(way == 0), way - 1)
        starts = np.cumsum(sizes) - sizes
        each = sizes[state]
        arcs = np.repeat(starts[state], each) + _within(each)
        return Counts(labels, np.repeat(np.arange(len(labels)), begins), second, weight, np.repeat(np.arange(len(state)), each), third[arcs], longer[arcs])


def _packed_rows(parts: Iterator[tuple[int, Counts]]) -> dict[str, pa.Array]:
    rows = [(r, Automaton.pack(c)) for r, c in parts]
    return {"range": pa.array([r for r, _ in rows], pa.int64()), "packed": pa.array([x for _, x in rows], pa.binary())}


def _word_ids(texts: pa.Array, langs: pa.Array) -> tuple[Words, np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Words and pieces of texts, each word's 64-bit id, the languages and each word's place among them."""
    words, piece = phrase_words(texts)
    langs = langs.dictionary_encode()
    lang = langs.indices.to_numpy().astype(np.int64)[words.doc]
    ids = mix(words.ids() + np.array([*_lang_salts(langs.dictionary), 0], np.uint64)[lang])
    return words, piece, ids, langs.dictionary, lang


def _sharded(ranges: int, shard_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Texts to the automata of each prefix range, shard by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, pieces, size, last = [], [], 0, 0

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(_packed_rows(Counts.of_words(np.concatenate(ids), np.concatenate(pieces)).parts(ranges)))

        for part in slices(batches):
            words, piece, own, _, _ = _word_ids(part.column(0), part.column(1))
            ids.append(own)
            pieces.append(piece + last)
            last += int(piece[-1]) + 1 if len(piece) else 0
            size += len(words.data)
            if size >= shard_bytes:
                yield rows()
                ids, pieces, size, last = [], [], 0, 0
        if size:
            yield rows()

    return run


_WORDS = pa.schema([("id", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])


def _counted_words(shard_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Texts to the words of each language with their counts, shard by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0

        def rows() -> pa.RecordBatch:
            ids, n = (np.concatenate([x[k] for x in found]) for k in (0, 1))
            _, first, inverse = np.unique(ids, return_index=True, return_inverse=True)
            total = np.zeros(len(first), np.int64)
            np.add.at(total, inverse, n)
            lang, word = (pa.concat_arrays([x[k] for x in found]).take(pa.array(first)) for k in (2, 3))
            return pa.RecordBatch.from_arrays([pa.array(signed(ids[first])), lang, word, pa.array(total)], schema=_WORDS)

        for part in slices(batches):
            words, _, ids, langs, lang = _word_ids(part.column(0), part.column(1))
            distinct, first, n = np.unique(ids, return_index=True, return_counts=True)
            found.append((distinct, n.astype(np.int64), langs.take(pa.array(lang[first])).cast(pa.string()), words.texts(first).cast(pa.string())))
            size += len(words.data)
            if size >= shard_bytes:
                yield rows()
                found, size = [], 0
        if size:
            yield rows()

    return run


def _lang_salts(langs: pa.Array) -> np.ndarray:
    """A 64-bit number for each language, by its bytes."""
    out = []
    for lang in langs.to_pylist():
        codes = np.frombuffer(lang.encode("utf-8"), np.uint8).astype(np.uint64) + np.uint64(1)
        out.append(runs(codes, len(codes), np.zeros(len(codes), np.int64), 11)[0][0] if len(codes) else np.uint64(11))
    return np.array(out, np.uint64)


def _united(ranges: int) -> Callable[[pa.Table], pa.Table]:
    """Automata that meet in a step to those of finer prefix ranges."""

    def run(table: pa.Table) -> pa.Table:
        union = Counts.union([Automaton.unpack(x) for x in table.column("packed").to_pylist()])
        return pa.table(_packed_rows(union.parts(ranges)))

    return run


_PHRASES = "w1 long, w2 long, w3 long, a long, head long, longest long"


def _often(least: int) -> Callable[[pa.Table], pa.Table]:
    """All automata of a range to its phrases of ``least`` or more occurrences.

    Of three words: with the count of the first two. Of two: with the largest count of a
    phrase that goes on from them.
    """

    def run(table: pa.Table) -> pa.Table:
        c = Counts.union([Automaton.unpack(x) for x in table.column("packed").to_pylist()])
        most = np.zeros(len(c.first), np.int64)
        pair, long = np.flatnonzero(c.weight >= least), np.flatnonzero(c.longer >= least)
        owner = c.owner[long]
        np.maximum.at(most, owner, c.longer[long])
        name = lambda *places: pa.array(signed(c.labels[np.concatenate(places)]))
        third = pa.concat_arrays([pa.nulls(len(pair), pa.int64()), pa.array(signed(c.labels[c.third[long]]))])
        return pa.table(
            {
                "w1": name(c.first[pair], c.first[owner]),
                "w2": name(c.second[pair], c.second[owner]),
                "w3": third,
                "a": pa.array(np.concatenate([c.weight[pair], c.longer[long]])),
                "head": pa.concat_arrays([pa.nulls(len(pair), pa.int64()), pa.array(c.weight[owner])]),
                "longest": pa.concat_arrays([pa.array(most[pair]), pa.nulls(len(long), pa.int64())]),
            }
        )

    return run


def _narrowed(automata: DataFrame, ranges: int, coarse: int, fan_out: int) -> DataFrame:
    """Automata of ``coarse`` ranges, united in bounded groups and written for finer ones.

    A range's automata meet in groups of about STEP_BYTES, so neither the automata of a
    range nor the ranges of an automaton ever come together in one task.
    """
    if coarse < ranges:
        automata = stored(automata, "shard-automata")
    while coarse < ranges:
        finer = min(ranges, coarse * fan_out)
        sized = automata.groupBy("range").agg(F.sum(F.octet_length("packed")).alias("bytes"))
        grouped = automata.join(sized, "range").select(
            "range", "packed", F.pmod(F.xxhash64("packed"), F.ceil(F.col("bytes") / STEP_BYTES)).alias("deal")
        )
        automata = stored(grouped.groupBy("range", "deal").applyInArrow(_united(finer), "range long, packed binary"), "automata")
        coarse = finer
    return automata


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, first: int = FIRST,
    range_bytes: int = RANGE_BYTES, fan_out: int = FAN_OUT, shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the best phrases of two and three words of each language.

    ``a`` counts the phrase, ``l`` and ``r`` the two parts of its lowest-scoring cut and ``n`` all words
    of the language; the score is ``floor(1000000 * a * a / (l * r))``. A phrase that a longer phrase
    with at least half its occurrences holds is left out. A null language is ``und``, a null
    text empty; repeated rows count as often as they stand there. Other columns, whatever their names,
    are not read. An empty table, or one without a frequent phrase, gives an empty one.

    Word ids are 64-bit hashes of language and word.
    """
    rows = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"), F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("lang"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    ranges = max(1, math.ceil(size / range_bytes))
    coarse = min(ranges, fan_out)
    rows = small_batches(rows)
    words = stored(
        rows.mapInArrow(_counted_words(shard_bytes), "id long, lang string, word string, n long")
        .groupBy("id", "lang", "word")
        .agg(F.sum("n").alias("n")),
        "phrase-words",
    )
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    automata = _narrowed(rows.mapInArrow(_sharded(coarse, shard_bytes), "range long, packed binary"), ranges, coarse, fan_out)
    phrases = stored(automata.groupBy("range").applyInArrow(_often(least), _PHRASES), "phrases")

    # A longer phrase composed with the counts of pairs, on its last two words: the count of these, and
    # the other way round the largest count of a phrase that ends in a pair.
    longer = phrases.where("w3 IS NOT NULL").drop("longest")
    pairs = phrases.where("w3 IS NULL").select("w1", "w2", "a", "longest")
    tails = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("tail"))
    endings = longer.groupBy(F.col("w2").alias("w1"), F.col("w3").alias("w2")).agg(F.max("a").alias("ending"))
    kept = pairs.join(endings, ["w1", "w2"], "left").where(
        100 * F.greatest("longest", F.coalesce("ending", F.lit(0))) < COVERED * F.col("a")
    )
    none = F.lit(None).cast("bigint")
    phrase_rows = longer.join(tails, ["w2", "w3"]).select("w1", "w2", "w3", "a", "head", "tail")
    phrase_rows = phrase_rows.unionByName(kept.select("w1", "w2", none.alias("w3"), "a", none.alias("head"), none.alias("tail")))
    often = small_side(stored(words.where(F.col("n") >= least), "frequent-words"))
    for name in ("w1", "w2", "w3"):
        side = often.select(
            F.col("id").alias(name), F.col("word").alias(f"word_{name}"), F.col("n").alias(f"n_{name}"),
            *([F.col("lang")] if name == "w1" else []),
        )
        phrase_rows = phrase_rows.join(side, name, "left" if name == "w3" else "inner")

    def scored(l: str, r: str):  # noqa: E741
        exact = lambda c: f"cast({c} AS decimal(19, 0))"
        ways = f"(cast({exact('a')} * {exact('a')} AS decimal(31, 0)) * cast(1000000 AS decimal(7, 0))) div ({exact(l)} * {exact(r)})"
        return F.expr(f"struct({ways} AS score, {l} AS l, {r} AS r)")

    short, first_cut, second_cut = scored("n_w1", "n_w2"), scored("n_w1", "tail"), scored("head", "n_w3")
    lowest = F.when(F.col("w3").isNull(), short).when(second_cut["score"] < first_cut["score"], second_cut).otherwise(first_cut)
    scored_rows = phrase_rows.select(
        "lang", F.concat_ws(" ", "word_w1", "word_w2", "word_w3").alias("phrase"), "a", lowest.alias("cut")
    ).select("lang", "phrase", "a", "cut.*")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    best = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    some = scored_rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).withColumn("rank", best("lang", "salt"))
    ranked = some.where(F.col("rank") <= first).withColumn("rank", best("lang").cast("bigint")).where(F.col("rank") <= first)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = rf"""
WITH docs AS (
    SELECT coalesce(lang, 'und') AS lang,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs),
split AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
ones AS (SELECT lang, word, count(*) AS f FROM (SELECT lang, unnest(w) AS word FROM split) GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM ones GROUP BY ALL),
twos AS (
    SELECT lang, x[1] AS w1, x[2] AS w2, count(*) AS f FROM (
        SELECT lang, unnest(list_transform(range(1, len(w)::BIGINT), lambda i: [w[i], w[i + 1]])) AS x
        FROM split WHERE len(w) > 1) GROUP BY ALL),
threes AS (
    SELECT lang, x[1] AS w1, x[2] AS w2, x[3] AS w3, count(*) AS f FROM (
        SELECT lang, unnest(list_transform(range(1, len(w)::BIGINT - 1), lambda i: [w[i], w[i + 1], w[i + 2]])) AS x
        FROM split WHERE len(w) > 2) GROUP BY ALL HAVING f >= {LEAST}),
held AS (
    SELECT lang, w1, w2, max(f) AS f FROM (
        SELECT lang, w1, w2, f FROM threes UNION ALL SELECT lang, w2, w3, f FROM threes) GROUP BY ALL),
cuts AS (
    SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, t.f AS a, 1 AS k, x.f AS l, y.f AS r FROM twos t
    JOIN ones x ON x.lang = t.lang AND x.word = t.w1 JOIN ones y ON y.lang = t.lang AND y.word = t.w2
    LEFT JOIN held h ON h.lang = t.lang AND h.w1 = t.w1 AND h.w2 = t.w2
    WHERE t.f >= {LEAST} AND NOT coalesce(100 * h.f >= {COVERED} * t.f, false)
    UNION ALL
    SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 1, x.f, y.f FROM threes t
    JOIN ones x ON x.lang = t.lang AND x.word = t.w1 JOIN twos y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
    UNION ALL
    SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 2, x.f, y.f FROM threes t
    JOIN twos x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2 JOIN ones y ON y.lang = t.lang AND y.word = t.w3),
scored AS (SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cuts),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM lowest)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {FIRST}
"""
