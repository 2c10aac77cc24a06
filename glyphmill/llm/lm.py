"""Scoring texts with a weighted backoff automaton.

The model is a smoothed bigram model over the training documents. Every word of the vocabulary
is a state; an arc for each bigram carries its log-probability, and a failure arc leads
to the empty state, where every word has an arc, at the cost of a backoff weight that follows
from how often the state itself was left. A text goes through once from left to right, carrying the state and adding up the arcs it takes.

The automaton grows with the corpus, so it is never in one place. Documents are dealt to blocks;
each block asks for the arcs its own texts can take, the counts are summed where all requests
for one n-gram meet, and the answers, the block's slice of the automaton, are joined to its texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from glyphmill.llm.plan import small_batches
from glyphmill.llm.tokens import Words, mix, signed, slices

#: Held out: documents whose crc32(key as text) has this remainder.
FOLDS, HELD_OUT = 7, 2
#: A bigram is an arc from this count on; with 1, what may follow a state sums to one.
MIN_COUNT = 1
#: A state's own arcs weigh ``OWN_WEIGHT * c / (c + OWN_PRIOR)`` if it was left ``c`` times in training;
#: its failure arc has the rest, so a state seldom seen nearly always falls back.
OWN_WEIGHT, OWN_PRIOR = 0.4, 3.0
#: Characters of a block, about.
BLOCK_CHARS = 12_000_000
_END = np.uint64(0xE0D)
_NEXT = np.uint64(0x9E3779B97F4A7C15)


def held_out(key: Column) -> Column:
    """Whether a document is kept from training; a null key is not."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of the texts, each closed by the end token, and how many each text has."""
    ids, sizes = [], []
    for batch in slices(iter([pa.RecordBatch.from_arrays([column], names=["text"])])):
        words = Words(batch.column(0), lower=True)
        ids.append(np.insert(words.ids(), words.first[1:], _END))
        sizes.append(np.diff(words.first) + 1)
    if not ids:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(ids), np.concatenate(sizes)


def _bigrams(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of neighbours within a text, and the place of the second of each."""
    inside = np.ones(len(ids), bool)
    inside[np.cumsum(sizes) - sizes] = False
    at = np.flatnonzero(inside)
    return mix(ids[at - 1] * _NEXT + ids[at]), at


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(id, n)`` of the tokens of each batch."""
    for batch in batches:
        ids, n = np.unique(_tokens(batch.column(0))[0], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(signed(ids)), pa.array(n)], names=["id", "n"])


def training_totals(docs: DataFrame, text: str, train: Column) -> dict[str, float]:
    """Tokens, distinct tokens, and how many tokens occur once and twice, of the training texts."""
    counts = (
        docs.where(train)
        .select(F.coalesce(F.col(text), F.lit("")).alias("text"))
        .mapInArrow(_counted, "id bigint, n bigint")
        .groupBy("id")
        .agg(F.sum("n").alias("n"))
    )
    row = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"),
        F.count("*").alias("types"),
        F.count(F.when(F.col("n") == 1, 1)).alias("once"),
        F.count(F.when(F.col("n") == 2, 1)).alias("twice"),
    ).first()
    return row.asDict()


_REQUESTS = "bucket bigint, block bigint, words array<bigint>, word_n array<int>, pairs array<bigint>, pair_n array<int>"
# Totals are 64 bits in two halves: the upper one is nearly always 0 and takes no room in an exchange.
_ANSWERS = "bucket bigint, block bigint, word_n array<int>, word_up array<int>, pair_n array<int>, pair_up array<int>"


class _Grams:
    """The distinct n-grams of a block in the order of its requests: by bucket, count, then id.

    The order is a function of the block's texts, so answers need not repeat the ids; and as
    equal counts lie together, counts take next to no room in an exchange.
    """

    def __init__(self, ids: np.ndarray, weight: np.ndarray, buckets: int):
        values, inverse = np.unique(ids, return_inverse=True)
        counts = np.bincount(inverse, weights=weight, minlength=len(values)).astype(np.int32)
        bucket = (values % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((values, counts, bucket))
        self.ids, self.counts = values[order], counts[order]
        self.cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))

    def lists(self, values: np.ndarray, chosen: np.ndarray, kind: pa.DataType) -> pa.Array:
        """One list per chosen bucket; buckets that were not chosen have none of the values."""
        ends = np.append(self.cuts[chosen], len(values)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, kind))


def _grams(table: pa.Table, buckets: int):
    """Tokens of a block's texts, and its words and pairs with their training counts."""
    table = table.combine_chunks()
    column = table.column("text").chunk(0) if table.num_rows else pa.array([], pa.string())
    ids, sizes = _tokens(column)
    train = np.repeat(~table.column("held_out").to_numpy(), sizes)
    pairs, at = _bigrams(ids, sizes)
    return ids, sizes, _Grams(ids, train, buckets), _Grams(pairs, train[at], buckets)


def _requests(buckets: int):
    """A block's n-grams with their training counts, as one packed row per bucket of ids."""

    def run(table: pa.Table) -> pa.Table:
        _, _, words, pairs = _grams(table, buckets)
        chosen = np.flatnonzero((np.diff(words.cuts) > 0) | (np.diff(pairs.cuts) > 0))
        return pa.Table.from_arrays(
            [
                pa.array(chosen, pa.int64()),
                pa.array(np.full(len(chosen), table.column("block")[0].as_py()), pa.int64()),
                words.lists(signed(words.ids), chosen, pa.int64()),
                words.lists(words.counts, chosen, pa.int32()),
                pairs.lists(signed(pairs.ids), chosen, pa.int64()),
                pairs.lists(pairs.counts, chosen, pa.int32()),
            ],
            names=["bucket", "block", "words", "word_n", "pairs", "pair_n"],
        )

    return run


def _flat(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)


def _answers(min_count: int):
    """All blocks' requests for a bucket of n-grams, answered with totals in the order asked.

    A total below ``min_count`` (1 for words) is 0: not in the model.
    """

    def run(table: pa.Table) -> pa.Table:
        columns = [table.column(x).combine_chunks() for x in ("bucket", "block")]
        for name, n, least in (("words", "word_n", 1), ("pairs", "pair_n", min_count)):
            ids, counts = _flat(table, name), _flat(table, n)
            values, inverse = np.unique(ids, return_inverse=True)
            total = np.bincount(inverse, weights=counts, minlength=len(values)).astype(np.int64)
            total = np.where(total >= least, total, 0)[inverse]
            sizes = pc.list_value_length(table.column(name).combine_chunks()).to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            for half in (total.astype(np.uint32).view(np.int32), (total >> 32).astype(np.int32)):
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(half)))
        return pa.Table.from_arrays(columns, names=["bucket", "block", "word_n", "word_up", "pair_n", "pair_up"])

    return run


def _totals(answers: pa.Table, name: str) -> np.ndarray:
    low, up = _flat(answers, f"{name}_n"), _flat(answers, f"{name}_up")
    return low.astype(np.int32).view(np.uint32).astype(np.int64) + (up.astype(np.int64) << 32)


class Automaton:
    """A block's slice of the automaton: word arcs of the empty state, and bigram arcs."""

    def __init__(self, words: tuple, pairs: tuple, totals: dict[str, float], own_weight: float, own_prior: float):
        """``words`` and ``pairs`` are ids with their training counts."""
        (self.words, self.word_n), (self.pairs, self.pair_n) = self._sorted(*words), self._sorted(*pairs)
        self.totals, self.own_weight, self.own_prior = totals, own_weight, own_prior
        tokens, types = max(totals["tokens"], 1), max(totals["types"], 1)
        # Absolute discounting; what it frees is the unknown token's.
        spread = totals["once"] + 2 * totals["twice"]
        self.discount = min(max(totals["once"] / spread if spread else 0.5, 0.05), 0.95)
        self.tokens, self.unknown = tokens, self.discount * types / tokens if totals["tokens"] else 1.0

    @staticmethod
    def _sorted(ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids, n = ids[n > 0], n[n > 0].astype(np.int64)
        order = np.argsort(ids)
        return ids[order], n[order]

    @staticmethod
    def _find(ids: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(len(ids), np.int64)
        at = np.minimum(np.searchsorted(keys, ids), len(keys) - 1)
        return np.where(keys[at] == ids, counts[at], 0)

    def traverse(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per token its training count and the log10 weight of the arcs taken, all texts in step.

        The state before a token is the word before it if that is a state, else the empty one.
        From a word's state the token's own arc is taken if there is one, else the failure arc and
        the empty state's arc. An arc of a word's state has the interpolated probability.
        """
        known = self._find(ids, self.words, self.word_n)
        share = self.own_weight * known / (known + self.own_prior)
        low = np.where(known > 0, (known - self.discount) / self.tokens, self.unknown)
        pairs, at = _bigrams(ids, sizes)
        context = known[at - 1]
        arcs = self._find(pairs, self.pairs, self.pair_n)
        weight = low.copy()
        state = context > 0
        failed = state & (arcs == 0)
        weight[at[failed]] *= 1 - share[at[failed] - 1]
        taken = state & (arcs > 0)
        own, state_share = arcs[taken] / context[taken], share[at[taken] - 1]
        weight[at[taken]] = state_share * own + (1 - state_share) * low[at[taken]]
        return known, np.log10(weight)


def _scores(totals: dict[str, float], own_weight: float, own_prior: float, buckets: int):
    floor = math.log10(totals["tokens"] + totals["types"] + 1)

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        ids, sizes, words, pairs = _grams(texts, buckets)
        answers = answers.sort_by("bucket")
        counted = (words.ids, _totals(answers, "word")), (pairs.ids, _totals(answers, "pair"))
        arcs = Automaton(*counted, totals, own_weight, own_prior)
        known, weight = arcs.traverse(ids, sizes)
        starts = np.cumsum(sizes) - sizes
        add = lambda x: np.add.reduceat(x, starts) if len(starts) else np.zeros(0)
        return pa.Table.from_arrays(
            [
                texts.column("key"),
                texts.column("held_out"),
                pa.array(sizes.astype(np.int64)),
                pa.array(add((known > 0).astype(np.int64)).astype(np.int64)),
                pa.array(add(np.log10(known + 1.0)) - sizes * floor),
                pa.array(add(weight).astype(float)),
            ],
            names=["key", "held_out", "n_tokens", "n_known", "base_score", "score"],
        )

    return run


def scored(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_count: int = MIN_COUNT,
    own_weight: float = OWN_WEIGHT,
    own_prior: float = OWN_PRIOR,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``(key, held_out, n_tokens, n_known, train_tokens, base_score, score)`` per row of ``docs``.

    Scores are log10 probabilities. ``base_score`` is the add-one unigram model. A null or empty
    text is the end token alone; a null key trains; repeated rows count and score each. Without
    training texts every token is unknown. ``own_prior`` is above 0. Arcs below ``min_count`` are left out of the model; above 1,
    a state's arcs sum to less than one.
    """
    rows = small_batches(docs).select(
        F.col(key).alias("key"), held_out(F.col(key)).alias("held_out"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    key_type = rows.schema["key"].dataType.simpleString()
    totals = training_totals(rows, "text", ~F.col("held_out"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(least, math.ceil(chars / block_chars))
    # Repeated keys are dealt apart by their text.
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("key", "text"), F.lit(blocks)))
    requests = dealt.groupBy("block").applyInArrow(_requests(blocks), _REQUESTS)
    answers = requests.groupBy("bucket").applyInArrow(_answers(min_count), _ANSWERS)
    out = (
        dealt.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(
            _scores(totals, own_weight, own_prior, blocks),
            f"key {key_type}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double",
        )
    )
    return out.select(
        F.col("key").alias(key), "held_out", "n_tokens", "n_known", F.lit(totals["tokens"]).cast("bigint").alias("train_tokens"), "base_score", "score"
    )


def query(spark, sf_dir: str) -> DataFrame:
    return scored(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
