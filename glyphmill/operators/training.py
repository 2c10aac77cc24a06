"""Learning BPE merges over the table of distinct words.

The state is a table in the shared folder: the distinct words as symbols, after the merges so far. A
round foresees a batch of merges on the driver, has all words take them in turn and tell how each
changes the counts of the pairs in the running, and keeps the merges that are provably the next ones of
the one-at-a-time order. While these are few, the next round foresees anew from the same look at the
counts, now with measured effects: it is one pass over the words, which are neither counted nor written
again. The driver sees a fixed number of candidate pairs per look and their
counts step by step, never words.
"""

from __future__ import annotations

from copy import deepcopy
from functools import partial

from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from glyphmill.functions import merging, symbols as sy
from glyphmill.operators.merge_batch import CANDIDATES, NEIGHBOURS, Vocabulary, confirm, effects, foresee
from glyphmill.operators.tokenizer import DEFAULT_VOCAB_SIZE, Tokenizer
from glyphmill.operators.words import symbol_table, word_frequency
from glyphmill.session import drop_folder, scratch_path

# Ships the worker code with its functions, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(merging)

ROUNDS_SCHEMA = "rank int, left string, right string, freq bigint"
# The most merges foreseen in one round. Looking far ahead pays: what is measured guides the next look.
MAX_BATCH = 512
# With so many merges confirmed from one look at the counts, words are merged and looked at again.
LOOK_AGAIN = 64


def _trigrams(symbol_rows: DataFrame) -> DataFrame:
    """``(trigram, freq)`` of the words, an edge mark after each.

    ``a b c`` says how often the pair ``a b`` is followed by ``c`` and how often ``b c``
    comes after ``a``; the edge mark stands for the end of a word. Tasks sum up before they send.
    """
    run = partial(merging.trigrams, edge=sy.EDGE)
    return symbol_rows.mapInArrow(run, "trigram string, freq long").groupBy("trigram").agg(F.sum("freq").alias("freq"))


class _Words:
    """Words as symbols, written anew after each round; a lost executor costs one step from there."""

    def __init__(self, words: DataFrame, prefix: str, done: list[str] | None = None):
        """``done`` are rules to apply first, from a training that went before."""
        self.spark, self.prefix, self.writes = words.sparkSession, prefix, 0
        partitions = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.words = self._written(words.select("freq", "symbols").repartition(partitions))
        if done:
            self.apply(done)

    def _written(self, df: DataFrame) -> DataFrame:
        """Written beside the table before, which may still be read; the one before that goes."""
        self.writes += 1
        df.write.parquet(f"{self.prefix}/words-{self.writes}")
        drop_folder(self.spark, f"{self.prefix}/words-{self.writes - 2}")
        return self.spark.read.schema(df.schema).parquet(f"{self.prefix}/words-{self.writes}")

    def apply(self, rules: list[str]) -> None:
        run = partial(merging.merged_words, rules=rules)
        self.words = self._written(self.words.mapInArrow(run, self.words.schema))

    def followed(self, rules: list[str], candidates: list, fresh: str) -> list:
        """``(pair, step, freq)``: exact counts after each step that changes them.

        Of listed pairs, and of pairs with a symbol from ``fresh`` on that reach the last listed
        count: their number is bounded by that of the candidates and of the rules, not by the corpus.
        """
        floor = candidates[-1].freq if len(candidates) == CANDIDATES else 0
        listed = self.spark.createDataFrame([(r.pair, r.freq) for r in candidates], "pair string, base long")
        run = partial(merging.changed_pairs, rules=rules, listed={r.pair for r in candidates}, fresh=fresh, edge=sy.EDGE)
        so_far = Window.partitionBy("pair").orderBy("step")
        counted = (
            self.words.mapInArrow(run, "step int, pair string, freq long")
            .groupBy("pair", "step")
            .agg(F.sum("freq").alias("freq"))
            .join(F.broadcast(listed), "pair", "left")
            .withColumn("freq", F.coalesce("base", F.lit(0)) + F.sum("freq").over(so_far))
            .withColumn("most", F.max("freq").over(Window.partitionBy("pair")))
        )
        return counted.where(F.col("base").isNotNull() | (F.col("most") >= max(floor, 1))).select("pair", "step", "freq").collect()


def _candidates(trigrams: DataFrame, token_hex: list[str]) -> list:
    """The most frequent pairs in merge order, each with its most frequent neighbours.

    Pairs of equal count are ordered by the bytes of the left, then the right token.
    """
    spark = trigrams.sparkSession
    return spark.sql(
        f"""
        SELECT pair, freq, neighbours FROM (
            SELECT pair,
                sum(freq) FILTER (WHERE after) AS freq,
                slice(sort_array(collect_list(struct(freq, after, neighbour))
                    FILTER (WHERE neighbour <> :edge), false), 1, {NEIGHBOURS}) AS neighbours
            FROM (
                SELECT freq, inline(array(
                    struct(left(trigram, 2) AS pair, right(trigram, 1) AS neighbour, true AS after),
                    struct(right(trigram, 2) AS pair, left(trigram, 1) AS neighbour, false AS after)))
                FROM {{trigrams}})
            WHERE NOT contains(pair, :edge) GROUP BY pair)
        ORDER BY freq DESC,
            get(split(:tokens, ','), {sy.symbol_index_sql("left(pair, 1)")}),
            get(split(:tokens, ','), {sy.symbol_index_sql("right(pair, 1)")})
        LIMIT {CANDIDATES}
        """,
        args={"edge": sy.EDGE, "tokens": ",".join(token_hex)},
        trigrams=trigrams,
    ).collect()


def merges_so_far(spark: SparkSession, folder: str) -> DataFrame | None:
    """``(rank, left, right, freq)`` written by a training in ``folder``, also while it runs."""
    try:
        return spark.read.schema(ROUNDS_SCHEMA).parquet(f"{folder}/rounds").orderBy("rank")
    except AnalysisException:
        return None


def learn_merges(
    word_freq: DataFrame,
    vocab_size: int = DEFAULT_VOCAB_SIZE,
    max_batch: int = MAX_BATCH,
    folder: str | None = None,
    max_rounds: int | None = None,
) -> Tokenizer:
    """Learn merges from ``(word, freq)`` until the vocabulary is full or no pair is left.

    Ties go to the pair with the smaller left bytes, then right bytes. ``max_batch=1`` is
    the plain one-merge-per-round loop with the same result.

    With a ``folder`` every round adds its merges to a table there, and a training that finds
    such a table applies its merges and goes on from them; ``max_rounds`` ends one early. The
    tables of words are removed at the end.
    """
    spark = word_freq.sparkSession
    wanted = max(vocab_size - sy.FIRST_MERGE_ID, 0)
    if wanted == 0:
        return Tokenizer((), vocab_size)
    vocabulary, done = Vocabulary(), []
    before = merges_so_far(spark, folder) if folder else None
    if before is not None:
        # At most one row per merge of the vocabulary.
        for row in before.where(F.col("rank") < wanted).collect():
            pair = "".join(vocabulary.symbol_of[bytes.fromhex(x)] for x in (row.left, row.right))
            done.append(pair + vocabulary.add(pair, row.freq)[0])
    if len(done) == wanted:
        return Tokenizer(tuple(vocabulary.merges), vocab_size, tuple(vocabulary.freqs))
    work = scratch_path(spark, "merges")
    state = _Words(symbol_table(word_freq), work, done)
    rounds, measured = 0, {}
    while (missing := wanted - len(vocabulary.merges)) > 0 and rounds != max_rounds:
        candidates = _candidates(_trigrams(state.words), vocabulary.token_hex)
        first, confirmed, rules = len(vocabulary.merges), vocabulary, []
        while rounds != max_rounds:
            foreseen = foresee(candidates, vocabulary, min(max_batch, missing), measured)
            if not foreseen:
                break
            followed = state.followed(foreseen, candidates, sy.symbol(sy.FIRST_MERGE_ID + first))
            # The merges confirmed before come first again, by their measured effects, and one more at least.
            latest = effects(foreseen, candidates, followed, vocabulary)
            measured |= latest
            so_far, now = deepcopy(vocabulary), len(confirmed.merges)
            found = confirm(foreseen, candidates, followed, so_far, missing)
            rounds += 1
            if len(found) <= len(rules):
                break
            confirmed, rules = so_far, found
            if folder:
                rows = [
                    (now + i, left.hex(), right.hex(), freq)
                    for i, ((left, right), freq) in enumerate(zip(confirmed.merges[now:], confirmed.freqs[now:]))
                ]
                spark.createDataFrame(rows, ROUNDS_SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/rounds")
            if len(rules) >= min(missing, LOOK_AGAIN) or len(rules) == len(foreseen):
                break
        if not rules:
            break
        vocabulary, measured = confirmed, latest
        if len(rules) < missing and rounds != max_rounds:
            state.apply(rules)
    drop_folder(spark, work)
    return Tokenizer(tuple(vocabulary.merges), vocab_size, tuple(vocabulary.freqs))


def train_tokenizer(
    corpus: DataFrame,
    column: str = "text",
    vocab_size: int = DEFAULT_VOCAB_SIZE,
    folder: str | None = None,
) -> Tokenizer:
    return learn_merges(word_frequency(corpus, column), vocab_size, folder=folder)
