"""Words, word counts and adjacent-pair counts."""

from __future__ import annotations

from functools import reduce

from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from glyphmill.functions import merging, symbols as sy, text as tx
from glyphmill.sources.corpus import require_text

# Ships the worker code with its functions, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(merging)


def word_positions(df: DataFrame, *keys: str, column: str = "text") -> DataFrame:
    """One row per word: ``keys``, ``pos`` from 0, ``word``."""
    return require_text(df, column).select(
        *keys, F.posexplode(tx.words(column)).alias("pos", "word")
    )


def word_frequency(df: DataFrame, column: str = "text") -> DataFrame:
    """``(word, freq)``. Partial counts per task keep a hot word from skewing the shuffle.

    Workers split and count blocks of texts, so words are rows only once they are distinct in a block.
    """
    counts = require_text(df, column).select(column).mapInArrow(merging.count_words, "word string, freq long")
    return counts.groupBy("word").agg(F.sum("freq").alias("freq"))


def word_frequency_of(chunks: list[DataFrame], column: str = "text") -> DataFrame:
    """Word counts over several tables read as one corpus."""
    return word_frequency(reduce(DataFrame.unionByName, [c.select(column) for c in chunks]), column)


def corpus_totals(word_freq: DataFrame) -> DataFrame:
    return word_freq.agg(
        F.count("*").alias("unique_words"),
        F.coalesce(F.sum("freq"), F.lit(0)).alias("total_words"),
        F.coalesce(F.sum(F.octet_length("word") * F.col("freq")), F.lit(0)).alias("total_bytes"),
    )


def symbol_table(word_freq: DataFrame) -> DataFrame:
    """``(freq, symbols)``: every distinct word as byte symbols."""
    return word_freq.select("freq", sy.byte_symbols(F.col("word")).alias("symbols"))


def count_pairs(symbol_rows: DataFrame) -> DataFrame:
    """``(pair, freq)``: adjacent symbols weighted by word count, overlapping ones included."""
    return (
        symbol_rows.where(F.length("symbols") > 1)
        .select("freq", F.explode(sy.windows(F.col("symbols"), 2)).alias("pair"))
        .groupBy("pair")
        .agg(F.sum("freq").alias("freq"))
    )


def _byte_hex(char):
    return tx.to_hex(F.encode(char, "ISO-8859-1"))


def pair_frequency(word_freq: DataFrame) -> DataFrame:
    """``(left, right, freq)`` of adjacent bytes, in hex."""
    return count_pairs(symbol_table(word_freq)).select(
        _byte_hex(F.substring("pair", 1, 1)).alias("left"),
        _byte_hex(F.substring("pair", 2, 1)).alias("right"),
        "freq",
    )


def best_pair(pairs: DataFrame) -> DataFrame:
    """The most frequent pair; equal counts are settled by ``left``, then ``right``."""
    return pairs.orderBy(F.desc("freq"), "left", "right").limit(1)
