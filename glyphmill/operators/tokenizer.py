"""The trained tokenizer: merge rules, vocabulary, encode and decode as column functions."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from glyphmill.functions import merging, symbols as sy, text as tx
from glyphmill.session import bounded_batches
from glyphmill.sources.corpus import texts

DEFAULT_VOCAB_SIZE = 10_000
INVALID = "<INVALID>"

# Ships the worker code with the UDF, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(merging)

MERGES_SCHEMA = T.StructType(
    [
        T.StructField("rank", T.IntegerType(), False),
        T.StructField("left", T.StringType(), False),
        T.StructField("right", T.StringType(), False),
        T.StructField("merged", T.StringType(), False),
        T.StructField("id", T.IntegerType(), False),
        T.StructField("freq", T.LongType()),
    ]
)


def _encoder(rules: list[str], encode: Callable[..., Iterator[pa.Array]]):
    """Arrow UDF: texts, or single words, -> token ids, the words of a text joined by the space token."""

    space = sy.SPACE_ID

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def encode_words(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        merger = merging.merger_of(rules)
        for batch in batches:
            yield from encode(batch, merger, space)

    return encode_words


@dataclass(frozen=True)
class Tokenizer:
    """Merge rules in rank order, as byte pairs, with the counts they were learned from.

    The rule list is bounded by ``vocab_size`` and lives on the driver, as any tokenizer
    file would; corpora never do.
    """

    merges: tuple[tuple[bytes, bytes], ...] = ()
    vocab_size: int = DEFAULT_VOCAB_SIZE
    freqs: tuple[int, ...] = field(default=(), compare=False)
    #: The names of padding, unknown, begin and end, ids 0 to 3.
    special_tokens: tuple[str, ...] = sy.SPECIAL_TOKENS

    def __post_init__(self):
        if len(set(self.special_tokens)) != len(sy.SPECIAL_TOKENS):
            raise ValueError("special tokens are four different names")

    # -- rules ---------------------------------------------------------------

    @cached_property
    def symbol_of(self) -> dict[bytes, str]:
        """Token bytes -> symbol. Bytes reached by two rules keep the lower id."""
        table = {bytes([b]): sy.symbol(sy.FIRST_BYTE_ID + b) for b in range(256)}
        for rank, (left, right) in enumerate(self.merges):
            table.setdefault(left + right, sy.symbol(sy.FIRST_MERGE_ID + rank))
        return table

    @cached_property
    def rules(self) -> list[str]:
        """Rules as ``left right merged`` symbol triples, without those that cannot fire.

        A word holds no ASCII space, so a rule on that byte never applies.
        """
        table = self.symbol_of
        return [
            table[left] + table[right] + table[left + right]
            for left, right in self.merges
            if left in table and right in table and b" " not in left + right
        ]

    @cached_property
    def fingerprint(self) -> str:
        digest = hashlib.sha256()
        for left, right in self.merges:
            digest.update(f"{left.hex()} {right.hex()}\n".encode())
        return digest.hexdigest()[:16]

    # -- vocabulary ----------------------------------------------------------

    @cached_property
    def tokens(self) -> list[bytes]:
        """Token bytes by id."""
        return (
            [t.encode() for t in self.special_tokens]
            + [bytes([b]) for b in range(256)]
            + [left + right for left, right in self.merges]
        )

    def size(self) -> int:
        return len(set(self.tokens))

    def require_size(self, expected: int) -> Tokenizer:
        if self.size() != expected:
            raise ValueError(f"tokenizer has {self.size()} tokens, expected {expected}")
        return self

    def merges_table(self, spark: SparkSession) -> DataFrame:
        freqs = self.freqs or (None,) * len(self.merges)
        rows = [
            (rank, left.hex(), right.hex(), (left + right).hex(), sy.FIRST_MERGE_ID + rank, freq)
            for rank, ((left, right), freq) in enumerate(zip(self.merges, freqs))
        ]
        return spark.createDataFrame(rows, MERGES_SCHEMA)

    def progress(self, spark: SparkSession, every: int = 500) -> DataFrame:
        """Every ``every``-th merge with its count and the vocabulary size reached."""
        return (
            self.merges_table(spark)
            .where((F.col("rank") + 1) % every == 0)
            .withColumn("vocab_size", F.col("id") + 1)
        )

    def vocabulary(self, spark: SparkSession) -> DataFrame:
        """``(id, token, kind)``: special tokens, bytes and merges."""
        specials = spark.createDataFrame(
            list(enumerate(self.special_tokens)), "id int, token string"
        ).select("id", F.col("token").cast("binary").alias("token"), F.lit("special").alias("kind"))
        single = spark.range(256).select(
            (F.col("id") + sy.FIRST_BYTE_ID).cast("int").alias("id"),
            F.unhex(F.lpad(F.hex("id"), 2, "0")).alias("token"),
            F.lit("byte").alias("kind"),
        )
        merged = self.merges_table(spark).select(
            "id", F.unhex("merged").alias("token"), F.lit("merge").alias("kind")
        )
        return specials.unionByName(single).unionByName(merged)

    # -- encode --------------------------------------------------------------

    def encode(self, text: Column | str) -> Column:
        """``ARRAY<INT>`` of token ids, words joined by one space token; null for null.

        A map without a shuffle, the same for any vocabulary: whole Arrow columns of texts, of whose
        words each distinct one of a block is merged once.
        """
        return _encoder(self.rules, merging.encode_texts)(text)

    def encode_word(self, word: Column | str) -> Column:
        """Ids of a column that holds one word per row."""
        return _encoder(self.rules, merging.encode_each)(word)

    def encode_prompt(self, text: Column | str) -> Column:
        """Ids after BOS, open at the end."""
        return F.concat(F.array(F.lit(sy.BOS)), self.encode(text))

    def encode_with_special(self, text: Column | str) -> Column:
        return F.concat(F.array(F.lit(sy.BOS)), self.encode(text), F.array(F.lit(sy.EOS)))

    # -- decode --------------------------------------------------------------

    def _token_hex(self, silent: tuple[int, ...] = ()) -> Column:
        """The vocabulary as one constant array of hex strings, indexed by id."""
        return F.split(
            F.lit(",".join("" if i in silent else t.hex() for i, t in enumerate(self.tokens))), ","
        )

    def decode_bytes(self, ids: Column | str) -> Column:
        """PAD, BOS and EOS decode to nothing, and so do ids outside the vocabulary."""
        table = self._token_hex(silent=(sy.PAD, sy.BOS, sy.EOS))
        ids = F.col(ids) if isinstance(ids, str) else ids
        # array_join leaves out the nulls of unknown ids.
        return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(table, i)), ""))

    def decode(self, ids: Column | str) -> Column:
        """Text of token ids, ill-formed UTF-8 replaced; PAD, BOS, EOS and unknown ids dropped."""
        return tx.lossy_utf8(self.decode_bytes(ids))

    def id_to_string(self, token_id: Column | str) -> Column:
        token_id = F.col(token_id) if isinstance(token_id, str) else token_id
        token = F.unhex(F.get(self._token_hex(), token_id))
        return F.coalesce(tx.lossy_utf8(token), F.lit(INVALID))


def encode_words(word_freq: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """Dictionary ``(word, freq, token_ids)``: each distinct word encoded once."""
    return word_freq.select("word", "freq", tokenizer.encode_word("word").alias("token_ids"))


def token_rows(df: DataFrame, tokenizer: Tokenizer, *keys: str, column: str = "text") -> DataFrame:
    """``(keys, token_ids, n_tokens)`` of every non-null text, framed by BOS and EOS.

    A map over the rows: at any corpus size this is scan and project, without a shuffle.
    """
    return (
        bounded_batches(texts(df, column, *keys))
        .select(*keys, tokenizer.encode_with_special(column).alias("token_ids"))
        .withColumn("n_tokens", F.size("token_ids"))
    )


def round_trip(df: DataFrame, tokenizer: Tokenizer, *keys: str, column: str = "text") -> DataFrame:
    """``(keys, text, token_ids, n_tokens, decoded)``."""
    return (
        bounded_batches(texts(df, column, *keys))
        .withColumn("token_ids", tokenizer.encode(column))
        .withColumn("n_tokens", F.size("token_ids"))
        .withColumn("decoded", tokenizer.decode("token_ids"))
    )


def occurrence_ids(occurrences: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """``occurrences`` (with ``word``) plus ``token_ids``: a map, as equal words of a batch meet there."""
    return occurrences.withColumn("token_ids", tokenizer.encode_word("word"))
