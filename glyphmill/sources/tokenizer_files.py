"""Tokenizers as files: the hex text format and a Parquet merges table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from glyphmill.operators.tokenizer import DEFAULT_VOCAB_SIZE, MERGES_SCHEMA, Tokenizer


def _bytes(digits: str) -> bytes:
    """Hex digits as bytes; an odd last digit is dropped."""
    try:
        return bytes.fromhex(digits[: len(digits) // 2 * 2])
    except ValueError:
        raise ValueError(f"Invalid hex: {digits}") from None


def parse_tokenizer(content: str) -> Tokenizer:
    """Vocabulary size, merge count, then one ``left right`` hex pair per line."""
    lines = content.splitlines()
    for number, what in enumerate(("vocab size", "merge count")):
        if len(lines) <= number:
            raise ValueError(f"Missing {what}")
    vocab_size, n_merges = int(lines[0]), int(lines[1])
    if len(lines) < 2 + n_merges:
        raise ValueError("Missing merge")
    merges = []
    for line in lines[2 : 2 + n_merges]:
        parts = line.split()
        for number, what in enumerate(("left", "right")):
            if len(parts) <= number:
                raise ValueError(f"Missing {what} token")
        merges.append((_bytes(parts[0]), _bytes(parts[1])))
    return Tokenizer(tuple(merges), vocab_size)


def export_text(tokenizer: Tokenizer, spark: SparkSession, path: str) -> None:
    """Write the text format. One small file: a line per merge, bounded by the vocabulary."""
    header = spark.createDataFrame(
        [(-2, str(tokenizer.vocab_size)), (-1, str(len(tokenizer.merges)))], "rank int, value string"
    )
    lines = tokenizer.merges_table(spark).select(
        "rank", F.concat_ws(" ", "left", "right").alias("value")
    )
    (
        header.unionByName(lines)
        .coalesce(1)
        .sortWithinPartitions("rank")
        .select("value")
        .write.mode("overwrite")
        .text(path)
    )


def import_text(spark: SparkSession, path: str) -> Tokenizer:
    rows = spark.read.text(path, wholetext=True).limit(2).collect()
    if len(rows) > 1:
        raise ValueError(f"{path} holds more than one tokenizer file")
    return parse_tokenizer(rows[0].value if rows else "")


def save_merges(tokenizer: Tokenizer, spark: SparkSession, path: str) -> None:
    tokenizer.merges_table(spark).coalesce(1).write.mode("overwrite").parquet(path)


def from_merges(merges: DataFrame, vocab_size: int = DEFAULT_VOCAB_SIZE) -> Tokenizer:
    """Tokenizer from a merges table; its length is bounded by the vocabulary size."""
    rows = merges.orderBy("rank").collect()
    return Tokenizer(
        tuple((bytes.fromhex(r.left), bytes.fromhex(r.right)) for r in rows),
        vocab_size,
        tuple(r.freq for r in rows if r.freq is not None),
    )


def load_merges(spark: SparkSession, path: str, vocab_size: int = DEFAULT_VOCAB_SIZE) -> Tokenizer:
    return from_merges(spark.read.schema(MERGES_SCHEMA).parquet(path), vocab_size)
