"""The whole jobs, from a corpus to its tables: profile, train, build, complete."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from glyphmill.operators import profile as pf
from glyphmill.operators.batches import BATCH_SIZE, MAX_SEQ_LEN, SEED, batch_windows, batches
from glyphmill.operators.ordering import train_valid_split
from glyphmill.operators.scoring import best_next, complete, next_token_counts
from glyphmill.operators.tokenizer import DEFAULT_VOCAB_SIZE, Tokenizer
from glyphmill.operators.training import learn_merges
from glyphmill.operators.words import word_frequency_of
from glyphmill.sources.report import write_report
from glyphmill.sources.token_table import token_table

TRAIN_RATIO = 0.9


def profile_corpus(df: DataFrame, key: str, out: str | None = None) -> dict[str, DataFrame]:
    """The report's tables by name, written below ``out`` when given."""
    report = {
        "profile": pf.profile(df),
        "nulls": pf.null_counts(df),
        "top_chars": pf.top_chars(df),
        "histogram": pf.length_histogram(df),
        "samples": pf.sample_texts(df, key),
    }
    if out is not None:
        for name, table in report.items():
            write_report(table, f"{out}/{name}")
    return report


def train_on_chunks(
    chunks: list[DataFrame],
    column: str = "text",
    vocab_size: int = DEFAULT_VOCAB_SIZE,
    folder: str | None = None,
) -> Tokenizer:
    """One tokenizer from several inputs. A failed task is retried, so no chunk is lost."""
    return learn_merges(word_frequency_of(chunks, column), vocab_size, folder=folder)


@dataclass(frozen=True)
class TrainingSet:
    tokens: DataFrame
    train: DataFrame
    valid: DataFrame

    def train_batches(self, key: str, epoch: int, **options) -> DataFrame:
        return batches(self.train, key, epoch, **options)

    def train_windows(self, key: str, epoch: int, **options) -> DataFrame:
        return batch_windows(self.train, key, epoch, **options)

    def valid_batches(self, key: str, **options) -> DataFrame:
        return batches(self.valid, key, None, **options)


def build_training_set(
    df: DataFrame,
    tokenizer: Tokenizer,
    folder: str,
    key: str,
    column: str = "text",
    vocab_size: int | None = None,
    train_ratio: float = TRAIN_RATIO,
    seed: int = SEED,
) -> TrainingSet:
    """Check the vocabulary, store or find the token table, split it."""
    if vocab_size is not None:
        tokenizer.require_size(vocab_size)
    tokens = token_table(df, tokenizer, folder, key, column=column)
    labelled = train_valid_split(tokens, key, train_ratio, seed)
    return TrainingSet(
        tokens,
        labelled.where(F.col("split") == "train").drop("split"),
        labelled.where(F.col("split") == "valid").drop("split"),
    )


def complete_prompts(
    prompts: DataFrame, tokens: DataFrame, tokenizer: Tokenizer, *keys: str, **options
) -> DataFrame:
    """Completions by the next-token counts of a token table."""
    size = options.get("context_size", 1)
    best = best_next(next_token_counts(tokens, size))
    return complete(prompts, tokenizer, best, *keys, **options)


__all__ = [
    "BATCH_SIZE",
    "MAX_SEQ_LEN",
    "TrainingSet",
    "build_training_set",
    "complete_prompts",
    "profile_corpus",
    "train_on_chunks",
]
