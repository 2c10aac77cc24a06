"""Corpus profiling, byte-level BPE and training-batch tables on Spark DataFrames."""

from glyphmill.operators.tokenizer import Tokenizer
from glyphmill.operators.training import learn_merges, train_tokenizer

__all__ = ["Tokenizer", "learn_merges", "train_tokenizer"]
