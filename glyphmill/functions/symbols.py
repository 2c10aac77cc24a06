"""Token sequences as strings with one character per token.

A token id is written as one code point: bytes 0..255 (ids 4..259) are U+0000..U+00FF,
the merge of rank r (id 260 + r) is U+0100 + r, stepping over the surrogates. A word in
this form is an ordinary Spark string, so applying a merge is ``replace`` with a
two-character needle (left to right, not overlapping), the number of tokens is ``length``
and the ids are the code points.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Id layout of the vocabulary.
PAD, UNK, BOS, EOS = 0, 1, 2, 3
SPECIAL_TOKENS = ("<PAD>", "<UNK>", "<BOS>", "<EOS>")
FIRST_BYTE_ID = 4
FIRST_MERGE_ID = 260
SPACE_ID = FIRST_BYTE_ID + 32

# Stands before and after a word; beyond any token's code point.
EDGE = "\U0010ffff"

_SURROGATES_FROM, _SURROGATES_TO = 0xD800, 0xE000
_GAP = _SURROGATES_TO - _SURROGATES_FROM


def symbol(token_id: int) -> str:
    """The character that stands for ``token_id`` (4 or above)."""
    point = token_id - FIRST_BYTE_ID
    return chr(point if point < _SURROGATES_FROM else point + _GAP)


def symbol_id(char: Column, n_tokens: int | None = None) -> Column:
    """Id of a symbol; with a vocabulary that ends below the surrogates the step is left out."""
    point = F.ascii(char)
    if n_tokens is None or n_tokens > _SURROGATES_FROM:
        point = F.when(point >= _SURROGATES_TO, point - _GAP).otherwise(point)
    return point + FIRST_BYTE_ID


def symbol_index_sql(char: str) -> str:
    """SQL for the position of a symbol among all symbols, from 0."""
    return f"ascii({char}) - if(ascii({char}) >= {_SURROGATES_TO}, {_GAP}, 0)"


def byte_symbols(text: Column) -> Column:
    """Text to one symbol per UTF-8 byte (Latin-1 maps each byte to its own code point)."""
    return F.decode(text.cast("binary"), "ISO-8859-1")


def symbol_list(symbols: Column) -> Column:
    return F.array_remove(F.split(symbols, ""), "")


def symbol_ids(symbols: Column, n_tokens: int | None = None) -> Column:
    """``ARRAY<INT>`` of token ids; an empty string gives an empty array."""
    return F.transform(symbol_list(symbols), lambda char: symbol_id(char, n_tokens))


def apply_rules(symbols: Column, rules: list[str]) -> Column:
    """Apply merge rules in order. A rule is three characters: left, right, merged."""
    for rule in rules:
        symbols = F.replace(symbols, F.lit(rule[:2]), F.lit(rule[2]))
    return symbols


def windows(symbols: Column, width: int) -> Column:
    """Overlapping runs of ``width`` symbols; empty array for shorter sequences."""

    def runs(chars: Column) -> Column:
        starts = F.slice(chars, F.lit(1), F.greatest(F.size(chars) - (width - 1), F.lit(0)))
        return F.transform(
            starts, lambda _, i: F.concat(*[F.get(chars, i + k) for k in range(width)])
        )

    # The inner lambda's argument holds the split symbols, so they are split once.
    return F.element_at(F.transform(F.array(symbol_list(symbols)), runs), 1)
