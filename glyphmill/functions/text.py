"""Column functions on text: lengths, words, graphemes, previews, labels.

Everything here is a Spark expression; nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The code points with the Unicode White_Space property.
WHITESPACE = "".join(
    map(
        chr,
        (
            *range(0x09, 0x0E),
            0x20,
            0x85,
            0xA0,
            0x1680,
            *range(0x2000, 0x200B),
            0x2028,
            0x2029,
            0x202F,
            0x205F,
            0x3000,
        ),
    )
)

PREVIEW_LENGTH = 500

# Below U+0300 every code point is a grapheme cluster of its own, CR LF excepted.
_MAY_CLUSTER = r"[\r\x{300}-\x{10FFFF}]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(text: Column | str) -> Column:
    """Whitespace-separated words in order; empty array for blank text.

    Mapping every separator to a plain space first keeps the split on
    Spark's single-character path, without the regex engine.
    """
    spaced = F.translate(_col(text), WHITESPACE, " " * len(WHITESPACE))
    return F.array_remove(F.split(spaced, " "), "")


def char_count(text: Column | str) -> Column:
    return F.length(_col(text))


def word_count(text: Column | str) -> Column:
    return F.size(words(text))


def grapheme_count(text: Column | str) -> Column:
    """Extended grapheme clusters; plain text skips the costly ``\\X`` scan."""
    text = _col(text)
    return F.when(text.rlike(_MAY_CLUSTER), F.regexp_count(text, F.lit(r"\X"))).otherwise(
        F.length(text)
    )


def is_blank(text: Column | str) -> Column:
    """True where no character remains after a Unicode-aware trim."""
    return word_count(text) == 0


def trimmed(text: Column | str) -> Column:
    """Text without Unicode white space at either end."""
    return F.trim(_col(text), F.lit(WHITESPACE))


def preview(text: Column | str, length: int = PREVIEW_LENGTH) -> Column:
    """First ``length`` characters plus ``...`` where the text has more *bytes* than that."""
    text = _col(text)
    return F.when(
        F.octet_length(text) > length,
        F.concat(F.substring(text, 1, length), F.lit("...")),
    ).otherwise(text)


def chars(text: Column | str) -> Column:
    return F.array_remove(F.split(_col(text), ""), "")


def char_label(char: Column | str) -> Column:
    """Printable form of one character: whitespace as ``[space:U+hex]``."""
    char = _col(char)
    return F.when(
        F.lit(WHITESPACE).contains(char),
        F.concat(F.lit("[space:U+"), F.hex(F.ascii(char)), F.lit("]")),
    ).otherwise(char)


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` as a double; null where ``whole`` is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0)


def to_hex(data: Column | str) -> Column:
    return F.lower(F.hex(_col(data).cast("binary")))


def from_hex(digits: Column | str) -> Column:
    """Bytes of a hex string. An odd last digit is dropped, a non-hex digit raises."""
    digits = _col(digits)
    even = F.substr(digits, F.lit(1), F.length(digits) - F.length(digits) % 2)
    return F.when(even.rlike("^[0-9A-Fa-f]*$"), F.unhex(even)).otherwise(
        F.raise_error(F.concat(F.lit("Invalid hex: "), digits)).cast("binary")
    )


def lossy_utf8(data: Column | str) -> Column:
    """Bytes as text, each ill-formed sequence replaced by U+FFFD."""
    return F.make_valid_utf8(_col(data).cast("string"))
