"""Small helpers the operators share: written steps, checked broadcasts, column idioms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from glyphmill.session import scratch_path

#: White space that separates words: U+0020 and U+0009 to U+000D.
SPACE = r"\x20\x09-\x0D"
#: The most rows of a few short columns that are broadcast; larger sides are shuffled.
BROADCAST_ROWS = 500_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: the lineage ends here."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, after asking its session for Arrow batches of a few MB.

    Texts differ in length by orders of magnitude; batches of thousands of rows would decide how much
    memory a Python worker and its executor need. A session with lower limits keeps them.
    """
    conf = df.sparkSession.conf
    for name, most in (("maxRecordsPerBatch", 2_000), ("maxBytesPerBatch", 4 << 20)):
        key = f"spark.sql.execution.arrow.{name}"
        now = conf.get(key).rstrip("bB")
        if not now.isdigit() or not 0 < int(now) <= most:
            conf.set(key, str(most))
    return df


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written table, marked for broadcast if it has at most ``rows`` rows."""
    return F.broadcast(df) if df.count() <= rows else df


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    pieces = F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+")
    return F.array_remove(pieces, "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def text_key(text: Column) -> list[Column]:
    """128 bits that stand for a text, as the columns ``k1`` and ``k2``; null is empty."""
    value = F.coalesce(text, F.lit(""))
    return [F.xxhash64(value).alias("k1"), F.xxhash64(F.lit("k2"), value).alias("k2")]
