"""Row ranks over a whole table without a global sort in one task.

Rows are range partitioned and sorted by any order, and written with their place in their part; a
table of part sizes, summed up, gives each part its offset. Every row is shuffled once, and what is
summed has one row per part. Keys must be unique: equal keys cannot be told apart by any order. A
null key is a key of its own: it is shuffled like an empty one, and comes last in key order. Columns of
the rows may have any name.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, Window, functions as F

from glyphmill.session import scratch_path

# Bits of a place that count rows within a part.
_PLACE_BITS = 33
# Hex digits of the hash that deal the rows of a shuffle: up to 4,096 ranges of hashes.
_RANGE_DIGITS = 3
# Hex digits of the hash that one pass of the split looks at: 256 counts come to the driver.
_DIGITS, _HASH_DIGITS = 2, 32


def shuffle_hash(seed: int | str, key: str) -> Column:
    """md5 of ``seed:key``: an order that depends on neither partitioning nor engine."""
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(f"{seed}:"), name).cast("binary"))


class _Sorted:
    """Rows in order, written with the part each is in and its place there."""

    def __init__(self, df: DataFrame, order: list):
        spark, path = df.sparkSession, scratch_path(df.sparkSession, "sorted")
        # A name no column of the rows has.
        self.place = f"place_{uuid.uuid4().hex}"
        rows = df.orderBy(*order).withColumn(self.place, F.monotonically_increasing_id())
        rows.write.parquet(path)
        self.rows = spark.read.schema(rows.schema).parquet(path)
        part = F.shiftright(self.place, _PLACE_BITS)
        before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        self.offsets = (
            self.rows.groupBy(part.alias("part"))
            .agg(F.count("*").alias("n"))
            .select("part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
        )

    def ranked(self, name: str) -> DataFrame:
        """The rows with their 1-based rank. One row per part is joined; Spark broadcasts it."""
        part, offset = f"part_{self.place}", f"offset_{self.place}"
        offsets = self.offsets.select(F.col("part").alias(part), F.col("offset").alias(offset))
        within = F.col(self.place).bitwiseAND((1 << _PLACE_BITS) - 1)
        return (
            self.rows.withColumn(part, F.shiftright(self.place, _PLACE_BITS))
            .join(offsets, part)
            .withColumn(name, F.col(offset) + within + 1)
            .drop(part, offset, self.place)
        )

    def at(self, index: int) -> DataFrame:
        """The row at a 0-based index: its part is found among the offsets, and one place is read."""
        found = self.offsets.where((F.col("offset") <= index) & (index < F.col("offset") + F.col("n"))).first()
        place = -1 if found is None else (found.part << _PLACE_BITS) + index - found.offset
        return self.rows.where(F.col(self.place) == place).drop(self.place)


def shuffled_rank(df: DataFrame, key: str, seed: int | str, name: str = "rn") -> DataFrame:
    """Position of each row in the seeded shuffle, from 1.

    Hashes are spread evenly, so their first digits deal the rows into ranges, and no pass has to look
    for bounds first. Rows are written with their place in a range; a table of range sizes has the offsets.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "shuffled")
    # Names no column of the rows has.
    digits, place, offset = (f"{what}_{uuid.uuid4().hex}" for what in ("digits", "place", "offset"))
    within = Window.partitionBy(digits).orderBy(shuffle_hash(seed, key), F.col(key))
    rows = df.withColumn(digits, F.substring(shuffle_hash(seed, key), 1, _RANGE_DIGITS))
    rows = rows.withColumn(place, F.row_number().over(within))
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    before = Window.orderBy(digits).rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(digits).agg(F.count("*").alias("n"))
    offsets = sizes.select(digits, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(offset))
    return rows.join(F.broadcast(offsets), digits).withColumn(name, F.col(offset) + F.col(place)).drop(digits, place, offset)


def key_rank(df: DataFrame, key: str, name: str = "rn") -> DataFrame:
    """Position of each row in ascending order of ``key``, of any type that has an order, from 1."""
    return _Sorted(df, [F.col(key).asc_nulls_last()]).ranked(name)


def get_sample(df: DataFrame, key: str, index: int) -> DataFrame:
    """The row at 0-based ``index`` in key order, with ``sample_idx``; empty beyond the end."""
    return _Sorted(df, [F.col(key).asc_nulls_last()]).at(index).withColumn("sample_idx", F.lit(index).cast("bigint"))


def train_valid_split(
    df: DataFrame, key: str, train_ratio: float = 0.9, seed: int = 42
) -> DataFrame:
    """``df`` with ``split``: exactly ``floor(n * train_ratio)`` rows are ``train``.

    The rows with the smallest hashes are. Where they end is found digit by digit: a pass counts the rows
    below the digits known by the next two, 256 counts at most, until the cut falls between two
    of them. Labelling the rows is a comparison, not a shuffle.
    """
    keys = df.select(shuffle_hash(seed, key).alias("hash"))
    prefix, wanted = "", None
    while len(prefix) < _HASH_DIGITS:
        digits = F.substring("hash", len(prefix) + 1, _DIGITS)
        counts = sorted(keys.where(F.startswith("hash", F.lit(prefix))).groupBy(digits.alias("digits")).count().collect())
        if wanted is None:
            total = sum(n for _, n in counts)
            wanted = math.floor(total * train_ratio)
            if wanted <= 0:
                return df.withColumn("split", F.lit("valid"))
            if wanted >= total:
                return df.withColumn("split", F.lit("train"))
        for found, n in counts:
            if n >= wanted:
                prefix += found
                break
            wanted -= n
        if n == wanted:
            break
    label = F.when(F.substring(shuffle_hash(seed, key), 1, len(prefix)) <= prefix, F.lit("train"))
    return df.withColumn("split", label.otherwise(F.lit("valid")))
