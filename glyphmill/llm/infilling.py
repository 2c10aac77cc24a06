"""Fill-in-the-middle: token boundaries as a Roaring-style set that is asked for its k-th member.

A text's token ends are kept as code-point offsets in containers of 65,536 offsets each. A container
is a sorted array, a bitmap or a list of runs, whichever is smallest, and the set knows how many
offsets lie before each of them. A cut after k tokens is a search among these counts for the
container and a select inside it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from glyphmill.llm.plan import small_batches
from glyphmill.llm.tokens import Words, slices

SEED = 42
#: Of 100 texts, so many are transformed; of 100 transformed ones, so many have the suffix first.
RATE, SUFFIX_FIRST = 50, 80
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Members of a container that take as much room in an array as in a bitmap.
ARRAY_MOST = 4096


class ArrayContainer:
    """Low halves of the offsets, sorted."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])


class BitmapContainer:
    """One bit for each of 65,536 offsets, with the number of bits before each 64-bit word."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(1 << 16, np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, "right")) - 1
        word = int(self.words[at])
        for _ in range(k - int(self.before[at])):
            word &= word - 1
        return 64 * at + (word & -word).bit_length() - 1


class RunContainer:
    """Runs of consecutive offsets: the first of each, and the number of offsets before it."""

    def __init__(self, firsts: np.ndarray, sizes: np.ndarray):
        self.firsts = firsts.astype(np.uint16)
        self.before = np.cumsum(sizes) - sizes

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.firsts[run]) + k - int(self.before[run])


def container(low: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest of the three kinds for the given low halves, sorted and distinct."""
    edges = np.flatnonzero(np.diff(low) != 1) + 1
    if 4 * (len(edges) + 1) < min(2 * len(low), 8192):
        firsts = np.concatenate([[0], edges])
        return RunContainer(low[firsts], np.diff(np.concatenate([firsts, [len(low)]])))
    return ArrayContainer(low) if len(low) <= ARRAY_MOST else BitmapContainer(low)


class BoundarySet:
    """A set of offsets, given sorted and distinct, of any size."""

    def __init__(self, offsets: np.ndarray):
        self.size = len(offsets)
        high = offsets >> 16
        starts = np.concatenate([[0], np.flatnonzero(np.diff(high)) + 1]) if self.size else np.zeros(0, np.int64)
        self.high = high[starts]
        self.containers = [container(part & 0xFFFF) for part in np.split(offsets, starts[1:])] if self.size else []
        #: Members before each container.
        self.before = starts

    def select(self, k: int) -> int:
        """The ``k``-th smallest member, from 0."""
        at = int(np.searchsorted(self.before, k, "right")) - 1
        return (int(self.high[at]) << 16) + self.containers[at].select(k - int(self.before[at]))


def boundary_sets(texts: pa.Array) -> list[BoundarySet]:
    """The token ends of each text, in code points.

    A token is a word with the white space before it; white space at the end of a text is one more.
    """
    words = Words(texts)
    sizes = pa.compute.binary_length(texts.cast(pa.large_string()).fill_null("")).to_numpy().astype(np.int64)
    stops = np.cumsum(sizes)
    # Code points before each byte place.
    points = np.zeros(len(words.data) + 1, np.int64)
    np.cumsum((words.data & 0xC0) != 0x80, out=points[1:])
    out = []
    for i, (stop, size) in enumerate(zip(stops, sizes)):
        ends = words.ends[words.first[i] : words.first[i + 1]]
        if size and (not len(ends) or ends[-1] < stop):
            ends = np.append(ends, stop)
        out.append(BoundarySet(points[ends] - points[stop - size]))
    return out


def cuts(text: Column, first: Column, second: Column) -> Column:
    """``struct<n, low, high>``: a text's tokens and the code points before its two cuts.

    The cuts are after ``first`` and ``second`` tokens, each modulo ``n + 1``, in order of size.
    """

    @F.arrow_udf("struct<n: long, low: long, high: long>")
    def run(texts: pa.Array, one: pa.Array, other: pa.Array) -> pa.Array:
        rows = pa.RecordBatch.from_arrays([texts, one, other], ["text", "one", "other"])
        out = []
        for part in slices([rows]):
            sets = boundary_sets(part.column(0))
            for ends, a, b in zip(sets, part.column(1).to_pylist(), part.column(2).to_pylist()):
                places = sorted((a % (ends.size + 1), b % (ends.size + 1)))
                out.append((ends.size, *(ends.select(k - 1) if k else 0 for k in places)))
        columns = np.array(out, np.int64).reshape(len(out), 3).T
        return pa.StructArray.from_arrays([pa.array(c) for c in columns], ["n", "low", "high"])

    return run(text, first, second)


def draws(key: Column, seed: int = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers that the seed and a key give; a null key is an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED, rate: int = RATE) -> DataFrame:
    """``(row, n, form, prefix_chars, middle_chars, output)``, one for each row of ``docs``.

    ``row`` holds all columns of the input, whatever their names. ``output`` is the text as it is
    (``plain``), or its prefix, suffix and middle behind their marks: suffix first (``spm``) or prefix
    first (``psm``). A null text counts as empty; an empty text, and one that holds a mark, stays
    plain. Equal keys are cut after the same draws; a null key draws like an empty one. The lengths of
    the parts are null for plain texts. An empty table gives an empty one.
    """
    h1, h2, h3, h4 = draws(F.col(f"`{key}`"), seed)
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(whole, F.lit(mark))
    rows = small_batches(docs).select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        whole.alias("whole"),
        F.when((whole == "") | marked | (h3 % 100 >= rate), "plain")
        .when(h4 % 100 < SUFFIX_FIRST, "spm")
        .otherwise("psm")
        .alias("form"),
        cuts(whole, h1, h2).alias("cut"),
    )
    prefix = F.expr("substring(whole, 1, cut.low)")
    middle = F.expr("substring(whole, cut.low + 1, cut.high - cut.low)")
    suffix = F.expr("substring(whole, cut.high + 1)")
    parts = {PREFIX: prefix, SUFFIX: suffix, MIDDLE: middle}
    joined = lambda *marks: F.concat(*[x for m in marks for x in (F.lit(m), parts[m])])
    cut = F.col("form") != "plain"
    return rows.select(
        "row",
        F.col("cut.n").alias("n"),
        "form",
        F.when(cut, F.col("cut.low")).alias("prefix_chars"),
        F.when(cut, F.col("cut.high") - F.col("cut.low")).alias("middle_chars"),
        F.when(F.col("form") == "spm", joined(SUFFIX, PREFIX, MIDDLE))
        .when(F.col("form") == "psm", joined(PREFIX, SUFFIX, MIDDLE))
        .otherwise(F.col("whole"))
        .alias("output"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text that an output of :func:`fill_in_middle` was made from.

    The marks are found wherever they stand: the text held none, and none can come about where a
    part meets a mark.
    """
    parts = F.split(output, "<[PSM]>", -1)
    part = lambda i: F.coalesce(F.get(parts, F.lit(i)), F.lit(""))
    return (
        F.when(form == "psm", F.concat(part(1), part(3), part(2)))
        .when(form == "spm", F.concat(part(2), part(3), part(1)))
        .otherwise(output)
    )


def digests(rows: DataFrame) -> DataFrame:
    return rows.select(
        "row.doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return digests(fill_in_middle(docs))


_HEX = "list_sum(list_transform(range(1, 9), lambda i: (instr('0123456789abcdef', substr(h, {at} + i, 1)) - 1) * (16 ** (8 - i))::BIGINT))::BIGINT"

SQL = rf"""
WITH hashed AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
        regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
    FROM documents),
drawn AS (
    SELECT *, len(units) AS n, {_HEX.format(at=0)} AS h1, {_HEX.format(at=8)} AS h2,
        {_HEX.format(at=16)} AS h3, {_HEX.format(at=24)} AS h4
    FROM hashed),
placed AS (
    SELECT doc_id, text, units, n,
        least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50
            THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn),
parted AS (
    SELECT doc_id, text, n, form, array_to_string(units[1:low], '') AS prefix,
        array_to_string(units[low + 1:high], '') AS middle, array_to_string(units[high + 1:n], '') AS suffix
    FROM placed)
SELECT doc_id, n::BIGINT AS n, form,
    CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM parted
"""
