"""Removing long repeats across documents, found by recompression.

Word sequences are recompressed in rounds. Runs of four or more equal words become one symbol;
then, round by round, a coin per symbol makes it a left or a right one, and every left symbol
followed by a right one becomes one symbol. Coins and names are hashes of what they stand for, so
all documents name alike, wherever they are. Equal stretches are therefore parsed alike but for
their ends, which lose at most one symbol of 1, 2, 4 and 8 words in the four rounds and up to
three words of a run that goes on outside: 18 words at either end. All symbols that
touch the middle of a repeated window are thus in two documents or more.

One exchange finds the shared symbols. Windows whose middle is all shared, and those that
touch a long run, are compared by their own hashes in a second exchange, which gives the smallest
document of each; so shared symbols reveal repeats, and windows verify them exactly. Hashes have
64 bits: among 10^10 candidate windows some three pairs would collide.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window

from glyphmill.llm.plan import let, small_side, stored, words
from glyphmill.llm.tokens import Words, mix, seeded, signed, slices

WINDOW = 50
ROUNDS = 4
#: Equal words in a row that are one symbol.
RUN = 4
BLOCK_CHARS = 6_000_000
#: Words that either end of a repeat can lose to parsing.
_LOSS = RUN - 1 + 2**ROUNDS - 1
_LAST = np.iinfo(np.int64).max
_FACTORS = seeded(4, 21) | np.uint64(1)
_PACKED = "bucket bigint, block bigint, ids array<bigint>, a array<bigint>, b array<bigint>"


def _read(table: pa.Table):
    """Slices of a block's texts, each with its keys and words."""
    batch = pa.RecordBatch.from_arrays(
        [table.column("order").combine_chunks(), table.column("text").combine_chunks()], names=["order", "text"]
    ) if table.num_rows else None
    for part in slices(iter([batch] if batch else [])):
        yield part.column(0).to_numpy(), Words(part.column(1))


def recompressed(ids: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of word sequences: names, sizes in words, and which words lie in a long run."""
    n = len(ids)
    new = np.ones(n, bool)
    new[1:] = (ids[1:] != ids[:-1]) | (doc[1:] != doc[:-1])
    starts = np.flatnonzero(new)
    lengths = np.diff(np.append(starts, n))
    long = lengths >= RUN
    in_run = np.repeat(long, lengths)
    # A long run is one symbol, a short one its words.
    head = np.ones(n, bool)
    head[np.flatnonzero(in_run & ~new)] = False
    at = np.flatnonzero(head)
    size = np.diff(np.append(at, n))
    name = np.where(in_run[at], mix(ids[at] * _FACTORS[0] + size.astype(np.uint64)), ids[at])
    fixed, owner = in_run[at], doc[at]
    for r in range(ROUNDS):
        coin = (mix(name + _FACTORS[3] * np.array([r + 1], np.uint64)) >> np.uint64(63)).astype(bool)
        # A run stays as it is: only names of bounded size take part in pairs.
        free = ~fixed
        first = np.zeros(len(name), bool)
        first[:-1] = ~coin[:-1] & coin[1:] & free[:-1] & free[1:] & (owner[:-1] == owner[1:])
        second = np.roll(first, 1)
        pair = np.flatnonzero(first)
        name = name.copy()
        name[pair] = mix(name[pair] * _FACTORS[1] + name[pair + 1] * _FACTORS[2] + np.uint64(r))
        size = size.copy()
        size[pair] += size[pair + 1]
        name, size, fixed, owner = (x[~second] for x in (name, size, fixed, owner))
    return name, size, in_run


def _packed(block: int, buckets: int, ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.Table:
    """One row per bucket that has ids."""
    bucket = (ids % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    ids, a, b, bucket = signed(ids[order]), a[order], b[order], bucket[order]
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
    offsets = pa.array(np.append(cuts, len(bucket)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int64())) for x in (ids, a, b)]
    return pa.Table.from_arrays(
        [pa.array(bucket[cuts]), pa.array(np.full(len(cuts), block, np.int64)), *lists],
        names=["bucket", "block", "ids", "a", "b"],
    )


def _flat(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)


def _symbols(buckets: int):
    """Distinct symbols of a block, each with how many of its documents have it."""

    def run(table: pa.Table) -> pa.Table:
        seen = []
        for _, w in _read(table):
            name, size, _ = recompressed(w.ids(), w.doc)
            doc = w.doc[np.cumsum(size) - size]
            order = np.lexsort((doc, name))
            name, doc = name[order], doc[order]
            fresh = np.ones(len(name), bool)
            fresh[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])
            seen.append(name[fresh])
        names, n = np.unique(np.concatenate(seen), return_counts=True) if seen else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        return _packed(table.column("block")[0].as_py(), buckets, names, n.astype(np.int64), np.zeros(len(names), np.int64))

    return run


def _answers(kind: str):
    """For every block, its ids of a bucket that count: shared symbols, or windows seen earlier.

    ``symbols``: ids that two documents have. ``windows``: ids whose smallest document over all
    blocks is before the block's largest one; ``a`` is that smallest document.
    """

    def run(table: pa.Table) -> pa.Table:
        ids, a, b = (_flat(table, x) for x in ("ids", "a", "b"))
        sizes = np.diff(np.concatenate([c.offsets.to_numpy() for c in [table.column("ids").combine_chunks()]]))
        owner = np.repeat(np.arange(table.num_rows), sizes)
        values, inverse = np.unique(ids, return_inverse=True)
        if kind == "symbols":
            keep = np.bincount(inverse, weights=a, minlength=len(values))[inverse] > 1
        else:
            least = np.full(len(values), _LAST)
            np.minimum.at(least, inverse, a)
            a = least[inverse]
            keep = a < b
        cuts = np.searchsorted(owner[keep], np.arange(table.num_rows + 1)).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(cuts), pa.array(x[keep], pa.int64())) for x in (ids, a, a)]
        return pa.Table.from_arrays(
            [table.column("bucket").combine_chunks(), table.column("block").combine_chunks(), *lists],
            names=["bucket", "block", "ids", "a", "b"],
        )

    return run


def _windows(ids: np.ndarray, w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of a slice, and the number of the first word of each."""
    n = len(ids) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(w.doc[:n] == w.doc[WINDOW - 1 :])
    out = np.zeros(len(at), np.uint64)
    for i in range(WINDOW):
        out = out * _FACTORS[0] + ids[at + i]
    return mix(out), at


def _found(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of values in sorted keys, or -1."""
    if not len(keys):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return np.where(keys[at] == values, at, -1)


def _candidates(buckets: int):
    """Distinct candidate windows of a block, with the smallest and largest document of each."""

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        shared = np.sort(_flat(answers, "ids").view(np.uint64))
        hashes, docs = [], []
        for keys, w in _read(texts):
            ids = w.ids()
            name, size, in_run = recompressed(ids, w.doc)
            known = np.repeat(_found(name, shared) >= 0, size)
            alone = np.concatenate([[0], np.cumsum(~known)])
            runs = np.concatenate([[0], np.cumsum(in_run)])
            n = len(ids) - WINDOW + 1
            if n <= 0:
                continue
            first = np.arange(n)
            take = (alone[first + WINDOW - _LOSS] == alone[first + _LOSS]) | (runs[first + WINDOW] > runs[first])
            take &= w.doc[:n] == w.doc[WINDOW - 1 :]
            at = first[take]
            h = np.zeros(len(at), np.uint64)
            for i in range(WINDOW):
                h = h * _FACTORS[0] + ids[at + i]
            hashes.append(mix(h))
            docs.append(keys[w.doc[at]])
        if texts.num_rows == 0:
            return _packed(0, buckets, np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        d = np.concatenate(docs) if docs else np.zeros(0, np.int64)
        order = np.lexsort((d, h))
        h, d = h[order], d[order]
        first = np.ones(len(h), bool)
        first[1:] = h[1:] != h[:-1]
        last = np.roll(first, -1)
        if len(last):
            last[-1] = True
        return _packed(texts.column("block")[0].as_py(), buckets, h[first], d[first], d[last])

    return run


def _without(texts: pa.Table, answers: pa.Table) -> pa.Table:
    """Texts without the words of windows that an earlier document has."""
    ids = _flat(answers, "ids").view(np.uint64)
    order = np.argsort(ids)
    ids, least = ids[order], _flat(answers, "a")[order]
    n_words, n_removed, digests = [], [], []
    for keys, w in _read(texts):
        words_ids = w.ids()
        cover = np.zeros(len(words_ids) + 1, np.int64)
        if len(ids):
            h, at = _windows(words_ids, w)
            place = _found(h, ids)
            hit = (place >= 0) & (least[place] < keys[w.doc[at]])
            np.add.at(cover, at[hit], 1)
            np.add.at(cover, at[hit] + WINDOW, -1)
        kept = np.cumsum(cover[:-1]) == 0
        n = np.diff(w.first)
        left = np.concatenate([[0], np.cumsum(kept)])[w.first]
        # Kept words, each with one space after it; the last of a text goes without.
        which = np.flatnonzero(kept)
        sizes = (w.ends - w.starts)[which] + 1
        ends = np.cumsum(sizes)
        index = np.repeat(w.starts[which] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        body = w.data[np.minimum(index, max(len(w.data) - 1, 0))]
        body[ends - 1] = 0x20
        bounds = np.concatenate([[0], ends])[left]
        raw = body.tobytes()
        for i in range(len(n)):
            digests.append(hashlib.sha256(raw[bounds[i] : max(bounds[i + 1] - 1, bounds[i])]).hexdigest())
        n_words += n.tolist()
        n_removed += (n - np.diff(left)).tolist()
    return pa.Table.from_arrays(
        [texts.column("key"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string())],
        names=["key", "n_words", "n_removed", "kept_sha256"],
    )


def removed(docs: DataFrame, key: str = "doc_id", text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``(key, n_words, n_removed, kept_sha256)`` per row of ``docs``.

    A word goes if a window of 50 words over it is also in a row with a smaller key. A null or
    empty text has no words. Null keys come after all others and not before each other; rows
    that repeat a key are not before each other either. Exact copies of an earlier document's
    words are settled by one hash of the whole, and only one of them enters the rounds.
    """
    order = F.coalesce(F.col(key), F.lit(int(_LAST)))
    facts = let(
        words(F.col(text)),
        lambda w: F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.xxhash64(w).alias("k1"),
            F.xxhash64(F.lit("k2"), w).alias("k2"),
            F.when(F.size(w) < WINDOW, F.sha2(F.array_join(w, " "), 256)).alias("short_sha"),
        ),
    )
    seen = stored(docs.select(F.col(key).alias("key"), order.alias("order"), facts.alias("f")).select("key", "order", "f.*"), "documents-seen")
    long = seen.where(F.col("n_words") >= WINDOW)
    least = long.groupBy("k1", "k2").agg(F.min("order").alias("least"))
    l, m = long.alias("l"), least.alias("m")
    marked = l.join(m, F.expr("l.k1 = m.k1 and l.k2 = m.k2")).select("l.key", "l.order", "l.n_words", (F.col("least") < F.col("l.order")).alias("copy"), "l.k1")
    copies = stored(marked.where("copy").select("key", "order", "n_words", "k1"), "copies")
    aside = small_side(copies.select(F.col("order").alias("c_order"), F.col("k1").alias("c_k1")).distinct())
    rows = docs.select(F.col(key).alias("key"), order.alias("order"), F.col(text).alias("text"))
    rows = rows.withColumn("f", let(words(F.col("text")), lambda w: F.struct(F.size(w).alias("n"), F.xxhash64(w).alias("k1"))))
    rows = rows.where(F.col("f.n") >= WINDOW).select("key", "order", "text", F.col("f.k1").alias("k1"))
    fresh = rows.join(aside, (F.col("order") == F.col("c_order")) & (F.col("k1") == F.col("c_k1")), "left_anti")
    chars = docs.agg(F.sum(F.length(text))).first()[0] or 0
    blocks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(chars / block_chars))
    dealt = fresh.select("key", "order", "text", F.pmod(F.xxhash64("order", "k1"), F.lit(blocks)).alias("block"))
    shared = dealt.groupBy("block").applyInArrow(_symbols(blocks), _PACKED).groupBy("bucket").applyInArrow(_answers("symbols"), _PACKED)
    windows = (
        dealt.groupBy("block")
        .cogroup(shared.groupBy("block"))
        .applyInArrow(_candidates(blocks), _PACKED)
        .groupBy("bucket")
        .applyInArrow(_answers("windows"), _PACKED)
    )
    key_type = seen.schema["key"].dataType.simpleString()
    cleaned = (
        dealt.groupBy("block")
        .cogroup(windows.groupBy("block"))
        .applyInArrow(_without, f"key {key_type}, n_words bigint, n_removed bigint, kept_sha256 string")
    )
    short = seen.where(F.col("n_words") < WINDOW).select("key", "n_words", F.lit(0).cast("bigint").alias("n_removed"), F.col("short_sha").alias("kept_sha256"))
    whole = copies.select("key", "n_words", F.col("n_words").alias("n_removed"), F.sha2(F.lit(""), 256).alias("kept_sha256"))
    return cleaned.unionByName(short).unionByName(whole).withColumnRenamed("key", key)


def query(spark, sf_dir: str) -> DataFrame:
    return removed(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
