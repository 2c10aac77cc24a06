"""Near duplicates: all pairs of documents whose word 5-gram sets have Jaccard similarity 0.8 or more.

Every distinct set of n-grams is one class; exact copies never meet again. A MinHash LSH forest
proposes partners: each tree is a prefix trie of signatures of min-hashes, kept as rows sorted by
signature, in which a node is a run of rows that share a prefix. Classes meet first where their
whole signatures match. Matched prefixes are then shortened value by value, node by node: a node is
opened only while it holds classes that no longer prefix has joined, and what one child has settled
is not looked at again. The shortest prefix is that at which a pair at the threshold meets in some
tree with the target probability, and decides how the tries are dealt to tasks. Classes that
meet and whose sketches look alike form clusters, and within a cluster every pair is verified on
its n-grams.

Pairs are compared inside tasks and counted there; what leaves a task is linear in its rows.
Nodes and clusters too large for one task are cut into blocks, and pairs of blocks are tasks.
Class ids are 64-bit hashes of n-gram sets: among 10^10 sets some three pairs would collide.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from glyphmill.llm.components import components
from glyphmill.llm.plan import small_batches, small_side, stored
from glyphmill.llm.tokens import Words, mix, runs, seeded, signed, slices

NGRAM = 5
THRESHOLD = 0.8
TREES = 16
#: The whole signature of a tree, in values; a sketch keeps a byte of every value of every tree.
SIGNATURE = 8
TARGET_RECALL = 0.999
#: Sketches that agree on fewer values than this many standard deviations below the
#: threshold's mean are not alike: at five, one pair in three million at the threshold.
DEVIATIONS = 5.0
#: The most classes of an LSH node, and of a cluster, that one task compares with each other.
NODE_BLOCK, CLUSTER_BLOCK = 4096, 512
_COLUMNS = 4096


def shortest_prefix(threshold: float, trees: int = TREES, signature: int = SIGNATURE, target: float = TARGET_RECALL) -> int:
    """How far prefixes are shortened: a pair at the threshold then meets with the target probability."""
    depth = signature
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < target:
        depth -= 1
    return depth


def _shingles(batch: pa.RecordBatch, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram ids of each text; a shorter text is one n-gram, an empty one none."""
    words = Words(batch.column(batch.schema.get_field_index("text")))
    ids = words.ids()
    grams, at = runs(ids, n, words.doc)
    bounds = np.searchsorted(at, words.first)
    for i in range(batch.num_rows):
        own = grams[bounds[i] : bounds[i + 1]]
        a, b = words.first[i], words.first[i + 1]
        if not len(own) and b > a:
            own, _ = runs(ids[a:b], int(b - a), np.zeros(b - a), seed=int(b - a) + 100)
        yield np.unique(own)


def _set_id(grams: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        return int(signed(mix(np.array([mix(grams).sum(dtype=np.uint64) + np.uint64(len(grams))], np.uint64)))[0])


def _sketches(n: int, trees: int, signature: int, shortest: int):
    """Per text its n-gram set's id and size, the label of its shortest prefix in each tree, and its sketch.

    The sketch has the bytes of tree 0's signature, then tree 1's and so on.
    """
    factors = seeded(trees * signature, 11) | np.uint64(1)
    shifts = seeded(trees * signature, 12)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = list(_shingles(batch, n))
            sizes = np.array([len(s) for s in sets])
            full = np.flatnonzero(sizes)
            least = np.zeros((len(sets), trees * signature), np.uint64)
            if len(full):
                flat = np.concatenate([sets[i] for i in full])
                starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
                for j in range(trees * signature):
                    least[full, j] = np.minimum.reduceat(flat * factors[j] + shifts[j], starts)
            labels = np.zeros((len(sets), trees), np.uint64)
            for d in range(shortest):
                labels = mix(labels * np.uint64(31) + least[:, d::signature])
            sketch = (mix(least) >> np.uint64(56)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([_set_id(s) for s in sets], pa.int64()),
                    pa.array(sizes, pa.int32()),
                    pa.array(list(signed(np.ascontiguousarray(labels))), pa.list_(pa.int64())),
                    pa.array([row.tobytes() for row in sketch], pa.binary()),
                ],
                names=["key", "tk", "id", "n", "labels", "sketch"],
            )

    return run


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal keys of a sorted partition, each as one table; a run may span batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            now = tuple(c[a] for c in columns)
            if now != last and held:
                yield pa.Table.from_batches(held)
                held = []
            last = now
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _dealt(rows: DataFrame, keys: list[str], size: str, block: int, order: tuple = ()) -> DataFrame:
    """Rows by group; a group above ``block`` rows goes to every pair of its blocks.

    Adds ``i`` and ``j``, the pair, and ``own``, the row's block. A small group is one pair. Rows of a
    pair are sorted by ``order``.
    """
    blocks = F.ceil(F.col(size) / float(block)).cast("int")
    own = F.pmod(F.xxhash64("id", F.lit(5)), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    return (
        rows.withColumn("own", own)
        .withColumn("other", other)
        .withColumn("i", F.least("own", "other"))
        .withColumn("j", F.greatest("own", "other"))
        .drop("other", size)
        .repartition(*keys, "i", "j")
        .sortWithinPartitions(*keys, "i", "j", *order)
    )


def _joined_in_trie(path: np.ndarray, sketch: np.ndarray, needed: int) -> np.ndarray:
    """The cluster of each class of a subtree: the first row it is connected with by like sketches.

    ``path`` has the rows' signatures below the subtree's own prefix, sorted. Nodes are taken from the
    deepest to the root; in a node, classes of different children and clusters are compared.
    """
    n = len(path)
    shared = np.minimum.accumulate(path[1:] == path[:-1], axis=1).sum(1)
    cluster, child = np.arange(n), np.arange(n)
    for depth in np.unique(shared)[::-1]:
        opens = np.concatenate([[True], shared < depth])
        starts = np.flatnonzero(opens)
        for a, b in zip(starts, np.append(starts[1:], n)):
            if b - a > 1 and (cluster[a:b] != cluster[a]).any():
                _connect(np.arange(a, b), cluster, child, sketch, needed)
        child = np.cumsum(opens)
    return cluster


def _connect(left: np.ndarray, cluster: np.ndarray, child: np.ndarray, sketch: np.ndarray, needed: int) -> None:
    """Unites the clusters of a node's rows that have rows alike in different children."""
    while len(left):
        own = cluster[left] == cluster[left[0]]
        name, grown = cluster[left[0]], left[own]
        queue, left = grown.tolist(), left[~own]
        while queue and len(left):
            at = queue.pop()
            other = left[child[left] != child[at]]
            alike = other[(sketch[other] == sketch[at]).sum(1) >= needed]
            if len(alike):
                come = np.isin(cluster[left], cluster[alike])
                queue += left[come].tolist()
                cluster[left[come]], left = name, left[~come]


def _alike(signature: int, needed: int):
    """Links of the clusters of each subtree, from a cluster's smallest id to its others.

    Subtrees with the same members thus give the same links, whatever their tree.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for group in _groups(batches, ["tree", "label", "i", "j"]):
            ids = group.column("id").to_numpy()
            sketch = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint8).reshape(len(ids), -1)
            tree = group.column("tree")[0].as_py()
            cluster = _joined_in_trie(sketch[:, tree * signature : (tree + 1) * signature], sketch, needed)
            _, number = np.unique(cluster, return_inverse=True)
            least = np.full(number.max() + 1, np.iinfo(np.int64).max)
            np.minimum.at(least, number, ids)
            to = least[number]
            a += to[to != ids].tolist()
            b += ids[to != ids].tolist()
            if len(a) > 50_000:
                yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
                a, b = [], []
        yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """How many n-grams each two sets share, as a matrix.

    Only n-grams of two sets or more are columns; they are taken some thousands at a time.
    """
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(times > 1) - 1
    shared = times[column] > 1
    owner, column = owner[shared], number[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(sets), len(sets)), np.float64)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
        lo, hi = np.searchsorted(column, [start, start + _COLUMNS])
        dense = np.zeros((len(sets), _COLUMNS), np.float32)
        dense[owner[lo:hi], column[lo:hi] - start] = 1
        out += dense @ dense.T
    return out


def _verified(threshold: float):
    """Per class: links found in this group, as documents and classes, and a root to join."""
    ratio = Fraction(threshold).limit_denominator(10_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["root", "i", "j"]):
            ids, first = np.unique(group.column("id").to_numpy(), return_index=True)
            group = group.take(pa.array(first))
            own, m = group.column("own").to_numpy(), group.column("m").to_numpy()
            sets = [np.asarray(x, np.int64) for x in group.column("grams").to_numpy()]
            size = np.array([len(s) for s in sets])
            both = _common(sets)
            linked = ratio.denominator * both >= ratio.numerator * (size[:, None] + size[None, :] - both)
            np.fill_diagonal(linked, False)
            if group.column("i")[0] != group.column("j")[0]:
                linked &= own[:, None] != own[None, :]
            rows = linked.any(1)
            to = np.where(rows, ids[np.argmax(linked, 1)], ids)
            yield pa.RecordBatch.from_pydict(
                {
                    "id": pa.array(ids[rows]),
                    "to": pa.array(to[rows]),
                    "documents": pa.array((linked @ m)[rows].astype(np.int64)),
                    "classes": pa.array(linked.sum(1)[rows].astype(np.int64)),
                }
            )
            # The first partner of each need not connect all: add a chain along the links.
            a, b = _spanning(linked)
            if len(a):
                none = np.zeros(len(a), np.int64)
                yield pa.RecordBatch.from_pydict(
                    {"id": pa.array(ids[a]), "to": pa.array(ids[b]), "documents": pa.array(none), "classes": pa.array(none)}
                )

    return run


def _spanning(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of a link matrix."""
    a, b, left = [], [], np.arange(len(linked))
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = linked[at, left]
            found = left[near]
            a += [at] * len(found)
            b += found.tolist()
            queue += found.tolist()
            left = left[~near]
    return np.array(a, np.int64), np.array(b, np.int64)


def joined(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``(key, class_id, copy_id, n_links, n_linked_texts)`` per row of ``docs``.

    ``class_id`` is the smallest key among all rows connected by links, ``copy_id`` that among
    rows with an equal n-gram set, ``n_links`` counts the other rows with similarity at or above
    the threshold, ``n_linked_texts`` the other n-gram sets. A text of fewer than ``n`` words is
    one n-gram. Null and empty texts have no n-grams: they are copies of each other and linked to
    nothing else. Rows with a null key take part; repeated rows are copies.
    """
    return _classed(docs, key, text, **options).select(
        F.col("key").alias(key), F.col("first.key").alias("class_id"), F.col("rep.key").alias("copy_id"), "n_links", "n_linked_texts"
    )


def _text_hash(text: str):
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _classed(
    docs: DataFrame, key: str, text: str, n: int = NGRAM, threshold: float = THRESHOLD, target: float = TARGET_RECALL
) -> DataFrame:
    """``(key, tk, rep, first, n_links, n_linked_texts)`` per row; ``tk`` is a hash of the text.

    ``rep`` and ``first`` are the rows that stand for the n-gram set and for the class, as
    ``(none, key, tk)``: the smallest key, null after all, then the smallest hash.
    """
    shortest = shortest_prefix(threshold, target=target)
    values = TREES * SIGNATURE
    needed = int(values * threshold - DEVIATIONS * (values * threshold * (1 - threshold)) ** 0.5)
    rows = small_batches(docs).select(F.col(key).alias("key"), _text_hash(text).alias("tk"), F.col(text).alias("text"))
    key_type = rows.schema["key"].dataType.simpleString()
    sketches = stored(
        rows.mapInArrow(
            _sketches(n, TREES, SIGNATURE, shortest), f"key {key_type}, tk bigint, id bigint, n int, labels array<bigint>, sketch binary"
        ),
        "sketches",
    )
    classes = stored(
        sketches.groupBy("id").agg(
            F.min(F.struct(F.col("key").isNull().alias("none"), "key", "tk")).alias("rep"), F.count("*").alias("m"), F.first(F.struct("n", "labels", "sketch")).alias("s")
        ),
        "classes",
    )
    placed = classes.where("s.n > 0").select("id", F.posexplode("s.labels").alias("tree", "label"))
    crowded = placed.groupBy("tree", "label").agg(F.count("*").alias("n_node")).where("n_node > 1")
    met = stored(placed.join(crowded, ["tree", "label"]), "nodes")
    members = met.join(classes.select("id", "s.sketch"), "id")
    path = F.expr(f"substring(sketch, tree * {SIGNATURE} + 1, {SIGNATURE})")
    links = _dealt(members, ["tree", "label"], "n_node", NODE_BLOCK, (path,)).mapInArrow(
        _alike(SIGNATURE, needed), "a bigint, b bigint"
    )
    clusters = components(links)
    sized = clusters.groupBy("root").agg(F.count("*").alias("n_cluster"))
    chosen = stored(
        clusters.join(sized, "root").join(classes.select("id", "m", "rep"), "id"), "clusters"
    )
    side = small_side(chosen)
    picked = rows.join(side, rows["key"].eqNullSafe(side["rep.key"]) & (rows["tk"] == side["rep.tk"])).select(
        "id", "text", "root", "n_cluster", F.col("m").cast("bigint").alias("m")
    )

    def with_grams(batches):
        for batch in slices(batches, "text"):
            sets = list(_shingles(batch, n))
            ids = np.array([_set_id(s) for s in sets])
            keep = pa.array(ids == batch.column(0).to_numpy())
            table = pa.RecordBatch.from_arrays(
                [batch.column(0), *[batch.column(k) for k in (2, 3, 4)], pa.array([signed(s) for s in sets], pa.list_(pa.int64()))],
                names=["id", "root", "n_cluster", "m", "grams"],
            )
            yield table.filter(keep)

    grams = picked.mapInArrow(with_grams, "id bigint, root bigint, n_cluster bigint, m bigint, grams array<bigint>")
    found = stored(
        _dealt(grams, ["root"], "n_cluster", CLUSTER_BLOCK).mapInArrow(
            _verified(threshold), "id bigint, to bigint, documents bigint, classes bigint"
        ),
        "verified",
    )
    groups = components(found.select(F.col("id").alias("a"), F.col("to").alias("b")))
    lowest = (
        groups.join(classes.select("id", "rep"), "id").groupBy("root").agg(F.min("rep").alias("first"))
    )
    counts = found.groupBy("id").agg(F.sum("documents").alias("documents"), F.sum("classes").alias("classes"))
    per_class = groups.join(lowest, "root").join(counts, "id").select("id", "first", "documents", "classes")
    table = stored(
        classes.join(per_class, "id", "left").select(
            "id",
            "rep",
            F.coalesce("first", "rep").alias("first"),
            (F.col("m") - 1 + F.coalesce("documents", F.lit(0))).alias("n_links"),
            F.coalesce("classes", F.lit(0)).alias("n_linked_texts"),
        ),
        "near-classes",
    )
    return sketches.select("key", "tk", "id").join(table, "id").select(
        "key", "tk", "rep", "first", "n_links", "n_linked_texts"
    )


def first_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each class one row stays.

    It is the one with the smallest key, a null key after all others, then the smallest hash of
    the text; of rows that repeat it, one. Texts do not move unless the keys of what goes, or of
    what is repeated, outgrow a broadcast. Null and empty texts are one class.
    """
    found = _classed(docs, key, text).where("n_links > 0")
    other = ~(F.col("key").eqNullSafe(F.col("first.key")) & (F.col("tk") == F.col("first.tk")))
    gone = small_side(stored(found.where(other).select("key", "tk").distinct(), "duplicates"))
    again = found.where(~other).groupBy("key", "tk").agg(F.count("*").alias("times")).where("times > 1")
    twice = small_side(stored(again.select("key", "tk"), "repeated"))
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(key).alias("key"), _text_hash(text).alias("tk"))

    def same(side: DataFrame):
        return rows["key"].eqNullSafe(side["key"]) & (rows["tk"] == side["tk"])

    left = rows.join(gone, same(gone), "left_anti")
    once = left.join(twice, same(twice), "left_semi").dropDuplicates(["key", "tk"])
    return left.join(twice, same(twice), "left_anti").unionByName(once).select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    return joined(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
