"""Near duplicates among vectors by cells of the E8 lattice.

Every table projects the unit vectors at random to some blocks of eight coordinates and takes the
nearest point of the E8 lattice in each; the points together are the vector's cell. A vector
lives in its own cell and also looks into the cells most easily reached by moving one block to a
neighbouring lattice point. Two vectors meet where one looks into the cell the other lives in; what
meets is verified by the cosine in doubles. The number of tables is what the recall asked for needs
at the very threshold, so pairs above it are found more surely.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from glyphmill.llm.components import components
from glyphmill.llm.plan import small_batches, stored
from glyphmill.llm.tokens import mix, seeded

THRESHOLD = 0.95
#: The chance of finding a pair that is exactly at the threshold.
RECALL = 0.995
#: Lattice points lie this far apart, in units of which a projected unit vector is about one long.
SCALE = 0.8
#: Neighbouring cells a vector looks into, besides its own, in each table.
PROBES = 4
#: Blocks of eight coordinates at least; more for more vectors, see ``blocks_for``.
BLOCKS = 3
#: Members of a cell that are compared in one task; larger cells are cut, and cut with cut compared.
CELL_BLOCK = 2048
#: About so many members of cells are verified together.
TASK_ROWS = 20_000
#: Cells of fewer members are compared pair by pair, many cells at once.
SMALL_CELL = 24
_PAIRS = 1 << 15


def roots() -> np.ndarray:
    """The 240 shortest vectors of E8: what leads to a neighbouring lattice point."""
    pairs = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            row = np.zeros(8)
            row[i], row[j] = a, b
            pairs.append(row)
    halves = [s for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array([*pairs, *halves])


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Integers of even sum: the coordinate that rounding moved most goes the other way if need be."""
    near = np.rint(x)
    off = x - near
    worst = np.abs(off).argmax(1)
    at = np.arange(len(x))
    odd = near.sum(1).astype(np.int64) & 1
    near[at, worst] += np.where(off[at, worst] >= 0, 1, -1) * odd
    return near


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """The nearest lattice point of each row: of D8, or of D8 moved by a half in all coordinates."""
    whole, half = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1)
    return np.where(closer[:, None], whole, half)


class Cells:
    """Cells of vectors as 64-bit codes: per table a vector's own cell, then those it looks into."""

    def __init__(self, tables: int, blocks: int = BLOCKS, probes: int = PROBES, scale: float = SCALE, seed: int = 1):
        self.tables, self.blocks, self.probes, self.scale, self.seed = tables, blocks, probes, scale, seed
        self.roots = roots()
        n = tables * blocks * 8
        self.factors = (seeded(n, seed) | np.uint64(1)).reshape(tables, blocks, 8)
        twice = (2 * self.roots).astype(np.int64).view(np.uint64)
        # What a step to each neighbour adds to a code before it is mixed.
        self.steps = (twice[None, None] * self.factors[:, :, None]).sum(3)
        self.salts = seeded(tables, seed + 1)
        self.projections: dict[int, np.ndarray] = {}

    def projection(self, dim: int) -> np.ndarray:
        if dim not in self.projections:
            draws = np.random.Generator(np.random.PCG64([self.seed, dim])).standard_normal((dim, self.tables * self.blocks * 8))
            self.projections[dim] = draws / math.sqrt(8)
        return self.projections[dim]

    def of_projected(self, x: np.ndarray, dim: int) -> np.ndarray:
        """Codes of rows already projected: ``(rows, tables, 1 + probes)``."""
        n = len(x)
        x = x.reshape(n * self.tables * self.blocks, 8) / self.scale
        points = nearest_e8(x)
        # The shorter the way to a neighbour, the more of the offset lies along the root.
        along = ((x - points) @ self.roots.T).reshape(n, self.tables, -1)
        best = np.argpartition(-along, self.probes, axis=2)[:, :, : self.probes] if self.probes else np.zeros((n, self.tables, 0), int)
        points = (2 * points).astype(np.int64).view(np.uint64).reshape(n, self.tables, self.blocks, 8)
        own = (points * self.factors).sum((2, 3)) + self.salts + np.uint64(dim)
        moved = self.steps.reshape(self.tables, -1)[np.arange(self.tables)[None, :, None], best]
        return mix(np.concatenate([own[:, :, None], own[:, :, None] + moved], axis=2))

    def of(self, units: np.ndarray) -> np.ndarray:
        """Codes of unit vectors of one dimension."""
        p = self.projection(units.shape[1])
        parts = [self.of_projected(units[i : i + 256] @ p, units.shape[1]) for i in range(0, len(units), 256)]
        return np.concatenate(parts) if parts else np.zeros((0, self.tables, 1 + self.probes), np.uint64)


def meeting_rate(threshold: float, blocks: int, probes: int, scale: float = SCALE, trials: int = 20_000) -> float:
    """How often two vectors of that cosine meet in one table: a simulation, the same on every run."""
    rng = np.random.Generator(np.random.PCG64(5))
    x, z = rng.standard_normal((2, trials, 8 * blocks)) / math.sqrt(8)
    y = threshold * x + math.sqrt(1 - threshold**2) * z
    cells = Cells(1, blocks, probes, scale)
    a, b = (np.concatenate([cells.of_projected(v[i : i + 1000], 0)[:, 0] for i in range(0, trials, 1000)]) for v in (x, y))
    return float(((a == b[:, :1]).any(1) | (b == a[:, :1]).any(1)).mean())


def tables_for(threshold: float, blocks: int, probes: int, recall: float = RECALL) -> int:
    rate = meeting_rate(threshold, blocks, probes)
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - min(rate, 1 - 1e-9))))


def blocks_for(rows: int) -> int:
    """Blocks that keep chance meetings of unlike vectors to hundreds a vector, for any number of rows.

    Unlike vectors share a block's lattice point about once in 64 times.
    """
    return max(BLOCKS, math.ceil(math.log(max(rows, 1) / 100) / math.log(64)) if rows > 100 else BLOCKS)


def unit_rows(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Unit vectors of an Arrow column of lists, as (row numbers, matrix) for each dimension."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False).astype(float)
    sizes = np.diff(offsets)
    out = []
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        x = values[offsets[at][:, None] + np.arange(dim)]
        # By the largest component first: squares of huge or tiny numbers stay in range.
        x = x / np.abs(x).max(1, keepdims=True)
        out.append((at, x / np.sqrt((x * x).sum(1, keepdims=True))))
    return out


def _coded(cells: Cells) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = cells.tables * (1 + cells.probes)
        for batch in batches:
            codes = np.zeros((batch.num_rows, width), np.uint64)
            for at, units in unit_rows(batch.column(batch.schema.get_field_index("vec"))):
                codes[at] = cells.of(units).reshape(len(at), width)
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * width)
            lists = pa.ListArray.from_arrays(offsets, pa.array(codes.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "codes"])

    return run


def first_meetings(x: np.ndarray, y: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Whether each pair meets in the cell ``code`` before any other.

    ``x`` and ``y`` are the pairs' codes, ``(pairs, tables, 1 + probes)``. The first table in which
    one looks into the other's own cell counts, and there the smaller of the cells they meet in.
    """
    most = np.iinfo(np.int64).max
    first = np.zeros(len(code), bool)
    left = np.arange(len(code))
    for t in range(x.shape[1]):
        a, b = x[left, t], y[left, t]
        in_b = np.where((a == b[:, :1]).any(1), b[:, 0], most)
        in_a = np.where((b == a[:, :1]).any(1), a[:, 0], most)
        where = np.minimum(in_a, in_b)
        met = where != most
        first[left[met]] = where[met] == code[left[met]]
        left = left[~met]
        if not len(left):
            break
    return first


def smallest_connected(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` numbers the smallest one that the links ``a``-``b`` connect it with."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _pairs(begin: np.ndarray, count: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers ``a`` and their partners ``begin[a]`` onwards, about _PAIRS pairs at a time."""
    total = np.cumsum(count)
    start = 0
    while start < len(count):
        done = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, done + _PAIRS, "right")))
        part = np.arange(start, stop)
        a = np.repeat(part, count[part])
        yield a, begin[a] + np.arange(len(a)) - np.repeat(total[part] - count[part] - done, count[part])
        start = stop


def _verified(threshold: float, tables: int) -> Callable[[pa.Table], pa.Table]:
    """Members of cells to ``(key, links, root)``: copies linked with, and the first row connected."""

    def run(table: pa.Table) -> pa.Table:
        code, i, j, block = (table.column(c).to_numpy() for c in ("code", "i", "j", "block"))
        order = np.lexsort((block, j, i, code))
        table = table.take(order)
        code, i, j, block = code[order], i[order], j[order], block[order]
        n = len(code)
        resident = table.column("resident").to_numpy()
        weight = table.column("n").to_numpy()
        codes = table.column("codes").combine_chunks().values.to_numpy().reshape(n, tables, -1)
        units, dims, row_in = [], np.zeros(n, np.int64), np.zeros(n, np.int64)
        for at, x in unit_rows(table.column("vec")):
            dims[at], row_in[at] = len(units), np.arange(len(at))
            units.append(x)
        edge = np.flatnonzero((np.diff(code) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1
        starts = np.concatenate([[0], edge])
        ends = np.concatenate([edge, [n]])
        # Partners of a row: those after it in its cell, or the other block's rows for one of two blocks.
        begin = np.arange(1, n + 1)
        stop = np.repeat(ends, ends - starts)
        other = np.flatnonzero(i != j)
        if len(other):
            cell = np.repeat(np.arange(len(starts)), ends - starts)
            firsts = np.bincount(cell, weights=(block == i) & (i != j), minlength=len(starts)).astype(np.int64)
            begin[other] = (starts + firsts)[cell[other]]
            stop[other] = np.where(block[other] == i[other], stop[other], begin[other])
        links_a, links_b = [], []

        def keep(a: np.ndarray, b: np.ndarray) -> None:
            good = first_meetings(codes[a], codes[b], code[a])
            links_a.append(a[good])
            links_b.append(b[good])

        size = np.repeat(ends - starts, ends - starts)
        for a, b in _pairs(begin, np.where(size < SMALL_CELL, stop - begin, 0)):
            met = (resident[a] | resident[b]) & (dims[a] == dims[b])
            a, b = a[met], b[met]
            for d, x in enumerate(units):
                at = np.flatnonzero(dims[a] == d)
                near = np.einsum("ij,ij->i", x[row_in[a[at]]], x[row_in[b[at]]]) >= threshold
                keep(a[at[near]], b[at[near]])
        for s, e in zip(starts[ends - starts >= SMALL_CELL], ends[ends - starts >= SMALL_CELL]):
            for d in np.unique(dims[s:e]):
                rows = s + np.flatnonzero(dims[s:e] == d)
                x = units[d][row_in[rows]]
                for k in range(0, len(rows), 256):
                    at, near = np.nonzero(x[k : k + 256] @ x.T >= threshold)
                    a, b = rows[k + at], rows[near]
                    met = (b >= begin[a]) & (b < stop[a]) & (resident[a] | resident[b])
                    keep(a[met], b[met])
        a, b = (np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64) for x in (links_a, links_b))
        label = smallest_connected(n, a, b)
        links = np.bincount(a, weights=weight[b], minlength=n) + np.bincount(b, weights=weight[a], minlength=n)
        linked = np.flatnonzero(links > 0)
        keys = table.column("key").combine_chunks()
        return pa.table({"key": keys.take(linked), "links": links[linked].astype(np.int64), "root": keys.take(label[linked])})

    return run


def comparable(vec: Column) -> Column:
    """Whether a vector can have a cosine: no null, NaN or infinite component, and not all zero."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))
    return F.coalesce(F.forall(vec, fine) & F.exists(vec, lambda x: x != 0), F.lit(False))


def linked(vectors: DataFrame, key: str = "vec_id", vec: str = "embedding", threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """``(row, n_links, component_id, kept)``, one for each row of ``vectors``.

    Links join rows whose vectors have a cosine of ``threshold`` or more; vectors that are null,
    zero, empty or hold a null or non-finite component have none, and vectors of different
    lengths are never linked. Equal vectors are one class that is compared once; each of its rows counts
    the others. ``component_id`` is the smallest key that links reach, the row's own
    included, and ``kept`` says whether that is the row's own. A null key is larger than any other.
    Repeated keys are rows of their own. ``row`` holds all columns, whatever their names; an empty
    table gives an empty one.
    """
    rows = vectors.select(
        F.struct(*[F.col(f"`{c}`") for c in vectors.columns]).alias("row"),
        F.col(f"`{key}`").alias("id"),
        F.when(comparable(F.col(f"`{vec}`").cast("array<double>")), F.col(f"`{vec}`").cast("array<double>")).alias("vec"),
    ).withColumns({"k1": F.xxhash64("vec"), "k2": F.xxhash64(F.lit("k2"), "vec")})
    known = F.col("vec").isNotNull()
    # A class is known by its smallest key, and by its hash where keys repeat; null keys come last.
    classes = stored(
        rows.where(known)
        .groupBy("k1", "k2")
        .agg(F.min("id").alias("id"), F.count("*").alias("n"), F.any_value("vec").alias("vec"))
        .select(F.struct(F.col("id").isNull().alias("lost"), "id", "k1", "k2").alias("key"), "n", "vec"),
        "vector-classes",
    )
    blocks = blocks_for(classes.count())
    tables = tables_for(threshold, blocks, PROBES, recall)
    cells = Cells(tables, blocks)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema)
    coded = stored(small_batches(classes).mapInArrow(_coded(cells), f"{schema}, codes array<bigint>"), "vector-cells")

    # Cells with at least two members, one of them at home there; all others link nothing.
    members = coded.select("key", F.posexplode("codes").alias("place", "code")).select(
        "key", "code", (F.col("place") % (1 + PROBES) == 0).alias("resident")
    )
    sizes = members.groupBy("code").agg(F.count("*").alias("size"), F.count_if("resident").alias("homes"))
    sizes = sizes.where("size > 1 AND homes > 0").select("code", "size")
    parts = F.ceil(F.col("size") / CELL_BLOCK).cast("int")
    dealt = (
        members.join(sizes, "code")
        .select("code", "key", "resident", parts.alias("parts"))
        .withColumn("block", F.pmod(F.xxhash64("key"), "parts").cast("int"))
        .select("code", "key", "resident", "block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("with"))
        .select("code", "key", "resident", "block", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"))
    )
    dealt = stored(dealt, "cell-members")
    buckets = max(1, math.ceil(dealt.count() / TASK_ROWS))
    found = stored(
        dealt.join(coded, "key")
        .withColumn("bucket", F.pmod(F.xxhash64("code", "i", "j"), F.lit(buckets)))
        .groupBy("bucket")
        .applyInArrow(_verified(threshold, tables), f"key {coded.schema['key'].dataType.simpleString()}, links bigint, root {coded.schema['key'].dataType.simpleString()}"),
        "vector-links",
    )
    roots_of = components(found.select(F.col("key").alias("a"), F.col("root").alias("b")))
    results = (
        classes.select("key", "n")
        .join(found.groupBy("key").agg(F.sum("links").alias("links")), "key", "left")
        .join(roots_of.select(F.col("id").alias("key"), "root"), "key", "left")
        .select(
            "key.k1",
            "key.k2",
            (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("root.id", "key.id").alias("component_id"),
        )
    )
    keyed = rows.select("row", "id", F.when(known, F.col("k1")).alias("k1"), F.when(known, F.col("k2")).alias("k2"))
    component = F.when(F.col("k1").isNotNull(), F.col("component_id")).otherwise(F.col("id"))
    return keyed.join(results, ["k1", "k2"], "left").select(
        "row",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return linked(vectors).select("row.vec_id", "n_links", "component_id", "kept")
