"""Lattice points against the definition, links and components against all pairs."""

import math

import numpy as np
import pyarrow as pa
from glyphmill.llm import lattice


def test_nearest_point():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((400, 8)) * 2
    found = lattice.nearest_e8(x)
    twice = (2 * found).astype(int)
    assert np.allclose(twice, 2 * found)
    assert ((twice % 2 == 0).all(1) | (twice % 2 == 1).all(1)).all() and (found.sum(1) % 2 == 0).all()
    # No other lattice point nearby is closer: a point is nearest if no neighbour of norm 2 or 4 is.
    roots = lattice.roots()
    assert len(np.unique(roots, axis=0)) == 240 and np.allclose((roots**2).sum(1), 2)
    steps = np.unique(np.concatenate([roots, (roots[:, None] + roots[None]).reshape(-1, 8)]), axis=0)
    own = ((x - found) ** 2).sum(1)
    for k, point in enumerate(found):
        assert own[k] <= ((x[k] - point - steps) ** 2).sum(1).min() + 1e-9


def brute(ids, vecs, threshold=0.95):
    """Links and smallest connected ids of all pairs; ids may be None."""
    n = len(ids)
    good = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for v in vecs]
    links, label = [0] * n, list(range(n))
    scaled = [np.array(v, float) / np.abs(np.array(v, float)).max() if g else None for v, g in zip(vecs, good)]
    units = [v / np.linalg.norm(v) if g else None for v, g in zip(scaled, good)]

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for a in range(n):
        for b in range(a):
            if good[a] and good[b] and len(units[a]) == len(units[b]) and units[a] @ units[b] >= threshold:
                links[a] += 1
                links[b] += 1
                label[top(a)] = top(b)
    smallest = {}
    for i in range(n):
        if ids[i] is not None:
            smallest[top(i)] = min(smallest.get(top(i), ids[i]), ids[i])
    return [(links[i], smallest.get(top(i))) for i in range(n)]


def near(rng, x, cos):
    x = np.asarray(x, float) / np.linalg.norm(x)
    z = rng.standard_normal(len(x))
    z -= (z @ x) * x
    return cos * x + math.sqrt(1 - cos * cos) * z / np.linalg.norm(z)


def run(spark, ids, vecs, **options):
    data = [(i, k, None if v is None else [None if x is None else float(x) for x in v], 1, "x") for i, (k, v) in enumerate(zip(ids, vecs))]
    df = spark.createDataFrame(data, "place long, vec_id long, embedding array<double>, n long, key string")
    out = lattice.linked(df, **options).collect()
    assert len(out) == len(ids)
    return {r.row.place: (r.n_links, r.component_id, r.kept) for r in out}


def test_planted_rows(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((120, 24))
    vecs = [*base, *[near(rng, base[i], 0.97 + 0.0002 * i) for i in range(60)], *[base[3] * 2] * 3, *[base[5]] * 4]
    vecs += [None, [], [0.0] * 24, [float("nan")] + [1.0] * 23, [float("inf")] * 24, [None] + [1.0] * 23, [1.0], [2.0], [-1.0], [1e200] * 24, [1e-200] * 24]
    chain = [base[50]]
    for _ in range(5):
        chain.append(near(rng, chain[-1], 0.96))
    vecs += chain[1:]
    ids = [1000 - i for i in range(len(vecs))]
    ids[150], ids[151], ids[0] = None, 7, 7
    want, got = brute(ids, vecs), run(spark, ids, vecs, recall=0.9999)
    for place, (links, smallest) in enumerate(want):
        assert got[place] == (links, smallest, ids[place] == smallest), place


def test_large_cell_is_cut(spark, monkeypatch):
    """One group of near copies across many blocks of a cell: every link counted once."""
    rng = np.random.default_rng(3)
    centre = rng.standard_normal(16)
    vecs = [near(rng, centre, 0.9999) for _ in range(150)] + [centre] * 20 + list(rng.standard_normal((50, 16)))
    ids = list(range(len(vecs)))
    for block, rows, small in ((16, 200, 4), (2048, 20_000, 24), (16, 100, 1000)):
        monkeypatch.setattr(lattice, "CELL_BLOCK", block)
        monkeypatch.setattr(lattice, "TASK_ROWS", rows)
        monkeypatch.setattr(lattice, "SMALL_CELL", small)
        got = run(spark, ids, vecs)
        assert [got[i][:2] for i in ids] == brute(ids, vecs)


def test_recall_at_the_threshold(spark):
    """Pairs just above the threshold, among the driver's own vectors."""
    rng = np.random.default_rng(4)
    own = [r.embedding for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    vecs = [*own, *[near(rng, v, 0.9501) for v in own]]
    got = run(spark, range(len(vecs)), vecs)
    x = np.array(vecs)
    x /= np.linalg.norm(x, axis=1)[:, None]
    want = (x @ x.T >= 0.95).sum(1) - 1
    found = np.array([got[i][0] for i in range(len(vecs))])
    assert (found <= want).all() and found.sum() >= 0.98 * want.sum(), (found.sum(), want.sum())


def test_query_and_empty_table(spark):
    rows = lattice.query(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 500 and all(r.n_links == 0 and r.component_id == r.vec_id and r.kept for r in rows)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert lattice.linked(empty).count() == 0


def test_rates():
    assert 0.99 < 1 - (1 - lattice.meeting_rate(0.95, 3, 4)) ** lattice.tables_for(0.95, 3, 4) < 1
    assert [lattice.blocks_for(n) for n in (0, 100, 10**6, 10**9, 10**11)] == [3, 3, 3, 4, 5]
    assert lattice.smallest_connected(6, np.array([5, 3]), np.array([3, 1])).tolist() == [0, 1, 2, 1, 4, 1]
    x = pa.array([[3.0, 4.0], [1.0], [0.0, 2.0]])
    assert [(a.tolist(), u.tolist()) for a, u in lattice.unit_rows(x)] == [([1], [[1.0]]), ([0, 2], [[0.6, 0.8], [0.0, 1.0]])]
