from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from perfspark.llm import ann, embeddup
from perfspark.llm.vectors import rotate

SCHEMA = "vec_id long, embedding array<float>, label int, list int, node long, dim string"
BAD = [None, [], [0.0, 0.0, 0.0], [1.0, None, 1.0], [float("nan"), 1.0, 1.0],
       [float("inf"), 1.0, 1.0]]


def _frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    data = [(i, None if v is None else [None if x is None else float(x) for x in v], 0, 1, 2, "x")
            for i, v in zip(ids, vectors, strict=True)]
    return spark.createDataFrame(data, SCHEMA)


def _clustered(n, dim, seed, spread=0.1):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(8, dim))
    out = centers[rng.integers(0, 8, n)] + spread * rng.normal(size=(n, dim))
    out[: n // 2] = rng.normal(size=(n // 2, dim))
    return out.astype("float32")


def test_rotation_keeps_distances_and_does_not_depend_on_the_batch():
    x = _clustered(50, 24, 1).astype("float64")
    y = rotate(x)
    assert np.allclose((y * y).sum(axis=1), (x * x).sum(axis=1))
    assert np.allclose(y @ y.T, x @ x.T)
    assert (rotate(x[7:9]) == y[7:9]).all()


@pytest.mark.parametrize(("dim", "chunk", "grid"), [(64, 4096, None), (20, 16, 2), (3, 8, 1)])
def test_links_against_brute_force(spark, dim, chunk, grid):
    x = _clustered(150, dim, dim, 0.12)
    x[10] = x[11] = x[12]
    x[13] = 3 * x[12]
    bad = BAD if dim == 3 else [None, [], [0.0] * dim]
    frame = _frame(spark, [*x.tolist(), *bad])
    got = {r.vec_id: r for r in embeddup.near_duplicates(frame, 0.95, chunk=chunk,
                                                         grid=grid).collect()}
    assert len(got) == len(x) + len(bad)
    u = x.astype("float64")
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    link = u @ u.T >= 0.95
    np.fill_diagonal(link, False)
    reach = np.linalg.matrix_power((link | np.eye(len(u), dtype=bool)).astype(float), 64) > 0
    assert [got[i].n_links for i in range(len(x))] == link.sum(axis=1).tolist()
    assert [got[i].component_id for i in range(len(x))] == reach.argmax(axis=1).tolist()
    for i in range(len(x), len(got)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)


@pytest.mark.parametrize("spread", [0.02, 0.12])
def test_close_pairs_of_chunks_tile_by_tile(spread, monkeypatch):
    """Few and many candidates, tiles that are left out and one of a single row."""
    monkeypatch.setattr(embeddup, "TILE", (16, 32))
    x = _clustered(161, 64, 5, spread)
    x = x[np.argsort(np.arange(161) % 8)]
    parts = [embeddup._Chunk(pa.py_buffer(v.tobytes()), 64, "float32", 16, 0.95)
             for v in (x[:80], x[80:])]
    got = set()
    for a, b, i, j in ((0, 0, 0, 0), (0, 1, 0, 80), (1, 1, 80, 80)):
        for s, t in embeddup._close(parts[a], parts[b], a == b, 0.95, 16):
            pairs = list(zip((s + i).tolist(), (t + j).tolist()))
            assert not got & set(pairs) and len(set(pairs)) == len(pairs)
            got |= set(pairs)
    u = x.astype("float64")
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    assert got == set(zip(*(v.tolist() for v in np.nonzero(np.triu(u @ u.T >= 0.95, 1)))))


def test_vectors_are_not_copied_for_each_pair_of_chunks(spark, monkeypatch):
    plans, cut = [], embeddup.cut
    monkeypatch.setattr(embeddup, "cut", lambda df: plans.append(
        df._jdf.queryExecution().executedPlan().toString()) or cut(df))
    x = _clustered(150, 16, 9)
    x[100:] = x[3]
    found = embeddup.near_duplicates(_frame(spark, x.tolist()), chunk=16)
    assert found.where("n_links >= 50").count() == 51
    met = [p for p in plans if "CartesianProduct" in p]
    assert len(met) == 1 and not any("Generate" in p or "Expand" in p for p in plans)
    assert met[0].count("Exchange") == 1 and "BroadcastExchange" not in met[0]


def test_vectors_of_other_lengths_meet_their_own(spark):
    """Lengths change inside a chunk's run, and doubles are not shortened to floats."""
    rng = np.random.default_rng(12)
    vectors = [(rng.normal(size=dim) * 1e-300 if i % 2 else rng.normal(size=dim)).tolist()
               for i, dim in enumerate([2, 3, 5, 8] * 12)]
    frame = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in embeddup.near_duplicates(frame, 0.8, chunk=7).collect()}
    units = [np.array(v) / np.abs(v).max() for v in vectors]
    units = [u / np.linalg.norm(u) for u in units]
    assert got == {i: sum(len(u) == len(v) and j != i and float(u @ v) >= 0.8
                          for j, v in enumerate(units)) for i, u in enumerate(units)}


def test_links_of_null_and_repeated_ids(spark):
    frame = _frame(spark, [[1, 0], [1, 0], [1, 0.01], [0, 1]], [None, 5, 5, 9])
    got = sorted(embeddup.near_duplicates(frame).select("vec_id", "n_links", "component_id")
                 .collect(), key=repr)
    assert [tuple(r) for r in got] == [(5, 2, 5), (5, 2, 5), (9, 0, 9), (None, 2, 5)]
    assert embeddup.near_duplicates(_frame(spark, [])).count() == 0


def test_neighbours_are_right_and_mostly_all(spark):
    x = _clustered(900, 32, 3) * np.random.default_rng(2).uniform(0.5, 2, (900, 1))
    x = x.astype("float32")
    x[5] = x[6] = x[7]
    frame = _frame(spark, [*x.tolist(), *[None, [], [0.0] * 32, [float("nan")] * 32]])
    asked = frame.where("vec_id % 20 = 0 or vec_id >= 900")
    got = {}
    for r in ann.nearest(frame, asked, k=10, sample=400, chunk=64, query_block=16).collect():
        got.setdefault(r.query_id, []).append(r)
    d = x.astype("float64")
    hits = 0
    for q in range(0, 900, 20):
        found = sorted(got[q], key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == list(range(1, 11))
        s = d @ d[q]
        assert np.allclose([r.score for r in found], [s[r.vec_id] for r in found])
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
        s[q] = -np.inf
        hits += len({r.vec_id for r in found} & set(np.lexsort((np.arange(900), -s))[:10]))
    assert set(got) == set(range(0, 900, 20))
    assert hits >= 0.9 * 10 * len(got)


def test_neighbours_of_small_and_empty_tables(spark):
    few = _frame(spark, [[1, 0], [1, 1], [1, 0], [1, 2, 3]], [0, 1, 2, 3])
    got = [tuple(r) for r in ann.nearest(few, few.where("vec_id = 0")).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0)]
    empty = _frame(spark, [])
    assert ann.nearest(empty, empty).count() == 0
    assert ann.nearest(few, empty).count() == 0


def test_scan_abandons_nothing_above_the_floor_when_tests_are_wide():
    rng = np.random.default_rng(4)
    x, q = rng.normal(size=(200, 32)), rng.normal(size=(20, 32))
    floor = np.sort(x @ q.T, axis=0)[-5]
    a, b = ann.scan(x, q, floor - 1e-9, 8, 50.0)
    kept = set(zip(a.tolist(), b.tolist()))
    s = q @ x.T
    assert {(i, j) for i in range(20) for j in range(200) if s[i, j] >= floor[i]} <= kept
