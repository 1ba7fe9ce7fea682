"""Approximate nearest neighbours by an adaptive dimension scan.

Vectors are rotated at random and kept in lists around centroids that were fitted on a bounded
sample; every vector is indexed. A query probes the lists of the best centroids. Within a list the
rotated coordinates are read in column blocks: after each block the squared distance so far is
tested against the distance that the query's k-th best known score allows, as a random projection
would show it (factor ``1 + eps / sqrt(d)``); candidates that fail are abandoned, and rows that no
query keeps leave the scan. Survivors are scored exactly on the original vectors. The k-th best
score among the sample's rows in the probed lists is each query's first bound: it is tight from
the first block, and the ``k`` rows behind it are found in any case.

Lists are cut into chunks of rows and queries into blocks, so a list with a third of all vectors
is many bounded tasks; only each query's best ``k`` per task leave it.

Vectors that are null, empty, zero or hold null or non-finite components take no part, as query
or candidate. Queries meet vectors of their own length only, and never rows of their own id; ties
go to the smaller id. Repeated rows are found as often as they stand there. Without candidates a
query has no row. Columns other than the id and the vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..plans.shapes import top_rows
from ..session import cut
from .vectors import matrix, rotate, usable


class Model:
    """Centroids and a sample of one vector length, in rotated coordinates, and how many lists to
    probe: so many that the sample's own nearest neighbours are found to the part ``recall``."""

    def __init__(self, ids: np.ndarray, sample: np.ndarray, lists: int, k: int, recall: float,
                 seed: int = 5):
        self.ids, self.raw = ids, sample
        x = rotate(sample)
        rng = np.random.default_rng(seed)
        lists = max(1, min(lists, len(x) // 128))
        centers = x[rng.permutation(len(x))[:lists]]
        for _ in range(10):
            near = _nearest(x, centers)
            size = np.bincount(near, minlength=lists)
            total = np.zeros_like(centers)
            np.add.at(total, near, x)
            centers = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centers)
        self.centers = centers
        near, deep = _nearest(x, centers), []
        self.lists = near
        for at in range(0, min(len(x), 1024), 256):
            q = x[at:at + 256]
            score = q @ x.T
            score[ids[at:at + 256][:, None] == ids] = -np.inf
            best = np.argsort(-score, axis=1)[:, :k]
            place = np.argsort(np.argsort(-(q @ centers.T), axis=1), axis=1)
            deep.append(np.take_along_axis(place, near[best], axis=1).ravel())
        self.probes = 1 + int(np.quantile(np.concatenate(deep), recall, method="higher"))


def _nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return ((centers * centers).sum(axis=1) - 2 * (x @ centers.T)).argmin(axis=1)


def _fit(rows: DataFrame, sample: int, lists: int, k: int, recall: float) -> dict[int, Model]:
    """Models by vector length from the ``sample`` rows of least hash: a bounded number."""
    got = (rows.withColumn("_h", F.xxhash64("vec_id", "vec")).orderBy("_h", "vec_id")
           .limit(sample).select("vec_id", "dim", "vec").collect())
    out = {}
    for dim in sorted({r.dim for r in got}):
        own = [r for r in got if r.dim == dim]
        x = np.frombuffer(b"".join(bytes(r.vec) for r in own)).reshape(-1, dim)
        ids = np.array([np.iinfo("int64").min if r.vec_id is None else r.vec_id for r in own])
        out[dim] = Model(ids, x, lists, k, recall)
    return out


def _by_dim(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims):
            yield int(dim), batch.filter(pa.array(dims == dim))


def _place_rows(batches: Iterator[pa.RecordBatch], models: dict[int, Model]
                ) -> Iterator[pa.RecordBatch]:
    for dim, part in _by_dim(batches):
        lists = np.zeros(part.num_rows, "int64")
        if dim in models:
            lists = _nearest(rotate(matrix(part.column("vec"), dim)), models[dim].centers)
        yield pa.RecordBatch.from_arrays(
            [part.column("dim"), pa.array(lists.astype("int32")), part.column("vec_id"),
             part.column("vec")], ["dim", "list", "vec_id", "vec"])


def _place_queries(batches: Iterator[pa.RecordBatch], models: dict[int, Model], k: int
                   ) -> Iterator[pa.RecordBatch]:
    for dim, part in _by_dim(batches):
        n = part.num_rows
        floor, lists = np.full(n, -np.inf), np.zeros((n, 1), "int64")
        if dim in models:
            m = models[dim]
            raw = matrix(part.column("vec"), dim)
            ids = part.column("vec_id").to_numpy(zero_copy_only=False)
            lists = np.argsort(-(rotate(raw) @ m.centers.T), axis=1)[:, :m.probes]
            for at in range(0, n, 512):
                score = raw[at:at + 512] @ m.raw.T
                away = ~(lists[at:at + 512, :, None] == m.lists).any(axis=1)
                score[(ids[at:at + 512][:, None] == m.ids) | away] = -np.inf
                if score.shape[1] >= k:
                    floor[at:at + 512] = np.partition(score, -k, axis=1)[:, -k]
        floor = floor - 1e-9 * np.abs(np.where(np.isfinite(floor), floor, 0))
        rows = np.repeat(np.arange(n), lists.shape[1])
        take = part.take(pa.array(rows))
        yield pa.RecordBatch.from_arrays(
            [take.column("dim"), pa.array(lists.ravel().astype("int32")), take.column("vec_id"),
             pa.array(floor[rows]), take.column("vec")],
            ["dim", "list", "query_id", "floor", "vec"])


def scan(x: np.ndarray, q: np.ndarray, floor: np.ndarray, columns: int, eps: float
         ) -> tuple[np.ndarray, np.ndarray]:
    """``(query, row)`` that no test abandoned, from rotated rows and queries."""
    width = x.shape[1]
    budget = (q * q).sum(axis=1)[:, None] + (x * x).sum(axis=1) - 2 * floor[:, None]
    rows, so_far = np.arange(len(x)), np.zeros((len(q), len(x)))
    for lo in range(0, width, columns):
        hi = min(lo + columns, width)
        a, b = q[:, lo:hi], x[rows, lo:hi]
        so_far += (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)
        room = hi / width * (1 + eps / np.sqrt(hi)) ** 2 if hi < width else 1 + 1e-9
        alive = so_far <= budget * room + 1e-12
        some = alive.any(axis=0)
        so_far = np.where(alive, so_far, np.inf)
        if some.mean() < 0.8 or hi == width:
            rows, so_far, budget = rows[some], so_far[:, some], budget[:, some]
        if not rows.size:
            break
    found = np.nonzero(np.isfinite(so_far))
    return found[0], rows[found[1]]


def _search(queries: pa.Table, rows: pa.Table, k: int, columns: int, eps: float) -> pa.Table:
    names = ["query_id", "vec_id", "score"]
    types = [pa.int64(), pa.int64(), pa.float64()]
    if not queries.num_rows or not rows.num_rows:
        return pa.Table.from_arrays([pa.array([], t) for t in types], names)
    dim = rows.column("dim")[0].as_py()
    x_raw, q_raw = matrix(rows.column("vec"), dim), matrix(queries.column("vec"), dim)
    x, q = rotate(x_raw), rotate(q_raw)
    x_id, q_id = rows.column("vec_id").to_numpy(), queries.column("query_id").to_numpy()
    floor = queries.column("floor").to_numpy()
    parts = []
    for at in range(0, len(q), 128):
        a, b = scan(x, q[at:at + 128], floor[at:at + 128], columns, eps)
        a = a + at
        other = q_id[a] != x_id[b]
        a, b = a[other], b[other]
        score = np.concatenate([np.zeros(0), *[
            (q_raw[a[s:s + 65536]] * x_raw[b[s:s + 65536]]).sum(axis=1)
            for s in range(0, len(a), 65536)]])
        order = np.lexsort((x_id[b], -score, a))
        a, b, score = a[order], b[order], score[order]
        first = np.r_[True, a[1:] != a[:-1]] if a.size else np.zeros(0, bool)
        place = np.arange(len(a)) - np.maximum.accumulate(np.where(first, np.arange(len(a)), 0))
        best = place < k
        parts.append((q_id[a[best]], x_id[b[best]], score[best]))
    arrays = [np.concatenate([p[i] for p in parts]) for i in range(3)]
    return pa.Table.from_arrays([pa.array(v, t) for v, t in zip(arrays, types)], names)


def _blocks(df: DataFrame, size: int, name: str) -> DataFrame:
    return df.groupBy("dim", "list").agg(
        F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, *, sample: int = 4096,
            lists: int = 32, recall: float = 0.97, columns: int = 16, eps: float = 2.1,
            chunk: int = 4096, query_block: int = 2048) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` found of largest inner product per query.

    Both tables have ``vec_id`` and ``embedding``; ids should be unique among the queries.
    ``sample`` bounds the rows that centroids and first bounds are fitted on; ``recall`` is the
    part of the sample's own neighbours that the number of probed lists must reach."""
    rows = cut(usable(vectors).where(F.col("vec_id").isNotNull()))
    asked = cut(usable(queries).where(F.col("vec_id").isNotNull()))
    models = vectors.sparkSession.sparkContext.broadcast(_fit(rows, sample, lists, k, recall))
    placed = cut(rows.mapInArrow(lambda b: _place_rows(b, models.value),
                                 "dim int, list int, vec_id long, vec binary"))
    probing = cut(asked.mapInArrow(lambda b: _place_queries(b, models.value, k),
                                   "dim int, list int, query_id long, floor double, vec binary"))
    grid = _blocks(placed, chunk, "_nr").join(_blocks(probing, query_block, "_nq"),
                                              ["dim", "list"])
    def own(uid: str, n: str):
        return F.pmod(F.xxhash64(uid), F.col(n)).cast("int")

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = probing.join(grid, ["dim", "list"]).withColumn("_q", own("query_id", "_nq")) \
        .withColumn("_r", every("_nr")).drop("_nr", "_nq")
    right = placed.join(grid, ["dim", "list"]).withColumn("_r", own("vec_id", "_nr")) \
        .withColumn("_q", every("_nq")).drop("_nr", "_nq")
    keys = ["dim", "list", "_q", "_r"]
    local = (left.groupBy(*keys).cogroup(right.groupBy(*keys))
             .applyInArrow(lambda a, b: _search(a, b, k, columns, eps),
                           "query_id long, vec_id long, score double"))
    best = top_rows(local, ["query_id"], [F.desc("score"), F.asc("vec_id")], k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
