"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors within squared distance ``2 - 2 cos`` are, after a rotation, within a proportional
part of it in at least one block of ``block`` coordinates. Vectors are laid out along slabs of the
blocks' leading coordinates, as wide as a block's radius, and cut into chunks; chunks meet pair by
pair, once. There the rows of a tile of either side are range-joined block by block: a block whose
coordinates lie further apart in the two tiles than its budget is left out, in the others all
pairs are measured. What is within the budget of a block is verified with the exact cosine in
double precision. Nothing below the threshold links and no close pair is lost.

Equal vectors are one row with a count. A chunk is one row of a table; a cartesian product streams
that table past itself, so disk grows with the vectors and not with their pairs, and a task holds
a few chunks. It gives out a link count per vector and spanning links, never the pairs.

Null, empty and zero vectors and those with a null or non-finite component link with nothing;
vectors of other lengths are compared among themselves. Rows with a null or repeated id are rows
like others; a component's id is the least id in it that is not null.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import cut
from .common import components, forest
from .vectors import matrix, rotate, usable

#: Room for the rounding of rotated coordinates; verification is exact.
ROOM = 1e-6


def _units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


@cache
def _rotation(dim: int) -> np.ndarray:
    return rotate(np.eye(dim))


def _turn(x: np.ndarray) -> np.ndarray:
    """``rotate``, as one product where the matrix is small."""
    return x @ _rotation(x.shape[1]) if x.shape[1] <= 512 else rotate(x)


def _blocks(width: int, block: int, cosine: float) -> list[tuple[int, int, float]]:
    """``(first, last, budget)`` of each block."""
    whole = 2 - 2 * cosine + ROOM
    edges = [*range(0, width, block), width]
    return [(a, b, whole * (b - a) / width) for a, b in zip(edges, edges[1:])]


def _slabs(batches: Iterator[pa.RecordBatch], cosine: float, block: int, grid: int, kind: str
           ) -> Iterator[pa.RecordBatch]:
    """Adds ``cell``: the slabs of the leading coordinates of the first blocks, as one number."""
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        cell = np.zeros(batch.num_rows, "int64")
        for dim in np.unique(dims).tolist():
            at = np.flatnonzero(dims == dim)
            x = _turn(_units(matrix(batch.column("vec").take(pa.array(at)), dim, kind)
                             .astype("float64")))
            lead = [(k, budget**0.5) for lo, hi, budget in _blocks(x.shape[1], block, cosine)
                    for k in range(lo, min(hi, lo + grid))]
            for k, radius in lead[:4]:
                slab = np.clip(np.floor(x[:, k] / radius), -8192, 8191).astype("int64") + 8192
                cell[at] = cell[at] * 16384 + slab
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)],
                                         [*batch.schema.names, "cell"])


#: Bytes of a chunk's vectors, at most; two chunks are in one row while they meet.
CHUNK_BYTES = 4 << 20

#: Parts that the chunks are dealt to on one side while they meet.
PARTS = 64

MEMBERS = ["node", "mult", "least", "k1", "k2"]


def _pack(batches: Iterator[pa.RecordBatch], size: int, kind: str) -> Iterator[pa.RecordBatch]:
    """Rows sorted by ``dim`` as rows of up to ``size`` vectors of one length."""
    def packed(part: pa.Table, dim: int) -> pa.RecordBatch:
        lists = [pa.array([part.column(c).to_pylist()], pa.list_(pa.int64())) for c in MEMBERS]
        vec = b"".join(part.column("vec").to_pylist())
        return pa.RecordBatch.from_arrays(
            [pa.array([dim], pa.int32()), *lists, pa.array([vec], pa.binary())],
            ["dim", *MEMBERS, "vec"])

    held, rows, last = [], 0, None
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        edges = [0, *(np.flatnonzero(dims[1:] != dims[:-1]) + 1).tolist(), len(dims)]
        for lo, hi in zip(edges, edges[1:]):
            if lo == hi:
                continue
            if rows and dims[lo] != last:
                yield packed(pa.Table.from_batches(held), last)
                held, rows = [], 0
            last = int(dims[lo])
            most = max(1, min(size, CHUNK_BYTES // (last * np.dtype(kind).itemsize)))
            while lo < hi:
                n = min(hi - lo, most - rows)
                held.append(batch.slice(lo, n))
                lo, rows = lo + n, rows + n
                if rows == most:
                    yield packed(pa.Table.from_batches(held), last)
                    held, rows = [], 0
    if rows:
        yield packed(pa.Table.from_batches(held), last)


#: Rows of a tile on the left and on the right.
TILE = 512, 1024


class _Chunk:
    """Vectors of a chunk, turned, with what each block needs to measure its pairs."""

    def __init__(self, vec: pa.Buffer, dim: int, kind: str, block: int, cosine: float):
        x = np.frombuffer(vec, kind).reshape(-1, dim).astype("float64")
        self.unit = _units(x)
        self.turned = _turn(self.unit).astype("float32")
        self.left, self.right = [], []
        for lo, hi, _ in _blocks(self.turned.shape[1], block, cosine):
            part = self.turned[:, lo:hi]
            norm = (part * part).sum(axis=1, keepdims=True)
            one = np.ones_like(norm)
            # A product of these rows is a squared distance.
            self.left.append(np.hstack([-2 * part, norm, one]))
            self.right.append(np.hstack([part, one, norm]).T)

    def boxes(self, rows: int) -> list[tuple[np.ndarray, np.ndarray]]:
        return [(t.min(axis=0), t.max(axis=0)) for t in (
            self.turned[k:k + rows] for k in range(0, len(self.turned), rows))]


def _close(a: _Chunk, b: _Chunk, same: bool, cosine: float, block: int
           ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of ``a`` and ``b`` that link, tile by tile; each pair once if both are the same."""
    spans = _blocks(a.turned.shape[1], block, cosine)
    whole = 2 - 2 * cosine + ROOM + 1e-5
    rights = b.boxes(TILE[1])
    for i, (low, high) in enumerate(a.boxes(TILE[0])):
        p0, p1 = i * TILE[0], min((i + 1) * TILE[0], len(a.turned))
        for j, (least, most) in enumerate(rights):
            q0, q1 = j * TILE[1], min((j + 1) * TILE[1], len(b.turned))
            if same and q1 <= p0:
                continue
            gap = np.maximum(0, np.maximum(least - high, low - most)).astype("float64") ** 2
            if gap.sum() > whole:
                continue
            found = []
            for k, (lo, hi, budget) in enumerate(spans):
                if gap[lo:hi].sum() > budget + 1e-5:
                    continue
                apart = a.left[k][p0:p1] @ b.right[k][:, q0:q1]
                limit = np.float32(budget + 1e-5)
                if apart.min() <= limit:
                    found.append(np.flatnonzero(apart.ravel() <= limit))
            if not found:
                continue
            at = found[0] if len(found) == 1 else np.unique(np.concatenate(found))
            if at.size > (p1 - p0) * (q1 - q0) // 32:
                # Many: those that are far apart as a whole are not worth a sum in double precision.
                dots = a.turned[p0:p1] @ b.turned[q0:q1].T
                at = at[dots.ravel()[at] >= np.float32(cosine - 1e-3)]
            p, q = np.divmod(at, q1 - q0)
            p, q = p + p0, q + q0
            if same:
                p, q = p[p < q], q[p < q]
            for k in range(0, len(p), 65536):
                s, t = p[k:k + 65536], q[k:k + 65536]
                linked = (a.unit[s] * b.unit[t]).sum(axis=1) >= cosine
                if linked.any():
                    yield s[linked], t[linked]


def _meet(batches: Iterator[pa.RecordBatch], cosine: float, block: int, kind: str
          ) -> Iterator[pa.RecordBatch]:
    """``(a, others, b)`` of each vector that links in a pair of chunks: how many rows it links
    with there, and a vector that it is joined to."""
    kept: dict[str, dict[int, _Chunk]] = {"_a": {}, "_b": {}}

    def chunk(batch: pa.RecordBatch, row: int, side: str) -> _Chunk:
        # A chunk on the left meets several on the right in turn.
        at, known = batch.column(f"at{side}")[row].as_py(), kept[side]
        if at not in known:
            while len(known) >= {"_a": 1, "_b": 3}[side]:
                known.pop(next(iter(known)))
            dim = batch.column(f"dim{side}")[row].as_py()
            known[at] = _Chunk(batch.column(f"vec{side}")[row].as_buffer(), dim, kind,
                               block, cosine)
        return known[at]

    def numbers(batch: pa.RecordBatch, row: int, name: str) -> np.ndarray:
        return batch.column(name)[row].values.to_numpy()

    for batch in batches:
        for row in range(batch.num_rows):
            same = batch.column("at_a")[row] == batch.column("at_b")[row]
            a = chunk(batch, row, "_a")
            b = a if same else chunk(batch, row, "_b")
            shift = 0 if same else len(a.unit)
            node, mult = numbers(batch, row, "node_a"), numbers(batch, row, "mult_a")
            if not same:
                node = np.concatenate([node, numbers(batch, row, "node_b")])
                mult = np.concatenate([mult, numbers(batch, row, "mult_b")])
            every = np.arange(len(node))
            links, label = np.zeros(len(node), "int64"), every
            for s, t in _close(a, b, same, cosine, block):
                t = t + shift
                links += np.bincount(s, mult[t], len(node)).astype("int64")
                links += np.bincount(t, mult[s], len(node)).astype("int64")
                label = forest(len(node), np.concatenate([every, s]), np.concatenate([label, t]))
            some = np.flatnonzero(links)
            if some.size:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[some]), pa.array(links[some]), pa.array(node[label[some]])],
                    ["a", "others", "b"])


def _key() -> list[Column]:
    """Two hashes that name a vector."""
    return [F.xxhash64("dim", "vec").alias("k1"), F.xxhash64(F.lit(1), "dim", "vec").alias("k2")]


def near_duplicates(vectors: DataFrame, cosine: float = 0.95, block: int = 16,
                    chunk: int | None = None, grid: int | None = None) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` per row of ``vectors``.

    ``chunk`` is the most vectors of a chunk, by default a 32nd of the rows and 2,048 to 16,384;
    ``grid`` is how many leading coordinates of a block are cut into slabs, by default one."""
    of = vectors.schema["embedding"].dataType.elementType
    kind = "float32" if of == T.FloatType() else "float64"
    n = vectors.count()
    size = chunk or min(16384, max(2048, -(-n // 32)))
    parts = max(1, min(PARTS, -(-n // size)))
    rows = usable(vectors, kind=kind)
    distinct = rows.groupBy("dim", "vec").agg(F.count(F.lit(1)).alias("mult"),
                                              F.min("vec_id").alias("least"))
    laid = distinct.mapInArrow(lambda b: _slabs(b, cosine, block, grid or 1, kind),
                               "dim int, vec binary, mult long, least long, cell long")
    # Of vectors in one cell, each has its own place.
    order = ["dim", "cell", F.xxhash64("vec")]
    laid = laid.repartitionByRange(*order).sortWithinPartitions(*order)
    members = ", ".join(f"{c} array<long>" for c in MEMBERS)
    chunks = cut(laid.select("dim", "mult", "least", F.monotonically_increasing_id().alias("node"),
                             *_key(), "vec")
                 .mapInArrow(lambda b: _pack(b, size, kind), f"dim int, {members}, vec binary")
                 .withColumn("at", F.monotonically_increasing_id()))
    sides = [chunks.select(*[F.col(c).alias(f"{c}_{s}") for c in ("dim", "at", "node", "mult", "vec")])
             for s in "ab"]
    # Without an equality, which would bring all chunks of a length to one task.
    met = sides[0].join(sides[1].repartition(parts).hint("shuffle_replicate_nl"),
                        (F.col("at_a") <= F.col("at_b"))
                        & (F.col("dim_a") - F.col("dim_b") == 0))
    found = cut(met.drop("dim_b").withColumn("dim_b", F.col("dim_a")).mapInArrow(
        lambda b: _meet(b, cosine, block, kind), "a long, others long, b long"))
    counts = found.groupBy("a").agg(F.sum("others").alias("others"))
    roots = components(found.select("a", "b"))
    named = (chunks.select(F.explode(F.arrays_zip(*MEMBERS)).alias("m")).select("m.*")
             .join(counts, F.col("node") == F.col("a"), "left").drop("a")
             .join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    whole = named.join(ids, "root").select(
        "k1", "k2", (F.coalesce("others", F.lit(0)) + F.col("mult") - 1).alias("n_links"),
        "component_id")
    linked = rows.select("vec_id", *_key()).join(whole, ["k1", "k2"]).select(
        "vec_id", "n_links", "component_id")
    return _with_unlinked(vectors, linked)


def _with_unlinked(vectors: DataFrame, linked: DataFrame) -> DataFrame:
    """Adds the rows that take no part, alone in their component."""
    v = F.col("embedding")
    ok = (v.isNotNull() & (F.size(v) > 0)
          & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x)
                                & (F.abs(x) < F.lit(float("inf")))), F.lit(False))
          & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False)))
    rest = vectors.where(~ok).select(F.col("vec_id").cast("long").alias("vec_id"),
                                     F.lit(0).cast("long").alias("n_links"),
                                     F.col("vec_id").cast("long").alias("component_id"))
    return linked.unionAll(rest).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
