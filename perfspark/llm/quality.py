"""Quality of texts by logistic regression over hashed word n-grams, trained with
follow-the-regularised-leader updates.

A text's tokens are runs of letters and digits and runs of other visible characters, as they are
written. Every run of one to ``order`` tokens is hashed into one of ``2 ** bits`` features; a pair
of equal tokens at most eight apart is a gapped n-gram, one feature for each gap. A feature's
value is its count over the root of the sum of squared counts, so texts of any length have unit
length. The score is the logistic curve of the sparse dot product with the weights.

Training holds ``z`` and ``n`` of the proximal update for each feature. In each round the training
rows, dealt into shards by a hash, run through the updates one by one from the state of the last
round; what the shards change is averaged by feature as whole multiples of 2**-32, so the sums
do not depend on their order. State and weights are two numbers a feature at any corpus size, which
bounds what is collected and broadcast. At most ``sample`` labelled documents are read for
training, by least hash of the id; all rows are scored.

Null and empty texts have no features and get the curve of the bias. Texts are read whole. Repeated
rows are scored alike; labels that differ for one id count as 1. Rows without an id are held out.
Columns other than ``doc_id`` and ``text`` are not read and do not appear in the result. Without
training rows the score is one half.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import cut
from .common import drop_table, held_out, lean, slices

TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_+")
FEATURES = "shard int, place long, label int, features array<int>, counts array<int>"
#: Gapped pairs of equal tokens reach so far.
GAPS = 8
#: Fractions of a change are summed as multiples of this.
UNIT = 2.0 ** -32


class Hashes(dict):
    """A token's 32-bit hash, kept for up to ``limit`` tokens."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, token: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[token] = zlib.crc32(token.encode("utf-8", "surrogatepass"))
        return value


def ngrams(text: str | None, hashes: Hashes, bits: int, order: int
           ) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of a text and how often each occurs."""
    tokens = TOKEN.findall(text or "")
    one = np.fromiter(map(hashes.__getitem__, tokens), "u8", len(tokens))
    grams, found = one, []
    for n in range(1, order + 1):
        # Multiplied by a fixed odd number; the top bits of the product are well mixed.
        found.append((grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits))
        if n < order:
            grams = grams[:-1] * np.uint64(0x100000001B3) + one[n:] + np.uint64(n)
    # Gapped pairs: a token and the same token again, by the words between them.
    for gap in range(1, GAPS + 1):
        again = int(np.count_nonzero(one[gap:] == one[:-gap]))
        found.append(np.full(again, gap, "u8"))
    return np.unique(np.concatenate(found).astype("int32"), return_counts=True)


def values(counts: np.ndarray) -> np.ndarray:
    x = counts.astype("float64")
    return x / np.sqrt(x @ x) if x.size else x


class Leader:
    """Follow-the-regularised-leader state; the last feature is the bias, always 1."""

    def __init__(self, z: np.ndarray, n: np.ndarray, rate: float, smooth: float, l1: float,
                 l2: float):
        self.z, self.n = z, n
        self.rate, self.smooth, self.l1, self.l2 = rate, smooth, l1, l2

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z = self.z[at]
        steps = (self.smooth + np.sqrt(self.n[at])) / self.rate + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / steps)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -60, 60))) - label) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.rate * w
        self.n[at] = n + g * g


def training_rows(docs: DataFrame, labels: DataFrame, folds: int = 5, sample: int | None = 20000,
                  label: str = "quality") -> DataFrame:
    """``(doc_id, text, label)`` of at most ``sample`` labelled documents (None: of all) that are
    not held out, by least hash of the id."""
    known = (labels.where(F.col(label).isin(0, 1) & ~held_out("doc_id", folds))
             .groupBy("doc_id").agg(F.max(label).cast("int").alias("label")))
    if sample is not None:
        known = F.broadcast(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    return docs.select("doc_id", "text").join(known, "doc_id")


def hashed(rows: DataFrame, bits: int, order: int, shards: int) -> DataFrame:
    """Training rows as features; ``place`` orders a shard's rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in chain.from_iterable(map(lambda b: slices(b, 100), batches)):
            own = [ngrams(t, hashes, bits, order) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("shard"), batch.column("place"), batch.column("label"),
                 pa.array([f for f, _ in own], pa.list_(pa.int32())),
                 pa.array([c.astype("int32") for _, c in own], pa.list_(pa.int32()))],
                ["shard", "place", "label", "features", "counts"])

    place = F.xxhash64(F.lit(7), "doc_id", "text")
    dealt = rows.select(F.pmod(place, F.lit(shards)).cast("int").alias("shard"),
                        place.alias("place"), "label", "text")
    return dealt.mapInArrow(lean(run), FEATURES)


def fit(rows: DataFrame, *, bits: int = 18, order: int = 2, rounds: int = 4, rate: float = 0.5,
        smooth: float = 1.0, l1: float = 0.05, l2: float = 1.0, shard_rows: int = 2500
        ) -> np.ndarray:
    """Weights by feature, the bias last, from ``(doc_id, text, label)``."""
    spark, size = rows.sparkSession, (1 << bits) + 1
    z, n = np.zeros(size), np.zeros(size)
    shards = max(1, -(-rows.count() // shard_rows))
    table = cut(hashed(rows, bits, order, shards))

    for _ in range(rounds):
        state = spark.sparkContext.broadcast((z, n))

        def run(shard: pa.Table) -> pa.Table:
            z0, n0 = state.value
            leader = Leader(z0.copy(), n0.copy(), rate, smooth, l1, l2)
            for row in shard.sort_by([("place", "ascending"), ("label", "ascending")]).to_batches(
                    max_chunksize=200):
                for label, features, counts in zip(
                        row.column("label").to_pylist(), row.column("features"),
                        row.column("counts"), strict=True):
                    at = np.append(features.values.to_numpy(), size - 1)
                    x = np.append(values(counts.values.to_numpy()), 1.0)
                    leader.learn(at, x, label)
            moved = np.nonzero(leader.n != n0)[0]
            return pa.table({
                "feature": moved.astype("int32"),
                "z": np.rint((leader.z - z0)[moved] / UNIT).astype("int64"),
                "n": np.rint((leader.n - n0)[moved] / UNIT).astype("int64")})

        moved = (table.groupBy("shard").applyInArrow(run, "feature int, z long, n long")
                 .groupBy("feature").agg(F.sum("z").alias("z"), F.sum("n").alias("n")).toArrow())
        at = moved.column("feature").to_numpy()
        z[at] += moved.column("z").to_numpy() * (UNIT / shards)
        n[at] += moved.column("n").to_numpy() * (UNIT / shards)
        state.unpersist()
    drop_table(table)
    return Leader(z, n, rate, smooth, l1, l2).weights()


def score(docs: DataFrame, labels: DataFrame, *, folds: int = 5, sample: int | None = 20000,
          cutoff: float = 0.3, bits: int = 18, order: int = 2) -> DataFrame:
    """``(doc_id, score, predicted)`` of each row."""
    weights = docs.sparkSession.sparkContext.broadcast(
        fit(training_rows(docs, labels, folds, sample), bits=bits, order=order))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, w = Hashes(), weights.value
        for batch in chain.from_iterable(map(slices, batches)):
            margins = []
            for text in batch.column("text").to_pylist():
                features, counts = ngrams(text, hashes, bits, order)
                margins.append(float(w[features] @ values(counts) + w[-1]))
            scores = 1 / (1 + np.exp(-np.clip(np.array(margins), -60, 60)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()),
                 pa.array((scores >= cutoff).astype("int32"), pa.int32())],
                ["doc_id", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(lean(run), "doc_id long, score double, predicted int")
