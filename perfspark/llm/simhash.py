"""SimHash near-duplicates over a Gray-order hierarchical index.

Fingerprints are 64 bits over word shingles. Those within ``bits`` differing bits agree in at
least one of ``bits + 1`` groups of bits; these masks are the top nodes of the index. Below a top
node (mask and shared pattern) the distinct fingerprints are sorted by Gray rank, so that
neighbours share long bit patterns; runs of them become leaves, and runs of nodes become upper
nodes, each holding the mask of bits that all below agree in and their pattern. A probe walks
down, adds up its differences to the newly fixed bits, and drops a whole group as soon as they
exceed ``bits``. A node whose open bits are so few that all below must agree is linked as one.

Only distinct fingerprints are placed, so copies cost nothing; a top node with very many of them
is cut into chunks whose pairs are bounded tasks. Tasks give out spanning links, never all pairs.

Null and empty texts, and texts without words, have fingerprint 0 and link like any other. Very
long texts are hashed whole. Repeated rows and null ids are rows like others; a component's id is
its least id that is not null. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut
from .common import (chunk_pairs, components, document_key, first_of_each, forest, lean,
                     sorted_groups, text_column, whole_groups)

SEED = 42


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    parts = text.lower().split()
    if not parts:
        return np.zeros(0, "uint64")
    joined = b" ".join(parts)
    ends = list(accumulate((len(p) + 1 for p in parts)))
    starts = [0, *ends[:-1]]
    digest = xxhash.xxh64_intdigest
    if len(parts) <= words:
        return np.array([digest(joined, SEED)], "uint64")
    return np.array([digest(joined[a:b - 1], SEED) for a, b in zip(starts, ends[words - 1:])],
                    "uint64")


def fingerprint(text: bytes, words: int = 4) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes."""
    h = shingle_hashes(text, words)
    if not h.size:
        return 0
    ones = np.zeros(64, "int64")
    for at in range(0, h.size, 8192):
        bits = np.unpackbits(h[at:at + 8192].view("uint8").reshape(-1, 8), axis=1,
                             bitorder="little")
        ones += bits.sum(axis=0, dtype="uint16")
    set_bits = np.packbits(ones * 2 > h.size, bitorder="little")
    return int(set_bits.view("uint64")[0])


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """``(doc_id, k1, k2, fp)`` per row: the row's key and its fingerprint as a signed long."""
    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, words) for t in text_column(batch)], "uint64")
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("k1"), batch.column("k2"),
                 pa.array(fps.view("int64"))], ["doc_id", "k1", "k2", "fp"])

    k1, k2 = document_key()
    rows = docs.select(F.col("doc_id").cast("long"), k1.alias("k1"), k2.alias("k2"), "text")
    return rows.mapInArrow(lean(prints), "doc_id long, k1 long, k2 long, fp long")


def gray_rank(fp: Column) -> Column:
    """Position of the bits in the reflected Gray order."""
    for step in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, step))
    return fp


def masks(bits: int) -> list[int]:
    """``bits + 1`` groups of bits that together make up 64."""
    edges = [64 * i // (bits + 1) for i in range(bits + 2)]
    return [(1 << hi) - (1 << lo) for lo, hi in zip(edges, edges[1:])]


def _spread(firsts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(owner, item)`` of ``counts[i]`` items from ``firsts[i]`` on, for each owner ``i``."""
    owner = np.repeat(np.arange(len(counts)), counts)
    before = np.cumsum(counts) - counts
    return owner, np.arange(len(owner)) - np.repeat(before - firsts, counts)


class GrayIndex:
    """Levels of nodes over the rows of many groups at once; rows are in Gray order by group."""

    def __init__(self, fps: np.ndarray, starts: np.ndarray, leaf: int = 16, fan: int = 8):
        self.fps = fps
        self.levels = []
        firsts, lasts, all_bits, any_bits = starts[:-1], starts[1:], fps, fps
        width = leaf
        spans = (np.arange(len(fps)), np.ones(len(fps), "int64"))
        while True:
            sizes = lasts - firsts
            nodes = -(-sizes // width)
            owner, k = _spread(np.zeros(len(sizes), "int64"), nodes)
            at = firsts[owner] + k * width
            n_below = np.minimum(width, lasts[owner] - at)
            all_bits = np.bitwise_and.reduceat(all_bits, at)
            any_bits = np.bitwise_or.reduceat(any_bits, at)
            spans = (spans[0][at], np.add.reduceat(spans[1], at))
            self.levels.append((at, n_below, all_bits, ~(all_bits ^ any_bits), spans))
            lasts = np.cumsum(nodes)
            firsts = lasts - nodes
            if (nodes <= 1).all():
                break
            width = fan

    def links(self, probes: np.ndarray, root: np.ndarray, bits: int
              ) -> tuple[np.ndarray, np.ndarray]:
        """``(probe, row)`` whose links join everything within ``bits`` of each probe."""
        row, node = probes, root[probes]
        spent = np.zeros(len(row), "uint8")
        known = np.zeros(len(row), "uint64")
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for at, below, pattern, mask, spans in reversed(self.levels):
            fresh = (self.fps[row] ^ pattern[node]) & mask[node] & ~known
            spent = spent + np.bitwise_count(fresh)
            alive = spent <= bits
            row, node, spent = row[alive], node[alive], spent[alive]
            known = mask[node]
            whole = spent + np.bitwise_count(~known) <= bits
            if whole.any():
                found.append((row[whole], spans[0][node[whole]]))
                nodes = np.unique(node[whole])
                owner, item = _spread(spans[0][nodes], spans[1][nodes])
                found.append((spans[0][nodes][owner], item))
                row, node, spent = row[~whole], node[~whole], spent[~whole]
                known = known[~whole]
            owner, item = _spread(at[node], below[node])
            row, spent, known, node = row[owner], spent[owner], known[owner], item
        rest = spent + np.bitwise_count((self.fps[row] ^ self.fps[node]) & ~known)
        near = (rest <= bits) & (row != node)
        found.append((row[near], node[near]))
        return (np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))


def _near(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    keys = ["mask", "pattern", "_i", "_j"]
    for table, starts in whole_groups(batches, keys):
        fps = table.column("fp").to_numpy().view("uint64")
        index = GrayIndex(fps, starts)
        root = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        label = np.arange(len(fps))
        for at in range(0, len(fps), 4096):
            a, b = index.links(np.arange(at, min(at + 4096, len(fps))), root, bits)
            label = forest(len(fps), np.concatenate([np.arange(len(fps)), a]),
                           np.concatenate([label, b]))
        far = np.nonzero(label != np.arange(len(fps)))[0]
        yield pa.RecordBatch.from_arrays([pa.array(fps[far].view("int64")),
                                          pa.array(fps[label[far]].view("int64"))], ["a", "b"])


def near_links(prints: DataFrame, bits: int = 4, chunk: int = 4096) -> DataFrame:
    """Spanning links ``(a, b)`` between distinct fingerprints within ``bits`` of each other."""
    top = F.explode(F.array(*[
        F.struct(F.lit(i).alias("mask"),
                 F.col("fp").bitwiseAND(F.lit(m if m < 2**63 else m - 2**64)).alias("pattern"))
        for i, m in enumerate(masks(bits))])).alias("top")
    placed = prints.select("fp").distinct().select("fp", top).select("fp", "top.*")
    keys = ["mask", "pattern", "_i", "_j"]
    met = chunk_pairs(placed, ["mask", "pattern"], "fp", chunk)
    rows = sorted_groups(met.withColumn("_g", gray_rank(F.col("fp")).bitwiseXOR(
        F.lit(-2**63))), keys, ["_g"])
    return (rows.select(*keys, "fp")
            .mapInArrow(lambda b: _near(b, bits), "a long, b long").distinct())


def near_duplicates(docs: DataFrame, bits: int = 4, words: int = 4) -> DataFrame:
    """``(doc_id, k1, k2, fp, component_id, root)`` per row.

    ``component_id`` is the least id that the row's fingerprint reaches."""
    prints = cut(fingerprints(docs, words))
    roots = components(near_links(prints, bits))
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("_min"))
    named = (least.join(roots, least["fp"] == roots["node"], "left")
             .withColumn("root", F.coalesce("root", "fp")))
    ids = named.groupBy("root").agg(F.min("_min").alias("component_id"))
    by_print = named.select("fp", "root").join(ids, "root")
    return prints.join(by_print, "fp").select("doc_id", "k1", "k2", "fp", "component_id", "root")


def one_of_each(docs: DataFrame, bits: int = 4, words: int = 4) -> DataFrame:
    """``docs`` with one row of each component: one with the least id (ids that are null last).

    Texts move once, to meet the keys that stay; rows that repeat id and text count as one."""
    return first_of_each(docs, near_duplicates(docs, bits, words))
