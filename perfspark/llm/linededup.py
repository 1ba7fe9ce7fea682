"""Line deduplication over levelled sorted runs of line hashes.

A run is a table of ``(h1, h2, n_docs)`` sorted by hash in the shared folder. Each batch of
documents is counted, merge-anti-joined with the settled keys (those already known to be common)
and added as a run of level 0; when a level holds ``fan_in`` runs they are merged into one of the
next level, and keys that reach ``min_docs`` on the way are settled. So a key is written once per
level, as in a log-structured merge tree, and the runs can be kept between calls.

Keys: the line without ASCII white space at both ends, A-Z lower-cased, as a 128-bit hash. Every
row is a document. Null and empty texts are one empty line; empty keys are never common. Texts of
any length are split whole. Rows with the same text share one decision, so repeated ids and ids
that are null need no care. Columns besides ``text`` pass through untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import cut
from .common import drop_table, lean, slices, text_column

#: ASCII white space, as in [\x20\x09-\x0D].
BLANK = b" \t\n\x0b\x0c\r"


def line_key(line: bytes) -> bytes:
    return line.strip(BLANK).lower()


def _text_keys() -> dict:
    text = F.coalesce("text", F.lit(""))
    return {"_t1": F.xxhash64(text), "_t2": F.xxhash64(F.lit(1), text)}


def _halves(digests: list[bytes]) -> tuple[pa.Array, pa.Array]:
    high = [int.from_bytes(d[:8], "big", signed=True) for d in digests]
    low = [int.from_bytes(d[8:], "big", signed=True) for d in digests]
    return pa.array(high, pa.int64()), pa.array(low, pa.int64())


def line_hashes(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """``(t1, t2, h1, h2)``: a row per document and distinct key of at least ``min_chars``."""
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, digests = [], []
            for i, text in enumerate(text_column(batch)):
                keys = {line_key(line) for line in text.split(b"\n")}
                for key in keys:
                    if key and (min_chars <= 1 or len(key.decode()) >= min_chars):
                        at.append(i)
                        digests.append(xxhash.xxh3_128_digest(key))
            rows = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_t1").take(rows), batch.column("_t2").take(rows),
                 *_halves(digests)], ["t1", "t2", "h1", "h2"])

    texts = docs.select("text").withColumns(_text_keys())
    return texts.mapInArrow(lean(hashes), "t1 long, t2 long, h1 long, h2 long")


class LineRuns:
    """Counts of line keys over batches, kept as levelled sorted runs."""

    KEY = ["h1", "h2"]

    def __init__(self, min_docs: int, fan_in: int = 2):
        self.min_docs, self.fan_in = min_docs, fan_in
        self.levels: list[list[DataFrame]] = []
        self.settled: list[DataFrame] = []

    def add(self, lines: DataFrame) -> None:
        """Count one batch of ``(h1, h2)`` rows into the runs."""
        fresh = lines.groupBy(*self.KEY).agg(F.count(F.lit(1)).alias("n_docs"))
        for run in self.settled:
            fresh = fresh.join(run, self.KEY, "left_anti")
        self._put(0, self._sorted(fresh))

    def _sorted(self, counts: DataFrame) -> DataFrame:
        return cut(counts.sortWithinPartitions(*self.KEY))

    def _put(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fan_in:
            self._compact(level)

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        total = runs[0]
        for run in runs[1:]:
            total = total.unionAll(run)
        return total.groupBy(*self.KEY).agg(F.sum("n_docs").alias("n_docs"))

    def _compact(self, level: int) -> None:
        old, self.levels[level] = self.levels[level], []
        merged = cut(self._merged(old))
        self.settled.append(self._sorted(merged.where(F.col("n_docs") >= self.min_docs)
                                         .select(*self.KEY)))
        self._put(level + 1, self._sorted(merged.where(F.col("n_docs") < self.min_docs)))
        for table in [*old, merged]:
            drop_table(table)

    def common(self) -> DataFrame:
        """Keys of at least ``min_docs`` documents so far."""
        known = self.settled
        open_runs = [run for level in self.levels for run in level]
        found = [self._merged(open_runs).where(F.col("n_docs") >= self.min_docs)
                 .select(*self.KEY)] if open_runs else []
        out = [*known, *found]
        total = out[0]
        for part in out[1:]:
            total = total.unionAll(part)
        return total


def drop_common_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1,
                      batches: int = 4, fan_in: int = 2) -> DataFrame:
    """``docs`` without lines whose key stands in ``min_docs`` documents or more.

    Adds ``n_lines`` (before) and ``n_dropped``; the other lines stay, joined by a line feed. An
    empty table gives an empty result. Only hashes are shuffled to count; texts move once, to
    meet the hashes they lose, keyed by text (Spark splits a text that very many rows share)."""
    rest = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    lines = cut(line_hashes(docs, min_chars).withColumn("batch", F.pmod("t1", F.lit(batches))))
    runs = LineRuns(min_docs, fan_in)
    for i in range(batches):
        runs.add(lines.where(F.col("batch") == i))
    lost = (lines.join(runs.common(), LineRuns.KEY, "left_semi")
            .select(F.col("t1").alias("_t1"), F.col("t2").alias("_t2"),
                    F.struct("h1", "h2").alias("h"))
            .groupBy("_t1", "_t2").agg(F.collect_set("h").alias("_lost")))
    rows = docs.select(F.struct(*[F.col(c) for c in rest]).alias("_row"), "text")
    met = rows.withColumns(_text_keys()).join(lost, ["_t1", "_t2"], "left")
    schema = T.StructType([met.schema["_row"], T.StructField("text", T.StringType()),
                           T.StructField("n_lines", T.LongType()),
                           T.StructField("n_dropped", T.LongType())])

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(map(slices, batches)):
            texts, counts, drops = [], [], []
            for text, lost in zip(text_column(batch), batch.column("_lost"), strict=True):
                parts = text.split(b"\n")
                kept = parts
                if lost.is_valid:
                    gone = {(h["h1"], h["h2"]) for h in lost.as_py()}
                    digests = [xxhash.xxh3_128_digest(line_key(p)) for p in parts]
                    kept = [p for p, d in zip(parts, digests, strict=True)
                            if not line_key(p) or (int.from_bytes(d[:8], "big", signed=True),
                                int.from_bytes(d[8:], "big", signed=True)) not in gone]
                texts.append(b"\n".join(kept).decode())
                counts.append(len(parts))
                drops.append(len(parts) - len(kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(texts, pa.string()),
                 pa.array(counts, pa.int64()), pa.array(drops, pa.int64())],
                ["_row", "text", "n_lines", "n_dropped"])

    out = met.select("_row", "text", "_lost").mapInArrow(lean(rewrite), schema)
    return out.select(*[F.col("_row")[c].alias(c) for c in rest], "text", "n_lines", "n_dropped")
