"""Texts as word numbers: chunks of documents, and the distinct words of each chunk.

Work that needs something per word of a whole corpus (a count, a tokenizer's ids) is done once per
distinct word and brought back per chunk, so a frequent word is one row per chunk, and no join
ever sees single tokens. A chunk is a bounded number of words (one longer text is a chunk of its
own); its words are numbered by falling frequency and stored in byte planes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..session import cut
from .common import lean, slices, text_column

SCHEMA = ("kind int, chunk long, doc_ids array<long>, marks array<long>, lengths array<long>, "
          "tokens binary, classes binary, local int, word binary, n long, class int")
MAX_WORDS = 300_000
MAX_BYTES = 1 << 25


class Numbers(dict):
    """Numbers words in the order of their first use."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def squeeze(numbers: np.ndarray, width: int = 4) -> bytes:
    """Numbers of up to ``width`` (4 or 2) bytes."""
    planes = numbers.astype(f"<u{width}").view("u1").reshape(-1, width).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unsqueeze(data: bytes, width: int = 4) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "u1").reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel()


def encode(docs: DataFrame, *, lower: bool, end: bool, word_class: Callable[[bytes], int],
           tokens: int = 2_000_000) -> tuple[DataFrame, DataFrame]:
    """``(chunks, words)`` of ``(doc_id, mark, text)`` rows, from one table in the shared folder.

    A document's words are its runs of characters outside [\\x20\\x09-\\x0D], with ``lower`` A-Z
    lower-cased, with ``end`` followed by the empty word. ``words`` has ``(chunk, local, word, n,
    class)`` with ``n`` counted in documents whose ``mark`` is 0."""
    def flush(base: int, ids: list, marks: list, parts: list, seen: Numbers) -> Iterator:
        words = list(seen)
        flat = np.concatenate(parts) if parts else np.zeros(0, "int32")
        lengths = np.array([len(p) for p in parts], "int64")
        counts = np.bincount(flat, minlength=len(words))
        order = np.argsort(-counts, kind="stable")
        place = np.empty(len(words), "int32")
        place[order] = np.arange(len(words), dtype="int32")
        trained = np.repeat(np.array(marks, "int64") == 0, lengths)
        n = np.bincount(flat[trained], minlength=len(words))[order]
        words = [words[i] for i in order]
        classes = np.array([word_class(w) for w in words], "<u2")
        schema = pa.schema([
            ("kind", pa.int32()), ("chunk", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
            ("marks", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
            ("tokens", pa.binary()), ("classes", pa.binary()), ("local", pa.int32()),
            ("word", pa.binary()), ("n", pa.int64()), ("class", pa.int32())])
        yield pa.RecordBatch.from_pylist([{
            "kind": 0, "chunk": base, "doc_ids": ids, "marks": marks, "lengths": lengths.tolist(),
            "tokens": squeeze(place[flat]), "classes": classes.tobytes()}], schema)
        many = len(words)
        for lo in range(0, many, 20_000):
            hi = min(lo + 20_000, many)
            size = hi - lo
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ones(size, "int32")), pa.array(np.full(size, base)),
                 *[pa.nulls(size, schema.field(f).type) for f in (
                     "doc_ids", "marks", "lengths", "tokens", "classes")],
                 pa.array(np.arange(lo, hi, dtype="int32")),
                 pa.array(words[lo:hi], pa.binary()), pa.array(n[lo:hi]),
                 pa.array(classes[lo:hi].astype("int32"))], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        ids, marks, parts, seen, size, spelled = [], [], [], Numbers(), 0, 0
        for batch in (part for whole in batches for part in slices(whole)):
            for doc_id, mark, text in zip(batch.column("doc_id").to_pylist(),
                                          batch.column("mark").to_pylist(), text_column(batch),
                                          strict=True):
                words = (text.lower() if lower else text).split()
                if end:
                    words.append(b"")
                if parts and (size + len(words) > tokens or len(seen) >= MAX_WORDS
                              or spelled >= MAX_BYTES * 4):
                    yield from flush(base, ids, marks, parts, seen)
                    base += 1
                    ids, marks, parts, seen, size, spelled = [], [], [], Numbers(), 0, 0
                parts.append(np.fromiter(map(seen.__getitem__, words), "int32", len(words)))
                ids.append(doc_id)
                marks.append(mark)
                size += len(words)
                spelled += len(text)
        if parts:
            yield from flush(base, ids, marks, parts, seen)

    rows = docs.select("doc_id", "mark", "text").mapInArrow(lean(run), SCHEMA)
    table = cut(rows)
    chunks = table.where("kind = 0").select("chunk", "doc_ids", "marks", "lengths", "tokens",
                                            "classes")
    words = table.where("kind = 1").select("chunk", "local", "word", "n", "class")
    return chunks, words


def with_words(words: DataFrame, chunks: DataFrame, function: Callable[[pa.Table, dict], pa.Table],
               schema: str) -> DataFrame:
    """``function(words of the chunk by number, chunk)`` for each chunk, next to its words."""
    def run(own: pa.Table, chunk: pa.Table) -> pa.Table:
        row = chunk.to_pylist()[0]
        return function(own.sort_by("local"), row)

    # Both come from one table: a new name keeps their columns apart.
    own = words.withColumnRenamed("chunk", "_chunk").select(
        (F.col("_chunk") + F.lit(0)).alias("_chunk"),
        *[c for c in words.columns if c != "chunk"])
    return own.groupBy("_chunk").cogroup(chunks.groupBy("chunk")).applyInArrow(run, schema)
