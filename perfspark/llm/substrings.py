"""Substring deduplication: repeated paragraphs by MinHash banding, repeated clauses and runs of
words by hash.

A text's units are its lines, inside them its clauses, and grams of 10 words in a row, whatever
lines and punctuation they cross. The grams are chosen by their hashes (the least of any 10 in a
row), so a passage that was put into the middle of another text has the same ones there: of any
shared run of words all but at most 9 at either end are seen, and of 48 words or more at least 30.
Clauses see short equal pieces between edits. Lines are compared by 5-word shingles: each
distinct line has MinHash values in bands (``rows`` values a band, bands enough that a pair at the
threshold is missed at most once in several hundred), lines that share a band's value are joined,
and every such pair is verified by its exact Jaccard similarity. Verified links form clusters by
connected components. Clauses and grams count as repeated when equal.

Repeated units that follow one another, with at most a few words between them, make a run;
runs of at least ``min_words`` words are reported, cut where kept text and removals meet. In each
cluster the first occurrence (least document, then position) is kept and the others are removals,
so one copy of every passage survives.

Only hashes travel, and where units lie only for those that repeat; the words of lines are read
again for those lines alone that met in a band (each time a bitmap of fixed size keeps the others
out, and the exact join decides). A line that very many
documents share is one row after pre-aggregation; a band value with very many distinct lines is
cut into chunks. Null and empty texts have no units. Texts of any length are read whole. Rows with
an equal id count as one document, and so do all rows without an id, which comes last; each of their
texts has its own positions, and ``text_hash`` (``xxhash64`` of the text) tells which it is. Rows
equal in id and text are reported once. A passage that repeats only inside one document has no row.
Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import cut
from .common import (chunk_pairs, components, drop_table, forest, sorted_groups,
                     whole_groups)

SHINGLE = 5
#: Words of a gram, and of how many grams in a row the least is a unit.
GRAM, WINDOW = 10, 10
LINE_WORDS, CLAUSE_WORDS = 10, 6
#: Characters between two units of a run, such as clauses too short to be units.
GAP = 48
BANDS, ROWS = 8, 3
BITMAP = 1 << 24
CLAUSE = re.compile(r"[^.,!?;:]+[.,!?;:]*")

_RNG = np.random.default_rng(23)
_MUL = _RNG.integers(1, 1 << 63, BANDS * ROWS, dtype="uint64") | np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, BANDS * ROWS, dtype="uint64")
_MIX = _RNG.integers(1, 1 << 63, max(SHINGLE, ROWS) + 1, dtype="uint64") | np.uint64(1)
_GRAM = _RNG.integers(1, 1 << 63, GRAM, dtype="uint64") | np.uint64(1)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingle_hashes(words: list[bytes], known: dict) -> np.ndarray:
    """Hashes of the 5-word shingles; fewer words are one shingle."""
    h = np.fromiter(map(known.__getitem__, words), "uint64", len(words))
    n = max(1, len(h) - SHINGLE + 1)
    out = np.full(n, len(h) < SHINGLE, "uint64")
    for k in range(min(SHINGLE, len(h))):
        out = (out ^ h[k:k + n]) * _MIX[k]
        out ^= out >> np.uint64(29)
    return out


def band_hashes(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """``BANDS`` values per set of shingles; the sets lie one behind the other in ``flat``."""
    out = np.zeros((len(starts), BANDS), "uint64")
    for b in range(BANDS):
        value = np.full(len(starts), b + 1, "uint64")
        for r in range(ROWS):
            i = b * ROWS + r
            mixed = flat * _MUL[i] + _ADD[i]
            mixed ^= mixed >> np.uint64(32)
            value = (value ^ np.minimum.reduceat(mixed, starts)) * _MIX[r]
            value ^= value >> np.uint64(31)
        out[:, b] = value
    return out


def _units(text: str) -> Iterator[tuple[int, int, int, int, list[bytes]]]:
    """``(kind, start, length, words before, words)`` of each unit; kind 0 is a line, 1 a clause
    of one."""
    at = before = 0
    for line in text.split("\n"):
        words = line.lower().encode().split()
        if len(words) >= CLAUSE_WORDS:
            whole = len(words) >= LINE_WORDS
            if whole:
                yield 0, at, len(line), before, words
            spots = list(CLAUSE.finditer(line))
            if len(spots) > 1 or not whole:
                passed = before
                for m in spots:
                    own = m.group().lower().encode().split()
                    if len(own) >= CLAUSE_WORDS:
                        yield 1, at + m.start(), m.end() - m.start(), passed, own
                    passed += len(own)
        at += len(line) + 1
        before += len(words)


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1 ...``, ``counts[i]`` of them, for every ``i``."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def _shingles(h: np.ndarray, starts: np.ndarray, counts: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of lines of at least ``SHINGLE`` words that lie in the word hashes ``h``, and
    where those of each line begin."""
    counts = counts - SHINGLE + 1
    at = _spread(starts, counts)
    out = np.zeros(len(at), "uint64")
    for k in range(SHINGLE):
        out = (out ^ h[at + k]) * _MIX[k]
        out ^= out >> np.uint64(29)
    return out, np.cumsum(counts) - counts


def _least(gram: np.ndarray, width: int) -> np.ndarray:
    """Where the least of any ``width`` in a row stands, the last one of equals."""
    least, at = gram[:len(gram) - width + 1].copy(), np.arange(len(gram) - width + 1)
    for k in range(1, width):
        own = gram[k:k + len(least)]
        lower = own <= least
        np.copyto(least, own, where=lower)
        at[lower] = np.flatnonzero(lower) + k
    return at


def _grams(texts: list[str], h: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """``(text, start, length, words before, hash)`` of the chosen grams of each text's words;
    ``h`` are the hashes of all words, ``sizes`` their number by text.

    Of any ``WINDOW`` grams in a row the one of least hash is chosen, so two texts with the same
    words choose the same, but for ``WINDOW - 1`` words at either end."""
    first_word = np.cumsum(sizes) - sizes
    many = np.maximum(sizes - GRAM + 1, 0)
    if not many.any():
        return (np.zeros(0, "int64"),) * 5
    # Grams and windows that reach into the next text are made, and left out below.
    gram = np.zeros(len(h) - GRAM + 1, "uint64")
    for k in range(GRAM):
        gram = (gram ^ h[k:k + len(gram)]) * _GRAM[k]
        gram ^= gram >> np.uint64(29)
    chosen = []
    full = many >= WINDOW
    if full.any():
        at = _least(gram, WINDOW)
        chosen.append(at[_spread(first_word[full], many[full] - WINDOW + 1)])
    for i in np.flatnonzero((many > 0) & ~full):
        chosen.append(first_word[i] + _least(gram[first_word[i]:first_word[i] + many[i]], many[i]))
    at = np.unique(np.concatenate(chosen))
    codes = np.frombuffer("\n".join(texts).encode("utf-32-le"), "<u4")
    inside = np.zeros(len(codes) + 2, bool)
    inside[1:-1] = (codes != 32) & (codes - np.uint32(9) > 4)
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    first, last = edge[::2], edge[1::2]
    text = np.searchsorted(first_word + sizes, at, "right")
    begin = np.cumsum([0, *[len(t) + 1 for t in texts[:-1]]])
    return (text, first[at] - begin[text], last[at + GRAM - 1] - first[at], at - first_word[text],
            gram[at].view("int64"))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


#: Stands for a missing id, so that it is a document of its own and the last one.
NO_ID = (1 << 63) - 1
UNITS = ("d long, r long, kind int, start int, length int, at_word int, n_words int, unit long, "
         "bands array<long>")
UNIT_COLUMNS = [c.split()[0] for c in UNITS.split(", ")]


#: Words of texts that are hashed together.
WORDS = 200_000


def _read_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 500):
            part = batch.slice(lo, 500)
            known = _Hashes()
            docs, texts, hashes, size = [], [], [], 0
            for d, text in zip(part.column("d").to_pylist(), part.column("text").to_pylist()):
                words = (text or "").lower().encode().split()
                docs.append(d)
                texts.append(text or "")
                hashes.append(np.fromiter(map(known.__getitem__, words), "uint64", len(words)))
                size += len(words)
                if size >= WORDS:
                    yield from _text_units(docs, texts, hashes)
                    docs, texts, hashes, size = [], [], [], 0
            if docs:
                yield from _text_units(docs, texts, hashes)


def _text_units(docs: list[int], texts: list[str], hashes: list[np.ndarray]
                ) -> Iterator[pa.RecordBatch]:
    """Lines and clauses of the texts, then their grams. Numpy calls cover all texts at once."""
    sizes = np.array([len(h) for h in hashes], "int64")
    flat = np.concatenate(hashes)
    first_word = (np.cumsum(sizes) - sizes).tolist()
    own = [_signed(xxhash.xxh64_intdigest(t.encode(), seed=42)) for t in texts]
    doc, row, kind, start, length, at, n, unit, lines = [], [], [], [], [], [], [], [], []
    for i, text in enumerate(texts):
        for k, s, size, before, words in _units(text):
            doc.append(docs[i])
            row.append(own[i])
            kind.append(k)
            start.append(s)
            length.append(size)
            at.append(before)
            n.append(len(words))
            unit.append(_signed(xxhash.xxh64_intdigest(b" ".join(words))))
            if not k:
                lines.append((first_word[i] + before, len(words)))
    bands = iter(())
    if lines:
        starts, counts = np.array(lines, "int64").T
        bands = iter(band_hashes(*_shingles(flat, starts, counts)).view("int64").tolist())
    yield _unit_batch(doc, row, kind, start, length, at, n, unit,
                      [None if k else next(bands) for k in kind])
    text, start, length, at, unit = _grams(texts, flat, sizes)
    many = len(text)
    yield _unit_batch(np.array(docs, "int64")[text], np.array(own, "int64")[text],
                      np.full(many, 2), start, length, at, np.full(many, GRAM), unit,
                      pa.nulls(many, pa.list_(pa.int64())))


def _unit_batch(*columns) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 5, pa.int64(), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, kind)
         for c, kind in zip(columns, kinds, strict=True)], UNIT_COLUMNS)


def _bitmap(units: DataFrame) -> np.ndarray:
    """Bits of a fixed number of positions: which ``unit % BITMAP`` occur."""
    bit = F.pmod("unit", F.lit(BITMAP))
    cells = (units.select(F.shiftright(bit, 6).alias("cell"),
                          F.expr(f"shiftleft(1L, cast(pmod(unit, {BITMAP}) % 64 as int))")
                          .alias("bits")).groupBy("cell").agg(F.bit_or("bits").alias("bits")))
    out = np.zeros(BITMAP // 64, "int64")
    for r in cells.collect():
        out[r.cell] = r.bits
    return out.view("uint64")


def _marked(units: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """The units whose bit is set."""
    wanted = units.sparkSession.sparkContext.broadcast(bitmap)

    @F.pandas_udf("boolean")
    def marked(unit: pd.Series) -> pd.Series:
        bit = unit.to_numpy() % BITMAP
        return pd.Series(wanted.value[bit >> 6] >> (bit & 63).astype("uint64") & np.uint64(1) == 1)

    return units.where(marked("unit"))


def _lines_of(docs: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """``(unit, body)`` of the lines whose bit is set; a body is its words joined by spaces."""
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        for batch in batches:
            unit, body = [], []
            for text in batch.column("text").to_pylist():
                for line in (text or "").split("\n"):
                    words = line.lower().encode().split()
                    if len(words) < LINE_WORDS:
                        continue
                    joined = b" ".join(words)
                    u = xxhash.xxh64_intdigest(joined)
                    bit = _signed(u) % BITMAP
                    if int(bits[bit >> 6]) >> (bit & 63) & 1:
                        unit.append(_signed(u))
                        body.append(joined)
            yield pa.RecordBatch.from_arrays(
                [pa.array(unit, pa.int64()), pa.array(body, pa.binary())], ["unit", "body"])

    return docs.select("text").mapInArrow(read, "unit long, body binary")


def _verify(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    for table, starts in whole_groups(batches, ["band", "_i", "_j"]):
        units, chunk = table.column("unit").to_numpy(), table.column("_c").to_numpy()
        same = table.column("_i").to_numpy() == table.column("_j").to_numpy()
        bodies = table.column("body").to_pylist()
        known, a, b = _Hashes(), [], []
        for lo, hi in zip(starts, starts[1:]):
            sets = [set(shingle_hashes(bodies[i].split(b" "), known).tolist())
                    for i in range(lo, hi)]
            label = np.arange(hi - lo)
            for i in range(hi - lo):
                for j in range(i + 1, hi - lo):
                    if not same[lo] and chunk[lo + i] == chunk[lo + j]:
                        continue
                    s, t = sets[i], sets[j]
                    if min(len(s), len(t)) < similarity * max(len(s), len(t)):
                        continue
                    both = len(s & t)
                    if label[i] != label[j] and both >= similarity * (len(s) + len(t) - both):
                        low, high = sorted((label[i], label[j]))
                        label[label == high] = low
            far = np.nonzero(label != np.arange(hi - lo))[0]
            a += units[lo + far].tolist()
            b += units[lo + label[far]].tolist()
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                         ["a", "b"])


def line_clusters(docs: DataFrame, units: DataFrame, similarity: float = 0.8,
                  chunk: int = 256) -> DataFrame:
    """``(node, root)`` of the distinct lines that are near another one."""
    lines = units.where("kind = 0").groupBy("unit").agg(F.first("bands").alias("bands"))
    banded = lines.select("unit", F.explode("bands").alias("band"))
    met = cut(chunk_pairs(banded, ["band"], "unit", chunk))
    apart = met.select("unit").distinct()
    bodies = (_lines_of(docs, _bitmap(apart)).join(apart, "unit", "left_semi")
              .groupBy("unit").agg(F.first("body").alias("body")))
    rows = sorted_groups(met.join(bodies, "unit"), ["band", "_i", "_j"], ["unit"])
    links = (rows.select("band", "_i", "_j", "_c", "unit", "body")
             .mapInArrow(lambda b: _verify(b, similarity), "a long, b long"))
    return components(links)


def repeated_passages(docs: DataFrame, similarity: float = 0.8, min_words: int = 30
                      ) -> DataFrame:
    """``(doc_id, start, length, n_words, run_words, cluster_id, first_doc_id, kept, text_hash)`` of
    every occurrence.

    ``start`` and ``length`` count code points of the text; ``first_doc_id`` is the document whose
    occurrence is ``kept``. Documents without repeated passages have no row."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("d"), "text")
    every = cut(rows.mapInArrow(_read_units, UNITS))
    near = cut(line_clusters(docs, every, similarity))
    # Hashes alone travel until it is known which units repeat.
    twice = every.groupBy("unit").agg(F.min("d").alias("low"), F.max("d").alias("high"))
    again = cut(twice.where("low < high").select("unit")
                .unionAll(near.select(F.col("node").alias("unit"))).distinct())
    units = cut(_marked(every.drop("bands"), _bitmap(again)).join(again, "unit", "left_semi"))
    drop_table(every)
    by_unit = units.groupBy("unit").agg(
        F.min(F.struct("d", "r", "start")).alias("first"), F.max("d").alias("last"))
    clustered = by_unit.join(near, F.col("unit") == F.col("node"), "left").withColumn(
        "cluster_id", F.coalesce("root", "unit"))
    wide = (clustered.where("root is not null").groupBy("cluster_id").agg(
        F.min("first").alias("first"), F.max("last").alias("last")))
    repeated = (clustered.where("root is not null").select("unit", "cluster_id")
                .join(wide, "cluster_id")
                .unionByName(clustered.where("root is null").select(
                    "unit", "cluster_id", "first", "last"))
                .where(F.col("first.d") != F.col("last")))
    hits = units.join(repeated, "unit").withColumn(
        "kept", F.struct("d", "r", "start") == F.col("first"))
    return _spans(hits, min_words)


def _spans(hits: DataFrame, min_words: int) -> DataFrame:
    """Repeated units of a text as runs, cut into spans by whether they are kept.

    The windows hold a document's own repeated units."""
    end, last_word = F.col("start") + F.col("length"), F.col("at_word") + F.col("n_words")
    order = W.partitionBy("d", "r").orderBy("start", "kind", "length")
    before, upto = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(
        W.unboundedPreceding, 0)
    far = F.coalesce(F.col("start") > F.max(end).over(before) + GAP, F.lit(True))
    turned = F.coalesce(F.col("kept") != F.lag("kept").over(order), F.lit(True))
    rows = hits.withColumns({"_far": far.cast("int"), "_cut": (far | turned).cast("int")})
    rows = rows.withColumns({"_run": F.sum("_far").over(upto), "_span": F.sum("_cut").over(upto)})
    run = W.partitionBy("d", "r", "_run")
    rows = rows.withColumn("run_words", F.max(last_word).over(run) - F.min("at_word").over(run))
    spans = rows.where(F.col("run_words") >= min_words).groupBy("d", "r", "_span").agg(
        F.min("start").alias("start"), F.max(end).alias("_end"),
        (F.max(last_word) - F.min("at_word")).alias("n_words"), F.max("run_words").alias("run_words"),
        F.min_by("cluster_id", F.struct("start", "kind")).alias("cluster_id"),
        F.min_by("first.d", F.struct("start", "kind")).alias("first_doc_id"),
        F.min("kept").alias("kept"))
    none = F.lit(NO_ID)
    return spans.select(
        F.nullif("d", none).alias("doc_id"), "start",
        (F.col("_end") - F.col("start")).alias("length"), "n_words", "run_words", "cluster_id",
        F.nullif("first_doc_id", none).alias("first_doc_id"), "kept", F.col("r").alias("text_hash"))
