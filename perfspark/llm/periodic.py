"""Periodic runs of words: stretches that repeat themselves with a shortest period.

A run of period q is a longest stretch in which words q apart are identical, at least
``max(min_words, 2 q)`` words long, q being its smallest period. Words are the runs of characters
outside [\\x20\\x09-\\x0D].

* Periods are taken by octaves ``[P, 2 P)``. A text is exploded, octave by octave, into tiles of
  ``max(TILE, 4 P)`` words that overlap by the words next to them which the octave's periods need.
  Every run of the octave repeats a gram of six words within ``2 P`` words, so tiles in which none
  recurs so near cannot hold any part of a run and are not made.
* Each tile is a row and is solved by itself. The words from ``i`` to ``i + q`` being equal holds
  for at least ``P`` starts ``i`` in a row, so for a start that is a multiple of ``P``, a boundary.
  The Z-function of the words from the boundary on, and that of the words before it read backwards,
  give for every period how far this goes on to either side, up to the next boundary.
* The fragments are shuffled by document and period and stitched where they touch. What is too
  short goes, as does a stretch that a run with a smaller period contains.

The text of a document is read by one task; its tiles, of a bounded size up to a quarter of the
period, are spread over all. A text without any repeated gram is finished where it is read.
Rows are named by two hashes of id and text: repeated rows get the same result, each its own row;
ids may be null. Null and empty texts, and those of white space alone, have no words and no runs.
Tables may be empty. Columns other than ``doc_id`` and ``text`` are not read and do not appear in
the result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import cut
from .common import document_key, lean, slices, text_column

#: Least words that a tile calls its own, and words of a gram: a run of at least 12 words and two
#: periods agrees with itself, one period on, over six words or more.
TILE, GRAM = 2048, 6
TILES = "k1 long, k2 long, octave int, tile int, first long, size long, words binary"
FRAGMENTS = "k1 long, k2 long, period long, lo long, hi long"
SPANS = "array<struct<start: long, length: long, period: long>>"


def z_function(s: list[int]) -> list[int]:
    """For each place, how many elements from it on equal those from the start on."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k > right - i:
                k = right - i
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def needed(period: int, min_words: int) -> int:
    """Starts in a row that a run of ``period`` has at least."""
    return max(period, min_words - period)


def boundary_fragments(words: list[int], at: int, octave: int, min_words: int
                       ) -> list[tuple[int, int, int]]:
    """``(period, lo, hi)``: starts around ``at`` at which words a period apart are identical.

    Either side ends at the next boundary; what ends before both and is too short is left out."""
    step = 1 << octave
    ahead = z_function(words[at:at + 3 * step])
    found = [(q, min(ahead[q], step)) for q in range(step, min(2 * step, len(ahead))) if ahead[q]]
    if not found:
        return []
    first, last = max(0, at - step), min(len(words), at + 2 * step)
    mirror = words[first:at][::-1]
    behind = z_function([*mirror, -1, *words[first:last][::-1]])
    base, out, through = len(mirror) + 1 + last, [], 0
    for q, right in found:
        left = min(behind[base - at - q], step) if mirror and at + q <= last else 0
        if right == step or left == step or left + right >= needed(q, min_words):
            out.append((q, at - left, at + right))
            through += left == right == step
    if through > 1:
        # The stretch goes through this boundary with several periods. If the words around it have
        # a period that divides one of them, that one is smallest nowhere in the stretch.
        around = z_function(words[first:at + 2 * step])
        own = next((p for p in range(1, step + 1) if around[p] == len(around) - p), None)
        if own:
            out = [f for f in out if f[2] - f[1] < 2 * step or f[0] == own or f[0] % own]
    return out


def tile_fragments(words: np.ndarray, first: int, start: int, stop: int, octave: int,
                   min_words: int) -> list[tuple[int, int, int]]:
    """Fragments of the boundaries in ``[start, stop)`` of a text; ``words`` begin at its word
    ``first``. Touching ones are joined; what ends inside the tile and is too short is left out."""
    step, plain = 1 << octave, words.tolist()
    open_, out = {}, []
    boundary = -(-start // step) * step
    for at in range(boundary, min(stop, first + len(plain)), step):
        for q, lo, hi in boundary_fragments(plain, at - first, octave, min_words):
            lo, hi = lo + first, hi + first
            held = open_.get(q)
            if held and lo <= held[1]:
                held[1] = max(held[1], hi)
                continue
            if held:
                out.append((q, *held))
            open_[q] = [lo, hi]
    out += [(q, *held) for q, held in open_.items()]
    last = boundary + (stop - 1 - boundary) // step * step
    return [(q, lo, hi) for q, lo, hi in out
            if hi - lo >= needed(q, min_words) or lo <= boundary or hi >= last]


def near_grams(words: np.ndarray) -> np.ndarray:
    """For each gram of words how many words on it next occurs; the largest number for never.

    Grams are told apart by 64-bit hashes; equal hashes of others only cost work."""
    n = len(words) - GRAM + 1
    never = np.iinfo("int64").max
    if n < 2:
        return np.full(max(0, n), never)
    mixed = (words.astype("u8") + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    gram = np.zeros(n, "u8")
    for k in range(GRAM):
        gram = gram * np.uint64(0xD6E8FEB86659FD93) + mixed[k:k + n]
    order = np.argsort(gram, kind="stable")
    ordered = gram[order]
    same = ordered[1:] == ordered[:-1]
    gap = np.full(n, never)
    gap[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return gap


def tiles_of(words: np.ndarray, gaps: np.ndarray) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """``(octave, tile, first word, words)`` of the tiles that may hold a part of a run."""
    n, near = len(words), int(gaps.min()) if len(gaps) else len(words)
    for octave in range(max(1, n // 2).bit_length()):
        step = 1 << octave
        if near >= 2 * step:
            continue
        own = max(TILE, 4 * step)
        at = np.nonzero(gaps < 2 * step)[0]
        # A stretch of starts reaches a gram's length beyond the last of its grams.
        for tile in np.unique(np.concatenate([at, at + GRAM - 1]) // own).tolist():
            first = max(0, tile * own - step)
            if tile * own < n:
                yield octave, tile, first, words[first:(tile + 1) * own + 3 * step]


def numbered(text: bytes) -> tuple[list[bytes], np.ndarray]:
    """A text's words and their numbers, equal for equal words."""
    words, numbers = text.split(), {}
    return words, np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), "int32",
                              len(words))


def _told(text: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    words, numbers = numbered(text)
    return words, numbers, near_grams(numbers)


def _repeats(gaps: np.ndarray) -> bool:
    return bool(len(gaps)) and int(gaps.min()) < len(gaps) + GRAM


def fragments(repeating: DataFrame, min_words: int) -> DataFrame:
    """Stretches of starts of each document and period, tile by tile."""
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in TILES.split(", ")]
        for batch in chain.from_iterable(map(lambda b: slices(b, 50), batches)):
            keys = zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist(),
                       text_column(batch), strict=True)
            rows, size = [], 0
            for k1, k2, text in keys:
                _, numbers, gaps = _told(text)
                for octave, tile, first, words in tiles_of(numbers, gaps):
                    rows.append((k1, k2, octave, tile, first, len(numbers),
                                 words.astype("<i4").tobytes()))
                    size += 4 * len(words)
                    if size > 1 << 22:
                        yield _batch(rows, names)
                        rows, size = [], 0
            if rows:
                yield _batch(rows, names)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in FRAGMENTS.split(", ")]
        for batch in chain.from_iterable(map(lambda b: slices(b, 50), batches)):
            rows = []
            for t in batch.to_pylist():
                own = max(TILE, 4 << t["octave"])
                found = tile_fragments(np.frombuffer(t["words"], "<i4"), t["first"],
                                       t["tile"] * own, min(t["size"], (t["tile"] + 1) * own),
                                       t["octave"], min_words)
                rows += [(t["k1"], t["k2"], *f) for f in found]
            yield _batch(rows, names)

    tiles = repeating.select("k1", "k2", "text").mapInArrow(lean(explode), TILES)
    spread = tiles.repartition("k1", "k2", "octave", "tile")
    return spread.mapInArrow(lean(solve), FRAGMENTS)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    kinds = {"words": pa.binary(), "octave": pa.int32(), "tile": pa.int32()}
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds.get(n, pa.int64())) for n, c in zip(names, columns, strict=True)], names)


def stitch(found: DataFrame, min_words: int) -> DataFrame:
    """``(k1, k2, spans)``: all long stretches of a document, periods not yet smallest."""
    group = Window.partitionBy("k1", "k2", "period").orderBy("lo", "hi")
    before = F.max("hi").over(group.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("lo") <= F.col("_before"), 0).otherwise(1)).over(
        group.rowsBetween(Window.unboundedPreceding, 0))
    whole = (found.withColumn("_before", before).withColumn("_island", island)
             .groupBy("k1", "k2", "period", "_island")
             .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    length = F.col("hi") - F.col("lo") + F.col("period")
    long = whole.where(length >= F.greatest(F.lit(min_words), 2 * F.col("period")))
    return long.groupBy("k1", "k2").agg(F.collect_list(F.struct(
        F.col("lo").alias("start"), length.alias("length"), "period")).alias("spans"))


def smallest_periods(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` without those that lie in one of a smaller period, sorted."""
    spans = sorted(spans, key=lambda s: (s[0], -s[1], s[2]))
    ends = sorted({s + n for s, n, _ in spans})
    tree = [1 << 62] * (len(ends) + 1)  # least period of those seen that end there or later
    kept = []
    for start, length, period in spans:
        place = len(ends) - bisect_left(ends, start + length)
        least, i = 1 << 62, place
        while i:
            least = min(least, tree[i])
            i &= i - 1
        if period < least:
            kept.append((start, length, period))
        i = place
        while i <= len(ends):
            tree[i] = min(tree[i], period)
            i += i & -i
    return sorted(kept, key=lambda s: (s[0], s[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run repeats, joined by one space."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, "int64")
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    kept = np.cumsum(edge[:-1]) == 0
    return b" ".join([words[i] for i in np.nonzero(kept)[0].tolist()])


RESULT = f"doc_id long, n_words long, runs {SPANS}, text string"


def _result(ids: list, words: list[int], runs: list[list], texts: list[bytes]) -> pa.RecordBatch:
    span = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    told = [[{"start": s, "length": n, "period": q} for s, n, q in own] for own in runs]
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(words, pa.int64()), pa.array(told, pa.list_(span)),
         pa.array([t.decode() for t in texts], pa.string())],
        ["doc_id", "n_words", "runs", "text"])


def periodic_runs(docs: DataFrame, min_words: int = 12) -> DataFrame:
    """``(doc_id, n_words, runs, text)`` of each row.

    ``runs`` are ``(start, length, period)`` by start, then period; ``text`` is the words that no
    run holds after its first period, joined by one space. ``min_words`` is at least 12, which the
    grams need."""
    if min_words < 12:
        raise ValueError("runs of fewer than 12 words share no gram of six words")
    k1, k2 = document_key()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", k1.alias("k1"), k2.alias("k2"), "text")

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(map(slices, batches)):
            ids, counts, texts = [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), text_column(batch),
                                    strict=True):
                words, _, gaps = _told(text)
                if not _repeats(gaps):
                    ids.append(doc_id)
                    counts.append(len(words))
                    texts.append(collapse(words, []))
            yield _result(ids, counts, [[]] * len(ids), texts)

    def repeat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(map(slices, batches)):
            keep = [_repeats(_told(text)[2]) for text in text_column(batch)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(map(slices, batches)):
            words = [text.split() for text in text_column(batch)]
            runs = [smallest_periods([(s["start"], s["length"], s["period"]) for s in own or []])
                    for own in batch.column("spans").to_pylist()]
            yield _result(batch.column("doc_id").to_pylist(), list(map(len, words)), runs,
                          list(map(collapse, words, runs)))

    done = rows.select("doc_id", "text").mapInArrow(lean(plain), RESULT)
    repeating = cut(rows.mapInArrow(
        lean(repeat), "doc_id long, k1 long, k2 long, text string"))
    spans = stitch(fragments(repeating.dropDuplicates(["k1", "k2"]), min_words), min_words)
    held = repeating.join(spans, ["k1", "k2"], "left").select("doc_id", "text", "spans")
    return done.unionAll(held.mapInArrow(lean(finish), RESULT))
