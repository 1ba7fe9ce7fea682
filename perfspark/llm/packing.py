"""Packing documents into sequences by first-fit decreasing over a tournament tree.

Documents are token ids with an end id. The tokenizer drops white space, so a text's ids are those
of its words in order; each worker keeps the ids of the words it has met, up to a bounded number
and size, from one task to the next, and so seldom tokenises a word twice. Documents go to groups by a seeded
hash of id and text; a group is packed by itself: whole sequences are cut off first, the tails are
placed in falling length, each in the first sequence with room, found by walking a tournament tree
of free capacities. Gaps that stay are closed by cutting up the emptiest sequences, and what
remains of the last one becomes sequences whose lengths are powers of two, so nothing is padded.

Groups hold a bounded number of documents, so memory does not grow with the table; a source or a
set of copies with a third of all rows spreads over groups by id. Rows equal in id and text that
would overfill a group are counted, tokenised once and spread by the number of the copy. Null and
empty texts are the end id alone. Texts of any length are cut over as many sequences as they need.
Repeated rows are packed as often as they stand there; ids may be null. Columns other than ``doc_id`` and ``text`` are not
read.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import lean, text_column

PIECES = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, "
          "ids binary")

#: Words whose ids a worker keeps.
WORDS = 400_000


class TournamentTree:
    """Free capacities of bins; finds the first bin with enough room in log time."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.best = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """The first bin with room for ``size``, which it takes."""
        best, at = self.best, 1
        while at < self.leaves:
            at *= 2
            if best[at] < size:
                at += 1
        found = at - self.leaves
        best[at] -= size
        while at > 1:
            at //= 2
            best[at] = max(best[2 * at], best[2 * at + 1])
        return found


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Items of each bin, by falling size; every size is at most ``capacity``."""
    tree, bins = TournamentTree(max(1, len(sizes)), capacity), []
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = tree.place(sizes[item])
        if at == len(bins):
            bins.append([])
        bins[at].append(item)
    return bins


def close_gaps(bins: list[list[tuple[int, int, int]]], capacity: int
               ) -> list[list[tuple[int, int, int]]]:
    """Bins of pieces ``(item, start, length)``, all full but for powers of two.

    The emptiest bins are cut up to fill the gaps of the fullest; the last one left is cut into
    sequences whose lengths are the powers of two that add up to it."""
    used = [sum(p[2] for p in b) for b in bins]
    order = sorted(range(len(bins)), key=lambda i: (-used[i], i))
    bins = [list(bins[i]) for i in order]
    used = [used[i] for i in order]
    front, back = 0, len(bins) - 1
    while front < back:
        gap = capacity - used[front]
        if not gap:
            front += 1
            continue
        item, start, length = bins[back].pop()
        taken = min(gap, length)
        bins[front].append((item, start + length - taken, taken))
        used[front] += taken
        used[back] -= taken
        if taken < length:
            bins[back].append((item, start, length - taken))
        if not used[back]:
            back -= 1
    bins = bins[:back + 1]
    if not bins or used[back] & (used[back] - 1) == 0:
        return bins
    rest, total = bins.pop(), used[back]
    while total:
        size = 1 << (total.bit_length() - 1)
        total -= size
        sequence = []
        while size:
            item, start, length = rest.pop(0)
            taken = min(size, length)
            sequence.append((item, start, taken))
            size -= taken
            if taken < length:
                rest.insert(0, (item, start + taken, length - taken))
        bins.append(sequence)
    return bins


def pack(lengths: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces ``(document, start, length)``."""
    whole = [[(d, s, capacity)] for d, n in enumerate(lengths)
             for s in range(0, n - capacity + 1, capacity)]
    tails = [(d, n - n % capacity, n % capacity) for d, n in enumerate(lengths) if n % capacity]
    bins = first_fit_decreasing([t[2] for t in tails], capacity)
    return whole + close_gaps([[tails[i] for i in b] for b in bins], capacity)


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Speller:
    """Token ids of texts, word by word.

    A word is letters, perhaps with one closing mark, or anything else. The tokenizer parts
    letters from punctuation and lowers case, so the two parts are looked up each by itself and
    letters in lower case; every other word goes to it whole. Past ``limit`` words, or ``HELD``
    bytes of words, it forgets."""

    CLOSING = frozenset(".,;:!?")
    #: Letters whose lower case depends on the library or on their neighbours.
    ODD = re.compile("[\u03a3\u0130]")
    HELD = 1 << 25
    #: Letters below this one are their own composed form.
    PLAIN = "\u0250"
    #: The tokenizer's model reads bytes as characters: printable ones of Latin-1 stand for
    #: themselves, the others for the characters from U+0100 on.
    OTHERS = [*range(0x21), *range(0x7f, 0xa1), 0xad]
    BYTES = {byte: 0x100 + i for i, byte in enumerate(OTHERS)}

    def __init__(self, tokenizer, limit: int = WORDS):
        self.tokenizer, self.limit = tokenizer, limit
        self.forget()

    def forget(self) -> None:
        self.numbers, self.held = Numbers(), 0
        self.parts: dict[str, bytes] = {"": b""}
        self.sizes, self.starts = np.zeros(0, "int64"), np.zeros(0, "int64")
        self.flat = np.zeros(0, "<u4")

    def _part_ids(self, parts: list[str]) -> None:
        """Learn parts that are new; plain letters need neither normalising nor splitting."""
        rest, spell = [], self.tokenizer.model.tokenize
        for part in parts:
            if part.isalpha() and max(part) < self.PLAIN and not self.ODD.search(part):
                raw = part if part.isascii() else part.encode().decode("latin-1").translate(
                    self.BYTES)
                self.parts[part] = array("I", [t.id for t in spell(raw)]).tobytes()
            else:
                rest.append(part)
        for lo in range(0, len(rest), 1024):  # an encoding holds far more than its ids
            own = rest[lo:lo + 1024]
            for part, found in zip(own, self.tokenizer.encode_batch_fast(
                    own, add_special_tokens=False), strict=True):
                self.parts[part] = array("I", found.ids).tobytes()

    def _learn(self) -> None:
        """Ids of the words numbered since the last call."""
        known, heads, tails = self.parts, [], []
        for word in self.numbers.fresh:
            head, tail = word.decode(), ""
            if head[-1] in self.CLOSING:
                head, tail = head[:-1], head[-1]
            if not head.isalpha() or not (head.isascii() or not self.ODD.search(head)):
                head, tail = head + tail, ""
            else:
                head = head.lower()
            heads.append(head)
            tails.append(tail)
        self._part_ids([p for p in {*heads, *tails} if p not in known])
        spelled = list(map(bytes.__add__, map(known.__getitem__, heads),
                           map(known.__getitem__, tails)))
        sizes = np.fromiter(map(len, spelled), "int64", len(spelled)) // 4
        starts = len(self.flat) + np.cumsum(sizes) - sizes
        self.sizes, self.starts = np.append(self.sizes, sizes), np.append(self.starts, starts)
        self.flat = np.append(self.flat, np.frombuffer(b"".join(spelled), "<u4"))
        self.held += sum(map(len, self.numbers.fresh))
        self.numbers.fresh.clear()

    def ids(self, texts: list[bytes]) -> list[np.ndarray]:
        if len(self.numbers) > self.limit or self.held > self.HELD:
            self.forget()
        split = list(map(bytes.split, texts))
        lengths = np.fromiter(map(len, split), "int64", len(split))
        own = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(split)), "int64",
                          int(lengths.sum()))
        if self.numbers.fresh:
            self._learn()
        n = self.sizes[own]
        ends = np.cumsum(n)
        at = np.repeat(self.starts[own] - (ends - n), n)
        at += np.arange(len(at))
        last = np.append(0, ends)[np.cumsum(lengths)]
        return np.split(self.flat[at], last[:-1])


@lru_cache(maxsize=1)
def _speller(path: str, limit: int = WORDS) -> Speller:
    """One a worker; Spark keeps workers for later tasks."""
    return Speller(_tokenizer(path), limit)


class Numbers(dict):
    """Numbers words in the order of their first use and lists those that are new."""

    def __init__(self):
        super().__init__()
        self.fresh: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.fresh.append(word)
        return number


def _narrow(ids: np.ndarray) -> bytes:
    """Two bytes an id where all fit, else four; the first byte tells."""
    small = not ids.size or int(ids.max()) < 1 << 16
    return (b"\2" if small else b"\4") + ids.astype("<u2" if small else "<u4").tobytes()


def _wide(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u2" if data[0] == 2 else "<u4", offset=1).astype("<u4")


def tokens_of(docs: DataFrame, tokenizer: str, end_id: int, mark: Column,
              words: int = WORDS) -> DataFrame:
    """``(doc_id, mark, ids)`` of each row; ``mark`` is any long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller = _speller(tokenizer, words)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                ids = [_narrow(np.append(i, np.uint32(end_id)).astype("<u4"))
                       for i in speller.ids(text_column(part))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("mark"), pa.array(ids, pa.binary())],
                    ["doc_id", "mark", "ids"])

    rows = docs.select(F.col("doc_id").cast("long"), mark.cast("long").alias("mark"), "text")
    return rows.mapInArrow(lean(run), "doc_id long, mark long, ids binary")


def _pack_group(rows: pa.Table, capacity: int) -> pa.Table:
    rows = rows.sort_by([("doc_id", "ascending"), ("mark", "ascending")])
    ids = [_wide(b) for b in rows.column("ids").to_pylist()]
    doc_ids, group = rows.column("doc_id").to_pylist(), rows.column("group")[0].as_py()
    out = {name.split()[0]: [] for name in PIECES.split(", ")}
    for number, sequence in enumerate(pack([len(i) for i in ids], capacity)):
        offset = 0
        for doc, start, length in sequence:
            row = (doc_ids[doc], start, length, len(ids[doc]), (group << 32) + number, offset,
                   ids[doc][start:start + length].tobytes())
            for column, value in zip(out.values(), row, strict=True):
                column.append(value)
            offset += length
    types = [pa.int64()] * 6 + [pa.binary()]
    return pa.table([pa.array(v, t) for v, t in zip(out.values(), types)], names=list(out))


def pack_documents(docs: DataFrame, tokenizer: str, *, capacity: int = 2048, end_id: int = 1,
                   seed: int = 3, group_rows: int = 1024, words: int = WORDS) -> DataFrame:
    """Pieces ``(doc_id, start, length, doc_tokens, sequence_id, offset, ids)``.

    ``ids`` are a piece's token ids as little-endian unsigned 32-bit numbers; ``tokenizer`` is the
    path of its file, which every worker can read. A worker keeps the ids of ``words`` words:
    fewer take less memory and more time."""
    per_id = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    size = per_id.agg(F.sum("n").alias("rows"), F.max("n").alias("most")).first()
    groups = F.lit(max(1, -(-(size.rows or 0) // group_rows)))
    rows, many = docs.select("doc_id", "text"), None
    if (size.most or 0) > group_rows:
        key = F.xxhash64("doc_id", "text").alias("k")
        keyed = rows.select("*", key)
        hot = keyed.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where(
            F.col("n") > group_rows).select("k")
        rows = keyed.join(hot, "k", "left_anti").drop("k")
        many = keyed.join(hot, "k", "left_semi").groupBy("doc_id", "text").agg(
            F.count(F.lit(1)).alias("n"))
    group = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), groups)
    tokens = tokens_of(rows, tokenizer, end_id, group, words).withColumnRenamed("mark", "group")
    if many is not None:
        copies = tokens_of(many, tokenizer, end_id, F.col("n"), words).withColumn(
            "copy", F.explode(F.sequence(F.lit(1), "mark")))
        tokens = tokens.unionByName(copies.select(
            "doc_id", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "ids", "copy"), groups)
            .alias("group"), "ids"))
    tokens = tokens.withColumn("mark", F.xxhash64("ids"))
    return tokens.groupBy("group").applyInArrow(lambda t: _pack_group(t, capacity), PIECES)
