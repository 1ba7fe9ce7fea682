"""Alignment of two tokenizers' tokens over the bytes of the same text.

Both tokenizers read a space and the text, so their tokens cover the same bytes. Tokens by bytes is
a sparse matrix ``A`` of one tokenizer and ``B`` of the other, in compressed rows built here; the
product ``A Bᵀ``, row by row, links tokens that overlap, with the bytes they share. Where tokens of
both end together, the text is cut into groups; tokens by groups are two more such matrices, whose
product links the tokens of a group. Tokens by last bytes give the links of tokens that end
together, whose counts over the corpus tell which partners of a token are the usual ones.

No token of either reaches over the start of white space, so a text is the sequence of its pieces
of white space and what follows, and each distinct piece is tokenised and multiplied once per task
and then looked up. For the counts, distinct pieces are first counted over the corpus and then
multiplied once each. Pairs that end together are suffixes of one another, so there are at most as
many as both vocabularies have bytes, times the spellings of one string: a bound by the vocabularies,
whatever the corpus. The counted pairs alone are collected and broadcast.

A text has no tokens where it is null or empty, or where the joined bytes of either tokenizer differ
from the space and the text; all its numbers are zero then and its groups are the empty string.
Special tokens inside texts are plain text. Texts are read whole. Repeated rows count as often as
they stand there and ids may be null. Columns other than ``doc_id`` and ``text`` are not read and
do not appear in the result.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import lean, slices
from .packing import Numbers

# White space as both tokenizers' patterns know it, and the pretoken pattern that
# byte-level tokenizers share.
BLANK = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PRETOKEN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
SPACE = "\u2581"

KINDS = ("end", "overlap", "group")
ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
           "count_sum long, groups string")
LINKS = "doc_id long, a array<int>, b array<int>, weight array<int>"


@dataclass
class Rows:
    """A sparse matrix of counts in compressed rows."""

    starts: np.ndarray
    columns: np.ndarray
    counts: np.ndarray
    width: int

    @classmethod
    def of_ranges(cls, first: np.ndarray, stop: np.ndarray, width: int) -> Rows:
        """Row ``i`` has a one in each column from ``first[i]`` to before ``stop[i]``."""
        size = stop - first
        starts = np.append(0, np.cumsum(size))
        columns = np.arange(starts[-1]) + np.repeat(first - starts[:-1], size)
        return cls(starts, columns, np.ones(len(columns), "int64"), width)

    def transposed(self) -> Rows:
        order = np.argsort(self.columns, kind="stable")
        height = len(self.starts) - 1
        own = np.repeat(np.arange(height), np.diff(self.starts))
        starts = np.append(0, np.cumsum(np.bincount(self.columns, minlength=self.width)))
        return Rows(starts, own[order], self.counts[order], height)

    def times(self, other: Rows) -> Rows:
        """Each row's entries call up the other's rows, whose columns are added up by row."""
        size = np.diff(other.starts)[self.columns]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(other.starts[self.columns] - (ends - size), size)
        height = len(self.starts) - 1
        row = np.repeat(np.repeat(np.arange(height), np.diff(self.starts)), size)
        key, place = np.unique(row * other.width + other.columns[at], return_inverse=True)
        counts = np.zeros(len(key), "int64")
        np.add.at(counts, place, np.repeat(self.counts, size) * other.counts[at])
        row, column = np.divmod(key, max(1, other.width))
        starts = np.append(0, np.cumsum(np.bincount(row, minlength=height)))
        return Rows(starts, column, counts, other.width)

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))
        return row, self.columns, self.counts


def token_links(ends_a: np.ndarray, ends_b: np.ndarray, kind: str = "end"
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(a, b, weight)`` of linked tokens that cover the same bytes, given where they end."""
    width = int(ends_a[-1]) if len(ends_a) else 0
    if kind == "overlap":
        a, b = (Rows.of_ranges(np.append(0, e[:-1])[:len(e)], e, width) for e in (ends_a, ends_b))
    elif kind == "end":
        a, b = (Rows.of_ranges(e - 1, e, width) for e in (ends_a, ends_b))
    elif kind == "group":
        cuts = ends_a[token_links(ends_a, ends_b)[0]]
        own = (np.searchsorted(cuts, e) for e in (ends_a, ends_b))
        a, b = (Rows.of_ranges(g, g + 1, len(cuts)) for g in own)
    else:
        raise ValueError(f"links are one of {KINDS}")
    return a.times(b.transposed()).entries()


def part_pattern(pieces: list[str]) -> re.Pattern | None:
    """Matches the parts of a text that can be tokenised by themselves.

    A part ends before white space, unless some piece goes on with that character, as with the
    carriage return after a semicolon; a single line end is a part. None if pieces hold line ends
    or spaces inside, so that only the whole text will do."""
    joint = {c for p in pieces for c in re.findall(f"(?<=[^{BLANK}{SPACE}])[{BLANK}{SPACE}]", p)}
    if joint & {" ", SPACE} or any("\n" in p for p in pieces):
        return None
    on = f"(?:[{re.escape(''.join(sorted(joint)))}][{BLANK}]*[^{BLANK}]*)*" if joint else ""
    return re.compile(f"\n(?=[^{BLANK}])|[{BLANK}]*[^{BLANK}]+{on}|[{BLANK}]+")


class ByteLevel:
    """A byte-level tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        vocabulary, added = told["model"]["vocab"], {t["content"] for t in told["added_tokens"]}
        # Bytes that stand for themselves; the others follow from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in plain]
        letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
        self.spelled = [b""] * (1 + max(vocabulary.values()))
        for token, number in vocabulary.items():
            if token not in added:
                self.spelled[number] = bytes(letters[c] for c in token)
        self.widths = np.array(list(map(len, self.spelled)))
        merges = (m.split(" ") if isinstance(m, str) else m for m in told["model"]["merges"])
        in_order = all(vocabulary["".join(m)] == 256 + i for i, m in enumerate(merges))
        split = told["pre_tokenizer"]
        if in_order and told["normalizer"] is None and split == {
                **split, "type": "ByteLevel", "add_prefix_space": False, "use_regex": True}:
            # Numbers rank the merges: the same tokens come from ranks, at a third of the cost.
            import tiktoken

            ranks = {t: i for i, t in enumerate(self.spelled) if t}
            self.one = tiktoken.Encoding("a", pat_str=PRETOKEN, mergeable_ranks=ranks,
                                         special_tokens={}).encode_ordinary
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.encode_special_tokens = True
            self.one = lambda t: tokenizer.encode(t, add_special_tokens=False).ids

    def encode(self, parts: list[str]) -> list[list[int]]:
        return list(map(self.one, parts))


class Pieces:
    """A piece model that adds a space before a text."""

    #: Comes back as it is, but for spaces, from a model that does not change texts.
    PROBE = "\ufb01 \u2460  e\u0301 \u3000A "

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.spelled = [bytes([int(n[3:-1], 16)]) if self.model.is_byte(i)
                        else n.replace(SPACE, " ").encode() for i, n in enumerate(names)]
        self.widths = np.array(list(map(len, self.spelled)))
        self.part = part_pattern(names)
        #: Whether only the space mark inside a text can come back as something else.
        self.faithful = (self.model.normalize(self.PROBE)
                         == SPACE + self.PROBE.replace(" ", SPACE))

    def encode(self, parts: list[str]) -> list[list[int]]:
        if self.part is None:
            return self.model.encode([p[1:] for p in parts], num_threads=1)
        # The space that the model adds and a line end, which joins nothing, go again.
        return [ids[2:] for ids in self.model.encode(["\n" + p for p in parts], num_threads=1)]


@lru_cache(maxsize=2)
def tokenizers(path_a: str, path_b: str) -> tuple[ByteLevel, Pieces]:
    return ByteLevel(path_a), Pieces(path_b)


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, lists), "int64", len(lists))
    return np.fromiter(chain.from_iterable(lists), "int64", int(size.sum())), size


@dataclass
class Aligned:
    """Parts of texts, tokenised both ways; tokens of parts that do not match are left out."""

    good: np.ndarray
    ids: tuple[np.ndarray, np.ndarray]
    part: tuple[np.ndarray, np.ndarray]
    ends: tuple[np.ndarray, np.ndarray]
    link: tuple[np.ndarray, np.ndarray]

    def codes(self) -> tuple[np.ndarray, np.ndarray]:
        """Linked id pairs as ``a << 32 | b``, and the part that each is in."""
        a, b = self.link
        return self.ids[0][a] << 32 | self.ids[1][b], self.part[0][a]

    def groups(self) -> list[bytes]:
        """Each part's groups, ``a1,a2|b1;`` and so on."""
        cuts = self.ends[0][self.link[0]]
        ids, part = (np.concatenate(x) for x in (self.ids, self.part))
        side = np.concatenate([2 * np.searchsorted(cuts, e) + s for s, e in enumerate(self.ends)])
        order = np.argsort(side, kind="stable")
        ids, part, side = ids[order], part[order], side[order]
        after = np.append(side[1:], -1)
        mark = np.where(after == side, ord(","), np.where(side % 2, ord(";"), ord("|")))
        digits = np.searchsorted(10 ** np.arange(1, 10), ids, "right") + 1
        size = digits + 1
        starts = np.cumsum(size) - size
        out = np.empty(int(size.sum()), "u1")
        out[starts + digits] = mark
        rest = ids.copy()
        for d in range(int(digits.max(initial=0))):
            has = digits > d
            out[(starts + digits - 1 - d)[has]] = ord("0") + rest[has] % 10
            rest //= 10
        stop = np.cumsum(np.bincount(part, weights=size, minlength=len(self.good))).astype(int)
        told = out.tobytes()
        return [told[lo:hi] for lo, hi in zip([0, *stop.tolist()], stop.tolist())]


def align_parts(parts: list[str], a: ByteLevel, b: Pieces) -> Aligned:
    raw = [p.encode() for p in parts]
    width = np.fromiter(map(len, raw), "int64", len(raw))
    told = [_flat(t.encode(parts)) for t in (a, b)]
    good = np.ones(len(parts), bool)
    for (ids, size), side in zip(told, (a, b), strict=True):
        spelled = list(map(side.spelled.__getitem__, ids.tolist()))
        own = np.bincount(np.repeat(np.arange(len(parts)), size), minlength=len(parts),
                          weights=side.widths[ids])
        if (own == width).all() and b"".join(spelled) == b"".join(raw):
            continue
        at = 0
        for i, n in enumerate(size.tolist()):
            good[i] &= b"".join(spelled[at:at + n]) == raw[i]
            at += n
    ids, part, ends = [], [], []
    for (flat, size), side in zip(told, (a, b), strict=True):
        keep = np.repeat(good, size)
        ids.append(flat[keep])
        part.append(np.repeat(np.arange(len(parts)), size)[keep])
        ends.append(np.cumsum(side.widths[ids[-1]]))
    link = token_links(ends[0], ends[1])[:2] if len(ids[0]) else (np.zeros(0, "int64"),) * 2
    return Aligned(good, tuple(ids), tuple(part), tuple(ends), link)


def bounded(parts: list[str], size: int = 1 << 18) -> Iterator[list[str]]:
    """Parts in turn, a bounded number of characters at a time."""
    held, n = [], 0
    for p in parts:
        held.append(p)
        n += len(p)
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


class Lookup:
    """Numbers of each distinct part; forgets past ``limit`` parts or 64 MB of them."""

    FIELDS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "bad")

    def __init__(self, a: ByteLevel, b: Pieces, counts: tuple | None = None,
                 limit: int = 150_000):
        self.a, self.b, self.counts, self.limit = a, b, counts, limit
        self.forget()

    def forget(self) -> None:
        self.numbers, self.groups, self.held = Numbers(), [], 0
        self.fields = np.zeros((0, len(self.FIELDS)), "int64")

    def split(self, text: str) -> list[str]:
        return self.b.part.findall(" " + text) if self.b.part else [" " + text]

    def _learn(self) -> None:
        new = [self.fields]
        for parts in bounded(self.numbers.fresh):
            own = align_parts(parts, self.a, self.b)
            codes, part = own.codes()
            rows = np.zeros((len(parts), len(self.FIELDS)), "int64")

            def count(of: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
                return np.bincount(of, weights=weights, minlength=len(parts)).astype("int64")

            rows[:, 0], rows[:, 1] = map(count, own.part)
            rows[:, 2] = rows[:, 3] = count(part)
            if self.counts is not None:
                known, times, best = self.counts
                # Parts of texts without tokens may hold pairs that count nowhere.
                at = np.searchsorted(known[:-1], codes)
                told = known[at] == codes if len(known) else np.zeros(len(codes), bool)
                at, own_part = at[told], part[told]
                rows[:, 4], rows[:, 5] = count(own_part, best[at]), count(own_part, times[at])
                self.groups += own.groups()
            rows[:, 6] = ~own.good
            new.append(rows)
            self.held += sum(map(len, parts))
        self.fields = np.concatenate(new)
        self.numbers.fresh.clear()

    def read(self, texts: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Fields summed over each text, and the numbers of its parts."""
        if len(self.numbers) > self.limit or self.held > 1 << 26:
            self.forget()
        split = [self.split(t) if t else [] for t in texts]
        size = np.fromiter(map(len, split), "int64", len(split))
        own = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(split)), "int64",
                          int(size.sum()))
        if self.numbers.fresh:
            self._learn()
        ends = np.cumsum(size)
        sums = np.concatenate([np.zeros((1, len(self.FIELDS)), "int64"),
                               np.cumsum(self.fields[own], axis=0)])
        total = sums[ends] - sums[ends - size]
        total[total[:, -1] > 0, :-1] = 0
        return total, np.split(own, ends[:-1])


def count_parts(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``(part, n)``: how often each part occurs in the texts that have tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = tokenizers(path_a, path_b)
        lookup, seen, held = Lookup(a, b), Counter(), 0
        for batch in chain.from_iterable(map(lambda x: slices(x, 100), batches)):
            texts = [t for t in batch.column("text").to_pylist() if t]
            # A text that may not come back as it is must be tokenised to be sure.
            odd = [t for t in texts if not b.faithful or SPACE in t]
            wrong = {t for t, f in zip(odd, lookup.read(odd)[0][:, -1].tolist())
                     if f} if odd else ()
            for text in texts:
                if text not in wrong:
                    seen.update(lookup.split(text))
            held += sum(map(len, texts))
            if len(seen) > 150_000 or held > 1 << 26 and len(seen) > 1000:
                yield from _told(seen)
                seen, held = Counter(), 0
        yield from _told(seen)

    return (docs.select("text").mapInArrow(lean(run), "part string, n long")
            .groupBy("part").agg(F.sum("n").alias("n")))


def _told(seen: Counter) -> Iterator[pa.RecordBatch]:
    keys, counts = list(seen), list(seen.values())
    for lo in range(0, len(keys), 20_000):
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys[lo:lo + 20_000], pa.string()),
             pa.array(counts[lo:lo + 20_000], pa.int64())], ["part", "n"])


def _added(codes: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    known, place = np.unique(np.concatenate(codes), return_inverse=True)
    total = np.zeros(len(known), "int64")
    np.add.at(total, place, np.concatenate(times))
    return known, total


def pair_counts(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``(pair, n)`` with ``pair`` ``a << 32 | b``: links over the corpus that hold the id pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = tokenizers(path_a, path_b)
        codes, times, held = [np.zeros(0, "int64")], [np.zeros(0, "int64")], 0
        for batch in chain.from_iterable(map(lambda x: slices(x, 5000), batches)):
            n, at = batch.column("n").to_numpy(), 0
            for parts in bounded(batch.column("part").to_pylist()):
                own, part = align_parts(parts, a, b).codes()
                codes.append(own)
                times.append(n[at:at + len(parts)][part])
                at += len(parts)
                held += len(own)
            if held > 1 << 20:
                codes, times = ([x] for x in _added(codes, times))
                held = 0
        known, total = _added(codes, times)
        yield pa.RecordBatch.from_arrays([pa.array(known), pa.array(total)], ["pair", "n"])

    return (count_parts(docs, path_a, path_b).mapInArrow(lean(run), "pair long, n long")
            .groupBy("pair").agg(F.sum("n").alias("n")))


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)`` of each row.

    ``n_best`` links hold a pair that is the most frequent of its second id, ties included;
    ``count_sum`` adds up how often the pairs of all links are linked in the corpus. ``groups`` is
    ``a1,a2|b1;a3|b2,b3``: ids of both tokenizers by group."""
    found = pair_counts(docs, path_a, path_b).toArrow()
    pair, n = (found.column(c).to_numpy() for c in ("pair", "n"))
    order = np.argsort(pair)
    pair, n = pair[order], n[order]
    second = pair & 0xFFFFFFFF
    most = np.zeros(int(second.max(initial=0)) + 1, "int64")
    np.maximum.at(most, second, n)
    shared = docs.sparkSession.sparkContext.broadcast((pair, n, n == most[second]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(*tokenizers(path_a, path_b), shared.value)
        for batch in chain.from_iterable(map(lambda x: slices(x, 100), batches)):
            total, own = lookup.read(batch.column("text").to_pylist())
            told = [b"" if bad else b"".join([lookup.groups[i] for i in parts.tolist()])[:-1]
                    for parts, bad in zip(own, total[:, -1].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c) for c in total.T[:-1]],
                 pa.array([t.decode() for t in told], pa.string())],
                ["doc_id", *Lookup.FIELDS[:-1], "groups"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lean(run), ALIGNED)


def links(docs: DataFrame, path_a: str, path_b: str, kind: str = "overlap") -> DataFrame:
    """``(doc_id, a, b, weight)`` of each row: linked tokens by their places in the text.

    Weights are the bytes that two tokens share (``overlap``), else one: for two tokens of a group
    (``group``) or two that end together (``end``)."""
    if kind not in KINDS:
        raise ValueError(f"links are one of {KINDS}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = tokenizers(path_a, path_b)
        lookup = Lookup(a, b)
        for batch in chain.from_iterable(map(lambda x: slices(x, 20), batches)):
            found = []
            for text in batch.column("text").to_pylist():
                own = align_parts(lookup.split(text), a, b) if text else None
                whole = own is not None and own.good.all()
                found.append(token_links(*own.ends, kind) if whole else ([],) * 3)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array([np.asarray(f[i], "int32") for f in found],
                                                    pa.list_(pa.int32())) for i in range(3)]],
                ["doc_id", "a", "b", "weight"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lean(run), LINKS)
