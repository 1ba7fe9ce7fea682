"""A hidden Markov language model over a whole corpus.

Latent states emit words by way of word classes (hashes of a word's last letters): a state has a
distribution over the bounded set of classes, and a class one over its words, estimated from the
counts of the whole training corpus. So the model is exact over any vocabulary, while what the
tasks need at hand stays bounded. Baum-Welch counts of every training document are taken in all
partitions and added up by state and class; forward recursion is scaled and gives each text's
exact log likelihood. Long texts are cut into segments whose transfer matrices are chained, which
is the same recursion in another order and lets segments run side by side.

Words are runs of characters outside [\\x20\\x09-\\x0D] with A-Z lower-cased, then one end. Null
texts are empty: the end alone. Repeated rows are counted and scored as rows; rows without an id
are held out. Without any training row all counts are 0. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import cut
from .chunks import encode, squeeze, unsqueeze, with_words
from .common import drop_table, held_out, lean

CLASSES = 2048
#: Longer texts are cut: transfer matrices cost as many times more as there are states.
SEGMENT = 1024
#: Weights are scaled each so many steps; with far more they could leave the range of numbers.
RESCALE = 8
#: Words whose states are added up by class at once.
COUNTED = 1 << 14
ADD = 0.1


def word_class(word: bytes) -> int:
    """The end is class 0; other words share a class with those of the same last three bytes."""
    return 1 + xxhash.xxh32_intdigest(word[-3:]) % (CLASSES - 1) if word else 0


class Model:
    """``start`` by state, ``move`` by state and next state, ``emit`` by class and state."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit

    @classmethod
    def random(cls, states: int, seed: int) -> Model:
        rng = np.random.default_rng(seed)
        move = rng.random((states, states)) + 8 * np.eye(states)
        emit = rng.random((CLASSES, states)) + 0.5
        return cls(np.full(states, 1 / states), move / move.sum(axis=1, keepdims=True),
                   emit / emit.sum(axis=0))

    @classmethod
    def from_counts(cls, counts: np.ndarray, states: int) -> Model:
        start, move, emit = split_counts(counts, states)
        start, move, emit = start + ADD, move + ADD, emit + ADD
        return cls(start / start.sum(), move / move.sum(axis=1, keepdims=True),
                   emit / emit.sum(axis=0))


def split_counts(counts: np.ndarray, states: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    a, b = states, states + states * states
    return counts[:a], counts[a:b].reshape(states, states), counts[b:].reshape(CLASSES, states)


class Segments:
    """The segments of a chunk's documents, longest first, and their order in each document.

    ``symbols`` has the classes step by step: those of all segments at their first word, then at
    their second and so on; step ``t`` has ``active[t]`` of them from ``at[t]`` on."""

    def __init__(self, classes: np.ndarray, lengths: np.ndarray, laid: bool = False):
        """``classes`` document by document or, if ``laid``, step by step."""
        per_doc = -(-lengths // SEGMENT)
        self.doc = np.repeat(np.arange(len(lengths)), per_doc)
        first = np.cumsum(per_doc) - per_doc
        self.rank = np.arange(len(self.doc)) - first[self.doc]
        begin = (np.cumsum(lengths) - lengths)[self.doc] + self.rank * SEGMENT
        self.size = np.minimum(SEGMENT, lengths[self.doc] - self.rank * SEGMENT)
        order = np.argsort(-self.size, kind="stable")
        self.doc, self.rank, self.size = self.doc[order], self.rank[order], self.size[order]
        self.more = per_doc[self.doc] > 1
        self.docs = len(lengths)
        self._steps()
        if laid:
            self.symbols = classes
            return
        self.symbols = np.empty(int(self.active.sum()), classes.dtype)
        place = begin[order]
        for at, n in zip(self.at.tolist(), self.active.tolist()):
            np.take(classes, place[:n], out=self.symbols[at:at + n], mode="clip")
            place += 1

    def _steps(self) -> None:
        self.steps = int(self.size[0]) if len(self.size) else 0
        self.active = len(self.size) - np.searchsorted(self.size[::-1], np.arange(self.steps),
                                                       "right")
        self.at = np.cumsum(self.active) - self.active

    def only(self, which: np.ndarray) -> Segments:
        """Some of the segments, given by number in rising order."""
        part = Segments.__new__(Segments)
        part.docs = self.docs
        part.doc, part.rank, part.size = self.doc[which], self.rank[which], self.size[which]
        part.more = self.more[which]
        part._steps()
        part.symbols = np.empty(int(part.active.sum()), self.symbols.dtype)
        for at, n, own in zip(part.at.tolist(), part.active.tolist(), self.at.tolist()):
            np.take(self.symbols[own:], which[:n], out=part.symbols[at:at + n], mode="clip")
        return part

    def by_rank(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(segments, their predecessors)`` for rank 0, 1 ...; rank 0 has none. Segments of a
        document that has no other are left out."""
        at = np.full(self.docs, -1)
        some = np.nonzero(self.more)[0]
        some = some[np.argsort(self.rank[some], kind="stable")]
        cuts = np.nonzero(np.diff(self.rank[some]))[0] + 1
        for own in np.split(some, cuts) if len(some) else ():
            yield own, at[self.doc[own]]
            at[self.doc[own]] = own


def _forward(m: Model, s: Segments, begin: np.ndarray, keep: np.ndarray | None = None
             ) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Last state weights, log of the scale so far and scales of each ``RESCALE``th step, for
    segments that start with ``begin`` weights (rank 0 by ``m.start``). ``keep`` takes the weights
    after each step, step by step."""
    k, log, scales = len(m.start), np.zeros(len(begin)), []
    end, first, ones = np.empty_like(begin), s.rank == 0, np.ones(k)
    spare, emitted = np.empty((2, len(begin), k)), np.empty((len(begin), k))
    active, starts, last = [*s.active.tolist(), 0], s.at.tolist(), begin
    for t in range(s.steps):
        n, at, e = active[t], starts[t], emitted[:active[t]]
        now = spare[t % 2, :n] if keep is None else keep[at:at + n]
        np.matmul(last[:n], m.move, out=now)
        if t == 0:
            now[first] = m.start
        np.take(m.emit, s.symbols[at:at + n], axis=0, out=e, mode="clip")
        now *= e
        if t % RESCALE == RESCALE - 1:
            total = now @ ones
            now /= total[:, None]
            log[:n] += np.log(total)
            scales.append(total)
        end[active[t + 1]:n] = now[active[t + 1]:]
        last = now
    return end, log, scales


def _transfers(m: Model, s: Segments) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scaled transfer matrices of the segments after a document's first, and their log scale."""
    later = np.nonzero(s.rank > 0)[0]
    k = len(m.start)
    x = np.broadcast_to(np.eye(k), (len(later), k, k)).copy()
    log = np.zeros(len(later))
    place = np.full(len(s.rank), -1)
    place[later] = np.arange(len(later))
    if not len(later):
        return x, log, place
    own = s.only(later)
    moved, emitted = np.empty((2, len(later) * k, k))
    for t, (at, n) in enumerate(zip(own.at.tolist(), own.active.tolist())):
        now, e = moved[:n * k], emitted[:n * k]
        np.matmul(x[:n].reshape(-1, k), m.move, out=now)
        np.take(m.emit, np.repeat(own.symbols[at:at + n], k), axis=0, out=e, mode="clip")
        np.multiply(now, e, out=x[:n].reshape(-1, k))
        if t % RESCALE == RESCALE - 1:
            top = x[:n].max(axis=(1, 2))
            x[:n] /= top[:, None, None]
            log[:n] += np.log(top)
    return x, log, place


def _chain(m: Model, s: Segments, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple]:
    """Begin weights of every segment, and each document's log likelihood as far as its first
    segment is among ``heads``; those that others follow have to be."""
    k = len(m.start)
    begin, end = np.zeros((len(s.rank), k)), np.zeros((len(s.rank), k))
    total = np.zeros(s.docs)
    if len(heads):
        last, log, _ = _forward(m, s.only(heads), begin[heads])
        size = last.sum(axis=1)
        end[heads] = last / size[:, None]
        total[s.doc[heads]] += log + np.log(size)
    transfers = _transfers(m, s)
    x, scale, place = transfers
    for rank, (own, before) in enumerate(s.by_rank()):
        if rank:
            begin[own] = end[before]
            out = np.einsum("nk,nkj->nj", begin[own], x[place[own]])
            size = out.sum(axis=1)
            end[own] = out / size[:, None]
            total[s.doc[own]] += np.log(size) + scale[place[own]]
    return begin, total, transfers


def log_likelihood(m: Model, classes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Natural log likelihood of each document's classes."""
    s = Segments(classes, lengths)
    return _chain(m, s, np.nonzero(s.rank == 0)[0])[1]


def expected_counts(m: Model, classes: np.ndarray, lengths: np.ndarray, laid: bool = False
                    ) -> np.ndarray:
    """Baum-Welch counts of all documents: starts, moves, and emissions by class and state. With
    ``laid`` classes are in the order of ``Segments.symbols``.

    The weights that come back from a segment's end are scaled so that, times those that came
    forward, they add up to one at its last step; then they do so at every step."""
    k = len(m.start)
    s = Segments(classes, lengths, laid)
    if not len(s.rank):
        return np.zeros(k + k * k + CLASSES * k)
    begin, _, (x, _, place) = _chain(m, s, np.nonzero((s.rank == 0) & s.more)[0])
    last = np.ones((len(s.rank), k))
    for own, before in reversed(list(s.by_rank())):
        some = before >= 0
        if some.any():
            back = np.einsum("nkj,nj->nk", x[place[own[some]]], last[own[some]])
            last[before[some]] = back / back.sum(axis=1, keepdims=True)
    weights = np.empty((len(s.symbols), k))
    end, _, scales = _forward(m, s, begin, weights)
    start, move, emit = np.zeros(k), np.zeros((k, k)), np.zeros((k, CLASSES))
    beta, first = last / (end * last).sum(axis=1, keepdims=True), s.rank == 0
    emitted, back = np.empty_like(beta), np.ascontiguousarray(m.move.T)
    both, filled = np.empty((COUNTED + len(beta), k)), COUNTED + len(beta)
    active, starts, done = s.active.tolist(), s.at.tolist(), len(weights)
    for t in range(s.steps - 1, -1, -1):
        n, at = active[t], starts[t]
        ahead, own = emitted[:n], beta[:n]
        np.take(m.emit, s.symbols[at:at + n], axis=0, out=ahead, mode="clip")
        ahead *= own
        if t % RESCALE == RESCALE - 1:
            ahead /= scales[t // RESCALE][:, None]
        np.multiply(weights[at:at + n], own, out=both[filled - n:filled])
        filled -= n
        if t:
            move += weights[starts[t - 1]:starts[t - 1] + n].T @ ahead
            np.matmul(ahead, back, out=own)
        else:
            start += both[filled:filled + n][first].sum(axis=0)
            move += begin[~first].T @ ahead[~first]
        if done - at >= COUNTED or not t:  # while they are at hand
            symbols = s.symbols[at:done].astype("int64")
            for j in range(k):
                emit[j] += np.bincount(symbols, both[filled:, j], CLASSES)
            done, filled = at, len(both)
    move *= m.move
    return np.concatenate([start, move.ravel(), emit.T.ravel()])


def _chunk_classes(row: dict, marks: set[int] | None) -> tuple[np.ndarray, np.ndarray]:
    """Class of every word of the chunk's documents with these marks, and their lengths."""
    classes = np.frombuffer(row["classes"], "<u2")[unsqueeze(row["tokens"])]
    lengths = np.array(row["lengths"], "int64")
    if marks is None:
        return classes, lengths
    own = np.isin(np.array(row["marks"], "int64"), list(marks))
    return classes[np.repeat(own, lengths)], lengths[own]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _training_classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes of each chunk's training documents, step by step, and the documents' lengths."""
    for row in _rows(batches):
        classes, lengths = _chunk_classes(row, {0})
        yield pa.RecordBatch.from_pylist([{
            "training": squeeze(Segments(classes, lengths).symbols, 2),
            "lengths": lengths.astype("<i8").tobytes()}])


def _e_step(batches: Iterator[pa.RecordBatch], m: Model) -> Iterator[pa.RecordBatch]:
    total = 0.0
    for row in _rows(batches):
        classes = unsqueeze(row["training"], 2)
        lengths = np.frombuffer(row["lengths"], "<i8")
        total = total + expected_counts(m, classes, lengths, laid=True)
    if np.ndim(total):
        some = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["at", "n"])


def train(chunks: DataFrame, states: int = 6, rounds: int = 14, seed: int = 17) -> Model:
    """A model by ``rounds`` of Baum-Welch, each over all training documents, from a seeded random
    start; neither the order of rows nor their place in files decides anything."""
    size = states + states * states + CLASSES * states
    model = Model.random(states, seed)
    # Rounds read classes alone, of training documents alone.
    training = cut(chunks.mapInArrow(lean(_training_classes), "training binary, lengths binary"))
    for _ in range(rounds):
        counts = training.mapInArrow(lambda b, m=model: _e_step(b, m), "at long, n double")
        total = np.zeros(size)
        for r in counts.groupBy("at").agg(F.sum("n").alias("n")).collect():
            total[r["at"]] = r["n"]
        model = Model.from_counts(total, states)
    drop_table(training)
    return model


def _score_chunk(own: pa.Table, row: dict, m: Model, base: float, by_class: np.ndarray
                 ) -> pa.Table:
    counts = own.column("c").to_numpy()
    tokens, lengths = unsqueeze(row["tokens"]), np.array(row["lengths"], "int64")
    classes = np.frombuffer(row["classes"], "<u2")[tokens]
    starts = np.cumsum(lengths) - lengths

    def per_doc(values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, starts) if len(starts) else np.zeros(0)

    words = per_doc(np.log10(counts + ADD)[tokens])
    known = per_doc((counts > 0).astype("int64")[tokens])
    inside = words - per_doc(by_class[classes])
    latent = log_likelihood(m, classes, lengths) / np.log(10)
    return pa.table({
        "doc_id": pa.array(row["doc_ids"], pa.int64()),
        "held_out": pa.array([x != 0 for x in row["marks"]], pa.bool_()),
        "n_tokens": pa.array(lengths), "n_known": pa.array(known.astype("int64")),
        "base_score": pa.array(words - lengths * base), "score": pa.array(latent + inside)})


def score(docs: DataFrame, folds: int = 10, states: int = 6, rounds: int = 14) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` per row."""
    rows = docs.select(F.col("doc_id").cast("long"), held_out("doc_id", folds).cast("long")
                       .alias("mark"), "text")
    chunks, words = encode(rows, lower=True, end=True, word_class=word_class)
    counts = cut(words.groupBy("word").agg(F.sum("n").alias("c"), F.min("class").alias("class"))
                 .where("c > 0"))
    by_class = counts.groupBy("class").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")
                                           ).collect()
    n, v = sum(r.n for r in by_class), sum(r.v for r in by_class)
    whole = np.full(CLASSES, np.log10(ADD))
    for r in by_class:
        whole[r["class"]] = np.log10(r.n + ADD * (r.v + 1))
    base = float(np.log10(n + ADD * (v + 1)))
    model = train(chunks, states, rounds)
    # A hash join: words of all chunks need no sort.
    counted = (words.select("chunk", "local", "word")
               .join(counts.select("word", "c").hint("shuffle_hash"), "word", "left")
               .select("chunk", "local", F.coalesce("c", F.lit(0)).alias("c")))
    out = with_words(counted, chunks, lambda w, c: _score_chunk(w, c, model, base, whole),
                     "doc_id long, held_out boolean, n_tokens long, n_known long, "
                     "base_score double, score double")
    return out.withColumn("train_tokens", F.lit(n).cast("long"))
