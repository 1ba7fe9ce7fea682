from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from helpers import docs, prose
from perfspark.llm import chunks, hmm


def _plain_log_likelihood(m, classes):
    a = m.start * m.emit[classes[0]]
    log = 0.0
    for c in classes[1:]:
        log += math.log(a.sum())
        a = (a / a.sum()) @ m.move * m.emit[c]
    return log + math.log(a.sum())


def _model(states=3, seed=1):
    rng = np.random.default_rng(seed)
    m = hmm.Model.random(states, seed)
    m.emit = m.emit * rng.uniform(0.1, 3, m.emit.shape)
    m.emit /= m.emit.sum(axis=0)
    return m


def test_chained_segments_give_the_plain_recursion():
    rng = np.random.default_rng(0)
    lengths = np.array([1, 2, hmm.SEGMENT - 1, hmm.SEGMENT, hmm.SEGMENT + 1, 5 * hmm.SEGMENT, 1300])
    classes = rng.integers(0, hmm.CLASSES, lengths.sum())
    m = _model()
    got = hmm.log_likelihood(m, classes, lengths)
    ends = np.cumsum(lengths)
    for value, lo, hi in zip(got, ends - lengths, ends):
        assert value == pytest.approx(_plain_log_likelihood(m, classes[lo:hi]), rel=1e-10)
    assert hmm.log_likelihood(m, np.zeros(0, "int64"), np.zeros(0, "int64")).size == 0


def test_expected_counts_against_plain_forward_backward():
    rng = np.random.default_rng(3)
    lengths = np.array([1, 3, hmm.SEGMENT + 7, 2 * hmm.SEGMENT])
    classes = rng.integers(0, 20, lengths.sum())
    m = _model(seed=4)
    start, move, emit = hmm.split_counts(hmm.expected_counts(m, classes, lengths), 3)
    s, t, e = np.zeros(3), np.zeros((3, 3)), np.zeros((hmm.CLASSES, 3))
    ends = np.cumsum(lengths)
    for lo, hi in zip(ends - lengths, ends):
        own = classes[lo:hi]
        a, b = np.zeros((len(own), 3)), np.ones((len(own), 3))
        for i, c in enumerate(own):
            a[i] = (m.start if not i else a[i - 1] @ m.move) * m.emit[c]
            a[i] /= a[i].sum()
        for i in range(len(own) - 2, -1, -1):
            b[i] = m.move @ (m.emit[own[i + 1]] * b[i + 1])
            b[i] /= b[i].sum()
        g = a * b / (a * b).sum(axis=1, keepdims=True)
        s += g[0]
        np.add.at(e, own, g)
        for i in range(1, len(own)):
            x = a[i - 1][:, None] * m.move * (m.emit[own[i]] * b[i])
            t += x / x.sum()
    assert np.allclose(start, s, atol=1e-4)
    assert np.allclose(move, t, atol=1e-3)
    assert np.allclose(emit, e, atol=1e-3)


def test_texts_of_a_thousand_words_need_no_transfers_and_counts_add_up():
    rng = np.random.default_rng(11)
    lengths = np.array([1000, 300, 7, 1, 260])
    classes = rng.integers(0, hmm.CLASSES, lengths.sum())
    m = _model(seed=2)
    x, _, _ = hmm._transfers(m, hmm.Segments(classes, lengths))
    assert not len(x)
    for sizes in (lengths, np.array([len(classes)]), np.array([5, len(classes) - 5])):
        start, move, emit = hmm.split_counts(hmm.expected_counts(m, classes, sizes), 3)
        assert start.sum() == pytest.approx(len(sizes), rel=1e-11)
        assert move.sum() == pytest.approx(len(classes) - len(sizes), rel=1e-11)
        assert np.allclose(emit.sum(axis=1), np.bincount(classes, minlength=hmm.CLASSES),
                           rtol=1e-11, atol=1e-11)


def test_rounds_read_the_classes_of_training_documents_alone():
    rng = np.random.default_rng(5)
    classes = rng.integers(0, hmm.CLASSES, 300).astype("<u2")
    lengths, marks = [3, hmm.SEGMENT + 70, 1, 40, 2 * hmm.SEGMENT + 1], [0, 0, 1, 1, 0]
    tokens = rng.integers(0, 300, sum(lengths))
    chunk = {"tokens": chunks.squeeze(tokens), "classes": classes.tobytes(),
             "lengths": lengths, "marks": marks}
    rows = pa.RecordBatch.from_pylist([chunk, {**chunk, "marks": [1] * 5}])
    out = list(hmm._training_classes(iter([rows])))
    assert [b.schema.names for b in out] == [["training", "lengths"]] * 2
    sizes = [len(chunks.unsqueeze(b.column(0)[0].as_py(), 2)) for b in out]
    own = np.repeat(np.array(marks) == 0, lengths)
    assert sizes == [own.sum(), 0]
    m = _model(seed=6)
    got = next(hmm._e_step(iter(out), m))
    total = np.zeros(3 + 9 + 3 * hmm.CLASSES)
    total[got.column(0).to_numpy()] = got.column(1).to_numpy()
    plain = hmm.expected_counts(m, classes[tokens][own],
                                np.array([n for n, x in zip(lengths, marks) if not x]))
    assert np.allclose(total, plain, rtol=1e-12)


def test_rounds_raise_the_likelihood():
    rng = np.random.default_rng(7)
    lengths = np.full(40, 50)
    half = rng.integers(0, 10, 1000), rng.integers(10, 20, 1000)
    classes = np.concatenate(half)
    m, last = _model(seed=9), -np.inf
    for _ in range(6):
        now = hmm.log_likelihood(m, classes, lengths).sum()
        assert now > last
        last = now
        m = hmm.Model.from_counts(hmm.expected_counts(m, classes, lengths), 3)


def _words(text):
    low = re.sub("[A-Z]", lambda x: x.group().lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), ""]


def _is_held(i, folds=10):
    return i is None or zlib.crc32(str(i).encode()) % folds == 0


def test_base_scores_against_brute_force_and_model_beats_them(spark):
    german = [prose(120, i, 200).replace("w", "über") for i in range(60)]
    texts = [*[prose(120, i, 200) for i in range(60)], *german, None, "", "É é A a\x0bb", "w1 " * 5000]
    ids = [*range(len(texts) - 1), None]
    got = hmm.score(docs(spark, texts, ids=ids, clash=True), states=3).collect()
    train = Counter(w for i, t in zip(ids, texts) if not _is_held(i) for w in _words(t))
    n, v = sum(train.values()), len(train)
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(texts)
    held = [0.0, 0.0]
    for i, t in zip(ids, texts, strict=True):
        r, words = by_id[i], _words(t)
        base = sum(math.log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (_is_held(i), len(words), n)
        assert r.n_known == sum(train[w] > 0 for w in words)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        if r.held_out:
            held = [held[0] + r.score, held[1] + r.base_score]
    assert held[0] > held[1]


def test_class_model_is_a_distribution_over_words(spark):
    texts = [prose(30, i, 50) for i in range(30)]
    got = {r.doc_id: r for r in hmm.score(docs(spark, [*texts, ""]), states=2).collect()}
    assert all(r.score < 0 for r in got.values())


def test_empty_table_and_nothing_to_train_on(spark):
    assert hmm.score(docs(spark, [])).count() == 0
    r = hmm.score(docs(spark, ["a b"], ids=[None])).first()
    assert (r.train_tokens, r.n_known, r.n_tokens) == (0, 0, 3)
    assert r.base_score == pytest.approx(0.0) and math.isfinite(r.score)


def test_a_long_first_text_trains_states_apart(spark):
    block = "a " * 50 + "b " * 50
    texts = [block * 4001, *[block * 2] * 20]
    ids = [i for i in range(100) if not _is_held(i)][:len(texts)]
    got = hmm.score(docs(spark, texts, ids=ids), states=2).collect()
    assert len(got) == len(texts)
    for r in got:
        # A unigram gives log10(0.5) a word, states of their own nearly 0.
        assert r.score > 0.5 * r.base_score


def test_every_round_counts_every_chunk(spark):
    texts = [prose(60, i, 200) for i in range(40)]
    rows = docs(spark, texts).selectExpr("doc_id", "0L as mark", "text").repartition(4)
    chunks, _ = hmm.encode(rows, lower=True, end=True, word_class=hmm.word_class)
    chunks = chunks.cache()
    m = hmm.Model.random(3, 17)
    for _ in range(3):
        total = sum(hmm.expected_counts(m, *hmm._chunk_classes(r.asDict(), {0}))
                    for r in chunks.collect())
        m = hmm.Model.from_counts(total, 3)
    got = hmm.train(chunks, 3, rounds=3)
    assert chunks.count() > 1
    for name in ("start", "move", "emit"):
        assert np.allclose(getattr(got, name), getattr(m, name), rtol=1e-5, atol=1e-9)
