from __future__ import annotations

import math
import random

import numpy as np
import pytest

from helpers import docs, prose, rows
from perfspark.llm import quality, queries

LABELS = "doc_id long, quality int, toxic int"
SF = "/root/testdata/sf0.1"


def _plain(examples, size, rounds, rate, smooth, l1, l2):
    """The updates one feature at a time, from their definition."""
    z, n = [0.0] * size, [0.0] * size

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((smooth + math.sqrt(n[i])) / rate + l2)

    for _ in range(rounds):
        for x, label in examples:
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x.items())))
            for i, v in x.items():
                g = (p - label) * v
                step = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / rate
                z[i] += g - step * w[i]
                n[i] += g * g
    return [weight(i) for i in range(size)]


def test_one_shard_equals_the_plain_updates(spark):
    rng = random.Random(3)
    data = [(i, " ".join(rng.choice(["red", "blue", "up", "down"]) for _ in range(rng.randint(0, 9))),
             i % 2) for i in range(60)]
    frame = spark.createDataFrame(data, "doc_id long, text string, label int")
    settings = dict(rate=0.5, smooth=1.0, l1=0.05, l2=1.0)
    got = quality.fit(frame, bits=8, order=2, rounds=3, **settings)
    hashes, examples = quality.Hashes(), []
    for r in quality.hashed(frame, 8, 2, 1).orderBy("place", "label").collect():
        x = dict(zip(r.features, quality.values(np.array(r.counts)), strict=True))
        examples.append(({**x, 256: 1.0}, r.label))
    want = _plain(examples, 257, 3, *settings.values())
    assert np.allclose(got, want, atol=1e-6) and np.count_nonzero(got) > 5
    told = {t: dict(zip(*(v.tolist() for v in quality.ngrams(t, hashes, 8, 2)), strict=True))
            for t in ("red red", "red")}
    assert sum(told["red"].values()) == 1 and sum(told["red red"].values()) == 4


def test_a_score_is_the_sparse_dot_product(spark):
    frame = docs(spark, [prose(40, i) + (" | |" if i % 4 == 0 else "") for i in range(80)])
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(80)], LABELS)
    weights = quality.fit(quality.training_rows(frame, labels), bits=18)
    hashes = quality.Hashes()
    got = {r.doc_id: r.score for r in quality.score(frame, labels).collect()}
    for r in frame.collect():
        features, counts = quality.ngrams(r.text, hashes, 18, 2)
        norm = math.sqrt(sum(c * c for c in counts.tolist()))
        margin = weights[-1] + sum(weights[f] * c / norm for f, c in zip(features, counts))
        assert got[r.doc_id] == pytest.approx(1 / (1 + math.exp(-margin)))


def test_held_out_rows(spark):
    """Accuracy on rows that training has not seen, and no use of their labels."""
    frame = queries.table(spark, SF, "documents").join(
        queries.table(spark, SF, "labels").select("doc_id"), "doc_id", "left_semi")
    labels = queries.table(spark, SF, "labels")
    label = {r.doc_id: r.quality for r in labels.collect()}
    out = quality.score(frame, labels).withColumn("held", quality.held_out("doc_id", 5)).collect()
    held = [r for r in out if r.held]
    good = [r for r in held if label[r.doc_id] == 1]
    bad = [r for r in held if label[r.doc_id] == 0]
    assert sum(r.predicted for r in good) >= 0.99 * len(good)
    assert sum(1 - r.predicted for r in bad) >= 0.9 * len(bad)


def test_labels_of_held_out_rows_are_never_read(spark):
    frame = docs(spark, [prose(30, i) + (" $$$ $$$" if i % 3 == 0 else "") for i in range(120)])
    held = {r.doc_id for r in frame.where(quality.held_out("doc_id", 5)).collect()}
    plain = [(i, int(i % 3 > 0), 0) for i in range(120)]
    turned = [(i, 1 - q if i in held else q, 0) for i, q, _ in plain]
    a, b = (rows(quality.score(frame, spark.createDataFrame(x, LABELS)), "doc_id", "score")
            for x in (plain, turned))
    assert held and a == b


def test_shards_do_not_change_with_the_order_of_rows(spark):
    frame = docs(spark, [prose(30, i) + (" $$$" if i % 3 == 0 else "") for i in range(120)])
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(120)], LABELS)
    train = quality.training_rows(frame, labels)
    one = quality.fit(train, bits=12, shard_rows=20)
    other = quality.fit(train.repartition(7), bits=12, shard_rows=20)
    assert (one == other).all() and np.count_nonzero(one)


def test_edges(spark):
    none = spark.createDataFrame([], LABELS)
    frame = docs(spark, [None, "", "x " * 100_000, "$"], ids=[None, 1, 1, 2], clash=True)
    got = rows(quality.score(frame, none), "doc_id", "score", "predicted")
    assert got == [(1, 0.5, 1), (1, 0.5, 1), (2, 0.5, 1), (None, 0.5, 1)]
    assert quality.score(docs(spark, []), none).count() == 0
    odd = spark.createDataFrame([(1, None, None), (None, 0, 1), (2, 7, 0), (2, 0, 1), (2, 1, 0)],
                                LABELS)
    assert quality.score(frame, odd).count() == 4
    assert [r.label for r in quality.training_rows(frame, odd, sample=None).collect()] == [1]
