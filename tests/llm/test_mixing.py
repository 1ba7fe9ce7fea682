from __future__ import annotations

from collections import defaultdict
from itertools import product

import numpy as np
import pytest

from helpers import docs, rows
from perfspark.llm import mixing


def _targets(sizes: dict, weights=(3, 1, 2), share=1.5, cap=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    names += [None] if None in sizes else []
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > cap * sizes[s]}
        if not over:
            out |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
        open_ -= over
    return out


@pytest.mark.parametrize("seed", range(3))
def test_targets_and_budgets(spark, seed):
    rng = np.random.default_rng(seed)
    texts, sources = [], []
    for s, n in (("b", 300), ("a", 20), ("é", 40), ("Z", 5), (None, 60)):
        for _ in range(n):
            texts.append("w " * int(rng.integers(0, 200)))
            sources.append(s)
    out = mixing.mix(docs(spark, texts, sources, clash=True)).collect()
    assert len(out) == len(texts)
    sizes, taken, seen = defaultdict(int), defaultdict(int), {}
    for r in out:
        assert r.size == len(r.row.text.split()) and 0 <= r.repeats <= 2
        sizes[r.row.source] += r.size
        taken[r.row.source] += r.size * r.repeats
        seen[r.row.source] = r.target
    want = _targets(sizes)
    for s in sizes:
        assert seen[s] == pytest.approx(want[s], rel=1e-12)
        assert abs(taken[s] - want[s]) <= 1
    again = mixing.mix(docs(spark, texts, sources, clash=True))
    assert rows(again.select("row.doc_id", "repeats"), "doc_id", "repeats") == sorted(
        ((r.row.doc_id, r.repeats) for r in out), key=repr)


def test_edges(spark):
    assert mixing.mix(docs(spark, [])).count() == 0
    out = mixing.mix(docs(spark, [None, "", "a b", "c " * 50_000], [None, "x", "x", "y"],
                          ids=[None, 1, 1, 2])).collect()
    assert sorted(r.size for r in out) == [0, 0, 2, 50_000]
    assert all(r.repeats <= 2 for r in out)


def test_hot_length_is_cut_exactly(spark):
    out = mixing.mix(docs(spark, ["same words here"] * 500 + ["x"] * 10,
                          ["a"] * 500 + ["b"] * 10)).collect()
    got = sum(r.repeats * r.size for r in out if r.row.source == "a")
    assert abs(got - next(r.target for r in out if r.row.source == "a")) <= 3


def test_equal_rows_meet_the_target(spark):
    """Most rows of a source are one row, with an id or without; others differ in a column only."""
    texts = ["same words here"] * 300 + ["x"] * 10 + ["other words"] * 100
    sources = ["a"] * 300 + ["b"] * 10 + [None] * 100
    frame = docs(spark, texts, sources, ids=[None] * 200 + [5] * 100 + [*range(10)] + [7] * 100)
    out = mixing.mix(frame).collect()
    assert len(out) == len(texts) and {r.repeats for r in out} <= {0, 1, 2}
    taken, targets = defaultdict(int), {}
    for r in out:
        taken[r.row.source] += r.repeats * r.size
        targets[r.row.source] = r.target
    assert all(abs(taken[s] - targets[s]) <= 3 for s in targets)
    again = mixing.mix(frame.repartition(7))
    assert rows(again.select("row.doc_id", "size", "repeats"), "doc_id", "size", "repeats") == sorted(
        ((r.row.doc_id, r.size, r.repeats) for r in out), key=repr)


def test_knapsack_reaches_what_brute_force_reaches():
    rng = np.random.default_rng(1)
    for _ in range(40):
        lengths = rng.choice(np.arange(1, 30), 4, replace=False)
        spare = rng.integers(0, 4, 4)
        rest = int(rng.integers(0, 120))
        taken = mixing.close_budget(rest, lengths, spare)
        sums = {sum(n * x for n, x in zip(c, lengths)) for c in product(*[range(s + 1)
                                                                         for s in spare])}
        assert (taken <= spare).all()
        assert int((taken * lengths).sum()) == max(s for s in sums if s <= rest)
