from __future__ import annotations

import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from helpers import docs, prose, rows
from perfspark.llm import simhash
from perfspark.llm.common import components


def _print(text, k=4):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _components(prints, bits=4):
    label = list(range(len(prints)))
    for i, a in enumerate(prints):
        for j in range(i):
            if bin(a ^ prints[j]).count("1") <= bits and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


def test_fingerprints_and_components_against_brute_force(spark):
    base = prose(200, 1)
    texts = [prose(60, 100 + i) for i in range(60)]
    texts += [base, base, base.upper(), base + " more", base.replace("w1", "v1", 1)]
    texts += [None, "", " \n", "one", "One two", "É é", "x " * 100_000]
    got = {r.doc_id: r for r in simhash.near_duplicates(docs(spark, texts, clash=True)).collect()}
    prints = [_print(t) for t in texts]
    assert [got[i].fp % (1 << 64) for i in range(len(texts))] == prints
    label = _components(prints)
    assert [got[i].component_id for i in range(len(texts))] == label


def test_index_links_what_brute_force_links(spark):
    rng = random.Random(5)
    centers = [rng.getrandbits(64) for _ in range(12)]
    prints = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6)))
              for c in centers for _ in range(40)} | {0, 1, 2**64 - 1}
    prints = sorted(prints)
    frame = spark.createDataFrame([(p - (p >> 63 << 64),) for p in prints], "fp long")
    for chunk in (4096, 16):
        roots = {r.node % (1 << 64): r.root for r in components(
            simhash.near_links(frame, 4, chunk)).collect()}
        label = _components(prints)
        for i, p in enumerate(prints):
            alone = label.count(label[i]) == 1
            assert (p not in roots) == alone
        groups = {}
        for p, x in zip(prints, label):
            if p in roots:
                groups.setdefault(x, set()).add(roots[p])
        assert all(len(g) == 1 for g in groups.values())
        assert len({min(g) for g in groups.values()}) == len(groups)


def test_gray_rank_orders_the_gray_code(spark):
    got = spark.range(16).select("id", simhash.gray_rank(F.col("id")).alias("r")).collect()
    assert {r.id: r.r for r in got} == {i ^ i >> 1: i for i in range(16)}


def test_one_of_each_keeps_the_least_id_and_all_columns(spark):
    texts = ["a b c d e f"] * 3 + [prose(80, 1), None, ""]
    frame = docs(spark, texts, ids=[9, 4, 4, 7, None, None], clash=True)
    kept = simhash.one_of_each(frame)
    assert kept.columns == frame.columns
    assert rows(kept, "doc_id") == [(4,), (7,), (None,)]
    assert simhash.one_of_each(docs(spark, [])).count() == 0
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


def test_fingerprint_of_many_shingles_is_exact():
    text = prose(30_000, 3).encode()
    h = simhash.shingle_hashes(text, 4)
    ones = np.array([(h >> np.uint64(b) & np.uint64(1)).sum() for b in range(64)])
    assert simhash.fingerprint(text) == sum(1 << b for b in range(64) if ones[b] * 2 > len(h))
