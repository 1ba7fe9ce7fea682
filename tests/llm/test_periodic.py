from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from helpers import docs, prose, rows
from perfspark.llm import periodic, queries

SF = "/root/testdata/sf0.001"


def brute(words, min_words=12):
    """Runs by trying every period at every place."""
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            start, length = i, j + q - i
            own = words[start:start + length]
            smallest = next(p for p in range(1, length + 1)
                            if all(own[k] == own[k + p] for k in range(length - p)))
            if length >= max(min_words, 2 * q) and smallest == q:
                found.append((start, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def periodic_text(seed):
    """Repeated blocks, with blocks inside blocks, between random words."""
    rng = random.Random(seed)
    words = []
    for _ in range(rng.randint(1, 4)):
        words += [rng.choice("abcdef") for _ in range(rng.randint(0, 9))]
        block = [rng.choice("abc"[:rng.randint(1, 3)]) for _ in range(rng.randint(1, 12))]
        inner = block * rng.randint(1, 4) + [rng.choice("abx")]
        words += (inner * rng.randint(1, 5))[:rng.randint(1, 120)]
    return " ".join(words)


def check(frame, texts):
    got = {r.doc_id: r for r in periodic.periodic_runs(frame).collect()}
    assert sorted(got) == list(range(len(texts)))
    for i, text in enumerate(texts):
        words = split(text)
        runs = brute(words)
        assert [tuple(s) for s in got[i].runs] == runs, text
        assert got[i].n_words == len(words) and got[i].text == brute_collapse(words, runs)


def test_runs_equal_brute_force(spark):
    texts = [periodic_text(s) for s in range(150)]
    check(docs(spark, texts, clash=True).repartition(5), texts)


def test_runs_over_many_tiles(spark, monkeypatch):
    block = [f"w{i}" for i in range(90)]
    texts = ["x " * 300, prose(700, 1), " ".join(block * 9), " ".join("ab" * 100 + "cab" * 150),
             " ".join((block[:7] * 20 + block) * 4), prose(40, 2) + " " + " ".join(block * 3)]
    monkeypatch.setattr(periodic, "TILE", 16)
    for i, text in enumerate(texts):
        words, numbers, gaps = periodic._told(text.encode())
        joined = {}
        for octave, tile, first, own in periodic.tiles_of(numbers, gaps):
            size = max(16, 4 << octave)
            for q, lo, hi in periodic.tile_fragments(
                    own, first, tile * size, min(len(words), (tile + 1) * size), octave, 12):
                joined.setdefault(q, []).append((lo, hi))
        spans = []
        for q, parts in joined.items():
            lo, hi = None, -1
            for a, b in [*sorted(parts), (1 << 40, 0)]:
                if a > hi:
                    if hi - (lo or 0) + q >= max(12, 2 * q):
                        spans.append((lo, hi - lo + q, q))
                    lo, hi = a, b
                hi = max(hi, b)
        assert periodic.smallest_periods(spans) == brute(text.split()), i


def test_tiles_are_bounded():
    words, numbers, gaps = periodic._told(b"a b " * 40_000)
    for octave, tile, first, own in periodic.tiles_of(numbers, gaps):
        step = 1 << octave
        assert len(own) <= max(periodic.TILE, 4 * step) + 4 * step


def test_z_function():
    for seed in range(50):
        s = [random.Random(seed * 99 + i).randrange(2) for i in range(30)]
        want = [next((k for k in range(30 - i) if s[k] != s[i + k]), 30 - i) for i in range(30)]
        assert periodic.z_function(s) == want
    assert periodic.z_function([]) == []


def test_edges(spark):
    texts = [None, "", " \n\t", "one", "x\x0bx" * 20, "é " * 12, "é " * 11, "a a " * 30]
    check(docs(spark, texts), texts)
    long = "u v w " * 30_000
    frame = docs(spark, [long, "x " * 20, "x " * 20, "x " * 20, None], ids=[5, 7, 7, None, None])
    got = sorted(((r.doc_id, r.n_words, [tuple(s) for s in r.runs], r.text)
                  for r in periodic.periodic_runs(frame).collect()), key=repr)
    x = [(0, 20, 1)]
    assert got == sorted([(5, 90_000, [(0, 90_000, 3)], "u v w"), (7, 20, x, "x"), (7, 20, x, "x"),
                          (None, 20, x, "x"), (None, 0, [], "")], key=repr)
    assert periodic.periodic_runs(docs(spark, [])).count() == 0
    with pytest.raises(ValueError):
        periodic.periodic_runs(frame, min_words=11)


def test_query_equals_brute_force(spark):
    got = {r.doc_id: r for r in queries.op12_octave_tiles(spark, SF).collect()}
    planted = 0
    for r in queries.table(spark, SF, "documents").collect():
        words = split(r.text)
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            planted += 1
        if n > 1500:  # brute force is quadratic
            continue
        runs, row = brute(words), got[r.doc_id]
        best = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=(None, None, None))
        assert row.n_runs == len(runs) and (row.start, row.length, row.period) == best
        assert row.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        told = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        assert row.runs_sha256 == hashlib.sha256(told.encode()).hexdigest()
        kept = brute_collapse(words, runs)
        assert row.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest()
    assert planted > 5 and len(got) == queries.table(spark, SF, "documents").count()
