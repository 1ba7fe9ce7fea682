from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from helpers import docs, prose
from perfspark.llm import packing
from perfspark.llm.queries import tokenizer

ODD = [None, "", "  \n", "naïve ÉCOLE Straße ǅ İ", "a b c", "x<|endoftext|>y <|ENDOFTEXT|>",
       "don't it's ' 's 12 3.4 !?", "é ́x", "\x1c\x85 z", "𝄞 日本語 😀", "x" * 20_000]


def _whole(texts):
    t = Tokenizer.from_file(tokenizer())
    return [[*t.encode(x or "", add_special_tokens=False).ids, 1] for x in texts]


@pytest.mark.parametrize("group_rows", [1024, 8])
def test_pieces_hold_every_id_once(spark, group_rows):
    texts = [*ODD, *[prose(random.Random(i).randint(1, 3000), i) for i in range(40)], "twin", "twin"]
    ids = [*range(len(texts) - 2), 90, 90]
    frame = docs(spark, texts, ids=ids, clash=True)
    out = packing.pack_documents(frame, tokenizer(), group_rows=group_rows).collect()
    want = defaultdict(list)
    for i, tokens in zip(ids, _whole(texts), strict=True):
        want[i].append(tokens)
    found, bins = defaultdict(list), defaultdict(list)
    for r in out:
        piece = np.frombuffer(r.ids, "<u4").tolist()
        assert len(piece) == r.length > 0
        found[r.doc_id].append((r.start, piece, r.doc_tokens))
        bins[r.sequence_id].append((r.offset, r.length))
    for i, pieces in found.items():
        pieces.sort()
        joined = [x for _, p, _ in pieces for x in p]
        assert sorted(joined) == sorted(x for t in want[i] for x in t)
        assert {n for _, _, n in pieces} == {len(t) for t in want[i]}
        if len(want[i]) == 1:
            assert joined == want[i][0]
            at = 0
            for start, piece, _ in pieces:
                assert start == at
                at += len(piece)
    assert set(found) == set(want)
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == 2048 or (at < 2048 and at & (at - 1) == 0)


def test_reruns_agree_and_empty_table(spark):
    texts = [prose(50 + i, i) for i in range(20)]
    a = packing.pack_documents(docs(spark, texts), tokenizer(), group_rows=4)
    b = packing.pack_documents(docs(spark, texts).repartition(5), tokenizer(), group_rows=4)
    key = [c for c in a.columns if c != "ids"]
    assert sorted(map(tuple, a.select(*key).collect())) == sorted(map(tuple,
                                                                      b.select(*key).collect()))
    assert packing.pack_documents(docs(spark, []), tokenizer()).count() == 0


def test_equal_rows_spread_over_groups(spark):
    """Half of the rows are one row: without an id, and longer than a sequence."""
    twin = prose(2500, 7)
    texts, ids = [twin] * 60 + [prose(40, i) for i in range(60)], [None] * 60 + [*range(60)]
    out = packing.pack_documents(docs(spark, texts, ids=ids), tokenizer(), group_rows=8).collect()
    want = _whole([twin])[0]
    twins = [r for r in out if r.doc_id is None]
    assert {r.doc_tokens for r in twins} == {len(want)}
    assert sum(r.length for r in twins) == 60 * len(want)
    per_group = defaultdict(int)
    for r in twins:
        per_group[r.sequence_id >> 32] += r.length
        assert np.frombuffer(r.ids, "<u4").tolist() == want[r.start:r.start + r.length]
    assert len(per_group) > 5 and max(per_group.values()) <= 16 * len(want)
    assert {r.doc_id for r in out} == {None, *range(60)}


def test_speller_agrees_with_the_tokenizer():
    """Letters of every kind below and above the plain ones, upper and lower, with and without a
    mark, learned twice where the words were forgotten."""
    rng = random.Random(12)
    letters = [c for c in map(chr, range(0x41, 0x600)) if c.isalpha()]
    words = ["".join(rng.choices(letters[:rng.choice([52, 190, len(letters)])], k=rng.randint(1, 9)))
             + rng.choice(["", "", ".", "!", "\u0301", "-x"]) for _ in range(6000)]
    speller = packing.Speller(Tokenizer.from_file(tokenizer()), limit=2000)
    texts = [" ".join(words[i:i + 20]) for i in range(0, len(words), 20)]
    for lo in range(0, len(texts), 50):
        own = texts[lo:lo + 50]
        for text, ids in zip(own, speller.ids([x.encode() for x in own]), strict=True):
            assert [*ids.tolist(), 1] == _whole([text])[0]


def test_tree_places_like_a_plain_first_fit():
    rng = random.Random(2)
    for _ in range(30):
        sizes = [rng.randint(1, 64) for _ in range(rng.randint(1, 60))]
        free, plain = [], []
        for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
            at = next((b for b, room in enumerate(free) if room >= sizes[item]), len(free))
            if at == len(free):
                free.append(64)
                plain.append([])
            free[at] -= sizes[item]
            plain[at].append(item)
        assert packing.first_fit_decreasing(sizes, 64) == plain


def test_pack_covers_every_position_once():
    rng = random.Random(3)
    for _ in range(30):
        lengths = [rng.randint(1, 300) for _ in range(rng.randint(0, 40))]
        seen = defaultdict(list)
        for sequence in packing.pack(lengths, 64):
            total = sum(p[2] for p in sequence)
            assert total == 64 or (0 < total < 64 and total & (total - 1) == 0)
            for doc, start, length in sequence:
                seen[doc] += range(start, start + length)
        assert {d: sorted(x) for d, x in seen.items()} == {
            d: list(range(n)) for d, n in enumerate(lengths)}


def test_fewer_kept_words_give_the_same_pieces(spark, monkeypatch):
    rows = docs(spark, [prose(400, i, 120) for i in range(40)])
    path = tokenizer()
    whole = sorted(map(tuple, packing.pack_documents(rows, path).collect()))
    assert sorted(map(tuple, packing.pack_documents(rows, path, words=50).collect())) == whole
    speller = packing.Speller(packing._tokenizer(path), 50)
    for i in range(8):
        speller.ids([prose(400, i, 120).encode()])
        assert len(speller.numbers) <= 50 + 120
    assert packing._speller(path, 50).limit == 50
