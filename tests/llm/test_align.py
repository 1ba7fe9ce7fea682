from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from helpers import docs, prose, rows
from perfspark.llm import align, queries
from perfspark.llm.align import Rows

SF = "/root/testdata/sf0.001"
A, B = queries.tokenizer("byte_bpe_50k.json"), queries.tokenizer("piece_bpe_32k.model")

ODD = ["a  b", " lead", "trail ", "\n", "\n\n x\n y \n\nz", "tab\tand\u3000wide\u00a0space", "!\x1c\x1dq",
       "it's 12 o'clock <|endoftext|> <s></s><unk> <0x41>", "naïve Σίσυφος 東京都 \U0001f600\U0001f468",
       "x\u2581y", "fine \u2581", "e\u0301 ﬁ ①", "\x00\x01", "…" * 40, "a" * 3000, " " * 50, "\r\n\r\n",
       "a;\r\n b\r c,\r\rd \r", "x();\r\n\r\n  y);\ny\r", "the the the", "def f(x):\n    return  x\n", "\u2028line\u2029", "\ufeffbom"]


def whole(text):
    """Both tokenizers' ids and byte strings of a whole text, by the libraries themselves."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    if not hasattr(whole, "a"):
        whole.a = Tokenizer.from_file(A)
        whole.a.encode_special_tokens = True
        whole.b = SentencePieceProcessor(model_file=B)
        whole.spelled = align.ByteLevel(A).spelled
    ids_a = whole.a.encode(" " + text, add_special_tokens=False).ids
    ids_b = whole.b.encode(text)
    names = map(whole.b.id_to_piece, ids_b)
    spelled_b = [bytes([int(n[3:5], 16)]) if whole.b.is_byte(i) else n.replace("\u2581", " ").encode()
                 for i, n in zip(ids_b, names)]
    return ids_a, [whole.spelled[i] for i in ids_a], ids_b, spelled_b


def brute(texts):
    """Rows of the query by walking over byte offsets."""
    told, counts = [], Counter()
    for text in texts:
        linked, groups = [], []
        n_a = n_b = 0
        if text:
            ids_a, bytes_a, ids_b, bytes_b = whole(text)
            if b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
                n_a, n_b = len(ids_a), len(ids_b)
                ends = [dict(zip(np.cumsum([len(x) for x in s]).tolist(), i))
                        for s, i in ((bytes_a, ids_a), (bytes_b, ids_b))]
                open_ = [[], []]
                for offset in range(1, len((" " + text).encode()) + 1):
                    for side, e in zip(open_, ends):
                        if offset in e:
                            side.append(str(e[offset]))
                    if offset in ends[0] and offset in ends[1]:
                        groups.append("|".join(map(",".join, open_)))
                        linked.append((ends[0][offset], ends[1][offset]))
                        open_ = [[], []]
        counts.update(linked)
        told.append((n_a, n_b, linked, ";".join(groups)))
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [(n_a, n_b, len(li), len(li), sum(counts[p] == most[p[1]] for p in li),
             sum(counts[p] for p in li), g) for n_a, n_b, li, g in told]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


def test_texts_equal_brute_force(spark):
    rng = random.Random(5)
    letters = "aé ß\n\t.,'x1 9東\u2581\U0001f600<|>"
    texts = [*ODD, None, "", *[prose(60, i) for i in range(5)],
             *["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(200)]]
    frame = docs(spark, texts, clash=True).repartition(4)
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in align.align(frame, A, B).collect()}
    want = brute(texts)
    for i, text in enumerate(texts):
        assert got[i] == want[i], repr(text)


def test_query_equals_brute_force(spark):
    found = {r.doc_id: r for r in queries.op11_incidence_links(spark, SF).collect()}
    table = queries.table(spark, SF, "documents").collect()
    for r, want in zip(table, brute([r.text for r in table]), strict=True):
        got = found[r.doc_id]
        assert tuple(got[c] for c in COLUMNS[:-1]) == want[:-1]
        groups = want[-1]
        assert got.groups_sha256 == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")


def test_products_equal_dense_ones():
    rng = np.random.default_rng(1)
    for _ in range(20):
        n, m, k = rng.integers(1, 9, 3)
        first = rng.integers(0, k, n)
        one = Rows.of_ranges(first, first + rng.integers(0, k - first + 1), int(k))
        first = rng.integers(0, k, m)
        two = Rows.of_ranges(first, first + rng.integers(0, k - first + 1), int(k))
        dense = [np.zeros((int(h), int(k)), int) for h in (n, m)]
        for d, r in zip(dense, (one, two)):
            i, j, w = r.entries()
            d[i, j] = w
        out = np.zeros((int(n), int(m)), int)
        i, j, w = one.times(two.transposed()).entries()
        out[i, j] = w
        assert (out == dense[0] @ dense[1].T).all() and (w > 0).all()


def test_kinds_of_links(spark):
    # abcd|ef|g and ab|cdef|g cover the same seven bytes.
    a, b = np.array([4, 6, 7]), np.array([2, 6, 7])
    told = {k: list(zip(*(x.tolist() for x in align.token_links(a, b, k)))) for k in align.KINDS}
    assert told["end"] == [(1, 1, 1), (2, 2, 1)]
    assert told["overlap"] == [(0, 0, 2), (0, 1, 2), (1, 1, 2), (2, 2, 1)]
    assert told["group"] == [(0, 0, 1), (0, 1, 1), (1, 0, 1), (1, 1, 1), (2, 2, 1)]
    texts = [None, "", "x\u2581y", "Wörter und words.\nmore"]
    for kind in align.KINDS:
        got = {r.doc_id: r for r in align.links(docs(spark, texts), A, B, kind).collect()}
        assert all(got[i].a == got[i].b == got[i].weight == [] for i in range(3))
        _, bytes_a, _, bytes_b = whole(texts[3])
        ends = [np.cumsum([len(x) for x in s]) for s in (bytes_a, bytes_b)]
        want = [x.tolist() for x in align.token_links(*ends, kind)]
        assert [got[3].a, got[3].b, got[3].weight] == want
    with pytest.raises(ValueError):
        align.links(docs(spark, texts), A, B, "other")


def test_parts():
    pattern = align.part_pattern(["a", "\u2581a", ";\r", "\u2581\u2581"])
    assert pattern.findall(" a b\nc;\r\n d\re\n\n f ") == [" a", " b", "\n", "c;\r\n d\re",
                                                          "\n\n f", " "]
    assert align.part_pattern(["a\u2581b"]) is align.part_pattern(["\n"]) is None
    assert align.part_pattern(["a"]).findall("x\ry") == ["x", "\ry"]


def test_memory_of_parts_is_bounded():
    a, b = align.tokenizers(A, B)
    small = align.Lookup(a, b, limit=10)
    large = align.Lookup(a, b)
    texts = [prose(50, i) for i in range(20)]
    for t in texts:
        assert (small.read([t])[0] == large.read([t])[0]).all()
        assert len(small.numbers) < 60


def test_edges(spark):
    frame = docs(spark, ["one two", "one two", None, "one two", "word " * 20_000],
                 ids=[1, 1, None, None, 2])
    got = rows(align.align(frame, A, B), "doc_id", *COLUMNS[:-1])
    want = brute(["one two", "one two", None, "one two", "word " * 20_000])
    assert got == sorted([(i, *w[:-1]) for i, w in zip([1, 1, None, None, 2], want)], key=repr)
    assert align.align(docs(spark, []), A, B).count() == 0
