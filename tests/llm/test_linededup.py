from __future__ import annotations

from collections import Counter

from helpers import docs, prose, rows
from perfspark.llm import linededup


def _expected(texts, min_docs):
    key = linededup.line_key
    split = [(t or "").encode().split(b"\n") for t in texts]
    seen = Counter(k for lines in split for k in {key(x) for x in lines} if k)
    kept = [[x for x in lines if not key(x) or seen[key(x)] < min_docs] for lines in split]
    return [(b"\n".join(k).decode(), len(s), len(s) - len(k))
            for s, k in zip(split, kept, strict=True)]


def test_against_brute_force(spark):
    texts = [f"{prose(40, i)}\n \tShared Line\x0b\nrare {i % 4}" for i in range(11)]
    texts += [None, "", "\n\n", "shared line", "x\n" * 40_000, "É\né\nÉ"] + ["twin\nshared line"] * 3
    frame = docs(spark, texts, clash=True, ids=[None, 3, *range(len(texts) - 2)])
    out = linededup.drop_common_lines(frame, min_docs=3, batches=3, fan_in=2)
    assert set(out.columns) == {*frame.columns, "n_lines", "n_dropped"}
    got = Counter(rows(out, "text", "n_lines", "n_dropped"))
    assert got == Counter(_expected(texts, 3))


def test_runs_count_like_one_table_for_any_batches(spark):
    texts = [f"a{i % 7}\nb{i % 3}\nc{i}" for i in range(30)]
    results = [rows(linededup.drop_common_lines(docs(spark, texts), 5, batches=b, fan_in=f),
                    "doc_id", "text") for b, f in ((1, 2), (5, 2), (4, 3))]
    assert results[0] == results[1] == results[2]
    assert [t for _, t in results[0]] != texts


def test_empty_table_and_least_length(spark):
    assert linededup.drop_common_lines(docs(spark, [])).count() == 0
    short = linededup.drop_common_lines(docs(spark, ["ab\nabc"] * 4), 2, min_chars=3, batches=1)
    assert {r.text for r in short.collect()} == {"ab"}
