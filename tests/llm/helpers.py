"""Small tables for the operators' tests."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names the operators use inside.
CLASH = ("_n long, h1 long, chunk long, size long, row string, score double, fp long, key string, "
         "node long, _row string, src string, kind string")


def docs(spark, texts, sources=None, ids=None, clash=False):
    ids = list(range(len(texts))) if ids is None else ids
    sources = sources or ["s"] * len(texts)
    rows = [(i, t, "en", s, None if t is None else len(t))
            for i, t, s in zip(ids, texts, sources, strict=True)]
    schema = DOCS
    if clash:
        rows = [(*r, 1, 2, 3, 4, "r", 0.5, 6, "k", 7, "x", "y", None) for r in rows]
        schema = f"{DOCS}, {CLASH}"
    return spark.createDataFrame(rows, schema)


def prose(n_words: int, seed: int, vocabulary: int = 3000) -> str:
    """Sentences of random words, three to a line."""
    rng = random.Random(seed)
    lines, left = [], n_words
    while left > 0:
        line = []
        for _ in range(3):
            n = min(left, rng.randint(6, 14))
            if n > 0:
                line.append(" ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n)) + ".")
                left -= n
        lines.append(" ".join(line))
    return "\n".join(lines)


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
