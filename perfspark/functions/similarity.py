"""Token-set similarity of names.

Set algebra on tokens plus a longest common subsequence (LCS) of what the two names do not
share. The LCS has no Spark built-in; both run Arrow-batched, the LCS bit-parallel over all pairs
of a batch at once (one machine word per name, one numpy step per character).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T

_WORD = 64
_CHUNK = 16384


def _lcs_long(x: str, y: str) -> int:
    """Bit-parallel LCS on arbitrary-length integers, for names beyond one machine word."""
    masks: dict[str, int] = {}
    for i, ch in enumerate(x):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(x)) - 1
    row = full
    for ch in y:
        hit = row & masks.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(x) - row.bit_count()


def _codes(texts: list[str], alphabet: dict[str, int], width: int) -> np.ndarray:
    out = np.zeros((len(texts), width), dtype=np.int32)
    for i, t in enumerate(texts):
        for j, ch in enumerate(t):
            out[i, j] = alphabet.setdefault(ch, len(alphabet) + 1)
    return out


def lcs_pairs(xs: list[str], ys: list[str], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """LCS length of ``xs[left[k]]`` and ``ys[right[k]]`` for every pair k."""
    out = np.zeros(len(left), dtype=np.int64)
    if not len(left):
        return out
    xlen = np.array([len(x) for x in xs])
    long = xlen[left] > _WORD
    for k in np.flatnonzero(long):
        out[k] = _lcs_long(xs[left[k]], ys[right[k]])
    short = np.flatnonzero(~long)
    if not len(short):
        return out
    alphabet: dict[str, int] = {}
    clipped = [x if len(x) <= _WORD else "" for x in xs]
    _codes(clipped, alphabet, _WORD)
    ycodes = _codes(ys, alphabet, max((len(y) for y in ys), default=0) or 1)
    masks = np.zeros((len(xs), len(alphabet) + 1), dtype=np.uint64)
    for i, x in enumerate(clipped):
        for j, ch in enumerate(x):
            masks[i, alphabet[ch]] |= np.uint64(1 << j)
    ylen = np.array([len(y) for y in ys])
    flat, letters = masks.ravel(), np.ascontiguousarray(ycodes.T)
    for start in range(0, len(short), _CHUNK):
        pick = short[start:start + _CHUNK]
        li, ri = left[pick], right[pick]
        row = np.full(len(pick), np.iinfo(np.uint64).max, dtype=np.uint64)
        base = li * masks.shape[1]
        for j in range(int(ylen[ri].max(initial=0))):
            hit = row & flat[base + letters[j][ri]]
            row = (row + hit) | (row - hit)
        width = xlen[li].astype(np.uint64)
        used = np.where(width == 64, np.iinfo(np.uint64).max,
                        (np.uint64(1) << (width % np.uint64(64))) - np.uint64(1))
        out[pick] = np.bitwise_count(~row & used)
    return out


def _ratio(distance: float, total: float) -> float:
    return 100.0 - 100.0 * distance / total if total else 100.0


def token_set_scores(a: list[str | None], b: list[str | None]) -> np.ndarray:
    """Similarity 0..100 of every pair ``(a[k], b[k])``.

    Names are whitespace token sets. When one set contains the other the score is 100; an empty
    name scores 0. Otherwise the best of: the two remainders compared by LCS with the shared part
    in front, and each side compared with the shared part alone. Case is kept."""
    n = len(a)
    scores = np.zeros(n)
    left, right, prefix, at = [], [], [], []
    for k in range(n):
        s, t = set((a[k] or "").split()), set((b[k] or "").split())
        if not s or not t:
            continue
        common = s & t
        if common and (common == s or common == t):
            scores[k] = 100.0
            continue
        left.append(" ".join(sorted(s - t)))
        right.append(" ".join(sorted(t - s)))
        prefix.append(len(" ".join(common)))
        at.append(k)
    index = np.arange(len(at))
    lcs = lcs_pairs(left, right, index, index)
    for i, k in enumerate(at):
        x, y, common = len(left[i]), len(right[i]), prefix[i]
        gap = 1 if common else 0
        best = _ratio(x + y - 2 * int(lcs[i]), 2 * (common + gap) + x + y)
        if common:
            best = max(best, _ratio(gap + x, 2 * common + gap + x),
                       _ratio(gap + y, 2 * common + gap + y))
        scores[k] = best
    return scores


@F.pandas_udf(T.DoubleType())
def _scores(a: pd.Series, b: pd.Series) -> pd.Series:
    sides = [c.astype(object).where(c.notna(), None).tolist() for c in (a, b)]
    return pd.Series(token_set_scores(*sides))


def token_set_ratio(a: Column | str, b: Column | str) -> Column:
    """Token-set similarity of two name columns, 0..100; rules as in ``token_set_scores``.

    One Arrow call per batch: as array functions the token sets would stand in the plan once per
    use, and every use would split both names again."""
    return _scores(*[F.col(c) if isinstance(c, str) else c for c in (a, b)])
