"""Weighted fuzzy string ratios (0 to 100) as Arrow-batched UDFs. Run them on blocked, distinct pairs only."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def common(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel over b's characters."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    state = full
    for c in b:
        hit = state & where.get(c, 0)
        state = (state + hit | state - hit) & full
    return len(a) - state.bit_count()


def ratio(a: str, b: str) -> float:
    return 200.0 * common(a, b) / (len(a) + len(b)) if a or b else 100.0


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter string and a window of its length in the longer, cut at the ends."""
    a, b = sorted((a, b), key=len)
    if not a:
        return 0.0
    n = len(a)
    return max(ratio(a, b[max(0, i) : i + n]) for i in range(1 - n, len(b)))


def _sets(a: str, b: str) -> tuple[str, str, str]:
    x, y = set(a.split()), set(b.split())
    return tuple(" ".join(sorted(s)) for s in (x & y, x - y, y - x))


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    if not a.split() or not b.split():
        return 0.0
    both, x, y = _sets(a, b)
    if both and (not x or not y):
        return 100.0
    gap = 1 if both else 0
    nx, ny, n = len(both) + gap + len(x), len(both) + gap + len(y), len(both)
    best = 100.0 * (1 - (len(x) + len(y) - 2 * common(x, y)) / (nx + ny))
    return max(best, 200.0 * n / (n + nx), 200.0 * n / (n + ny)) if both else best


def partial_token_ratio(a: str, b: str) -> float:
    both, x, y = _sets(a, b)
    if both:
        return 100.0
    return max(partial_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split()))), partial_ratio(x, y))


def weighted_ratio(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    spread = max(len(a), len(b)) / min(len(a), len(b))
    if spread < 1.5:
        return max(ratio(a, b), 0.95 * max(token_sort_ratio(a, b), token_set_ratio(a, b)))
    scale = 0.9 if spread < 8 else 0.6
    return max(ratio(a, b), scale * partial_ratio(a, b), 0.95 * scale * partial_token_ratio(a, b))


def _batched(f):
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        seen: dict[tuple, float] = {}
        out = []
        for pair in zip(a.fillna(""), b.fillna(""), strict=True):
            if pair not in seen:
                seen[pair] = round(f(*pair), 6)
            out.append(seen[pair])
        return pd.Series(out, dtype="float64")

    return F.pandas_udf(run, T.DoubleType())


wratio_udf, token_set_udf = _batched(weighted_ratio), _batched(token_set_ratio)
