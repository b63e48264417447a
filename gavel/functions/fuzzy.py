"""Fuzzy scores from 0 to 100, as Arrow-batched functions: normalised insertions and deletions, token sort, token set."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def common(a: str, b: str) -> int:
    """Length of the longest common subsequence, counted in bit-parallel integers."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    s = full
    for c in b:
        u = s & masks.get(c, 0)
        s = (s + u | s - u) & full
    return len(a) - bin(s).count("1")


def indel(a: str, b: str) -> float:
    """100 * 2 * LCS / (length of both); 100 for two empty strings."""
    if not a or not b:
        return 100.0 if a == b else 0.0
    return 200.0 * common(a, b) / (len(a) + len(b))


def token_sort(a: str, b: str) -> float:
    return indel(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    """100 where one side's words lie in the other's; else the best of the joined common and remaining words."""
    return word_sets(set(a.split()), set(b.split()))


def word_sets(x: set[str], y: set[str]) -> float:
    """`token_set` of two sets of words. The common words, joined, begin both sides, so only the remaining ones are compared."""
    if not x or not y:
        return 0.0
    both, left, right = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if not both:
        return indel(left, right)
    if not left or not right:
        return 100.0
    n = len(both)
    one, two = n + 1 + len(left), n + 1 + len(right)
    return max(200.0 * (n + 1 + common(left, right)) / (one + two), 200.0 * n / (n + one), 200.0 * n / (n + two))


def _udf(score):
    @F.pandas_udf("double")
    def f(a: pd.Series, b: pd.Series) -> pd.Series:
        seen: dict = {}
        out = []
        for p in zip(a, b):
            if p not in seen:
                seen[p] = None if p[0] is None or p[1] is None else score(*p)
            out.append(seen[p])
        return pd.Series(out, dtype="float64")

    return f


def ratio(a: Column, b: Column) -> Column:
    return _udf(indel)(a, b)


def token_sort_ratio(a: Column, b: Column) -> Column:
    return _udf(token_sort)(a, b)


def token_set_ratio(a: Column, b: Column) -> Column:
    return _udf(token_set)(a, b)
