"""Title similarity in per cent: the weighted ratio of two strings, from longest common subsequences."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

CUTOFF = 90.0


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, with one bit for each character of ``a``."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = state = (1 << len(a)) - 1
    for c in b:
        match = state & places.get(c, 0)
        state = (state + match | state - match) & full
    return len(a) - state.bit_count()


def ratio(a: str, b: str) -> float:
    return 100.0 if not a and not b else 200.0 * common_subsequence(a, b) / (len(a) + len(b))


def token_ratio(a: str, b: str) -> float:
    """The better of the ratios of sorted words and of shared against other words."""
    left, right = set(a.split()), set(b.split())
    if not left or not right:
        return 0.0
    both, only_a, only_b = sorted(left & right), sorted(left - right), sorted(right - left)
    if both and (not only_a or not only_b):
        return 100.0
    by_sort = ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))
    base, with_a, with_b = " ".join(both), " ".join(both + only_a), " ".join(both + only_b)
    by_set = ratio(with_a, with_b)
    if both:
        by_set = max(by_set, ratio(base, with_a), ratio(base, with_b))
    return max(by_sort, by_set)


def weighted_ratio(a: str, b: str) -> float:
    """The weighted ratio as far as it decides at a cut-off of 90: below that, any lower value may stand.

    Of strings of which one is 1.5 to 8 times as long, only a whole occurrence of the shorter in the
    longer reaches 90; beyond 8 nothing does.
    """
    if not a or not b:
        return 0.0
    longer = max(len(a), len(b)) / min(len(a), len(b))
    if longer < 1.5:
        return max(ratio(a, b), 0.95 * token_ratio(a, b))
    short, long = sorted((a, b), key=len)
    return 90.0 if longer <= 8 and short in long else min(ratio(a, b), 89.0)


@F.pandas_udf(DoubleType())
def title_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([weighted_ratio(x or "", y or "") for x, y in zip(a, b, strict=True)], dtype="float64")
