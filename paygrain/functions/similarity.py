"""Similarities in [0, 1] that the JVM lacks, as Arrow functions; each distinct pair of a batch is computed once."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as T


def jaro(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    free = [True] * len(b)
    hits = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if free[j] and b[j] == c:
                free[j] = False
                hits.append(c)
                break
    if not hits:
        return 0.0
    swapped = sum(x != y for x, y in zip(hits, [c for c, f in zip(b, free) if not f])) // 2
    m = len(hits)
    return (m / len(a) + m / len(b) + (m - swapped) / m) / 3


def osa(a: str, b: str) -> int:
    """Edits with swaps of neighbours, no substring edited twice."""
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i] + [0] * len(b)
        for j, y in enumerate(b, 1):
            new[j] = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                new[j] = min(new[j], before[j - 2] + 1)
        before, row = row, new
    return row[-1]


def damerau(a: str, b: str) -> int:
    """Edits with swaps, without that restriction."""
    last: dict[str, int] = {}
    top = len(a) + len(b)
    d = [[top] * (len(b) + 2) for _ in range(len(a) + 2)]
    for i in range(len(a) + 1):
        d[i + 1][1] = i
    for j in range(len(b) + 1):
        d[1][j + 1] = j
    for i, x in enumerate(a, 1):
        seen = 0
        for j, y in enumerate(b, 1):
            k, m = last.get(y, 0), seen
            if x == y:
                seen = j
            d[i + 1][j + 1] = min(d[i][j] + (x != y), d[i + 1][j] + 1, d[i][j + 1] + 1, d[k][m] + (i - k - 1) + 1 + (j - m - 1))
        last[x] = i
    return d[-1][-1]


def lcs(a: str, b: str) -> int:
    """Deletions and insertions alone."""
    row = [0] * (len(b) + 1)
    for x in a:
        diag = 0
        for j, y in enumerate(b, 1):
            diag, row[j] = row[j], diag + 1 if x == y else max(row[j], row[j - 1])
    return len(a) + len(b) - 2 * row[-1]


def qgram(a: str, b: str, q: int = 2) -> int:
    """Differences of q-gram counts."""
    from collections import Counter

    x, y = (Counter(s[i : i + q] for i in range(len(s) - q + 1)) for s in (a, b))
    return sum(abs(x[g] - y[g]) for g in x.keys() | y.keys())


def relative(distance: Callable[[str, str], int]) -> Callable[[str, str], float]:
    """1 - distance / longer length, kept within [0, 1]."""
    return lambda a, b: 1.0 if not max(len(a), len(b)) else min(1.0, max(0.0, 1 - distance(a, b) / max(len(a), len(b))))


PYTHON: dict[str, Callable[[str, str], float]] = {"jw": jaro, "osa": relative(osa), "dl": relative(damerau), "lcs": relative(lcs), "qgram": relative(qgram)}
JVM: dict[str, Callable[[Column, Column], Column]] = {"lv": T.levenshtein, "hamming": T.hamming, "jaccard": T.jaccard, "cosine": T.cosine}
METHODS = (*PYTHON, *JVM)


def similarity(method: str, a: Column, b: Column) -> Column:
    """Similarity of two texts by one of METHODS; null if either is null."""
    if method in JVM:
        return JVM[method](a, b)
    f = PYTHON[method]

    @F.pandas_udf("double")
    def score(x: pd.Series, y: pd.Series) -> pd.Series:
        seen: dict[tuple[str, str], float] = {}
        out = []
        for p in zip(x, y):
            if p[0] is None or p[1] is None:
                out.append(None)
                continue
            if p not in seen:
                seen[p] = f(*p)
            out.append(seen[p])
        return pd.Series(out, dtype="float64")

    return score(a, b)
