"""Numbers: guards for null, normal and Student quantiles."""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp(x: Column, lo: Column, hi: Column) -> Column:
    """Within [lo, hi]; null stays null."""
    return F.when(x.isNotNull(), F.greatest(lo, F.least(hi, x)))


def normal_quantile(p: float) -> float:
    return NormalDist().inv_cdf(p)


def _beta_fraction(a: float, b: float, x: float) -> float:
    tiny = 1e-300
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 400):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + num * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + num / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return h


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    return front * _beta_fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * _beta_fraction(b, a, 1 - x) / b


def student_quantile(p: float, df: float) -> float:
    """Quantile of Student's t; the normal one for infinite or very large df."""
    if not df > 0:
        return math.nan
    if df > 1e7:
        return normal_quantile(p)
    if p == 0.5:
        return 0.0
    tail = min(p, 1 - p)
    lo, hi = 0.0, 1.0
    cdf = lambda t: 0.5 * incomplete_beta(df / 2, 0.5, df / (df + t * t))
    while cdf(hi) > tail:
        hi *= 2
        if hi > 1e300:
            return math.copysign(math.inf, p - 0.5)
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if cdf(mid) > tail else (lo, mid)
        if hi - lo <= 1e-14 * max(1.0, hi):
            break
    return math.copysign((lo + hi) / 2, p - 0.5)
