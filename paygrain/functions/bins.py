"""Ordered classes of a number: code and label columns."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Class = tuple[float | None, float | None, str]

#: Closed intervals (None: open end) and labels. Values between two classes have none.
AGE: list[Class] = [
    (None, math.nextafter(1, 0), "< 1 an"),
    (1, 4, "1 - 4 ans"),
    *[(lo, lo + 4, f"{lo} - {lo + 4} ans") for lo in range(5, 75, 5)],
    (75, None, "75 ans et plus"),
]
AGE_REDUCED: list[Class] = [(None, math.nextafter(5, 0), "< 5 ans"), (5, 9, "5 - 9 ans"), (10, 19, "10 - 19 ans"), (20, None, "20 ans et plus")]
SIZE: list[Class] = [
    (1, 5, "1 à 5"), (6, 20, "6 à 20"), (21, 50, "21 à 50"), (51, 100, "51 à 100"), (101, 200, "101 à 200"), (201, 500, "201 à 500"), (501, 1000, "501 à 1000"),
    (1001, 5000, "1001 à 5000"), (5001, 10000, "5001 à 10000"), (math.nextafter(10000, math.inf), None, "Plus de 10000"),
]
SIZE_REDUCED: list[Class] = [(1, 20, "1 à 20"), (21, 100, "21 à 100"), (101, 500, "101 à 500"), (math.nextafter(500, math.inf), None, "Plus de 500")]
#: Left-closed breaks of the older tenure and firm-age classes, and the four groups of the size classes.
TENURE = ([0, 1, 3, 5, 10, 20], ["Moins de 1 an", "1-3 ans", "3-5 ans", "5-10 ans", "10-20 ans", "Plus de 20 ans"])
FIRM_AGE = ([0, 2, 5, 10, 20, 50], ["Moins de 2 ans", "2-5 ans", "5-10 ans", "10-20 ans", "20-50 ans", "Plus de 50 ans"])
SIZE_GROUPS = {"TPE": (1, 2), "PE": (3, 4), "ME": (5, 6), "GE": (7, 8, 9, 10)}


def code(x: Column | str, classes: Sequence[Class]) -> Column:
    """1, 2, ... for the class of x; null for null, NaN and values in no class."""
    x = F.col(x) if isinstance(x, str) else x
    known = x.isNotNull() & ~F.isnan(x.cast("double"))
    out = None
    for i, (lo, hi, _) in enumerate(classes, 1):
        inside = known if lo is None and hi is None else None
        for test in ([x >= lo] if lo is not None else []) + ([x <= hi] if hi is not None else []):
            inside = test if inside is None else inside & test
        out = F.when(inside, i) if out is None else out.when(inside, i)
    return F.when(known, out)


def text(code_: Column, classes: Sequence[Class]) -> Column:
    """The label of a class code; null for null."""
    return F.get(F.array(*[F.lit(c[2]) for c in classes]), code_ - 1)


def cut(x: Column | str, breaks: Sequence[float], labels: Sequence[str]) -> Column:
    """Left-closed classes from breaks; the last is open. Values below the first break have none."""
    x = F.col(x) if isinstance(x, str) else x
    out = F.when(x >= breaks[-1], labels[-1])
    for i in range(len(breaks) - 2, -1, -1):
        out = out.when((x >= breaks[i]) & (x < breaks[i + 1]), labels[i])
    return out


def size_group(size_code: Column) -> Column:
    out = None
    for name, codes in SIZE_GROUPS.items():
        out = F.when(size_code.isin(*codes), name) if out is None else out.when(size_code.isin(*codes), name)
    return out
