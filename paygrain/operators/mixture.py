"""Expectation-maximisation for mixtures of Gaussian and categorical fields, with missing values.

A component has a weight, a mean vector and full covariance over the numeric fields and one table of probabilities per
categorical field; fields are independent of one another across the two kinds within a component. Missing fields are
integrated out: the expectation step uses the marginal density of what is known and adds the conditional mean and
covariance of what is not.

Fitting does not see rows but cells: rows with nearly equal numeric fields and the same categories, as counts, sums and
cross products, aggregated map-side. Each step is one job that returns one row of sufficient statistics per partition,
so what reaches the driver depends on the model's size alone. Categories have to be coded 0..n-1 with n bounded, -1 is
missing.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Mixture:
    numeric: list[str]
    levels: dict[str, int]
    weight: np.ndarray
    mean: np.ndarray
    cov: np.ndarray
    table: dict[str, np.ndarray]
    steps: int = 0
    loglik: list[float] = field(default_factory=list)

    def log_density(self, x: np.ndarray, cats: dict[str, np.ndarray]) -> np.ndarray:
        """log weight times density per component, missing fields integrated out; (rows, components)."""
        n, k = len(x), len(self.weight)
        out = np.tile(np.log(self.weight), (n, 1))
        for c, v in cats.items():
            known = v >= 0
            out[known] += np.log(self.table[c])[:, v[known]].T
        for rows, o, _ in _patterns(x):
            if not len(o):
                continue
            for j in range(k):
                s = self.cov[j][np.ix_(o, o)]
                d = x[rows][:, o] - self.mean[j][o]
                out[rows, j] += -0.5 * (np.einsum("ij,ij->i", d @ np.linalg.inv(s), d) + math.log(np.linalg.det(s)) + len(o) * math.log(2 * math.pi))
        return out

    def responsibilities(self, x: np.ndarray, cats: dict[str, np.ndarray]) -> np.ndarray:
        p = self.log_density(x, cats)
        p = np.exp(p - p.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)

    def expect(self, x: np.ndarray, cats: dict[str, np.ndarray]) -> np.ndarray:
        """x with its missing numeric fields at their conditional expectations."""
        r, out = self.responsibilities(x, cats), x.copy()
        for rows, o, m in _patterns(x):
            if len(m):
                out[np.ix_(rows, m)] = sum(r[rows][:, [j]] * self._given(j, x[rows], o, m) for j in range(len(self.weight)))
        return out

    def _given(self, j: int, x: np.ndarray, o: np.ndarray, m: np.ndarray) -> np.ndarray:
        mu = np.tile(self.mean[j][m], (len(x), 1))
        if len(o):
            mu = mu + (x[:, o] - self.mean[j][o]) @ np.linalg.inv(self.cov[j][np.ix_(o, o)]) @ self.cov[j][np.ix_(o, m)]
        return mu

    def distribution(self, c: str, x: np.ndarray, cats: dict[str, np.ndarray]) -> np.ndarray:
        """Conditional distribution of categorical field c; (rows, levels)."""
        return self.responsibilities(x, {k: v for k, v in cats.items() if k != c}) @ self.table[c]


def _patterns(x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, observed fields, missing fields) per pattern of missing values."""
    miss = np.isnan(x)
    code = miss @ (1 << np.arange(x.shape[1])) if x.shape[1] else np.zeros(len(x), int)
    for c in np.unique(code):
        m = np.array([bool(c >> i & 1) for i in range(x.shape[1])], dtype=bool)
        yield np.flatnonzero(code == c), np.flatnonzero(~m), np.flatnonzero(m)


def cells(df: DataFrame, numeric: Sequence[str], levels: dict[str, int], width: dict[str, float]) -> DataFrame:
    """Sufficient statistics of rows that share a cell: n, sums s_i and cross products q_i_j. NaN counts as missing."""
    val = {c: F.when(~F.isnan(c), F.col(c)) for c in numeric}
    d = df.select(
        *[val[c].alias(f"x{i}") for i, c in enumerate(numeric)],
        *[F.round(val[c] / width[c]).cast("int").alias(f"g{i}") for i, c in enumerate(numeric)],
        *[F.coalesce(F.col(c).cast("int"), F.lit(-1)).alias(f"c_{c}") for c in levels],
    )
    k = range(len(numeric))
    return d.groupBy(*[f"g{i}" for i in k], *[f"c_{c}" for c in levels]).agg(
        F.count("*").alias("n"),
        *[F.sum(f"x{i}").alias(f"s{i}") for i in k],
        *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"q{i}_{j}") for i, j in itertools.combinations_with_replacement(k, 2)],
    )


def fit(cell: DataFrame, numeric: Sequence[str], levels: dict[str, int], components: int = 3, steps: int = 12, tol: float = 1e-4, floor: float = 1e-3) -> Mixture | None:
    """Fit on the cells of `cells` (read once per step: hand in a written table). None if there are no rows."""
    numeric, d, k = list(numeric), len(numeric), components
    tot = cell.agg(
        F.sum("n").alias("n"),
        *[F.sum(F.when(F.col(f"s{i}").isNotNull(), F.col("n"))).alias(f"n{i}") for i in range(d)],
        *[F.sum(f"s{i}").alias(f"s{i}") for i in range(d)],
        *[F.sum(f"q{i}_{i}").alias(f"q{i}") for i in range(d)],
    ).first()
    if not tot["n"]:
        return None
    mean = np.array([(tot[f"s{i}"] or 0.0) / (tot[f"n{i}"] or 1) for i in range(d)])
    var = np.array([max((tot[f"q{i}"] or 0.0) / (tot[f"n{i}"] or 1) - mean[i] ** 2, floor) for i in range(d)])
    spread = np.linspace(-1.2, 1.2, k) if k > 1 else np.zeros(1)
    m = Mixture(
        numeric, dict(levels), np.full(k, 1 / k), np.array([mean + s * np.sqrt(var) for s in spread]), np.array([np.diag(var) for _ in range(k)]), {c: np.full((k, n), 1 / n) for c, n in levels.items()}
    )
    schema = "s array<double>"
    for _ in range(steps):
        parts = cell.mapInPandas(_step(m), schema).collect()  # one row per partition, of the model's size
        if not parts:
            break
        _update(m, np.sum([np.array(p["s"]) for p in parts], axis=0), floor)
        m.steps += 1
        if len(m.loglik) > 1 and abs(m.loglik[-1] - m.loglik[-2]) < tol * abs(m.loglik[-2]):
            break
    return m


def _step(m: Mixture):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        k, d = len(m.weight), len(m.numeric)
        acc = None
        for b in batches:
            n = b["n"].to_numpy(float)
            x = np.column_stack([b[f"s{i}"].to_numpy(float) / n for i in range(d)]) if d else np.zeros((len(b), 0))
            cats = {c: b[f"c_{c}"].to_numpy(int) for c in m.levels}
            p = m.log_density(x, cats)
            top = p.max(1, keepdims=True)
            e = np.exp(p - top)
            r = e / e.sum(1, keepdims=True)
            loglik = float((n * (top[:, 0] + np.log(e.sum(1)))).sum())
            w = r * n[:, None]
            out = [np.array([loglik]), w.sum(0)]
            first, second = np.zeros((k, d)), np.zeros((k, d, d))
            for rows, o, miss in _patterns(x):
                # within-cell scatter of the known fields
                scatter = np.zeros((len(rows), d, d))
                for i, j in itertools.combinations_with_replacement(o, 2):
                    q = b[f"q{i}_{j}"].to_numpy(float)[rows] / n[rows] - x[rows, i] * x[rows, j]
                    scatter[:, i, j] = scatter[:, j, i] = q
                for c in range(k):
                    full, extra = x[rows].copy(), np.zeros((d, d))
                    if len(miss):
                        full[:, miss] = m._given(c, x[rows], o, miss)
                        s = m.cov[c]
                        extra[np.ix_(miss, miss)] = s[np.ix_(miss, miss)] - (s[np.ix_(miss, o)] @ np.linalg.inv(s[np.ix_(o, o)]) @ s[np.ix_(o, miss)] if len(o) else 0)
                    wc = w[rows, c]
                    first[c] += wc @ full
                    second[c] += np.einsum("i,ij,ik->jk", wc, full, full) + np.einsum("i,ijk->jk", wc, scatter) + wc.sum() * extra
            out += [first.ravel(), second.ravel()]
            for c, size in m.levels.items():
                t = np.zeros((k, size))
                known = cats[c] >= 0
                for j in range(k):
                    t[j] = np.bincount(cats[c][known], weights=w[known, j], minlength=size)[:size]
                out.append(t.ravel())
            v = np.concatenate(out)
            acc = v if acc is None else acc + v
        if acc is not None:
            yield pd.DataFrame({"s": [acc.tolist()]})

    return run


def _update(m: Mixture, v: np.ndarray, floor: float) -> None:
    k, d = len(m.weight), len(m.numeric)
    m.loglik.append(float(v[0]))
    w = v[1 : 1 + k]
    first = v[1 + k : 1 + k + k * d].reshape(k, d)
    second = v[1 + k + k * d : 1 + k + k * d + k * d * d].reshape(k, d, d)
    at = 1 + k + k * d + k * d * d
    total = w.sum()
    m.weight = (w + 1e-3) / (total + k * 1e-3)
    for j in range(k):
        if w[j] < d + 2:  # an empty component keeps its place and stays weak
            continue
        m.mean[j] = first[j] / w[j]
        m.cov[j] = second[j] / w[j] - np.outer(m.mean[j], m.mean[j]) + floor * np.eye(d)
        m.cov[j] = (m.cov[j] + m.cov[j].T) / 2
    for c, size in m.levels.items():
        t = v[at : at + k * size].reshape(k, size) + 0.5
        m.table[c] = t / t.sum(1, keepdims=True)
        at += k * size
