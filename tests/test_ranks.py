"""Order statistics by ranges against plain ones."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paygrain.operators import intervals, ranks


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", None]), st.one_of(st.none(), st.floats(-1e12, 1e12), st.sampled_from([0.0, 1e-15, -1e-15, 0.25, 0.26]))), min_size=1, max_size=50))
def test_percentiles_are_exact(spark, pairs):
    d = spark.createDataFrame(pairs, "g string, v double")
    ps = (0.0, 0.1, 0.5, 0.77, 1.0)
    got = {r.g: list(r.q) for r in ranks.percentiles(d, "v", ps, ["g"]).collect()}
    want = {g: [v for k, v in pairs if k == g and v is not None] for g in {k for k, _ in pairs}}
    assert set(got) == {g for g, v in want.items() if v}
    for g, q in got.items():
        assert q == pytest.approx(np.quantile(want[g], ps).tolist(), rel=1e-9, abs=1e-12)


def test_running_sums_nulls_last_and_ends(spark):
    random.seed(3)
    rows = [(random.choice(["x", "y", None]), v) for v in {round(random.lognormvariate(10, 2) * random.choice([1, -1]), 2) for _ in range(300)}] + [("x", None), (None, float("nan"))]
    d = spark.createDataFrame(rows, "g string, y double").withColumn("w", F.lit(1.0))
    got = ranks.running(d, ["g"], "y", {"w": F.col("w")}).collect()
    assert len(got) == len(rows)
    for g in ("x", "y", None):
        mine = sorted((r for r in got if r.g == g), key=lambda r: tuple(r._place))
        order = sorted((v for k, v in rows if k == g), key=lambda v: (v is None, v is not None and math.isnan(v), v if v is not None and v == v else 0))
        assert [str(r.y) for r in mine] == [str(v) for v in order]
        assert [r.Cw for r in mine] == [i + 1.0 for i in range(len(mine))] and {r.Tw for r in mine} == {float(len(mine))}
        assert [r._end for r in mine] == [False] * (len(mine) - 1) + [True]


def test_percentiles_of_nothing(spark):
    d = spark.createDataFrame([], "v double")
    assert ranks.percentiles(d, "v", (0.5,)).first()["q"] == [None]


def test_bootstrap_in_chunks_is_the_bootstrap(spark):
    """The chunks' drawn sums lead to the same quantiles as all draws side by side."""
    random.seed(5)
    rows = [(g, round(random.lognormvariate(3, 1), 1), random.choice([0.5, 1.0, 2.0])) for g in ("a", None) for _ in range(90)] + [("few", 1.0, 1.0)]
    d = spark.createDataFrame(rows, "g string, y double, w double")
    ps = {"q1": 0.25, "median": 0.5, "p90": 0.9}
    got = {(r.g, r.statistique): (r.estimate, r.se) for r in intervals.bootstrap_quantiles(d, ["g"], "y", "w", ps, replicates=30, chunk=16).collect()}
    assert got["few", "median"] == (1.0, None)
    for g in ("a", None):
        blocks = {}
        for k, y, w in rows:
            if k == g:
                c, s = blocks.get(y, (0, 0.0))
                blocks[y] = (c + 1, s + w)
        v = np.array(sorted(blocks))
        c, w = (np.array([blocks[y][i] for y in v], float) for i in (0, 1))
        m = np.vstack([intervals._draws(1, (g,), k, c[i : i + 16], w[i : i + 16], 30) for k, i in enumerate(range(0, len(v), 16))])
        cum = np.cumsum(m, 0)
        for n, p in ps.items():
            picks = v[(cum < p * cum[-1] - 1e-9).sum(0)]
            assert got[g, n][0] == v[(np.cumsum(w) / w.sum() < p - 1e-12).sum()] and got[g, n][1] == pytest.approx(np.std(picks, ddof=1), rel=0.05)
