"""Weighted statistics, intervals, combination - hand-computed values and properties."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paygrain.functions import mathx
from paygrain.operators import intervals, stats
from paygrain.plans.catalog import Dimension, Statistic, dimensions

NAMES = ("n_obs", "n_weighted", "mean", "variance", "min", "max", "p10", "q1", "median", "q3", "p90", "gini")


def one(spark, pairs, extra=()):
    d = spark.createDataFrame([(1, y, w) for y, w in pairs], "g int, y double, w double")
    return stats.group_statistics(d, ["g"], "y", "w", [*stats.STATISTICS, *extra]).first()


def test_four_values(spark):
    r = one(spark, [(10.0, 1.0), (20.0, 1.0), (30.0, 2.0), (40.0, 1.0)], [Statistic("usual", "gini_standard", "")])
    assert [r[n] for n in NAMES[:-1]] == [4, 5.0, 26.0, pytest.approx(104), 10, 40, 10, 20, 30, 30, 40]
    assert r.gini == pytest.approx(-0.0769231, abs=1e-7) and r.usual == pytest.approx(0.2153846, abs=1e-7)


def test_null_value_keeps_its_weight(spark):
    r = one(spark, [(10.0, 1.0), (20.0, 1.0), (30.0, 2.0), (40.0, 1.0), (None, 5.0)])
    assert [r[n] for n in NAMES] == [5, 10.0, 13.0, pytest.approx(136.5), 10, 40, 10, 30, 40, None, None, None]


def test_edges(spark):
    r = one(spark, [(None, 1.0)])
    assert (r.n_obs, r["mean"], r.median, r.gini) == (1, None, None, None)
    assert one(spark, [(5.0, 0.0), (6.0, 0.0)]).n_weighted == 0
    assert one(spark, [(5.0, 1.0)]).gini is None
    assert stats.group_statistics(spark.createDataFrame([], "g int, y double, w double"), ["g"], "y", "w").collect() == []


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9), st.integers(1, 4)), min_size=2, max_size=25))
def test_against_row_level_definitions(spark, pairs):
    r = one(spark, [(float(y), float(w)) for y, w in pairs])
    rows = sorted(pairs)
    tw, twy = sum(w for _, w in rows), sum(w * y for y, w in rows)
    for n, p in (("q1", 0.25), ("median", 0.5), ("p90", 0.9)):
        c = 0
        for y, w in rows:
            c += w
            if c / tw >= p:
                break
        assert r[n] == y
    # ties: the average over the orders of equal rows
    gini, c = 0.0, 0.0
    for y in sorted({a for a, _ in rows}):
        ws = [w for a, w in rows if a == y]
        gini += sum(ws) * c + y * (sum(ws) ** 2 + sum(w * w for w in ws)) / 2
        c += y * sum(ws)
    assert r.gini == pytest.approx(1 - 2 * gini / (tw * twy), abs=1e-9)


def test_dimensions_and_cells(spark):
    d = spark.createDataFrame([("a", "x", 2024, 1, 10.0, 20.0), ("a", None, 2024, 1, 20.0, 20.0), ("b", "x", 2024, 1, 30.0, 5.0)], "s string, c string, annee int, mois int, y double, w double")
    dims = [Dimension("global", None, "", 1), Dimension("s", "S", "", 30), Dimension("c", "c", "", 10)]
    a = stats.all_dimensions(d, dims, "y", "w")
    assert {(r.dimension, r.group_value): r.n_weighted for r in a.collect()} == {("global", "Total"): 45, ("s", "a"): 40, ("s", "b"): 5, ("c", "x"): 25, ("c", None): 20}
    assert {(r.dimension, r.group_value) for r in stats.publishable(a, dims).collect()} == {("global", "Total"), ("s", "a"), ("c", "x"), ("c", None)}
    assert [x.name for x in dimensions(["SEXE", "COMMUNE"])] == ["global", "sex", "commune"]
    assert [x.name for x in dimensions(["SEXE", "COMMUNE", "CSP_CODE"], use="in_weights")] == ["csp"]


def test_normalised_weights_sum_to_the_row_count(spark):
    d = spark.createDataFrame([(2024, 1, 2.0, None), (2024, 1, 1.0, 3.0), (2024, 2, None, None)], "annee int, mois int, w_jt double, w_ijt double")
    r = stats.final_weights(d).groupBy("mois").agg(F.sum("w_normalized"), F.count("*")).collect()
    assert all(x[1] == pytest.approx(x[2]) for x in r)


def test_winsorise_keeps_null_and_rows(spark):
    d = spark.createDataFrame([(None, float(i)) for i in range(101)] + [(None, None)], "g string, y double")
    r = sorted((x.y for x in stats.winsorise(d, ["g"], "y").collect()), key=lambda v: (v is None, v))
    assert r[0] == 1.0 and r[-2] == 99.0 and r[-1] is None and len(r) == 102


def test_rubin(spark):
    d = spark.createDataFrame([(1, 10.0, 1.0), (1, 12.0, 1.0), (1, 14.0, 1.0)], "g int, e double, v double")
    r = intervals.rubin(d, ["g"], "e").first()
    assert (r.estimate, r.variance, r.se) == (12, 4, 2)
    r = intervals.rubin_extended(d, ["g"], "e", "v").first()
    assert (r.variance, r.se, r.df) == (pytest.approx(6.3333, abs=1e-4), pytest.approx(2.5166, abs=1e-4), pytest.approx(2.8203, abs=1e-4))
    assert r.ci_upper - 12 == pytest.approx(r.se * mathx.student_quantile(0.975, r.df))
    same = intervals.rubin_extended(d.withColumn("e", F.lit(5.0)), ["g"], "e", "v").first()
    assert same.between == 0 and same.ci_upper - 5 == pytest.approx(1.959964, abs=1e-5)


@pytest.mark.parametrize(("p", "df", "t"), [(0.975, 1, 12.7062), (0.975, 2, 4.30265), (0.975, 10, 2.228139), (0.95, 5, 2.015048), (0.025, 30, -2.042272), (0.5, 3, 0.0), (0.975, 1e9, 1.959964)])
def test_student_quantiles(p, df, t):
    assert mathx.student_quantile(p, df) == pytest.approx(t, abs=2e-4)


def test_mean_with_variance(spark):
    d = spark.createDataFrame([(1, 10.0, 1.0), (1, 20.0, 3.0), (1, None, 9.0), (2, 7.0, 2.0)], "g int, y double, w double")
    r = {x.g: x for x in intervals.mean_with_variance(d, ["g"], "y", "w").collect()}
    mu = 70 / 4
    assert r[1]["mean"] == mu and r[1].variance == pytest.approx((56.25 + 9 * 6.25) / 16 * 2)
    assert r[2].variance == 0


def test_bootstrap_is_repeatable_and_sane(spark):
    import random

    random.seed(1)
    d = spark.createDataFrame([(1, random.gauss(100, 10), 1.0) for _ in range(400)] + [(2, 5.0, 1.0)] * 4, "g int, y double, w double")
    a, b = (sorted(map(tuple, intervals.bootstrap_quantiles(d.repartition(n), ["g"], "y", "w", {"median": 0.5}).collect()), key=str) for n in (1, 3))
    assert a == b
    r = {x[0]: x for x in a}
    assert r[2][3] is None and abs(r[1][3] - 10 * math.sqrt(math.pi / 2 / 400)) < 0.3


def test_extremes(spark):
    d = spark.createDataFrame([(None, float(i)) for i in range(8)] + [(None, None)], "g string, y double")
    assert tuple(intervals.extremes(d, ["g"], "y").first()) == (None, 0.0, 4.0, 7.0, 4.0)
