"""Implausible readings: bounds, ratios, stuck values, tails; nulls, copies, empty input, clashing columns."""

import math

import pytest
from pyspark.sql import functions as F

from paygrain.operators import spikes

SCHEMA = "ligne_id bigint, id_indiv string, numero_employeur string, type_salarie string, salaire_brut double, duree_travaillee double, mois int, annee int"


def lines(worker, wages, kind="M", firm="1000001", start=1, duration=1.0):
    return [(None, worker, firm, kind, w, duration, (m - 1) % 12 + 1, 2024 + (m - 1) // 12) for m, w in enumerate(wages, start)]


def frame(spark, rows):
    return spark.createDataFrame([(i, *r[1:]) for i, r in enumerate(rows, 1)], SCHEMA)


def varied(base, n, seed=0):
    return [base * (1 + 0.01 * ((i * 7 + seed) % 5)) + i for i in range(n)]


def found(spark, rows):
    return {tuple(r) for r in spikes.implausible(frame(spark, rows)).collect()}


def test_ratio_needs_five_months_and_is_inclusive(spark):
    a = lines("A", [*[100_000.0 + k for k in range(8)], 3 * 100_004.0])
    b = lines("B", [100_000.0, 100_100.0, 100_200.0, 400_000.0])
    got = found(spark, a + b)
    assert (9, "salaire_brut") in got
    assert not any(i > 9 for i, _ in got)


def test_third_of_the_median(spark):
    a = lines("A", [90_000.0, 90_001.0, 90_000.0, 90_003.0, 90_000.0, 90_005.0, 30_000.0])
    assert found(spark, a) == {(7, "salaire_brut")}


def test_bounds_without_worker_and_type(spark):
    rows = [
        (None, None, "1", "M", -5.0, 1.0, 1, 2024),
        (None, None, "1", "J", 1.0, 31.5, 1, 2024),
        (None, None, "1", "H", 1.0, 700.0, 1, 2024),
        (None, None, "1", "H", 1.0, 745.0, 1, 2024),
        (None, None, "2", "M", 1.0, 1.0, 1, 2024),
        (None, None, "2", None, 1.0, 40.0, 1, 2024),
        (None, None, "3 ", "h ", 1.0, 100.0, 1, 2024),
        (None, None, "3.0", None, 1.0, 40.0, 1, 2024),
        (None, None, "4", "m", 1.0, 32.0, 1, 2024),
        (None, None, None, None, None, None, 1, 2024),
    ]
    assert found(spark, rows) == {(1, "salaire_brut"), (2, "duree_travaillee"), (4, "duree_travaillee"), (6, "duree_travaillee"), (9, "duree_travaillee")}


def test_stuck_run_only_where_repeats_are_rare(spark):
    others = [r for k in range(10) for r in lines(f"W{k}", varied(100_000 + 7 * k, 12, k))]
    stuck = lines("S", [1e5, 1.01e5, 77_777.0, 77_777.0, None, 77_777.0, 0.0, 77_777.0, 77_777.0, 1.02e5])
    got = found(spark, stuck + others)
    assert {i for i, c in got if c == "salaire_brut"} == {3, 4, 6, 8, 9}
    usual = [r for k in range(10) for r in lines(f"W{k}", [90_000.0 + k] * 12)]
    assert not found(spark, usual)


def test_agreeing_month_and_copies(spark):
    rows = [r for k in range(6) for r in lines(f"W{k}", varied(100_000 + 900 * k, 12, k))]
    rows = [(*r[:4], 88_888.0, *r[5:]) if (r[6], r[7]) == (5, 2024) else r for r in rows]
    copy = [r for r in rows if (r[6], r[7]) == (5, 2024)][:1]
    got = found(spark, rows + copy)
    assert len(got) == 7
    assert (len(rows) + 1, "salaire_brut") in got


def test_every_copy_of_a_spike_is_a_case(spark):
    a = lines("A", varied(100_000, 8))
    spike = lines("A", [900_000.0], start=9)
    assert found(spark, a + spike + spike + spike) == {(9, "salaire_brut"), (10, "salaire_brut"), (11, "salaire_brut")}


def test_empty_and_clashing_columns(spark):
    empty = frame(spark, [])
    assert spikes.implausible(empty).collect() == []
    d = frame(spark, lines("A", [*varied(100_000, 8), 900_000.0])).withColumns({c: F.lit("x") for c in ("source", "worker", "champ", "v", "med", "n", "cutoff")})
    assert [r.ligne_id for r in spikes.implausible(d).collect()] == [9]


def test_tail_cutoff_follows_the_pareto_law(spark):
    """Exceedances of an exponential law: shape near 0, the cutoff near the law's own quantile."""
    n = 4000
    rows = []
    for k in range(n // 8):
        for m in range(8):
            u = ((k * 8 + m) * 0.6180339887498949) % 1.0
            sign = 1 if (k + m) % 2 else -1
            rows.append((f"W{k}", "S", 2024 * 12 + m, "salaire_brut", 100_000 * math.exp(sign * -0.05 * math.log(1 - 0.999 * u)), 8, 100_000.0))
    ser = spark.createDataFrame(rows, "worker string, source string, month int, champ string, v double, n bigint, med double")
    r = spikes.SpikeRules(width=0.005)
    c = spikes.tail_cutoffs(ser, r).agg(F.avg("shape"), F.avg("threshold"), F.min("cutoff"), F.max("cutoff")).first()
    assert abs(c[0]) < 0.25
    assert c[1] == pytest.approx(0.05 * math.log(10), abs=0.03)
    assert 0.05 * math.log(1000) * 0.75 < c[3] < 0.05 * math.log(1000) * 1.35


def test_flags_name_rule_and_score(spark):
    f = spikes.flag_spikes(frame(spark, lines("A", [*varied(100_000, 8), 900_000.0])))
    r = [x for x in f.collect() if x.ligne_id == 9][0]
    assert r.regle == "tail" and r.residual > r.cutoff and r.n == 9
