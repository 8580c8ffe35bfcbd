"""Filling: which cells, held-out accuracy, the mixture itself."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from paygrain.operators import fill, mixture

BASE = "ligne_id bigint, id_indiv string, numero_employeur string, secteur_activite_cod string, sexe string, salaire_brut_mens double"
PANEL = "ligne_id bigint, numero_employeur string, annee int, mois int, secteur_activite_cod string, n_salaries bigint, d_jt int"


def panel(spark, rows=(("E1", 1), ("E2", 1))):
    return spark.createDataFrame([(900 + i, e, 2024, 1 + i, "C10", 3, d) for i, (e, d) in enumerate(rows)], PANEL)


def cells(spark, base, p):
    return {(r.ligne_id, r.champ): r.valeur for r in fill.filled_cells(base, p).collect()}


def test_which_cells_are_filled(spark):
    base = spark.createDataFrame(
        [
            (1, "A", "E1", "C10", "F", 100.0), (2, "A", None, "C10", "F", 110.0), (3, "A", "ND", None, None, -1.0), (4, "B", "E2", "C10", "M", None),
            (5, "C", "9999999", "C10", "M", float("nan")), (6, "D", "E1", "C10", "M", 999999999.0), (7, None, None, None, None, None), (8, "A", "E1", "C10", "F", 0.0),
        ], BASE,
    )
    got = cells(spark, base, panel(spark))
    assert set(got) == {(2, "numero_employeur"), (3, "numero_employeur"), (3, "salaire_brut_mens"), (6, "salaire_brut_mens")}
    assert got[2, "numero_employeur"] == got[3, "numero_employeur"] == "E1"


def test_flags(spark):
    p = spark.createDataFrame([(1, "E1", 2024, 1, None, 5, 1), (2, "E1", 2024, 2, None, 5, None), (3, "E1", 2024, 3, None, None, 0), (4, "E1", 2024, 4, None, None, 9), (5, "E2", 2024, 1, None, None, -1), (6, "E2", 2024, 2, None, 4, None)], PANEL)
    f = {r.ligne_id: (r.d_jt_rempli, r.d_jt_est_rempli) for r in fill.fill_panel(p).collect()}
    assert {k for k, v in f.items() if v[1]} == {2, 4}
    assert f[5] == (None, False) and f[1] == (1, False)


def test_full_table_keeps_rows_and_columns(spark):
    base = spark.createDataFrame([(1, "A", "E1", "C10", "F", 100.0), (2, "A", "E1", "C10", "F", None)], BASE).withColumn("_x", F.lit("clash"))
    out = fill.fill_base(base, panel(spark))
    r = {x.ligne_id: x for x in out.collect()}
    assert len(r) == 2 and r[1].salaire_brut_mens_rempli == 100.0 and not r[1].salaire_brut_mens_est_rempli
    assert r[2].salaire_brut_mens is None and r[2].salaire_brut_mens_est_rempli and r[2]._x == "clash"


def test_clashing_columns_and_null_employers(spark):
    names = ("_d", "_n", "_f", "_row", "_rate", "d_jt_rempli")
    p = spark.createDataFrame([(1, "E1", 2024, 1, None, 5, 1), (2, "E1", 2024, 2, None, 5, None), (3, None, 2024, 1, None, 5, 1), (4, None, 2024, 2, None, 5, None)], PANEL).withColumns({c: F.lit("x") for c in names})
    r = {x.ligne_id: x for x in fill.fill_panel(p).collect()}
    assert [(k, r[k].d_jt_rempli, r[k].d_jt_est_rempli) for k in sorted(r)] == [(1, 1, False), (2, 1, True), (3, 1, False), (4, None, False)]
    assert r[2]._d == r[2]._row == "x"
    b = spark.createDataFrame([(1, "A", "E1", "C10", "F", 100.0), (2, "A", None, "C10", "F", None)], BASE).withColumns({c: F.lit("x") for c in (*names, "_fx", "_ue", "_emp", "salaire_brut_mens_rempli")})
    out = {x.ligne_id: x for x in fill.fill_base(b, p).collect()}
    assert out[2].numero_employeur_rempli == "E1" and out[2]._fx == "x" and isinstance(out[2].salaire_brut_mens_rempli, float)


def test_empty(spark):
    assert cells(spark, spark.createDataFrame([], BASE), panel(spark, ())) == {}


def test_held_out_accuracy(spark):
    rng = np.random.default_rng(3)
    rows, truth = [], {}
    for w in range(150):
        level, firm = rng.normal(12, 0.5), f"E{w % 5}"
        for m in range(6):
            i, x = w * 6 + m, float(np.exp(level + rng.normal(0, 0.05)))
            hide = m == 2
            if hide:
                truth[i] = x
            rows.append((i, f"W{w}", None if m == 4 else firm, "C10", "F", None if hide else x))
    got = cells(spark, spark.createDataFrame(rows, BASE), panel(spark, [(f"E{k}", 1) for k in range(5)]))
    err = [abs(np.log(float(got[i, "salaire_brut_mens"]) / t)) for i, t in truth.items()]
    assert np.median(err) < 0.08
    assert all(v == f"E{(i // 6) % 5}" for (i, c), v in got.items() if c == "numero_employeur")


def test_mixture_recovers_two_groups(spark):
    rng = np.random.default_rng(5)
    z = rng.integers(0, 2, 3000)
    x = np.where(z == 0, rng.normal(0, 0.3, 3000), rng.normal(4, 0.3, 3000))
    y = 2 * x + rng.normal(0, 0.2, 3000)
    c = np.where(rng.random(3000) < 0.9, z, 1 - z)
    hide = rng.random(3000) < 0.2
    d = spark.createDataFrame([(float(a), None if h else float(b), int(k)) for a, b, k, h in zip(x, y, c, hide)], "x double, y double, c int")
    m = mixture.fit(mixture.cells(d, ["x", "y"], {"c": 2}, {"x": 0.1, "y": 0.1}).cache(), ["x", "y"], {"c": 2}, components=2, steps=25)
    assert np.allclose(sorted(m.mean[:, 0]), [0, 4], atol=0.15)
    assert np.all(np.diff(m.loglik) > -1e-6 * abs(m.loglik[0]))
    assert m.expect(np.array([[4.1, np.nan]]), {"c": np.array([-1])})[0, 1] == pytest.approx(8.2, abs=0.15)
    assert m.distribution("c", np.array([[4.0, 8.0]]), {"c": np.array([-1])})[0].argmax() == 1


def test_mixture_of_nothing(spark):
    d = spark.createDataFrame([], "x double, c int")
    assert mixture.fit(mixture.cells(d, ["x"], {"c": 2}, {"x": 1.0}), ["x"], {"c": 2}) is None
