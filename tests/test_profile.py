"""Profiles of loads: shapes, induced expressions, drift."""

import re
from collections import Counter

from pyspark.sql import functions as F

from paygrain.operators import profile as P

SCHEMA = "chargement string, charge_le timestamp, id_indiv string, numero_employeur string, mois int, annee int, sexe string, commune string, salaire_brut double, duree_travaillee double"


def load(name, n=40, **change):
    month = int(name[-2:])
    out = []
    for i in range(n):
        r = {"id_indiv": f"AB{100000000 + i}", "numero_employeur": f"{1000000 + i % 7}", "mois": month, "annee": 2024, "sexe": "F", "commune": "X", "salaire_brut": 100000.0 + i, "duree_travaillee": 1.0}
        r |= {k: (v(i) if callable(v) else v) for k, v in change.items()}
        out.append((name, None, *r.values()))
    return out


def drift(spark, *loads):
    d = spark.createDataFrame([r for x in loads for r in x], SCHEMA)
    return sorted(tuple(r) for r in P.drift(d).collect())


def test_quiet_loads(spark):
    assert drift(spark, load("A_2024_01"), load("A_2024_02")) == []


def test_range_pattern_nulls_distinct(spark):
    bad = load("A_2024_02", mois=lambda i: 13 if i == 0 else 2, id_indiv=lambda i: "ab123456789" if i == 0 else f"AB{100000000 + i}", sexe=lambda i: None if i < 4 else "F", salaire_brut=lambda i: 5.0 if i < 20 else -1.0)
    assert drift(spark, load("A_2024_01"), bad) == [
        ("A_2024_02", "id_indiv", "pattern"), ("A_2024_02", "mois", "range"), ("A_2024_02", "salaire_brut", "distinct"), ("A_2024_02", "salaire_brut", "distribution"),
        ("A_2024_02", "salaire_brut", "range"), ("A_2024_02", "sexe", "nulls"),
    ]


def test_distribution_gap_is_exact_and_month_share(spark):
    quarter = load("A_2024_02", duree_travaillee=lambda i: 2.0 if i < 10 else 1.0)
    less = load("A_2024_02", duree_travaillee=lambda i: 2.0 if i < 9 else 1.0)
    assert drift(spark, load("A_2024_01"), quarter) == [("A_2024_02", "duree_travaillee", "distribution")]
    assert drift(spark, load("A_2024_01"), less) == []
    assert drift(spark, load("A_2024_01"), load("A_2024_02", mois=lambda i: 1 if i < 8 else 2)) == [("A_2024_02", "mois", "distribution")]


def test_no_values_on_one_side_and_other_agency(spark):
    assert drift(spark, load("A_2024_01", salaire_brut=None), load("A_2024_02")) == [("A_2024_02", "salaire_brut", "nulls")]
    assert drift(spark, load("A_2024_01"), load("B_2024_02", salaire_brut=7.0)) == []
    assert drift(spark) == []


def test_missing_columns_and_nan(spark):
    d = spark.createDataFrame([r for r in load("A_2024_01", salaire_brut=float("nan"))], SCHEMA).drop("commune", "sexe")
    p = {r.colonne: r for r in P.profile_loads(d).collect()}
    assert p["salaire_brut"].nulls == 40 and "commune" not in p


def test_induction_prefers_the_common_form():
    e = P.induce([("AA999999999", 5000), ("AA99999999", 3), ("aa999999999", 2)])
    assert len(e) == 1 and e[0].regex == "[A-Z]{2}[0-9]{9}"
    assert P.induce([]) == []


def test_induction_merges_lengths_where_it_pays():
    e = P.induce([("A" + "a" * n, 300) for n in range(3, 12)])
    assert len(e) == 1 and e[0].regex == "[A-Z]+[a-z]+"


def test_shape(spark):
    d = spark.createDataFrame([("Éa-9Z b",), ("",), (None,)], "s string")
    assert [r[0] for r in d.select(P.shape(d.s)).collect()] == ["La-9A a", "", None]


def test_numbers_get_expressions_and_coverage_is_compared(spark):
    salaries = lambda i: 100000.0 + i if i < 30 else 7.5 + i
    d = spark.createDataFrame(load("A_2024_01") + load("A_2024_02", salaire_brut=salaries) + load("A_2024_03", salaire_brut=None), SCHEMA)
    p = {(r.chargement, r.colonne): r for r in P.profile_loads(d).collect()}
    first, second = p["A_2024_01", "salaire_brut"], p["A_2024_02", "salaire_brut"]
    assert (first.foreign, first.main, first.main_coverage) == (0, "[0-9]{6}", 1.0) and second.main_coverage == 0.75
    assert p["A_2024_03", "salaire_brut"].main_coverage is None
    got = {(r.chargement, r.expression): (r.rows, r.share, r.share_before, r.drifts) for r in P.coverage(d).where("colonne = 'salaire_brut'").collect()}
    other = r"[0-9]{2}\.[0-9]"
    assert got == {
        ("A_2024_01", "[0-9]{6}"): (40, 1.0, None, None), ("A_2024_02", "[0-9]{6}"): (30, 0.75, 1.0, True), ("A_2024_02", other): (10, 0.25, 0.0, True),
        ("A_2024_03", "[0-9]{6}"): (0, None, 0.75, None), ("A_2024_03", other): (0, None, 0.25, None),
    }


def test_every_column_is_profiled(spark):
    d = spark.createDataFrame([("A_2024_01", None, 5, "Agence A"), ("A_2024_01", None, 5, None)], "chargement string, charge_le timestamp, ligne_id bigint, libelle_agence string")
    p = {r.colonne: (r["rows"], r.nulls, r.distinct) for r in P.profile_loads(d).collect()}
    assert p == {"charge_le": (2, 2, 0), "ligne_id": (2, 0, 1), "libelle_agence": (2, 1, 1)}


def test_distributed_selection_is_that_of_the_counts_at_hand(spark):
    """Many rare forms, odd characters, one column each."""
    values = [("a", v) for v in [f"AB{i:09}" for i in range(300)] + ["ab1", "x-9", "É1", "", "a.b", "a.b.c", "\\{}", "日本", "x\ny"] + [f"{'k' * (i % 9 + 1)}{i}" for i in range(200)]]
    values += [("b", f"{'abc'[i % 3] * (i % 5 + 1)} {'XY'[i % 2] * (i % 4 + 1)}{i}") for i in range(400)] + [("c", "é" * i) for i in range(1, 30)]
    d = spark.createDataFrame(values * 2, "colonne string, v string").withColumn("shape", P.shape(F.col("v")))
    got = {(r.colonne, r["shape"]): (r.expression, r["values"]) for r in P.induced(d).collect()}
    for c in "abc":
        counts = Counter(r["shape"] for r in d.where(F.col("colonne") == c).distinct().collect())
        want = {s: (e.regex, e.values) for e in P.induce(list(counts.items())) for s in e.shapes}
        assert {s: got[c, s] for s in counts} == {s: want.get(s, (None, None)) for s in counts}
    assert {e for e, _ in got.values()} >= {"[A-Z]{2}[0-9]{9}", "[a-z]+[0-9]+", None}


def test_expressions_take_their_own_values(spark):
    values = [("a", v) for v in ["A-1", "B-2", "a_b", "x y", "1.5", "[x]", "(9)", "a+b", "Éa9", "\u00a07"] * 3 + [f"Q{i}.{'z' * (i % 6 + 1)}" for i in range(90)]]
    d = spark.createDataFrame(values, "colonne string, v string").withColumn("shape", P.shape(F.col("v")))
    for level, form in enumerate((F.col("shape"), F.regexp_replace("shape", "([Aa9L])\\1+", "$1"), F.regexp_replace("shape", "[Aa9L]+", "w"))):
        r = d.select("v", F.concat(F.lit("^(?:"), P._regex(form, level), F.lit(")$")).alias("rx"))
        assert r.where("NOT v RLIKE rx").collect() == []


def test_rare_forms_are_kept_and_violations_are_exact(spark):
    """Every form but one is rarer than one value in two hundred; a value of a merged form may still violate."""
    ids = [f"AB{100000000 + i}" for i in range(20)] + [f"A{'B' * (i % 30)}{10**(i % 12)}{i}" for i in range(600)] + ["AB12"]
    d = spark.createDataFrame([("A_2024_01", None, v, "1234567", 1, 2024, "F", "X", 1.0, 1.0) for v in ids], SCHEMA)
    p = {r.colonne: r for r in P.profile_loads(d).collect()}["id_indiv"]
    assert p.violations == sum(not re.fullmatch("[A-Z]{2}[0-9]{9}", v) for v in ids) and p.foreign < len(ids) / 10
