"""Cleaning, panel, lookups, audits, reshaping, classes, dates - null and boundary cases."""

import datetime

import pytest
from pyspark.sql import functions as F

from paygrain.functions import bins, dates, similarity, text
from paygrain.operators import audit, clean, models, panel, refjoin, reshape
from paygrain.plans import catalog


def test_cleaning_rules(spark):
    rows = [(100000.0, 1.0, "M"), (None, 1.0, "M"), (0.0, 1.0, "M"), (90000.0, 1.0, "H"), (70000.0, 1.0, "M"), (80000.0, 0.0, "M"), (200000.0, 2.0, "M"), (80000.0, 0.0, None), (70000.0, 1.0, None), (70000.0, 1.0, "X")]
    d = spark.createDataFrame(rows, "salaire_brut double, duree_travaillee double, type_salarie string")
    got = sorted((tuple(r) for r in clean.apply_filters(d).collect()), key=str)
    assert got == sorted([(100000.0, 1.0, "M", 100000.0), (80000.0, 1.0, "M", 80000.0), (200000.0, 1.0, "M", 200000.0), (80000.0, None, None, 80000.0), (70000.0, 1.0, "X", 70000.0)], key=str)


def test_harmonise_ignores_unknown_and_bad_values(spark):
    d = spark.createDataFrame([(" a ", "12", "x", "7.0", "31/12/2023"), ("", "abc", None, " 8 ", "zzz")], "id_indiv string, salaire_brut string, autre string, numero_employeur string, date_naissance string")
    assert [tuple(r) for r in clean.harmonise(d).collect()] == [("a", 12.0, "x", "7", datetime.datetime(2023, 12, 31)), (None, None, None, "8", None)]


def test_observation_id_and_union(spark):
    d = spark.createDataFrame([(None, "7", "2024_01")], "a string, b string, c string")
    assert d.select(clean.observation_id("a", "b", "c")).first()[0] == "NA_7_2024_01"
    a, b = spark.createDataFrame([(1, 2), (1, 2)], "a int, b int"), spark.createDataFrame([(1, 3), (1, 3)], "a int, c int")
    assert sorted(map(tuple, clean.union_files([a, b]).collect()), key=str) == [(1, 2, None), (1, None, 3)]
    assert clean.union_files([a, b], None).count() == 4 and clean.union_files([a, a], "global").count() == 1


def test_panel_history(spark):
    rows = [("A", m, f"{i}") for m, n in ((1, 2), (2, 4), (4, 6)) for i in range(n)] + [("B", 3, "0")]
    d = spark.createDataFrame([(i, f, 2024, m, w, 100.0, "F", "C") for i, (f, m, w) in enumerate(rows)], "ligne_id bigint, numero_employeur string, annee int, mois int, id_indiv string, salaire_brut_mens double, sexe string, commune string")
    p = panel.panel(d, carried=["commune"]).select("numero_employeur", "mois", "d_jt", "d_jt_lag1", "d_jt_lag2", "n_declarations_passees", "n_periodes_passees", F.round("pct_declarations_passees", 4), "effectif_moyen_passe", "commune")
    assert [tuple(r) for r in p.orderBy("numero_employeur", "mois").collect()] == [
        ("A", 1, 1, None, None, 0, 0, None, None, "C"), ("A", 2, 1, 1, None, 1, 1, 1.0, 2.0, "C"), ("A", 3, 0, 1, 1, 2, 2, 1.0, 3.0, "C"), ("A", 4, 1, 0, 1, 2, 3, 0.6667, None, "C"),
        ("B", 1, 0, None, None, 0, 0, None, None, "C"), ("B", 2, 0, 0, None, 0, 1, 0.0, None, "C"), ("B", 3, 1, 0, 0, 0, 2, 0.0, None, "C"), ("B", 4, 0, 1, 0, 1, 3, 0.3333, None, "C"),
    ]


def test_firm_month_counts_null_person_as_one(spark):
    d = spark.createDataFrame([(1, "A", 2024, 1, None, 10.0, "F"), (2, "A", 2024, 1, None, None, None), (3, "A", 2024, 1, "x", 30.0, "M")], "ligne_id bigint, numero_employeur string, annee int, mois int, id_indiv string, salaire_brut_mens double, sexe string")
    r = panel.firm_month(d).first()
    assert (r.n_salaries, r.n_salaries_distincts, r.salaire_moyen, r.pct_femmes) == (3, 2, 20.0, 0.5)


@pytest.mark.parametrize(
    ("value", "day"),
    [("45292", "2024-01-01"), ("45292.7", "2024-01-01"), ("31/12/2023", "2023-12-31"), ("2023-12-31 10:00:00", "2023-12-31"), ("0", None), ("100000", None), ("99999", None), ("abc", None), ("", None), (None, None), ("20240101", "2024-01-01"), ("31/02/2024", None)],
)
def test_moments(spark, value, day):
    r = spark.createDataFrame([(value,)], "v string").select(dates.to_moment("v")).first()[0]
    assert (str(r.date()) if r else None) == day


@pytest.mark.parametrize(("x", "label"), [(-1.0, "< 1 an"), (0.0, "< 1 an"), (4.0, "1 - 4 ans"), (4.5, None), (75.0, "75 ans et plus"), (None, None), (float("nan"), None)])
def test_age_classes(spark, x, label):
    assert spark.createDataFrame([(x,)], "x double").select(bins.text(bins.code("x", bins.AGE), bins.AGE)).first()[0] == label


@pytest.mark.parametrize(("x", "label"), [(0.0, None), (5.5, None), (10001.0, "Plus de 10000"), (10000.0, "5001 à 10000")])
def test_size_classes(spark, x, label):
    assert spark.createDataFrame([(x,)], "x double").select(bins.text(bins.code("x", bins.SIZE), bins.SIZE)).first()[0] == label


def test_exact_join_nulls_duplicates_and_suffix(spark):
    m = spark.createDataFrame([(1, " k ", "a"), (2, None, "b"), (3, "z", "c")], "i int, k string, v string")
    ref = spark.createDataFrame([("k", "y"), ("k ", "x"), (None, "n"), ("", "e")], "k string, v string")
    assert sorted(map(tuple, refjoin.join_exact(m, ref, "k").select("i", "v", "v_ref").collect())) == [(1, "a", "x"), (2, "b", None), (3, "c", None)]
    assert sorted(map(tuple, refjoin.join_exact(m, ref, "k", match_null=True).select("i", "v_ref").collect())) == [(1, "x"), (2, "e"), (3, None)]
    assert refjoin.join_exact(m, ref, "k", how="inner").count() == 1


def test_fuzzy_join_keeps_row_count(spark):
    m = spark.createDataFrame([(1, "ABIDJAN"), (2, "ABIDJAN"), (3, None), (4, "zzz")], "i int, t string")
    ref = spark.createDataFrame([("Abidjan", "x"), ("Bouaké", "y")], "t string, code string")
    for blocking in ("shared", "none"):
        r = sorted(map(tuple, refjoin.join_fuzzy(m, ref, "t", "t", score="s", blocking=blocking).select("i", "t_ref", "code").collect()))
        assert r == [(1, "Abidjan", "x"), (2, "Abidjan", "x"), (3, None, None), (4, None, None)]


def test_failed_lookup_is_logged(spark):
    d = spark.createDataFrame([("a",)], "k string")

    def load(name):
        raise FileNotFoundError(name)

    out, log = refjoin.merge_all(d, [catalog.MergeSpec("x", "gone", "k", "k")], load)
    assert out.count() == 1 and log[0]["status"] == "skipped"


@pytest.mark.parametrize(
    ("method", "a", "b", "value"),
    [("jw", "MARTHA", "MARHTA", 0.9444), ("jw", "", "", 1.0), ("lv", "kitten", "sitting", 1 - 3 / 7), ("osa", "ab", "ba", 0.5), ("dl", "ca", "abc", 1 - 2 / 3), ("osa", "ca", "abc", 0.0), ("lcs", "abcd", "acd", 0.75), ("hamming", "abc", "abd", 2 / 3),
     ("hamming", "abc", "ab", 0.0), ("jaccard", "abcd", "abce", 0.5), ("cosine", "abab", "abab", 1.0), ("cosine", "ab", "cd", 0.0), ("qgram", "abc", "abc", 1.0), ("lv", "", "", 1.0)],
)
def test_similarities(spark, method, a, b, value):
    r = spark.createDataFrame([(a, b), (None, b)], "a string, b string").select(similarity.similarity(method, F.col("a"), F.col("b")))
    got = [x[0] for x in r.collect()]
    assert got[0] == pytest.approx(value, abs=1e-4)


def test_prepare(spark):
    d = spark.createDataFrame([("  Société   d'ÉTUDES, S.A. ",), (None,)], "t string")
    assert [r[0] for r in d.select(text.prepare(F.col("t"), stopwords=["societe"])).collect()] == ["d etudes s a", ""]


def test_outliers_by_quartiles(spark):
    wages = [1.0, 2.0, 3.0, 10.0, 20.0, 21.0, 22.0, 23.0, 24.0, 25.0, 100.0]
    d = spark.createDataFrame([(w,) for w in [*wages, 100.0]], "salaire double")
    r = audit.outliers(d, ["salaire"]).first()
    assert (r.q1, r.q3, r.upper, r.outliers, round(r.pct, 2)) == (6.5, 23.5, 49.0, 1, 9.09)


def test_rules_with_two_columns_and_nulls(spark):
    d = spark.createDataFrame([(10.0, 9.0), (10.0, 20.0), (None, 5.0)], "a double, b double")
    r = audit.check_rules(d, [catalog.Rule("r", "b <= a * 1.1", "m", "exclude", ("a", "b")), catalog.Rule("absent", "zz > 0", "m", "flag", ("zz",))]).collect()
    assert [(x.rule, x.n_invalid) for x in r] == [("r", 1)]
    assert audit.exclude_invalid(d, [catalog.Rule("r", "b <= a * 1.1", "m", "exclude", ("a", "b"))]).count() == 2


def test_schema_differences(spark):
    a, b = spark.createDataFrame([], "x int, y string"), spark.createDataFrame([], "x double, z string")
    assert audit.schema_differences([("1", a), ("2", b)]) == [{"file": "2", "missing": ["y"], "extra": ["z"], "retyped": [("x", "int", "double")]}]


def test_wide_and_dynamics(spark):
    d = spark.createDataFrame([(1, 1, "2024_01", 100.0), (2, 1, "2024_02", 150.0), (3, 1, "2024_02", 160.0), (4, 2, "2024_02", None)], "o int, i int, p string, v double")
    w = {r.i: r for r in reshape.wide_panel(d, "i", "p", ["v"], ["2024_01", "2024_02"], ["o"]).collect()}
    assert (w[1].v_t2024_01, w[1].v_t2024_02, w[2].v_t2024_01) == (100, 160, None)
    n = {r.i: r for r in reshape.numeric_dynamics(d, "i", "p", "v", ["2024_01", "2024_02"], ["o"]).collect()}
    assert tuple(n[1])[1:] == (60, 60, 130, 100, 160, 1, 2) and n[2].v_change is None
    assert reshape.order_columns(["b_t2024_02", "k", "a_t2024_01", "b_t2024_01"], ["a", "b"], ["k"]) == ["k", "a_t2024_01", "b_t2024_01", "b_t2024_02"]


def test_inverse_weights(spark):
    d = spark.createDataFrame([(1, 0.2), (2, 0.5), (3, None)], "i int, p double")
    r = [round(x.w_jt, 3) for x in models.inverse_weights(d, "p").orderBy("i").collect()]
    assert r == [1.735, 0.706, 1.0]


def test_auc_ties_and_direction(spark):
    d = spark.createDataFrame([(0.9, 0), (0.8, 1), (0.8, 0), (0.1, 1), (None, 1)], "s double, y int")
    assert models.auc(d, "s", "y").first().auc == pytest.approx(0.875)


def test_one_class_and_separated_outcomes(spark):
    d = spark.createDataFrame([(1, 1.0), (1, 2.0)], "y int, x double")
    spec = catalog.ModelSpec("m", "logit", "y", ("x", "absent"))
    m = models.fit_logit(d, spec)
    assert m.constant == 1.0 and m.dropped == ["absent"]
    sep = spark.createDataFrame([(int(i > 5), float(i)) for i in range(10)] + [(1, None)], "y int, x double")
    out = models.predict(sep, models.fit_logit(sep, spec), "p").collect()
    assert len(out) == 11 and all(r.p is None or 0 <= r.p <= 1 for r in out)


def test_imputations_are_repeatable_and_differ(spark):
    d = spark.createDataFrame([(i, float(i % 7), 0.5 * (i % 7) + 0.01 * (i % 3)) for i in range(60)], "k int, x double, y double")
    m = models.fit_linear(d, catalog.ModelSpec("m", "linear", "y", ("x",)))
    a, b = (sorted(tuple(r) for r in models.impute(d.repartition(n), m, ["k"], 3).select("k", "imputation_id", "log_imputed").collect()) for n in (1, 4))
    assert a == b and len({x[2] for x in a if x[0] == 1}) == 3 and m.figures["r2"] > 0.99


def test_stacking_with_and_without_pseudo_rows(spark):
    i = spark.createDataFrame([("A", 1, 5.0)], "f string, t int, y double")
    imp = spark.createDataFrame([("B", 1, 1, 7.0), ("B", 1, 2, 8.0)], "f string, t int, imputation_id int, imputed double")
    assert models.stack_imputations(i, imp, ["f", "t"], "y").count() == 4
    same = models.stack_imputations(i, imp, ["f", "t"], "y", pseudo_rows=False)
    assert same.groupBy("imputation_id").agg(F.sum("y")).agg(F.count_distinct("sum(y)")).first()[0] == 1


def test_gate_roles_and_toggle():
    assert models.gate({"auc": 0.5, "slope": 1.5, "n": 10}) and not models.gate({"auc": 0.7, "slope": 1.0, "n": 1000})
    assert catalog.guess_roles(["ID_INDIV", "PERIOD", "SALAIRE_BRUT", "NUMERO_EMPLOYEUR"])["salary"] == ["SALAIRE_BRUT"]
    assert catalog.merges(catalog.toggle(catalog.MERGES, "secteurs", False)) == []
    with pytest.raises(KeyError):
        catalog.toggle(catalog.MERGES, "x", True)


def test_similarity_join_is_exact_for_any_blocks(spark):
    """Best match and score over the whole lookup, below the threshold too; the lossy way keeps what it finds right."""
    from paygrain.functions.similarity import jaro

    left = ["abidjan nord", "bouake", "zzz qqq", "korhogo sud", "", None, "man"] + [f"site {i} {'xyz'[i % 3] * (i % 4)}" for i in range(40)]
    look = ["abidjan", "bouaké centre", "korhogo", "sud man", "qqzz"] + [f"{'zyx'[i % 3] * (i % 5)} sito {i}" for i in range(60)]
    x = spark.createDataFrame([(v,) for v in left], "t string")
    y = spark.createDataFrame([(v,) for v in look * 2], "m string")
    plain = {v: v.replace("é", "e") for v in look}
    want = {}
    for v in left:
        if v is not None:
            scores = [(jaro(v.strip(), " ".join(plain[m].split())), m) for m in look]
            top = max(s for s, _ in scores)
            want[v] = (min(m for s, m in scores if s == top) if top >= 0.8 else None, round(top, 9))
    for block in (7, 1000):
        got = {r.value: (r.match, round(r.score, 9)) for r in refjoin.best_matches(x, "t", y, "m", block=block).collect()}
        assert got == want
    shared = {r.value: r.match for r in refjoin.best_matches(x, "t", y, "m", blocking="shared").collect() if r.match}
    kept = sum(shared.get(v) == m for v, (m, _) in want.items() if m)
    assert set(shared) <= {v for v, (m, _) in want.items() if m} and kept >= 0.7 * sum(m is not None for m, _ in want.values())
    assert {(r.value, r.match, r.score) for r in refjoin.best_matches(x.where("t = 'man'"), "t", y.where("false"), "m").collect()} == {("man", None, None)}


def test_residual_statistics(spark):
    d = spark.createDataFrame([(float(x), 2.0 * x + (1 if x % 2 else -1)) for x in range(40)] + [(None, 5.0), (3.0, None)], "x double, y double")
    m = models.fit_linear(d, catalog.ModelSpec("m", "linear", "y", ("x",)))
    r = models.residual_statistics(d, m).first()
    assert abs(r["mean"]) < 1e-6 and abs(r.sd - m.figures["rmse"] * (40 / 39) ** 0.5) < 1e-6 and -1.2 < r.min < r.q25 < r.q75 < r.max < 1.2
