"""Schema changes between files and the one consistent table."""

import json

import pytest

from paygrain.operators import schema_drift as S

SCHEMA = "fichier string, ligne_id bigint, contenu string"


def frame(spark, files):
    rows = [(f, x if isinstance(x, str) or x is None else json.dumps(x, ensure_ascii=False)) for f, xs in files for x in xs]
    return spark.createDataFrame([(f, i, c) for i, (f, c) in enumerate(rows)], SCHEMA)


def changes(spark, files):
    return sorted(tuple(r) for r in S.schema_changes(frame(spark, files)).select("fichier", "champ", "changement").collect())


def test_all_four_changes(spark):
    files = [
        ("01_2024_A1.xlsx", [{"ID_INDIV": "AB123456789", "SALAIRE_BRUT": 100000, "SEXE": "F", "PRIME": 1}] * 3),
        ("02_2024_A1.xlsx", [{"Id Indiv": "AB123456789", "REMUNERATION_BRUTE": "100 000", "COMMUNE": "X", "PRIME": 1}] * 3),
        ("01_2024_B.xlsx", [{"SEXE": "F"}]),
    ]
    assert changes(spark, files) == [
        ("02_2024_A1.xlsx", "COMMUNE", "added"),
        ("02_2024_A1.xlsx", "ID_INDIV", "renamed"),
        ("02_2024_A1.xlsx", "SALAIRE_BRUT", "renamed"),
        ("02_2024_A1.xlsx", "SALAIRE_BRUT", "retyped"),
        ("02_2024_A1.xlsx", "SEXE", "removed"),
    ]


def test_unreadable_rows_missing_month_and_nulls(spark):
    files = [
        ("01_2024_A1.xlsx", [{"SEXE": "F", "DUREE_TRAVAILLEE": None}, '{"COMMUNE": ', None, "[1]", "7", ""]),
        ("03_2024_A1.xlsx", [{"SEXE": "F", "DUREE_TRAVAILLEE": 1}, {"SEXE": 1}, {"SEXE": "M"}]),
        ("notes.xlsx", [{"SEXE": "F"}]),
    ]
    assert changes(spark, files) == []


def test_case_and_blanks_are_renames(spark):
    assert changes(spark, [("12_2024_A.xlsx", [{"SALAIRE_BRUT": 1}]), ("01_2025_A.xlsx", [{"SALAIRE_BRUT ": 1}])]) == [("01_2025_A.xlsx", "SALAIRE_BRUT", "renamed")]


@pytest.mark.parametrize(
    ("header", "champ"),
    [("SALAIREBRUT", "SALAIRE_BRUT"), ("SAL_BRUT", "SALAIRE_BRUT"), ("N° employeur", "NUMERO_EMPLOYEUR"), ("NE_LE", "DATE_NAISSANCE"), ("GENRE", "SEXE"), ("duree", "DUREE_TRAVAILLEE"), ("Nb salariés", "EFFECTIF_SALARIES"), ("TYPE_SAL", "TYPE_SALARIE")],
)
def test_correspondences(header, champ):
    assert S.flood([(header, "text", "words", None)]) == {header: champ}


@pytest.mark.parametrize("header", ["SALAIRE_NET", "SALAIRE_BASE", "NUMERO_EMPLOYEUR_ALT", "ID_EMPLOI", "PRIME_TRANSPORT", "", "???"])
def test_other_fields_keep_their_header(header):
    assert S.flood([(header, "number", "9 six", None)]) == {}


@pytest.mark.parametrize(
    ("header", "kind", "form", "champ"),
    [
        ("SALAIRE_BRT", "number", "9 six", "SALAIRE_BRUT"), ("SALARE_BRUT", "number", "9 six", "SALAIRE_BRUT"), ("Salaires bruts", "text", "9 grouped", "SALAIRE_BRUT"), ("Salaire mensuel brut", "number", "9 six", "SALAIRE_BRUT"),
        ("Gross salary", "number", "9 six", "SALAIRE_BRUT"), ("Employer Number", "text", "9 seven", "NUMERO_EMPLOYEUR"), ("Matricule salarie", "text", "AA9", "ID_INDIV"), ("NUMRO EMPLOYUER", "number", "9 seven", "NUMERO_EMPLOYEUR"),
    ],
)
def test_unseen_headers_with_matching_values(header, kind, form, champ):
    assert S.flood([(header, kind, form, None)]) == {header: champ}


def test_values_decide_where_names_leave_it_open():
    """The same header, once with an identity number's values, once with a flag's."""
    assert S.flood([("Matricule salarie", "text", "AA9", None)]) == {"Matricule salarie": "ID_INDIV"}
    assert S.flood([("Matricule salarie", "number", "decimal", None)]) == {}


def test_propagation_decides():
    headers = [(" ID_INDIV", "text", "AA9", None), ("RS_EMPLOYEUR", "text", "words", None), ("NO_EMPLOYEUR", "text", "9 seven", None), ("GENRE", "text", "letter", None), ("NE_LE", "text", "date", None),
               ("REMUNERATION_BRUTE", "number", "9 six", None), ("SALAIRE_NET", "number", "9 six", None), ("COMMUNE_EMPLOYEUR", "text", "words", None)]
    want = {" ID_INDIV": "ID_INDIV", "RS_EMPLOYEUR": "RAISON_SOCIALE", "NO_EMPLOYEUR": "NUMERO_EMPLOYEUR", "GENRE": "SEXE", "NE_LE": "DATE_NAISSANCE", "REMUNERATION_BRUTE": "SALAIRE_BRUT", "COMMUNE_EMPLOYEUR": "COMMUNE"}
    assert S.flood(headers) == want
    names_alone = S.flood(headers, most=0)
    assert names_alone != want and names_alone["SALAIRE_NET"] == "SALAIRE_BRUT" and "GENRE" not in names_alone
    # rivals weigh on a word: with the wage itself in the file, SALARE speaks of it and no longer of the workers
    few, many = (S.scores([("SALARE", "number", "9 six", None), ("SALAIRE_BRUT", "number", "9 six", None)], S.PROJECT, most=m) for m in (1, 60))
    assert (few != many).any()


def test_scores_converge():
    headers = [(f.name, f.kinds[0], f.forms[0], None) for f in S.PROJECT]
    a, b = S.scores(headers, S.PROJECT, most=60), S.scores(headers, S.PROJECT, most=200)
    assert abs(a - b).max() < 1e-3 and S.flood(headers) == {f.name: f.name for f in S.PROJECT}


def test_second_header_of_a_column_does_not_take_another():
    got = S.flood([("DATE_EMBAUCHE", "text", "date", None), ("DT_EMBAUCHE", "text", "date", None)])
    assert got == {"DATE_EMBAUCHE": "DATE_EMBAUCHE"}


def test_one_header_per_column():
    got = S.flood([("SALAIRE_BRUT", "number", "9 six", None), ("Salaire brut", "number", "9 six", None)])
    assert got == {"SALAIRE_BRUT": "SALAIRE_BRUT"} or len(got) == 1


def test_unify_types(spark):
    files = [
        ("01_2024_A1.xlsx", [{"ID_INDIV": "AB123456789", "SALAIRE_BRUT": "100 250,5", "Date embauche": "13/06/2015"}]),
        ("02_2024_A1.xlsx", [{"MATRICULE_INDIV": 123456789, "SAL_BRUT": {"montant": 7, "devise": "XOF"}, "DT_EMBAUCHE": 45292, "PRIME_TRANSPORT": 5}, "{broken"]),
    ]
    got = {r.ligne_id: r for r in S.unify(frame(spark, files)).collect()}
    assert (got[0].SALAIRE_BRUT, str(got[0].DATE_EMBAUCHE)) == (100250.5, "2015-06-13")
    assert (got[1].ID_INDIV, got[1].SALAIRE_BRUT, str(got[1].DATE_EMBAUCHE), got[1].autres) == ("123456789", 7.0, "2024-01-01", {"PRIME_TRANSPORT": "5"})
    assert got[2].SALAIRE_BRUT is None and len(got) == 3


def test_empty(spark):
    assert changes(spark, []) == []
