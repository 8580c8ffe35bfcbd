"""Personal information: forms found, look-alikes left, held-out accuracy, redaction."""

import re
from pathlib import Path

import pytest

from paygrain.llm import boosting, pii
from paygrain.llm.pii_training import sample

FOUND = [
    ("Écrire à jean_dupont@exemple.test pour toute question.", "email", "jean_dupont@exemple.test"),
    ("Copie à <awa.kone[at]paie[dot]mail[dot]example>.", "email", "awa.kone[at]paie[dot]mail[dot]example"),
    ("Write to paie (at) vora.test with questions.", "email", "paie (at) vora.test"),
    ("Joindre le service au (+225) 09 61 18 98 00.", "phone", "(+225) 09 61 18 98 00"),
    ("Cel 09.28.21.17.04 / fax néant", "phone", "09.28.21.17.04"),
    ("jean.kouassi@société.ci", "email", "jean.kouassi@société.ci"),
    ("SSN 123-45-6789 on file", "id", "123-45-6789"),
    ("Call 00225 0908102570 after noon.", "phone", "00225 0908102570"),
    ("Rappeler le 09 76 25 02 22 après 14 h.", "phone", "09 76 25 02 22"),
    ("Matricule GV 022 157 160 inconnu au fichier.", "id", "GV 022 157 160"),
    ("Sa pièce (C 7384 0799 14) est illisible.", "id", "C 7384 0799 14"),
    ("Carte 21ZK49812 expirée.", "id", "21ZK49812"),
    ("Domicile : Quai du Champ des Cigognes, n° 8.", "address", "Quai du Champ des Cigognes, n° 8"),
    ("Le courrier envoyé au 239 bis, rue du Champ des Cigognes est revenu.", "address", "239 bis, rue du Champ des Cigognes"),
    ("Siège : lot 193, îlot 7, quai du Port, Vanzi.", "address", "lot 193, îlot 7, quai du Port"),
    ("Office: 132 Silent Ferry Street, Mafoudi.", "address", "132 Silent Ferry Street"),
    ("Selon Mme Vackurat, le taux est faux.", "name", "Vackurat"),
    ("Dossier suivi par KOUFOLVA Abel.", "name", "KOUFOLVA Abel"),
    ("Le salaire de A. Quivamvié a été versé deux fois.", "name", "A. Quivamvié"),
    ("Transmis à Marie-Ange Vacképlo-Morfigné pour avis.", "name", "Marie-Ange Vacképlo-Morfigné"),
]
LEFT = [
    "Le dossier 0900602338 est en attente depuis le 14/07/2024.", "Compte interne 310 0912 445.", "Standard fermé de 12 30 à 14 00 00.", "objet@poids et modele@version sont des emplacements S4.",
    "Les taux du jour sont publiés sous la référence @paie_2024.", "Boîte postale 01 BP 1734.", "La Caisse Commune a répondu.", "Bureau Principal et Direction Générale sont saisis.", "Novaport SA emploie 929 salariés à Yébouassi.",
    "Le montant de 1 111 681 francs a été saisi deux fois.", "L'employeur 1000143 n'a pas déclaré.", "Votre demande R/910786/24 est close.", "La rue commerçante de la zone a été recensée en 12 blocs.", "Version 09.12.3 du gabarit.",
    "LES JOURNALIERS DE SÉGUÉROU SONT PAYÉS 12 JOURS PAR MOIS EN MOYENNE.", "00000000000000001234567890123456789", "Le fichier 09_2024_A001150.xlsx compte 6488 lignes.",
]


@pytest.fixture(scope="module")
def model():
    return pii.train()


@pytest.mark.parametrize(("text", "kind", "value"), FOUND)
def test_found(model, text, kind, value):
    assert [(k, text[a:b]) for k, a, b in pii.find([text], model)[0]] == [(kind, value)]


@pytest.mark.parametrize("text", LEFT)
def test_left(model, text):
    assert pii.find([text], model)[0] == []


def counts(pairs):
    """Per kind: found, missed, false."""
    c = {k: [0, 0, 0] for k in pii.KINDS}
    for truth, got in pairs:
        for n, spans in enumerate((truth & got, truth - got, got - truth)):
            for k, *_ in spans:
                c[k][n] += 1
    return c


def test_held_out_accuracy(model):
    texts = list(sample(1000, 4711))
    for k, (tp, fn, fp) in counts((set(t), set(g)) for (_, t), g in zip(texts, pii.find([t for t, _ in texts], model))).items():
        assert tp / (tp + fn) > 0.96 and tp / (tp + fp) > 0.97, k


def test_texts_of_another_origin(model):
    """Lines written by hand, apart from the patterns the trees are fitted on, with marks \u27e6kind:value\u27e7."""
    texts, truths = [], []
    for line in (Path(__file__).parent / "letters.txt").read_text(encoding="utf8").splitlines():
        text, truth = "", set()
        for part in re.split("(\u27e6.*?\u27e7)", line):
            m = re.fullmatch("\u27e6(\\w+):(.*)\u27e7", part)
            if m:
                truth.add((m[1], len(text), len(text) + len(m[2])))
            text += m[2] if m else part
        texts.append(text)
        truths.append(truth)
    for k, (tp, fn, fp) in counts(zip(truths, map(set, pii.find(texts, model)))).items():
        assert tp / (tp + fn) >= 0.9 and tp / (tp + fp) >= 0.9, (k, tp, fn, fp)


NAMES = [
    ("Le rapport de Zhang Weimin est attendu.", ["Zhang Weimin"]),
    ("JEAN KOUASSI DIRECTEUR GENERAL DE LA SOCIETE", ["JEAN KOUASSI"]),
    ("Monsieur Aya Kouassi Jean Konan Paul Koffi Awa Traore", ["Aya Kouassi", "Jean Konan", "Paul Koffi", "Awa Traore"]),
    ("Présents : Mme Aya Kouassi Responsable Paie Direction Générale Caisse Commune.", ["Aya Kouassi"]),
    ("Mr. Smith and Mrs. O'Connor met Dr. Van der Berg and madame Koné.", ["Smith", "O'Connor", "Van der Berg", "Koné"]),
]


@pytest.mark.parametrize(("text", "names"), NAMES)
def test_rows_of_any_length(model, text, names):
    assert [text[a:b] for k, a, b in pii.find([text], model)[0] if k == "name"] == names


def test_long_row_is_linear():
    row = " ".join(["Mot"] * 5000)
    assert len(pii.candidates(row)) <= 5000 * pii.NAME_WORDS


def test_no_vocabulary_of_the_row_is_lost(model):
    names = ["Awa Koné", "Paul Brou", "Inès Sarr"]
    text = "Liste : " + ", ".join(names * 40) + "."
    assert [text[a:b] for _, a, b in pii.find([text], model)[0]] == names * 40


def test_decomposed_accents_come_out_as_written(model):
    import unicodedata

    t = unicodedata.normalize("NFD", "Déjà vu. Selon Mme Béréglé, rien.")
    got = pii.find_as_written([t], model)[0]
    assert [t[a:b] for _, a, b in got] == [unicodedata.normalize("NFD", "Béréglé")]


def test_tables(spark):
    d = spark.createDataFrame([(1, None), (2, ""), (3, "Selon Mme Vackurat, rien. Selon Mme Vackurat, tout. Tél. : 09 41 91 49 77"), (3, "rien")], "doc_id bigint, text string")
    got = sorted(tuple(r) for r in pii.personal_information(d).collect())
    assert got == [(3, "name", "Vackurat"), (3, "phone", "09 41 91 49 77")]
    red = {(r.doc_id, r.text) for r in pii.redact(d).collect()}
    assert red == {(1, None), (2, ""), (3, "Selon Mme [NAME], rien. Selon Mme [NAME], tout. Tél. : [PHONE]"), (3, "rien")}
    assert pii.personal_information(d.where("false")).collect() == []


def test_very_long_text(model):
    t = "mot " * 200_000 + "Selon Mme Vackurat, rien." + " mot" * 10
    assert [t[a:b] for _, a, b in pii.find([t], model)[0]] == ["Vackurat"]


def test_trees_learn_an_interaction():
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.random((2000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    m = boosting.fit(x[:1500], y[:1500], trees=40, depth=3)
    boosting.calibrate(m, x[1500:], y[1500:])
    assert ((m.probability(x[1500:]) > 0.5) == (y[1500:] > 0)).mean() > 0.97
