"""Declarative catalogues: column types, labels, dimensions, statistics, models, lookups, rules. To extend, append an entry."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: logical types of the known columns ----------------------------------------------------------------
TEXTS = (
    "ID_INDIV", "ID_EMPLOI", "NUMERO_EMPLOYEUR", "NUMERO_EMPLOYEUR_ALT", "SEXE", "SITUATION_MATRIMONIALE", "NIVEAU_ETUDE", "PROFESSION",
    "STATUT_TRAVAILLEUR", "TYPE_SALARIE", "CSP_CODE", "PROF_CODE", "RAISON_SOCIALE", "SECTEUR_ACTIVITE", "SECTEUR_ACTIVITE_COD", "SECTOR_CODE",
    "LIBELLE_AGENCE", "COMMUNE", "PERIOD", "CL_AGE_EMPLOYE", "CL_ANCIENNETE_ENTREPRISE", "CL_ANCIENNETE_IMMAT", "CL_AGE_ENTREPRISE_IMMAT",
    "CL_RED_AGE_EMPLOYE", "CL_RED_ANCIENNETE_ENTREPRISE", "CL_RED_ANCIENNETE_IMMAT", "CL_RED_AGE_ENTREPRISE_IMMAT", "CLASSE_EFFECTIF",
    "CLASSE_EFFECTIF_REDUITE",
)
NUMBERS = (
    "CATEGORIE_ENTREPRISE", "EFFECTIF_SALARIES", "SALAIRE_BRUT", "DUREE_TRAVAILLEE", "SALAIRE_BRUT_MENS", "MOIS", "ANNEE", "TRIMESTRE", "SEMESTRE",
    "AGE_EMPLOYE", "ANCIENNETE_ENTREPRISE", "ANCIENNETE_IMMAT", "AGE_ENTREPRISE_IMMAT",
)
MOMENTS = (
    "DATE_NAISSANCE", "DATE_EMBAUCHE", "DATE_IMMATRICULATION", "DATE_DEBUT_ACT_EMPLOY", "DATE_IMMAT_EMPLOYEUR",
)
TYPES = {**{c: "text" for c in TEXTS}, **{c: "number" for c in NUMBERS}, **{c: "moment" for c in MOMENTS}}

# --- fixed values: code labels -----------------------------------------------------------------------------------------
LABELS = {
    "SEXE": {"M": "Masculin", "F": "Féminin", "1": "Masculin", "2": "Féminin"},
    "TYPE_SALARIE": {"M": "Mensuel", "H": "Horaire", "J": "Journalier"},
    "SITUATION_MATRIMONIALE": {
        "C": "Célibataire", "M": "Marié(e)", "D": "Divorcé(e)", "V": "Veuf/Veuve", "1": "Célibataire", "2": "Marié(e)", "3": "Divorcé(e)", "4": "Veuf/Veuve",
    },
}


@dataclass(frozen=True)
class Dimension:
    """least: weighted count below which a cell is not published."""

    name: str
    variable: str | None
    label: str
    least: float = 30
    in_weights: bool = False
    in_imputation: bool = True
    enabled: bool = True


# Fixed values.
DIMENSIONS = [
    Dimension("global", None, "National", 1, False, False),
    Dimension("sector", "SECTEUR_ACTIVITE_COD", "Secteur d'activité", in_weights=True),
    Dimension("age_employe", "CL_RED_AGE_EMPLOYE", "Tranche d'âge employé"),
    Dimension("anciennete_entreprise", "CL_RED_ANCIENNETE_ENTREPRISE", "Ancienneté entreprise", in_weights=True),
    Dimension("anciennete_immat", "CL_RED_ANCIENNETE_IMMAT", "Ancienneté immatriculation", in_weights=True),
    Dimension("age_entreprise", "CL_RED_AGE_ENTREPRISE_IMMAT", "Âge entreprise", in_weights=True),
    Dimension("taille_entreprise", "CLASSE_EFFECTIF", "Taille entreprise", in_weights=True),
    Dimension("taille_entreprise_red", "CLASSE_EFFECTIF_REDUITE", "Taille entreprise (réduite)", in_weights=True),
    Dimension("sex", "SEXE", "Sexe"),
    Dimension("commune", "COMMUNE", "Commune", 50, in_imputation=False),
    Dimension("csp", "CSP_CODE", "Catégorie socioprofessionnelle", in_weights=True),
    Dimension("profession", "PROF_CODE", "Profession", 50),
]


def dimensions(columns: Iterable[str], catalogue: Sequence[Dimension] = tuple(DIMENSIONS), use: str | None = None) -> list[Dimension]:
    """Enabled dimensions whose column is there, whatever its case; use: in_weights or in_imputation."""
    have = {c.upper() for c in columns}
    return [d for d in catalogue if d.enabled and (d.variable is None or d.variable.upper() in have) and (use is None or getattr(d, use))]


@dataclass(frozen=True)
class Statistic:
    """kind: a builder's name in operators.stats.BUILDERS; p: of a quantile; combine: over imputations."""

    name: str
    kind: str
    label: str
    p: float | None = None
    combine: bool = True


# Fixed values.
STATISTICS = [
    Statistic("n_obs", "count", "Effectif observé", combine=False),
    Statistic("n_weighted", "weight", "Effectif pondéré", combine=False),
    Statistic("mean", "mean", "Moyenne"),
    Statistic("variance", "variance", "Variance"),
    Statistic("min", "min", "Minimum"),
    Statistic("max", "max", "Maximum"),
    Statistic("q1", "quantile", "Premier quartile", 0.25),
    Statistic("median", "quantile", "Médiane", 0.5),
    Statistic("q3", "quantile", "Troisième quartile", 0.75),
    Statistic("p10", "quantile", "Premier décile", 0.1),
    Statistic("p90", "quantile", "Neuvième décile", 0.9),
    Statistic("gini", "gini", "Indice de Gini"),
]


@dataclass(frozen=True)
class ModelSpec:
    """A fit: outcome, candidate covariates (those present are used), family logit or linear."""

    name: str
    family: str
    outcome: str
    covariates: tuple[str, ...]
    stabilise: bool = True
    trim: tuple[float, float] = (0.01, 0.99)
    floor: float = 0.01


# Fixed values.
MODELS = [
    ModelSpec(
        "declaration_firm",
        "logit",
        "D_jt",
        ("SECTEUR_ACTIVITE_COD", "CLASSE_EFFECTIF_REDUITE", "AGE_ENTREPRISE_IMMAT", "D_jt_lag1", "D_jt_lag2", "N_DECLARATIONS_PASSEES", "PCT_DECLARATIONS_PASSEES", "MOIS", "ANNEE"),
    ),
    ModelSpec("imputation_firm_salary", "linear", "log_Y_bar_jt", ("SECTEUR_ACTIVITE_COD", "CLASSE_EFFECTIF_REDUITE", "log_Y_bar_jt_lag1", "log_Y_bar_jt_lag2", "EFFECTIF_MOYEN_PASSE", "MOIS")),
    ModelSpec("declaration_individual", "constant", "R_ijt", ()),
    ModelSpec("imputation_individual_salary", "linear", "log_Y_ijt", ("SECTEUR_ACTIVITE_COD", "SEXE", "AGE_EMPLOYE", "ANCIENNETE_ENTREPRISE", "CL_RED_ANCIENNETE_ENTREPRISE")),
]


@dataclass(frozen=True)
class MergeSpec:
    """A join to a lookup: exact by key, or fuzzy by the most similar text at or above threshold."""

    name: str
    ref: str
    key: str
    ref_key: str
    kind: str = "exact"
    how: str = "left"
    keep: tuple[str, ...] = ()
    drop: tuple[str, ...] = ()
    rename: tuple[tuple[str, str], ...] = ()
    check: str | None = None
    order: int = 1
    method: str = "jw"
    threshold: float = 0.8
    score: str | None = None
    enabled: bool = True


# Fixed values.
MERGES = [MergeSpec("secteurs", "secteurs_employeurs", "NUMERO_EMPLOYEUR", "NUMERO_EMPLOYEUR", keep=("SECTEUR_ACTIVITE_COD",), drop=("CLASSE_EFFECTIF",), check="SECTEUR_ACTIVITE_COD")]
#: Quality bands of a similarity, best first.
BANDS = (("excellent", 0.95), ("good", 0.85), ("acceptable", 0.75), ("poor", 0.60))


def merges(catalogue: Sequence[MergeSpec] = tuple(MERGES), kind: str | None = None) -> list[MergeSpec]:
    return sorted((m for m in catalogue if m.enabled and (kind is None or m.kind == kind)), key=lambda m: m.order)


def check_files(catalogue: Sequence[MergeSpec], exists: Callable[[str], bool]) -> dict[str, object]:
    """Whether the lookups of all enabled entries are there: valid, and the names of existing and missing ones."""
    there = {m.ref: exists(m.ref) for m in merges(catalogue)}
    return {"valid": all(there.values()), "existing": [r for r, ok in there.items() if ok], "missing": [r for r, ok in there.items() if not ok]}


def list_merges(catalogue: Sequence[MergeSpec], exists: Callable[[str], bool]) -> list[tuple[str, str, str, bool, int, bool]]:
    """(name, lookup, kind, enabled, order, lookup exists) of every entry, in their order."""
    return [(m.name, m.ref, m.kind, m.enabled, m.order, exists(m.ref)) for m in sorted(catalogue, key=lambda m: m.order)]


def toggle(catalogue: list[MergeSpec], name: str, enabled: bool) -> list[MergeSpec]:
    """The catalogue with one entry switched; an unknown name is an error."""
    from dataclasses import replace

    if name not in {m.name for m in catalogue}:
        raise KeyError(name)
    return [replace(m, enabled=enabled) if m.name == name else m for m in catalogue]


@dataclass(frozen=True)
class Rule:
    """An SQL predicate that holds for valid rows; action exclude, flag, warn, error or suppress."""

    name: str
    predicate: str
    message: str
    action: str = "flag"
    columns: tuple[str, ...] = ()


# Fixed values.
RULES = [
    Rule("salaire_brut_positive", "salaire_brut > 0", "Salaire brut doit être positif", "exclude", ("salaire_brut",)),
    Rule("duree_travaillee_valid", "duree_travaillee >= 0 AND duree_travaillee <= 12", "Durée travaillée invalide", "flag", ("duree_travaillee",)),
    Rule("id_indiv_not_missing", "id_indiv IS NOT NULL AND id_indiv <> ''", "ID individu manquant", "exclude", ("id_indiv",)),
    Rule("numero_employeur_valid", "numero_employeur IS NOT NULL", "Numéro employeur manquant", "exclude", ("numero_employeur",)),
]


def label(c: Column, labels: dict[str, str]) -> Column:
    """A code's label; an unknown code is kept."""
    m = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    return F.coalesce(F.element_at(m, c), c)


def missing_columns(columns: Iterable[str], required: Iterable[str]) -> list[str]:
    have = {c.upper() for c in columns}
    return [c for c in required if c.upper() not in have]


#: Name patterns by role, for tables whose columns aren't known beforehand.
ROLES = {
    "id": r"id|mat|ident|individu|person|num|nni|cnps",
    "time": r"annee|year|periode|date|trimestre|mois|time|an",
    "salary": r"sal|remun|wage|revenu|income|montant|masse",
    "status": r"statut|status|categorie|type|class|poste|fonction",
    "firm": r"entreprise|firm|employ|societe|company|etab|raison",
}


def guess_roles(columns: Sequence[str], roles: dict[str, str] = ROLES) -> dict[str, list[str]]:
    """Columns whose names fit each role, in their order."""
    return {r: [c for c in columns if re.search(rx, c, re.I)] for r, rx in roles.items()}
