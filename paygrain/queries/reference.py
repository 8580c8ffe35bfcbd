"""Queries of the statistical pipeline's operators, each with its DuckDB twin. Keys begin with the inventory's numbers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import bins, dates, mathx, similarity, text
from ..operators import audit, clean, intervals, models, panel, refjoin, reshape, stats
from ..plans import catalog
from ..session import folder, materialise, table
from ..sources import files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
MONTHS = [f"{2024 + (m - 1) // 12}_{(m - 1) % 12 + 1:02d}" for m in range(1, 19)]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def rounded(df: DataFrame, n: int = 4, skip: Sequence[str] = ()) -> DataFrame:
    return df.select(*[F.round(c, n).alias(c) if t == "double" and c not in skip else F.col(c) for c, t in df.dtypes])


def _decl(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "declarations")


def _base(s: SparkSession, d: str) -> DataFrame:
    """Analytical base with unusable wages as null and weights as decimals, whose sums don't depend on their order."""
    b = table(s, d, "base_analytique")
    w = F.coalesce(F.col("w_final"), F.lit(1.0)).cast("decimal(12,6)")
    return b.withColumn("y", F.when(F.col("salaire_brut_mens").between(0, 90_000_000), F.col("salaire_brut_mens"))).withColumn("w", w)


_B = "b AS (SELECT *, CASE WHEN salaire_brut_mens BETWEEN 0 AND 90000000 THEN salaire_brut_mens END y, coalesce(w_final, 1.0)::DECIMAL(12, 6) w FROM base_analytique)"
_TYPES_KEY = "regexp_replace(nullif(trim(numero_employeur), ''), '\\.0+$', '')"


def _case(x: str, classes: list[bins.Class], label: bool) -> str:
    parts = []
    for i, (lo, hi, name) in enumerate(classes, 1):
        c = " AND ".join(([f"{x} >= {lo!r}"] if lo is not None else []) + ([f"{x} <= {hi!r}"] if hi is not None else []))
        parts.append(f"WHEN {c} THEN " + (f"'{name}'" if label else str(i)))
    return f"CASE WHEN {x} IS NULL OR isnan({x}::DOUBLE) THEN NULL {' '.join(parts)} END"


# --- projections and filters -----------------------------------------------------------------------------------------


@query(
    f"SELECT ligne_id, nullif(trim(id_indiv), '') id_indiv, {_TYPES_KEY} numero_employeur, nullif(trim(sexe), '') sexe, nullif(trim(type_salarie), '') type_salarie, salaire_brut, mois::DOUBLE mois, annee::DOUBLE annee FROM declarations"
)
def prj01_harmonise(s, d):
    return clean.harmonise(_decl(s, d).select("ligne_id", "id_indiv", "numero_employeur", "sexe", "type_salarie", "salaire_brut", "mois", "annee"))


_AGES = (("age_employe", "date_naissance"), ("anciennete_entreprise", "date_embauche"), ("anciennete_immat", "date_immatriculation"), ("age_entreprise_immat", "date_immat_employeur"))


@query(
    "SELECT ligne_id, "
    + ", ".join(f"annee - year({src})::INT {n}, {_case(f'(annee - year({src}))', bins.AGE, True)} cl_{n}, {_case(f'(annee - year({src}))', bins.AGE_REDUCED, False)}::INT cl_red_{n}_code" for n, src in _AGES)
    + f", {_case('effectif_salaries', bins.SIZE, True)} classe_effectif, {_case('effectif_salaries', bins.SIZE_REDUCED, True)} classe_effectif_reduite"
    + ", printf('%d_%02d', annee, mois) period, ceil(mois / 3)::INT trimestre, ceil(mois / 6)::INT semestre, CASE WHEN duree_travaillee > 0 THEN salaire_brut / duree_travaillee ELSE salaire_brut END salaire_brut_mens FROM declarations"
)
def prj07_prj08_prj09_bin01_to_bin04_derived(s, d):
    x = clean.derive(_decl(s, d))
    return x.select("ligne_id", *[c for n, _ in _AGES for c in (n, f"cl_{n}", f"cl_red_{n}_code")], "classe_effectif", "classe_effectif_reduite", "period", "trimestre", "semestre", "salaire_brut_mens")


@query("SELECT ligne_id, coalesce(id_indiv, 'NA') || '_' || coalesce(numero_employeur, 'NA') || '_' || printf('%d_%02d', annee, mois) obs_id FROM declarations")
def prj10_observation_id(s, d):
    x = _decl(s, d).withColumn("period", dates.period(F.col("annee"), F.col("mois")))
    return x.select("ligne_id", clean.observation_id("id_indiv", "numero_employeur", "period").alias("obs_id"))


@query("SELECT ligne_id, coalesce(w_jt, 1.0) * coalesce(w_ijt, 1.0) AS w, round(ln(1 + w_jt), 9) l, round(exp(ln(1 + w_jt)) - 1, 9) e FROM base_analytique")
def prj12_prj13_weights_and_logs(s, d):
    b = table(s, d, "base_analytique")
    return rounded(b.select("ligne_id", panel.weight_product(F.col("w_jt"), F.col("w_ijt")).alias("w"), F.log1p("w_jt").alias("l"), F.expm1(F.log1p("w_jt")).alias("e")), 9, ["w"])


@query(
    "SELECT ligne_id, CASE sexe WHEN 'M' THEN 'Masculin' WHEN 'F' THEN 'Féminin' WHEN '1' THEN 'Masculin' WHEN '2' THEN 'Féminin' ELSE sexe END sexe, CASE type_salarie WHEN 'M' THEN 'Mensuel' WHEN 'H' THEN 'Horaire' WHEN 'J' THEN 'Journalier' ELSE type_salarie END type_salarie FROM declarations"
)
def prj14_labels(s, d):
    return _decl(s, d).select("ligne_id", *[catalog.label(F.col(c), catalog.LABELS[c.upper()]).alias(c) for c in ("sexe", "type_salarie")])


_CLEAN = """f AS (SELECT * REPLACE (CASE WHEN (type_salarie = 'M' AND (duree_travaillee = 0 OR duree_travaillee > 1)) IS NULL THEN NULL WHEN type_salarie = 'M' AND (duree_travaillee = 0 OR duree_travaillee > 1) THEN 1.0 ELSE duree_travaillee END AS duree_travaillee)
FROM declarations WHERE salaire_brut IS NOT NULL AND salaire_brut <> 0 AND (type_salarie IS NULL OR type_salarie NOT IN ('H', 'J')))"""


@query(f"WITH {_CLEAN} SELECT ligne_id, salaire_brut, duree_travaillee, type_salarie, CASE WHEN duree_travaillee > 0 THEN salaire_brut / duree_travaillee ELSE salaire_brut END salaire_brut_mens FROM f WHERE NOT (salaire_brut < 75000 AND type_salarie = 'M')")
def flt01_to_flt05_clean(s, d):
    return clean.apply_filters(_decl(s, d)).select("ligne_id", "salaire_brut", "duree_travaillee", "type_salarie", "salaire_brut_mens")


@query("SELECT ligne_id FROM declarations WHERE sexe IS NOT NULL AND csp_code IS NOT NULL AND salaire_brut IS NOT NULL")
def flt06_complete_cases(s, d):
    return clean.complete_cases(_decl(s, d), ["sexe", "csp_code", "salaire_brut"]).select("ligne_id")


@query(
    "SELECT d_jt, count(*) n, count(salaire_moyen) with_wage FROM panel_employeur WHERE d_jt IN (0, 1) GROUP BY 1"
)
def flt10_declarants(s, d):
    p = panel.with_flag(table(s, d, "panel_employeur"))
    return p.groupBy("d_jt").agg(F.count("*").alias("n"), F.count("salaire_moyen").alias("with_wage"))


@query(
    """SELECT r AS rule, a AS action, m AS message, coalesce(sum(CASE WHEN ok IS FALSE THEN 1 ELSE 0 END), 0)::BIGINT n_invalid, round(sum(CASE WHEN ok IS FALSE THEN 1 ELSE 0 END) * 100.0 / count(*), 6) pct_invalid FROM (
SELECT unnest([{'r': 'salaire_brut_positive', 'a': 'exclude', 'm': 'Salaire brut doit être positif', 'ok': salaire_brut > 0}, {'r': 'duree_travaillee_valid', 'a': 'flag', 'm': 'Durée travaillée invalide', 'ok': duree_travaillee >= 0 AND duree_travaillee <= 12},
{'r': 'id_indiv_not_missing', 'a': 'exclude', 'm': 'ID individu manquant', 'ok': id_indiv IS NOT NULL AND id_indiv <> ''}, {'r': 'numero_employeur_valid', 'a': 'exclude', 'm': 'Numéro employeur manquant', 'ok': numero_employeur IS NOT NULL}], recursive := true) FROM declarations) GROUP BY ALL"""
)
def flt09_rules(s, d):
    return rounded(audit.check_rules(_decl(s, d), catalog.RULES), 6)


@query("SELECT ligne_id FROM declarations WHERE coalesce(salaire_brut > 0, true) AND coalesce(id_indiv IS NOT NULL AND id_indiv <> '', true) AND numero_employeur IS NOT NULL")
def flt09_exclude(s, d):
    return audit.exclude_invalid(_decl(s, d), catalog.RULES).select("ligne_id")


# --- joins -----------------------------------------------------------------------------------------------------------

_LOOK = "k AS (SELECT trim(numero_employeur) e, secteur_activite_cod FROM secteurs_employeurs WHERE nullif(trim(numero_employeur), '') IS NOT NULL QUALIFY row_number() OVER (PARTITION BY trim(numero_employeur) ORDER BY secteur_activite_cod NULLS FIRST) = 1)"


@query(f"WITH {_LOOK} SELECT ligne_id, trim(numero_employeur) numero_employeur, k.secteur_activite_cod FROM declarations LEFT JOIN k ON nullif(trim(numero_employeur), '') = k.e")
def joi01_exact_left(s, d):
    return refjoin.join_exact(_decl(s, d).select("ligne_id", "numero_employeur"), table(s, d, "secteurs_employeurs"), "numero_employeur")


@query(f"WITH {_LOOK} SELECT ligne_id, b.secteur_activite_cod, k.secteur_activite_cod secteur_activite_cod_ref FROM base_analytique b JOIN k ON nullif(trim(b.numero_employeur), '') = k.e")
def joi02_joi03_exact_inner_suffix(s, d):
    b = table(s, d, "base_analytique").select("ligne_id", "numero_employeur", "secteur_activite_cod")
    return refjoin.join_exact(b, table(s, d, "secteurs_employeurs"), "numero_employeur", how="inner").drop("numero_employeur")


@query(f"WITH {_LOOK} SELECT count(*) n, count(k.secteur_activite_cod) matched, round(count(k.secteur_activite_cod) / count(*), 6) rate FROM declarations LEFT JOIN k ON nullif(trim(numero_employeur), '') = k.e")
def joi04_match_rate(s, d):
    return rounded(refjoin.match_rate(joi01_exact_left(s, d), "secteur_activite_cod"), 6)


_PREP = "trim(regexp_replace(regexp_replace(lower(strip_accents(coalesce({}, ''))), '[!-/:-@\\[-`{{-~]', ' ', 'g'), '\\s+', ' ', 'g'))"
_FUZZY = f"""x AS (SELECT DISTINCT p_name v, {_PREP.format('p_name')} px FROM part), y AS (SELECT DISTINCT reverse(p_brand) || ' ' || p_name m FROM part), z AS (SELECT {_PREP.format('m')} py, min(m) m FROM y GROUP BY 1),
s AS (SELECT px, py, m, jaro_similarity(px, py) j FROM (SELECT DISTINCT px FROM x), z),
b AS (SELECT px, max(j) j FROM s GROUP BY 1), w AS (SELECT s.px, s.j, min(m) m FROM s JOIN b USING (px, j) GROUP BY ALL)"""


def _lookup_names(s, d):
    p = table(s, d, "part")
    return p.select(F.concat_ws(" ", F.reverse("p_brand"), "p_name").alias("m"))


@query(f"WITH {_FUZZY} SELECT v AS value, CASE WHEN j >= 0.7 THEN m END AS match, round(j, 6) score FROM x JOIN w USING (px)")
def joi05b_win11_best_matches(s, d):
    return rounded(refjoin.best_matches(table(s, d, "part"), "p_name", _lookup_names(s, d), "m", "jw", 0.7), 6)


@query(f"WITH {_FUZZY} SELECT p_partkey, CASE WHEN j >= 0.7 THEN m END AS m, round(j, 6) score FROM part LEFT JOIN x ON p_name = v LEFT JOIN w USING (px)")
def joi05_fuzzy_join(s, d):
    j = refjoin.join_fuzzy(table(s, d, "part").select("p_partkey", "p_name"), _lookup_names(s, d), "p_name", "m", "jw", 0.7, score="score")
    return rounded(j.select("p_partkey", "m", "score"), 6)


@query(f"WITH {_FUZZY} SELECT p_partkey, CASE WHEN j >= 0.7 THEN m END AS m, round(j, 6) score FROM part LEFT JOIN x ON p_name = v LEFT JOIN w USING (px)")
def joi05_joi14_merge_all_fuzzy(s, d):
    """The fold over lookups with a similarity join in it, on its default path; the lookup in blocks of 500 texts."""
    spec = catalog.MergeSpec("noms", "part", "p_name", "m", kind="fuzzy", method="jw", threshold=0.7, score="score")
    x, _ = refjoin.merge_all(table(s, d, "part").select("p_partkey", "p_name"), [spec], lambda n: _lookup_names(s, d), block=500)
    return rounded(x.select("p_partkey", "m", "score"), 6)


@query(f"WITH {_FUZZY}, q AS (SELECT CASE WHEN j >= 0.95 THEN 'excellent' WHEN j >= 0.85 THEN 'good' WHEN j >= 0.75 THEN 'acceptable' WHEN j >= 0.6 THEN 'poor' ELSE 'rejected' END quality, j FROM part JOIN x ON p_name = v JOIN w USING (px)) SELECT quality, count(*) n, round(avg(j), 6) mean_score FROM q GROUP BY 1")
def agg25_match_quality(s, d):
    return rounded(refjoin.quality_report(refjoin.join_fuzzy(table(s, d, "part"), _lookup_names(s, d), "p_name", "m", "jw", 0.7, score="score"), "score"), 6)


@query(f"WITH {_LOOK} SELECT numero_employeur, count(*) n FROM (SELECT trim(numero_employeur) numero_employeur, k.secteur_activite_cod c FROM declarations LEFT JOIN k ON nullif(trim(numero_employeur), '') = k.e) WHERE c IS NULL GROUP BY 1")
def src20_unmatched(s, d):
    return refjoin.unmatched(joi01_exact_left(s, d), "numero_employeur", "secteur_activite_cod")


@query(f"WITH {_LOOK} SELECT ligne_id, k.secteur_activite_cod FROM declarations LEFT JOIN k ON nullif(trim(numero_employeur), '') = k.e")
def joi14_merge_all(s, d):
    x, _ = refjoin.merge_all(_decl(s, d).select("ligne_id", "numero_employeur"), [catalog.MergeSpec("secteurs", "secteurs_employeurs", "numero_employeur", "numero_employeur", keep=("secteur_activite_cod",))], lambda n: table(s, d, n))
    return x.select("ligne_id", "secteur_activite_cod")


# --- employer by month -----------------------------------------------------------------------------------------------

_FM = """m AS (SELECT numero_employeur, annee, mois, count(*) n_salaries, count(DISTINCT id_indiv) + max((id_indiv IS NULL)::INT) n_salaries_distincts, avg(salaire_brut) salaire_moyen, quantile_cont(salaire_brut, 0.5) salaire_median,
sum(salaire_brut) salaire_total, min(salaire_brut) salaire_min, max(salaire_brut) salaire_max, stddev_samp(salaire_brut) salaire_sd, arg_min(commune, ligne_id) FILTER (commune IS NOT NULL) commune, avg((sexe = 'F')::INT) pct_femmes
FROM declarations GROUP BY 1, 2, 3)"""
_PANEL = f"""{_FM}, g AS (SELECT * FROM (SELECT DISTINCT numero_employeur FROM m), (SELECT DISTINCT annee, mois FROM m)),
p AS (SELECT g.*, m.* EXCLUDE (numero_employeur, annee, mois), CASE WHEN m.n_salaries IS NULL THEN 0 ELSE 1 END d_jt, CASE WHEN salaire_moyen > -1 THEN ln(1 + salaire_moyen) END log_y_bar_jt FROM g LEFT JOIN m USING (numero_employeur, annee, mois))"""


def _months(s, d):
    return panel.firm_month(_decl(s, d), wage="salaire_brut", carried=["commune"])


@query(
    f"WITH {_FM} SELECT numero_employeur, annee, mois, n_salaries, n_salaries_distincts, round(salaire_moyen, 6) salaire_moyen, salaire_median, round(salaire_total, 2) salaire_total, salaire_min, salaire_max, round(salaire_sd, 3) salaire_sd, commune, round(pct_femmes, 6) pct_femmes FROM m"
)
def agg01_to_agg03_firm_month(s, d):
    m = _months(s, d).drop("log_y_bar_jt", "d_jt")
    n = {"pct_femmes": 6, "salaire_moyen": 6, "salaire_total": 2, "salaire_sd": 3}
    return m.select(*[F.round(c, n[c]).alias(c) if c in n else F.col(c) for c in m.columns])


@query(f"WITH {_PANEL} SELECT numero_employeur, annee, mois, n_salaries, d_jt FROM p")
def joi07_joi08_balanced_panel(s, d):
    return panel.balanced(_months(s, d)).select("numero_employeur", "annee", "mois", "n_salaries", "d_jt")


@query(
    f"""WITH {_PANEL} SELECT numero_employeur, annee, mois, d_jt, coalesce(last_value(commune IGNORE NULLS) OVER (PARTITION BY numero_employeur ORDER BY annee, mois), first_value(commune IGNORE NULLS) OVER (PARTITION BY numero_employeur ORDER BY annee, mois ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) commune,
lag(d_jt, 1) OVER w d_jt_lag1, lag(d_jt, 2) OVER w d_jt_lag2, coalesce(sum(d_jt) OVER q, 0)::BIGINT n_declarations_passees, (row_number() OVER w - 1)::INT n_periodes_passees, round(CASE WHEN row_number() OVER w > 1 THEN sum(d_jt) OVER q / (row_number() OVER w - 1) END, 6) pct_declarations_passees,
round(lag(log_y_bar_jt, 1) OVER w, 6) log_y_bar_jt_lag1, round(CASE WHEN count(n_salaries) OVER q = count(*) OVER q THEN avg(n_salaries) OVER q END, 6) effectif_moyen_passe FROM p
WINDOW w AS (PARTITION BY numero_employeur ORDER BY annee, mois), q AS (PARTITION BY numero_employeur ORDER BY annee, mois ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""
)
def win01_to_win05_panel_history(s, d):
    p = panel.panel(_decl(s, d), carried=["commune"], wage="salaire_brut")
    return rounded(p.select("numero_employeur", "annee", "mois", "d_jt", "commune", "d_jt_lag1", "d_jt_lag2", "n_declarations_passees", "n_periodes_passees", "pct_declarations_passees", "log_y_bar_jt_lag1", "effectif_moyen_passe"), 6)


@query(f"WITH {_PANEL} SELECT round(avg(d_jt), 6) rate, count(DISTINCT numero_employeur) n_firms, count(DISTINCT (annee, mois)) n_periods FROM p")
def agg26_declaration_rate(s, d):
    return rounded(panel.declaration_rate(panel.balanced(_months(s, d))), 6)


@query("SELECT b.ligne_id, p.n_salaries, p.secteur_activite_cod secteur_activite_cod_firm, p.d_jt FROM base_analytique b LEFT JOIN panel_employeur p USING (numero_employeur, annee, mois)")
def joi09_analytical_base(s, d):
    a = panel.analytical_base(table(s, d, "base_analytique"), table(s, d, "panel_employeur").drop("ligne_id", "period"))
    return a.select("ligne_id", "n_salaries", "secteur_activite_cod_firm", "d_jt")


@query("SELECT b.ligne_id, coalesce(p.w, b.w_jt, 1.0) w_jt FROM base_analytique b LEFT JOIN (SELECT numero_employeur, annee, mois, 1.0 + mois / 10.0 w FROM panel_employeur WHERE d_jt = 1) p USING (numero_employeur, annee, mois)")
def joi10_attach_weights(s, d):
    w = table(s, d, "panel_employeur").where("d_jt = 1").withColumn("w_jt", F.lit(1.0) + F.col("mois") / 10.0)
    return panel.attach_weights(table(s, d, "base_analytique"), w, ["numero_employeur", "annee", "mois"], "w_jt").select("ligne_id", "w_jt")


@query("SELECT * FROM (SELECT obs_id, ligne_id, numero_employeur, annee FROM base_analytique QUALIFY row_number() OVER (PARTITION BY obs_id ORDER BY ligne_id) = 1)")
def win08_keep_first(s, d):
    return clean.keep_first(table(s, d, "base_analytique").select("obs_id", "ligne_id", "numero_employeur", "annee"), ["obs_id"], ["ligne_id"])


# --- statistics ------------------------------------------------------------------------------------------------------

_OUT = "round(n_weighted, 6) n_weighted, round(mean, 4) mean, round(variance, -3) variance, min, max, q1, median, q3, p10, p90, round(gini, 6) gini"


def _stat_sql(keys: str, source: str, where: str = "", having: str = "") -> str:
    k = keys
    q = lambda p: f"(list(y ORDER BY a) FILTER (cw / nullif(tw, 0) >= {p} OR a = n))[1]"
    return f"""{source}, o AS (SELECT *, sum(w) OVER r cw, sum(w * y) OVER r cwy, sum(w) OVER g tw, sum(w * y) OVER g twy, row_number() OVER r a, count(*) OVER g n FROM (SELECT {k}, y::DOUBLE y, w::DOUBLE w, ligne_id FROM src {where})
WINDOW g AS (PARTITION BY {k}), r AS (PARTITION BY {k} ORDER BY y NULLS LAST, ligne_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
c AS (SELECT *, twy / nullif(tw, 0) mu, sum(w * w) OVER (PARTITION BY {k}, y) s2, sum(w) OVER (PARTITION BY {k}, y) bw, max(cwy) OVER (PARTITION BY {k}, y) ecwy, row_number() OVER (PARTITION BY {k}, y ORDER BY ligne_id) t FROM o),
e AS (SELECT {k}, count(*) n_obs, sum(w) n_weighted, max(mu) mean, sum(w * (y - mu) * (y - mu)) / nullif(max(tw), 0) variance, min(y) AS min, max(y) AS max, {q(0.25)} q1, {q(0.5)} median, {q(0.75)} q3, {q(0.1)} p10, {q(0.9)} p90,
CASE WHEN count(*) >= 2 AND count(y) = count(*) THEN 1 - 2 * sum(CASE WHEN t = 1 THEN bw * (ecwy - bw * y) + y * (bw * bw + s2) / 2 END) / nullif(max(tw) * max(twy), 0) END gini FROM c GROUP BY {k})
SELECT {k}, n_obs, {_OUT} FROM e {having}"""


def _round_stats(x: DataFrame) -> DataFrame:
    n = {"n_weighted": 6, "variance": -3, "gini": 6, "gini_standard": 6}
    return x.select(*[F.round(c, n.get(c, 4)).alias(c) if c in ("n_weighted", "mean", "variance", "gini", "gini_standard") else F.col(c) for c in x.columns])


@query(_stat_sql("secteur_activite_cod, annee, mois", f"WITH {_B}, src AS (SELECT * FROM b)"))
def agg04_to_agg10_group_statistics(s, d):
    return _round_stats(stats.group_statistics(_base(s, d), ["secteur_activite_cod", "annee", "mois"], "y", "w"))


_DIMS = [catalog.Dimension("global", None, "National", 1), catalog.Dimension("sector", "secteur_activite_cod", "Secteur"), catalog.Dimension("age_employe", "cl_red_age_employe", "Âge"), catalog.Dimension("sex", "sexe", "Sexe"), catalog.Dimension("commune", "commune", "Commune", 50)]
_SRC_DIMS = f"WITH {_B}, src AS (SELECT ligne_id, annee, mois, y, w, unnest([{{'dimension': 'global', 'group_value': 'Total'}}, {{'dimension': 'sector', 'group_value': secteur_activite_cod}}, {{'dimension': 'age_employe', 'group_value': cl_red_age_employe}}, {{'dimension': 'sex', 'group_value': sexe}}, {{'dimension': 'commune', 'group_value': commune}}], recursive := true) FROM b)"


def _dims(s, d):
    return stats.all_dimensions(_base(s, d), _DIMS, "y", "w")


@query(_stat_sql("dimension, group_value, annee, mois", _SRC_DIMS))
def agg11_all_dimensions(s, d):
    return _round_stats(_dims(s, d))


_LEAST = "CASE dimension WHEN 'global' THEN 0 WHEN 'commune' THEN 50 ELSE 30 END"


@query(_stat_sql("dimension, group_value, annee, mois", _SRC_DIMS, having=f"WHERE n_weighted >= {_LEAST}"))
def flt07_publishable_cells(s, d):
    return _round_stats(stats.publishable(_dims(s, d), _DIMS))


@query(_stat_sql("dimension, group_value, annee, mois", _SRC_DIMS, having="WHERE n_weighted >= 30"))
def flt08_suppressed_cells(s, d):
    return _round_stats(stats.suppress(_dims(s, d)))


@query(
    _stat_sql("dimension, group_value, annee, mois", _SRC_DIMS).replace("SELECT dimension, group_value, annee, mois, n_obs, " + _OUT, "SELECT count(*) n_cells, sum((n_weighted < 30)::INT)::BIGINT small_cells, sum((mean < 5e4 OR mean > 1e8)::INT)::BIGINT means_out_of_range, coalesce(sum((q1 > median OR median > q3)::INT), 0)::BIGINT quantiles_out_of_order")
)
def qc04_validate_estimates(s, d):
    return audit.validate_estimates(_dims(s, d))


@query(
    f"""WITH {_B}, f AS (SELECT * FROM b WHERE y IS NOT NULL AND secteur_activite_cod IS NOT NULL), q AS (SELECT secteur_activite_cod, annee, mois, quantile_cont(y, 0.01) lo, quantile_cont(y, 0.99) hi FROM f GROUP BY ALL)
SELECT ligne_id, round(greatest(lo, least(hi, y)), 4) y FROM f JOIN q USING (secteur_activite_cod, annee, mois)"""
)
def win07_winsorise(s, d):
    b = _base(s, d).dropna(subset=["y", "secteur_activite_cod"])
    return rounded(stats.winsorise(b, ["secteur_activite_cod", "annee", "mois"], "y").select("ligne_id", "y"))


_REP = f"""WITH {_B}, f AS (SELECT * FROM b WHERE y IS NOT NULL AND sexe IS NOT NULL), z AS (SELECT sexe, annee, mois, quantile_cont(y, 0.01) lo, quantile_cont(y, 0.99) hi FROM f GROUP BY ALL),
src AS (SELECT ligne_id, f.sexe groupe, annee, mois, greatest(lo, least(hi, y)) y, w FROM f JOIN z USING (sexe, annee, mois))"""


def _report_sql(tail: str) -> str:
    return _stat_sql("groupe, annee, mois", _REP).rsplit("SELECT groupe", 1)[0] + tail


_LONG = ", ".join(f"{{'statistique': '{n}', 'valeur': {c}::DOUBLE}}" for n, c in (("N", "n_obs"), ("N_weighted", "n_weighted"), ("Min", "min"), ("Q1", "q1"), ("Mediane", "median"), ("Moyenne", "mean"), ("Q3", "q3"), ("Max", "max")))


@query(_report_sql(f"SELECT groupe, annee, mois, statistique, round(valeur, 3) valeur FROM (SELECT groupe, annee, mois, unnest([{_LONG}], recursive := true) FROM e)"))
def agg12_rsh06_report(s, d):
    return rounded(stats.report(_base(s, d), "sexe", "y", "w"), 3)


@query(
    _report_sql(
        "SELECT groupe, statistique, "
        + ", ".join(f"round(max(valeur) FILTER (annee = {m[:4]} AND mois = {int(m[5:])}), 3) \"{m[:4]}_{int(m[5:])}\"" for m in MONTHS)
        + f" FROM (SELECT groupe, annee, mois, unnest([{_LONG}], recursive := true) FROM e) GROUP BY ALL"
    )
)
def rsh07_srt05_report_table(s, d):
    return rounded(stats.report_table(stats.report(_base(s, d), "sexe", "y", "w"), [(int(m[:4]), int(m[5:])) for m in MONTHS]), 3)


@query("SELECT ligne_id, w_jt * w_ijt w_final, round(w_jt * w_ijt / sum(w_jt * w_ijt) OVER (PARTITION BY annee, mois) * count(*) OVER (PARTITION BY annee, mois), 6) w_normalized FROM base_analytique")
def win06_normalised_weights(s, d):
    return rounded(stats.final_weights(table(s, d, "base_analytique").drop("w_final")).select("ligne_id", "w_final", "w_normalized"), 6, ["w_final"])


_Z = mathx.normal_quantile(0.975)


@query(
    f"""WITH {_B}, f AS (SELECT *, sum(w * y) OVER g / sum(w) OVER g mu FROM (SELECT secteur_activite_cod, y, w::DOUBLE w FROM b WHERE y IS NOT NULL) WINDOW g AS (PARTITION BY secteur_activite_cod)),
e AS (SELECT secteur_activite_cod, count(*) n, sum(w) sum_w, max(mu) mean, sqrt(sum(w * w * (y - mu) * (y - mu)) / (sum(w) * sum(w)) * CASE WHEN count(*) > 1 THEN count(*) / (count(*) - 1) ELSE 1 END) se FROM f GROUP BY 1)
SELECT secteur_activite_cod, n, round(sum_w, 4) sum_w, round(mean, 4) mean, round(se, 4) se, round(mean - {_Z!r} * se, 3) ci_lower, round(mean + {_Z!r} * se, 3) ci_upper FROM e"""
)
def agg13_mean_with_variance(s, d):
    m = intervals.mean_with_variance(_base(s, d), ["secteur_activite_cod"], "y", "w").drop("variance")
    return m.select(*[F.round(c, 3 if c.startswith("ci") else 4).alias(c) if t == "double" else F.col(c) for c, t in m.dtypes])


@query()
def agg14_bootstrap_quantiles(s, d):
    return intervals.bootstrap_quantiles(_base(s, d), ["secteur_activite_cod", "annee"], "y", "w", {"q1": 0.25, "median": 0.5, "q3": 0.75})


@query(
    f"""WITH {_B}, r AS (SELECT commune, y, row_number() OVER (PARTITION BY commune ORDER BY y) a, row_number() OVER (PARTITION BY commune ORDER BY y DESC) z FROM b WHERE y IS NOT NULL)
SELECT commune, min(y) AS min, max(y) FILTER (a <= 5) - min(y) FILTER (a <= 5) min_range, max(y) AS max, max(y) FILTER (z <= 5) - min(y) FILTER (z <= 5) max_range FROM r GROUP BY 1"""
)
def agg15_extremes(s, d):
    return intervals.extremes(_base(s, d), ["commune"], "y")


@query()
def agg16_statistics_with_intervals(s, d):
    return intervals.with_intervals(_base(s, d), ["sexe", "annee", "mois"], "y", "w")


def _imputed(s, d):
    """Five deterministic imputations: y (1 + m / 100)."""
    b = _base(s, d).withColumn("imputation_id", F.explode(F.sequence(F.lit(1), F.lit(5))))
    return b.withColumn("y", F.col("y") * (1 + F.col("imputation_id") / 100))


_IMP = f"WITH {_B}, i AS (SELECT b.* REPLACE (y * (1 + m / 100) AS y), m FROM b, range(1, 6) t(m))"


@query(
    f"{_IMP}, e AS (SELECT sexe, m, avg(y) est, var_samp(y) / count(y) v FROM i GROUP BY ALL) SELECT sexe, count(est) m, round(avg(est), 4) estimate, round(avg(v), 2) AS \"within\", round(var_samp(est), 2) AS \"between\", round(avg(v) + (1 + 1 / count(est)) * var_samp(est), 2) variance FROM e GROUP BY 1"
)
def agg17_rubin(s, d):
    e = _imputed(s, d).groupBy("sexe", "imputation_id").agg(F.avg("y").alias("est"), (F.var_samp("y") / F.count("y")).alias("v"))
    r = intervals.rubin(e, ["sexe"], "est", "v").drop("se")
    return r.select(*[F.round(c, 4 if c == "estimate" else 2).alias(c) if t == "double" else F.col(c) for c, t in r.dtypes])


@query()
def agg18_rubin_extended(s, d):
    e = _imputed(s, d).groupBy("secteur_activite_cod", "annee", "imputation_id").agg(F.avg("y").alias("est"), (F.var_samp("y") / F.count("y")).alias("v"))
    return intervals.rubin_extended(e, ["secteur_activite_cod", "annee"], "est", "v")


@query(
    f"""{_IMP}, e AS (SELECT secteur_activite_cod, annee, m, avg(y) est, var_samp(y) / count(y) v FROM i GROUP BY ALL), r AS (SELECT secteur_activite_cod, annee, count(est) m, avg(est) e, avg(v) w, coalesce(var_samp(est), 0) b FROM e GROUP BY ALL),
t AS (SELECT *, w + (1 + 1 / m) * b t FROM r), l AS (SELECT *, CASE WHEN t <> 0 THEN (1 + 1 / m) * b / t END l FROM t)
SELECT secteur_activite_cod, annee, m, round(e, 3) estimate, round(w, 1) AS "within", round(b, 1) AS "between", round(t, 1) variance, round(l, 6) part, CASE WHEN b > 0 THEN round((m - 1) / (l * l), 3) END df FROM l"""
)
def agg18_rubin_figures(s, d):
    """The extended combination without the Student interval."""
    x = agg18_rubin_extended(s, d)
    return x.select("secteur_activite_cod", "annee", "m", F.round("estimate", 3).alias("estimate"), *[F.round(c, 1).alias(c) for c in ("within", "between", "variance")], F.round("lambda", 6).alias("part"), F.round("df", 3).alias("df"))


@query(
    f"""{_IMP}, l AS (SELECT annee, mois, m, y, w, unnest([{{'d': 'global', 'g': 'Total'}}, {{'d': 'sector', 'g': secteur_activite_cod}}, {{'d': 'age_employe', 'g': cl_red_age_employe}}, {{'d': 'sex', 'g': sexe}}, {{'d': 'commune', 'g': commune}}], recursive := true) FROM i),
e AS (SELECT d, g, annee, mois, m, sum(w * y)::DOUBLE / sum(w)::DOUBLE mean, max(y) mx FROM l GROUP BY ALL) SELECT d dimension, g group_value, annee, mois, statistique, count(v) m, round(avg(v), 3) estimate, round(coalesce(var_samp(v), CASE WHEN count(v) >= 1 THEN 0 END), 1) variance FROM (SELECT d, g, annee, mois, unnest([{{'statistique': 'mean', 'v': mean}}, {{'statistique': 'max', 'v': mx}}], recursive := true) FROM e) WHERE v IS NOT NULL GROUP BY ALL"""
)
def agg19_combine_dimensions(s, d):
    x = stats.all_dimensions(_imputed(s, d), _DIMS, "y", "w", extra=["imputation_id"])
    c = intervals.combine_dimensions(x, ["mean", "max"], ["dimension", "group_value", "annee", "mois"])
    return c.select("dimension", "group_value", "annee", "mois", "statistique", "m", F.round("estimate", 3).alias("estimate"), F.round("variance", 1).alias("variance"))


# --- audits ----------------------------------------------------------------------------------------------------------


@query("SELECT csp_code AS value, count(*) n, round(count(*) * 100 / sum(count(*)) OVER (), 6) pct FROM declarations GROUP BY 1")
def agg20_distribution(s, d):
    return rounded(audit.distribution(_decl(s, d), "csp_code"), 6)


#: Every column of declarations.
_PROFILED = [
    "ligne_id", "id_indiv", "numero_employeur", "sexe", "type_salarie", "situation_matrimoniale", "niveau_etude", "profession", "statut_travailleur", "csp_code", "prof_code", "date_naissance", "date_embauche",
    "date_immatriculation", "date_immat_employeur", "date_debut_act_employ", "raison_sociale", "secteur_activite", "commune", "libelle_agence", "categorie_entreprise", "effectif_salaries", "salaire_brut",
    "duree_travaillee", "mois", "annee", "recu_le",
]


@query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) n, count(*) - count({c}) missing, round((count(*) - count({c})) * 100.0 / count(*), 6) pct_missing FROM declarations" for c in _PROFILED))
def agg21_rsh08_fill_profile(s, d):
    return rounded(audit.fill_profile(_decl(s, d)), 6)


@query("WITH u AS (SELECT DISTINCT * EXCLUDE (ligne_id, recu_le) FROM declarations), a AS (SELECT count(*) n FROM declarations), b AS (SELECT count(*) n_distinct FROM u) SELECT n, n_distinct, n - n_distinct duplicates FROM a, b")
def agg22_set02_duplicates(s, d):
    return audit.duplicate_rows(_decl(s, d).drop("ligne_id", "recu_le"))


@query("SELECT count(DISTINCT id_indiv) nb_unique, count(*) - count(DISTINCT id_indiv) - max((id_indiv IS NULL)::INT) nb_doublons FROM declarations")
def agg23_key_uniqueness(s, d):
    return audit.key_uniqueness(_decl(s, d), "id_indiv")


@query(
    """WITH u AS (SELECT DISTINCT id_indiv, numero_employeur, annee, mois, type_salarie, salaire_brut, duree_travaillee FROM declarations), l AS (SELECT type_salarie, unnest([{'column': 'salaire_brut', 'v': salaire_brut}, {'column': 'duree_travaillee', 'v': duree_travaillee}], recursive := true) FROM u),
q AS (SELECT type_salarie, "column", quantile_cont(v, 0.25) q1, quantile_cont(v, 0.75) q3, count(*) n FROM l GROUP BY ALL),
o AS (SELECT q.type_salarie, q."column", count(*) FILTER (v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) outliers FROM q JOIN l ON q.type_salarie IS NOT DISTINCT FROM l.type_salarie AND q."column" = l."column" GROUP BY q.type_salarie, q."column")
SELECT q.type_salarie, q."column", round(q1, 4) q1, round(q3, 4) q3, round(q1 - 1.5 * (q3 - q1), 4) lower, round(q3 + 1.5 * (q3 - q1), 4) upper, n, outliers, round(outliers * 100.0 / n, 6) pct FROM q JOIN o ON q.type_salarie IS NOT DISTINCT FROM o.type_salarie AND q."column" = o."column"
"""
)
def agg24_outliers(s, d):
    x = _decl(s, d).select("id_indiv", "numero_employeur", "annee", "mois", "type_salarie", "salaire_brut", "duree_travaillee")
    o = audit.outliers(x, ["salaire_brut", "duree_travaillee"], by=["type_salarie"])
    return o.select(*[F.round(c, 6 if c == "pct" else 4).alias(c) if t == "double" else F.col(c) for c, t in o.dtypes])


@query("SELECT min(salaire_brut) AS min, round(quantile_cont(salaire_brut, 0.25), 4) q1, round(quantile_cont(salaire_brut, 0.5), 4) median, round(avg(salaire_brut), 2) mean, round(quantile_cont(salaire_brut, 0.75), 4) q3, max(salaire_brut) AS max, count(DISTINCT id_indiv) n_id_indiv FROM declarations")
def agg27_summary(s, d):
    x = audit.summary(_decl(s, d), "salaire_brut", ["id_indiv"])
    return x.select("min", F.round("q1", 4).alias("q1"), F.round("median", 4).alias("median"), F.round("mean", 2).alias("mean"), F.round("q3", 4).alias("q3"), "max", "n_id_indiv")


_QC1 = ", ".join(f"sum((annee - year({src}) < 0)::INT)::BIGINT {n}_negative" for n, src in _AGES)


@query(f"SELECT count(*) n, {_QC1}, coalesce(sum((annee - year(date_naissance) > 100)::INT), 0)::BIGINT age_above_100, coalesce(sum((annee - year(date_embauche) > annee - year(date_naissance))::INT), 0)::BIGINT tenure_above_age FROM declarations")
def qc01_derived_checks(s, d):
    return audit.check_derived(clean.derive(_decl(s, d)))


@query(" UNION ALL ".join(f"SELECT '{c}' dimension, count(DISTINCT {c}) n_distinct, round(avg(({c} IS NULL)::INT) * 100, 6) pct_missing FROM base_analytique" for c in ("secteur_activite_cod", "sexe", "commune", "cl_red_age_employe")))
def qc05_dimension_availability(s, d):
    return rounded(audit.dimension_availability(table(s, d, "base_analytique"), ["secteur_activite_cod", "sexe", "commune", "cl_red_age_employe"]), 6)


@query(f"WITH {_B} SELECT count(*) n, count(*) - count(DISTINCT obs_id) repeated, sum((y IS NULL)::INT)::BIGINT wage_missing, coalesce(sum((y = 0)::INT), 0)::BIGINT wage_zero, coalesce(sum((y < 0)::INT), 0)::BIGINT wage_negative FROM b")
def qc07_base_checks(s, d):
    return audit.base_checks(_base(s, d), wage="y")


# --- sorting, sets, reshaping ----------------------------------------------------------------------------------------


@query("SELECT min((annee, mois))[1] AS first_annee, min((annee, mois))[2] AS first_mois, max((annee, mois))[1] AS last_annee, max((annee, mois))[2] AS last_mois, printf('%02d_%04d-%02d_%04d', min((annee, mois))[2], min((annee, mois))[1], max((annee, mois))[2], max((annee, mois))[1]) \"range\" FROM declarations")
def srt02_src14_period_range(s, d):
    return audit.period_range(_decl(s, d))


@query("SELECT profession, count(*) n FROM declarations GROUP BY 1 ORDER BY n DESC, profession NULLS FIRST LIMIT 15")
def srt03_top_by_frequency(s, d):
    return audit.top_values(_decl(s, d), "profession")


@query(
    "SELECT DISTINCT * FROM (SELECT 1 f, id_indiv, numero_employeur, sexe, NULL::DOUBLE salaire_brut FROM base_analytique) UNION ALL SELECT DISTINCT * FROM (SELECT 2 f, id_indiv, numero_employeur, NULL sexe, salaire_brut FROM declarations)"
)
def set01_set02_union_by_name(s, d):
    a = table(s, d, "base_analytique").select(F.lit(1).alias("f"), "id_indiv", "numero_employeur", "sexe")
    b = _decl(s, d).select(F.lit(2).alias("f"), "id_indiv", "numero_employeur", "salaire_brut")
    return clean.union_files([a, b], "file")


@query("SELECT DISTINCT annee, mois, libelle_agence FROM declarations")
def set04_distinct_pairs(s, d):
    return _decl(s, d).select("annee", "mois", "libelle_agence").distinct()


@query(
    "WITH l AS (SELECT * FROM base_analytique QUALIFY row_number() OVER (PARTITION BY id_indiv, period ORDER BY ligne_id DESC) = 1) SELECT id_indiv, "
    + ", ".join(f"max(CASE WHEN period = '{m}' THEN {v} END) {v}_t{m}" for m in MONTHS for v in ("age_employe", "sexe"))
    + " FROM l GROUP BY 1"
)
def rsh01_win09_wide_panel(s, d):
    b = table(s, d, "base_analytique")
    return reshape.wide_panel(b, "id_indiv", "period", ["age_employe", "sexe"], MONTHS, ["ligne_id"])


@query("SELECT id_indiv, numero_employeur FROM base_analytique QUALIFY row_number() OVER (PARTITION BY id_indiv ORDER BY period, ligne_id) = 1")
def rsh02_invariants(s, d):
    b = table(s, d, "base_analytique").select("id_indiv", "period", "ligne_id", "numero_employeur")
    return clean.keep_first(b, ["id_indiv"], ["period", "ligne_id"]).select("id_indiv", "numero_employeur")


_LAST = f"{_B}, l AS (SELECT id_indiv, period, y, secteur_activite_cod c, annee * 12 + mois i FROM b QUALIFY row_number() OVER (PARTITION BY id_indiv, period ORDER BY ligne_id DESC) = 1)"


@query(
    f"""WITH {_LAST}, k AS (SELECT *, lag(y) OVER w p, lag(i) OVER w j FROM l WINDOW w AS (PARTITION BY id_indiv ORDER BY period)), e AS (SELECT id_indiv, max(y) FILTER (period = '2024_01') a, max(y) FILTER (period = '2025_06') z, avg(y) m, min(y) lo, max(y) hi, count(y) n, coalesce(sum((y <> p AND j = i - 1)::INT), 0)::BIGINT ch FROM k GROUP BY 1)
SELECT id_indiv, round(z - a, 6) y_change, round((z - a) / nullif(a, 0) * 100, 6) y_growth_pct, round(m, 6) y_mean, lo y_min, hi y_max, ch y_n_changes, n y_n_obs FROM e"""
)
def rsh03_rsh05_numeric_dynamics(s, d):
    return rounded(reshape.numeric_dynamics(_base(s, d), "id_indiv", "period", "y", MONTHS, ["ligne_id"]), 6)


@query(
    f"""WITH {_LAST}, n AS (SELECT id_indiv, c, count(*) k FROM l WHERE c IS NOT NULL GROUP BY ALL), m AS (SELECT id_indiv, c FROM n QUALIFY row_number() OVER (PARTITION BY id_indiv ORDER BY k DESC, c) = 1),
e AS (SELECT id_indiv, max(c) FILTER (period = '2024_01') a, max(c) FILTER (period = '2025_06') z, count(c) n FROM l GROUP BY 1) SELECT id_indiv, a secteur_activite_cod_first, z secteur_activite_cod_last, a <> z secteur_activite_cod_changed, n secteur_activite_cod_n_obs, m.c secteur_activite_cod_mode FROM e LEFT JOIN m USING (id_indiv)"""
)
def rsh04_categorical_dynamics(s, d):
    return reshape.categorical_dynamics(table(s, d, "base_analytique"), "id_indiv", "period", "secteur_activite_cod", MONTHS, ["ligne_id"])


# --- functions -------------------------------------------------------------------------------------------------------


@query(f"SELECT DISTINCT raison_sociale, {_PREP.format('raison_sociale')} prepared FROM declarations")
def str01_to_str03_prepare(s, d):
    return _decl(s, d).select("raison_sociale").distinct().withColumn("prepared", text.prepare(F.col("raison_sociale")))


_PAIRS = "SELECT n.n_name a, r.r_name || n.n_name b FROM nation n JOIN region r ON n_regionkey = r_regionkey UNION ALL SELECT c_name, replace(c_name, '0', 'O') FROM customer"


def _pairs(s, d):
    n, r, c = table(s, d, "nation"), table(s, d, "region"), table(s, d, "customer")
    x = n.join(r, n.n_regionkey == r.r_regionkey).select(F.col("n_name").alias("a"), F.concat("r_name", "n_name").alias("b"))
    return x.unionByName(c.select(F.col("c_name").alias("a"), F.replace("c_name", F.lit("0"), F.lit("O")).alias("b")))


_G = "list_transform(range(1, length({0})), lambda i: substring({0}, i, 2))"


@query(
    f"""SELECT a, b, round(jaro_similarity(a, b), 6) jw, round(1 - levenshtein(a, b) / greatest(length(a), length(b)), 6) lv, round(1 - damerau_levenshtein(a, b) / greatest(length(a), length(b)), 6) dl, round(CASE WHEN length(a) <> length(b) THEN 0 ELSE 1 - hamming(a, b) / length(a) END, 6) hamming,
round(len(list_intersect({_G.format('a')}, {_G.format('b')})) / len(list_distinct(list_concat({_G.format('a')}, {_G.format('b')}))), 6) jaccard FROM ({_PAIRS})"""
)
def str04_to_str07_similarities(s, d):
    p = _pairs(s, d)
    return rounded(p.select("a", "b", *[similarity.similarity(m, F.col("a"), F.col("b")).alias(m) for m in ("jw", "lv", "dl", "hamming", "jaccard")]), 6)


_COUNTS = "(SELECT i, g, count(*) n FROM (SELECT i, unnest({}) g FROM p) GROUP BY ALL)"


@query(
    f"""WITH p AS (SELECT row_number() OVER () i, a, b FROM ({_PAIRS})), x AS {_COUNTS.format(_G.format('a'))}, y AS {_COUNTS.format(_G.format('b'))},
j AS (SELECT i, coalesce(x.n, 0) u, coalesce(y.n, 0) v FROM x FULL JOIN y USING (i, g)), q AS (SELECT i, sum(abs(u - v)) d, sum(u * v) / sqrt(sum(u * u) * sum(v * v)) c FROM j GROUP BY i)
SELECT a, b, round(1 - damerau_levenshtein(a, b) / greatest(length(a), length(b)), 6) osa, round(greatest(0, 1 - d / greatest(length(a), length(b))), 6) qgram, round(c, 6) cosine FROM p JOIN q USING (i)"""
)
def str06_str07_more_similarities(s, d):
    """In these pairs no part is edited twice, so that both kinds of swaps agree."""
    p = _pairs(s, d)
    return rounded(p.select("a", "b", *[similarity.similarity(m, F.col("a"), F.col("b")).alias(m) for m in ("osa", "qgram", "cosine")]), 6)


@query()
def str06_lcs(s, d):
    return _pairs(s, d).select("a", "b", similarity.similarity("lcs", F.col("a"), F.col("b")).alias("lcs"))


@query(
    """SELECT ligne_id, strptime(strftime(date_naissance, '%d/%m/%Y'), '%d/%m/%Y') a, strptime(strftime(date_naissance, '%Y-%m-%d'), '%Y-%m-%d') b, CASE WHEN n > 0 AND n < 100000 THEN date_trunc('day', date_naissance) END c, date_trunc('day', date_naissance) e
FROM (SELECT *, date_diff('day', DATE '1899-12-30', date_naissance::DATE) n FROM declarations)"""
)
def dat01_to_dat03_moments(s, d):
    x = _decl(s, d)
    day = F.col("date_naissance")
    serial = F.datediff(day, F.lit("1899-12-30").cast("date"))
    as_text = lambda c: dates.to_moment(c)
    out = x.select("ligne_id", as_text(F.date_format(day, "dd/MM/yyyy")).alias("a"), as_text(F.date_format(day, "yyyy-MM-dd")).alias("b"), as_text(F.concat(serial.cast("string"), F.lit(".7"))).alias("c"), as_text(F.date_format(day, "yyyyMMdd")).alias("e"))
    return out.select("ligne_id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in "abce"])


@query(
    "SELECT fichier, CASE WHEN fichier[1:2]::INT BETWEEN 1 AND 12 THEN fichier[1:2]::INT END mois, fichier[4:7]::INT annee, fichier[4:7]::INT * 12 + fichier[1:2]::INT numero FROM (SELECT DISTINCT fichier FROM lignes_brutes)"
)
def src12_src13_dat06_file_period(s, d):
    m, a = dates.period_of_file(F.col("fichier"))
    return table(s, d, "lignes_brutes").select("fichier").distinct().select("fichier", m.alias("mois"), a.alias("annee"), dates.number_of_period(a, m).alias("numero"))


@query(
    "SELECT p_partkey, CASE WHEN p_size >= 20 THEN 'Plus de 20 ans' WHEN p_size >= 10 THEN '10-20 ans' WHEN p_size >= 5 THEN '5-10 ans' WHEN p_size >= 3 THEN '3-5 ans' WHEN p_size >= 1 THEN '1-3 ans' WHEN p_size >= 0 THEN 'Moins de 1 an' END tenure, CASE WHEN p_size BETWEEN 1 AND 20 THEN 'TPE' WHEN p_size BETWEEN 21 AND 100 THEN 'PE' END AS size_group, round_even(p_retailprice, 0) half_even FROM part"
)
def bin05_bin06_mth02_classes(s, d):
    return table(s, d, "part").select("p_partkey", bins.cut("p_size", *bins.TENURE).alias("tenure"), bins.size_group(bins.code("p_size", bins.SIZE)).alias("size_group"), F.bround("p_retailprice", 0).alias("half_even"))


# --- models ----------------------------------------------------------------------------------------------------------

#: A deterministic probability per employer-month, with nulls.
_P = "p AS (SELECT ligne_id, numero_employeur, annee, mois, d_jt, CASE WHEN mois % 11 <> 0 THEN (ligne_id * 37 % 997 + CASE WHEN d_jt = 1 THEN 200 ELSE 0 END) / 1200.0::DOUBLE END pr FROM panel_employeur WHERE d_jt IN (0, 1))"


def _prob(s, d):
    x = table(s, d, "panel_employeur").where(F.col("d_jt").isin(0, 1))
    pr = (F.col("ligne_id") * 37 % 997 + F.when(F.col("d_jt") == 1, 200).otherwise(0)) / F.lit(1200.0)
    return x.select("ligne_id", "numero_employeur", "annee", "mois", "d_jt", F.when(F.col("mois") % 11 != 0, pr).alias("pr"))


@query(
    f"""WITH {_P}, a AS (SELECT *, greatest(coalesce(pr, avg(pr) OVER ()), 0.01) q, avg(coalesce(pr, (SELECT avg(pr) FROM p))) OVER () top FROM p), r AS (SELECT *, top / q raw FROM a)
SELECT ligne_id, round(greatest((SELECT quantile_cont(raw, 0.01) FROM r), least((SELECT quantile_cont(raw, 0.99) FROM r), raw)), 6) w_jt FROM r"""
)
def mod02_inverse_weights(s, d):
    return rounded(models.inverse_weights(_prob(s, d), "pr").select("ligne_id", "w_jt"), 6)


@query(
    f"""WITH {_P}, a AS (SELECT *, greatest(coalesce(pr, avg(pr) OVER ()), 0.01) q FROM p), r AS (SELECT *, avg(q) OVER () / q raw FROM a)
SELECT ligne_id, round(greatest((SELECT quantile_cont(raw, 0.01) FROM r), least((SELECT quantile_cont(raw, 0.99) FROM r), raw)), 6) w_ijt FROM r"""
)
def mod03_mod11_inverse_weights_after(s, d):
    return rounded(models.inverse_weights(_prob(s, d), "pr", "w_ijt", marginal="after").select("ligne_id", "w_ijt"), 6)


@query(
    f"WITH {_P}, k AS (SELECT d_jt, rank() OVER (ORDER BY pr) + (count(*) OVER (PARTITION BY pr) - 1) / 2 r FROM p WHERE pr IS NOT NULL), a AS (SELECT (sum(r) FILTER (d_jt = 1) - count(*) FILTER (d_jt = 1) * (count(*) FILTER (d_jt = 1) + 1) / 2) / (count(*) FILTER (d_jt = 1) * count(*) FILTER (d_jt = 0)) v, count(*) FILTER (d_jt = 1) n_pos, count(*) FILTER (d_jt = 0) n_neg FROM k) SELECT round(greatest(v, 1 - v), 6) auc, n_pos, n_neg FROM a"
)
def mod04_win12_auc(s, d):
    return rounded(models.auc(_prob(s, d), "pr", "d_jt"), 6)


@query(
    f"WITH {_P}, c AS (SELECT list_distinct(quantile_cont(pr, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) q FROM p) SELECT (len(list_filter(q, lambda x: x < pr)) + 1)::INT AS bin, count(*) n, round(avg(pr), 6) mean_score, round(avg(d_jt), 6) mean_outcome FROM p, c WHERE pr IS NOT NULL GROUP BY 1"
)
def mod05_calibration(s, d):
    return rounded(models.calibration(_prob(s, d), "pr", "d_jt"), 6)


@query(
    f"WITH {_P}, c AS (SELECT list_distinct(quantile_cont(pr, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) q FROM p), b AS (SELECT len(list_filter(q, lambda x: x < pr)) k, avg(pr) x, avg(d_jt) y FROM p, c WHERE pr IS NOT NULL GROUP BY 1) SELECT round(regr_slope(y, x), 6) slope, round(regr_intercept(y, x), 6) intercept FROM b"
)
def mod05_calibration_line(s, d):
    return rounded(models.calibration_line(models.calibration(_prob(s, d), "pr", "d_jt")), 6)


@query(
    f"WITH {_P}, t AS (SELECT unnest([0.3, 0.4, 0.5, 0.6, 0.7])::DOUBLE threshold), c AS (SELECT threshold, count(*) FILTER (pr >= threshold AND d_jt = 1) tp, count(*) FILTER (pr >= threshold AND d_jt = 0) fp, count(*) FILTER (pr < threshold AND d_jt = 0) tn, count(*) FILTER (pr < threshold AND d_jt = 1) fn FROM p, t WHERE pr IS NOT NULL GROUP BY 1) SELECT *, round((tp + tn) / (tp + fp + tn + fn), 6) accuracy, round(tp / (tp + fn), 6) sensitivity, round(tn / (tn + fp), 6) specificity FROM c"
)
def mod06_confusion(s, d):
    return rounded(models.confusion(_prob(s, d), "pr", "d_jt"), 6, ["threshold"])


@query(f"WITH {_P} SELECT round(avg((pr - d_jt) * (pr - d_jt)), 6) brier FROM p")
def mod06_brier(s, d):
    return rounded(models.brier(_prob(s, d), "pr", "d_jt"), 6)


def _history(s, d):
    p = panel.with_flag(table(s, d, "panel_employeur"))
    h = panel.history(p).withColumn("section", F.coalesce(F.substring("secteur_activite_cod", 1, 1), F.lit("?")))
    return materialise(h, "model-history")


_SPEC = catalog.ModelSpec("declaration_firm", "logit", "d_jt", ("section", "d_jt_lag1", "n_declarations_passees", "pct_declarations_passees", "mois", "secteur_inconnu"))
_LINE = catalog.ModelSpec("imputation_firm_salary", "linear", "log_y_bar_jt", ("section", "log_y_bar_jt_lag1", "mois"))


@query()
def mod01_logit_weights(s, d):
    h = _history(s, d)
    m = models.fit_logit(h, _SPEC)
    p = materialise(models.predict(h, m, "pi_jt"), "model-probabilities")
    return models.inverse_weights(p, "pi_jt").select("ligne_id", "d_jt", "pi_jt", "w_jt")


@query()
def mod07_mod08_imputation(s, d):
    h = _history(s, d)
    return models.impute(h, models.fit_linear(h, _LINE), ["ligne_id"]).select("ligne_id", "imputation_id", "log_imputed", "imputed")


@query()
def mod09_regression_diagnostics(s, d):
    h = _history(s, d)
    m = models.fit_linear(h, _LINE)
    r = models.residual_statistics(h, m)
    names = ["mean", "sd", "min", "max", "q25", "q75"]
    rows = r.unpivot([], names, "figure", "value").select(F.concat(F.lit("residual_"), "figure").alias("figure"), "value")
    return s.createDataFrame(sorted(m.figures.items()), "figure string, value double").unionByName(rows)


@query("SELECT ligne_id, 1.0::DOUBLE rho FROM base_analytique")
def mod10_degenerate_response(s, d):
    b = table(s, d, "base_analytique").withColumn("R_ijt", F.lit(1))
    return models.predict(b, models.fit_logit(b, catalog.MODELS[2]), "rho").select("ligne_id", "rho")


@query()
def mod12_individual_imputation(s, d):
    b = _base(s, d).withColumn("log_y_ijt", F.log1p("y")).withColumn("section", F.coalesce(F.substring("secteur_activite_cod", 1, 1), F.lit("?")))
    m = models.fit_linear(b, catalog.ModelSpec("individual", "linear", "log_y_ijt", ("section", "sexe", "age_employe")))
    return models.impute(b.where("y IS NULL"), m, ["ligne_id"]).select("ligne_id", "imputation_id", "imputed")


_GAP = "p AS (SELECT numero_employeur, annee, mois, m imputation_id, 200000.0 + m * 1000 + mois imputed FROM panel_employeur, range(1, 4) t(m) WHERE d_jt = 0)"


@query(
    f"""WITH {_B}, {_GAP}, s AS (SELECT b.numero_employeur, annee, mois, m imputation_id, ligne_id, y FROM b, range(1, 4) t(m))
SELECT s.ligne_id, s.imputation_id, coalesce(s.y, p.imputed) y FROM s LEFT JOIN p USING (numero_employeur, annee, mois, imputation_id)
UNION ALL SELECT NULL, imputation_id, imputed FROM p ANTI JOIN b USING (numero_employeur, annee, mois)"""
)
def joi11_stack_imputations(s, d):
    p = table(s, d, "panel_employeur").where("d_jt = 0").withColumn("imputation_id", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    imp = p.select("numero_employeur", "annee", "mois", "imputation_id", (F.lit(200000.0) + F.col("imputation_id") * 1000 + F.col("mois")).alias("imputed"))
    return models.stack_imputations(_base(s, d), imp, ["numero_employeur", "annee", "mois"], "y").select("ligne_id", "imputation_id", "y")


@query(
    """WITH a AS (SELECT sexe, avg(age_employe) m, count(*)::DOUBLE n FROM base_analytique WHERE annee = 2024 GROUP BY 1), z AS (SELECT sexe, avg(age_employe) m, count(*)::DOUBLE n FROM base_analytique WHERE annee = 2025 GROUP BY 1),
l AS (SELECT z.sexe, unnest([{'statistique': 'm', 'ancien': a.m, 'nouveau': z.m}, {'statistique': 'n', 'ancien': a.n, 'nouveau': z.n}], recursive := true) FROM z JOIN a ON a.sexe = z.sexe) SELECT sexe, statistique, round(nouveau, 6) nouveau, round(ancien, 6) ancien, round(nouveau - ancien, 6) ecart, round((nouveau - ancien) / ancien * 100, 6) ecart_pct FROM l"""
)
def joi12_compare_runs(s, d):
    b = table(s, d, "base_analytique")
    one = lambda y: b.where(F.col("annee") == y).groupBy("sexe").agg(F.avg("age_employe").alias("m"), F.count("*").cast("double").alias("n"))
    return rounded(refjoin.compare_runs(one(2024), one(2025), ["sexe"], ["m", "n"]), 6)


# --- further column and set operations -------------------------------------------------------------------------------


@query("SELECT ligne_id, numero_employeur AS employeur, mois, annee FROM declarations")
def prj02_to_prj06_columns(s, d):
    x = _decl(s, d).withColumns({"tmp_a": F.lit(1), "tmp_b": F.lit(2)})
    x = clean.drop_prefixed(clean.keep_columns(x, ["mois", "annee", "tmp_a", "tmp_b", "absent"], ["ligne_id", "numero_employeur"]), "tmp_")
    x = x.drop("absent").withColumnsRenamed({"numero_employeur": "employeur", "absent": "x"})
    return x.select(*reshape.order_columns(x.columns, [], ["ligne_id", "employeur"]))


@query("SELECT row_number() OVER (ORDER BY rank, period, v) - 1 AS place, name AS \"column\" FROM (SELECT 0 rank, '' period, '' v, 'id_indiv' AS name UNION ALL SELECT 1, '', '', 'note' UNION ALL SELECT 2, period, v, v || '_t' || period FROM (SELECT DISTINCT period FROM instantanes), (VALUES ('csp_code'), ('salaire_brut')) t(v))")
def prj06_ordered_columns(s, d):
    """Columns of a wide table: the lead, others, then by period and variable."""
    periods = [r[0] for r in table(s, d, "instantanes").select("period").distinct().orderBy(F.desc("period")).collect()]  # bounded by the calendar
    names = [f"{v}_t{p}" for v in ("salaire_brut", "csp_code") for p in periods]
    got = reshape.order_columns([*names, "note", "id_indiv"], ["csp_code", "salaire_brut"], ["id_indiv"])
    return s.createDataFrame(list(enumerate(got)), "place bigint, `column` string")


@query("SELECT * FROM (SELECT coalesce(id_indiv, 'NA') || '_' || coalesce(numero_employeur, 'NA') || '_' || printf('%d_%02d', annee, mois) obs_id, ligne_id, 1.0::DOUBLE w_final FROM declarations QUALIFY row_number() OVER (PARTITION BY obs_id ORDER BY ligne_id) = 1)")
def prj11_individual_base(s, d):
    x = _decl(s, d).withColumn("period", dates.period(F.col("annee"), F.col("mois")))
    return panel.individual_base(x.select("ligne_id", "id_indiv", "numero_employeur", "period")).select("obs_id", "ligne_id", "w_final")


@query("SELECT ligne_id FROM base_analytique WHERE salaire_brut_mens IS NOT NULL AND sexe IS NOT NULL AND annee IS NOT NULL AND mois IS NOT NULL")
def flt11_report_rows(s, d):
    return stats.report_rows(table(s, d, "base_analytique"), "salaire_brut_mens", ["sexe", "annee", "mois"]).select("ligne_id")


@query(f"WITH {_LOOK} SELECT b.ligne_id, k.secteur_activite_cod secteur_activite_cod_ext, coalesce(k.secteur_activite_cod, b.secteur_activite_cod) sector_code FROM base_analytique b LEFT JOIN k ON nullif(trim(b.numero_employeur), '') = k.e")
def joi06_sector_code(s, d):
    b = table(s, d, "base_analytique").select("ligne_id", "numero_employeur", "secteur_activite_cod")
    j = refjoin.join_exact(b, table(s, d, "secteurs_employeurs"), "numero_employeur", suffix="_ext")
    return j.select("ligne_id", "secteur_activite_cod_ext", F.coalesce("secteur_activite_cod_ext", "secteur_activite_cod").alias("sector_code"))


@query(
    """WITH x AS (SELECT column_name c, column_type t FROM (DESCRIBE declarations)), y AS (SELECT column_name c, column_type t FROM (DESCRIBE SELECT * REPLACE (mois::VARCHAR AS mois, annee::DOUBLE AS annee) FROM base_analytique))
SELECT c AS "column", 'missing' AS change FROM x ANTI JOIN y USING (c) UNION ALL SELECT c, 'extra' FROM y ANTI JOIN x USING (c) UNION ALL SELECT c, 'retyped' FROM x JOIN y USING (c) WHERE x.t <> y.t"""
)
def set03_qc02_qc03_schema_differences(s, d):
    other = table(s, d, "base_analytique").withColumn("mois", F.col("mois").cast("string")).withColumn("annee", F.col("annee").cast("double"))
    r = audit.schema_differences([("declarations", _decl(s, d)), ("base_analytique", other)])[0]
    return s.createDataFrame([(c, k) for k in ("missing", "extra") for c in r[k]] + [(c, "retyped") for c, _, _ in r["retyped"]], "`column` string, change string")


_ROLE_ROWS = " UNION ALL ".join(f"SELECT '{role}' AS role, column_name AS \"column\" FROM (DESCRIBE declarations) WHERE regexp_matches(lower(column_name), '{rx}')" for role, rx in catalog.ROLES.items())


@query(_ROLE_ROWS)
def rsh09_key_variables(s, d):
    got = catalog.guess_roles(_decl(s, d).columns)
    return s.createDataFrame([(role, c) for role, cs in got.items() for c in cs], "role string, `column` string")


@query("SELECT unnest(['ID_INDIV', 'CLASSE_EFFECTIF', 'OBS_ID']) AS \"column\" EXCEPT SELECT upper(column_name) FROM (DESCRIBE declarations)")
def qc06_required_columns(s, d):
    return s.createDataFrame([(c,) for c in catalog.missing_columns(_decl(s, d).columns, ["ID_INDIV", "CLASSE_EFFECTIF", "OBS_ID"])], "`column` string")


@query("SELECT * FROM (VALUES ('noms', 'part', 'fuzzy', true, 2, true), ('perdu', 'absente', 'exact', true, 3, false), ('secteurs', 'secteurs_employeurs', 'exact', false, 1, true)) t(name, lookup, kind, enabled, \"order\", \"exists\")")
def udx05_lookups(s, d):
    """Lookups with what their files are, one switched off."""
    specs = [*catalog.toggle(catalog.MERGES, "secteurs", False), catalog.MergeSpec("perdu", "absente", "k", "k", order=3), catalog.MergeSpec("noms", "part", "p_name", "m", kind="fuzzy", order=2)]
    return s.createDataFrame(catalog.list_merges(specs, lambda n: files.exists(s, f"{d}/{n}.parquet")), "name string, lookup string, kind string, enabled boolean, order int, exists boolean")


@query("SELECT p_partkey, CASE WHEN p_size % 7 <> 0 THEN greatest(10, least(40, p_size)) END AS clamped, sqrt(p_size) root, abs(p_size - 25) away FROM part")
def mth01_mth02_clamp(s, d):
    size = F.when(F.col("p_size") % 7 != 0, F.col("p_size"))
    return table(s, d, "part").select("p_partkey", mathx.clamp(size, F.lit(10), F.lit(40)).alias("clamped"), F.sqrt("p_size").alias("root"), F.abs(F.col("p_size") - 25).alias("away"))


@query()
def mth03_student_quantiles(s, d):
    return s.range(1, 41).select(F.col("id").alias("df"), intervals.t_quantile(0.975, F.col("id").cast("double")).alias("t"))


@query(f"WITH {_B}, a AS (SELECT sexe, y, sum(w)::DOUBLE w FROM b WHERE y IS NOT NULL GROUP BY ALL) SELECT sexe, y, round(sum(w) OVER r / sum(w) OVER g, 9) cdf, round(sum(w * y) OVER r / sum(w * y) OVER g, 9) lorenz FROM a WINDOW g AS (PARTITION BY sexe), r AS (PARTITION BY sexe ORDER BY y)")
def win10_cumulated_shares(s, d):
    p = stats._placed(stats.blocks(_base(s, d).where("y IS NOT NULL"), ["sexe"], "y", "w"), ["sexe"])
    return p.select("sexe", "y", F.round(F.col("CW") / F.col("TW"), 9).alias("cdf"), F.round(F.col("CWY") / F.col("TWY"), 9).alias("lorenz"))


@query("SELECT numero_employeur, arg_max(ligne_id, (annee, mois)) ligne_id FROM panel_employeur GROUP BY 1")
def srt01_srt04_latest(s, d):
    return panel.latest(table(s, d, "panel_employeur"))


@query("SELECT b.ligne_id, k.numero_employeur premier_employeur FROM base_analytique b LEFT JOIN (SELECT id_indiv, numero_employeur FROM base_analytique QUALIFY row_number() OVER (PARTITION BY id_indiv ORDER BY period, ligne_id) = 1) k USING (id_indiv)")
def joi13_invariants_back(s, d):
    first = rsh02_invariants(s, d).withColumnRenamed("numero_employeur", "employeur")
    return reshape.attach_invariants(table(s, d, "base_analytique"), first, "id_indiv", "premier_").select("ligne_id", "premier_employeur")


@query(
    f"""WITH {_B}, k AS (SELECT secteur_activite_cod g, annee, y, sum(w)::DOUBLE W, sum(w * w)::DOUBLE S, count(*) c FROM b WHERE y IS NOT NULL GROUP BY ALL),
p AS (SELECT *, coalesce(sum(W * y) OVER (PARTITION BY g, annee ORDER BY y ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) bef FROM k),
t AS (SELECT g, annee, sum(c) n, sum(W) * sum(W * y) den, sum(W * bef + y * (W * W + S) / 2) l, sum(S * y) e FROM p GROUP BY ALL)
SELECT g secteur_activite_cod, annee, CASE WHEN n >= 2 THEN round(1 - 2 * l / den, 6) END gini, CASE WHEN n >= 2 THEN round(1 - 2 * l / den + e / den, 6) END usual FROM t"""
)
def agg09_usual_gini(s, d):
    """A statistic added by a catalogue entry."""
    return rounded(stats.group_statistics(_base(s, d).where("y IS NOT NULL"), ["secteur_activite_cod", "annee"], "y", "w", [catalog.Statistic("gini", "gini", ""), catalog.Statistic("usual", "gini_standard", "")]), 6)


# --- files -----------------------------------------------------------------------------------------------------------


@query("SELECT n_nationkey::VARCHAR n_nationkey, n_name, n_regionkey::VARCHAR n_regionkey, NULL::VARCHAR r_name FROM nation UNION ALL SELECT NULL, NULL, r_regionkey::VARCHAR, r_name FROM region")
def src01_to_src03_src15_workbooks(s, d):
    """Two workbooks written, then read with all their sheets one under the other, columns by header; a lock file stays out."""
    n, r = table(s, d, "nation").select("n_nationkey", "n_name", "n_regionkey"), table(s, d, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    at = folder(s, "books")
    files.write_report(f"{at}/01_2024.xlsx", {"Feuil1": n.where("n_nationkey < 10"), "Feuil2": r}, {"source": "nation"})
    files.write(n.where("n_nationkey >= 10"), f"{at}/02_2024.xlsx")
    files.write(r, f"{at}/~$03_2024.xlsx")
    x = files.read_workbooks(s, at, keep_place=True).where("feuille <> 'Metadata'")
    return x.select("n_nationkey", "n_name", "n_regionkey", "r_name")


@query("SELECT n_nationkey, n_name, n_regionkey, k FROM nation, (VALUES ('csv'), ('dta'), ('json'), ('orc'), ('parquet'), ('xlsx')) t(k)")
def src04_to_src08_src17_readers(s, d):
    """A table written by each sink and read by each reader, two of its columns asked for by name."""
    n = table(s, d, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").cast("int").alias("n_regionkey"))
    at, out = folder(s, "sinks"), None
    for k in ("csv", "dta", "json", "orc", "parquet", "xlsx"):
        files.write(n, f"{at}/nation.{k}")
        x = files.read(s, f"{at}/nation.{k}", columns=["n_nationkey", "n_name", "n_regionkey"])
        x = x.select(F.col("n_nationkey").cast("int").alias("n_nationkey"), "n_name", F.col("n_regionkey").cast("int").alias("n_regionkey"), F.lit(k).alias("k"))
        out = x if out is None else out.unionByName(x)
    return out


@query("SELECT row_number() OVER () - 1 AS place, column_name AS \"column\" FROM (DESCRIBE declarations)")
def src07_probe(s, d):
    kinds, _ = files.probe(_decl(s, d))
    return s.createDataFrame([(i, c) for i, (c, _) in enumerate(kinds)], "place bigint, `column` string")


@query("SELECT n_name AS file, CASE WHEN n_nationkey % 2 = 0 THEN 'completed' ELSE 'in_progress' END AS status FROM nation")
def src11_registry(s, d):
    """Entries set twice: the later state holds."""
    import tempfile

    reg = files.IntakeRegistry(f"{tempfile.mkdtemp()}/registry.csv")  # the registry is a file of the driver
    for r in table(s, d, "nation").select("n_nationkey", "n_name").collect():
        reg.upsert(r["n_name"], "h", "in_progress")
        if r["n_nationkey"] % 2 == 0:
            reg.upsert(r["n_name"], "h", "completed")
    return reg.frame(s).select("file", "status")


# --- intake ----------------------------------------------------------------------------------------------------------


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS \"start\", event_type, count(*) n, round(sum(value), 4) total FROM events GROUP BY ALL")
def stream_windowed_counts(s, d):
    from ..streaming.intake import windowed_counts

    w = windowed_counts(table(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp")))
    return w.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("SELECT fichier AS file, 'modified' AS reason FROM (SELECT DISTINCT fichier FROM lignes_brutes) WHERE fichier[1:2] = '03' UNION ALL SELECT fichier, 'new_file' FROM (SELECT DISTINCT fichier FROM lignes_brutes) WHERE fichier[1:2] = '04' UNION ALL SELECT fichier, 'incomplete' FROM (SELECT DISTINCT fichier FROM lignes_brutes) WHERE fichier[1:2] = '05'")
def src10_incremental_files(s, d):
    from ..sources.files import to_process

    f = table(s, d, "lignes_brutes").groupBy(F.col("fichier").alias("file")).agg(F.md5(F.array_join(F.array_sort(F.collect_list(F.md5("contenu"))), "")).alias("hash"))
    month = F.substring("file", 1, 2)
    known = f.where(month != "04").select("file", F.when(month == "03", "?").otherwise(F.col("hash")).alias("hash"), F.when(month == "05", "in_progress").otherwise("completed").alias("status"))
    return to_process(f, known).select("file", "reason")


@query("SELECT upper(libelle_agence) agence, libelle_agence[8:] numero, regexp_extract(libelle_agence, '([0-9]+)$', 1)::INT n, libelle_agence ~ 'A0+1' hit FROM (SELECT DISTINCT libelle_agence FROM declarations WHERE libelle_agence IS NOT NULL)")
def str08_to_str10_text_fields(s, d):
    c = F.col("libelle_agence")
    x = _decl(s, d).where(c.isNotNull()).select(c).distinct()
    return x.select(F.upper(c).alias("agence"), F.substring(c, 8, 1000).alias("numero"), F.regexp_extract(c, "([0-9]+)$", 1).try_cast("int").alias("n"), c.rlike("A0+1").alias("hit"))


@query()
def pipeline_estimates(s, d):
    """The whole chain, from declarations to publishable cells."""
    from ..plans.pipeline import Pipeline, Settings

    r = Pipeline(s, settings=Settings(imputations=0, checks=False)).run({"declarations": _decl(s, d), "secteurs_employeurs": table(s, d, "secteurs_employeurs")})
    return r.tables["estimates"]


@query()
def pipeline_combined_imputations(s, d):
    """The whole chain with five imputations, combined."""
    from ..plans.pipeline import Pipeline, Settings

    r = Pipeline(s, settings=Settings(checks=False)).run({"declarations": _decl(s, d), "secteurs_employeurs": table(s, d, "secteurs_employeurs")})
    return r.tables["combined"]
