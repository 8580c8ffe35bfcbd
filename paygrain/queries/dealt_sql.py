"""DuckDB twins of the p queries."""

from __future__ import annotations

_P1 = r"""
WITH l AS (SELECT ligne_id, nullif(regexp_replace(regexp_replace(numero_employeur, '\s', '', 'g'), '\.0$', ''), '') e,
    nullif(trim(id_indiv), '') i, nullif(upper(trim(type_salarie)), '') k, annee * 12 + mois m,
    unnest([{'c': 'salaire_brut', 'v': salaire_brut}, {'c': 'duree_travaillee', 'v': duree_travaillee}], recursive := true)
    FROM declarations),
x AS (SELECT * FROM l WHERE v IS NOT NULL AND v <> 0 AND NOT isnan(v)),
usual AS (SELECT e, max_by(k, (n, k)) u FROM (SELECT e, k, count(*) n FROM l WHERE k IS NOT NULL AND c = 'salaire_brut' GROUP BY ALL) GROUP BY e),
a AS (SELECT ligne_id, c FROM x LEFT JOIN usual USING (e) WHERE v < 0
    OR (c = 'duree_travaillee' AND (v > 744 OR (v > 31 AND coalesce(k, u) IN ('M', 'J'))))),
mo AS (SELECT e, i, c, m, max_by(v, ligne_id) v FROM x WHERE i IS NOT NULL AND e IS NOT NULL GROUP BY ALL),
st AS (SELECT *, lag(v) OVER w p FROM mo WINDOW w AS (PARTITION BY e, i, c ORDER BY m)),
sh AS (SELECT e, c FROM st WHERE p IS NOT NULL GROUP BY ALL HAVING avg((p = v)::INT) < 0.25),
ru AS (SELECT *, sum(CASE WHEN p IS DISTINCT FROM v THEN 1 ELSE 0 END) OVER (PARTITION BY e, i, c ORDER BY m) r FROM st),
c1 AS (SELECT e, i, c, m FROM ru SEMI JOIN sh USING (e, c) QUALIFY count(*) OVER (PARTITION BY e, i, c, r) >= 5),
c2 AS (SELECT e, i, c, m FROM mo SEMI JOIN (SELECT e, c, m FROM mo SEMI JOIN sh USING (e, c) WHERE c = 'salaire_brut'
    GROUP BY ALL HAVING count(*) >= 5 AND min(v) = max(v)) g USING (e, c, m)),
md AS (SELECT e, i, c, median(v) d FROM mo GROUP BY ALL HAVING count(*) >= 5),
b AS (SELECT e, i, c, m FROM mo JOIN md USING (e, i, c) WHERE d > 0 AND (v >= 3 * d OR v * 3 <= d)),
u AS (SELECT * FROM c1 UNION SELECT * FROM c2 UNION SELECT * FROM b)
SELECT ligne_id, c AS champ FROM a UNION SELECT ligne_id, c FROM x SEMI JOIN u USING (e, i, c, m)
"""

_P1_RULES = _P1[: _P1.index("u AS (SELECT * FROM c1")].rstrip().rstrip(",") + """
SELECT ligne_id, c AS champ, 'bound' AS regle FROM a UNION ALL SELECT ligne_id, c, 'stuck' FROM x SEMI JOIN c1 USING (e, i, c, m) UNION ALL SELECT ligne_id, c, 'agreed' FROM x SEMI JOIN c2 USING (e, i, c, m)
"""

_HEADERS = {
    "ID_INDIV": ["Id Indiv", " ID_INDIV", "ID_INDIVIDU", "IDENTIFIANT_INDIVIDU", "MATRICULE_INDIV", "ID-INDIV", "id_indiv"],
    "SALAIRE_BRUT": ["SALAIREBRUT", "SALAIRE_BRUT_FCFA", "REMUNERATION_BRUTE", "SALAIRE_BRUT ", "Salaire brut", "SAL_BRUT", "salaire_brut"],
    "NUMERO_EMPLOYEUR": ["EMPLOYEUR_NUM", "NO_EMPLOYEUR", "NUMERO EMPLOYEUR", "NUM_EMPLOYEUR", "numero_employeur", "Numéro Employeur", "N° employeur"],
    "DUREE_TRAVAILLEE": ["TEMPS_TRAVAILLE", "DUREE_TRAV", "duree", "Durée travaillée"],
    "SEXE": ["Sexe", "SEX", "GENRE"],
    "TYPE_SALARIE": ["Type salarié", "TYPESALARIE", "TYPE_SAL"],
    "DATE_NAISSANCE": ["NE_LE", "DT_NAISSANCE", "Date de naissance"],
    "DATE_EMBAUCHE": ["DT_EMBAUCHE", "Date embauche"],
    "RAISON_SOCIALE": ["Raison sociale", "RS_EMPLOYEUR"],
    "COMMUNE": ["Commune", "COMMUNE_EMPLOYEUR"],
    "EFFECTIF_SALARIES": ["Nb salariés", "EFFECTIF"],
    "SECTEUR_ACTIVITE": ["SECTEUR", "Secteur d'activité"],
    "CSP_CODE": ["CODE_CSP", "csp code"],
}
_VALUES = ", ".join("('{}', '{}')".format(h.replace("'", "''"), c) for c, hs in _HEADERS.items() for h in hs)

_P2 = f"""
WITH ok AS (SELECT fichier, contenu::JSON j FROM lignes_brutes WHERE json_valid(contenu) AND json_type(contenu) = 'OBJECT'),
k AS (SELECT fichier, j, unnest(json_keys(j)) h FROM ok),
v AS (SELECT fichier, h, json_type(j -> ('$."' || h || '"')) t FROM k),
n AS (SELECT fichier, h, CASE WHEN t IN ('VARCHAR') THEN 'text' WHEN t = 'OBJECT' THEN 'object' WHEN t = 'NULL' THEN NULL ELSE 'number' END q, count(*) n FROM v GROUP BY ALL),
f AS (SELECT fichier, h, max_by(q, n * 10 + CASE q WHEN 'number' THEN 3 WHEN 'object' THEN 2 ELSE 1 END) q FROM n GROUP BY ALL),
names AS (SELECT * FROM (VALUES {_VALUES}) t(h, c)),
g AS (SELECT fichier, coalesce(c, h) champ, h, q FROM f LEFT JOIN names USING (h)),
o AS (SELECT fichier, lag(fichier) OVER w b FROM (SELECT DISTINCT fichier FROM g)
    WINDOW w AS (PARTITION BY regexp_extract(fichier, '^\\d\\d_\\d{{4}}_(.+)\\.', 1) ORDER BY fichier[4:7], fichier[1:2])),
d AS (SELECT coalesce(x.fichier, y.a) fichier, coalesce(x.champ, y.champ) champ, x.h h1, y.h h0, x.q q1, y.q q0
    FROM (SELECT g.* FROM g JOIN o USING (fichier) WHERE b IS NOT NULL) x
    FULL JOIN (SELECT o.fichier a, g.champ, h, q FROM o JOIN g ON g.fichier = o.b) y ON x.fichier = y.a AND x.champ = y.champ)
SELECT fichier, champ, 'added' changement FROM d WHERE h0 IS NULL UNION ALL SELECT fichier, champ, 'removed' FROM d WHERE h1 IS NULL
UNION ALL SELECT fichier, champ, 'renamed' FROM d WHERE h0 <> h1 UNION ALL SELECT fichier, champ, 'retyped' FROM d WHERE q0 <> q1
"""

#: The project's columns and their types, and the value's name in columns that may hold objects.
_TEXTS = ("ID_INDIV", "NUMERO_EMPLOYEUR", "SEXE", "TYPE_SALARIE", "SITUATION_MATRIMONIALE", "NIVEAU_ETUDE", "PROFESSION", "STATUT_TRAVAILLEUR", "CSP_CODE", "PROF_CODE", "RAISON_SOCIALE", "SECTEUR_ACTIVITE", "COMMUNE", "LIBELLE_AGENCE")
_DOUBLES = ("SALAIRE_BRUT", "DUREE_TRAVAILLEE", "CATEGORIE_ENTREPRISE", "EFFECTIF_SALARIES")
_DATES = ("DATE_NAISSANCE", "DATE_EMBAUCHE", "DATE_IMMATRICULATION", "DATE_IMMAT_EMPLOYEUR", "DATE_DEBUT_ACT_EMPLOY")
_OWN = ", ".join(f"'{c}'" for c in _TEXTS + _DOUBLES + _DATES)


def _p2_table() -> str:
    """Every row's cells by column, cast; rows that are no whole object keep their place."""
    of = lambda c: f"nullif(trim(max(t) FILTER (c = '{c}')), '')"
    text = ", ".join(f"regexp_replace({of(c)}, '\\.0$', '') {c}" for c in _TEXTS)
    num = ", ".join(f"try_cast(replace(regexp_replace({of(c)}, '[\\s\u00a0\u202f]', '', 'g'), ',', '.') AS DOUBLE) {c}" for c in _DOUBLES)
    day = ", ".join(
        f"""CASE WHEN regexp_matches({of(c)}, '^\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}') THEN try_strptime({of(c)}[:10], '%d/%m/%Y')::DATE
WHEN regexp_matches({of(c)}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN try_cast({of(c)}[:10] AS DATE)
WHEN try_cast({of(c)} AS DOUBLE) > 0 AND try_cast({of(c)} AS DOUBLE) < 73051 THEN DATE '1899-12-30' + floor(try_cast({of(c)} AS DOUBLE))::INT END {c}"""
        for c in _DATES
    )
    return f"""
WITH ok AS (SELECT ligne_id, contenu::JSON j FROM lignes_brutes WHERE json_valid(contenu) AND json_type(contenu) = 'OBJECT'),
k AS (SELECT ligne_id, j, unnest(json_keys(j)) h FROM ok),
v AS (SELECT ligne_id, h, j -> ('$."' || h || '"') x FROM k),
names AS (SELECT * FROM (VALUES {_VALUES}) t(h, c)),
g AS (SELECT ligne_id, coalesce(c, h) c, CASE WHEN json_type(x) = 'OBJECT' AND coalesce(c, h) = 'NUMERO_EMPLOYEUR' THEN x ->> '$.numero'
    WHEN json_type(x) = 'OBJECT' AND coalesce(c, h) = 'SALAIRE_BRUT' THEN x ->> '$.montant' ELSE x ->> '$' END t FROM v LEFT JOIN names USING (h)),
w AS (SELECT ligne_id, {text}, {num}, {day}, coalesce(string_agg(c || '=' || coalesce(t, ''), ';' ORDER BY c) FILTER (c NOT IN ({_OWN})), '') autres FROM g GROUP BY ligne_id),
e AS (SELECT ligne_id, '' autres FROM ok WHERE len(json_keys(j)) = 0)
SELECT r.fichier, r.ligne_id, w.* EXCLUDE (ligne_id, autres), coalesce(w.autres, e.autres) autres FROM lignes_brutes r LEFT JOIN w USING (ligne_id) LEFT JOIN e USING (ligne_id)
"""


_P3 = """
WITH h AS (SELECT instantane s, coalesce(nullif(trim(id_indiv), ''), 'NA') || '_' || coalesce(nullif(trim(numero_employeur), ''), 'NA') || '_' || coalesce(nullif(trim(period), ''), 'NA') k,
    max_by({'a': nullif(trim(type_salarie), ''), 'b': nullif(trim(csp_code), ''), 'c': nullif(trim(commune), ''), 'd': nullif(trim(secteur_activite_cod), ''),
    'e': nullif(trim(sexe), ''), 'x': salaire_brut, 'y': duree_travaillee}, ligne) r FROM instantanes GROUP BY ALL),
j AS (SELECT coalesce(n.s, o.s + 1) s, coalesce(n.k, o.k) k, n.r n, o.r o, n.k kn, o.k ko FROM h n FULL JOIN h o ON n.s = o.s + 1 AND n.k = o.k)
SELECT s::INT AS instantane, k AS obs_id, CASE WHEN ko IS NULL THEN 'added' WHEN kn IS NULL THEN 'removed' ELSE 'changed' END AS changement FROM j
WHERE s > (SELECT min(instantane) FROM instantanes) AND s <= (SELECT max(instantane) FROM instantanes)
AND (ko IS NULL OR kn IS NULL OR n.a IS DISTINCT FROM o.a OR n.b IS DISTINCT FROM o.b OR n.c IS DISTINCT FROM o.c OR n.d IS DISTINCT FROM o.d OR n.e IS DISTINCT FROM o.e
OR (n.x IS NULL) <> (o.x IS NULL) OR abs(n.x - o.x) > 0.005 OR (n.y IS NULL) <> (o.y IS NULL) OR abs(n.y - o.y) > 0.005)
"""


_DIFFERS = {"type_salarie": "a", "csp_code": "b", "commune": "c", "secteur_activite_cod": "d", "sexe": "e", "salaire_brut": "x", "duree_travaillee": "y"}
_P3_CHANGES = _P3.replace(
    "'changed' END AS changement FROM j",
    "'changed' END AS changement, CASE WHEN ko IS NOT NULL AND kn IS NOT NULL THEN array_to_string(list_sort(list_filter(["
    + ", ".join(
        f"CASE WHEN n.{f} IS DISTINCT FROM o.{f} THEN '{c}' END" if f < "x" else f"CASE WHEN (n.{f} IS NULL) <> (o.{f} IS NULL) OR abs(n.{f} - o.{f}) > 0.005 THEN '{c}' END" for c, f in _DIFFERS.items()
    )
    + "], lambda q: q IS NOT NULL)), ',') END AS changed FROM j",
)


def _p4() -> str:
    cols = ["id_indiv", "numero_employeur", "mois", "sexe", "commune", "salaire_brut", "duree_travaillee"]
    rows = "\nUNION ALL ".join(f"SELECT chargement c, '{x}' k, count(*) n, count(*) - count({x}) z, count(DISTINCT {x}) u FROM chargements GROUP BY ALL" for x in cols)
    cdf = "\nUNION ALL ".join(
        f"""SELECT a.c, '{x}' k, max(abs(fa - fb)) g FROM (
SELECT o.c, p.v, (SELECT 0) q, sum(p.na) OVER w / sum(p.na) OVER t fa, sum(p.nb) OVER w / sum(p.nb) OVER t fb, sum(p.na) OVER t ta, sum(p.nb) OVER t tb FROM o JOIN (
SELECT c, v, sum(na) na, sum(nb) nb FROM (
SELECT o.c, d.{x} v, 1.0::DOUBLE na, 0.0::DOUBLE nb FROM o JOIN chargements d ON d.chargement = o.c WHERE o.b IS NOT NULL AND d.{x} IS NOT NULL
UNION ALL SELECT o.c, d.{x}, 0.0, 1.0 FROM o JOIN chargements d ON d.chargement = o.b WHERE d.{x} IS NOT NULL) GROUP BY ALL) p USING (c)
WINDOW w AS (PARTITION BY o.c ORDER BY p.v), t AS (PARTITION BY o.c)) a WHERE ta > 0 AND tb > 0 GROUP BY ALL"""
        for x in ("salaire_brut", "duree_travaillee")
    )
    return f"""
WITH o AS (SELECT c, lag(c) OVER (PARTITION BY regexp_extract(c, '^(.*)_\\d{{4}}_\\d\\d$', 1) ORDER BY c[-7:]) b FROM (SELECT DISTINCT chargement c FROM chargements)),
s AS ({rows}),
f AS (SELECT c, k, round(z / n, 6) z, CASE WHEN n > z THEN round(u / (n - z), 6) END u FROM s),
p AS (SELECT f.c, f.k, f.z, f.u, g.z z0, g.u u0 FROM f JOIN o USING (c) JOIN f g ON g.c = o.b AND g.k = f.k),
m AS (SELECT chargement c, round(avg((mois <> chargement[-2:]::INT)::INT), 6) x FROM chargements WHERE mois IS NOT NULL GROUP BY ALL),
r AS (SELECT chargement, 'mois' colonne, 'range' constat FROM chargements WHERE mois NOT BETWEEN 1 AND 12
UNION SELECT chargement, 'salaire_brut', 'range' FROM chargements WHERE salaire_brut NOT BETWEEN 0 AND 50000000
UNION SELECT chargement, 'duree_travaillee', 'range' FROM chargements WHERE duree_travaillee NOT BETWEEN 0 AND 744
UNION SELECT chargement, 'id_indiv', 'pattern' FROM chargements WHERE NOT regexp_full_match(id_indiv, '[A-Z]{{2}}[0-9]{{9}}')
UNION SELECT chargement, 'numero_employeur', 'pattern' FROM chargements WHERE NOT regexp_full_match(numero_employeur, '[0-9]{{7}}')
UNION SELECT c, k, 'nulls' FROM p WHERE round(abs(z - z0), 6) >= 0.1
UNION SELECT c, k, 'distinct' FROM p WHERE k IN ('id_indiv', 'salaire_brut') AND round(abs(u - u0), 6) >= 0.2
UNION SELECT c, k, 'distribution' FROM ({cdf}) WHERE round(g, 6) >= 0.25
UNION SELECT m.c, 'mois', 'distribution' FROM m JOIN o USING (c) JOIN m n ON n.c = o.b WHERE round(abs(m.x - n.x), 6) >= 0.2)
SELECT * FROM r
"""


def _p4_figures() -> str:
    bounds = {"mois": (1, 12), "salaire_brut": (0, 50_000_000), "duree_travaillee": (0, 744)}
    forms = {"id_indiv": "[A-Z]{2}[0-9]{9}", "numero_employeur": "[0-9]{7}"}
    numbers = ("ligne_id", "mois", "annee", "salaire_brut", "duree_travaillee")
    rows = []
    for c in ("ligne_id", "libelle_agence", "charge_le", "id_indiv", "numero_employeur", "mois", "annee", "sexe", "type_salarie", "commune", "salaire_brut", "duree_travaillee"):
        least = f"min({c})::DOUBLE least, max({c})::DOUBLE most" if c in numbers else "NULL::DOUBLE least, NULL::DOUBLE most"
        out = f"count(*) FILTER ({c} NOT BETWEEN {bounds[c][0]} AND {bounds[c][1]})" if c in bounds else "0"
        bad = f"count(*) FILTER (NOT regexp_full_match({c}, '{forms[c]}'))" if c in forms else "0"
        rows.append(f"SELECT chargement, '{c}' colonne, count(*) AS rows, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS \"distinct\", {least}, {out} out_of_range, {bad} violations FROM chargements WHERE chargement IS NOT NULL GROUP BY chargement")
    return "\nUNION ALL ".join(rows)


_P6 = """
WITH k AS (SELECT DISTINCT numero_employeur e FROM panel_employeur),
b AS (SELECT ligne_id, id_indiv, CASE WHEN salaire_brut_mens BETWEEN 0 AND 90000000 THEN 1 END s, k.e FROM base_analytique LEFT JOIN k ON numero_employeur = k.e),
x AS (SELECT *, count(s) OVER (PARTITION BY id_indiv) si, count(e) OVER (PARTITION BY id_indiv) ei, count(s) OVER (PARTITION BY e) se FROM b),
p AS (SELECT ligne_id, d_jt IN (0, 1) ok, count(*) FILTER (d_jt IN (0, 1)) OVER (PARTITION BY numero_employeur) n FROM panel_employeur)
SELECT 'base_analytique' AS nom_table, ligne_id, 'salaire_brut_mens' AS champ FROM x WHERE s IS NULL AND ((id_indiv IS NOT NULL AND si > 0) OR (e IS NOT NULL AND se > 0))
UNION ALL SELECT 'base_analytique', ligne_id, 'numero_employeur' FROM x WHERE e IS NULL AND id_indiv IS NOT NULL AND ei > 0
UNION ALL SELECT 'panel_employeur', ligne_id, 'd_jt' FROM p WHERE ok IS NOT TRUE AND n > 0
"""

ORACLE = {"p1_found": _P1, "p1_rules": _P1_RULES, "p2_found": _P2, "p2_table": _p2_table(), "p3_found": _P3, "p3_changes": _P3_CHANGES, "p4_found": _p4(), "p4_figures": _p4_figures(), "p6_found": _P6}
