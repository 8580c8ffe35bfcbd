"""DuckDB twins of the queries of the text and number operators; the others can't be said in SQL."""

from __future__ import annotations

import math

from .sketch import ERROR, gamma

PS = {"p10": 0.1, "q1": 0.25, "mediane": 0.5, "q3": 0.75, "p90": 0.9, "p99": 0.99}
GROUPS = ("sexe", "cl_red_age_employe", "secteur_activite_cod", "commune", "numero_employeur")


def _p5(month: str = "mois", groups: tuple[str, ...] = GROUPS) -> str:
    """Exact percentiles, each put at the representative of its logarithmic bucket."""
    g = gamma(ERROR)
    rep = lambda v: f"CASE WHEN {v} < 1e-9 THEN 0.0 ELSE 2.0 * exp(ceil(ln({v}) / {math.log(g)!r}) * {math.log(g)!r}) / {g + 1.0!r} END"
    picks = ", ".join(
        [f"min(v) FILTER (cn >= tn * ({p} - 1e-12)) {k}" for k, p in PS.items()] + [f"min(v) FILTER (tw > 0 AND cw >= tw * ({p} - 1e-12)) {k}_pond" for k, p in PS.items()]
    )
    outs = ", ".join(f"round({rep(c)}, 4) {c}" for c in [*PS, *(f"{k}_pond" for k in PS)])
    dims = ", ".join(["{'d': 'ensemble', 'g': 'Total'}", *(f"{{'d': '{x}', 'g': {x}}}" for x in groups)])
    name = "mois" if month == "mois" else "trimestre"
    return f"""
WITH r AS (SELECT annee, {month} mois, salaire_brut_mens v, CASE WHEN w_final >= 0 THEN w_final::DECIMAL(14, 6) END w, unnest([{dims}], recursive := true) FROM base_analytique WHERE salaire_brut_mens BETWEEN 0 AND 90000000),
a AS (SELECT annee, mois, d, g, v, count(*) n, coalesce(sum(w), 0) w FROM r GROUP BY ALL),
c AS (SELECT *, sum(n) OVER o cn, (sum(w) OVER o)::DOUBLE cw, sum(n) OVER t tn, (sum(w) OVER t)::DOUBLE tw FROM a WINDOW o AS (PARTITION BY annee, mois, d, g ORDER BY v), t AS (PARTITION BY annee, mois, d, g)),
q AS (SELECT annee, mois, d, g, sum(n) n, sum(w) p, {picks} FROM c GROUP BY ALL)
SELECT annee, mois AS {name}, d AS dimension, g AS groupe, n::BIGINT AS n, p::DOUBLE AS poids, {outs} FROM q
"""


ORACLE = {"p5_percentiles": _p5(), "p5_quarters": _p5("ceil(mois / 3)::INT")}
