"""Filling missing wages, employer numbers and declaration flags from similar records, with masks.

A mixture of Gaussian and categorical fields (see mixture.py) is fitted on the whole table; a missing number becomes its
conditional expectation, a missing category the mode of its conditional distribution, both given the record's own fields
and what the other records of its worker or employer show. A cell without any such record stays empty.

Everything about a worker or employer is aggregated map-side into one row per key (a bounded list of candidate employers
among it), so a key that holds a third of all rows costs no more than another; joins go by key against those rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from . import mixture

#: Sections A to U of the activity code, then anything else.
SECTIONS = 22


@dataclass(frozen=True)
class FillRules:
    least: float = 0.0
    most: float = 90_000_000.0
    components: int = 3
    steps: int = 12
    flags: tuple[int, ...] = (0, 1)


def section(c: Column | str) -> Column:
    """0..20 for a code's leading letter A..U, 21 for other texts, null for none."""
    c = F.upper(F.trim(F.col(c) if isinstance(c, str) else c))
    i = F.ascii(F.substring(c, 1, 1)) - 65
    return F.when(c.isNull() | (c == ""), None).when(i.between(0, 20), i).otherwise(SECTIONS - 1).cast("int")


def sex(c: Column | str) -> Column:
    c = F.upper(F.substring(F.trim(F.col(c) if isinstance(c, str) else c), 1, 1))
    return F.when(c == "F", 0).when(c == "M", 1).when(c.isNotNull() & (c != ""), 2).cast("int")


def usable_wage(c: Column, rules: FillRules) -> Column:
    """The wage where it is usable, else null; NaN lies above any bound."""
    return F.when(c.between(rules.least, rules.most), c)


def fill_base(base: DataFrame, panel: DataFrame, rules: FillRules = FillRules()) -> DataFrame:
    """base with salaire_brut_mens_rempli, numero_employeur_rempli and their masks salaire_brut_mens_est_rempli,
    numero_employeur_est_rempli. A wage is usable from rules.least to rules.most, an employer if it is in the panel; any
    other cell is missing, null included, and is filled if another row of its worker (wages: or of its usable employer)
    has a usable one. Rows that lack a worker have no worker's rows. Other columns pass through; copies of a row are
    other rows of it. ligne_id is unique; columns that bear the new names are replaced. Empty tables give empty results."""
    d, filled = _filled_rows(base, panel, rules)
    keys = filled.select("ligne_id", F.col("_x").alias("_fx"), F.col("_emp").alias("_fe"))
    # the row travels whole, so that its columns may have any name
    row = base.select("ligne_id", F.struct(*base.columns).alias("_row"))
    out = row.join(d.select("ligne_id", F.col("_emp").alias("_ue")), "ligne_id").join(keys, "ligne_id", "left")
    wage = usable_wage(F.col("_row.salaire_brut_mens"), rules)
    new = {
        "salaire_brut_mens_rempli": F.coalesce(wage, "_fx"),
        "salaire_brut_mens_est_rempli": wage.isNull() & F.col("_fx").isNotNull(),
        "numero_employeur_rempli": F.coalesce("_ue", "_fe"),
        "numero_employeur_est_rempli": F.col("_ue").isNull() & F.col("_fe").isNotNull(),
    }
    return out.select(*[F.col(f"_row.`{c}`") for c in base.columns if c not in new], *[e.alias(k) for k, e in new.items()])


def filled_cells(base: DataFrame, panel: DataFrame, rules: FillRules = FillRules()) -> DataFrame:
    """(nom_table, ligne_id, champ, valeur text): the cells that are filled, by the same steps as the full tables."""
    _, filled = _filled_rows(base, panel, rules)
    cell = F.explode(
        F.array(
            F.struct(F.lit("salaire_brut_mens").alias("champ"), F.col("_x").cast("string").alias("valeur")),
            F.struct(F.lit("numero_employeur").alias("champ"), F.col("_emp").alias("valeur")),
        )
    )
    a = filled.select(F.lit("base_analytique").alias("nom_table"), "ligne_id", cell.alias("_c")).select("nom_table", "ligne_id", "_c.champ", "_c.valeur").where("valeur IS NOT NULL")
    b = _filled_flags(panel, rules).select(F.lit("panel_employeur").alias("nom_table"), "ligne_id", F.lit("d_jt").alias("champ"), F.col("_f").cast("string").alias("valeur"))
    return a.unionByName(b)


def _filled_rows(base: DataFrame, panel: DataFrame, rules: FillRules) -> tuple[DataFrame, DataFrame]:
    """Rows with their groups, and (ligne_id, _x, _emp) of the rows in which a wage or employer is filled."""
    d = materialise(_with_groups(base, panel, rules), "fill-base")
    m = _fit_wages(d, rules)
    missing = d.where("(_x IS NULL AND (_w_n > 0 OR _e_n > 0)) OR (_emp IS NULL AND size(_who) > 0)")
    use = missing.select("ligne_id", "_x", "_emp", "_wx", "_ex", "_sec", "_sex", "_w_n", "_e_n", "_who")
    return d, use.mapInPandas(_fill_rows(m), "ligne_id bigint, _x double, _emp string")


def _with_groups(base: DataFrame, panel: DataFrame, rules: FillRules) -> DataFrame:
    """ligne_id, usable wage as log (_x) and employer (_emp), and what other rows show: their number and mean log wage
    per worker (_w_n, _wx) and employer (_e_n, _ex), the worker's other employers (_who, at most one per section)."""
    wage = usable_wage(F.col("salaire_brut_mens"), rules)
    rows = base.select(
        "ligne_id", "id_indiv", "numero_employeur", F.log1p(wage).alias("_x"), section("secteur_activite_cod").alias("_sec"), sex("sexe").alias("_sex")
    )
    known = panel.where("numero_employeur IS NOT NULL").select("numero_employeur").distinct()
    firm = (
        rows.where("numero_employeur IS NOT NULL")
        .groupBy("numero_employeur")
        .agg(F.count("_x").alias("_e_c"), F.sum("_x").alias("_e_s"), F.mode("_sec").alias("_e_sec"))
        .join(known, "numero_employeur", "left_semi")
    )
    rows = rows.join(firm, "numero_employeur", "left").withColumn("_emp", F.when(F.col("_e_c").isNotNull(), F.col("numero_employeur")))
    pair = (
        rows.where("id_indiv IS NOT NULL")
        .groupBy("id_indiv", "_emp")
        .agg(F.count("*").alias("_n"), F.count("_x").alias("_c"), F.sum("_x").alias("_s"), F.first("_e_sec", ignorenulls=True).alias("_p_sec"))
    )
    best = F.max(F.when(F.col("_emp").isNotNull(), F.struct("_n", "_emp")))
    per_section = pair.groupBy("id_indiv", F.coalesce("_p_sec", F.lit(-1)).alias("_p_sec")).agg(best.alias("_b"), F.sum("_c").alias("_c"), F.sum("_s").alias("_s"))
    worker = per_section.groupBy("id_indiv").agg(
        F.sum("_c").alias("_w_c"),
        F.sum("_s").alias("_w_s"),
        F.collect_list(F.when(F.col("_b").isNotNull(), F.struct(F.col("_p_sec").alias("sec"), F.col("_b._n").alias("n"), F.col("_b._emp").alias("emp")))).alias("_who"),
    )
    d = rows.join(worker, "id_indiv", "left")
    mine, has = F.coalesce("_x", F.lit(0.0)), F.col("_x").isNotNull().cast("int")
    d = d.withColumn("_w_n", F.coalesce(F.col("_w_c") - has, F.lit(0))).withColumn("_e_n", F.coalesce(F.col("_e_c") - has, F.lit(0)))
    return d.select(
        "ligne_id", "_x", "_emp", F.coalesce("_sec", "_e_sec").alias("_sec"), "_sex", "_w_n", "_e_n",
        F.when(F.col("_w_n") > 0, (F.col("_w_s") - mine) / F.col("_w_n")).alias("_wx"),
        F.when(F.col("_e_n") > 0, (F.col("_e_s") - mine) / F.col("_e_n")).alias("_ex"),
        # only rows that need candidates carry them
        F.when(F.col("_emp").isNull(), F.coalesce("_who", F.array().cast("array<struct<sec:int,n:bigint,emp:string>>"))).alias("_who"),
    )


def _fit_wages(d: DataFrame, rules: FillRules) -> mixture.Mixture | None:
    numeric = ["_x", "_wx", "_ex"]
    levels = {"_sec": SECTIONS, "_sex": 3}
    c = materialise(mixture.cells(d, numeric, levels, {"_x": 0.25, "_wx": 0.25, "_ex": 0.25}), "fill-cells")
    return mixture.fit(c, numeric, levels, rules.components, rules.steps)


def _fill_rows(m: mixture.Mixture | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if m is None or not len(b):
                # no usable wage anywhere: employers are filled by frequency alone
                yield pd.DataFrame({"ligne_id": b["ligne_id"], "_x": np.nan, "_emp": [_mode(w, None) if e is None else None for w, e in zip(b["_who"], b["_emp"])]})
                continue
            x = b[["_x", "_wx", "_ex"]].to_numpy(float)
            cats = {"_sec": b["_sec"].fillna(-1).to_numpy(int), "_sex": b["_sex"].fillna(-1).to_numpy(int)}
            need = np.isnan(x[:, 0]) & ((b["_w_n"].to_numpy() > 0) | (b["_e_n"].to_numpy() > 0))
            wage = np.where(need, np.expm1(m.expect(x, cats)[:, 0]), np.nan)
            # where the row's own section is known it decides; else the mixture's distribution of it
            probs = m.distribution("_sec", x, cats)
            known = cats["_sec"] >= 0
            probs[known] = 0.02 / SECTIONS
            probs[known, cats["_sec"][known]] += 0.98
            emp = [_mode(w, p) if e is None else None for w, e, p in zip(b["_who"], b["_emp"], probs)]
            yield pd.DataFrame({"ligne_id": b["ligne_id"], "_x": np.round(wage, 2), "_emp": pd.Series(emp, dtype=object, index=b.index)})

    return run


def _mode(who, probs: np.ndarray | None) -> str | None:
    """The most probable of a worker's employers: how often it stands in other rows, times its section's probability."""
    if who is None or not len(who):
        return None
    score = lambda w: (w["n"] * (1.0 if probs is None or w["sec"] < 0 else probs[w["sec"]]), w["n"], w["emp"])
    return max(who, key=score)["emp"]


def fill_panel(panel: DataFrame, rules: FillRules = FillRules()) -> DataFrame:
    """panel with d_jt_rempli and d_jt_est_rempli. A flag is usable if 0 or 1; a missing one is filled, with the mode of
    its distribution given its employer's rate in other months, the nearest usable months, the presence of figures and
    the section, if another month of its employer has a usable one."""
    row = panel.select("ligne_id", F.struct(*panel.columns).alias("_row")).join(_filled_flags(panel, rules), "ligne_id", "left")
    ok = F.when(F.col("_row.d_jt").isin(*rules.flags), F.col("_row.d_jt").cast("int"))
    new = {"d_jt_rempli": F.coalesce(ok, "_f"), "d_jt_est_rempli": F.col("_f").isNotNull()}
    return row.select(*[F.col(f"_row.`{c}`") for c in panel.columns if c not in new], *[e.alias(k) for k, e in new.items()])


def _filled_flags(panel: DataFrame, rules: FillRules) -> DataFrame:
    """(ligne_id, _f) of the rows whose flag is filled."""
    figures = [c for c in ("n_salaries", "salaire_total", "salaire_moyen", "log_y_bar_jt") if c in panel.columns]
    some = F.lit(False)
    for c in figures:
        some = some | F.col(c).isNotNull()
    ok = F.when(F.col("d_jt").isin(*rules.flags), F.col("d_jt").cast("int"))
    p = panel.where("numero_employeur IS NOT NULL").select(
        "ligne_id", "numero_employeur", "annee", "mois", ok.alias("_d"), some.cast("int").alias("_some"), section("secteur_activite_cod").alias("_sec")
    )
    firm = Window.partitionBy("numero_employeur")  # an employer's months; bounded by the calendar, the panel being balanced
    line = firm.orderBy("annee", "mois", "ligne_id")
    has = F.col("_d").isNotNull().cast("int")
    p = p.select(
        "*",
        (F.count("_d").over(firm) - has).alias("_n"),
        (F.coalesce(F.sum("_d").over(firm), F.lit(0)) - F.coalesce("_d", F.lit(0))).alias("_s"),
        F.last("_d", ignorenulls=True).over(line.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        F.first("_d", ignorenulls=True).over(line.rowsBetween(1, Window.unboundedFollowing)).alias("_after"),
    ).withColumn("_rate", F.when(F.col("_n") > 0, F.col("_s") / F.col("_n")))
    p = materialise(p, "fill-panel")
    levels = {"_d": 2, "_before": 2, "_after": 2, "_some": 2, "_sec": SECTIONS}
    c = materialise(mixture.cells(p, ["_rate"], levels, {"_rate": 0.05}), "fill-panel-cells")
    m = mixture.fit(c, ["_rate"], levels, rules.components, rules.steps)
    need = p.where("_d IS NULL AND _n > 0").select("ligne_id", "_rate", *levels)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = b[["_rate"]].to_numpy(float)
            cats = {k: b[k].fillna(-1).to_numpy(int) for k in levels}
            yield pd.DataFrame({"ligne_id": b["ligne_id"], "_f": m.distribution("_d", x, cats).argmax(1).astype("int32")})

    return need.mapInPandas(run, "ligne_id bigint, _f int") if m else need.select("ligne_id", F.lit(0).alias("_f"))
