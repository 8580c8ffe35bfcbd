"""Individual base, employer by month panel, analytical base (AGG-01 to AGG-03, AGG-26, JOI-07 to JOI-10, WIN-01 to WIN-05)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .clean import observation_id


def individual_base(df: DataFrame, ident: str = "id_indiv", firm: str = "numero_employeur", period: str = "period", order: Sequence[str] = ("ligne_id",)) -> DataFrame:
    """OBS_ID, weights of 1, one row per OBS_ID (the first by order)."""
    from .clean import keep_first

    d = df.withColumn("obs_id", observation_id(ident, firm, period))
    d = d.withColumns({w: F.lit(1.0) for w in ("w_jt", "w_ijt", "w_final")})
    return keep_first(d, ["obs_id"], order)


def firm_month(df: DataFrame, firm: str = "numero_employeur", ident: str = "id_indiv", wage: str = "salaire_brut_mens", carried: Sequence[str] = (), order: str = "ligne_id", sex: str | None = "sexe", female: str = "F", tenure: str | None = None, age: str | None = None) -> DataFrame:
    """One row per employer and month: counts, wage statistics, first known value of carried columns by order, shares.
    Null persons count as one person, as a value of their own."""
    persons = F.count_distinct(ident) + F.max(F.col(ident).isNull().cast("int"))
    aggs = [
        F.count("*").alias("n_salaries"),
        persons.cast("bigint").alias("n_salaries_distincts"),
        F.avg(wage).alias("salaire_moyen"),
        F.percentile(wage, 0.5).alias("salaire_median"),
        F.sum(wage).alias("salaire_total"),
        F.min(wage).alias("salaire_min"),
        F.max(wage).alias("salaire_max"),
        F.stddev_samp(wage).alias("salaire_sd"),
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in carried],
    ]
    if sex and sex in df.columns:
        aggs.append(F.avg((F.col(sex) == female).cast("double")).alias("pct_femmes"))
    if tenure and tenure in df.columns:
        aggs.append(F.avg(tenure).alias("anciennete_moyenne"))
    if age and age in df.columns:
        aggs.append(F.avg(age).alias("age_moyen"))
    return df.where(F.col(firm).isNotNull()).groupBy(firm, "annee", "mois").agg(*aggs).withColumn("log_y_bar_jt", F.log1p("salaire_moyen")).withColumn("d_jt", F.lit(1))


def balanced(observed: DataFrame, firm: str = "numero_employeur", zero: Sequence[str] = ("d_jt",)) -> DataFrame:
    """Every employer in every observed month, 0 in the zero columns where nothing was observed. The months are listed
    first, a row each, bounded by the calendar; every employer is then exploded over that list."""
    months = sorted((r[0], r[1]) for r in observed.select("annee", "mois").distinct().collect() if None not in r)
    each = F.explode(F.array(*[F.struct(F.lit(a).alias("annee"), F.lit(m).alias("mois")) for a, m in months])).alias("_t")
    firms = observed.select(firm).distinct()
    grid = firms.select(firm, each).select(firm, "_t.annee", "_t.mois") if months else firms.select(firm, F.lit(0).alias("annee"), F.lit(0).alias("mois")).where("false")
    d = grid.join(observed, [firm, "annee", "mois"], "left")
    return d.withColumns({c: F.coalesce(c, F.lit(0)) for c in zero if c in d.columns})


def fill_both_ways(df: DataFrame, columns: Sequence[str], firm: str = "numero_employeur") -> DataFrame:
    """Last known value before, else first known after, in month order."""
    w = Window.partitionBy(firm).orderBy("annee", "mois")
    down, up = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    return df.withColumns({c: F.coalesce(F.last(c, ignorenulls=True).over(down), F.first(c, ignorenulls=True).over(up)) for c in columns})


def history(df: DataFrame, firm: str = "numero_employeur", flag: str = "d_jt", log_wage: str = "log_y_bar_jt", size: str = "n_salaries") -> DataFrame:
    """Lags, past declarations, past periods, their share (null in the first), mean past size (null after a gap)."""
    w = Window.partitionBy(firm).orderBy("annee", "mois")
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    n = F.row_number().over(w) - 1
    told = F.coalesce(F.sum(flag).over(past), F.lit(0))
    return df.withColumns(
        {
            f"{flag}_lag1": F.lag(flag, 1).over(w),
            f"{flag}_lag2": F.lag(flag, 2).over(w),
            "n_declarations_passees": told,
            "n_periodes_passees": n,
            "pct_declarations_passees": F.when(n > 0, told / n),
            f"{log_wage}_lag1": F.lag(log_wage, 1).over(w),
            f"{log_wage}_lag2": F.lag(log_wage, 2).over(w),
            "effectif_moyen_passe": F.when(F.count(size).over(past) == F.count("*").over(past), F.avg(size).over(past)),
        }
    )


def panel(df: DataFrame, firm: str = "numero_employeur", carried: Sequence[str] = (), **names: str) -> DataFrame:
    """The balanced panel with carried columns filled and its history."""
    seen = materialise(firm_month(df, firm, carried=carried, **names), "panel-observed")
    return history(fill_both_ways(balanced(seen, firm), carried, firm), firm)


def with_flag(p: DataFrame, flag: str = "d_jt", values: Sequence[int] = (0, 1)) -> DataFrame:
    """Employer-months that declared (1) or didn't (0); pass one value for either alone."""
    return p.where(F.col(flag).isin(*values))


def latest(p: DataFrame, firm: str = "numero_employeur", value: str = "ligne_id", order: Sequence[str] = ("annee", "mois")) -> DataFrame:
    """firm and the value of its last month."""
    return p.groupBy(firm).agg(F.max_by(value, F.struct(*order)).alias(value))


def declaration_rate(p: DataFrame, firm: str = "numero_employeur", flag: str = "d_jt") -> DataFrame:
    return p.agg(F.avg(flag).alias("rate"), F.count_distinct(firm).alias("n_firms"), F.count_distinct("annee", "mois").alias("n_periods"))


def attach_weights(df: DataFrame, weights: DataFrame, keys: Sequence[str], weight: str) -> DataFrame:
    """The weights' value, else the row's own, else 1."""
    own = F.col(weight) if weight in df.columns else F.lit(None).cast("double")
    d = df.join(weights.select(*keys, F.col(weight).alias("_new")), list(keys), "left")
    return d.withColumn(weight, F.coalesce("_new", own, F.lit(1.0))).drop("_new")


def weight_product(*parts: Column) -> Column:
    out = F.lit(1.0)
    for p in parts:
        out = out * F.coalesce(p, F.lit(1.0))
    return out


def analytical_base(individual: DataFrame, weights: DataFrame, firm: str = "numero_employeur") -> DataFrame:
    """Individuals with their employer-month's columns, on employer and month; clashing names end in _firm."""
    keys = [firm, "annee", "mois"]
    own = set(individual.columns) - set(keys)
    right = weights.select(*keys, *[F.col(c).alias(f"{c}_firm" if c in own else c) for c in weights.columns if c not in keys])
    return individual.join(right, keys, "left")
