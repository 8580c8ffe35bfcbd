"""Type harmonisation, derived columns, filters (PRJ-01 to PRJ-14, FLT-01 to FLT-06, SRC-13)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bins, dates, text
from ..plans.catalog import TYPES


def harmonise(df: DataFrame, types: dict[str, str] = TYPES) -> DataFrame:
    """Known columns cast to their logical type in one projection: trimmed text with empty as null, numbers with null
    for what isn't one, moments. Employer numbers become text without a trailing .0. Other columns pass through."""

    def one(c: str) -> Column:
        kind, col = types.get(c.upper()), F.col(f"`{c}`")
        if kind == "text":
            t = text.trimmed(col)
            return (F.regexp_replace(t, r"\.0+$", "") if c.upper() == "NUMERO_EMPLOYEUR" else t).alias(c)
        if kind == "number":
            return (col.try_cast("double") if dict(df.dtypes)[c] != "string" else F.trim(col).try_cast("double")).alias(c)
        if kind == "moment":
            return (col if dict(df.dtypes)[c].startswith("timestamp") else dates.to_moment(col)).alias(c)
        return col

    return df.select(*[one(c) for c in df.columns])


def add_period(df: DataFrame, file: str) -> DataFrame:
    """MOIS and ANNEE from the file's name; rows of files with other names are left out."""
    m, a = dates.period_of_file(F.col(file))
    return df.withColumn("MOIS", m).withColumn("ANNEE", a).where("MOIS IS NOT NULL")


def monthly_wage(wage: Column, duration: Column) -> Column:
    return F.when(duration > 0, wage / duration).otherwise(wage)


def derive(df: DataFrame) -> DataFrame:
    """Ages and tenures as differences of calendar years, their classes, period columns, the monthly wage; only what the
    table's columns allow."""
    have = set(df.columns)
    years = {n: (F.col("annee") - F.year(c)).cast("int") for n, c in AGES if {c, "annee"} <= have}
    # one projection each for years, codes and labels: a column that later ones use often is computed once
    coded, labelled = {}, {}
    for name in years:
        for prefix, classes in (("cl_", bins.AGE), ("cl_red_", bins.AGE_REDUCED)):
            coded[f"{prefix}{name}_code"] = bins.code(name, classes)
            labelled[f"{prefix}{name}"] = bins.text(F.col(f"{prefix}{name}_code"), classes)
    if "effectif_salaries" in have:
        for name, classes in (("classe_effectif", bins.SIZE), ("classe_effectif_reduite", bins.SIZE_REDUCED)):
            coded[f"{name}_code"] = bins.code("effectif_salaries", classes)
            labelled[name] = bins.text(F.col(f"{name}_code"), classes)
    if {"annee", "mois"} <= have:
        labelled |= {"period": dates.period(F.col("annee"), F.col("mois")), "trimestre": dates.quarter(F.col("mois")), "semestre": dates.half(F.col("mois"))}
    if {"salaire_brut", "duree_travaillee"} <= have:
        labelled["salaire_brut_mens"] = monthly_wage(F.col("salaire_brut"), F.col("duree_travaillee"))
    out = df
    for step in (years, coded, labelled):
        out = out.withColumns(step) if step else out
    return out


#: Derived years and the dates they count from.
AGES = (("age_employe", "date_naissance"), ("anciennete_entreprise", "date_embauche"), ("anciennete_immat", "date_immatriculation"), ("age_entreprise_immat", "date_immat_employeur"))


@dataclass(frozen=True)
class CleanRules:
    floor: float = 75_000.0
    exclude: tuple[str, ...] = ("H", "J")
    monthly: str = "M"


def apply_filters(df: DataFrame, rules: CleanRules = CleanRules()) -> DataFrame:
    """Rows with a wage that isn't null or zero, of a kept kind (a null kind is kept), at or above the floor if monthly;
    durations of monthly staff become 1 where they are 0 or above 1. A condition that is null makes a duration null and
    drops a row from the floor."""
    kind, wage, d = F.col("type_salarie"), F.col("salaire_brut"), F.col("duree_travaillee")
    out = df.where(wage.isNotNull()).where(wage != 0).where(kind.isNull() | ~kind.isin(*rules.exclude))
    fix = (kind == rules.monthly) & ((d == 0) | (d > 1))
    out = out.withColumn("duree_travaillee", F.when(fix.isNull(), None).when(fix, 1.0).otherwise(d))
    out = out.where(~((F.col("salaire_brut") < rules.floor) & (F.col("type_salarie") == rules.monthly)))
    return out.withColumn("salaire_brut_mens", monthly_wage(F.col("salaire_brut"), F.col("duree_travaillee")))


def keep_columns(df: DataFrame, names: Sequence[str], key: Sequence[str] = ()) -> DataFrame:
    """Those of names that are there, and the key."""
    want = dict.fromkeys([*key, *names])
    return df.select(*[c for c in want if c in df.columns])


def drop_prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(prefix)])


def observation_id(*parts: str) -> Column:
    """Parts joined by _, a null part as NA."""
    return F.concat_ws("_", *[F.coalesce(F.col(p).cast("string"), F.lit("NA")) for p in parts])


def union_files(frames: Sequence[DataFrame], distinct: str | None = "file") -> DataFrame:
    """Union by name with null for absent columns; distinct: rows once per file, once over all, or as they are."""
    out = None
    for f in frames:
        f = f.distinct() if distinct == "file" else f
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out.distinct() if distinct == "global" else out


def complete_cases(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without null in the columns; absent columns are ignored."""
    return df.dropna(subset=[c for c in columns if c in df.columns])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool = False) -> DataFrame:
    """One row per keys, the first (or last) by order, combined before the shuffle, so that a hot key sends one row per task.
    The row held is a struct of any width, for which Spark sorts a task's rows by key on either side of the shuffle."""
    row = F.struct(*df.columns)
    at = F.struct(*order)
    pick = F.max_by(row, at) if last else F.min_by(row, at)
    return df.groupBy(*keys).agg(pick.alias("_r")).select("_r.*")
