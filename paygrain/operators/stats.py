"""Weighted group statistics (AGG-04 to AGG-12, WIN-06, WIN-07, WIN-10, FLT-07, FLT-11, RSH-06, RSH-07).

All statistics of all dimensions come from one plan: rows are unpivoted to (dimension, group), combined map-side to one
block per (group, period, value) - count, weight, squared weight - and only the blocks are shuffled and ordered. The
national dimension, which holds every row, is thereby as spread as the others, and a group costs its distinct values,
which are placed in ranges (ranks.py), so that no task holds a whole group.

Definitions, for values y with weights w: the mean divides by all weights, also those of rows whose y is null; the
variance is of the population form about that mean, over the same denominator; a quantile is the first y, nulls last,
whose cumulative share of weight reaches p, so it is null where the rows with null y reach it; the Gini index is
1 - 2 sum(w * cumulated w y) / (sum w * sum w y), null for fewer than two rows or any null y. gini_standard adds the
correction sum(w^2 y) / (sum w * sum w y), the usual index.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.catalog import STATISTICS, Dimension, Statistic
from .ranks import percentiles, running

KEYS = ["dimension", "group_value"]


def final_weights(df: DataFrame, parts: Sequence[str] = ("w_jt", "w_ijt"), period: Sequence[str] = ("annee", "mois")) -> DataFrame:
    """w_final, the product of the parts with null as 1, and w_normalized, scaled to the period's row count."""
    w = F.lit(1.0)
    for p in parts:
        if p in df.columns:
            w = w * F.coalesce(p, F.lit(1.0))
    d = df.withColumn("w_final", w)
    # sums per period are joined back: a window would bring a whole period into one task
    per = d.groupBy(*[F.col(c).alias(f"_k_{c}") for c in period]).agg(F.sum("w_final").alias("_t"), F.count("*").alias("_n"))
    on = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in period]
    return d.join(F.broadcast(per), on).select(*d.columns, (F.col("w_final") / F.col("_t") * F.col("_n")).alias("w_normalized"))  # one row per period


def long_form(df: DataFrame, dims: Sequence[Dimension], keep: Sequence[str]) -> DataFrame:
    """One row per row and dimension: dimension, group_value (null values form their own group; Total for the whole)."""
    names = {c.upper(): c for c in df.columns}
    g = [F.struct(F.lit(d.name).alias("dimension"), (F.lit("Total") if d.variable is None else F.col(names[d.variable.upper()]).cast("string")).alias("group_value")) for d in dims]
    return df.select(*keep, F.explode(F.array(*g)).alias("_g")).select("_g.dimension", "_g.group_value", *keep)


def blocks(df: DataFrame, keys: Sequence[str], y: str, w: str) -> DataFrame:
    """Rows with one value combined: c rows, weight W, squared weight S2."""
    return df.groupBy(*keys, F.col(y).alias("y")).agg(F.count("*").alias("c"), F.sum(w).cast("double").alias("W"), F.sum(F.col(w) * F.col(w)).cast("double").alias("S2"))


def _placed(b: DataFrame, keys: Sequence[str]) -> DataFrame:
    return running(b, keys, "y", {"W": F.col("W"), "WY": F.col("W") * F.col("y")}).withColumn("mu", F.try_divide("TWY", "TW"))


def _lorenz() -> Column:
    """Sum over rows of w times the cumulated w y, ties in any order: W C + y (W^2 + S2) / 2."""
    before = F.col("CWY") - F.col("W") * F.col("y")
    return F.sum(F.col("W") * before + F.col("y") * (F.col("W") * F.col("W") + F.col("S2")) / 2)


def _gini(extra: Column | float = 0.0) -> Column:
    den = F.max("TW") * F.max("TWY")
    ok = (F.sum("c") >= 2) & (F.sum(F.when(F.col("y").isNull(), 1).otherwise(0)) == 0)
    return F.when(ok, 1 - 2 * F.try_divide(_lorenz(), den) + extra)


#: Aggregates over placed blocks, by kind of statistic. A new kind is a new entry.
BUILDERS: dict[str, Callable[[Statistic], Column]] = {
    "count": lambda s: F.sum("c"),
    "weight": lambda s: F.sum("W"),
    "mean": lambda s: F.max("mu"),
    "variance": lambda s: F.try_divide(F.sum(F.col("W") * F.pow(F.col("y") - F.col("mu"), 2)), F.max("TW")),
    "min": lambda s: F.min("y"),
    "max": lambda s: F.max("y"),
    # blocks come in the order of y: the first that reaches p has the least place; the last block always does
    "quantile": lambda s: F.min_by("y", F.when((F.try_divide("CW", "TW") >= s.p) | F.col("_end"), F.col("_place"))),
    "gini": lambda s: _gini(),
    "gini_standard": lambda s: _gini(F.try_divide(F.sum(F.col("S2") * F.col("y")), F.max("TW") * F.max("TWY"))),
}


def group_statistics(df: DataFrame, keys: Sequence[str], y: str, w: str, statistics: Sequence[Statistic] = tuple(STATISTICS)) -> DataFrame:
    """One row per keys (null keys form groups) with the statistics named."""
    d = _placed(blocks(df, keys, y, w), keys)
    return d.groupBy(*keys).agg(*[BUILDERS[s.kind](s).alias(s.name) for s in statistics])


def all_dimensions(df: DataFrame, dims: Sequence[Dimension], y: str, w: str, period: Sequence[str] = ("annee", "mois"), extra: Sequence[str] = (), statistics: Sequence[Statistic] = tuple(STATISTICS)) -> DataFrame:
    """Statistics of every dimension per period, in long form; extra: further keys, as imputation_id."""
    keys = [*extra, *KEYS, *period]
    return group_statistics(long_form(df, dims, [*extra, *period, y, w]), keys, y, w, statistics)


def publishable(stats: DataFrame, dims: Sequence[Dimension], weight: str = "n_weighted") -> DataFrame:
    """Cells with at least their dimension's least weighted count; the national cell always."""
    ok = F.lit(False)
    for d in dims:
        ok = F.when(F.col("dimension") == d.name, F.lit(True) if d.variable is None else F.col(weight) >= d.least).otherwise(ok)
    return stats.where(ok)


def suppress(stats: DataFrame, least: float = 30, weight: str = "n_weighted") -> DataFrame:
    """Cells of any dimension with at least that weighted count."""
    return stats.where(F.col(weight) >= least)


def winsorise(df: DataFrame, keys: Sequence[str], y: str, p: float = 0.01) -> DataFrame:
    """y clamped in its group to the quantiles p and 1 - p (linear between values); null stays null."""
    q = percentiles(df, y, (p, 1 - p), keys, "_q").withColumnsRenamed({k: f"_k_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    clamped = F.when(F.col(y).isNotNull(), F.greatest(F.col("_q")[0], F.least(F.col("_q")[1], F.col(y))))
    return df.join(q, on, "left").select(*[clamped.alias(y) if c == y else F.col(c) for c in df.columns])


REPORT = [
    Statistic("N", "count", "N"), Statistic("N_weighted", "weight", "N_weighted"), Statistic("Min", "min", "Min"), Statistic("Q1", "quantile", "Q1", 0.25), Statistic("Mediane", "quantile", "Mediane", 0.5),
    Statistic("Moyenne", "mean", "Moyenne"), Statistic("Q3", "quantile", "Q3", 0.75), Statistic("Max", "max", "Max"),
]


def report_rows(df: DataFrame, y: str, keys: Sequence[str]) -> DataFrame:
    """Rows with a value and without null among the keys; NaN is a value here."""
    return df.where(F.col(y).isNotNull()).dropna(subset=list(keys))


def report(df: DataFrame, group: str, y: str, w: str, period: Sequence[str] = ("annee", "mois"), p: float = 0.01) -> DataFrame:
    """Report statistics of winsorised values, in long form: groupe, periods, statistique, valeur. Rows with a null wage,
    group or period are left out."""
    keys = [group, *period]
    d = winsorise(report_rows(df, y, keys).dropna(subset=[y]), keys, y, p)
    s = group_statistics(d, keys, y, w, REPORT)
    wide = s.select(F.col(group).alias("groupe"), *period, *[F.col(x.name).cast("double").alias(x.name) for x in REPORT])
    return wide.unpivot(["groupe", *period], [x.name for x in REPORT], "statistique", "valeur")


def report_table(long: DataFrame, periods: Sequence[tuple[int, int]], period: tuple[str, str] = ("annee", "mois")) -> DataFrame:
    """One column per period, named ANNEE_MOIS without padding, ordered by group and statistic."""
    name = F.concat_ws("_", F.col(period[0]).cast("string"), F.col(period[1]).cast("string"))
    wide = long.withColumn("_p", name).groupBy("groupe", "statistique").pivot("_p", [f"{a}_{m}" for a, m in periods]).agg(F.max("valeur"))
    return wide.orderBy("groupe", "statistique")


def mean_filtered(y: Column, w: Column) -> Column:
    """The mean over the weights of rows with a value, as an aggregate."""
    return F.try_divide(F.sum(w * y), F.sum(F.when(y.isNotNull(), w)))
