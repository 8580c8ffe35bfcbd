"""Long to wide panels, dynamics, ordering of columns (RSH-01 to RSH-09, PRJ-06, WIN-09, JOI-13)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .clean import keep_first


def last_per_period(df: DataFrame, ident: str, period: str, order: Sequence[str]) -> DataFrame:
    """The last row by order of each (ident, period)."""
    return keep_first(df, [ident, period], order, last=True)


def wide_panel(df: DataFrame, ident: str, period: str, values: Sequence[str], periods: Sequence[str], order: Sequence[str], invariant: Sequence[str] = ()) -> DataFrame:
    """One row per ident with VAR_tPERIOD columns, the later row holding, and invariants from the first row. Columns come
    by period, then by variable."""
    at = F.struct(*order)
    d = df.where(F.col(ident).isNotNull())
    # one aggregation: the pivot's periods are given, so no pass is spent on finding them
    wide = d.groupBy(ident).agg(
        *[F.max_by(F.col(v), F.when(F.col(period) == p, at)).alias(f"{v}_t{p}") for p in periods for v in values],
        *[F.min_by(F.col(v), F.struct(F.col(period), *order)).alias(v) for v in invariant],
    )
    return wide.select(ident, *invariant, *[f"{v}_t{p}" for p in periods for v in values])


def numeric_dynamics(df: DataFrame, ident: str, period: str, value: str, periods: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per ident: change and growth_pct from the first to the last period of all (null if absent in either), mean, min,
    max, n_changes between known neighbours in time, n_obs."""
    d = last_per_period(df.select(ident, period, value, *[o for o in order if o not in (ident, period, value)]), ident, period, order)
    w = Window.partitionBy(ident).orderBy(period)
    place = F.array_position(F.array(*[F.lit(p) for p in periods]), F.col(period))
    d = d.withColumn("_i", place).withColumn("_b", F.lag(value).over(w)).withColumn("_j", F.lag("_i").over(w))
    first, last = F.max(F.when(F.col(period) == periods[0], F.col(value))), F.max(F.when(F.col(period) == periods[-1], F.col(value)))
    moved = (F.col(value) != F.col("_b")) & (F.col("_j") == F.col("_i") - 1)
    return d.groupBy(ident).agg(
        (last - first).alias(f"{value}_change"),
        (F.try_divide(last - first, first) * 100).alias(f"{value}_growth_pct"),
        F.avg(value).alias(f"{value}_mean"),
        F.min(value).alias(f"{value}_min"),
        F.max(value).alias(f"{value}_max"),
        F.sum(F.when(moved, 1).otherwise(0)).alias(f"{value}_n_changes"),
        F.count(value).alias(f"{value}_n_obs"),
    )


def categorical_dynamics(df: DataFrame, ident: str, period: str, value: str, periods: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per ident: first, last (of the first and last period of all), changed, mode (the smallest among equals), n_obs."""
    d = last_per_period(df.select(ident, period, value, *[o for o in order if o not in (ident, period, value)]), ident, period, order)
    c = d.groupBy(ident, value).agg(
        F.count(value).alias("_n"), F.max((F.col(period) == periods[0]).cast("int")).alias("_f"), F.max((F.col(period) == periods[-1]).cast("int")).alias("_l")
    )
    first, last = F.max(F.when(F.col("_f") == 1, F.col(value))), F.max(F.when(F.col("_l") == 1, F.col(value)))
    best = F.max(F.when(F.col(value).isNotNull(), F.col("_n")))
    g = c.groupBy(ident).agg(first.alias(f"{value}_first"), last.alias(f"{value}_last"), (first != last).alias(f"{value}_changed"), best.alias("_b"), F.sum("_n").alias(f"{value}_n_obs"))
    m = c.join(g.select(ident, F.col("_b").alias("_m")), ident).where((F.col("_n") == F.col("_m")) & F.col(value).isNotNull()).groupBy(ident).agg(F.min(value).alias(f"{value}_mode"))
    return g.drop("_b").join(m, ident, "left")


def order_columns(columns: Sequence[str], variables: Sequence[str], lead: Sequence[str] = ()) -> list[str]:
    """Lead columns, others, then VAR_tPERIOD columns by period and by the order of variables."""
    timed = {}
    for c in columns:
        v, _, p = c.rpartition("_t")
        if v in variables and p[:4].isdigit():
            timed[c] = (p, list(variables).index(v))
    rest = [c for c in columns if c not in timed and c not in lead]
    return [*[c for c in lead if c in columns], *rest, *sorted(timed, key=timed.__getitem__)]


def attach_invariants(df: DataFrame, invariants: DataFrame, ident: str, prefix: str = "") -> DataFrame:
    """Every row with its person's invariants, their names after the prefix; persons without any keep nulls."""
    right = invariants.withColumnsRenamed({c: f"{prefix}{c}" for c in invariants.columns if c != ident})
    return df.join(right, ident, "left")
