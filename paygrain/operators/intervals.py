"""Variances, bootstrap, extremes, combination of imputations (AGG-13 to AGG-19, MTH-03)."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.mathx import normal_quantile, student_quantile
from ..session import materialise
from .ranks import running
from .stats import blocks


def mean_with_variance(df: DataFrame, keys: Sequence[str], y: str, w: str, alpha: float = 0.05) -> DataFrame:
    """keys, n, sum_w, mean, variance, se, ci_lower, ci_upper: variance of the weighted mean, sum(w^2 (y - mean)^2) /
    (sum w)^2, times n / (n - 1) for more than one row. Rows with a null value or weight are left out."""
    b = blocks(df.dropna(subset=[y, w]), keys, y, w)
    # the means are joined back: a window would bring a whole group into one task
    b = materialise(b, "variance-blocks")
    mu = b.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.try_divide(F.sum(F.col("W") * F.col("y")), F.sum("W")).alias("mu"))
    b = b.join(mu, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]).drop(*[f"_k_{k}" for k in keys])
    s = b.groupBy(*keys).agg(F.sum("c").alias("n"), F.sum("W").alias("sum_w"), F.max("mu").alias("mean"), F.sum(F.col("S2") * F.pow(F.col("y") - F.col("mu"), 2)).alias("_v"))
    v = F.try_divide(F.col("_v"), F.col("sum_w") * F.col("sum_w"))
    s = s.withColumn("variance", F.when(F.col("n") > 1, v * F.col("n") / (F.col("n") - 1)).otherwise(v)).withColumn("se", F.sqrt("variance")).drop("_v")
    z = normal_quantile(1 - alpha / 2)
    return s.withColumn("ci_lower", F.col("mean") - z * F.col("se")).withColumn("ci_upper", F.col("mean") + z * F.col("se"))


def extremes(df: DataFrame, keys: Sequence[str], y: str, k: int = 5) -> DataFrame:
    """keys, min, min_range, max, max_range: extremes and the spread of the k values nearest to each."""
    d = df.where(F.col(y).isNotNull()).select(*keys, F.col(y).alias("y"))
    lo = d.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy("y"))).where(F.col("_r") <= k)
    hi = d.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("y")))).where(F.col("_r") <= k)
    a = lo.groupBy(*keys).agg(F.min("y").alias("min"), (F.max("y") - F.min("y")).alias("min_range"))
    b = hi.groupBy(*keys).agg(F.max("y").alias("max"), (F.max("y") - F.min("y")).alias("max_range"))
    b = b.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    return a.join(b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]).select(*keys, "min", "min_range", "max", "max_range")


#: Value blocks of a group that one Python call takes.
CHUNK = 20_000


def _draws(seed: int, key: tuple, chunk: int, c, w, replicates: int):
    """Drawn weights of a chunk's blocks, blocks by replicates: Poisson multiplicities of its rows times their mean weight.
    The same arguments draw the same numbers."""
    import zlib

    import numpy as np

    rng = np.random.default_rng([seed, zlib.crc32(repr(key).encode()), chunk])
    return rng.poisson(c[:, None], (len(c), replicates)) * (w / c)[:, None]


def bootstrap_quantiles(df: DataFrame, keys: Sequence[str], y: str, w: str, ps: dict[str, float], replicates: int = 200, seed: int = 1, least: int = 10, chunk: int = CHUNK) -> DataFrame:
    """keys, statistique, estimate, se: standard errors from Poisson replicates of a group's value blocks.

    A replicate draws each block's multiplicity from a Poisson law with mean c, as resampling rows does for large groups;
    so the work is the number of distinct values of a group, in vectors of `replicates`. Fewer than `least` rows: se null.
    The seed and the key give each group its own, repeatable stream.

    A group is worked in chunks of `chunk` values in order. Each chunk's drawn sums come first; added up along the group
    they tell in which chunk a replicate's quantile lies, and that chunk, drawn again alike, gives its value."""
    import numpy as np

    names = list(ps)
    b = blocks(df.dropna(subset=[y, w]), keys, y, w).withColumn("y", F.col("y").cast("double"))
    d = running(b, keys, "y", {"W": F.col("W"), "c": F.col("c"), "k": F.lit(1)})
    d = d.select(*keys, "y", "c", "W", "CW", "TW", "Tc", F.floor((F.col("Ck") - 1) / chunk).cast("int").alias("_chunk"), "_end")
    point = d.groupBy(*keys).agg(F.max("Tc").alias("n"), *[F.min(F.when((F.try_divide("CW", "TW") >= p) | F.col("_end"), F.col("y"))).alias(n) for n, p in ps.items()])
    kinds = ", ".join(f"`{k}` {t}" for k, t in b.dtypes if k in keys)
    enough = materialise(d.where(F.col("Tc") >= least).select(*keys, "y", "c", "W", "_chunk"), "bootstrap-blocks")

    def summed(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("y")
        m = _draws(seed, key[:-1], int(key[-1]), g["c"].to_numpy(float), g["W"].to_numpy(float), replicates)
        return pd.DataFrame([[*key, np.cumsum(m, 0)[-1]]], columns=[*keys, "_chunk", "_sum"])

    def located(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("_chunk")
        after = np.cumsum(np.stack(g["_sum"].to_numpy()), 0)
        before = np.vstack([np.zeros(replicates), after[:-1]])
        total = after[-1]
        rows = []
        for i, at in enumerate(g["_chunk"]):
            here = [(total > 0) & (before[i] < p * total) & (after[i] >= p * total) for p in ps.values()]
            if np.any(here):
                rows.append([*key, int(at), before[i], total])
        return pd.DataFrame(rows, columns=[*keys, "_chunk", "_before", "_total"])

    def picked(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("y")
        v = g["y"].to_numpy(float)
        before, total = np.asarray(g["_before"].iloc[0], float), np.asarray(g["_total"].iloc[0], float)
        m = _draws(seed, key[:-1], int(key[-1]), g["c"].to_numpy(float), g["W"].to_numpy(float), replicates)
        cum = before + np.cumsum(m, 0)
        rows = []
        for n, p in ps.items():
            here = (total > 0) & (before < p * total) & (cum[-1] >= p * total)
            rows += [[*key[:-1], n, x] for x in v[(cum[:, here] < p * total[here]).sum(0)]]
        return pd.DataFrame(rows, columns=[*keys, "statistique", "_v"])

    sums = enough.groupBy(*keys, "_chunk").applyInPandas(summed, f"{kinds}, _chunk int, _sum array<double>")
    spots = sums.groupBy(*keys).applyInPandas(located, f"{kinds}, _chunk int, _before array<double>, _total array<double>")
    spots = spots.withColumnsRenamed({k: f"_k_{k}" for k in [*keys, "_chunk"]})
    here = enough.join(spots, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in [*keys, "_chunk"]]).drop(*[f"_k_{k}" for k in [*keys, "_chunk"]])
    values = here.groupBy(*keys, "_chunk").applyInPandas(picked, f"{kinds}, statistique string, _v double")
    se = values.groupBy(*keys, "statistique").agg(F.stddev_samp("_v").alias("se")).withColumnsRenamed({k: f"_k_{k}" for k in [*keys, "statistique"]})
    long = point.unpivot([*keys], names, "statistique", "estimate")
    return long.join(se, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in [*keys, "statistique"]], "left").select(*keys, "statistique", "estimate", "se")


def with_intervals(df: DataFrame, keys: Sequence[str], y: str, w: str, alpha: float = 0.05, replicates: int = 200, seed: int = 1) -> DataFrame:
    """keys, statistique, estimate, se, ci_lower, ci_upper for counts, mean, extremes and quantiles, in long form."""
    none = F.lit(None).cast("double")
    m = mean_with_variance(df, keys, y, w, alpha)
    long = lambda d, name, est, se=none: d.select(*keys, F.lit(name).alias("statistique"), F.col(est).cast("double").alias("estimate"), se.alias("se"))
    x = extremes(df.dropna(subset=[y, w]), keys, y)
    parts = [long(m, "n_obs", "n"), long(m, "n_weighted", "sum_w"), long(m, "mean", "mean", F.col("se")), long(x, "min", "min"), long(x, "max", "max")]
    parts.append(bootstrap_quantiles(df, keys, y, w, {"q1": 0.25, "median": 0.5, "q3": 0.75, "p10": 0.1, "p90": 0.9}, replicates, seed))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    z = normal_quantile(1 - alpha / 2)
    return out.withColumn("ci_lower", F.col("estimate") - z * F.col("se")).withColumn("ci_upper", F.col("estimate") + z * F.col("se"))


def rubin(df: DataFrame, keys: Sequence[str], estimate: str, variance: str | None = None) -> DataFrame:
    """keys, m, estimate, within, between, variance, se. Without variances the total is the variance between imputations;
    with them it is within + (1 + 1/m) between. One imputation has no variance between,
    none has null."""
    b = F.when(F.count(estimate) >= 1, F.coalesce(F.var_samp(estimate), F.lit(0.0)))
    out = df.groupBy(*keys).agg(F.count(estimate).alias("m"), F.avg(estimate).alias("estimate"), (F.avg(variance) if variance else F.lit(None).cast("double")).alias("within"), b.alias("between"))
    total = F.col("within") + (1 + 1 / F.col("m")) * F.col("between") if variance else F.col("between")
    return out.withColumn("variance", total).withColumn("se", F.sqrt("variance"))


def t_quantile(p: float, df_: Column) -> Column:
    @F.pandas_udf("double")
    def q(v: pd.Series) -> pd.Series:
        return v.map(lambda d: student_quantile(p, d) if d == d else float("nan"))

    return q(df_)


def rubin_extended(df: DataFrame, keys: Sequence[str], estimate: str, variance: str, alpha: float = 0.05) -> DataFrame:
    """rubin() with lambda, degrees of freedom (m - 1) / lambda^2 and a Student interval; normal where the imputations
    agree. One row per cell reaches the quantile function."""
    r = rubin(df, keys, estimate, variance)
    share = F.try_divide((1 + 1 / F.col("m")) * F.col("between"), F.col("variance"))
    r = r.withColumn("lambda", share).withColumn("df", F.when(F.col("between") > 0, (F.col("m") - 1) / F.pow("lambda", 2)))
    z = normal_quantile(1 - alpha / 2)
    r = r.withColumn("_q", F.coalesce(t_quantile(1 - alpha / 2, F.coalesce("df", F.lit(1e9))), F.lit(z)))
    return r.withColumn("ci_lower", F.col("estimate") - F.col("_q") * F.col("se")).withColumn("ci_upper", F.col("estimate") + F.col("_q") * F.col("se")).drop("_q")


def combine_dimensions(stats: DataFrame, names: Sequence[str], keys: Sequence[str], imputation: str = "imputation_id") -> DataFrame:
    """Long-form combination of the named statistics of all dimensions over imputations; group labels are kept."""
    long = stats.unpivot([imputation, *keys], list(names), "statistique", "valeur")
    return rubin(long, [*keys, "statistique"], "valeur")
