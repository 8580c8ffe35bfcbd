"""Models: declaration, weights, diagnostics, imputation (MOD-01 to MOD-13, WIN-12)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import RFormula
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression, LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.catalog import ModelSpec
from ..session import materialise
from .ranks import percentiles


@dataclass
class Fitted:
    """A fitted pipeline, the covariates it uses, those its spec names but the table lacks, and summary figures."""

    spec: ModelSpec
    model: PipelineModel | None
    used: list[str]
    dropped: list[str]
    figures: dict[str, float]
    constant: float | None = None


def usable_covariates(df: DataFrame, spec: ModelSpec) -> tuple[list[str], list[str]]:
    names = {c.upper(): c for c in df.columns}
    return [names[c.upper()] for c in spec.covariates if c.upper() in names], [c for c in spec.covariates if c.upper() not in names]


def fit_logit(df: DataFrame, spec: ModelSpec) -> Fitted:
    """Logistic regression on complete cases. An outcome of one class, or no covariate, gives that constant probability."""
    used, dropped = usable_covariates(df, spec)
    d = df.dropna(subset=[spec.outcome, *used])
    n, mean = d.agg(F.count("*"), F.avg(F.col(spec.outcome).cast("double"))).first()
    if not n or not used or mean in (0.0, 1.0):
        return Fitted(spec, None, used, dropped, {"n": float(n)}, float(mean if mean is not None else 0.0))
    form = RFormula(formula=f"{spec.outcome} ~ {' + '.join(used)}", handleInvalid="keep", featuresCol="_features", labelCol="_label")
    d = d.select(F.col(spec.outcome).cast("double").alias(spec.outcome), *used)
    form = form.fit(d)
    # every iteration reads the rows again: features are made once
    ready = materialise(form.transform(d).select("_features", "_label"), "model-features")
    glm = GeneralizedLinearRegression(family="binomial", link="logit", featuresCol="_features", labelCol="_label", predictionCol="_p", regParam=1e-6).fit(ready)
    return Fitted(spec, PipelineModel([form, glm]), used, dropped, {"n": float(n), "aic": float(glm.summary.aic)})


def predict(df: DataFrame, fitted: Fitted, name: str) -> DataFrame:
    """df with the prediction; null where a covariate is."""
    if fitted.model is None:
        return df.withColumn(name, F.lit(fitted.constant))
    known = F.lit(True)
    for c in fitted.used:
        known = known & F.col(c).isNotNull()
    # one pass: what a missing covariate makes of a prediction is dropped
    whole = fitted.model.transform(df).drop("_features", "_label")
    return whole.withColumn("_p", F.when(known, F.col("_p"))).withColumnRenamed("_p", name)


def probability_column(vector: str) -> Column:
    return vector_to_array(F.col(vector))[1]


def inverse_weights(df: DataFrame, p: str, weight: str = "w_jt", floor: float = 0.01, stabilise: bool = True, trim: tuple[float, float] = (0.01, 0.99), marginal: str = "before") -> DataFrame:
    """Weights from probabilities: null becomes the mean, then the floor; stabilised by the mean (taken before or after the
    floor), trimmed to its own quantiles (linear between values). The figures are scalar subqueries."""
    mean = df.agg(F.avg(p)).scalar()
    q = F.greatest(F.coalesce(F.col(p), mean), F.lit(floor))
    d = df.withColumn("_q", q).withColumn("_m", F.coalesce(F.col(p), mean))
    top = d.agg(F.avg("_m" if marginal == "before" else "_q")).scalar() if stabilise else F.lit(1.0)
    d = d.withColumn("_raw", top / F.col("_q"))
    cut = percentiles(d, "_raw", trim).scalar()
    d = d.withColumn("_cut", cut)
    return d.withColumn(weight, F.greatest(F.col("_cut")[0], F.least(F.col("_cut")[1], F.col("_raw")))).drop("_q", "_m", "_raw", "_cut")


def auc(df: DataFrame, score: str, outcome: str) -> DataFrame:
    """Area under the ROC curve, ties counted half, direction as it comes out above one half; one row. Equal scores are
    combined before they are ordered, and the running sums go over the distinct scores in ranges."""
    c = df.where(F.col(score).isNotNull() & F.col(outcome).isNotNull()).groupBy(F.col(score).alias("s")).agg(F.sum((F.col(outcome) == 1).cast("bigint")).alias("p"), F.sum((F.col(outcome) == 0).cast("bigint")).alias("n"))
    c = c.withColumn("b", F.floor(F.col("s") * 1000))
    by = c.groupBy("b").agg(F.sum("n").alias("bn"))
    by = by.withColumn("before", F.coalesce(F.sum("bn").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))  # at most 1,001 ranges of a probability
    w = Window.partitionBy("b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    d = c.join(F.broadcast(by), "b").withColumn("below", F.col("before") + F.coalesce(F.sum("n").over(w), F.lit(0)))
    a = d.agg((F.sum(F.col("p") * (F.col("below") + F.col("n") / 2)) / (F.sum("p") * F.sum("n"))).alias("a"), F.sum("p").alias("n_pos"), F.sum("n").alias("n_neg"))
    return a.select(F.greatest("a", 1 - F.col("a")).alias("auc"), "n_pos", "n_neg")


def calibration(df: DataFrame, score: str, outcome: str, bins: int = 10) -> DataFrame:
    """Quantile bins, right-closed, repeated breaks merged: bin, n, mean_score, mean_outcome."""
    d = df.where(F.col(score).isNotNull() & F.col(outcome).isNotNull()).select(F.col(score).cast("double").alias("s"), F.col(outcome).cast("double").alias("y"))
    cut = percentiles(d, "s", [i / bins for i in range(1, bins)]).select(F.array_distinct("q")).scalar()
    b = d.withColumn("_b", cut)
    return b.groupBy((F.size(F.filter("_b", lambda x: x < F.col("s"))) + 1).alias("bin")).agg(F.count("*").alias("n"), F.avg("s").alias("mean_score"), F.avg("y").alias("mean_outcome"))


def calibration_line(cal: DataFrame) -> DataFrame:
    return cal.agg(F.regr_slope("mean_outcome", "mean_score").alias("slope"), F.regr_intercept("mean_outcome", "mean_score").alias("intercept"))


def confusion(df: DataFrame, score: str, outcome: str, thresholds: Sequence[float] = (0.3, 0.4, 0.5, 0.6, 0.7)) -> DataFrame:
    """threshold, tp, fp, tn, fn, accuracy, sensitivity, specificity - one pass for all thresholds."""
    d = df.where(F.col(score).isNotNull() & F.col(outcome).isNotNull())
    count = lambda c: F.sum(F.when(c, 1).otherwise(0))
    pos = F.col(outcome) == 1
    one = d.agg(
        *[F.struct(F.lit(t).alias("threshold"), count((F.col(score) >= t) & pos).alias("tp"), count((F.col(score) >= t) & ~pos).alias("fp"), count((F.col(score) < t) & ~pos).alias("tn"), count((F.col(score) < t) & pos).alias("fn")).alias(f"t{i}") for i, t in enumerate(thresholds)]
    )
    r = one.select(F.explode(F.array(*[f"t{i}" for i in range(len(thresholds))])).alias("r")).select("r.*")
    return r.withColumns(
        {
            "accuracy": F.try_divide(F.col("tp") + F.col("tn"), F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")),
            "sensitivity": F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")),
            "specificity": F.try_divide(F.col("tn"), F.col("tn") + F.col("fp")),
        }
    )


def brier(df: DataFrame, score: str, outcome: str) -> DataFrame:
    return df.agg(F.avg(F.pow(F.col(score) - F.col(outcome), 2)).alias("brier"))


def fit_linear(df: DataFrame, spec: ModelSpec) -> Fitted:
    """Least squares on complete cases; sigma with residual degrees of freedom, R2, adjusted R2, RMSE, MAE, AIC, BIC."""
    import math

    used, dropped = usable_covariates(df, spec)
    d = df.dropna(subset=[spec.outcome, *used])
    form = RFormula(formula=f"{spec.outcome} ~ {' + '.join(used) or '1'}", handleInvalid="keep", featuresCol="_features", labelCol="_label")
    m = Pipeline(stages=[form, LinearRegression(solver="normal", featuresCol="_features", labelCol="_label", predictionCol="_p", regParam=1e-9)]).fit(d)
    s = m.stages[-1].summary
    n, k = s.numInstances, len(m.stages[-1].coefficients) + 1
    rss = s.meanSquaredError * n
    loglik = -n / 2 * (math.log(2 * math.pi * max(rss / n, 1e-300)) + 1)
    figures = {"n": float(n), "r2": s.r2, "r2adj": s.r2adj, "rmse": s.rootMeanSquaredError, "mae": s.meanAbsoluteError, "sigma": math.sqrt(rss / max(n - k, 1)), "aic": -2 * loglik + 2 * (k + 1), "bic": -2 * loglik + math.log(n) * (k + 1)}
    return Fitted(spec, m, used, dropped, figures)


def residual_statistics(df: DataFrame, fitted: Fitted) -> DataFrame:
    """One row: mean, sd, min, max, q25, q75 of outcome less prediction on complete cases."""
    r = predict(df, fitted, "_hat").select((F.col(fitted.spec.outcome) - F.col("_hat")).alias("_r")).where("_r IS NOT NULL")
    q = percentiles(r, "_r", (0.25, 0.75)).scalar()
    return r.agg(F.avg("_r").alias("mean"), F.stddev_samp("_r").alias("sd"), F.min("_r").alias("min"), F.max("_r").alias("max"), q[0].alias("q25"), q[1].alias("q75"))


def impute(df: DataFrame, fitted: Fitted, key: Sequence[str], times: int = 5, seed: int = 1) -> DataFrame:
    """`times` stacked copies of df tagged imputation_id, the predicted log wage plus a normal residual. The residual
    comes from a hash of seed, key and copy, so a lost partition is recomputed with the same values."""
    d = predict(df, fitted, "_mu").where("_mu IS NOT NULL").withColumn("imputation_id", F.explode(F.sequence(F.lit(1), F.lit(times))))
    return d.withColumn("log_imputed", F.col("_mu") + F.lit(fitted.figures.get("sigma", 0.0)) * hashed_normal(seed, *key, "imputation_id")).withColumn("imputed", F.expm1("log_imputed")).drop("_mu")


def hashed_normal(seed: int, *key: str) -> Column:
    """A standard normal number that depends on the seed and key alone (Box-Muller on two hashes)."""
    unit = lambda salt: (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(salt), *key), 11) + F.lit(1)) / F.lit(float(2**53 + 1))
    return F.sqrt(-2 * F.ln(unit(1))) * F.cos(2 * F.pi() * unit(2))


def stack_imputations(individual: DataFrame, imputed: DataFrame, keys: Sequence[str], wage: str, value: str = "imputed", pseudo_rows: bool = True) -> DataFrame:
    """Individuals once per imputation, missing wages filled from the imputation of their employer-month. pseudo_rows:
    imputed employer-months without individuals come in as rows of their own, so that imputations differ; without, the
    copies are as the joined rows leave them."""
    ids = sorted(r[0] for r in imputed.select("imputation_id").distinct().collect())  # the number of imputations
    base = individual.withColumn("imputation_id", F.explode(F.array(*[F.lit(i) for i in ids]))) if ids else individual.withColumn("imputation_id", F.lit(0)).where("false")
    i = imputed.select(*keys, "imputation_id", F.col(value).alias("_v"))
    d = base.join(i, [*keys, "imputation_id"], "left").withColumn(wage, F.coalesce(wage, "_v")).drop("_v")
    if not pseudo_rows:
        return d
    seen = individual.select(*keys).distinct()
    extra = i.join(seen, list(keys), "left_anti").withColumnRenamed("_v", wage)
    return d.unionByName(extra, allowMissingColumns=True)


def gate(figures: dict[str, float], auc_least: float = 0.6, slope: tuple[float, float] = (0.8, 1.2), n_least: int = 100) -> list[str]:
    """What speaks against using a model; empty if nothing does."""
    out = []
    if "auc" in figures and figures["auc"] < auc_least:
        out.append(f"auc {figures['auc']:.3f} is under {auc_least}")
    if "slope" in figures and not slope[0] <= figures["slope"] <= slope[1]:
        out.append(f"calibration slope {figures['slope']:.3f} is outside {slope}")
    if "n" in figures and figures["n"] < n_least:
        out.append(f"{figures['n']:.0f} rows are fewer than {n_least}")
    return out
