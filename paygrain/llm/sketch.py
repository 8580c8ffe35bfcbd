"""Percentiles from signed logarithmic buckets that add up across partitions, days and groups.

A value v > 0 falls into bucket ceil(log_g v) with g = (1 + a) / (1 - a); the bucket's representative
2 g^i / (g + 1) lies within the relative error a of every value in it. Negative values use the mirrored index, zero its
own bucket. A sketch is the table (keys, sign, bucket, n, weight): two sketches merge by adding matching rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ERROR = 0.005


def gamma(error: float) -> float:
    return (1 + error) / (1 - error)


def bucket_of(v: Column, error: float = ERROR) -> Column:
    """Signed bucket as (order) integer: larger values have larger numbers, whatever their sign. Null for null, NaN and
    infinite values. Magnitudes under 1e-9 count as zero."""
    g = math.log(gamma(error))
    low = math.ceil(math.log(1e-9) / g)  # bucket of the smallest magnitude that isn't zero
    i = F.ceil(F.ln(F.abs(v)) / F.lit(g)).cast("int") - F.lit(low) + 1
    fin = v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    return F.when(fin, F.when(F.abs(v) < 1e-9, F.lit(0)).when(v > 0, i).otherwise(-i))


def value_of(b: Column, error: float = ERROR) -> Column:
    """A bucket's representative."""
    g = gamma(error)
    low = math.ceil(math.log(1e-9) / math.log(g))
    size = F.lit(2.0) * F.exp((F.abs(b) + F.lit(low - 1)) * F.lit(math.log(g))) / F.lit(g + 1.0)
    return F.when(b == 0, F.lit(0.0)).when(b > 0, size).otherwise(-size)


def build(df: DataFrame, keys: Sequence[str | Column], value: Column | str, weight: Column | str | None = None, error: float = ERROR) -> DataFrame:
    """Sketch of df per keys: (keys, bucket, n, weight). Rows with a null, NaN or infinite value are no measurements
    and are left out; a null, NaN or negative weight adds to n only. Null keys form a group of their own."""
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    w = F.lit(1.0) if weight is None else (F.col(weight) if isinstance(weight, str) else weight).cast("double")
    w = F.when(F.isnan(w) | (w < 0), None).otherwise(w)
    return (
        df.select(*keys, bucket_of(v, error).alias("bucket"), w.alias("_w"))
        .where("bucket IS NOT NULL")
        .groupBy(*_names(df, keys), "bucket")
        .agg(F.count("*").alias("n"), F.coalesce(F.sum("_w"), F.lit(0.0)).alias("weight"))
    )


def _names(df: DataFrame, keys: Sequence[str | Column]) -> list[str]:
    return df.select(*keys).columns if keys else []


def merge(a: DataFrame, b: DataFrame) -> DataFrame:
    """Sum of two sketches with the same keys and error."""
    return roll_up(a.unionByName(b), [c for c in a.columns if c not in ("bucket", "n", "weight")])


def roll_up(sketch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sketch of coarser keys, from its own rows."""
    return sketch.groupBy(*keys, "bucket").agg(F.sum("n").alias("n"), F.sum("weight").alias("weight"))


def percentiles(sketch: DataFrame, keys: Sequence[str], ps: dict[str, float], error: float = ERROR, weighted: bool = False) -> DataFrame:
    """One row per keys: n, weight and the percentiles named in ps, each within the relative error of the exact
    percentile (the smallest value whose cumulative count, or weight, reaches p of the total). Null where the total
    weight is not positive."""
    m = F.col("weight") if weighted else F.col("n").cast("double")
    w = Window.partitionBy(*keys)
    run = w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    # buckets of a group are bounded by the error, not by its rows
    t = sketch.withColumn("_c", F.sum(m).over(run)).withColumn("_t", F.sum(m).over(w))
    reach = lambda p: F.min(F.when((F.col("_t") > 0) & (F.col("_c") >= F.col("_t") * p - F.col("_t") * 1e-12), F.col("bucket")))
    out = t.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("weight").alias("weight"), *[reach(p).alias(name) for name, p in ps.items()])
    return out.select(*keys, "n", "weight", *[value_of(F.col(name), error).alias(name) for name in ps])


def both(sketch: DataFrame, keys: Sequence[str], ps: dict[str, float], error: float = ERROR) -> DataFrame:
    """Plain percentiles under their names and weighted ones with the ending _pond, from one pass over the sketch."""
    w = Window.partitionBy(*keys)
    run = w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    # the ordered windows come first: their sort serves the others
    t = sketch.select("*", F.sum("n").over(run).alias("_cn"), F.sum("weight").over(run).cast("double").alias("_cw"))
    t = t.select("*", F.sum("n").over(w).alias("_tn"), F.sum("weight").over(w).cast("double").alias("_tw"))
    # a relative slack takes up the rounding of running sums
    plain = {k: F.min(F.when(F.col("_cn") >= F.col("_tn") * (p - 1e-12), F.col("bucket"))) for k, p in ps.items()}
    heavy = {k: F.min(F.when((F.col("_tw") > 0) & (F.col("_cw") >= F.col("_tw") * (p - 1e-12)), F.col("bucket"))) for k, p in ps.items()}
    out = t.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("weight").cast("double").alias("poids"), *[e.alias(k) for k, e in plain.items()], *[e.alias(f"{k}_pond") for k, e in heavy.items()]
    )
    return out.select(*keys, "n", "poids", *[value_of(F.col(c), error).alias(c) for c in [*ps, *(f"{k}_pond" for k in ps)]])
