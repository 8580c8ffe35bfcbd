"""Running sums and order statistics of groups of any size, exact, without a group in one task.

Values are cut into ranges that follow their order, a sixteenth of an octave wide. Sums go over the ranges of a group
first - a few thousand at most, however many rows - then over the values within a range; a value's place is the sum of
the ranges before it and of what stands before it in its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

#: Ranges per octave, and the magnitude below which a value counts as zero.
PER_OCTAVE, LEAST = 16, 1e-12
_OFFSET = 40 * PER_OCTAVE + 1
LAST = 1 << 30


def range_of(y: Column) -> Column:
    """The range of a value: larger values never have a smaller one; NaN and null come last, as they sort."""
    x = y.cast("double")
    size = F.floor(F.log2(F.abs(x)) * PER_OCTAVE).cast("int") + _OFFSET
    return (
        F.when(x.isNull(), LAST)
        .when(F.isnan(x), LAST - 1)
        .when(F.abs(x) == float("inf"), F.signum(x).cast("int") * (LAST - 2))
        .when(F.abs(x) < LEAST, 0)
        .otherwise(F.when(x > 0, size).otherwise(-size))
    )


def running(blocks: DataFrame, keys: Sequence[str], y: str, sums: Mapping[str, Column]) -> DataFrame:
    """blocks (one row per keys and value) with, for each sum, C<name> up to and including the value and T<name> of its
    group, and _place, a struct that sorts as the values of a group do, and _end, whether it is the group's last. Null
    keys form groups. The blocks are written once, as the ranges and the values within them are both read from them."""
    d = materialise(blocks.withColumn("_cut", range_of(F.col(y))), "ranked-blocks")
    per = d.groupBy(*keys, "_cut").agg(*[F.sum(e).alias(n) for n, e in sums.items()])
    group = Window.partitionBy(*keys)
    before = group.orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    base = per.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_cut").alias("_kcut"), *[F.sum(n).over(before).alias(f"_b_{n}") for n in sums], *[F.sum(n).over(group).alias(f"T{n}") for n in sums], F.max("_cut").over(group).alias("_top")
    )
    at = Window.partitionBy(*keys, "_cut").orderBy(F.col(y).asc_nulls_last())
    inner = at.rowsBetween(Window.unboundedPreceding, 0)
    d = d.select("*", F.row_number().over(at).alias("_row"), *[F.sum(e).over(inner).alias(f"_i_{n}") for n, e in sums.items()])
    d = d.select("*", F.count("*").over(Window.partitionBy(*keys, "_cut")).alias("_rows"))
    on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys] + [F.col("_cut") == F.col("_kcut")]
    total = lambda n: F.when(F.col(f"_i_{n}").isNotNull() | F.col(f"_b_{n}").isNotNull(), F.coalesce(f"_i_{n}", F.lit(0)) + F.coalesce(f"_b_{n}", F.lit(0)))
    return d.join(base, on).select(
        *blocks.columns, *[total(n).alias(f"C{n}") for n in sums], *[F.col(f"T{n}") for n in sums], F.struct("_cut", "_row").alias("_place"), ((F.col("_cut") == F.col("_top")) & (F.col("_row") == F.col("_rows"))).alias("_end")
    )


def percentiles(df: DataFrame, column: str, ps: Sequence[float], keys: Sequence[str] = (), name: str = "q", count: str | None = None) -> DataFrame:
    """keys and an array of the percentiles, exact and linear between neighbours; nulls are left out. A group without
    values has no row; without keys there is one row, of nulls where there is no value. count: rows that a row stands for."""
    n = F.count("*") if count is None else F.sum(count)
    c = df.where(F.col(column).isNotNull()).groupBy(*keys, F.col(column).cast("double").alias("_y")).agg(n.alias("_n"))
    d = running(c, keys, "_y", {"n": F.col("_n")})

    def value(place: Column) -> Column:
        return F.min(F.when((F.col("Cn") - F.col("_n") <= place) & (place < F.col("Cn")), F.col("_y")))

    spot = lambda p: F.lit(float(p)) * (F.col("Tn") - 1)
    out = d.groupBy(*keys).agg(F.max("Tn").alias("Tn"), *[e.alias(f"_{i}_{s}") for i, p in enumerate(ps) for s, e in (("lo", value(F.floor(spot(p)))), ("hi", value(F.ceil(spot(p)))))])
    between = lambda i, p: F.col(f"_{i}_lo") + (F.col(f"_{i}_hi") - F.col(f"_{i}_lo")) * (spot(p) - F.floor(spot(p)))
    return out.select(*keys, F.array(*[between(i, p) for i, p in enumerate(ps)]).alias(name))
