"""Audits and quality control (AGG-20 to AGG-24, AGG-27, FLT-09, SET-02 to SET-04, QC-01 to QC-07)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import file_period
from ..plans.catalog import Rule, missing_columns
from .ranks import percentiles


def distribution(df: DataFrame, column: str) -> DataFrame:
    """value, n, pct of all rows; null is a value."""
    g = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    total = g.agg(F.sum("n")).scalar()
    return g.select("value", "n", (F.col("n") * 100 / total).alias("pct"))


def fill_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """column, n, missing, pct_missing in one pass."""
    cols = list(columns or df.columns)
    one = df.agg(F.count("*").alias("_n"), *[F.sum(F.col(f"`{c}`").isNull().cast("bigint")).alias(c) for c in cols])
    long = one.unpivot("_n", cols, "column", "missing")
    return long.select("column", F.col("_n").alias("n"), F.coalesce("missing", F.lit(0)).alias("missing"), F.try_divide(F.col("missing") * 100.0, "_n").alias("pct_missing"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """n, n_distinct, duplicates."""
    n = df.groupBy(*df.columns).agg(F.count("*").alias("_c"))
    return n.agg(F.coalesce(F.sum("_c"), F.lit(0)).alias("n"), F.count("*").alias("n_distinct")).withColumn("duplicates", F.col("n") - F.col("n_distinct"))


def key_uniqueness(df: DataFrame, column: str) -> DataFrame:
    """nb_unique without null; nb_doublons with null as one value."""
    g = df.groupBy(F.col(column).alias("k")).agg(F.count("*").alias("c"))
    return g.agg(F.count("k").alias("nb_unique"), (F.coalesce(F.sum("c"), F.lit(0)) - F.count("*")).alias("nb_doublons"))


def outliers(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), factor: float = 1.5) -> DataFrame:
    """by, column, q1, q3, lower, upper, n, outliers, pct of all rows, after whole-row copies are dropped. Quartiles are
    linear between values; null values are no outliers."""
    d = df.select(*by, *columns).distinct() if not by and len(columns) == len(df.columns) else df.distinct().select(*by, *columns)
    names = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns])).alias("_x")
    long = d.select(*by, names).select(*by, "_x.column", "_x.v")
    # equal values are combined first: the quartiles come from counts
    c = long.groupBy(*by, "column", "v").agg(F.count("*").alias("n"))
    keys = [*by, "column"]
    cut = percentiles(c, "v", (0.25, 0.75), keys, count="n").withColumnsRenamed({k: f"_k_{k}" for k in keys})
    q = c.groupBy(*keys).agg(F.sum("n").alias("n")).join(cut, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], "left")
    q = q.select(*keys, F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3"), "n")
    iqr = F.col("q3") - F.col("q1")
    q = q.withColumn("lower", F.col("q1") - factor * iqr).withColumn("upper", F.col("q3") + factor * iqr)
    right = c.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "v", F.col("n").alias("_c"))
    j = q.join(right, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    out = F.sum(F.when((F.col("v") < F.col("lower")) | (F.col("v") > F.col("upper")), F.col("_c")).otherwise(0))
    g = j.groupBy(*keys, "q1", "q3", "lower", "upper", "n").agg(out.alias("outliers"))
    return g.withColumn("pct", F.col("outliers") * 100.0 / F.col("n"))


def summary(df: DataFrame, column: str, distinct: Sequence[str] = ()) -> DataFrame:
    """min, q1, median, mean, q3, max, and distinct counts without null."""
    q = percentiles(df, column, (0.25, 0.5, 0.75)).scalar()
    return df.agg(
        F.min(column).alias("min"), q[0].alias("q1"), q[1].alias("median"), F.avg(column).alias("mean"), q[2].alias("q3"), F.max(column).alias("max"), *[F.count_distinct(c).alias(f"n_{c}") for c in distinct]
    )


def period_range(df: DataFrame, year: str = "annee", month: str = "mois") -> DataFrame:
    """One row: first and last year and month, and the range MM_YYYY-MM_YYYY."""
    at = F.struct(year, month)
    x = df.agg(F.min(at).alias("a"), F.max(at).alias("z"))
    side = lambda s: (F.col(f"{s}.{year}"), F.col(f"{s}.{month}"))
    names = [c.alias(f"{n}_{k}") for s, n in (("a", "first"), ("z", "last")) for c, k in zip(side(s), (year, month))]
    return x.select(*names, F.concat_ws("-", file_period(*side("a")), file_period(*side("z"))).alias("range"))


def top_values(df: DataFrame, column: str, k: int = 15) -> DataFrame:
    """The k most frequent values with their rows, null among them; ties in the order of the alphabet."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(k)


def check_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """rule, action, message, n_invalid, pct_invalid of all rows, in one pass; a predicate that is null counts as valid.
    Rules whose columns are absent are left out."""
    use = [r for r in rules if not missing_columns(df.columns, r.columns)]
    one = df.agg(F.count("*").alias("_n"), *[F.sum(F.when(~F.expr(r.predicate), 1).otherwise(0)).alias(r.name) for r in use])
    long = one.unpivot("_n", [r.name for r in use], "rule", "n_invalid")
    what = F.create_map(*[x for r in use for x in (F.lit(r.name), F.struct(F.lit(r.action).alias("action"), F.lit(r.message).alias("message")))])
    return long.select("rule", what[F.col("rule")]["action"].alias("action"), what[F.col("rule")]["message"].alias("message"), F.coalesce("n_invalid", F.lit(0)).alias("n_invalid"), F.try_divide(F.col("n_invalid") * 100.0, "_n").alias("pct_invalid"))


def exclude_invalid(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that break no rule whose action is exclude; a null predicate keeps the row."""
    for r in rules:
        if r.action == "exclude" and not missing_columns(df.columns, r.columns):
            df = df.where(F.coalesce(F.expr(r.predicate), F.lit(True)))
    return df


def check_derived(df: DataFrame) -> DataFrame:
    """Counts of negative ages and tenures, ages above 100, tenures above the age; one row."""
    have = set(df.columns)
    bad: list[Column] = []
    count = lambda c, name: F.sum(F.when(c, 1).otherwise(0)).alias(name)
    for c in ("age_employe", "anciennete_entreprise", "anciennete_immat", "age_entreprise_immat"):
        if c in have:
            bad.append(count(F.col(c) < 0, f"{c}_negative"))
    if "age_employe" in have:
        bad.append(count(F.col("age_employe") > 100, "age_above_100"))
        if "anciennete_entreprise" in have:
            bad.append(count(F.col("anciennete_entreprise") > F.col("age_employe"), "tenure_above_age"))
    return df.agg(F.count("*").alias("n"), *bad)


def schema_differences(frames: Sequence[tuple[str, DataFrame]]) -> list[dict]:
    """Per file after the first: missing, extra and retyped columns against the first file."""
    first = dict(frames[0][1].dtypes)
    out = []
    for name, df in frames[1:]:
        now = dict(df.dtypes)
        out.append(
            {
                "file": name,
                "missing": sorted(first.keys() - now.keys()),
                "extra": sorted(now.keys() - first.keys()),
                "retyped": sorted((c, first[c], now[c]) for c in first.keys() & now.keys() if first[c] != now[c]),
            }
        )
    return out


def validate_estimates(stats: DataFrame, least: float = 30, low: float = 5e4, high: float = 1e8) -> DataFrame:
    """Counts of small cells, means outside [low, high], quantiles out of order; one row."""
    count = lambda c, name: F.sum(F.when(c, 1).otherwise(0)).alias(name)
    return stats.agg(
        F.count("*").alias("n_cells"),
        count(F.col("n_weighted") < least, "small_cells"),
        count((F.col("mean") < low) | (F.col("mean") > high), "means_out_of_range"),
        count((F.col("q1") > F.col("median")) | (F.col("median") > F.col("q3")), "quantiles_out_of_order"),
    )


def dimension_availability(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """dimension, n_distinct, pct_missing."""
    aggs = [F.count("*").alias("_n")]
    for c in columns:
        aggs += [F.count_distinct(c).alias(f"d_{c}"), F.avg(F.col(c).isNull().cast("double")).alias(f"m_{c}")]
    one = df.agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(f"d_{c}").alias("n_distinct"), (F.col(f"m_{c}") * 100).alias("pct_missing")) for c in columns])).alias("_r")
    return one.select(rows).select("_r.*")


def base_checks(df: DataFrame, key: str = "obs_id", wage: str = "salaire_brut_mens") -> DataFrame:
    """Rows, repeated keys, wages missing, zero and negative."""
    g = df.groupBy(key).agg(F.count("*").alias("c"), F.sum(F.col(wage).isNull().cast("int")).alias("m"), F.sum((F.col(wage) == 0).cast("int")).alias("z"), F.sum((F.col(wage) < 0).cast("int")).alias("neg"))
    s = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return g.agg(s("c").alias("n"), (s("c") - F.count("*")).alias("repeated"), s("m").alias("wage_missing"), s("z").alias("wage_zero"), s("neg").alias("wage_negative"))


def audit_tables(spark_frames: Sequence[tuple[str, DataFrame]], ident: str, numbers: Sequence[str]) -> dict[str, DataFrame]:
    """The tables of an audit workbook over files given in their order: rows and copies, schema differences, fill rates,
    outliers, identifiers, one row or few per file. Files without the columns asked for are left out of that table."""
    spark = spark_frames[0][1].sparkSession
    name = lambda n, d: d.select(F.lit(n).alias("file"), "*")

    def stack(parts: list[DataFrame]) -> DataFrame | None:
        out = None
        for p in parts:
            out = p if out is None else out.unionByName(p)
        return out

    differs = [(x["file"], kind, str(c)) for x in schema_differences(spark_frames) for kind in ("missing", "extra", "retyped") for c in x[kind]]
    tables = {
        "copies": stack([name(n, duplicate_rows(d)) for n, d in spark_frames]),
        "schema": spark.createDataFrame(differs, "file string, change string, `column` string"),
        "fill": stack([name(n, fill_profile(d)) for n, d in spark_frames]),
        "outliers": stack([name(n, outliers(d, [c for c in numbers if c in d.columns])) for n, d in spark_frames if set(numbers) & set(d.columns)]),
        "identifiers": stack([name(n, key_uniqueness(d, ident)) for n, d in spark_frames if ident in d.columns]),
    }
    return {k: v for k, v in tables.items() if v is not None}
