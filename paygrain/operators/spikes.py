"""Implausible readings: tail cutoffs per source, stuck durations, plausibility bounds.

Three judgements of a measurement:

* tail: extreme-value fitting over a threshold. The residual of a value is its log ratio to the series' own median,
  less the source's calendar-month effect. Absolute residuals of a source above their 90 % point, without those beyond
  the plausible ratio, are fitted with a generalised Pareto law by probability-weighted moments; the value exceeded with
  the fixed risk is the source's cutoff. Sources with few exceedances use the fit over all sources.
* stuck: runs of one repeated value in a series, and periods in which all series of a source agree, unless repeats are
  normal for that source.
* plausibility: signs and physical bounds.

A series is one worker at one employer, a source is an employer. Hot sources, series or copies never meet in one task:
copies are combined map-side before the series is ordered, and everything about a source is computed from
residual histograms whose size does not depend on the number of rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise


@dataclass(frozen=True)
class SpikeRules:
    """risk: share of normal values a source's cutoff may catch. ratio: beyond this multiple or part of the series'
    median a value is implausible whatever the fit, so a cutoff is never looser. least: months with a value that a
    series needs. run, group: sizes of stuck runs and of agreeing groups. repeats: share of unchanged steps from which
    repeats are normal. width: of a residual bucket. tail: quantile above which the tail is fitted. few: exceedances
    below which the common fit holds."""

    fields: tuple[str, ...] = ("salaire_brut", "duree_travaillee")
    grouped: tuple[str, ...] = ("salaire_brut",)
    risk: float = 1e-3
    ratio: float = 3.0
    least: int = 5
    run: int = 5
    group: int = 5
    repeats: float = 0.25
    width: float = 0.05
    tail: float = 0.9
    few: int = 12
    most_days: float = 31.0
    most_hours: float = 744.0


def employer_key(c: Column | str) -> Column:
    """Employer number without blanks and without a trailing .0; empty is null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.regexp_replace(F.regexp_replace(c.cast("string"), r"\s", ""), r"\.0$", ""), F.lit(""))


def _value(c: Column) -> Column:
    """Null, NaN and zero are no readings."""
    c = c.cast("double")
    return F.when(F.isnan(c) | (c == 0), None).otherwise(c)


def readings(decl: DataFrame, rules: SpikeRules = SpikeRules()) -> DataFrame:
    """The declared lines with their keys normalised; other columns are left behind."""
    return decl.select(
        "ligne_id",
        employer_key("numero_employeur").alias("source"),
        F.nullif(F.trim("id_indiv"), F.lit("")).alias("worker"),
        F.nullif(F.upper(F.trim("type_salarie")), F.lit("")).alias("kind"),
        (F.col("annee") * 12 + F.col("mois") - 1).alias("month"),
        *[_value(F.col(f)).alias(f) for f in rules.fields],
    )


def _longer(df: DataFrame, keys: list[str], fields: tuple[str, ...]) -> DataFrame:
    return df.select(
        *keys, F.explode(F.array(*[F.struct(F.lit(f).alias("champ"), F.col(f).alias("v")) for f in fields])).alias("_x")
    ).select(*keys, "_x.champ", "_x.v").where("v IS NOT NULL")


def series(lines: DataFrame, rules: SpikeRules = SpikeRules()) -> DataFrame:
    """One row per (source, worker, field, month) with a value: v, the series' n and median, whether v sits in a run of
    rules.run equal values, and whether the step to it left the field unchanged (null at the first)."""
    known = lines.where("worker IS NOT NULL AND source IS NOT NULL AND month IS NOT NULL")
    # copies of a month's line meet here, combined map-side; the copy with the highest ligne_id holds
    month = known.groupBy("source", "worker", "month").agg(*[F.max(F.when(F.col(f).isNotNull(), F.struct("ligne_id", f)))[f].alias(f) for f in rules.fields])
    long = _longer(month, ["source", "worker", "month"], rules.fields)
    w = Window.partitionBy("source", "worker", "champ").orderBy("month")
    whole = Window.partitionBy("source", "worker", "champ")
    back, ahead = F.lit(0), F.lit(0)
    for k in range(rules.run - 1, 0, -1):  # equal neighbours in a row, looked at no farther than a run is long
        back = F.when(F.lag("v", k).over(w) == F.col("v"), back + 1).otherwise(0)
        ahead = F.when(F.lead("v", k).over(w) == F.col("v"), ahead + 1).otherwise(0)
    # the ordered windows come first: their sort serves the others
    placed = long.select("*", (back + ahead + 1 >= rules.run).alias("stuck"), (F.lag("v", 1).over(w) == F.col("v")).alias("same"))
    return placed.select("*", F.count("*").over(whole).alias("n"), F.percentile("v", 0.5).over(whole).alias("med"))


def residual_ratio(v: Column, med: Column) -> Column:
    return F.ln(v / med)


def tail_cutoffs(ser: DataFrame, rules: SpikeRules = SpikeRules()) -> DataFrame:
    """(source, champ, cal, season, n, threshold, shape, scale, cutoff): calendar-month effect and tail cutoff on the
    absolute residual. Histogram rows of a source are bounded by the bucket width, not by its rows."""
    top = math.log(rules.ratio)
    r = residual_ratio(F.col("v"), F.col("med"))
    hist = (
        ser.where((F.col("n") >= rules.least) & (F.col("v") > 0) & (F.col("med") > 0))
        .groupBy("source", "champ", F.pmod("month", F.lit(12)).alias("cal"), F.floor(r / rules.width).alias("b"))
        .agg(F.count("*").alias("c"))
    )
    # read for the seasons, for each source's tail and for the common one
    hist = materialise(hist, "spike-residuals").withColumn("r", (F.col("b") + 0.5) * rules.width)
    by_cal = Window.partitionBy("source", "champ", "cal")
    clipped = F.greatest(F.lit(-top), F.least(F.lit(top), F.col("r")))
    # shrunk towards no effect: five values' worth
    hist = hist.withColumn("season", F.sum(F.col("c") * clipped).over(by_cal) / (F.sum("c").over(by_cal) + 5))
    seasons = hist.groupBy("source", "champ", "cal").agg(F.first("season").alias("season"))
    eb = F.floor(F.abs(F.col("r") - F.col("season")) / rules.width)
    # what is implausible by its ratio alone says nothing of the source's normal tail
    normal = hist.where(F.abs("r") < top)
    per_source = normal.groupBy("source", "champ", eb.alias("e")).agg(F.sum("c").alias("c"))
    common = per_source.groupBy("champ", "e").agg(F.sum("c").alias("c"))
    own = _pareto(per_source, ["source", "champ"], rules)
    shared = _pareto(common, ["champ"], rules).select("champ", F.col("cutoff").alias("common_cutoff"))
    cut = own.join(F.broadcast(shared), "champ", "left")  # one row per field
    z = F.when((F.col("exceed") >= rules.few) & F.col("cutoff").isNotNull(), F.col("cutoff")).otherwise(F.col("common_cutoff"))
    out = seasons.join(cut.withColumn("cutoff", z).drop("common_cutoff"), ["source", "champ"], "left")
    # a value beyond the plausible ratio of its median has a residual of at least ln(ratio) - |season|
    return out.withColumn("cutoff", F.least(F.coalesce("cutoff", F.lit(top)), F.lit(top) - F.abs("season")) - 1e-9)


def _pareto(hist: DataFrame, keys: list[str], rules: SpikeRules) -> DataFrame:
    """Generalised Pareto fit by probability-weighted moments on a histogram of (keys, e, c)."""
    w = Window.partitionBy(*keys)
    up = w.orderBy("e").rowsBetween(Window.unboundedPreceding, 0)
    h = hist.withColumn("n", F.sum("c").over(w)).withColumn("cum", F.sum("c").over(up))
    h = h.withColumn("u", F.min(F.when(F.col("cum") >= rules.tail * F.col("n"), (F.col("e") + 1) * rules.width)).over(w))
    over = h.where((F.col("e") + 0.5) * rules.width > F.col("u"))
    x = (F.col("e") + 0.5) * rules.width - F.col("u")
    # ranks of a bucket's values lie between cum - c and cum among all n; those above the threshold start at n - exceed
    below = F.col("n") - F.sum("c").over(w)
    over = over.withColumn("exceed", F.sum("c").over(w)).withColumn(
        "p", (F.col("cum") - F.col("c") / 2 - (F.col("n") - F.col("exceed"))) / F.col("exceed")
    )
    fit = over.groupBy(*keys).agg(
        F.first("n").alias("n"),
        F.first("u").alias("threshold"),
        F.first("exceed").alias("exceed"),
        (F.sum(x * F.col("c")) / F.first("exceed")).alias("a0"),
        (F.sum(x * F.col("c") * (1 - F.col("p"))) / F.first("exceed")).alias("a1"),
    )
    d = F.col("a0") - 2 * F.col("a1")
    shape = F.greatest(F.lit(-0.5), F.least(F.lit(0.9), 2 - F.try_divide(F.col("a0"), d)))
    scale = F.greatest(F.lit(1e-6), F.try_divide(2 * F.col("a0") * F.col("a1"), d))
    rest = F.col("exceed") / F.col("n") / rules.risk
    grown = F.when(F.abs("shape") < 1e-6, F.ln(rest)).otherwise((F.pow(rest, F.col("shape")) - 1) / F.col("shape"))
    return (
        fit.withColumn("shape", shape)
        .withColumn("scale", scale)
        .select(*keys, "n", "exceed", "threshold", "shape", "scale", (F.col("threshold") + F.col("scale") * grown).alias("cutoff"))
    )


def by_month(ser: DataFrame) -> DataFrame:
    """(source, champ, month): values, least and most of them, steps into the month and how many leave the field unchanged."""
    return ser.groupBy("source", "champ", "month").agg(
        F.count("*").alias("values"), F.min("v").alias("least"), F.max("v").alias("most"), F.count("same").alias("steps"), F.sum(F.col("same").cast("bigint")).alias("unchanged")
    )


def normal_repeats(months: DataFrame, rules: SpikeRules = SpikeRules()) -> DataFrame:
    """(source, champ) for which stuck values are worth a flag: under rules.repeats of all steps leave the field unchanged."""
    share = F.sum("unchanged").cast("double") / F.sum("steps")
    return months.groupBy("source", "champ").agg(share.alias("share")).where(F.col("share") < rules.repeats).select("source", "champ")


def flag_spikes(decl: DataFrame, rules: SpikeRules = SpikeRules()) -> DataFrame:
    """Every flagged value: (ligne_id, champ, valeur, regle, med, n, residual, cutoff).

    regle: `bound` (sign or physical bound), `tail` (residual beyond the source's cutoff), `stuck` (run of one value)
    or `agreed` (all workers of the source have one value in a month). A value may have several rows.

    Null, NaN and zero values are never flagged and are skipped in comparisons. Copies of a month's line count once in
    comparisons, each is flagged. Lines without a worker or source are judged by bounds only. Empty input gives no row.
    """
    lines = readings(decl, rules)
    ser = materialise(series(lines, rules), "spike-series", tight=True)

    # everything that a value is held against, one row per source, field and month: a single join brings it to the values
    months = materialise(by_month(ser), "spike-months").withColumn("cal", F.pmod("month", F.lit(12)))
    rare = normal_repeats(months, rules).withColumn("rare", F.lit(True))
    one_value = F.col("champ").isin(*rules.grouped) & (F.col("values") >= rules.group) & (F.col("least") == F.col("most"))
    known = months.join(tail_cutoffs(ser, rules).select("source", "champ", "cal", "season", "cutoff"), ["source", "champ", "cal"], "left").join(rare, ["source", "champ"], "left")
    known = known.select("source", "champ", "month", "season", "cutoff", F.coalesce("rare", F.lit(False)).alias("rare"), (one_value & F.coalesce("rare", F.lit(False))).alias("agreed"))
    d = ser.join(known, ["source", "champ", "month"])
    # a value of the other sign has no log ratio and lies beyond any cutoff
    d = d.withColumn("residual", F.when((F.col("v") > 0) & (F.col("med") > 0), residual_ratio(F.col("v"), F.col("med")) - F.coalesce("season", F.lit(0.0))))
    far = (F.col("v") < 0) | (F.abs("residual") >= F.coalesce("cutoff", F.lit(math.log(rules.ratio) - 1e-9)))
    tail = F.coalesce((F.col("n") >= rules.least) & (F.col("med") > 0) & far, F.lit(False))
    rules_met = F.filter(F.array(F.when(tail, "tail"), F.when(F.col("stuck") & F.col("rare"), "stuck"), F.when(F.col("agreed"), "agreed")), lambda x: x.isNotNull())
    keyed = d.select("source", "worker", "champ", "month", "med", "n", "residual", "cutoff", F.explode(rules_met).alias("regle"))
    of_tail = lambda c: F.when(F.col("regle") == "tail", F.col(c)).alias(c)
    keyed = keyed.select("source", "worker", "champ", "month", "regle", "med", "n", of_tail("residual"), of_tail("cutoff"))
    # back to every copy of the line; both sides are hashed on the whole key, a hot one is split by adaptive execution
    long = _longer(lines.where("worker IS NOT NULL AND source IS NOT NULL"), ["ligne_id", "source", "worker", "month"], rules.fields)
    by_key = long.join(keyed, ["source", "worker", "champ", "month"]).select(
        "ligne_id", "champ", F.col("v").alias("valeur"), "regle", "med", "n", "residual", "cutoff"
    )
    return by_key.unionByName(_bounds(lines, rules), allowMissingColumns=True)


def _bounds(lines: DataFrame, rules: SpikeRules) -> DataFrame:
    """Negative values, durations beyond a day count or an hour count; a line without type follows its source's mode."""
    long = _longer(lines, ["ligne_id", "source", "kind"], rules.fields)
    sure = (F.col("v") < 0) | (
        (F.col("champ") == "duree_travaillee")
        & ((F.col("v") > rules.most_hours) | ((F.col("v") > rules.most_days) & F.coalesce(F.col("kind").isin("M", "J"), F.lit(False))))
    )
    open_ = long.where(~sure & F.col("kind").isNull() & (F.col("champ") == "duree_travaillee") & (F.col("v") > rules.most_days))
    usual = (
        lines.where("kind IS NOT NULL AND source IS NOT NULL")
        .groupBy("source", "kind")
        .agg(F.count("*").alias("c"))
        .groupBy("source")
        .agg(F.max(F.struct("c", "kind"))["kind"].alias("usual"))
        .where(F.col("usual").isin("M", "J"))
        .select("source")
    )
    out = long.where(sure).unionByName(open_.join(usual, "source", "left_semi").select(long.columns))
    return out.select("ligne_id", "champ", F.col("v").alias("valeur"), F.lit("bound").alias("regle"))


def implausible(decl: DataFrame, rules: SpikeRules = SpikeRules()) -> DataFrame:
    """(ligne_id, champ): flagged values, those flagged by their tail alone only where they are rules.ratio times the
    series' median or more, or that part of it or less."""
    f = flag_spikes(decl, rules)
    exact = (F.col("regle") != "tail") | (F.col("valeur") >= rules.ratio * F.col("med")) | (F.col("valeur") * rules.ratio <= F.col("med"))
    return f.where(exact).select("ligne_id", "champ").distinct()
