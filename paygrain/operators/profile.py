"""Column profiles of loads: aggregates, induced expressions, drift between loads.

Expressions are induced by minimum description length over all distinct values. A value generalises to its shape: runs
of one character class (A-Z, a-z, other letters, digits; other characters as they are) with their lengths. The shapes of
one form with open lengths, and the forms with one row of word and digit runs, make up a tree of three levels. An
expression costs the bits of its text, and for each distinct value it takes the bits to name it, to tell the shape among
those of the form, and to tell the value among those the shape allows; a value that no expression takes is written out.
From the leaves up, a form is described as one expression or by what is best below it, whichever is shorter: the
selection of least total length. Values written out are nonconforming.

All of it is sums per shape, per form and per row of runs: nothing is collected, and any number of shapes is judged.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise


_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Text of a class and the characters it holds.
_CLASS = {"A": ("[A-Z]", 26), "a": ("[a-z]", 26), "9": ("[0-9]", 10), "L": (r"[\p{L}&&[^A-Za-z]]", 400), "w": (r"[\p{L}0-9]", 62)}


def shape(c: Column) -> Column:
    """`GP852204890` -> `AA999999999`: A for A-Z, a for a-z, L for any other letter, 9 for a digit; the rest stands for itself."""
    s = F.translate(c, _UPPER + _LOWER + _DIGITS, "A" * 26 + "a" * 26 + "9" * 10)
    return F.when(s.rlike(r"[^\x00-\x7F]"), F.regexp_replace(s, r"[\p{L}&&[^Aa]]", "L")).otherwise(s)


def runs(shape_text: str) -> list[tuple[str, int]]:
    out: list[tuple[str, int]] = []
    for ch in shape_text:
        if out and out[-1][0] == ch and ch in _CLASS:
            out[-1] = (ch, out[-1][1] + 1)
        else:
            out.append((ch, 1))
    return out


def loose_form(shape_text: str) -> str:
    return "".join(c for c, _ in runs(shape_text))


def word_form(shape_text: str) -> str:
    return re.sub("[Aa9L]+", "w", shape_text)


def regex(form: str, level: int) -> str:
    """The regular expression of a shape (level 0), a form with open lengths (1) or a row of word and digit runs (2)."""
    size = lambda n: "+" if level else f"{{{n}}}" if n > 1 else ""
    return "".join((_CLASS[c][0] + size(n)) if c in _CLASS and (c == "w") == (level == 2) else "\\" + c for c, n in runs(form))


def value_bits(shape_text: str, level: int) -> float:
    """Bits to tell a value of the shape among those it allows."""
    return sum(n * math.log2(_CLASS["w" if level == 2 else c][1]) for c, n in runs(shape_text) if c in "Aa9L")


@dataclass(frozen=True)
class Expression:
    regex: str
    shapes: frozenset[str]
    values: int


def induce(counts: Sequence[tuple[str, int]]) -> list[Expression]:
    """Expressions of a column from (shape, distinct values), those of most values first; empty without values. The same
    selection as `induced`, for counts at hand."""
    total = sum(n for _, n in counts)
    name = lambda n: n * math.log2((total + 1) / n)
    open_ = math.log2(total + 1)
    tree: dict[str, dict[str, list[tuple[str, int]]]] = {}
    for s, n in counts:
        tree.setdefault(word_form(s), {}).setdefault(loose_form(s), []).append((s, n))
    out: list[Expression] = []
    for word, forms in tree.items():
        below, picked = 0.0, []
        for form, shapes in forms.items():
            best, tight = 0.0, []
            for s, n in shapes:
                literal, own = (8 * len(s) + 2) * n, 8 * len(regex(s, 0)) + value_bits(s, 0) * n + name(n)
                best += min(literal, own)
                if own < literal:
                    tight.append(Expression(regex(s, 0), frozenset([s]), n))
            k, m = len(shapes), sum(n for _, n in shapes)
            own = 8 * len(regex(form, 1)) + sum(value_bits(s, 0) * n for s, n in shapes) + m * math.log2(k) + name(m) + open_ * k
            loose = k > 1 and own < best
            below += min(own, best) if k > 1 else best
            picked += [Expression(regex(form, 1), frozenset(s for s, _ in shapes), m)] if loose else tight
        shapes = [x for f in forms.values() for x in f]
        k, m = len(shapes), sum(n for _, n in shapes)
        own = 8 * len(regex(word, 2)) + sum(value_bits(s, 2) * n for s, n in shapes) + m * math.log2(k) + name(m) + 2 * open_ * k
        out += [Expression(regex(word, 2), frozenset(s for s, _ in shapes), m)] if k > 1 and own < below else picked
    return sorted(out, key=lambda e: (-e.values, e.regex))


@dataclass(frozen=True)
class LoadSpec:
    """load: the load's name. series, month: expressions for the agency of a load and its month number in order.
    ranges, patterns: declared bounds and expressions. nulls, distinct, numeric: columns judged between loads.
    columns: those profiled, all but the load's name if None.
    month_column: its values are compared with the load's own month of the year."""

    load: str = "chargement"
    order: str = "charge_le"
    columns: tuple[str, ...] | None = None
    ranges: tuple[tuple[str, float, float], ...] = (("mois", 1, 12), ("salaire_brut", 0, 50_000_000), ("duree_travaillee", 0, 744))
    patterns: tuple[tuple[str, str], ...] = (("id_indiv", "^[A-Z]{2}[0-9]{9}$"), ("numero_employeur", "^[0-9]{7}$"))
    nulls: tuple[str, ...] = ("id_indiv", "numero_employeur", "mois", "sexe", "commune", "salaire_brut", "duree_travaillee")
    distinct: tuple[str, ...] = ("id_indiv", "salaire_brut")
    numeric: tuple[str, ...] = ("salaire_brut", "duree_travaillee")
    month_column: str = "mois"
    null_gap: float = 0.1
    distinct_gap: float = 0.2
    distribution_gap: float = 0.25
    month_gap: float = 0.2
    expression_gap: float = 0.1


def _parts(spec: LoadSpec) -> tuple[Column, Column, Column]:
    """Agency, running month and month of the year of a load's name AGENCE_YYYY_MM."""
    rx = r"^(.*)_(\d{4})_(\d{2})$"
    year, month = F.regexp_extract(spec.load, rx, 2), F.regexp_extract(spec.load, rx, 3)
    n = lambda c: F.when(c != "", c.cast("int"))
    return F.regexp_extract(spec.load, rx, 1), n(year) * 12 + n(month), n(month)


def _is_null(df: DataFrame, c: str) -> Column:
    return F.col(c).isNull() | F.isnan(c) if dict(df.dtypes)[c] in ("double", "float") else F.col(c).isNull()


def _columns(df: DataFrame, spec: LoadSpec) -> list[str]:
    return [c for c in (df.columns if spec.columns is None else spec.columns) if c in df.columns and c != spec.load]


def long_values(df: DataFrame, spec: LoadSpec) -> DataFrame:
    """(load, colonne, v text, x number, rows): every column of every load, equal values counted map-side."""
    have = _columns(df, spec)
    number = {c for c, t in df.dtypes if t in ("int", "bigint", "double", "float", "smallint", "tinyint") or t.startswith("decimal")}
    cell = lambda c: F.struct(
        F.lit(c).alias("colonne"),
        F.when(~_is_null(df, c), F.col(c).cast("string")).alias("v"),
        (F.when(~_is_null(df, c), F.col(c).cast("double")) if c in number else F.lit(None).cast("double")).alias("x"),
    )
    long = df.where(F.col(spec.load).isNotNull()).select(spec.load, F.explode(F.array(*[cell(c) for c in have])).alias("_c"))
    return long.groupBy(spec.load, "_c.colonne", "_c.v", "_c.x").agg(F.count("*").alias("rows"))


def _text(df: DataFrame) -> Column:
    """The form of a value that expressions are induced on: as text, whole numbers of a floating column without fraction
    and exponent."""
    floating = [c for c, t in df.dtypes if t in ("double", "float")]
    whole = F.col("colonne").isin(*floating) & (F.col("x") == F.floor("x")) & (F.abs("x") < 1e15)
    return F.when(whole, F.col("x").cast("bigint").cast("string")).otherwise(F.col("v"))


def profile_loads(df: DataFrame, spec: LoadSpec = LoadSpec(), values: DataFrame | None = None, formed: Sequence[str] | None = None) -> DataFrame:
    """One row per (load, column): rows, nulls, distinct, least, most (numbers), out_of_range, violations (declared
    expression), foreign (rows no induced expression takes), main (the column's expression of most distinct values) and
    main_coverage (its share of the load's rows with a value). formed: columns whose expressions are induced, else all.

    Empty text is a value; NaN counts as null. Loads without a name are left out; an empty table gives no row."""
    values = long_values(df, spec) if values is None else values
    rng = F.lit(False)
    for c, lo, hi in spec.ranges:
        rng = F.when(F.col("colonne") == c, F.coalesce((F.col("x") < lo) | (F.col("x") > hi), F.lit(False))).otherwise(rng)
    some = F.col("v").isNotNull()
    figures = values.groupBy(spec.load, "colonne").agg(
        F.sum("rows").alias("rows"),
        F.sum(F.when(some, F.lit(0)).otherwise(F.col("rows"))).alias("nulls"),
        F.count("v").alias("distinct"),
        F.min("x").alias("least"),
        F.max("x").alias("most"),
        F.sum(F.when(rng, F.col("rows")).otherwise(0)).alias("out_of_range"),
    )
    took, forms = _expressed(df, values, _columns(df, spec) if formed is None else formed, spec)
    # what an induced expression takes that is the declared one itself conforms; the rest is tried against it
    vio = F.lit(False)
    for c, rx in spec.patterns:
        declared = F.coalesce(F.col("expression") == rx.removeprefix("^").removesuffix("$"), F.lit(False))
        vio = F.when(F.col("colonne") == c, ~declared & ~F.col("v").rlike(rx)).otherwise(vio)
    main = forms.where("expression IS NOT NULL").groupBy("colonne").agg(F.max_by("expression", F.struct("values", "expression")).alias("main"))
    took = took.join(F.broadcast(main), "colonne", "left")  # one row per column
    mainly = F.col("expression") == F.col("main")
    form_figures = took.groupBy(spec.load, "colonne").agg(
        F.sum(F.when(vio, F.col("rows")).otherwise(0)).alias("violations"),
        F.sum(F.when(F.col("expression").isNull(), F.col("rows")).otherwise(0)).alias("foreign"),
        F.max("main").alias("main"),
        F.round(F.sum(F.when(mainly, F.col("rows")).otherwise(0)).cast("double") / F.sum("rows"), 6).alias("main_coverage"),
    )
    out = figures.join(form_figures, [spec.load, "colonne"], "left").join(F.broadcast(main.withColumnRenamed("main", "_main")), "colonne", "left")
    none = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return out.select(
        spec.load, "colonne", "rows", "nulls", "distinct", "least", "most", "out_of_range", none("violations"), none("foreign"), F.col("_main").alias("main"), F.when(F.col("_main").isNotNull(), F.col("main_coverage")).alias("main_coverage")
    )


def _expressed(df: DataFrame, values: DataFrame, columns: Sequence[str], spec: LoadSpec) -> tuple[DataFrame, DataFrame]:
    """The values of the columns with the expression that takes each, null for those written out; and the expressions."""
    formed = values.where(F.col("colonne").isin(*columns) & F.col("v").isNotNull()).withColumn("shape", shape(_text(df)))
    forms = induced(formed)
    return formed.join(forms.select("colonne", "shape", "expression"), ["colonne", "shape"]), forms


def induced(formed: DataFrame) -> DataFrame:
    """(colonne, shape, expression, values): for every shape of the columns' distinct values the expression selected for
    it, null where its values are written out; values: distinct values of the expression. formed: colonne, v, shape."""
    classes = {c: F.length(F.regexp_replace("shape", f"[^{c}]", "")) for c in "Aa9L"}
    bits = sum((n * math.log2(_CLASS[c][1]) for c, n in classes.items()), F.lit(0.0))
    shapes = formed.groupBy("colonne", "shape").agg(F.count_distinct("v").alias("n"))
    shapes = shapes.withColumn("word", F.regexp_replace("shape", "[Aa9L]+", "w")).withColumn("loose", F.regexp_replace("shape", "([Aa9L])\\1+", "$1"))
    shapes = shapes.withColumn("rx", _regex(F.col("shape"), 0)).withColumn("bits", F.col("n") * bits)
    shapes = materialise(shapes.withColumn("chars", F.col("n") * sum(classes.values(), F.lit(0))), "load-shapes")
    total = F.broadcast(shapes.groupBy("colonne").agg((F.sum("n") + 1).alias("all")))  # one row per column
    name = lambda n: F.col(n) * F.log2(F.col("all") / F.col(n))
    written, own = (8 * F.length("shape") + 2) * F.col("n"), 8 * F.length("rx") + F.col("bits") + name("n")
    leaf = shapes.join(total, "colonne").withColumn("best", F.least(written, own)).withColumn("tight", own < written)
    sums = lambda d, *keys: d.groupBy("colonne", "all", *keys)
    loose = sums(leaf, "word", "loose").agg(F.count("*").alias("k"), F.sum("n").alias("m"), F.sum("bits").alias("bits"), F.sum("best").alias("best"), F.sum("chars").alias("chars"))
    loose = loose.withColumn("rx1", _regex(F.col("loose"), 1))
    own1 = 8 * F.length("rx1") + F.col("bits") + F.col("m") * F.log2("k") + name("m") + F.log2("all") * F.col("k")
    loose = loose.withColumn("take1", (F.col("k") > 1) & (own1 < F.col("best"))).withColumn("best1", F.when(F.col("k") > 1, F.least(own1, "best")).otherwise(F.col("best")))
    loose = materialise(loose.withColumnRenamed("m", "m1"), "load-forms")
    word = sums(loose, "word").agg(F.sum("k").alias("k"), F.sum("m1").alias("m"), F.sum("chars").alias("chars"), F.sum("best1").alias("best")).withColumn("rx2", _regex(F.col("word"), 2))
    own2 = 8 * F.length("rx2") + F.col("chars") * math.log2(62) + F.col("m") * F.log2("k") + name("m") + 2 * F.log2("all") * F.col("k")
    word = word.withColumn("take2", (F.col("k") > 1) & (own2 < F.col("best"))).select("colonne", "word", "take2", "rx2", F.col("m").alias("m2"))
    tree = leaf.select("colonne", "shape", "word", "loose", "n", "rx", "tight").join(loose.select("colonne", "word", "loose", "take1", "rx1", "m1"), ["colonne", "word", "loose"]).join(word, ["colonne", "word"])
    level = lambda a, b, c: F.when(F.col("take2"), F.col(a)).when(F.col("take1"), F.col(b)).when(F.col("tight"), F.col(c))
    return materialise(tree.select("colonne", "shape", level("rx2", "rx1", "rx").alias("expression"), level("m2", "m1", "n").alias("values")), "load-expressions")


def _regex(form: Column, level: int) -> Column:
    """As regex(), in the JVM."""
    letters = "w" if level == 2 else "Aa9L"
    pieces = F.regexp_extract_all(form, F.lit("(" + "|".join(f"{c}+" for c in letters) + f"|(?s:[^{letters}]))"), F.lit(1))

    def one(r: Column) -> Column:
        out = F.concat(F.lit("\\"), r)
        for c in letters:
            size = F.lit("+") if level else F.when(F.length(r) > 1, F.concat(F.lit("{"), F.length(r).cast("string"), F.lit("}"))).otherwise("")
            out = F.when(F.substring(r, 1, 1) == c, F.concat(F.lit(_CLASS[c][0]), size)).otherwise(out)
        return out

    return F.array_join(F.transform(pieces, one), "")


def _order(loads: DataFrame, spec: LoadSpec) -> DataFrame:
    """Every load with its agency, months, and the agency's loads before and after it."""
    agency, running, month = _parts(spec)
    w = Window.partitionBy("agency").orderBy("running", spec.load)
    loads = loads.select(spec.load).distinct().select(spec.load, agency.alias("agency"), running.alias("running"), month.alias("month"))
    return loads.withColumn("before", F.lag(spec.load).over(w)).withColumn("after", F.lead(spec.load).over(w))


def coverage(df: DataFrame, spec: LoadSpec = LoadSpec(), values: DataFrame | None = None) -> DataFrame:
    """(load, colonne, expression, rows, share, share_before, drifts): the rows that each induced expression takes, null for
    those that none takes, with its share of the rows with a value here and in the agency's preceding load; drifts where
    the two differ by spec.expression_gap or more, null without values on either side.

    A value belongs to the expression selected for its shape. An expression that only the preceding load has stands
    with 0 rows."""
    values = materialise(long_values(df, spec), "load-values", by=["colonne"]) if values is None else values
    took, _ = _expressed(df, values, _columns(df, spec), spec)
    counted = took.groupBy(spec.load, "colonne", "expression").agg(F.sum("rows").alias("rows"))
    counted = materialise(counted, "load-coverage")
    order = _order(values, spec)
    sides = F.array(F.struct(F.col(spec.load).alias("of"), F.lit(1).alias("side")), F.struct(F.col("after").alias("of"), F.lit(-1).alias("side")))
    sided = counted.join(order.select(spec.load, "after"), spec.load).select("colonne", "expression", "rows", F.explode(sides).alias("_s")).where("_s.of IS NOT NULL")
    of = lambda side: F.sum(F.when(F.col("_s.side") == side, F.col("rows")).otherwise(0))
    both = sided.groupBy(F.col("_s.of").alias(spec.load), "colonne", "expression").agg(of(1).alias("rows"), of(-1).alias("old"))
    w = Window.partitionBy(spec.load, "colonne")
    share = lambda c: F.round(F.try_divide(F.col(c).cast("double"), F.sum(c).over(w)), 6)
    both = both.withColumn("share", share("rows")).withColumn("share_before", share("old")).drop("old")
    return both.withColumn("drifts", F.round(F.abs(F.col("share") - F.col("share_before")), 6) >= spec.expression_gap)


def drift(df: DataFrame, spec: LoadSpec = LoadSpec(), values: DataFrame | None = None) -> DataFrame:
    """(load, colonne, constat): loads in which a column goes wrong - `range`, `pattern`, and against the agency's
    preceding load `nulls`, `distinct`, `distribution`. Shares are rounded to six decimals before they are compared;
    figures that need a value on either side give no row without one."""
    # read by each of the figures below: counted once, written once; other columns have no finding
    judged = dict.fromkeys([*(c for c, _, _ in spec.ranges), *(c for c, _ in spec.patterns), *spec.nulls, *spec.distinct, *spec.numeric, spec.month_column])
    values = materialise(long_values(df, replace(spec, columns=tuple(judged))), "load-values", by=["colonne"]) if values is None else values
    # of the expressions, the findings below read those of columns with a declared one alone
    prof = materialise(profile_loads(df, spec, values, [c for c, _ in spec.patterns if c in df.columns]), "load-profile")
    share = lambda a, b: F.round(F.try_divide(F.col(a).cast("double"), F.col(b)), 6)
    order = _order(prof, spec)
    figures = prof.withColumn("some", F.col("rows") - F.col("nulls"))
    figures = figures.withColumn("null_share", share("nulls", "rows")).withColumn("distinct_share", share("distinct", "some"))
    out = [
        figures.where("out_of_range > 0").select(spec.load, "colonne", F.lit("range").alias("constat")),
        figures.where("violations > 0").select(spec.load, "colonne", F.lit("pattern").alias("constat")),
    ]
    far = lambda a, b, gap: F.round(F.abs(F.col(a) - F.col(b)), 6) >= gap
    was = figures.select(
        F.col(spec.load).alias("before"), "colonne", F.col("null_share").alias("null_before"), F.col("distinct_share").alias("distinct_before")
    )
    pair = figures.join(order.select(spec.load, "before"), spec.load).where("before IS NOT NULL").join(was, ["before", "colonne"])
    out.append(pair.where(F.col("colonne").isin(*spec.nulls) & far("null_share", "null_before", spec.null_gap)).select(spec.load, "colonne", F.lit("nulls").alias("constat")))
    out.append(
        pair.where(F.col("colonne").isin(*spec.distinct) & far("distinct_share", "distinct_before", spec.distinct_gap)).select(
            spec.load, "colonne", F.lit("distinct").alias("constat")
        )
    )
    gaps = _cdf_gaps(values.where(F.col("colonne").isin(*spec.numeric) & F.col("x").isNotNull()), order, spec)
    out.append(gaps.where(F.round("gap", 6) >= spec.distribution_gap).select(F.col("after").alias(spec.load), "colonne", F.lit("distribution").alias("constat")))
    months = (
        values.where((F.col("colonne") == spec.month_column) & F.col("x").isNotNull())
        .join(order, spec.load)
        .groupBy(spec.load, "before", "colonne")
        .agg(F.round(F.sum(F.when(F.col("x") != F.col("month"), F.col("rows")).otherwise(0)) / F.sum("rows"), 6).alias("other"))
    )
    before = months.select(F.col(spec.load).alias("before"), F.col("other").alias("other_before"))
    out.append(
        months.join(before, "before")
        .where(far("other", "other_before", spec.month_gap))
        .select(spec.load, "colonne", F.lit("distribution").alias("constat"))
    )
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return res


def _cdf_gaps(values: DataFrame, order: DataFrame, spec: LoadSpec) -> DataFrame:
    """(after, colonne, gap): largest distance of the empirical distributions of a load and the one before it, exact.

    Values are cut into logarithmic ranges; running sums go over the ranges of a pair, then within each range, so a
    load of any size is spread over its ranges."""
    x = F.col("x")
    cut = (F.signum(x) * F.floor(F.log2(F.abs(x) + 1) * 8)).cast("int")
    sided = values.join(order, spec.load).select(
        "colonne", "x", "rows", cut.alias("cut"), F.explode(F.array(F.struct(F.col(spec.load).alias("after"), F.lit(1).alias("side")), F.struct(F.col("after").alias("after"), F.lit(-1).alias("side")))).alias("_p"), "before"
    )
    sided = sided.where("_p.after IS NOT NULL AND (_p.side = -1 OR before IS NOT NULL)")
    new, old = F.when(F.col("_p.side") == 1, F.col("rows")).otherwise(0), F.when(F.col("_p.side") == -1, F.col("rows")).otherwise(0)
    points = sided.groupBy(F.col("_p.after").alias("after"), "colonne", "cut", "x").agg(F.sum(new).alias("a"), F.sum(old).alias("b"))
    blocks = points.groupBy("after", "colonne", "cut").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    w = Window.partitionBy("after", "colonne")
    up = w.orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)
    base = blocks.select(
        "after", "colonne", "cut",
        F.coalesce(F.sum("a").over(up), F.lit(0)).alias("a0"), F.coalesce(F.sum("b").over(up), F.lit(0)).alias("b0"),
        F.sum("a").over(w).alias("na"), F.sum("b").over(w).alias("nb"),
    ).where("na > 0 AND nb > 0")
    inner = Window.partitionBy("after", "colonne", "cut").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    run = points.withColumn("a", F.sum("a").over(inner)).withColumn("b", F.sum("b").over(inner)).join(base, ["after", "colonne", "cut"])
    gap = F.abs((F.col("a") + F.col("a0")) / F.col("na") - (F.col("b") + F.col("b0")) / F.col("nb"))
    return run.groupBy("after", "colonne").agg(F.max(gap).alias("gap"))
