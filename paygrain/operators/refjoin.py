"""Joins to lookups, exact and by similarity (JOI-01 to JOI-06, JOI-12, JOI-14, WIN-11, AGG-25, SRC-20).

Lookups are joined by key; whether one is broadcast is left to the session's size threshold, which Spark checks. The
similarity join compares distinct prepared texts only, each with every lookup text, so that the best match and its score
are exact at any size: the lookup is dealt into blocks of bounded size, the texts into slices, and every block meets every
slice as one even cell of an equi-join. blocking='shared' is the cheaper, lossy way: it compares only texts that share a
word, their first two or their last two letters.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import similarity
from ..functions.text import prepare, trimmed
from ..plans.catalog import BANDS, MergeSpec
from ..session import materialise
from .clean import keep_first

#: Lookup texts of a block, and texts of a slice, of the similarity join.
BLOCK, SLICE = 2_000, 2_000


def lookup(ref: DataFrame, key: str, keep: Sequence[str] = (), drop: Sequence[str] = (), rename: Mapping[str, str] | None = None, order: Sequence[str] | None = None) -> DataFrame:
    """The lookup with its key trimmed and unique - the first row by order, by all its columns if none is given - and its
    columns kept, dropped (absent ones are ignored) and renamed."""
    d = ref.drop(*[c for c in drop if c != key])
    if keep:
        d = d.select(*dict.fromkeys([key, *[c for c in keep if c in d.columns]]))
    d = d.withColumnsRenamed(dict(rename or {})).withColumn(key, trimmed(key)).where(F.col(key).isNotNull())
    return keep_first(d, [key], order or [c for c in d.columns if c != key] or [key])


def join_exact(df: DataFrame, ref: DataFrame, key: str, ref_key: str | None = None, how: str = "left", suffix: str = "_ref", match_null: bool = False, **columns) -> DataFrame:
    """df with the lookup's columns on the trimmed key; clashing names get the suffix. how: inner, else left. match_null:
    null keys match a null key of the lookup."""
    ref_key = ref_key or key
    r = lookup(ref, ref_key, **columns)
    if match_null:
        nulls = ref.where(trimmed(ref_key).isNull()).select(*[c for c in r.columns])
        r = r.unionByName(keep_first(nulls.withColumn(ref_key, F.lit(None).cast("string")), [ref_key], [c for c in r.columns if c != ref_key] or [ref_key]))
    own = set(df.columns)
    r = r.select(F.col(ref_key).alias("_k"), *[F.col(c).alias(c + suffix if c in own else c) for c in r.columns if c != ref_key])
    d = df.withColumn(key, trimmed(key))
    on = d[key].eqNullSafe(r["_k"]) if match_null else d[key] == r["_k"]
    return d.join(r, on, "inner" if how == "inner" else "left").drop("_k")


def match_rate(df: DataFrame, check: str) -> DataFrame:
    return df.agg(F.count("*").alias("n"), F.count(check).alias("matched"), F.try_divide(F.count(check).cast("double"), F.count("*")).alias("rate"))


def _block_keys(c: Column) -> Column:
    words = F.filter(F.split(c, " "), lambda w: F.length(w) >= 2)
    ends = F.array(F.concat(F.lit("<"), F.substring(c, 1, 2)), F.concat(F.substring(c, -2, 2), F.lit(">")))
    return F.array_distinct(F.concat(words, ends))


def _cells(xs: DataFrame, ys: DataFrame, block: int) -> DataFrame:
    """Every text with every lookup text, as cells (block of the lookup, slice of the texts) of even, bounded size. Both
    sides are written first, so that their sizes are known and equal texts stay in their cell when a task is repeated."""
    xs, ys = materialise(xs, "fuzzy-texts"), materialise(ys, "fuzzy-lookup")
    n, cores = xs.count(), xs.sparkSession.sparkContext.defaultParallelism
    blocks, slices = max(1, -(-ys.count() // block)), max(1, -(-n // SLICE), min(n, cores))
    part = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    a = xs.withColumn("_s", part("_x", slices)).withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    b = ys.withColumn("_b", part("_y", blocks)).withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    return a.join(b, ["_b", "_s"]).select("_x", "_y", "match")


def best_matches(left: DataFrame, text: str, ref: DataFrame, ref_text: str, method: str = "jw", threshold: float = 0.8, blocking: str = "none", stopwords: Sequence[str] = (), block: int = BLOCK) -> DataFrame:
    """(value, match, score): for every distinct text the most similar lookup text, the first in the alphabet among equals;
    below the threshold match is null and the score kept. Without a lookup text there is neither. blocking='shared' loses
    matches that share no word and no two letters at either end; its texts without a candidate have neither."""
    x = left.select(F.col(text).alias("value")).where("value IS NOT NULL").distinct().withColumn("_x", prepare(F.col("value"), stopwords=stopwords))
    y = ref.select(F.col(ref_text).alias("match")).where("match IS NOT NULL").distinct().withColumn("_y", prepare(F.col("match"), stopwords=stopwords))
    # equal prepared texts are scored once; the first original stands for them
    xs = x.select("_x").distinct()
    ys = y.groupBy("_y").agg(F.min("match").alias("match"))
    if blocking == "none":
        pairs = _cells(xs, ys, block)
    else:
        a = xs.select("_x", F.explode(_block_keys(F.col("_x"))).alias("_b"))
        b = ys.select("_y", "match", F.explode(_block_keys(F.col("_y"))).alias("_b"))
        pairs = a.join(b, "_b").select("_x", "_y", "match").distinct()
    scored = pairs.withColumn("score", similarity(method, F.col("_x"), F.col("_y")))
    # the best as an aggregate: no sort of a text's candidates
    # highest score, then the first in the alphabet: an aggregate per (text, score), then per text
    best = scored.groupBy("_x", "score").agg(F.min("match").alias("match")).groupBy("_x").agg(F.max_by("match", "score").alias("match"), F.max("score").alias("score"))
    return x.join(best, "_x", "left").select("value", F.when(F.col("score") >= threshold, F.col("match")).alias("match"), "score")


def join_fuzzy(df: DataFrame, ref: DataFrame, text: str, ref_text: str, method: str = "jw", threshold: float = 0.8, keep: Sequence[str] = (), score: str | None = None, blocking: str = "none", suffix: str = "_ref", stopwords: Sequence[str] = (), block: int = BLOCK) -> DataFrame:
    """df with the columns of its best lookup row; every row of df exactly once."""
    best = best_matches(df, text, ref, ref_text, method, threshold, blocking, stopwords, block)
    r = lookup(ref, ref_text, keep)
    own = set(df.columns)
    r = r.select(F.col(ref_text).alias("_m"), F.col(ref_text).alias(ref_text + suffix if ref_text in own else ref_text), *[F.col(c).alias(c + suffix if c in own else c) for c in r.columns if c != ref_text])
    b = best.select(F.col("value").alias("_v"), F.col("match").alias("_m"), F.col("score").alias("_s"))
    d = df.join(b, df[text] == b["_v"], "left").drop("_v").join(r, "_m", "left").drop("_m")
    return d.withColumnRenamed("_s", score) if score else d.drop("_s")


def quality(score: Column) -> Column:
    out = None
    for name, least in BANDS:
        out = F.when(score >= least, name) if out is None else out.when(score >= least, name)
    return out.otherwise("rejected")


def quality_report(matched: DataFrame, score: str, by: str | None = None, top: int = 15) -> DataFrame:
    """Rows and share per quality band, or per group for the `top` largest groups."""
    if by is None:
        g = matched.where(F.col(score).isNotNull()).groupBy(quality(F.col(score)).alias("quality")).agg(F.count("*").alias("n"), F.avg(score).alias("mean_score"))
        return g
    return matched.where(F.col(score).isNotNull()).groupBy(by).agg(F.count("*").alias("n"), F.avg(score).alias("mean_score"), F.min(score).alias("min_score")).orderBy(F.desc("n"), by).limit(top)


def unmatched(df: DataFrame, key: str, check: str) -> DataFrame:
    """Values without a match, most frequent first."""
    return df.where(F.col(check).isNull()).groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key)


def merge_all(df: DataFrame, specs: Sequence[MergeSpec], load: Callable[[str], DataFrame], block: int = BLOCK) -> tuple[DataFrame, list[dict]]:
    """Fold of the enabled lookups in their order. A lookup that can't be read is skipped and said so in the log."""
    log = []
    for s in sorted((s for s in specs if s.enabled), key=lambda s: s.order):
        try:
            ref = load(s.ref)
        except Exception as e:  # noqa: BLE001 - an unreadable lookup must not end the run
            log.append({"name": s.name, "status": "skipped", "why": str(e)[:200]})
            continue
        before = set(df.columns)
        if s.kind == "exact":
            df = join_exact(df, ref, s.key, s.ref_key, s.how, keep=s.keep, drop=s.drop, rename=dict(s.rename))
        else:
            df = join_fuzzy(df, ref, s.key, s.ref_key, s.method, s.threshold, s.keep, s.score, block=block)
        log.append({"name": s.name, "status": "merged", "columns": [c for c in df.columns if c not in before]})
    return df, log


def compare_runs(old: DataFrame, new: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """keys, statistique, ancien, nouveau, ecart, ecart_pct over cells that both runs have."""
    o = old.unpivot(list(keys), list(values), "statistique", "ancien")
    n = new.unpivot(list(keys), list(values), "statistique", "nouveau")
    d = F.col("nouveau") - F.col("ancien")
    return n.join(o, [*keys, "statistique"]).withColumn("ecart", d).withColumn("ecart_pct", F.try_divide(d, F.col("ancien")) * 100)
