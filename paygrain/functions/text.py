"""Text preparation and similarities that the JVM computes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Latin letters and the plain letters they become.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY"
PAIRS = (("œ", "oe"), ("Œ", "OE"), ("æ", "ae"), ("Æ", "AE"), ("ß", "ss"))


def trimmed(c: Column | str) -> Column:
    """Trimmed; empty is null."""
    return F.nullif(F.trim((F.col(c) if isinstance(c, str) else c).cast("string")), F.lit(""))


def unaccent(c: Column) -> Column:
    c = F.translate(c, ACCENTED, PLAIN)
    for a, b in PAIRS:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def prepare(c: Column, lower: bool = True, accents: bool = True, punctuation: bool = True, stopwords: Sequence[str] = (), squish: bool = True) -> Column:
    """Null to empty, lower case, no accents, punctuation to blanks, stop words out, blanks squeezed - in this order."""
    c = F.coalesce(c, F.lit(""))
    if lower:
        c = F.lower(c)
    if accents:
        c = unaccent(c)
    if punctuation:
        c = F.regexp_replace(c, r"\p{Punct}", " ")
    if stopwords:
        c = F.regexp_replace(c, r"\b(" + "|".join(stopwords) + r")\b", "")
    if squish:
        c = F.trim(F.regexp_replace(c, r"\s+", " "))
    return c


def levenshtein(a: Column, b: Column) -> Column:
    """1 - distance / longer length; two empty texts are equal."""
    n = F.greatest(F.length(a), F.length(b))
    return F.when(n == 0, 1.0).otherwise(1 - F.levenshtein(a, b) / n)


def hamming(a: Column, b: Column) -> Column:
    """Share of equal places; 0 for texts of unequal length, 1 for two empty ones."""
    n = F.length(a)
    same = F.size(F.filter(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x == y), lambda e: e))
    return F.when(n != F.length(b), 0.0).when(n == 0, 1.0).otherwise(same / n)


def grams(c: Column, q: int = 2) -> Column:
    """Array of a text's q-grams, in order, with repeats."""
    last = F.length(c) - (q - 1)
    return F.when(last >= 1, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(c, i, F.lit(q)))).otherwise(F.array().cast("array<string>"))


def jaccard(a: Column, b: Column, q: int = 2) -> Column:
    """Shared over all distinct q-grams; 1 if neither text has any."""
    x, y = F.array_distinct(grams(a, q)), F.array_distinct(grams(b, q))
    both = F.size(F.array_intersect(x, y))
    all_ = F.size(F.array_union(x, y))
    return F.when(all_ == 0, 1.0).otherwise(both / all_)


def cosine(a: Column, b: Column, q: int = 2) -> Column:
    """Cosine of q-gram counts; 1 if neither text has any, 0 if one has none."""
    x, y = grams(a, q), grams(b, q)
    count = lambda arr, g: F.size(F.filter(arr, lambda e: e == g)).cast("double")
    total = lambda arr, f: F.aggregate(arr, F.lit(0.0), lambda s, g: s + f(g))
    dot = total(F.array_intersect(x, y), lambda g: count(x, g) * count(y, g))
    nx, ny = total(F.array_distinct(x), lambda g: F.pow(count(x, g), 2)), total(F.array_distinct(y), lambda g: F.pow(count(y, g), 2))
    return F.when((F.size(x) == 0) & (F.size(y) == 0), 1.0).when((F.size(x) == 0) | (F.size(y) == 0), 0.0).otherwise(dot / F.sqrt(nx * ny))
