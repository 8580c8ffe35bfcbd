"""Fields that are added, renamed, removed or retyped between files; one consistent table of all files.

Similarity flooding. A file's schema is a graph: its headers, and the nodes they point at - words of the header, the kind
of the values, their value forms, nested field names. The project's schema is such a graph too. Pairs of nodes start as
similar as their own text says: fields by their whole name, words by spelling, abbreviation or a thesaurus of general
words, kinds and forms by being the same. A pair of fields then takes up what the pairs of its words, kinds, forms and
nested names hold, a pair of words what the pairs of fields around it hold against their rivals, and so on until the
scores no longer move. From the converged scores consistent correspondences are selected: one column a header, one header
a column, stable in that no header and column prefer each other, above a floor.

Rows are parsed once, inside the JVM; what the matching sees is one small schema per distinct file layout.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise


@dataclass(frozen=True)
class Field:
    """A column of the project's schema: its type in the consistent table and what its raw values look like."""

    name: str
    type: str
    kinds: tuple[str, ...]
    forms: tuple[str, ...]
    nested: tuple[str, ...] = ()


#: The project's columns of monthly files.
PROJECT = (
    Field("ID_INDIV", "string", ("text", "number"), ("AA9", "9 long")),
    Field("NUMERO_EMPLOYEUR", "string", ("text", "number", "object"), ("9 seven",), ("numero", "agence")),
    Field("SALAIRE_BRUT", "double", ("number", "text", "object"), ("9 five", "9 six", "9 seven", "9 grouped", "decimal"), ("montant", "devise")),
    Field("DUREE_TRAVAILLEE", "double", ("number", "text"), ("9 short", "decimal")),
    Field("SEXE", "string", ("text", "number"), ("letter", "9 short")),
    Field("TYPE_SALARIE", "string", ("text",), ("letter",)),
    Field("SITUATION_MATRIMONIALE", "string", ("text",), ("letter",)),
    Field("NIVEAU_ETUDE", "string", ("text",), ("words",)),
    Field("PROFESSION", "string", ("text",), ("words",)),
    Field("STATUT_TRAVAILLEUR", "string", ("text",), ("words",)),
    Field("CSP_CODE", "string", ("text", "number"), ("9 short",)),
    Field("PROF_CODE", "string", ("text",), ("A9",)),
    Field("DATE_NAISSANCE", "date", ("text", "number"), ("date", "9 five")),
    Field("DATE_EMBAUCHE", "date", ("text", "number"), ("date", "9 five")),
    Field("DATE_IMMATRICULATION", "date", ("text", "number"), ("date", "9 five")),
    Field("DATE_IMMAT_EMPLOYEUR", "date", ("text", "number"), ("date", "9 five")),
    Field("DATE_DEBUT_ACT_EMPLOY", "date", ("text", "number"), ("date", "9 five")),
    Field("RAISON_SOCIALE", "string", ("text",), ("words",)),
    Field("SECTEUR_ACTIVITE", "string", ("text",), ("words",)),
    Field("COMMUNE", "string", ("text",), ("words",)),
    Field("LIBELLE_AGENCE", "string", ("text",), ("words",)),
    Field("CATEGORIE_ENTREPRISE", "double", ("number", "text"), ("9 short",)),
    Field("EFFECTIF_SALARIES", "double", ("number", "text"), ("9 short",)),
)

#: General words that mean the same, and usual abbreviations; the first of a row is the project's.
THESAURUS = (
    ("SALAIRE", "REMUNERATION", "PAIE", "SALARY", "WAGE", "PAY"),
    ("BRUT", "GROSS"),
    ("NUMERO", "NO", "N", "NUMBER", "NBR"),
    ("ID", "IDENTIFIANT", "MATRICULE", "IDENTIFIER"),
    ("INDIV", "PERSONNE", "PERSON"),
    ("EMPLOYEUR", "EMPLOYER"),
    ("DUREE", "TEMPS", "DURATION", "TIME"),
    ("TRAVAILLEE", "WORKED"),
    ("SEXE", "GENRE", "GENDER"),
    ("DATE", "DT", "LE"),
    ("NAISSANCE", "NE", "NEE", "BIRTH"),
    ("EMBAUCHE", "HIRE", "HIRING"),
    ("EFFECTIF", "NB", "NOMBRE", "COUNT"),
    ("COMMUNE", "TOWN"),
    ("SECTEUR", "SECTOR"),
    ("SALARIES", "EMPLOYEES"),
)
#: Words that carry no meaning of their own, and units.
EMPTY = frozenset("DE DU DES D LA LES L OF THE FCFA XOF EN".split())
#: Share of a field pair's score that comes from each kind of neighbour; the whole name has the rest.
SHARES = {"words": 0.5, "forms": 0.25, "kinds": 0.1}
#: A word of another column says less against a pair than a word the project doesn't have at all.
CONTEXT, FOREIGN = 0.3, 2.0
#: The least spelling similarity that counts.
SPELLING = 0.7
#: A header takes no column whose score lies further under that of its best.
NEAR_BEST = 0.85


def stems(header: str, known: frozenset[str] = frozenset()) -> list[str]:
    """Words of a header in capitals, without accents; a header written as one word is cut into known words if they
    cover it."""
    flat = unicodedata.normalize("NFKD", header.replace("°", " ").replace("º", " ")).encode("ascii", "ignore").decode().upper()
    out: list[str] = []
    for w in re.split(r"[^A-Z0-9]+", flat):
        if w and w not in EMPTY:
            out += (_cut(w, known) if known and w not in known else None) or [w]
    return list(dict.fromkeys(out))


def _cut(word: str, known: frozenset[str]) -> list[str] | None:
    for i in range(3, len(word) - 2):
        if word[:i] in known and word[i:] in known:
            return [word[:i], word[i:]]
    return None


@lru_cache(maxsize=100_000)
def spelling(a: str, b: str) -> float:
    """One less the edits (letters put in, left out, changed, swapped) for the longer word."""
    prev, cur = list(range(len(b) + 1)), []
    before: list[int] = []
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (x != y)))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cur[-1] = min(cur[-1], before[j - 2] + 1)
        before, prev = prev, cur
    return 1 - prev[-1] / max(len(a), len(b), 1)


@lru_cache(maxsize=100_000)
def word_similarity(t: str, u: str, known: frozenset[str]) -> float:
    """Of a header's word and a column's word, before any flooding. A word the project uses means itself."""
    if t == u:
        return 1.0
    if any(u == row[0] and t in row[1:] for row in THESAURUS):
        return 0.95
    if t in known:
        return 0.0
    if (len(t) >= 3 and u.startswith(t)) or (len(u) >= 4 and t.startswith(u)):
        return 0.95
    s = spelling(t, u)
    return s if s >= SPELLING else 0.0


def name_similarity(a: list[str], b: list[str]) -> float:
    """Shared pairs of letters of two whole names (Dice)."""
    x, y = " ".join(a), " ".join(b)
    if x == y:
        return 1.0
    p, q = ([z[i : i + 2] for i in range(len(z) - 1)] for z in (x, y))
    both = sum((Counter(p) & Counter(q)).values())
    return 2 * both / max(len(p) + len(q), 1)


def value_form(kind: Column, text: Column) -> Column:
    """A coarse form of a value's text."""
    t = F.trim(text)
    digits = t.rlike(r"^[0-9]+(\.0+)?$")
    n = F.length(F.regexp_replace(t, r"\.0+$", ""))
    return (
        F.when(kind == "object", "object")
        .when(digits, F.when(n <= 4, "9 short").when(n == 5, "9 five").when(n == 6, "9 six").when(n == 7, "9 seven").otherwise("9 long"))
        .when(t.rlike(r"^[A-Za-z]{2}[0-9]{6,}$"), "AA9")
        .when(t.rlike(r"^[A-Za-z][0-9]{2,}$"), "A9")
        .when(t.rlike(r"^\d{1,4}[/.-]\d{1,2}[/.-]\d{1,4}"), "date")
        .when(t.rlike(r"^-?[0-9]+[.,][0-9]+$"), "decimal")
        .when(t.rlike(r"^[0-9]{1,3}([  .][0-9]{3})+$"), "9 grouped")
        .when(F.length(t) == 1, "letter")
        .otherwise("words")
    )


def parse(raw: DataFrame) -> DataFrame:
    """(fichier, ligne_id, header, kind, text): one row per key of every readable object. kind is number, text, object
    or other; null where the value is null. A row that isn't a whole JSON object, or repeats a key, is unreadable and
    gives nothing. Each row is parsed once."""
    v = raw.select("fichier", "ligne_id", F.try_parse_json("contenu").alias("_v"))
    e = v.lateralJoin(raw.sparkSession.tvf.variant_explode(F.col("_v").outer())).where("key IS NOT NULL")
    e = e.select("fichier", "ligne_id", F.col("key").alias("header"), F.expr("schema_of_variant(value)").alias("_s"), F.expr("try_variant_get(value, '$', 'string')").alias("text"))
    s = F.col("_s")
    kind = F.when(s == "VOID", None).when(s == "STRING", "text").when(s.startswith("OBJECT"), "object").when((s == "BOOLEAN") | s.startswith("ARRAY"), "other").otherwise("number")
    return e.select("fichier", "ligne_id", "header", kind.alias("kind"), "text")


def file_fields(parsed: DataFrame) -> DataFrame:
    """(fichier, header, kind, forms, nested): per file and header the kind of most non-null values (ties: the kind first
    in the alphabet), its commonest value form and an object's field names. Counted map-side."""
    form = value_form(F.col("kind"), F.col("text"))
    names = F.when(F.col("kind") == "object", F.concat_ws(",", F.array_sort(F.json_object_keys("text"))))
    n = parsed.groupBy("fichier", "header", "kind", form.alias("form"), names.alias("names")).agg(F.count("*").alias("n"))
    by_kind = n.groupBy("fichier", "header", "kind").agg(
        F.sum("n").alias("n"), F.max(F.struct("n", "form"))["form"].alias("form"), F.max("names").alias("names")
    )
    rank = F.struct(F.col("kind").isNotNull().cast("int"), "n", F.translate("kind", "nto", "cba"))
    return by_kind.groupBy("fichier", "header").agg(
        F.max_by("kind", rank).alias("kind"), F.max_by(F.when(F.col("kind").isNotNull(), F.col("form")), rank).alias("form"), F.max("names").alias("names")
    )


def flood(
    headers: Sequence[tuple[str, str | None, str | None, str | None]],
    project: Sequence[Field] = PROJECT,
    floor: float = 0.64,
    eps: float = 1e-3,
    most: int = 60,
) -> dict[str, str]:
    """Correspondences header -> project column of one file's schema; headers are (header, kind, form, names). most: rounds
    of propagation, none of which leaves the similarity of whole names alone."""
    if not headers:
        return {}
    project = tuple(project)
    s = scores(headers, project, eps, most)
    out: dict[str, str] = {}
    taken: set[int] = set()
    # best first is the stable assignment where both sides rank pairs by one score; ties: the shorter header
    for _, _, i, j in sorted((-s[i, j], len(headers[i][0]), i, j) for i, j in zip(*np.nonzero((s >= floor) & (s >= NEAR_BEST * s.max(1, keepdims=True))))):
        if headers[i][0] not in out and j not in taken:
            out[headers[i][0]] = project[j].name
            taken.add(j)
    return out


def scores(headers: Sequence[tuple[str, str | None, str | None, str | None]], project: tuple[Field, ...], eps: float = 1e-3, most: int = 60) -> np.ndarray:
    """Converged similarity of every header and column, from 0 to 1."""
    words_p, known = _project_words(project)
    words_h = [_header_words(h, known) for h, *_ in headers]
    whole = np.array([_whole_names(h, project) for h, *_ in headers])
    base = (1 - sum(SHARES.values())) * whole
    base += SHARES["kinds"] * np.array([[1.0 if k is None else float(k in f.kinds) for f in project] for _, k, _, _ in headers])
    base += SHARES["forms"] * np.array([[_form_similarity(form, names, f) for f in project] for _, _, form, names in headers])
    # word pairs with their own similarity, and the field pairs around each
    vocabulary_h, vocabulary_p = sorted({t for ws in words_h for t in ws}), sorted(known)
    own = np.array([[word_similarity(t, u, known) for u in vocabulary_p] for t in vocabulary_h]).reshape(len(vocabulary_h), len(vocabulary_p))
    initials = {i: j for i, ws in enumerate(words_h) for t in ws[:1] for j, us in enumerate(words_p) if len(us) > 1 and t not in known and t == "".join(u[0] for u in us)}
    at_h, at_p = {t: i for i, t in enumerate(vocabulary_h)}, {u: j for j, u in enumerate(vocabulary_p)}
    rows, cols = _padded([[at_h[t] for t in ws] for ws in words_h]), _padded([[at_p[u] for u in us] for us in words_p])
    foreign = np.array([t not in known and own[i].max(initial=0.0) == 0.0 for t, i in at_h.items()])
    for i, j in initials.items():  # initials stand for each word
        own[rows[i, 0], cols[j][cols[j] >= 0]] = 0.95
        foreign[rows[i, 0]] = False
    alone = np.where(foreign, FOREIGN, np.where([t in known for t in vocabulary_h], CONTEXT, 1.0))
    here = (rows >= 0)[:, :, None, None] & (cols >= 0)[None, None]
    pairs = np.broadcast_to(rows[:, :, None, None], here.shape)[here], np.broadcast_to(cols[None, None], here.shape)[here]
    s, words = whole.copy(), own.copy()
    for _ in range(most):
        block = np.where(here, words[rows[:, :, None, None], cols[None, None]], 0.0)
        new = base + SHARES["words"] * _word_agreement(block, np.where(rows >= 0, alone[rows], 0.0), (cols >= 0).sum(1))
        moved = np.abs(new - s).max()
        s = new
        # what a word pair's fields are worth against the rivals of either
        rel = s / np.maximum(np.maximum(s.max(1, keepdims=True), s.max(0, keepdims=True)), 1e-9)
        support = np.zeros_like(own)
        np.maximum.at(support, pairs, np.broadcast_to(rel[:, None, :, None], here.shape)[here])
        words = own * (0.7 + 0.3 * support)
        if moved < eps:
            break
    return s


def _padded(lists: list[list[int]]) -> np.ndarray:
    """The lists as rows, filled up with -1."""
    out = np.full((len(lists), max(map(len, lists), default=1) or 1), -1)
    for i, x in enumerate(lists):
        out[i, : len(x)] = x
    return out


def _word_agreement(block: np.ndarray, alone: np.ndarray, count: np.ndarray) -> np.ndarray:
    """How far the words of each header are found in each column, and less, the column's in the header. block: similarity
    by header, its word, column, its word; alone: what a header's word weighs where it isn't found."""
    best = block.max(3)
    weight = np.where((best > 0) & (alone > 0)[:, :, None], 1.0, alone[:, :, None])
    found = (weight * best).sum(1) / np.maximum(weight.sum(1), 1e-9)
    return found * (0.75 + 0.25 * block.max(1).sum(2) / np.maximum(count, 1))


def _form_similarity(form: str | None, names: str | None, f: Field) -> float:
    """Plain words may stand for anything; other forms are the column's or they aren't."""
    if form is None:
        return 0.5
    if form == "object":
        mine = set(names.split(",")) if names else set()
        return len(mine & set(f.nested)) / max(len(mine | set(f.nested)), 1)
    return 1.0 if form in f.forms else 0.5 if form == "words" else 0.0


@lru_cache(maxsize=8)
def _project_words(project: tuple[Field, ...]) -> tuple[list[list[str]], frozenset[str]]:
    words = [stems(f.name) for f in project]
    return words, frozenset(w for ws in words for w in ws)


@lru_cache(maxsize=10_000)
def _header_words(header: str, known: frozenset[str]) -> list[str]:
    return stems(header, known) or [header.strip().upper()]


@lru_cache(maxsize=10_000)
def _whole_names(header: str, project: tuple[Field, ...]) -> tuple[float, ...]:
    words, known = _project_words(project)
    return tuple(name_similarity(_header_words(header, known), w) for w in words)


def match_files(fields: DataFrame, project: Sequence[Field] = PROJECT) -> DataFrame:
    """fields with champ, the project's column or the header itself. Each distinct layout is matched once."""
    layout = fields.groupBy("fichier").agg(F.array_sort(F.collect_list(F.struct("header", "kind", "form", "names"))).alias("_l"))
    layout = layout.withColumn("_key", F.xxhash64("_l"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for key, lay in zip(b["_key"], b["_l"]):
                hs = [(x["header"], x["kind"], x["form"], x["names"]) for x in lay]
                got = flood(hs, project)
                rows += [(key, h, got.get(h, h)) for h, *_ in hs]
            yield pd.DataFrame(rows, columns=["_key", "header", "champ"])

    matched = layout.groupBy("_key").agg(F.first("_l").alias("_l")).mapInPandas(run, "_key bigint, header string, champ string")
    files = layout.select("fichier", "_key")
    return fields.join(files, "fichier").join(matched, ["_key", "header"]).drop("_key")


def file_order(c: Column | str = "fichier") -> tuple[Column, Column]:
    """Agency and running month of MM_YYYY_AGENCE.xlsx; null for other names."""
    c = F.col(c) if isinstance(c, str) else c
    rx = r"^(\d{2})_(\d{4})_(.+)\.[^.]+$"
    mm, yy, ag = (F.regexp_extract(c, rx, i) for i in (1, 2, 3))
    return F.when(ag != "", ag), F.when(mm != "", yy.cast("int") * 12 + mm.cast("int"))


def schema_changes(raw: DataFrame, project: Sequence[Field] = PROJECT) -> DataFrame:
    """(fichier, champ, changement, avant, apres): each agency's files in the order of the month in their names, each
    against the preceding one delivered. changement is added, removed, renamed or retyped; one field can be renamed and
    retyped. A file's fields are the keys of its readable rows. The first file of an agency gives nothing, nor do files
    whose name holds no month; a field without non-null values on either side is not retyped. Empty input: no row."""
    # read by the layouts and by the comparison: parsed and counted once
    fields = materialise(file_fields(parse(raw)), "schema-fields")
    fields = materialise(match_files(fields, project), "schema-matches")
    agency, month = file_order()
    w = Window.partitionBy("_agency").orderBy("_month", "fichier")
    files = fields.select("fichier").distinct().select("fichier", agency.alias("_agency"), month.alias("_month")).where("_month IS NOT NULL")
    files = files.select("fichier", F.lag("fichier").over(w).alias("_before"), F.lead("fichier").over(w).alias("_after"))
    one = F.struct("header", "kind")
    f = fields.join(files, "fichier")
    new = f.where("_before IS NOT NULL").groupBy("fichier", "champ").agg(F.min(one).alias("_new"))
    old = f.where("_after IS NOT NULL").groupBy(F.col("_after").alias("fichier"), "champ").agg(F.min(one).alias("_old"))
    both = new.join(old, ["fichier", "champ"], "full")
    what = F.filter(
        F.array(
            F.when(F.col("_old").isNull(), F.lit("added")),
            F.when(F.col("_new").isNull(), F.lit("removed")),
            F.when(F.col("_new.header") != F.col("_old.header"), F.lit("renamed")),
            F.when(F.col("_new.kind") != F.col("_old.kind"), F.lit("retyped")),
        ),
        lambda x: x.isNotNull(),
    )
    side = lambda s: F.when(F.col("changement") == "retyped", F.col(f"{s}.kind")).otherwise(F.col(f"{s}.header"))
    return both.select("fichier", "champ", "_new", "_old", F.explode(what).alias("changement")).select(
        "fichier", "champ", "changement", side("_old").alias("avant"), side("_new").alias("apres")
    )


def unify(raw: DataFrame, project: Sequence[Field] = PROJECT) -> DataFrame:
    """One consistent, typed table of all files: fichier, ligne_id, the project's columns, and autres (map of the fields
    the project doesn't have). Numbers are read from text with blanks and commas and from objects (the first of the
    column's nested names); dates from text and from serial day numbers. What can't be cast is null. Unreadable rows
    stay, with all fields null.

    A row keeps its keys together: it meets its file's correspondences, one map a file, and is cast where it stands."""
    match = materialise(match_files(file_fields(parse(raw)), project), "schema-table-matches")
    mine = match.where(F.col("champ").isin(*[f.name for f in project]))
    pairs = F.map_from_entries(F.collect_list(F.struct("champ", "header")))
    files = mine.groupBy("fichier").agg(pairs.alias("_headers"), F.collect_list("header").alias("_own"))
    cells = F.expr("try_variant_get(_v, '$', 'map<string,variant>')")
    # the text travels, not what is parsed from it; files without a month in their name are looked up like any other
    d = raw.select("fichier", "ligne_id", "contenu").join(files, "fichier", "left").withColumn("_v", F.try_parse_json("contenu"))
    d = d.withColumn("_m", F.when(F.expr("schema_of_variant(_v)").startswith("OBJECT"), cells))
    # each text once, in a step of its own: the casts look at it several times
    d = d.select("fichier", "ligne_id", "_m", F.array_except(F.map_keys("_m"), F.coalesce("_own", F.array().cast("array<string>"))).alias("_rest"), *[F.nullif(F.trim(_text(f)), F.lit("")).alias(f"_{f.name}") for f in project])
    others = F.map_from_arrays("_rest", F.transform("_rest", lambda k: F.try_variant_get(F.col("_m")[k], "$", "string")))
    cast = [_cast(F.col(f"_{f.name}"), f.type).alias(f.name) for f in project]
    return d.select("fichier", "ligne_id", *cast, F.when(F.col("_m").isNotNull(), others).alias("autres"))


def _text(f: Field) -> Column:
    """The text of the column's cell in a row: of an object its first nested name, where the column has any."""
    x = F.col("_m")[F.col("_headers")[f.name]]
    text = F.try_variant_get(x, "$", "string")
    if not f.nested:
        return text
    return F.when(F.schema_of_variant(x).startswith("OBJECT"), F.try_variant_get(x, f"$.{f.nested[0]}", "string")).otherwise(text)


def _cast(t: Column, to: str) -> Column:
    """A trimmed text as the type. What isn't written as a number is never cast: a failed cast costs an exception."""
    number = lambda c: F.when(c.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), c.try_cast("double"))
    if to == "double":
        return number(F.translate(t, ", \u00a0\u202f\t", "."))
    if to == "date":
        serial = number(t)
        return F.coalesce(
            F.when(t.rlike(r"^\d{1,2}/\d{1,2}/\d{4}"), F.try_to_timestamp(F.substring(t, 1, 10), F.lit("d/M/yyyy")).cast("date")),
            F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(t, 1, 10).try_cast("date")),
            F.when((serial > 0) & (serial < 73051), F.date_add(F.lit("1899-12-30").cast("date"), serial.try_cast("int"))),
        )
    return F.regexp_replace(t, r"\.0$", "")
