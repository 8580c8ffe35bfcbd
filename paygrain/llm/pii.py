"""Personal information in free text: e-mail addresses, phone numbers, identity numbers, street addresses, names.

High-recall generators propose spans, overlapping ones too. Boosted trees, one set per kind, judge each span by its format
and its context; calibrated probabilities over a threshold per kind select, and of overlapping selected spans the more
probable, then the longer, stays. The trees are fitted on sentences made by rule (pii_training.py), whose number is a
parameter; nothing is fitted on the corpus. Every text is searched whole.

A generator leaves out only what its format excludes: fewer than eight digits for a phone number, a calendar date, a row
of capitalised words that holds an article. Names are proposed in rows of capitalised words of any length, as windows of
up to NAME_WORDS words; a longer name comes out in parts.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .boosting import Trees
from .pii_training import KNOWN
from .pii_words import BREAK, CLASSES, COMMON, FIRM, GIVEN, LOW_TITLES, PARTICLE, STREET, TITLES
from .spread import spread

KINDS = ("email", "phone", "id", "address", "name")
NAME_WORDS = 6

STREETS_FR = "rue|r\\.|avenue|av\\.|boulevard|bd|quai|all[ée]e|chemin|place|impasse|route|ruelle|passage|square|cit[ée]|villa|carrefour|cours|sentier|esplanade|voie|rond-point"
STREETS_EN = "Street|Road|Lane|Avenue|Drive|Close|Way|Square|Court|Terrace|Boulevard|Place|Crescent|St|Rd|Ave|Ln"
_UP, _LO = "A-ZÀ-ÖØ-ÞŒŠŽ", "a-zà-öø-ÿœšž"
_GAP = r"[^\S\r\n]{1,3}"
_WORD = rf"(?:[{_UP}{_LO}]+|(?=['’‑-]))(?:['’‑-][{_UP}][{_UP}{_LO}]*)*(?![\w'’@])"
_DOTTED = rf"(?:me|lle|[mrs]|rs|r|rof|e)?\.(?:-?[{_UP}]\.)?(?=\s{{0,3}}[{_UP}])"
# the first letter leads, so that the search runs along capitals alone
_TOKEN = rf"[{_UP}](?<![\w'’@.\[/].)(?:{_DOTTED}|{_WORD})"
_LINK = rf"(?:{_GAP}(?:de|du|van|von|der|den|ben|bin|el|al|da|dos|di|del|ould)){{0,2}}(?:{_GAP}d['’]|{_GAP})"
_NEXT_TOKEN = rf"[{_UP}](?:{_DOTTED}|{_WORD})"
_RUN = re.compile(rf"{_TOKEN}(?:{_LINK}{_NEXT_TOKEN})+")
_LOW_RUN = re.compile(rf"\b(?:{'|'.join(LOW_TITLES)}){_GAP}({_NEXT_TOKEN}(?:{_LINK}{_NEXT_TOKEN})*)")
_TOKENS = re.compile(_NEXT_TOKEN)
_LINKED = re.compile(rf"{_LINK}\Z")
_AT = tuple(re.compile(rx, re.I) for rx in (r"@\s?", r"[\[({<]\s?(?:at|arobase|@)\s?[\])}>]\s?", r"\s(?:at|arobase)\s"))
_DOT = r"(?:\.|\s?[\[({<]\s?(?:dot|point|\.)\s?[\])}>]\s?|\s(?:dot|point)\s)"
_LABEL = r"[^\W_](?:[\w-]*[^\W_])?"
_HOST = re.compile(rf"{_LABEL}(?:{_DOT}{_LABEL})+(?![\w@])", re.I)
_USER = re.compile(r"\w[\w.+-]*")
_SEP = r"[ .\-/\u00a0\u202f\u2009]"
# digits and what may stand between those of one number
_DIGITS = re.compile(r"[+(\d][\d()+ .\-/\u00a0\u202f\u2009]{6,}")
_PHONE = re.compile(
    rf"(?<![\w.,/+-])(?:\(?(?:\+|00){_SEP}?\d{{1,3}}\)?{_SEP}{{0,2}})?\(?\d{{1,4}}\)?(?:{_SEP}{{0,2}}\d{{2,4}}){{2,6}}(?![\w])|(?<![\w.,/+-])(?:\+|00)?\d{{8,14}}(?![\w])"
)
_STOP = re.compile(r"[.\-/] ")
_DATE = re.compile(r"(?:(?:19|20)\d\d([-/.])(?:0?\d|1[0-2])\1[0-3]?\d|[0-3]?\d([-/.])(?:0?\d|1[0-2])\2(?:19|20)\d\d)(?:\D{1,2}[0-2]?\d)?")
_ID_END = r"(?![\w/-]|\.\w)"
_ID = re.compile(
    r"[A-Z](?<![\w/.-].)(?:[A-Z]{0,2}[ -]?\d{3,4}(?:[ -]?\d{2,4}){1,4}|[A-Z]{0,2}[ -]?\d{6,12}|\d{7})" + _ID_END + r"|\d(?<![\w/.-].)(?:\d[ -]?[A-Z]{1,3}[ -]?\d{4,7}|\d{8,12})" + _ID_END
)
_ID_DIGITS = re.compile(r"(?<![\w/.-])(?:[12] ?\d\d ?\d\d ?\d\d ?\d{3} ?\d{3}(?: ?\d\d)?|\d{3}-\d\d-\d{4})" + _ID_END)
_TAIL = rf"(?:(?i:d[ue]s?|de la|de l['’]|aux?|à la|l[ae]s?)\s+|[dl]['’])*[{_UP}][\w'’-]*(?:{_GAP}(?:(?i:d[ue]s?|de la|aux?){_GAP})?[{_UP}][\w'’-]*)*"
_ADDRESS = re.compile(
    rf"\d(?<![\w./,-].)\d{{0,4}}(?:(?:\s?(?i:bis|ter|quater)\b|\s?[A-D]\b|[a-z]\b)?\s?,?\s*(?i:{STREETS_FR})\s+{_TAIL}|[a-zA-D]?,?\s+(?:[{_UP}][\w'’-]*{_GAP}){{1,4}}(?i:{STREETS_EN})\b)"
)
_LOT = re.compile(r"(?<![\w-])(?:lot|villa|porte)\s+(?:\d+[a-z]?\s?,?\s*(?:[îi]lot|bloc)\s+)?\Z", re.I)
_NUMBER_AFTER = re.compile(r",\s*(?:n\s?[°º]|no\.?|num[ée]ro|lot)\s?\d+(?:\s?(?:bis|ter)\b)?", re.I)
_STREET_BEFORE = re.compile(rf"(?<![\w-])(?i:{STREETS_FR})\s+{_TAIL}\s?\Z")
_CONTEXT = re.compile(r"[^\W\d]\w*|[:;=\"(<\[°]|\n")
_AFTER = re.compile(r"[^\W\d]\w*|[:;=\")>\],.\n]|\d+")
_MARKS = re.compile("[̀-ͯ]+")
_SUFFIX = re.compile(r"(?:tion|sion|ment|ite|age|ence|ance|ique|ing|ness|ity|aire|eur|euse|isme|als?|ive?s?|ees?|aux)s?$")
#: How far the search for a street goes back from a number behind it.
REACH = 240


def fold(w: str) -> str:
    return _MARKS.sub("", unicodedata.normalize("NFKD", w)).lower() if not w.isascii() else w.lower()


@lru_cache(maxsize=200_000)
def _classes(w: str) -> int:
    """The classes a word of the context belongs to, one bit each."""
    f = fold(w)
    return sum(1 << i for i, c in enumerate(CLASSES) if f in c)


@lru_cache(maxsize=200_000)
def _part(w: str) -> tuple[int, ...]:
    """What a capitalised word may be: title, break, particle, given, common, known, firm, street, noun-like, capitals."""
    f = fold(w.rstrip("."))
    first = f.split("-")[0]
    known = f in KNOWN or f in COMMON or any(f in c for c in CLASSES[1:])
    return (
        int(f in TITLES), int(f in BREAK and w[-1] != "."), int(f in PARTICLE and w[-1] != "."), int(f in GIVEN or first in GIVEN), int(f in COMMON), int(known), int(f in FIRM), int(f in STREET),
        int(bool(_SUFFIX.search(f))), int(len(w) > 2 and w.isupper()),
    )


@dataclass(frozen=True)
class Span:
    """A proposed span; left, right: capitalised words of its row on either side, titled: stands after a title; before: the
    capitalised word before it, if any, is a common word or breaks a row."""

    kind: str
    start: int
    end: int
    left: int = 0
    right: int = 0
    titled: bool = False
    words: tuple[str, ...] = ()
    before: int = 0


def candidates(text: str) -> list[Span]:
    """Every proposed span."""
    out = list(_emails(text))
    ids = {m.span() for m in _ID.finditer(text)}
    for area in _DIGITS.finditer(text):
        a = area[0]
        if sum(map(a.count, "0123456789")) < 8:
            continue
        # one character more, so that what follows a number is seen
        at, to = area.start(), area.end() + 1
        for m in _PHONE.finditer(text, at, to):
            # a full stop may end a sentence between two numbers: the parts are proposed too
            cuts = [c.span() for c in _STOP.finditer(m[0])]
            for x, y in {(0, len(m[0])), *((0, c) for c, _ in cuts), *((c, len(m[0])) for _, c in cuts)}:
                s = m[0][x:y]
                if sum(map(s.count, "0123456789")) >= 8 and not _DATE.fullmatch(s):
                    out.append(Span("phone", m.start() + x, m.start() + y))
        ids.update(m.span() for m in _ID_DIGITS.finditer(text, at, to))
    out += [Span("id", *ab) for ab in sorted(ids)]
    out += [Span("address", *ab) for ab in _addresses(text)]
    out += _names(text)
    return out


def _emails(text: str) -> Iterator[Span]:
    for k, rx in enumerate(_AT):
        if k == 0 and "@" not in text:
            continue
        for m in rx.finditer(text):
            host = _HOST.match(text, m.end())
            if not host:
                continue
            # the user's part is read from its end
            a = m.start() - (k < 2 and text[m.start() - 1 : m.start()].isspace())
            user = _USER.match(text[max(0, a - 80) : a][::-1])
            if user and (n := len(user[0].rstrip(".+-"))):
                yield Span("email", a - n, host.end())


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    for m in _ADDRESS.finditer(text):
        a = m.start()
        lot = _LOT.search(text, max(0, a - 40), a)
        yield lot.start() if lot else a, m.end()
    for m in _NUMBER_AFTER.finditer(text):
        street = _STREET_BEFORE.search(text, max(0, m.start() - REACH), m.start())
        if street:
            yield street.start(), m.end()


def _names(text: str) -> Iterator[Span]:
    """Windows of words in rows of capitalised words; a single word only after a title. Articles and the like part a row.
    Before a family name alone, M. may be an initial: windows with and without it are proposed."""
    for m in _RUN.finditer(text):
        yield from _windows(text, m.start(), m.end(), False)
    if any(t in text for t in LOW_TITLES):
        for m in _LOW_RUN.finditer(text):
            yield from _windows(text, m.start(1), m.end(1), True)


def _windows(text: str, a: int, b: int, titled: bool) -> Iterator[Span]:
    row: list[tuple[int, int, str, tuple[int, ...]]] = []
    segments: list[tuple[bool, list]] = []
    for m in _TOKENS.finditer(text, a, b):
        w = m[0]
        p = _part(w)
        if p[0] and not (w == "M." and (titled or row)):
            segments.append((titled, row))
            row, titled = [], True
            if w == "M.":
                row.append((m.start(), m.end(), w, p))
        elif p[1]:
            segments.append((titled, row))
            row, titled = [], False
        else:
            row.append((m.start(), m.end(), w, p))
    segments.append((titled, row))
    for after, row in segments:
        n = len(row)
        for i in range(n):
            here = (after and i == 0 and row[0][2] != "M.") or (i > 0 and row[i - 1][2] == "M.")
            if row[i][3][2] and not here:
                continue
            for j in range(i if here else i + 1, min(i + NAME_WORDS, n)):
                if row[j][3][2] or row[j][2][-1] == ".":
                    continue
                yield Span("name", row[i][0], row[j][1], i, n - 1 - j, here, tuple(r[2] for r in row[i : j + 1]), row[i - 1][3][5] if i else 0)


SPAN_FEATURES = 30
PLAIN = SPAN_FEATURES + 7
_TAILS = {c: k for k, cs in enumerate((":", "=\"';|", "(<[{", ".!?", ",", "\n\r", "°#"), 1) for c in cs}
_HEADS = {c: k for k, cs in enumerate((".!?", ",;", ")>]\"'}", "\n\r", ":"), 1) for c in cs}
WIDTH = SPAN_FEATURES + 2 + 3 * len(CLASSES) + len(set(_TAILS.values())) + len(set(_HEADS.values())) + 2


def features(text: str, s: Span) -> list[float]:
    """Format of the span, words and signs around it: PLAIN numbers, of which the last are class masks and codes."""
    a, b, kind = s.start, s.end, s.kind
    t = text[a:b]
    left, right = text[a - 56 if a > 56 else 0 : a], text[b : b + 36]
    f = [0.0] * PLAIN
    f[0] = b - a
    if kind == "name":
        ps = [_part(w) for w in s.words]
        first, last = ps[0], ps[-1]
        f[1] = len(ps)
        f[2], f[3], f[4] = sum(p[3] for p in ps), first[3], last[3]
        f[5], f[6] = sum(p[9] for p in ps), all(p[9] or len(w) < 3 for p, w in zip(ps, s.words))
        f[7] = s.words[0][-1] == "."
        f[8], f[9], f[10], f[11] = sum(p[4] for p in ps), sum(p[5] for p in ps), sum(p[6] for p in ps), sum(p[7] for p in ps)
        f[12] = "-" in t
        f[13], f[14] = min(s.left, 4), min(s.right, 4)
        f[15] = min(map(len, s.words))
        f[16] = s.titled
        f[17] = first[5] + 2 * last[5]
        f[18] = sum(p[8] for p in ps)
        f[19] = last[6]
        f[20] = sum(p[2] for p in ps)
        f[21] = len(t.split()) - len(ps)
        nxt = _TOKENS.match(text, _skip(text, b)) if s.right else None
        np_ = _part(nxt[0]) if nxt else None
        f[22], f[23], f[24] = (np_[3], np_[6], np_[5]) if np_ else (0, 0, 0)
        f[23] += 2 * s.before
        f[25] = s.words[0] == "M."
        f[26] = right[:1].isspace() and right.lstrip(" \t  ")[:1].islower()
    elif kind in ("phone", "id"):
        groups = [len(g) for g in re.findall(r"\d+", t)]
        d = re.sub(r"\D", "", t)
        f[1], f[2] = len(d), sum(map(str.isupper, t))
        f[3], f[4], f[5] = len(groups), groups[0], groups[-1]
        f[6] = t[0] in "+(" or t.startswith("00")
        f[7] = len(groups) > 1 and len(set(groups[1:] if f[6] else groups)) == 1
        f[8] = d[:1] == "0"
        f[9] = len({c for c in t if not c.isalnum()} - set("()+"))
        f[10] = "/" in t or "-" in t
        f[11] = bool(re.match(r"\d{1,4}[-/.]\d{1,2}[-/.]\d{1,4}", t))
        f[12] = bool(re.fullmatch(r"\d{1,3}([ .   ]\d{3})+", t))
        f[13] = t[0].isalpha() + 2 * bool(re.match(r"\d\d ?[A-Z]", t))
        f[15], f[17] = max(groups), min(groups)
        f[16] = d == d[:1] * len(d) or d.startswith("000000")
        f[18] = bool(re.match(r"\s?[%:€$]|[   ]?\d", right))
        f[19] = bool(re.search(r"\d[   .,:-]?$|[_$€=<>+*/-]$", left))
        f[20] = "-" in t
    elif kind == "email":
        parts = re.findall(r"\w+", t)
        f[3], f[4], f[5] = "@" in t, bool(re.search(r"[\[({<]", t)), bool(re.search(r"\s", t))
        f[6], f[7] = len(parts), len(parts[-1])
        f[8] = bool(re.search(r"(?i)\.|\bdot\b|\bpoint\b", t))
        f[9] = parts[-1].isalpha()
        at = t[len(_USER.match(t)[0].rstrip(".+-")) :]
        tight = at.lstrip()[:1]
        f[11] = 0 if at[:1] == "@" and not at[1:2].isspace() else 1 if tight == "@" else 2 if tight in "[({<" else 3
        f[12] = bool(re.search(r"(?i)\b(?:dot|point)\b", t))
    else:
        f[3], f[4] = t[0].isdigit(), bool(re.match(r"(?i)lot|villa|porte", t))
        f[5] = bool(re.search(r"\d\w*$", t))
        f[6], f[7] = len(re.findall(r"\w+", t)), t[0].isupper()
        f[8] = bool(re.search(rf"(?:{STREETS_EN})$", t))
        f[9] = bool(re.search(r"\d[   .,]?$", left))
        f[10] = "\n" in t
    f[27], f[28] = left.isupper(), right.isupper()
    words = [w for w in _CONTEXT.findall(left)[-6:] if w[0].isalpha()]
    if words:
        f[29] = len(words[-1]) <= 3
        f[30] = _classes(words[-1])
        far = 0
        for w in words[-4:-1]:
            far |= _classes(w)
        f[31] = far
    nxt_mask = 0
    for w in _AFTER.findall(right)[:2]:
        nxt_mask |= _classes(w)
    f[32] = nxt_mask
    tail, head = left.rstrip(" \t  ​")[-1:], right.lstrip(" \t  ")[:1]
    f[33] = _TAILS.get(tail, 0) if left else _TAILS["\n"]
    f[34] = _HEADS.get(head, 0) if right else _HEADS["\n"]
    f[35] = left[-1:].isspace() or not left
    f[36] = left[-1:] in "\n\r" or not left
    return f


def _skip(text: str, b: int) -> int:
    while b < len(text) and text[b].isspace():
        b += 1
    return b


def expanded(rows: Sequence[list[float]]) -> np.ndarray:
    """The trees' matrix: class masks as one column per class, codes as one per code."""
    x = np.array(rows, dtype=float).reshape(len(rows), PLAIN)
    bits = np.arange(len(CLASSES))
    masks = [(x[:, c].astype(np.int64)[:, None] >> bits) & 1 for c in (SPAN_FEATURES, SPAN_FEATURES + 1, SPAN_FEATURES + 2)]
    tails = x[:, [SPAN_FEATURES + 3]] == np.arange(1, len(set(_TAILS.values())) + 1)
    heads = x[:, [SPAN_FEATURES + 4]] == np.arange(1, len(set(_HEADS.values())) + 1)
    return np.hstack([x[:, :SPAN_FEATURES], x[:, SPAN_FEATURES + 5 :], *masks, tails, heads])


@dataclass(frozen=True)
class Model:
    trees: dict[str, Trees]
    cut: dict[str, float]


@lru_cache(maxsize=4)
def train(sentences: int = 8000, seed: int = 7, trees: int = 60) -> Model:
    """Fit, calibrate and choose thresholds on `sentences` texts made by rule, six eighths of the texts for the first and
    one for each of the others; the same model for the same arguments."""
    from . import boosting
    from .pii_training import sample

    x: dict[str, list[list[float]]] = {k: [] for k in KINDS}
    y: dict[str, list[int]] = {k: [] for k in KINDS}
    part: dict[str, list[int]] = {k: [] for k in KINDS}
    for i, (text, spans) in enumerate(sample(sentences, seed)):
        truth = set(spans)
        for s in candidates(text):
            x[s.kind].append(features(text, s))
            y[s.kind].append(int((s.kind, s.start, s.end) in truth))
            part[s.kind].append(i % 8)
    got, cut = {}, {}
    for k in KINDS:
        xs, ys, ps = expanded(x[k]), np.array(y[k], float), np.array(part[k])
        m = boosting.fit(xs[ps < 6], ys[ps < 6], trees=trees)
        boosting.calibrate(m, xs[ps == 6], ys[ps == 6])
        got[k], cut[k] = m, boosting.threshold(m.probability(xs[ps == 7]), ys[ps == 7])
    return Model(got, cut)


def find(texts: list[str | None], model: Model) -> list[list[tuple[str, int, int]]]:
    """Selected spans of each text, in order, without overlaps."""
    by: dict[str, list[tuple[int, Span]]] = {k: [] for k in KINDS}
    rows: dict[str, list[list[float]]] = {k: [] for k in KINDS}
    for i, t in enumerate(texts):
        for s in candidates(t) if t else ():
            by[s.kind].append((i, s))
            rows[s.kind].append(features(t, s))
    best: dict[int, list[tuple[float, int, int, str]]] = {}
    for k in KINDS:
        if by[k]:
            p = model.trees[k].probability(expanded(rows[k]))
            for at in np.flatnonzero(p >= model.cut[k]):
                i, s = by[k][at]
                best.setdefault(i, []).append((-float(p[at]), s.start - s.end, s.start, k))
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    for i, got in best.items():
        taken: list[tuple[str, int, int]] = []
        for _, minus, a, k in sorted(got):
            if all(a - minus <= t[1] or a >= t[2] for t in taken):
                taken.append((k, a, a - minus))
        out[i] = sorted(taken, key=lambda s: s[1])
    return out


def _composed(text: str | None) -> tuple[str | None, list[int] | None]:
    """The text with letters and accents composed, and for each of its places the place in the text as written; None
    where nothing changed."""
    if text is None or text.isascii() or unicodedata.is_normalized("NFC", text):
        return text, None
    parts, at, i = [], [], 0
    for m in re.finditer(r"(?s).[̀-ͯ]*", text):
        c = unicodedata.normalize("NFC", m[0])
        parts.append(c)
        at += [m.start()] + [m.end()] * (len(c) - 1)
        i = m.end()
    return "".join(parts), [*at, i]


def find_as_written(texts: list[str | None], model: Model) -> list[list[tuple[str, int, int]]]:
    both = [_composed(t) for t in texts]
    got = find([t for t, _ in both], model)
    return [[(k, at[a], at[b]) for k, a, b in g] if at else g for g, (_, at) in zip(got, both)]


#: Texts whose spans the trees judge together.
TOGETHER = 512


def personal_information(docs: DataFrame, sentences: int = 8000, seed: int = 7) -> DataFrame:
    """(doc_id, nature, valeur): what each text holds, distinct per row of docs, as written. Null and empty texts hold
    nothing; repeated documents are reported each. Narrow; only a table of fewer splits than cores is dealt out first."""
    model = train(sentences, seed)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lo in range(0, len(b), TOGETHER):
                part = b.iloc[lo : lo + TOGETHER]
                texts = [t if isinstance(t, str) else None for t in part["text"]]
                rows = []
                for doc, t, g in zip(part["doc_id"], texts, find_as_written(texts, model)):
                    rows += [(doc, k, v) for k, v in dict.fromkeys((k, t[x:y]) for k, x, y in g)]
                yield pd.DataFrame(rows, columns=["doc_id", "nature", "valeur"]).astype({"doc_id": "int64"})

    return spread(docs.select("doc_id", "text").where("text IS NOT NULL")).mapInPandas(run, "doc_id bigint, nature string, valeur string")


def redact(docs: DataFrame, sentences: int = 8000, seed: int = 7) -> DataFrame:
    """(doc_id, text): every row, each found span replaced by [EMAIL], [PHONE], [ID], [ADDRESS] or [NAME]; the rest as
    written. Null stays null."""
    model = train(sentences, seed)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            new = []
            for lo in range(0, len(b), TOGETHER):
                texts = [t if isinstance(t, str) else None for t in b["text"].iloc[lo : lo + TOGETHER]]
                for t, g in zip(texts, find_as_written(texts, model)):
                    for k, x, y in reversed(g):
                        t = f"{t[:x]}[{k.upper()}]{t[y:]}"
                    new.append(t)
            yield pd.DataFrame({"doc_id": b["doc_id"], "text": pd.Series(new, dtype=object, index=b.index)})

    return spread(docs.select("doc_id", "text")).mapInPandas(run, "doc_id bigint, text string")
