"""Held-out test passages inside a training corpus.

All normalised passages make up one generalised suffix automaton over words. Documents stream through it: after each word
the automaton holds the longest stretch, ending there, that stands in some passage. Where that stretch is long enough its
passages are candidates of the document; for each, the matching stretches are chained in the passage's own order and
counted. Documents are never joined with one another or with the passages; the automaton's size is that of the passages.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spread import spread

_MARKS = re.compile("[̀-ͯ­​-‏⁠﻿]+")
_WORDS = re.compile(r"[^\W_]+")
_BROKEN = re.compile(r"(?<=[^\W\d_])[-‐­]\s*\n\s*(?=[^\W\d_])")
_LETTERS = str.maketrans({"œ": "oe", "æ": "ae", "ø": "o", "ł": "l", "đ": "d", "ß": "ss"})


def words(text: str | None) -> list[str]:
    """Words of a text in lower case, without accents; a word broken at a line's end is put together."""
    if not text:
        return []
    t = _BROKEN.sub("", text)
    t = _MARKS.sub("", unicodedata.normalize("NFKD", t)).casefold()
    if not t.isascii():
        t = t.translate(_LETTERS)
    return _WORDS.findall(t)


def located(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """The same words with the places of each in the text: start and end."""
    kept = bytearray(b"\1") * len(text)
    for m in _BROKEN.finditer(text):
        kept[m.start() : m.end()] = bytes(m.end() - m.start())
    out: list[str] = []
    at: list[int] = []
    group: list[int] = []

    def close() -> None:
        # characters and the marks on them are normalised together, as their order may change
        t = _MARKS.sub("", unicodedata.normalize("NFKD", "".join(text[i] for i in group))).casefold().translate(_LETTERS)
        out.append(t)
        at.extend([group[0]] * len(t))

    for i, c in enumerate(text):
        if not kept[i]:
            continue
        if group and not unicodedata.combining(unicodedata.normalize("NFKD", c)[0]):
            close()
            group = []
        group.append(i)
    if group:
        close()
    found = list(_WORDS.finditer("".join(out)))
    places = []
    for m in found:
        end = at[m.end() - 1] + 1
        while end < len(text) and unicodedata.combining(text[end]):
            end += 1
        places.append((at[m.start()], end))
    return [m[0] for m in found], places


class Automaton:
    """Generalised suffix automaton of word sequences."""

    def __init__(self, items: Sequence[tuple[int, list[str]]], stretch: int):
        self.stretch = stretch
        self.vocab: dict[str, int] = {}
        self.items = {i: [self.vocab.setdefault(w, len(self.vocab)) for w in ws] for i, ws in items}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.own: list[set[int]] = [set()]
        for i, ws in self.items.items():
            last = 0
            for w in ws:
                last = self._extend(last, w)
                self.own[last].add(i)
        # passages of a state: its own and those of the states below it in the tree of links. The tree is walked once and
        # the passages are laid out in the order of the walk, so that those below a state stand side by side
        below: list[list[int]] = [[] for _ in self.next]
        for s in range(1, len(self.next)):
            below[self.link[s]].append(s)
        self.order: list[int] = []
        self.first, self.after = [0] * len(self.next), [0] * len(self.next)
        stack = [0]
        while stack:
            s = stack.pop()
            if s < 0:
                self.after[~s] = len(self.order)
                continue
            self.first[s] = len(self.order)
            self.order += sorted(self.own[s])
            stack.append(~s)
            stack += below[s]
        self.own = []
        # of a state, the widest state above it that is still long enough: it holds every passage with the last words
        self.widest = [0] * len(self.next)
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            up = self.link[s]
            self.widest[s] = self.widest[up] if up > 0 and self.length[up] >= stretch else s
        self._grams: dict[int, dict[tuple[int, ...], list[int]]] = {}

    def _new(self, length: int, nxt: dict[int, int], link: int) -> int:
        self.next.append(nxt)
        self.link.append(link)
        self.length.append(length)
        self.own.append(set())
        return len(self.next) - 1

    def _extend(self, p: int, w: int) -> int:
        if w in self.next[p]:
            q = self.next[p][w]
            return q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
        cur = self._new(self.length[p] + 1, {}, 0)
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = cur
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
        return cur

    def _split(self, p: int, w: int, q: int) -> int:
        c = self._new(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = c
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = c
            p = self.link[p]
        return c

    def candidates(self, ids: list[int]) -> set[int]:
        """Passages that share a long enough stretch with the words; ids are vocabulary numbers, -1 for other words."""
        s = n = 0
        nxt, link, length, least = self.next, self.link, self.length, self.stretch
        found: set[int] = set()
        seen: set[int] = set()
        for w in ids:
            if w < 0:
                s = n = 0
                continue
            t = nxt[s].get(w)
            while t is None and s > 0:
                s = link[s]
                n = length[s]
                t = nxt[s].get(w)
            if t is None:
                s = n = 0
                continue
            s, n = t, n + 1
            if n >= least:
                u = s
                while length[link[u]] >= n:  # the state whose words are as long as the match
                    u = link[u]
                u = self.widest[u]
                if u not in seen:
                    seen.add(u)
                    found.update(self.order[self.first[u] : self.after[u]])
        return found

    def _stretches(self, item: int) -> dict[tuple[int, ...], list[int]]:
        """Places of the item's stretches of the least length."""
        grams = self._grams.get(item)
        if grams is None:
            k, p = self.stretch, self.items[item]
            grams = self._grams[item] = {}
            for i in range(len(p) - k + 1):
                grams.setdefault(tuple(p[i : i + k]), []).append(i)
        return grams

    def spans(self, ids: list[int], item: int) -> list[tuple[int, int]]:
        """Places (first word, word after the last) of every stretch of the words that stands in the item, in any order."""
        k, grams = self.stretch, self._stretches(item)
        return joined([(j, j + k) for j in range(len(ids) - k + 1) if tuple(ids[j : j + k]) in grams])

    def overlap(self, ids: list[int], item: int, enough: int) -> int:
        """The most words of the item that the document holds in its order, in disjoint stretches; counting stops at
        enough. A stretch that ends at a pair of places is the one that ended a word before, grown by a word, or a new
        one after the best chain that ends before it in both; those are kept in a tree of maxima over the passage."""
        k, p = self.stretch, self.items[item]
        grams = self._stretches(item)
        tree = [0] * (len(p) + 1)
        before: dict[int, int] = {}
        waiting: list[tuple[int, list[tuple[int, int]]]] = []
        done = top = 0
        for j in range(len(ids) - k + 1):
            hits = grams.get(tuple(ids[j : j + k]))
            if not hits:
                before = {}
                continue
            while done < len(waiting) and waiting[done][0] <= j - k:
                for end, v in waiting[done][1]:
                    while end <= len(p):
                        tree[end] = max(tree[end], v)
                        end += end & -end
                done += 1
            now = {}
            for i in hits:
                best, at = 0, i
                while at > 0:
                    best = max(best, tree[at])
                    at -= at & -at
                now[i] = max(best + k, before.get(i - 1, 0) + 1)
                top = max(top, now[i])
            if top >= enough:
                return top
            waiting.append((j, [(i + k, v) for i, v in now.items()]))
            before = now
        return top


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans with those that overlap put together."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


@dataclass(frozen=True)
class LeakRules:
    """least: words of a passage that make a leak; stretch: words in a row that count; block: words of passages that one
    automaton takes - more passages are worked through in several blocks, each against all documents. coverage: in
    remove, the share of a passage's words that is over the limit even under least words."""

    least: int = 20
    stretch: int = 5
    block: int = 2_000_000
    coverage: float = 0.8


_BUILT: dict[tuple, Automaton] = {}


def _automaton(items: tuple[tuple[int, str], ...], stretch: int) -> Automaton:
    key = (hash(items), len(items), stretch)
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Automaton([(i, words(p)) for i, p in items], stretch)
    return _BUILT[key]


def leaks(docs: DataFrame, tests: DataFrame, rules: LeakRules = LeakRules(), passage: str = "passage") -> DataFrame:
    """(doc_id, item_id, mots): documents that hold at least rules.least words of an item's passage in its order, in
    stretches of rules.stretch words or more; mots is counted up to rules.least.

    Letter case, accents, punctuation, blanks and line breaks don't count. Null and empty texts and passages match
    nothing, nor do passages under rules.least words. Repeated documents are reported each, items with one text all.
    Narrow over the documents; only a table of fewer splits than cores is dealt out first."""
    out = None
    for block in _blocks(tests, rules, passage):
        got = spread(docs.select("doc_id", "text").where("text IS NOT NULL")).mapInPandas(_search(block, rules), "doc_id bigint, item_id bigint, mots int")
        out = got if out is None else out.unionByName(got)
    if out is None:
        return docs.select("doc_id", F.lit(0).cast("bigint").alias("item_id"), F.lit(0).alias("mots")).where("false")
    return out


def _blocks(tests: DataFrame, rules: LeakRules, passage: str) -> Iterator[tuple[tuple[int, str], ...]]:
    """Passages in blocks of a bounded number of words, handed over one after the other."""
    block: list[tuple[int, str]] = []
    size = 0
    for r in tests.select("item_id", passage).where(F.col(passage).isNotNull() & F.col("item_id").isNotNull()).toLocalIterator():
        n = len(words(r[1]))
        if n < rules.least:
            continue
        if block and size + n > rules.block:
            yield tuple(block)
            block, size = [], 0
        block.append((r[0], r[1]))
        size += n
    if block:
        yield tuple(block)


def _search(block: tuple[tuple[int, str], ...], rules: LeakRules):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a = _automaton(block, rules.stretch)
        number = a.vocab.get
        for b in batches:
            rows = []
            for doc, text in zip(b["doc_id"], b["text"]):
                ids = [number(w, -1) for w in words(text)]
                for item in sorted(a.candidates(ids)):
                    n = a.overlap(ids, item, rules.least)
                    if n >= rules.least:
                        rows.append((doc, item, n))
            yield pd.DataFrame(rows, columns=["doc_id", "item_id", "mots"]).astype({"doc_id": "int64", "item_id": "int64", "mots": "int32"})

    return run


def leak_spans(docs: DataFrame, tests: DataFrame, rules: LeakRules = LeakRules(), passage: str = "passage") -> DataFrame:
    """(doc_id, item_id, debut, fin, mots, part_item, part_texte): the stretches of passages that are over a limit (as in
    remove), by their places in the text as written: first character, character after the last, words. part_item: share
    of the passage's words that the text holds in its order; part_texte: share of the text's words in its stretches."""
    kind = "doc_id bigint, item_id bigint, debut int, fin int, mots int, part_item double, part_texte double"
    out = None
    for block in _blocks(tests, rules, passage):
        got = spread(docs.select("doc_id", "text").where("text IS NOT NULL")).mapInPandas(_spans(block, rules), kind)
        out = got if out is None else out.unionByName(got)
    return docs.sparkSession.createDataFrame([], kind) if out is None else out


def stretches(a: Automaton, text: str, rules: LeakRules) -> list[tuple[int, int, int, int, float, float]]:
    """(item, first character, character after the last, words, share of the item, share of the text)."""
    ids = [a.vocab.get(w, -1) for w in words(text)]
    rows = []
    at: list[tuple[int, int]] = []
    for item in sorted(a.candidates(ids)):
        size = len(a.items[item])
        if a.overlap(ids, item, (enough := min(rules.least, math.ceil(rules.coverage * size)))) >= enough:
            at = at or located(text)[1]
            found = a.spans(ids, item)
            held, mine = a.overlap(ids, item, size + 1) / size, sum(y - x for x, y in found) / len(ids)
            rows += [(item, at[x][0], at[y - 1][1], y - x, round(held, 6), round(mine, 6)) for x, y in found]
    return rows


def _spans(block: tuple[tuple[int, str], ...], rules: LeakRules):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a = _automaton(block, rules.stretch)
        for b in batches:
            rows = [(doc, *r) for doc, text in zip(b["doc_id"], b["text"]) for r in stretches(a, text, rules)]
            kinds = {"doc_id": "int64", "item_id": "int64", "debut": "int32", "fin": "int32", "mots": "int32", "part_item": float, "part_texte": float}
            yield pd.DataFrame(rows, columns=list(kinds)).astype(kinds)

    return run


def remove(docs: DataFrame, tests: DataFrame, rules: LeakRules = LeakRules(), passage: str = "passage") -> DataFrame:
    """(doc_id, text, spans, mots): every text without the stretches of passages over a limit, how many were removed, and
    their words.

    A passage is over the limit in a document that holds rules.least of its words (as in leaks), or rules.coverage of
    them; then all its stretches of rules.stretch words or more go, whatever their order, until none is left. The rest of
    a text stays character by character; a blank stands for a removed stretch. Passages under rules.least words stay, as
    in leaks. Null and empty texts stay as they are."""
    kind = "doc_id bigint, text string, spans int, mots int"
    out = spread(docs.select("doc_id", "text")).select("doc_id", "text", F.lit(0).alias("spans"), F.lit(0).alias("mots"))
    for block in _blocks(tests, rules, passage):
        out = out.mapInPandas(_removal(block, rules), kind)
    return out


def cleaned(a: Automaton, text: str | None, rules: LeakRules) -> tuple[str | None, int, int]:
    """The text without the stretches over a limit, their number and their words."""
    spans = lost = 0
    while True:
        ids = [a.vocab.get(w, -1) for w in words(text)]
        found = []
        for item in a.candidates(ids):
            enough = min(rules.least, math.ceil(rules.coverage * len(a.items[item])))
            if a.overlap(ids, item, enough) >= enough:
                found += a.spans(ids, item)
        if not found:
            return text, spans, lost
        found = joined(found)
        _, at = located(text)
        pieces, done = [], 0
        for x, y in found:
            pieces.append(text[done : at[x][0]])
            done = at[y - 1][1]
        text = " ".join([*pieces, text[done:]])
        spans += len(found)
        lost += sum(y - x for x, y in found)


def _removal(block: tuple[tuple[int, str], ...], rules: LeakRules):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a = _automaton(block, rules.stretch)
        for b in batches:
            got = [cleaned(a, t, rules) for t in b["text"]]
            yield pd.DataFrame(
                {"doc_id": b["doc_id"], "text": [t for t, _, _ in got], "spans": (b["spans"] + [n for _, n, _ in got]).astype("int32"), "mots": (b["mots"] + [n for _, _, n in got]).astype("int32")}
            )

    return run
