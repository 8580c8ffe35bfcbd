"""Token ids of whole texts by a public byte-level BPE vocabulary, in linear time.

Bytes are mapped to Latin-1 characters, so that a token of any bytes is a word of an Aho-Corasick automaton. A piece of
text is encoded by taking the longest match at each place and stepping back - to the next shorter token that starts
there, or to the token before - whenever two neighbours are incompatible, which is to say that merging by rank would have
joined bytes across their border. The check undoes the merges of both tokens along the border and is remembered for each
pair; a place from which the rest failed is never tried again. The result is exactly that of the merges.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .spread import spread

#: The pattern that cuts text into pieces before any merge (fixed value of the vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces remembered per worker before the memory is emptied.
REMEMBERED = 400_000


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_chars() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabulary files write for bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return out | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """A vocabulary file ready to encode; ids of tokens made by merges have to rise with the merge's rank."""

    def __init__(self, path: str):
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        back = _byte_chars()
        latin = lambda s: "".join(chr(back[c]) for c in s)
        special = {t for t in model["vocab"] if any(c not in back for c in t) or t == "<|endoftext|>"}
        self.text = {i: latin(t) for t, i in model["vocab"].items() if t not in special}
        by_text = {t: i for i, t in self.text.items()}
        top = max(self.text) + 1
        self.size = [len(self.text.get(i, "")) for i in range(top)]
        self.left, self.right = list(range(top)), list(range(top))
        self.joined: dict[tuple[int, int], int] = {}
        for m in model["merges"]:
            a, b = (latin(x) for x in (m.split(" ") if isinstance(m, str) else m))
            i, j, k = by_text[a], by_text[b], by_text[a + b]
            if (i, j) not in self.joined:
                self.joined[i, j] = k
            if self.left[k] == k:
                self.left[k], self.right[k] = i, j
        self.auto = ahocorasick.Automaton()
        for t, i in by_text.items():
            self.auto.add_word(t, i)
        self.auto.make_automaton()
        self.longest = max(self.size)
        # the longest token that is a proper beginning of a token; -1 for single bytes
        self.shorter = [-1] * top
        for t, i in by_text.items():
            for n in range(len(t) - 1, 0, -1):
                if t[:n] in by_text:
                    self.shorter[i] = by_text[t[:n]]
                    break
        self.by_text = by_text
        self.pieces = regex.compile(PATTERN)
        # letters and digits that Unicode has had since long; other texts are cut by the vocabulary's own library
        self.settled = regex.compile(r"[\x00-ɏ̀-ͯͰ-ԯ -⁯₠-₿℀-⅏←-⋿─-⛿]*+")
        self._path, self._library = path, None
        self._agree: dict[tuple[int, int], bool] = {}
        self._known: dict[str, list[int]] = {}

    def agree(self, a: int, b: int) -> bool:
        """Whether merging by rank leaves the border between tokens a and b alone."""
        got = self._agree.get((a, b))
        if got is None:
            if len(self._agree) > REMEMBERED:
                self._agree.clear()
            got = self._agree[a, b] = self._border_holds(a, b)
        return got

    def _border_holds(self, a: int, b: int) -> bool:
        limit = len(self.left) + 1
        while True:
            k = self.joined.get((a, b))
            if k is not None and k < limit:
                return False
            # undo the later of the two merges; once neither side has one left the border holds
            a_parts, b_parts = self.right[a] != a, self.left[b] != b
            if a_parts and (a > b or not b_parts):
                limit, a = a, self.right[a]
            elif b_parts:
                limit, b = b + 1, self.left[b]
            else:
                return True

    def encode_piece(self, s: str) -> list[int]:
        """Ids of a piece given as Latin-1 text."""
        whole = self.by_text.get(s)
        if whole is not None and len(s) == 1:
            return [whole]
        n, at, out = len(s), 0, []
        dead = bytearray(n + 1)
        auto, size, far = self.auto, self.size, self.longest
        # only as much as a token may take is handed over: the matcher copies its text
        token = next(auto.iter_long(s[:far]))[1]
        while True:
            last = out[-1] if out else -1
            while token >= 0:
                end = at + size[token]
                if not dead[end] and (last < 0 or self.agree(last, token)):
                    break
                token = self.shorter[token]
            if token >= 0:
                out.append(token)
                at = end
                if at == n:
                    return out
                token = next(auto.iter_long(s[at : at + far]))[1]
            else:
                dead[at] = 1
                token = out.pop()  # tried again from its own start; its end is dead now, so a shorter one follows
                at -= size[token]

    def cut(self, text: str) -> list[str]:
        if self.settled.fullmatch(text):
            return self.pieces.findall(text)
        if self._library is None:
            from tokenizers import Tokenizer  # without it the ids of such texts would be a guess: its absence is an error

            self._library = Tokenizer.from_file(self._path).pre_tokenizer
        return [text[a:b] for _, (a, b) in self._library.pre_tokenize_str(text)]

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        out: list[int] = []
        known = self._known
        for p in self.cut(text):
            ids = known.get(p)
            if ids is None:
                ids = self.encode_piece(p.encode("utf-8").decode("latin-1"))
                if len(p) <= 64:
                    if len(known) > REMEMBERED:
                        known.clear()
                    known[p] = ids
            out += ids
        return out


_LOADED: dict[str, Bpe] = {}


def load(path: str) -> Bpe:
    """One encoder per file and worker."""
    if path not in _LOADED:
        _LOADED[path] = Bpe(path)
    return _LOADED[path]


def encode_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(key, ids): a row for every row of docs, ids without special tokens; the strings of special tokens in a text are
    ordinary text. An empty or null text has an empty list, never null; blank text has the ids of its blanks. Repeated
    rows are encoded each. path: the vocabulary file, present on every executor; nothing of it is copied. Narrow but for a
    table of fewer splits than cores, which is dealt out first; batches stream through, other columns are not read."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in batches:
            flat: list[int] = []
            ends = [0]
            for t in b.column(1):
                flat += bpe.encode(t.as_py())
                ends.append(len(flat))
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), ids], names=[key, "ids"])

    kind = dict(docs.dtypes)[key]
    return spread(docs.select(key, text)).mapInArrow(run, f"`{key}` {kind}, ids array<int>")
