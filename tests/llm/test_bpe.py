"""The encoder against the vocabulary's own library and against plain merging."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

pytest.importorskip("ahocorasick")
P = pytest.importorskip("public_tokenizers")
from paygrain.llm.bpe import Bpe, default_path, encode_texts  # noqa: E402

CASES = [
    "", " ", "\n\n \t x", "Été à l'école, 1 250 000 F", "don't we'll I'M", "<|endoftext|>a<|endoftext|>", "工资 数据 缺失", "رقم الملف غير واضح", "👍🏽 reçu 🇫🇷👨‍👩‍👧", "zéro​largeur﻿",
    "ŠŽĐ ąęł Ўў", "Ⅻ² ½ № 7", "ﬁn de ﬁche", "été", "𝟙{D_jt=1}", "a" * 3000, " " * 999 + "x", "=-" * 700, "\x00\x1c\x85 　x", "0" * 400,
]


@pytest.fixture(scope="module")
def both():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_path())
    t.encode_special_tokens = True
    return Bpe(default_path()), lambda s: t.encode(s, add_special_tokens=False).ids


@pytest.mark.parametrize("text", CASES)
def test_cases(both, text):
    ours, theirs = both
    assert ours.encode(text) == theirs(text)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60))
def test_any_text(both, text):
    ours, theirs = both
    assert ours.encode(text) == theirs(text)


def test_words_made_of_frequent_letters(both):
    ours, theirs = both
    r = random.Random(3)
    for _ in range(3000):
        s = "".join(r.choice("etaoinshrdlu") for _ in range(r.randint(1, 40)))
        assert ours.encode(s) == theirs(s)


def test_plain_merging(both):
    ours, _ = both
    rank = {p: k for p, k in ours.joined.items()}
    r = random.Random(4)
    for _ in range(300):
        s = "".join(r.choice("abcdest ") for _ in range(r.randint(1, 30))).strip() or "a"
        ids = [ours.by_text[c] for c in s]
        while True:
            best = min(((rank[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in rank), default=None)
            if best is None:
                break
            ids[best[1] : best[1] + 2] = [best[0]]
        assert ours.encode_piece(s) == ids


def test_long_piece_is_linear(both):
    import time

    ours, _ = both
    took = []
    for n in (20_000, 80_000):
        t = time.process_time()
        ours.encode_piece("ab" * n)
        took.append(time.process_time() - t)
    assert took[1] < 12 * max(took[0], 0.02)


def test_table(spark, both):
    ours, _ = both
    d = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "le salaire", "x"), (3, "le salaire", "y"), (4, " ", "x")], "doc_id bigint, text string, ids string")
    got = sorted((r.doc_id, list(r.ids)) for r in encode_texts(d).collect())
    assert got == [(1, []), (2, []), (3, ours.encode("le salaire")), (3, ours.encode("le salaire")), (4, ours.encode(" "))]
    assert encode_texts(d.where("false")).collect() == []
