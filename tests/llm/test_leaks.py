"""Leak search against brute force; what counts as a leak."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from paygrain.llm.leaks import Automaton, LeakRules, cleaned, leak_spans, leaks, located, remove, stretches, words

SENT = ["le luthier distrait doubla chaque messager rapide après notre syndic", "ce tribunal tardif redistribua chaque notaire nocturne pour deux cents écus", "notre bûcheron prudent protégea un copiste avare derrière le vieux moulin"]
PASSAGE = ". ".join(SENT) + "."


def run(spark, docs, items, rules=LeakRules()):
    d = spark.createDataFrame(list(enumerate(docs, 1)), "doc_id bigint, text string")
    t = spark.createDataFrame(list(enumerate(items, 101)), "item_id bigint, passage string")
    return sorted((r.doc_id, r.item_id) for r in leaks(d, t, rules).collect())


def test_whole_altered_and_short(spark):
    w = PASSAGE.split()
    altered = " ".join(w[:9] + ["autre"] + w[10:17] + w[18:])
    docs = [
        "Bonjour. " + PASSAGE + " Merci.", PASSAGE.upper().replace(".", " !\r\n"), "texte avant " + altered, SENT[0] + ". Une phrase tout à fait étrangère ici. " + SENT[1] + " fin", " ".join(w[:19]),
        " ".join(reversed(w)), SENT[2] + ". " + SENT[1] + ". " + SENT[0], None, "", "!!! ???", PASSAGE.replace("bûcheron", "bûche-\nron").replace(" ", "  "),
    ]
    assert run(spark, docs, [PASSAGE]) == [(1, 101), (2, 101), (3, 101), (4, 101), (11, 101)]


def test_stretches_of_four_words_dont_count(spark):
    w = words(PASSAGE)
    doc = " xx ".join(" ".join(w[i : i + 4]) for i in range(0, len(w), 4))
    assert run(spark, [doc], [PASSAGE]) == []


def test_repeated_items_documents_and_blocks(spark):
    docs, items = [PASSAGE, PASSAGE], [PASSAGE, None, "", "trop court", PASSAGE]
    want = [(1, 101), (1, 105), (2, 101), (2, 105)]
    assert run(spark, docs, items) == want
    assert run(spark, docs, items, LeakRules(block=10)) == want


def test_empty(spark):
    assert run(spark, [], [PASSAGE]) == [] and run(spark, ["x"], []) == []


def test_words():
    assert words("L'Œuvre était  ﬁnie_ici ; déc­lar-\n  ée.") == ["l", "oeuvre", "etait", "finie", "ici", "declaree"]


def brute(doc, passage, k):
    """Largest number of words in ordered, disjoint common stretches of k words or more."""
    n, m = len(doc), len(passage)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            b = max(best[i + 1][j], best[i][j + 1])
            t = 0
            while i + t < n and j + t < m and doc[i + t] == passage[j + t]:
                t += 1
                if t >= k:
                    b = max(b, t + best[i + t][j + t])
            best[i][j] = b
    return best[0][0]


@settings(max_examples=400, deadline=None)
@given(st.integers(0, 10**6))
def test_against_brute_force(seed):
    r = random.Random(seed)
    vocab = [f"m{i}" for i in range(r.choice([3, 12, 60]))]
    items = {i: [r.choice(vocab) for _ in range(r.randint(3, 25))] for i in range(4)}
    doc = []
    for _ in range(r.randint(0, 6)):
        p = r.choice(list(items.values()))
        a = r.randrange(len(p))
        doc += p[a : a + r.randint(1, 12)] + [r.choice(vocab + ["zz"]) for _ in range(r.randint(0, 2))]
    a = Automaton(list(items.items()), 3)
    ids = [a.vocab.get(w, -1) for w in doc]
    near = {i for i in items if any(items[i][x : x + 3] == doc[y : y + 3] for x in range(len(items[i]) - 2) for y in range(len(doc) - 2))}
    assert a.candidates(ids) == near
    for i in near:
        assert a.overlap(ids, i, 10**9) == brute(doc, items[i], 3)


def test_removal_leaves_the_rest(spark):
    short = " ".join(words(PASSAGE)[:12])
    docs = ["Avant : " + PASSAGE + " Après !", "Un. " + SENT[1].upper() + " ; " + SENT[0] + ", deux " + SENT[2], short, None, "", PASSAGE.replace("bûcheron", "bûche-\nron") + " fin"]
    d = spark.createDataFrame(list(enumerate(docs, 1)), "doc_id bigint, text string")
    t = spark.createDataFrame([(101, PASSAGE), (102, None)], "item_id bigint, passage string")
    got = remove(d, t)
    n = len(words(PASSAGE))
    a, b, c = (len(words(s)) for s in SENT)
    rows = {r.doc_id: (r.text, r.spans, r.mots) for r in got.collect()}
    assert rows == {1: ("Avant :  . Après !", 1, n), 2: ("Un.   ;  , deux  ", 3, a + b + c), 3: (short, 0, 0), 4: (None, 0, 0), 5: ("", 0, 0), 6: (" . fin", 1, n)}
    assert leaks(got, t).count() == 0


def test_coverage_limit():
    p = [f"m{i}" for i in range(22)]
    text = " ".join([*p[:18], "autre"])
    a = Automaton([(1, p)], 5)
    assert cleaned(a, text, LeakRules(coverage=1.0)) == (text, 0, 0)
    assert cleaned(a, text, LeakRules()) == ("  autre", 1, 18)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aÉe\u0301\u0327œﬁß-\n '.,7\u00ad\u200b_ ǅİ한", max_size=40))
def test_located_words_are_the_words(text):
    found, at = located(text)
    assert found == words(text)
    assert all(a < b for a, b in at) and all(x[1] <= y[1] and x[0] <= y[0] for x, y in zip(at, at[1:]))


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**6))
def test_spans_against_brute_force(seed):
    """Every place of a stretch of the passage, and nothing else; shares of passage and text."""
    r = random.Random(seed)
    vocab = [f"m{i}" for i in range(r.choice([4, 30]))]
    items = {i: [r.choice(vocab) for _ in range(r.randint(6, 14))] for i in range(3)}
    doc = []
    for _ in range(r.randint(1, 5)):
        p = r.choice(list(items.values()))
        a = r.randrange(len(p))
        doc += p[a : a + r.randint(1, 12)] + [r.choice(vocab + ["zz"]) for _ in range(r.randint(0, 2))]
    text = " ".join(w.upper() if r.random() < 0.5 else w for w in doc)
    rules = LeakRules(least=6, stretch=3, coverage=0.5)
    got = stretches(Automaton(list(items.items()), 3), text, rules)
    starts = [sum(len(w) + 1 for w in doc[:i]) for i in range(len(doc))]
    want = []
    for i, p in items.items():
        held = brute(doc, p, 3)
        if held < min(6, -(-len(p) // 2)):
            continue
        inside = [any(p[x : x + 3] == doc[y : y + 3] for y in range(max(0, j - 2), j + 1) for x in range(len(p) - 2) if y + 3 <= len(doc)) for j in range(len(doc))]
        grams = {tuple(p[x : x + 3]) for x in range(len(p) - 2)}
        places = [j for j in range(len(doc) - 2) if tuple(doc[j : j + 3]) in grams]
        spans = []
        for j in places:
            if spans and j < spans[-1][1]:
                spans[-1] = (spans[-1][0], j + 3)
            else:
                spans.append((j, j + 3))
        assert sum(y - x for x, y in spans) == sum(inside)
        want += [(i, starts[x], starts[y - 1] + len(doc[y - 1]), y - x, round(held / len(p), 6), round(sum(inside) / len(doc), 6)) for x, y in spans]
    assert got == want


def test_spans_as_written(spark):
    text = "Avant : " + PASSAGE.upper() + " Après !"
    d = spark.createDataFrame([(1, text), (2, "rien"), (3, None), (4, "")], "doc_id bigint, text string")
    t = spark.createDataFrame([(101, PASSAGE)], "item_id bigint, passage string")
    (r,) = leak_spans(d, t).collect()
    assert (r.doc_id, text[r.debut : r.fin], r.mots, r.part_item) == (1, PASSAGE.upper()[:-1], len(words(PASSAGE)), 1.0) and r.part_texte == round(r.mots / (r.mots + 2), 6)
    assert leak_spans(d, t.where("false")).collect() == []


def test_passages_that_share_a_stretch_take_linear_room():
    shared = [f"s{i}" for i in range(60)]
    a = Automaton([(i, [*shared, f"x{i}"]) for i in range(300)], 5)
    assert len(a.order) <= 300 * 61 and a.candidates([a.vocab[w] for w in shared[:5]]) == set(range(300))
