import random

import numpy as np
import pytest

from cinderline.llm import leakage
from cinderline.llm.canonical import pieces
from cinderline.llm.leakage import LeakRules, _grams, build_index, common_words, find_leaks, leaked_items, plain_words, retrieve, words

RNG = random.Random(11)
VOCABULARY = [f"{a}{b}" for a in ("fue", "cam", "bos", "río", "ñan", "vien") for b in ("go", "po", "que", "to", "da", "ra", "les", "cho", "mo", "nas")] + ["de", "la", "el", "y", "en", "a"] * 4


def text(n, rng=RNG):
    return [rng.choice(VOCABULARY) for _ in range(n)]


ITEMS = [(i, f"¿pregunta {i}?" if i % 2 else None, " ".join(text(RNG.randrange(40, 121)))) for i in range(40)] + [(90, None, None), (91, "q", ""), (92, None, "..."), (93, None, "solo cinco palabras distintas aquí")]


def changed(ws, share, rng):
    ws = list(ws)
    for i in rng.sample(range(len(ws)), int(len(ws) * share)):
        ws[i] = "otra" + str(rng.randrange(100))
    return ws


def cases():
    rng = random.Random(5)
    docs, expected = [], set()
    for i, _, passage in ITEMS[:40]:
        ws = passage.split()
        at = rng.randrange(len(ws) - 12)
        for kind in range(6):
            body = {0: ws[at : at + 12], 1: ws[at : at + 8], 2: ws, 3: changed(ws, 0.12, rng), 4: ws[: len(ws) // 2], 5: []}[kind]
            shown = " ".join(body)
            if kind == 0:
                shown = shown.upper().replace(" ", ",\r\n")
            if kind == 2:
                shown = shown.replace("a", "а").replace("e", "е́").replace("o", "ｏ")
            docs.append((len(docs), " ".join(text(rng.randrange(0, 90), rng)) + ". " + shown + " " + " ".join(text(rng.randrange(0, 90), rng))))
            if kind in (0, 2, 3, 4):
                expected.add((docs[-1][0], i))
    return docs, expected


def exact(docs):
    """12 words in a row, by brute force."""
    grams = {}
    for i, _, p in ITEMS:
        ws = words(p or "")
        for k in range(len(ws) - 11):
            grams.setdefault(tuple(ws[k : k + 12]), set()).add(i)
    out = set()
    for d, t in docs:
        ws = words(t)
        out |= {(d, i) for k in range(len(ws) - 11) for i in grams.get(tuple(ws[k : k + 12]), ())}
    return out


def test_all_leaks_and_nothing_else():
    docs, expected = cases()
    index = build_index(ITEMS)
    leaks = find_leaks(index, [t for _, t in docs])
    got = {(d, index.items[i]) for d, i, *_ in leaks}
    assert got == expected
    assert {(d, index.items[i]) for d, i, run, *_ in leaks if run} == exact(docs)
    assert {(d, index.items[i]) for d, i, _, n, _ in leaks if n} == {(d, i) for d, i in expected if d % 6 in (2, 3)}


@pytest.mark.parametrize("kind", ["run", "whole"])
def test_bounds_lose_no_window(kind):
    index = build_index(ITEMS + [(94, None, "dos palabras")], LeakRules(block=4))
    postings = getattr(index, kind)
    docs, _ = cases()
    lists = [np.array([index.vocabulary.get(w, -1) for w in words(t)], np.int64) for _, t in docs[:60]]
    tokens, length = np.concatenate(lists), np.array([len(x) for x in lists])
    weights = {(int(c), int(i)): w for t, c in enumerate(postings.code) for i, w in zip(postings.item[postings.start[t] : postings.start[t + 1]], postings.weight[postings.start[t] : postings.start[t + 1]])}
    brute, width = set(), postings.width
    for d, x in enumerate(lists):
        base = int(length[:d].sum())
        for s in range(0, max(1, len(x) - width), width):
            window = x[s : s + 2 * width]
            terms = {int(_grams(window[k : k + n], n)[0]) for n in postings.grams for k in range(len(window) - n + 1) if (window[k : k + n] >= 0).all()}
            for i in range(len(index.items)):
                if sum(weights.get((t, i), 0.0) for t in terms) >= postings.need[i] * (1 - 1e-9):
                    brute.add((d, base + s, i))
    assert set(zip(*(x.tolist() for x in retrieve(postings, tokens, length)))) == brute and brute


def test_words_put_in_lost_and_changed():
    rng = random.Random(8)
    index = build_index(ITEMS)
    texts, expected = [], []
    for number, (i, _, passage) in enumerate(ITEMS[:40]):
        ws = passage.split()
        for kind in range(3):
            body = list(ws)
            for k in sorted(rng.sample(range(1, len(ws)), len(ws) // 9), reverse=True):
                body[k : k + (kind > 0)] = [[f"otra{k}"], [f"otra{k}"], []][kind]
            texts.append(" ".join(text(rng.randrange(60), rng) + body + text(rng.randrange(60), rng)))
            expected.append(i)
    got = {(d, index.items[i]) for d, i, *_ in find_leaks(index, texts)}
    assert got >= set(enumerate(expected))


def test_short_passages_are_found_as_a_whole():
    index = build_index([(1, None, "Sí"), (2, None, "dos palabras"), (3, None, "esto son ya cinco palabras"), (4, None, "once palabras hay en este pasaje, que es corto aún, sí")])
    got = {(d, index.items[i]) for d, i, *_ in find_leaks(index, ["dijo: ¡sí!", "solo dos palabras", "esto son cinco palabras", "y esto son ya cinco palabras", "Once palabras hay en este PASAJE que es corto aún"])}
    assert got == {(0, 1), (1, 2), (3, 2), (3, 3), (4, 4)} - {(3, 2)}


def test_very_long_texts(monkeypatch):
    index = build_index(ITEMS)
    filler = " ".join(text(3_000))
    long = filler + " " + ITEMS[7][2] + " " + filler + " " + ITEMS[20][2] + " " + filler
    want = {(0, 7), (0, 20)}
    assert {(d, index.items[i]) for d, i, *_ in find_leaks(index, [long, "", None])} == want
    monkeypatch.setattr(leakage, "pieces", lambda t: pieces(t, 500))
    assert {(d, index.items[i]) for d, i, *_ in find_leaks(index, [long, "", None])} == want


def test_common_words():
    a, b = np.array([1, 2, 3, 4, 5]), np.array([9, 1, 3, 2, 4, 5, 5])
    assert common_words(a, b) == 4 and common_words(a, a) == 5 and common_words(a, np.zeros(0, int)) == 0


def test_words_without_visible_differences():
    assert words("Él  «VIO» 0,41­ha\r\nÑandú") == ["el", "vio", "0", "41ha", "nandu"]
    assert words("Straße\u2028Ⅳ 葛\U000e0100x e\u0301l_la") == ["strasse", "iv", "葛x", "el", "la"] and words("") == words(" .\n") == []
    assert plain_words(["a\nb", "", "ñ"]) == ["a b", "", "n"]


@pytest.mark.parametrize("more", [{}, {"shard_chars": 2_000, "batch_chars": 500}])
def test_in_spark(spark, more):
    docs, expected = cases()
    question = (len(docs), "Sobre: ¿Pregunta 3? " + ITEMS[3][2])
    rows = [(d, t, "clash") for d, t in [*docs, question]] + [(900, None, ""), (901, "", ""), (902, " ", "")] + [(0, docs[0][1], "again")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, words string").repartition(4)
    i = spark.createDataFrame(ITEMS + ITEMS[:3], "item_id bigint, question string, passage string")
    call = lambda d, i: leaked_items(d, i, key="doc_id", text="text", item="item_id", passage="passage", question="question", **more)
    got = call(d, i).collect()
    assert {(r.doc_id, r.item_id) for r in got} == expected | {(question[0], 3)} and len(got) == len(expected) + 1
    assert {(r.doc_id, r.item_id) for r in got if r.question_found} == {(question[0], 3)}
    if not more:
        assert call(d.limit(0), i).count() == 0 and call(d, i.limit(0)).count() == 0
