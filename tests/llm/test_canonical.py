import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cinderline.llm import canonical as C
from cinderline.llm.lookalike import look_classes, lookalike_pairs

SAME = [
    ("Nota de campo", "Ｎｏｔａ ｄｅ ｃａｍｐｏ"),
    ("año", "año"),
    ("Comentario", "Сomentаriо"),
    ("río seco", "rı́o seco".replace("ı", "i")),
    ("dos  espacios", "dos  espacios"),
    ("palabra", "pa​la­bra﻿"),
    ("a\nb", "a\r\nb"),
    ("a\n\nb", "a\r­\n\r\nb"),
    ("oficina final", "oﬁcina ﬁnal"),
    ("e-mail", "e‑mail"),
    ("мост снег", "моcт cнeг"),
    ("всё", "всё"),
    ("всё", "всë"),
    ("μm", "µm"),
    ("Relatorio", "Relatοrio"),
    ("각", "각"),
    ("й", "й"),
    ("ǵ", "ǵ"),
]
DIFFERENT = [("año", "ano"), ("Casa", "casa"), ("1", "l"), ("0", "O"), ("rn", "m"), ("5", "S"), ("дом", "dom"), ("x²", "x2"), ("a b", "ab"), ("–", "-"), ("½", "1/2")]


@pytest.mark.parametrize("a,b", SAME)
def test_texts_that_look_the_same(a, b):
    assert C.canonical(a) == C.canonical(b) and C.skeleton(a) == C.skeleton(b)


@pytest.mark.parametrize("a,b", DIFFERENT)
def test_texts_that_look_different(a, b):
    assert C.canonical(a) != C.canonical(b)


def test_scripts_keep_their_letters():
    assert C.canonical("Снег на склоне, у реки") == "Снег на склоне, у реки"
    assert C.canonical("Соmеntаrio dе campo") == "Comentario de campo"
    assert C.canonical("λόγος 5 µm") == "λόγος 5 μm"
    assert C.canonical("Հայոց հող") == "Հայոց հող" and C.canonical("ᎠᎴ ᏣᎳᎩ") == "ᎠᎴ ᏣᎳᎩ"
    assert C.canonical("село Сосһіѵіӏ на реке") == "село Cochivil на реке"


PIECES = st.lists(st.sampled_from(list("abñéоеСАν́̈­​  \r\n\tＡ１ﬁ가각ᆨйЁ🔥‍.\U0002f800\U0001d15e\U00011099\U000110ba\U000e0100") + ["año ", "мост "]), max_size=40).map("".join)


@settings(max_examples=300, deadline=None)
@given(PIECES)
def test_idempotent_and_in_normal_form(text):
    once = C.canonical(text)
    assert C.canonical(once) == once and unicodedata.normalize("NFC", once) == once
    assert C.skeleton(once) == C.skeleton(text)


@settings(max_examples=300, deadline=None)
@given(PIECES)
def test_segments_give_what_whole_text_normalisation_gives(text):
    whole = unicodedata.normalize("NFC", text.translate(C.SINGLE).replace("\r\n", "\n").replace("\r", "\n"))
    whole = unicodedata.normalize("NFC", whole.translate(C.SINGLE))
    assert C.skeleton(text) == whole


ANY = st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.characters(categories=["Mn", "Mc"]), st.sampled_from("aаαñйЁ\u0301\u0308")), max_size=12)


@settings(max_examples=400, deadline=None)
@given(ANY)
def test_all_planes(text):
    look, once = C.skeleton(text), C.canonical(text)
    for form in ("NFC", "NFD"):
        assert C.skeleton(unicodedata.normalize(form, text)) == look
    assert C.skeleton(look) == look == C.skeleton(once) and C.canonical(once) == once and unicodedata.is_normalized("NFC", once)


@settings(max_examples=100, deadline=None)
@given(PIECES.map(lambda t: " ".join([t] * 4)))
def test_pieces_of_a_long_text_give_what_the_whole_gives(text):
    assert "".join(C.pieces(text, 7)) == text and C.skeletons([text], piece_chars=7) == [C.skeleton(text)]


def test_the_quick_check_lets_no_unstable_character_pass():
    assert [c for c in range(0x80) if C.PROPERTY[c] != C.KEEP or C.TO[c] != c] == []  # the return is asked for by itself


def test_the_table_knows_every_character_that_normalisation_changes():
    missed = [c for c in range(0x80, 0x110000) if not 0xAC00 <= c < 0xE000 and C.PROPERTY[c] == C.KEEP and C.TO[c] == c and not unicodedata.is_normalized("NFC", chr(c))]
    marks = [c for c in range(0x80, 0x110000) if unicodedata.combining(chr(c)) and C.PROPERTY[c] == C.KEEP]
    assert not missed and not marks


@settings(max_examples=200, deadline=None)
@given(st.lists(PIECES, max_size=30))
def test_many_at_a_time_give_what_each_gives_by_itself(texts):
    assert C.skeletons(texts, batch_chars=50) == [C.skeleton(t) for t in texts] == C.skeletons(texts)


SCHEMA = "doc_id bigint, text string, look string, form string"


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "clash", "clash") for i, t in enumerate(texts)], SCHEMA)


def test_pairs(spark):
    texts = ["año", "año", "año", "ano", None, "", " ", " ", "​", "x" * 50_000, "ｘ" * 50_000, "­año"]
    got = lookalike_pairs(docs(spark, texts), key="doc_id", text="text")
    assert got.columns == ["doc_id_a", "doc_id_b"]
    assert sorted(map(tuple, got.collect())) == [(0, 1), (0, 11), (1, 2), (1, 11), (2, 11), (9, 10)]
    assert lookalike_pairs(docs(spark, []), key="doc_id", text="text").count() == 0


def test_null_and_repeated_keys_make_no_pairs(spark):
    rows = [(None, "año", "", ""), (1, "an\u0303o", "", ""), (1, "año", "", ""), (2, "año", "", ""), (None, "an\u0303o", "", "")]
    got = lookalike_pairs(spark.createDataFrame(rows, SCHEMA), key="doc_id", text="text")
    assert sorted(map(tuple, got.collect())) == [(1, 2)]


def test_many_exact_copies_make_no_pairs(spark):
    texts = ["lo mismo"] * 5_000 + ["lo mismo"]
    got = lookalike_pairs(docs(spark, texts), key="doc_id", text="text")
    assert got.count() == 5_000 and got.where("doc_id_b <> 5000").count() == 0
    assert look_classes(docs(spark, texts), key="doc_id", text="text").select("look").distinct().count() == 1


def test_column_keeps_nulls_and_stable_texts(spark):
    out = [r[0] for r in docs(spark, ["a", None, "", "Ａ", "é"]).orderBy("doc_id").select(C.canonical_text(F.col("text"))).collect()]
    assert out == ["a", None, "", "A", "é"]
