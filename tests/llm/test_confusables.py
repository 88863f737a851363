import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parlance.llm import confusables as C

settings.register_profile("texts", max_examples=300, deadline=None)
settings.load_profile("texts")


@pytest.fixture(scope="session")
def looks(spark):
    return C.looks(spark)


@pytest.mark.parametrize(
    "text, clean, kinds",
    [
        ("plain", "plain", []),
        ("", "", []),
        ("café ¿qué? naïve", "café ¿qué? naïve", []),
        ("café", "café", ["combining"]),
        ("Ａｂ１", "Ab1", ["wide"]),
        ("ｶﾞ", "ガ", ["wide"]),
        ("a b c　d", "a b c d", ["space"]),
        ("a​b﻿­", "ab", ["invisible"]),
        ("\U0001f469‍\U0001f33e", "\U0001f469‍\U0001f33e", []),
        ("❤️‍\U0001f525", "❤️‍\U0001f525", []),
        ("x‍y", "xy", ["invisible"]),
        ("pаyрal", "paypal", ["lookalike"]),
        ("пοка", "пока", ["lookalike"]),
        ("caf\u0435\u0301s", "caf\u00e9s", ["combining", "lookalike"]),
        ("re\u0301\u0435l", "r\u00e9el", ["combining", "lookalike"]),
        ("Москва and Paris", "Москва and Paris", []),
        ("USBшный", "USBшный", []),
        ("“quoted” – dash", "“quoted” – dash", []),
    ],
)
def test_one_form(looks, text, clean, kinds):
    assert looks.one_form(text) == (clean, kinds)


def test_forms_are_stable_and_skeletons_agree(looks):
    for t in ("\uff50\u0430y", "cafe\u0301\u200b", "p\u0430y\u0440al\u00a0 x", "\U0001d429aypal", "\ufb01ne", "a\u1680b\u2028c", "\u13aapple", "xA\u030a \u212b", "\u0451 in w\u043erlds", "\u044cank"):
        clean = looks.one_form(t)[0]
        assert looks.one_form(clean)[1] == [], t
        assert looks.skeleton(clean) == looks.skeleton(t), t
    assert looks.skeleton("\u0430") == looks.skeleton("a") and looks.skeleton("paypal") == looks.skeleton("p\u0251yp\u0251l") == looks.skeleton("\U0001d429aypa1")
    assert looks.skeleton("x\u00b2") != looks.skeleton("x2") and looks.skeleton("modern") == looks.skeleton("rnodern")
    assert [looks.one_form(t) for t in ("\U0001d429aypal", "\ufb01ne", "\u13aapple", "a\u1680b")] == [("paypal", ["styled"]), ("fine", ["styled"]), ("Apple", ["lookalike"]), ("a b", ["space"])]


SIGNS = "abmnoprxIl10 .\u0301\u0308\u0430\u0435\u043e\u0440\u0445\u043c\u043a\u043d\u0432\u0391\u03b1\u03bf\u03bd\u03c4\u0585\u057d\u0570\u13aa\u211d\U0001d41a\U0001d6c2\ufb01\uff21\uff42\uff76\uff9e\u200b\u200d\u00a0\u3000\ufeff\u00b2\u00e9\u0451\u2126\u212b\u6f22\u30ab\ud55c\U0001f469\U0001f33e"


@given(st.text(SIGNS, max_size=12))
def test_a_text_and_its_form_have_one_skeleton(looks, t):
    clean, kinds = looks.one_form(t)
    assert looks.one_form(clean)[0] == clean
    assert looks.skeleton(clean) == looks.skeleton(t)
    assert bool(kinds) or clean == unicodedata.normalize("NFC", t)


@given(st.text(SIGNS.replace("\u200d", ""), max_size=12))
def test_a_disguised_text_keeps_its_skeleton(looks, t):
    disguised = "\u200b".join(t.translate({ord("a"): "\u0430", ord("o"): "\u03bf", ord("p"): "\u0440", ord(" "): "\u2003"}))
    assert looks.skeleton(disguised) == looks.skeleton(t)


def test_the_table_is_the_public_one(looks):
    assert len(looks.prototypes) > 5_000 and all(looks.prototypes[c] == p for c, p in {"\u0430": "a", "\u03bf": "o", "\u13aa": "A", "\U0001d429": "p", "1": "l"}.items())


def test_normalized_keeps_every_row(spark):
    long = "word pаy " * 20_000
    rows = [(1, "a", "x"), (2, None, "x"), (3, "", None), (4, "pаy", "x"), (4, "pаy", "x"), (5, long, "x"), (None, "z ", "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, kinds string")
    out = {(r["doc_id"], r["clean"]): r["kinds"] for r in C.normalized(df).collect()}
    assert C.normalized(df).count() == len(rows)
    assert out[(2, None)] == [] and out[(3, "")] == [] and out[(4, "pay")] == ["lookalike"] and out[(None, "z ")] == ["space"]
    assert out[(5, long.replace("а", "a"))] == ["lookalike"]
    assert sorted(map(tuple, C.kinds_found(df).collect()), key=str) == sorted([(4, "lookalike"), (4, "lookalike"), (5, "lookalike"), (None, "space")], key=str)


def test_jvm_filter_finds_all_that_python_does(spark, looks):
    odd = ["Ａ", "￝", "é", "कि", " ", "­", "᠎", "‍", "аb", "bа", "οа", "օа", "աb", "⃣", "\U0001d429", "ﬁ", "Ꭺb", "пοка", "Å"]
    df = spark.createDataFrame(list(enumerate(odd)), "doc_id bigint, text string")
    found = {r[0] for r in df.filter(C._suspect()).collect()}
    assert {i for i, t in enumerate(odd) if looks.one_form(t)[1]} <= found


def test_jvm_classes_hold_all_styled_characters():
    assert all(any(a <= ord(c) <= b for a, b in (*C._STYLED, *C.SPACES)) for c in C.STYLED_CHARS)


def test_groups_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "pаy"), (2, "pay"), (3, "x"), (4, None)], "doc_id bigint, text string")
    assert sorted((r["n_docs"], r["n_unformed"], r["first_id"]) for r in C.groups(df).collect()) == [(1, 0, 3), (2, 1, 1)]
    none = df.limit(0)
    assert C.groups(none).count() == C.kinds_found(none).count() == C.normalized(none).filter(F.lit(True)).count() == 0


def test_every_look_alike_inside_a_latin_word(looks):
    seen = 0
    for table in C.LOOKALIKES.values():
        for odd, latin in table.items():
            text, kinds = looks.one_form(f"wor{odd}zd and more")
            assert (text, list(kinds)) == (f"wor{latin}zd and more", ["lookalike"]), odd
            seen += 1
    named = {"Ԝ": "W", "Ԛ": "Q", "Ѵ": "V", "Һ": "h", "Ӏ": "l", "ү": "y", "Ү": "Y", "г": "r", "ь": "b", "Ь": "b", "γ": "y", "σ": "o", "η": "n", "Ϲ": "C", "Ϳ": "J", "Տ": "S"}
    assert {c: C.PROTOTYPE.get(c) for c in named} == named and seen == len(C.PROTOTYPE) == 96
