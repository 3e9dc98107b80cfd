"""Wrong encodings: round trips for every pair, mixed and correct text untouched, decoys."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from newsloom.llm import encodings as E

CLEAN = [
    "ÂGE D’OR", "“ÂME”", "Ðórunn", "Íslandsbær", "Łódka", "Γ-ray", "А/Б", "√66", "├── src/", "≈ 314 %", "≡ menu", "† footnote", "½ price", "£631", "日本 10", "¿415%?", "JOSÉ Ñ.", "SÃO TOMÉ", "IRMÃOS", "À LA CARTE", "DÍA DE ÁRBOL", "naïveté", "cet été” — fin", "L’été",
    "Рынок ждёт решения суда", "Новости дня и цены", "Утренний обзор акций", "ПО»", "LA COMPAÑÍA", "FAÇADE", "────────", "• • •", "«liberté»", "🌧️🚀☕⚖️🛰️", "", "plain", "été—été", "Où va-t-on ?",
]
TEXT = "Résumé – “Größe” für 3 € · l’été à São Tomé… ¿Señal? façade №5 → 日本 🚀☕"


@pytest.mark.parametrize("text", CLEAN)
def test_correct_text_is_clean(text):
    assert not E.is_garbled(text) and E.restore(text) == (text, "clean")


@pytest.mark.parametrize("wrong", [w for w in E.WRONG if w != "koi8-r"])
def test_restores_every_pair(wrong):
    table = E._table(wrong)
    for word in ("Résumé", "Größe für", "“hat,”", "3 € · 4", "l’été", "façade – Señal"):
        garbled = "".join(table[b] for b in word.encode("utf-8"))
        assert E.is_garbled(garbled), (wrong, garbled)
        if wrong in ("cp1252", "latin-1", "mac_roman", "cp437", "cp1251", "iso8859-2"):
            assert E.restore(garbled) == (word, "restored"), (wrong, garbled)


@pytest.mark.parametrize("wrong", ["cp1252", "latin-1"])
def test_twice_garbled(wrong):
    table = E._table(wrong)
    once = "".join(table[b] for b in TEXT.encode("utf-8"))
    twice = "".join(table[b] for b in once.encode("utf-8"))
    assert E.restore(twice)[0] == TEXT and E.restore(once)[0] == TEXT


def test_only_the_span_is_replaced():
    assert E.restore("l’été de RÃ©sumÃ© · ÂGE D’OR") == ("l’été de Résumé · ÂGE D’OR", "restored")
    assert E.restore("Mus�e, cafÃ©") == ("Mus�e, café", "lossy")
    assert E.restore("It\x92s") == ("It’s", "restored") and E.restore("a\x81b")[1] == "lossy"


def test_single_byte_cyrillic():
    garbled = "Малый бизнес и налоги".encode("cp1251").decode("cp1252")
    assert E.restore(garbled) == ("Малый бизнес и налоги", "restored")
    assert E.restore("Малый бизнес è налоги") == ("Малый бизнес и налоги", "restored")
    assert not E.is_garbled("vero è falso") and not E.is_garbled("à où")


@settings(max_examples=200, deadline=None)
@given(st.text("abcdefgh ABC.,-é", max_size=40), st.text("éüöñçßàô", min_size=1, max_size=3), st.text("abc .", max_size=20))
def test_round_trip(before, middle, after):
    garbled = middle.encode("utf-8").decode("latin-1")
    assert E.restore(before + garbled + after)[0] == before + middle + after


@pytest.mark.parametrize("word", ["السلام عليكم", "שלום עולם", "नमस्ते दुनिया", "สวัสดีชาวโลก", "안녕하세요"])
@pytest.mark.parametrize("wrong", ["cp1252", "latin-1"])
def test_other_scripts(word, wrong):
    table = E._table(wrong)
    garbled = "".join(table[b] for b in word.encode("utf-8"))
    assert E.is_garbled(garbled) and E.restore(garbled) == (word, "restored") and not E.is_garbled(word)


@pytest.mark.parametrize("text", ["3 ×\u00a05 cm", "«Ø»", "SØ\u00a0ny", "Ö\u00a0und Ü", "Ù", "5 ×‘x’"])
def test_neighbours_in_correct_text(text):
    assert not E.is_garbled(text)


def test_garbled_many_times():
    table, text = E._table("latin-1"), "café"
    for _ in range(7):
        text = "".join(table[b] for b in text.encode("utf-8"))
    assert E.restore(text) == ("café", "restored")


def test_columns(spark):
    df = spark.createDataFrame([(1, "RÃ©sumÃ©", 7), (2, None, 7), (3, "", 7), (4, "é", 7), (5, "x" * 200_000 + "Ã©", 7)], "id int, t string, state_ int")
    assert sorted(r.id for r in E.garbled_rows(df, "t").collect()) == [1, 5]
    out = {r.id: (r.fixed, r.state) for r in E.with_restored(df, "t").collect()}
    assert out[1] == ("Résumé", "restored") and out[2] == (None, "clean") and out[4] == ("é", "clean") and out[5][0].endswith("xé")
    assert E.garbled_rows(df.limit(0), "t").count() == 0
