import pytest

from tidewrack.llm.confusables import look_alikes, look_alikes_of, unified, unusual


@pytest.mark.parametrize("text", ["plain", "naïve café", "Straße", "ΔΕΛΤΑ", "Привет мир", "Thank you!", "🙂 👏", "👩‍🚀", "❤️", "日本語！", "wait…", "x² ½", "l'été", "WI-FI роутер", ""])
def test_usual_text_is_no_case(spark, text):
    for w in text.split(" "):
        assert look_alikes_of(spark).scan(w) == (w, False)


@pytest.mark.parametrize(
    ("text", "form"),
    [("ｆｕｌｌ", "full"), ("café", "café"), ("za​p", "zap"), ("a b", "a b"), ("thе", "the"), ("пoтoмy", "потому"), ("𝐛𝐨𝐥𝐝", "bold"), ("laﬆ", "last"), ("ＧООＤ", "GOOD"), ("πριv", "πριν"),
     ("frօm", "from"), ("lоnɡ", "long"), ("co­op", "coop"), ("１２", "12"), ("тhank", "thank"), ("l'оrage", "l'orage"), ("﻿Hi", "Hi"), ("e͏́", "é"), ("Ǆ", "DŽ")])
def test_disguised_text_is_found_and_comes_out_plain(spark, text, form):
    assert look_alikes_of(spark).scan(text) == (form, True)


def test_skeletons_of_look_alikes_are_equal(spark):
    skeleton = look_alikes_of(spark).skeleton
    assert skeleton("раураl") == skeleton("paypal")
    assert skeleton("ｐay​pal") == skeleton("paypal") and skeleton("é") == skeleton("é")
    assert skeleton("a") != skeleton("b")


def test_table(spark):
    rows = [(1, None, None, "x"), (2, "", " ", "x"), (3, "the", "thе", "x"), (3, "the", "thе", "x"), (4, "ok " * 20000 + "ｘ", "ok", "x"), (None, "a", "b ", "x")]
    df = spark.createDataFrame(rows, "line_no long, text string, normalized_text string, found string")
    got = sorted(((r.line_no, r.found) for r in unified(df, "line_no", ["text", "normalized_text"]).collect()), key=str)
    assert got == sorted([(1, False), (2, False), (3, True), (3, True), (4, True), (None, True)], key=str)
    assert unified(df.limit(0), "line_no", ["text"]).count() == 0
    assert sorted((r.line_no for r in unusual(df, "line_no", ["text", "normalized_text"]).collect()), key=str) == [3, 4, None]
    assert unusual(df.limit(0), "line_no", ["text"]).count() == 0
    g = look_alikes(spark.createDataFrame([("the",), ("thе",), ("thе",), (None,), ("",), ("x",)], "text string"), ["text"]).collect()
    assert [(r.skeleton, r.forms, r.words) for r in g] == [("the", 2, 3)]


def test_words_come_out_as_the_corpus_spells_them(spark):
    rows = [(1, "лiс у лісі і ліс"), (2, "ліс"), (3, "Հoս Հօս"), (4, "cop сор"), (5, "Ꭺbove it"), (6, "ноте home")]
    df = spark.createDataFrame(rows, "line_no long, text string")
    got = {r.line_no: (r.text, r.found) for r in unified(df, "line_no", ["text"]).collect()}
    assert got == {1: ("ліс у лісі і ліс", True), 2: ("ліс", False), 3: ("Հօս Հօս", True), 4: ("cop сор", False), 5: ("Above it", True), 6: ("ноте home", True)}
    assert {r.line_no for r in unusual(df, "line_no", ["text"]).collect()} == {1, 3, 5, 6}
