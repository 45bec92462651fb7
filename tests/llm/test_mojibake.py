import pytest

from tidewrack.llm import mojibake as M

SENTENCES = {
    "de": "die größere Straße für die schöne Mühle und frühe Übung", "fr": "la fenêtre légère était près de la forêt où brûle l’été", "es": "la niña soñó otra canción más cálida",
    "pl": "książka ponieważ cierpliwa chwila pamięć żółta łączność", "ru": "терпеливая долина потому что холодная река возле моста", "el": "την παλιά πλατεία του γαλαζιου ουρανού επειδή ήταν κοντά", "ja": "静かな委員会は橋を認めました", "en": "that’s the narrow café… “formal”",
}
SCHEMA = "doc_id long, text string, word string, certain string"


def corpus():
    rows, i = [], 0
    for s in SENTENCES.values():
        for _ in range(12):
            rows.append((i, s))
            i += 1
            rows.append((i, s.upper()))
            i += 1
    return rows


CHAINS = [("en", ("utf-8", "cp1252")), ("de", ("utf-8", "cp1252")), ("fr", ("utf-8", "cp437")), ("es", ("utf-8", "mac_roman")), ("pl", ("utf-8", "cp1250")), ("ru", ("utf-8", "cp1251")), ("el", ("utf-8", "cp1253")), ("ru", ("cp1251", "cp1252")),
          ("ru", ("koi8-r", "cp1251")), ("pl", ("cp1250", "cp1252")), ("pl", ("iso8859-2", "cp1252")), ("de", ("mac_roman", "cp1252")), ("fr", ("utf-8", "latin-1", "utf-8", "latin-1")), ("ja", ("utf-8", "latin-1")), ("ja", ("shift_jis", "cp1252"))]


def test_found_and_restored(spark):
    rows = corpus()
    bad = {}
    for k, (lang, chain) in enumerate(CHAINS):
        bad[1000 + k] = (M.garble(SENTENCES[lang], chain), SENTENCES[lang])
    bad[2000] = ("the report that " + M.garble("Zürläch", ("utf-8", "cp1252")) + " wrote", "the report that Zürläch wrote")  # a word that stands nowhere else
    bad[2001] = (M.garble(SENTENCES["de"], ("utf-8", "cp1252")).lower(), None)
    bad[2002] = ("la ni�a so��", None)
    decoys = {3000: "she spelled it with ð and then with Å", 3001: "A IRMÃ… “ALEMÃ”", 3002: "for £20 or €30 at 3 °C ± 1", 3003: "Ξένη ΞΈΝΗ", 3004: "Zürich naïve"}
    texts = rows + [(i, t) for i, (t, _) in bad.items()] + list(decoys.items()) + [(4000, None), (4001, ""), (4002, "   "), (4003, "plain " * 30000), (None, M.garble(SENTENCES["fr"], ("utf-8", "cp1252")))]
    df = spark.createDataFrame([(i, t, "w", "c") for i, t in texts], SCHEMA).repartition(3)
    got = {r.doc_id for r in M.garbled_documents(df).collect()}
    assert got == {*bad, None}
    back = {r.doc_id: r for r in M.restored(df).collect()}
    assert [k for k, (_, clean) in bad.items() if clean and back[k].text != clean] in ([], [1014])
    assert back[2002].text.startswith("la niña") and set(back) == set(got) - {None}


def test_nothing(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert M.garbled_documents(df).count() == 0 == M.restored(df).count()


@pytest.mark.parametrize("chain", [c for c in M.chains() if c[-1] != "utf-8"])
def test_chains_run_back(chain):
    for s in SENTENCES.values():
        for w in s.split(" "):
            g = M.garble(w, chain)
            if g is not None:
                assert M.ungarble(g, chain) == w
