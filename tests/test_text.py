import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidewrack.functions import text as T
from tidewrack.operators import buckets as B
from tidewrack.operators import textdedup as D
from tidewrack.operators.components import connected_components


@pytest.mark.parametrize(
    ("text", "lang", "strip", "want"),
    [("Ｈｅｌｌｏ   WORLD!!!", "en", False, "hello world!"), ("Straße", None, False, "strasse"), ("wow🙂 ok", "en", False, "wow ok"), ("a, b... c", "en", True, "a b c"), ("أَلِف", "ar-EG", False, "الف"), ("أَلِف", "en", False, "أَلِف"), (None, None, False, ""), ("", "x", True, ""), ("?!?!", "en", False, "?!?!")])
def test_normal_form(text, lang, strip, want):
    assert T.normal_form(text, lang, strip) == want


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("o")).first().o


def test_keys(spark):
    assert one(spark, "/data/Folder/File.v1.MP3", T.file_key) == "folder/file.v1"
    assert one(spark, "plain", T.file_key) == "plain" and one(spark, "./a/./b", T.record_id) == "a/./b"
    assert one(spark, "zh-TW", T.base_language) == "zh"
    assert one(spark, "Yes <COMMA> sir <PERIOD>", T.clean_tagged) == "yes, sir."
    assert one(spark, "x <MUSIC>", T.clean_tagged) is None and one(spark, "  ", T.clean_tagged) is None
    assert one(spark, 7, lambda c: T.universal_id(F.lit("s"), c), "int") == "s@000007"
    with pytest.raises(Exception, match="negative"):
        one(spark, -1, lambda c: T.universal_id(F.lit("s"), c), "int")
    assert one(spark, "a <<b>> c", lambda c: T.marked_region(c, "<<", ">>")) == "b" and one(spark, "abc", lambda c: T.marked_region(c, "<<", ">>")) == "abc"


def test_shingles_and_repetition(spark):
    assert one(spark, "abc", lambda c: T.char_shingles(c, 2)) == ["ab", "bc"] and one(spark, "a", lambda c: T.char_shingles(c, 2)) == ["a\0"] and one(spark, "", lambda c: T.char_shingles(c, 2)) == []
    assert one(spark, "a", lambda c: T.char_shingles(c, 2, False)) == ["a"]
    assert one(spark, "a b c", lambda c: T.ngrams(T.words(c), 2)) == ["a b", "b c"] and one(spark, None, lambda c: T.ngrams(T.words(c), 2)) == []
    assert one(spark, "x y " * 5, lambda c: T.excess_repetition(T.words(c), 2, 5)) is True
    assert one(spark, "x y " * 4, lambda c: T.excess_repetition(T.words(c), 2, 5)) is False
    assert one(spark, "a", lambda c: T.excess_repetition(T.words(c), 2, 5)) is False


def test_components_chain_hub_and_empty(spark):
    random.seed(0)
    pairs = [(i, i + 1) for i in range(100)] + [(1000, 1000 + i) for i in range(1, 60)] + [(5000, 5000), (None, 3)]
    random.shuffle(pairs)
    want = {**{i: 0 for i in range(101)}, **{1000 + i: 1000 for i in range(60)}, 5000: 5000}
    df = spark.createDataFrame(pairs, "a int, b int")
    for most in (0, 1000):  # by star steps, and in one task
        assert {r.node: r.root for r in connected_components(df, in_one_task=most).collect()} == want
        words = df.select(*[F.format_string("n%05d", c).alias(c) for c in "ab"]).where("a not like '%null%'")
        assert {r.node: r.root for r in connected_components(words, in_one_task=most).collect()} == {f"n{k:05}": f"n{v:05}" for k, v in want.items()}
    assert connected_components(spark.createDataFrame([], "a int, b int")).count() == 0


def _texts(spark):
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [(0, base), (1, base + " lambda"), (2, "mu " + base), (3, "quite another text about nothing at all and more"), (4, base), (5, None), (6, ""), (7, "short")]
    return spark.createDataFrame(rows, "doc_id int, text string")


def test_classes_keep_copies_and_links(spark):
    got = {r.id: (r.class_id, r.class_size, r.links) for r in D.duplicate_classes(_texts(spark), "doc_id", "text").collect()}
    assert got[0] == got[4] == (0, 4, 3) and got[1][:2] == got[2][:2] == (0, 4) and got[3] == (3, 1, 0) and got[7] == (7, 1, 0) and 5 not in got


def test_similar_pairs_against_brute_force(spark):
    random.seed(9)
    rows = []
    for i in range(120):
        w = [f"w{j}" for j in range(40)] if i % 3 == 0 else [random.choice("abcdefgh") for _ in range(30)]
        for _ in range(random.randrange(3)):
            w[random.randrange(len(w))] = "z"
        rows.append((i, " ".join(w)))
    sets = D.shingle_sets(spark.createDataFrame(rows, "doc_id int, text string"), "doc_id", "text")
    reps, _ = D.distinct_sets(sets)
    have = {r.id: set(r.shingles) for r in reps.collect()}
    want = {(a, b) for a in have for b in have if a < b and len(have[a] & have[b]) >= 0.8 * len(have[a] | have[b])}
    assert {(r.a, r.b) for r in D.similar_pairs(reps).collect()} == want


def test_lsh_clusters_and_guard(spark):
    got = {r.id: (r.cluster_id, r.cluster_size) for r in D.lsh_clusters(_texts(spark), "doc_id", "text").collect()}
    assert got[0] == got[4] == (0, 4) and 3 not in got
    with pytest.raises(ValueError, match="share"):
        D.lsh_clusters(_texts(spark), "doc_id", "text", max_fraction=0.1)


def test_buckets_of_any_size_give_all_pairs(spark):
    rows = spark.createDataFrame([(0, "x", i) for i in range(40)] + [(1, "x", i) for i in (3, 90)] + [(0, "alone", 77)], "band int, bucket string, id int")
    want = {(a, b) for a in range(40) for b in range(a + 1, 40)} | {(3, 90)}
    for shard in (500, 7):
        pairs = [(r.a, r.b) for r in D.candidates(rows, shard).collect()]
        assert len(pairs) == len(want) and set(pairs) == want
    signatures = spark.createDataFrame([(i, [i % 3, 7]) for i in range(9)], "id int, signature array<long>")
    reps, of = D.signature_classes(signatures)
    assert sorted(r.id for r in reps.collect()) == [0, 1, 2] and {r.id: r.rep for r in of.collect()} == {i: i % 3 for i in range(9)}
    with pytest.raises(Exception, match="longer than the signature"):
        D.buckets(signatures, 2, 2).collect()


def test_char_clusters_find_the_similar(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(80)) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t[:70] + "xyz") for i, t in enumerate(texts[:20])] + [(200, texts[0]), (201, None), (202, ""), (203, "ab"), (204, "ab")]
    got = {r.id: r.cluster_id for r in D.char_clusters(spark.createDataFrame(rows, "k int, t string"), "k", "t").collect()}
    found = sum(got.get(i, -1) == got.get(100 + i, -2) for i in range(20))
    assert found >= 18 and got[0] == got[200] and got[203] == got[204] and not {201, 202, *range(20, 30)} & set(got)
    inside = [(0, "one two three four five six seven"), (1, "zero One, two three four five six seven eight nine ten"), (2, "something else entirely is said right here")]
    held = D.containment_clusters(spark.createDataFrame(inside, "k int, t string").withColumn("t", F.lower("t")), "k", "t")
    assert {r.id for r in held.collect()} == {0, 1}


def test_chain_of_a_large_bucket(spark):
    rows = spark.createDataFrame([(0, "b", i) for i in range(500)] + [(1, "c", 7), (1, "d", 8)], "band int, bucket string, id int")
    assert sorted((r.a, r.b) for r in D.chained(rows.repartition(3)).collect()) == [(i, i + 1) for i in range(499)]


def test_contained_pairs_are_those_of_brute_force(spark):
    random.seed(5)
    sets = {i: {f"w{random.randrange(400)}" for _ in range(random.choice((1, 2, 4, 30, 120)))} for i in range(80)}
    for i in range(40):  # parts of texts up to thirty times as long
        whole = sorted(sets[random.randrange(80)] | {f"v{i}-{j}" for j in range(60)})
        sets[100 + 2 * i], sets[101 + 2 * i] = set(whole), set(random.sample(whole, random.choice((3, 6, 20)))) | {f"u{i}"}
    sets |= {300 + i: {"x1", "x2", "x3", "x4", f"y{i}"} for i in range(30)}  # a shingle of many
    want = {(a, b, len(sets[a] & sets[b])) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= max(3, 0.8 * min(len(sets[a]), len(sets[b])))}
    df = spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()], "id int, shingles array<string>")
    got = [(r.a, r.b, r.shared) for r in D.contained_pairs(df, 0.8, 3).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 435
    assert any(len(sets[a]) > 10 * len(sets[b]) for a, b, _ in want)


def test_clusters_hold_texts_just_near_enough(spark):
    rng, rows = random.Random(6), []
    for kind in range(80):  # two words of 100 changed: a Jaccard similarity of 0.81
        w = [f"k{kind}-{i}" for i in range(100)]
        rows.append((2 * kind, " ".join(w)))
        w[rng.randrange(10, 40)], w[rng.randrange(60, 90)] = "x", "y"
        rows.append((2 * kind + 1, " ".join(w)))
    got = D.lsh_clusters(spark.createDataFrame(rows, "doc_id int, text string"), "doc_id", "text").collect()
    assert {(r.id, r.cluster_id, r.cluster_size) for r in got} == {(i, i // 2, 2) for i in range(160)}


def _char_groups(rows, n=12, threshold=0.5, bands=16):
    """By brute force: texts that share two values of a band and are near enough, with all links between them."""
    sets = {i: {t[j : j + n] for j in range(len(t) - n + 1)} or {t.ljust(n, "\0")} for i, t in rows if t}
    signs = {}
    for i, s in sets.items():
        h = [(int(hashlib.md5(x.encode()).hexdigest()[:15], 16)) % D.PRIME for x in s]
        signs[i] = [min((x * a + b) % D.PRIME for x in h) for a, b in D.permutations(2 * bands)]
    root = {i: i for i in sets}
    met = near = 0
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and any(signs[a][2 * k : 2 * k + 2] == signs[b][2 * k : 2 * k + 2] for k in range(bands)):
                met += 1
                if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                    near += 1
                    x, y = sorted((root[a], root[b]))
                    root = {k: x if v == y else v for k, v in root.items()}
    held = {i: r for i, r in root.items() if list(root.values()).count(r) > 1}
    return held, met, near


def _phrased(count):
    """Texts with a phrase in common that are not near each other, some again with changes, copies, short and other scripts."""
    rng = random.Random(8)
    phrase = "this call may be recorded for training and quality"
    rows = [(i, phrase + "".join(rng.choice("abcdefghijkl ") for _ in range(60))) for i in range(count)]
    for i in range(0, count, 5):
        t = list(rows[i][1])
        for _ in range(rng.randrange(5)):
            t[rng.randrange(len(t))] = "ż"
        rows.append((1000 + i, "".join(t)))
    return rows + [(2000, "ab"), (2001, "ab"), (2002, "ab\0"), (2003, None), (2004, ""), (2005, "日本語の会話を録音しています、よろしく"), (2006, "日本語の会話を録音しています、よろしくね"), (2007, "a" * 40), (2008, "a" * 90)]


def test_char_clusters_are_those_of_brute_force(spark):
    rows = _phrased(120)
    want, met, near = _char_groups(rows)
    assert met > 10 * near > 200 and {2000, 2001, 2005, 2006, 2007, 2008} < set(want)
    df = spark.createDataFrame(rows, "k int, t string").repartition(3)
    order = {r: n for n, r in enumerate(sorted(set(want.values())))}
    for shard in (20_000, 9):  # whole buckets, and large ones in shards
        got = D.char_clusters(df, "k", "t", shard=shard).collect()
        assert len(got) == len(want) and {r.id: r.cluster_id for r in got} == {i: order[r] for i, r in want.items()}
        assert all(r.cluster_size == list(want.values()).count(want[r.id]) for r in got)
    signed, folder = B.signed(df, "k", "t", 12, 16, 2, D.permutations(32), D.PRIME)
    roots = B.near_nodes(signed, folder, 12, 0.5, most=5)  # forests by part, finished by star steps
    by = {}
    for r in signed.join(roots, "node", "left").collect():
        by.setdefault(r.root or r.node, set()).add(r.id)
    assert {min(x) for x in by.values() if len(x) > 1} == set(want.values()) and {i for x in by.values() for i in x if len(x) > 1} == set(want)
    with pytest.raises(ValueError, match="longer than the signature"):
        B.signed(df, "k", "t", 12, 16, 3, D.permutations(32), D.PRIME)
    assert D.char_clusters(df.where("false"), "k", "t").count() == 0


def test_char_clusters_write_no_candidates(spark):
    """A phrase in common makes candidates of most pairs; what is shuffled follows the texts and not their pairs."""
    def shuffled(rows):
        sc = spark.sparkContext._jsc.sc()
        sc.listenerBus().waitUntilEmpty()
        before = sc.statusStore().executorList(False).apply(0).totalShuffleWrite()
        D.char_clusters(spark.createDataFrame(rows, "k int, t string"), "k", "t").collect()
        sc.listenerBus().waitUntilEmpty()
        return sc.statusStore().executorList(False).apply(0).totalShuffleWrite() - before

    rows = _phrased(600)
    assert shuffled(rows) < 12 * sum(len(t or "") for _, t in rows)
