import random

from pyspark.sql import SparkSession

from tidewrack.llm import forest
from tidewrack.llm.confusables import look_alikes_of

SCHEMA = "line_no long, batch_no int, dataset string, cut_id string, text string, key string, words string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "k", "w") for r in rows], SCHEMA)


def edit(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        p, d[0] = d[0], i
        for j, y in enumerate(b, 1):
            p, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, p + (x != y))
    return d[-1]


def changed(w, n, vocabulary):
    w = list(w)
    for _ in range(n):
        if not w:
            break
        i, how = random.randrange(len(w)), random.randrange(3)
        if how == 0:
            w[i] = random.choice(vocabulary)
        elif how == 1:
            w.insert(i, random.choice(vocabulary))
        else:
            del w[i]
    return w


def corpus(n=600, batches=6):
    random.seed(7)
    vocabulary = [f"w{i}" for i in range(400)]
    hot = random.sample(vocabulary, 24)
    texts, rows = [], []
    for i in range(n):
        if random.random() < 0.33:
            w = changed(hot, random.randrange(4) if i else 0, vocabulary)  # a third are variants of one text
        elif texts and random.random() < 0.3:
            w = random.choice(texts)
            w = changed(w, random.randrange(len(w) // 6 + 1), vocabulary)
        else:
            w = random.sample(vocabulary, random.randrange(6, 30))
            texts.append(w)
        rows.append((i, i * batches // n, random.choice("ab"), f"c{random.randrange(3 * n)}", " ".join(w).capitalize() + random.choice(["", ".", "!"])))
    return rows


def brute(rows):
    words = forest.Words(look_alikes_of(SparkSession.active()))
    out, seen = set(), []
    for ln, b, ds, cut, t in sorted(rows, key=lambda r: r[1]):
        w = words(t) if t else []
        for b2, ds2, cut2, w2 in seen:
            if b2 < b and (ds is not None and (ds, cut) == (ds2, cut2) or len(w) > 5 and len(w2) > 5 and edit(w, w2) <= max(len(w), len(w2)) // 5):
                out.add(ln)
                break
        seen.append((b, ds, cut, w))
    return out


def test_near_is_the_edit_distance():
    random.seed(4)
    for _ in range(400):
        a = [random.choice("abcdef") for _ in range(random.randrange(1, 40))]
        b = changed(a, random.randrange(9), "abcdefg") or ["x"]
        assert forest.near(a, b) == (edit(a, b) <= max(len(a), len(b)) // 5)


def test_recall_and_precision(spark):
    rows = corpus()
    got = {r.line_no for r in forest.repeated(table(spark, rows)).collect()}
    want = brute(rows)
    assert got <= want and len(got & want) >= 0.9 * len(want)


def test_batch_by_batch_is_the_same(spark):
    rows = corpus(240, 4)
    whole = {r.line_no for r in forest.repeated(table(spark, rows)).collect()}
    f, step = forest.HashForest(spark), set()
    for b in range(4):
        step |= {r.line_no for r in f.add(table(spark, [r for r in rows if r[1] == b])).collect()}
        if b == 2:
            f.merge()
    want = brute(rows)
    assert step <= want and whole <= want and len(step) >= 0.9 * len(want) and len(whole) >= 0.9 * len(want)


def test_another_process_goes_on(spark):
    rows, found = corpus(200, 3), set()
    first = forest.HashForest(spark)
    first.add(table(spark, [r for r in rows if r[1] == 0]))
    for b in range(1, 3):
        f = forest.HashForest(spark, first.path)
        assert f.weights == first.weights and len(f.state["runs"]) == b
        found |= {r.line_no for r in f.add(table(spark, [r for r in rows if r[1] == b])).collect()}
    want = brute(rows)
    assert found <= want and len(found) >= 0.9 * len(want)


def test_reads_follow_the_batch(spark, monkeypatch):
    monkeypatch.setattr(forest.runs, "_GROUP_BYTES", 1 << 12)
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(4000)]
    rows = [(i, 1, "a", str(i), " ".join(rng.sample(vocabulary, 12))) for i in range(6000)]
    f = forest.HashForest(spark)
    f.add(table(spark, rows))
    got = f.add(table(spark, [(9001, 2, "b", "1", rows[17][4] + " more"), (9002, 2, "b", "2", "nothing that was ever here before")]))
    assert [r.line_no for r in got.collect()] == [9001]
    fs, root = forest.runs.file_system(f.path)
    held = sum(x.size for x in fs.get_file_info(forest.runs.pafs.FileSelector(root, recursive=True)) if x.path.endswith(".parquet"))
    assert f.last["bytes"] < held / 4


def test_prefixes_widen_until_the_target(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []
    for i in range(40):  # one word in five replaced: the similarity of these pairs is two thirds
        w = rng.sample(vocabulary, 20)
        rows += [(2 * i, 1, "a", f"{i}", " ".join(w)), (2 * i + 1, 2, "b", f"{i}", " ".join(w[:16] + rng.sample(vocabulary, 4)))]
    f = forest.HashForest(spark, trees=2)
    f.add(table(spark, [r for r in rows if r[1] == 1]))
    found = {r.line_no for r in f.add(table(spark, [r for r in rows if r[1] == 2])).collect()}
    assert f.last["depth"] == 1 and len(found) >= 30 and found <= brute(rows)


def test_defined_cases(spark):
    long = " ".join(f"x{i}" for i in range(20000))
    rows = [
        (1, 1, "a", "1", "Thank you so much my friend"), (2, 1, "a", "1", "Thank you so much my friend"),  # same batch
        (3, 2, "b", "7", "THANK, you so  much my friend!"), (4, 2, "b", "8", "thаnk yоu so much my friend"), (5, 2, "b", "9", "thank you so much"),
        (6, 2, "a", "1", None), (7, 2, "c", "1", ""), (8, 2, "c", "2", "   "), (9, 3, "c", "1", None), (10, 2, None, "1", None), (11, 3, None, "1", None), (12, None, "a", "1", "x"),
        (13, 1, "l", "1", long), (14, 2, "l", "2", long + " more"), (15, 2, "e", "1", "thank you so much good friend"), (16, 2, "e", "2", "thank them so much good friend"),
    ]
    got = {r.line_no for r in forest.repeated(table(spark, rows)).collect()}
    assert got == {3, 4, 6, 9, 14, 15}
    assert forest.repeated(table(spark, rows).limit(0)).count() == 0
