import numpy as np
import pytest

from tidewrack.llm import mixing, tokens

public = pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string, source string, ids string, tokens string"
ODD = ["", " ", "  a  b ", "a\n\n b", "don't you'll 'S", "<|endoftext|> x", "日本語の長い文" * 200, "🙂👏🏽 é é", "a" * 5000, "x \t  y　z", "\x00\x1c\x85  q", "naïve ñandú\r\n", "12 345,6"]


@pytest.fixture(scope="module")
def library():
    t = pytest.importorskip("tokenizers").Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def test_ids_equal_the_library_and_come_back(spark, library):
    rows = [(i, t, "s", "x", "y") for i, t in enumerate([*ODD, None, *ODD])] + [(None, "hello world", None, "", "")]
    df = spark.createDataFrame(rows, DOCS)
    got = tokens.encoded(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r.ids for r in got}
    for i, t, *_ in rows:
        assert by[i] == (library.encode(t, add_special_tokens=False).ids if t else [])
    back = {r.doc_id: r.text for r in tokens.decoded(tokens.encoded(df)).collect()}
    assert all(back[i] == (t or "") for i, t, *_ in rows)
    assert tokens.encoded(df.limit(0)).count() == 0


def test_memory_is_bounded(library, monkeypatch):
    monkeypatch.setattr(tokens, "_KEPT", 20)
    e = tokens.Encoder(tokens.public_vocabulary())
    texts = [f"word{i} other{i % 7} end" for i in range(2000)]
    got = [[i for p in pieces for i in p] for pieces in e.batch(texts)]
    assert got == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def test_permutation():
    for n in (1, 2, 3, 10, 1000):
        k = np.arange(n)
        for key in (0, 5):
            assert sorted(mixing.permuted(k, np.full(n, n), np.full(n, key, np.uint64))) == list(range(n))


def _documents(spark):
    rows = [(i, "some words of a text " * (i % 5), "big", "", "") for i in range(600)] + [(1000 + i, "tiny source", "small", "", "") for i in range(30)]
    rows += [(2000, "no source here", None, "", ""), (2001, None, "small", "", ""), (2002, "elsewhere", "unnamed", "", ""), (None, "text without id", "big", "", "")]
    return spark.createDataFrame(rows, DOCS)


def test_mixing(spark):
    docs = _documents(spark)
    weights = spark.createDataFrame([("big", 0.6, 2), ("small", 0.3, 3), ("absent", 0.1, 9), (None, 0.5, 1), ("nan", float("nan"), 2)], "source string, target_weight double, max_repeats int")
    assert sorted(r.source for r in mixing.short_sources(docs, weights).collect()) == ["absent", "small"]
    mix = mixing.prepare(docs, weights, block=16, shard=20)
    plan = mixing.drawn(spark, mix)
    assert plan.agg({"n": "sum"}).first()[0] == -(-mix.total // 16)
    slots = mixing.filled(spark, mix, plan).collect()
    assert len({(s.shard, s.slot) for s in slots}) == len(slots) == len({(s.source, s.use, s.block) for s in slots})
    assert all(s.use < {"big": 2, "small": 3}[s.source] for s in slots)
    report = {r.source: r for r in mixing.report(spark, mix).collect()}
    assert abs(report["big"].share_of_plan - 0.6) < 0.1 and report["small"].tokens == 3 * report["small"].own_tokens and report["absent"].tokens == 0


def test_short_sources_to_the_token(spark, library):
    docs = spark.createDataFrame([(1, "a b c d e f g h", "x", "", ""), (2, "a b c d e f g h i", "y", "", ""), (3, "a b c d e f g h i j k", "z", "", "")], DOCS)
    n = {s: len(library.encode(t, add_special_tokens=False).ids) for _, t, s, _, _ in docs.collect()}
    total = sum(n.values())
    weights = [("x", 2 * n["x"] / total, 2), ("y", (n["y"] + 0.5) / total, 1), ("z", 0.0, 0)]
    got = mixing.short_sources(docs, spark.createDataFrame(weights, "source string, target_weight double, max_repeats int"), block=4)
    assert [r.source for r in got.collect()] == ["y"]


def test_mixture_holds_whole_blocks(spark, library):
    more = [(2003, "the same id", "small", "", ""), (2003, "once more", "small", "", ""), (None, "no id", "small", "", ""), (None, "none here", "small", "", "")]
    docs = _documents(spark).union(spark.createDataFrame(more, DOCS))
    weights = spark.createDataFrame([("big", 0.5, 1), ("small", 0.5, 1)], "source string, target_weight double, max_repeats int")
    mix = mixing.prepare(docs, weights, block=16)
    by, sums = {}, {}
    for p in mixing.segments(mix).collect():
        by.setdefault((p.source, p.block), []).append((p.at, p.n))
        sums[p.source] = sums.get(p.source, 0) + p.n
    for x in by.values():
        at = 0
        for start, n in sorted(x):
            assert start == at
            at += n
    assert sums == {s.name: s.tokens for s in mix.sources}
    out = mixing.mixture(docs, weights, block=16).collect()
    held = {(r.source, r.block): r.ids for r in out}
    assert len(held) == len(out)
    tokens = {}
    for r in docs.collect():
        if r.text and r.source in ("big", "small"):
            tokens.setdefault(r.source, []).append(library.encode(r.text, add_special_tokens=False).ids)
    got = [i for b in range(max(b for s, b in held if s == "small") + 1) for i in held["small", b]]
    assert len(got) == sum(map(len, tokens["small"])) and sorted(got) == sorted(i for t in tokens["small"] for i in t)
    # every document stands in the stream of its source in one piece, each as often as it is in the table
    text = " " + " ".join(map(str, got)) + " "
    for t in tokens["small"]:
        assert text.count(" " + " ".join(map(str, t)) + " ") >= 1


def test_mixing_nothing(spark):
    docs = _documents(spark).limit(0)
    weights = spark.createDataFrame([("big", 1.0, 1)], "source string, target_weight double, max_repeats int")
    assert mixing.short_sources(docs, weights).count() == 0
    assert mixing.short_sources(_documents(spark), weights.limit(0)).count() == 0
