import gzip
import json
import tarfile
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewrack.functions import arrays as A
from tidewrack.operators import evaluation as V
from tidewrack.operators import joins as J
from tidewrack.plans.pipeline import Ledger, Pipeline, last_crashes, rendered, run_status
from tidewrack.sources import records, shards
from tidewrack.streaming import flows


def corpus(folder: Path, names=("talk-1", "a.b.c"), texts=("eins", "zwei")):
    folder.mkdir(parents=True, exist_ok=True)
    with tarfile.open(folder / "recording.000000.tar", "w") as t:
        for i, n in enumerate(names):
            for ext, data in (("wav", f"payload {i}".encode()), ("json", b"{}")):
                p = folder / "tmp"
                p.write_bytes(data)
                t.add(p, f"./{n}.{ext}")
    with gzip.open(folder / "cuts.000000.jsonl.gz", "wt") as f:
        for n, x in zip((*names, "silent"), (*texts, "drei")):
            f.write(json.dumps({"id": f"./{n}", "duration": 1.5, "supervisions": [{"text": x, "language": "en"}], "custom": {}}) + "\n\n")
        f.write('{"torn')
    (folder / "shar_index.json").write_text(json.dumps({"version": 1, "fields": {"cuts": ["cuts.000000.jsonl.gz"], "recording": ["recording.000000.tar"]}}))
    return str(folder)


def test_shards_are_read_by_name(spark, tmp_path):
    cuts = shards.read_shards(spark, [corpus(tmp_path / "talks")], str(tmp_path)).collect()
    by = {r.cut_id: r for r in cuts}
    assert set(by) == {"talk-1", "a.b.c", "silent"} and by["silent"].tar_path is None and by["talk-1"].dataset == "talks" and by["talk-1"].audio_format == "wav"
    whole = (tmp_path / "talks/recording.000000.tar").read_bytes()
    assert all(whole[r.tar_offset : r.tar_offset + r.tar_size].startswith(b"payload") for r in cuts if r.tar_path)
    data = {r.cut_id: bytes(r.payload) for r in shards.read_payloads(shards.read_shards(spark, [str(tmp_path / "talks")])).collect()}
    assert data == {"talk-1": b"payload 0", "a.b.c": b"payload 1"}
    with pytest.raises(Exception, match="3 cuts, 2 payloads"):
        shards.read_shards(spark, [str(tmp_path / "talks")], positional=True).collect()


def test_names_and_index(tmp_path):
    assert shards.shard_number("a/cuts.000012.jsonl.gz") == "000012"
    assert shards.dataset_tag("/r", "/r/x/y") == "x/y" and shards.dataset_tag("", "/q/set/en") == "set/en" and shards.dataset_tag("", "/q/longer") == "longer"
    corpus(tmp_path / "a")
    (tmp_path / "a/shar_index.json").write_text(json.dumps({"fields": {"cuts": ["/abs.jsonl.gz"]}}))
    with pytest.raises(ValueError, match="absolute"):
        shards.discover([str(tmp_path / "a")])
    (tmp_path / "a/recording.000000.tar").unlink()
    with pytest.raises(ValueError, match="without payloads"):
        shards.write_index(str(tmp_path / "a"))
    assert shards.tar_members(str(tmp_path / "none.tar")) == []
    (tmp_path / "lang_de_x").mkdir()
    assert shards.language_folders(str(tmp_path), "lang_", "_x") == [("de", str(tmp_path / "lang_de_x"))]


def test_tars_with_sidecars(spark, tmp_path):
    with tarfile.open(tmp_path / "t.tar", "w") as t:
        for name, data in (("a.flac", b"1234"), ("a.txt", b" hi "), ("a.metadata.json", b'{"k": 1}'), ("b.txt", b"alone")):
            (tmp_path / "x").write_bytes(data)
            t.add(tmp_path / "x", name)
    whole = (tmp_path / "t.tar").read_bytes()
    (tmp_path / "cut.tar").write_bytes(whole[:700])
    rows = shards.tar_cuts(spark, [str(tmp_path / "t.tar"), str(tmp_path / "cut.tar")]).collect()
    assert [(r.stem, r.format, r.size, r.text, r.meta) for r in rows] == [("a", "flac", 4, "hi", '{"k": 1}')]


def test_metadata_and_lines(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("x\tone\tmore\nbroken\n")
    with gzip.open(tmp_path / "b.csv.gz", "wt") as f:
        f.write("id,text,lang\nx,two,de\n,skip,me\n")
    import zstandard

    (tmp_path / "c.jsonl.zst").write_bytes(zstandard.compress(b'{"id": "y", "text": "three", "n": 5}\n{"torn\n'))
    rows = {r.id: (r.text, r.custom) for r in records.metadata(spark, [str(tmp_path / n) for n in ("a.tsv", "b.csv.gz", "c.jsonl.zst")]).collect()}
    assert rows == {"x": ("two", {"lang": "de"}), "y": ("three", {"n": "5"})}
    (tmp_path / "r.jsonl").write_text('{"id": "1"}\n{"id": "2"}\nbroken\n{"id": "3"}\n')
    assert [r.key for r in records.json_until_broken(spark, [str(tmp_path / "r.jsonl")], "id").collect()] == ["1", "2"]
    assert records.json_lines(spark, str(tmp_path / "r.jsonl"), "id string", "id").count() == 3
    with pytest.raises(ValueError):
        records.write_json_lines(spark.range(1), str(tmp_path / "in/out"), [str(tmp_path / "in")])
    with pytest.raises(FileExistsError):
        records.write_json_lines(spark.range(1), str(tmp_path / "r.jsonl"))


def test_pipeline_runs_a_stage_once(spark, tmp_path):
    runs = []

    def make(config):
        p = Pipeline(spark, str(tmp_path / "run"), config)

        @p.stage("a")
        def a(c):
            runs.append("a")
            return spark.range(c["n"])

        @p.stage("b", "a")
        def b(c, rows):
            runs.append("b")
            return rows.where("id > 1")

        return p

    assert make({"n": 5}).run()["b"].count() == 3 and make({"n": 5}).run()["b"].count() == 3 and runs == ["a", "b"]
    with pytest.raises(ValueError, match="another configuration"):
        make({"n": 6}).run()
    assert set(records.run_manifest(str(tmp_path / "run"))) == {"a", "b"}
    assert rendered({"x": ["{a}/{b}"]}, {"a": "1"}) == {"x": ["1/{b}"]}


def test_ledger(spark, tmp_path):
    led = Ledger(str(tmp_path / "l.jsonl"))
    a, b = led.start("c", "s", "en"), led.start("c", "s", "en")
    led.end(a, "crashed", 7)
    df = spark.read.json(str(tmp_path / "l.jsonl"))
    r = run_status(df).first()
    assert (r.running, r.crashed, r.n_committed, r.last_run) == (1, 1, 7, a) and b and [x.run_id for x in last_crashes(df).collect()] == [a]


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    src, mark, out = (str(tmp_path / n) for n in ("src", "mark", "out"))
    (tmp_path / "srd").mkdir()  # a sibling that differs in the last letter is no part of the stream
    spark.range(50, 60).selectExpr("id as k").coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "srd"))
    spark.range(5).selectExpr("id % 3 as k").coalesce(1).write.parquet(src)
    once = lambda: flows.appended_once(flows.stream_of(spark, src), ["k"], "x", checkpoint=mark, sink=out).count()
    assert once() == 3
    spark.range(6).selectExpr("id % 4 as k").coalesce(1).write.mode("append").parquet(src)
    assert once() == 4 and once() == 4


def test_state_of_keys_is_forgotten(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.sql("select id % 3 as k, timestamp '2024-01-01' + make_interval(0, 0, 0, 0, 0, cast(id as int)) as t from range(9)").coalesce(1).write.parquet(src)
    rows = flows.drained(flows.once_per_key(flows.stream_of(spark, src), ["k"], "t", "1 hour"), "x")
    assert sorted(r.k for r in rows.collect()) == [0, 1, 2]


def test_guard_breaks():
    def work(p):
        raise ValueError("no")

    with pytest.raises(RuntimeError, match="1 of 1 batches failed"):  # no batch is passed over in silence
        list(flows.guarded(work, attempts=1)(iter([pd.DataFrame({"a": [1]})])))
    dead = lambda p, e: p.assign(error=str(e))
    with pytest.raises(RuntimeError, match="in a row"):
        list(flows.guarded(work, attempts=1, in_a_row=2, failed=dead)(iter([pd.DataFrame({"a": [1]})] * 3)))
    calls = []

    def flaky(p):
        calls.append(1)
        if len(calls) in (1, 3):
            raise ValueError("no")
        return p

    assert len(list(flows.guarded(flaky, wait=0)(iter([pd.DataFrame({"a": [1]})])))) == 1
    calls.clear()
    out = pd.concat(flows.guarded(flaky, attempts=1, failed=dead)(iter([pd.DataFrame({"a": [i]}) for i in range(4)])))
    assert list(out.a) == [0, 1, 2, 3] and list(out.error) == ["no", None, "no", None]


def test_evaluation(spark):
    rows = spark.createDataFrame([(0.9, True), (0.8, True), (0.8, False), (0.1, False), (None, True)], "s double, y boolean").withColumn("g", F.lit(1))
    assert V.auroc(rows, ["g"], "s", "y").first().auroc == pytest.approx((1 + 1 + 1 + 0.5) / 4)
    one = spark.createDataFrame([(0.5, True)], "s double, y boolean").withColumn("g", F.lit(1))
    assert V.auroc(one, ["g"], "s", "y").first().auroc is None
    curve = {r.step: r for r in V.threshold_curve(rows, "s", "y", 0.0, 1.0, 11).collect()}
    assert (curve[8].kept, curve[9].kept, curve[0].kept, curve[10].precision) == (3, 1, 4, None)
    truth = spark.createDataFrame([("a", "b", "f"), ("c", "d", "f"), ("e", "z", "g")], "item string, partner string, family string")
    clusters = spark.createDataFrame([("a", 1), ("b", 1), ("c", -1), ("d", -1), ("e", 2)], "item string, cluster int")
    assert {r.family: r.found for r in V.recall_by(truth, clusters, "family").collect()} == {"f": 1, "g": 0, None: 1}
    assert V.allocation(10, {"a": 0.33, "b": 0.33}, "rest") == {"a": 3, "b": 3, "rest": 4}


def test_joins(spark):
    df = spark.createDataFrame([(1, "a/x.wav"), (2, "q"), (3, "none")], "row_id int, path string")
    look = spark.createDataFrame([("x.wav", "base"), ("q.txt", "ext")], "name string, v string")
    assert {r.row_id: (r.v, r.matched_by) for r in J.fallback_lookup(df, look, "path", "name", "v", ".txt").collect()} == {1: ("base", 1), 2: ("ext", 2), 3: (None, None)}
    with pytest.raises(ValueError, match="not unique"):
        J.assert_unique(df.union(df), ["row_id"])
    J.assert_unique(df, ["row_id"])


def test_arrays(spark):
    r = spark.createDataFrame([([0.5, -1.0],), ([0.0, 0.0],), ([],)], "a array<double>").select(A.rms_db(F.col("a")).alias("db"), A.not_silent(F.col("a")).alias("s"), A.loud_enough(F.col("a")).alias("l"), A.peak_normalised(F.col("a"), 0.0).alias("p"), A.gained(F.col("a"), 20.0).alias("g")).collect()
    assert r[0].db == pytest.approx(-2.0412, abs=1e-3) and r[0].p == [0.5, -1.0] and r[0].g == [1.0, -1.0]
    assert (r[1].s, r[1].l, r[1].p) == (False, False, [0.0, 0.0]) and r[2].db is None and r[2].s is False


def test_entry_without_the_optional_part(spark, monkeypatch):
    import __spark_entry__ as e

    monkeypatch.setattr(e, "LLM", "tidewrack.llm.is_not_there")
    q, sql = e.queries(), e.oracle_sql()
    assert "p7_found" in q and not [n for n in q if n.startswith("p1_")] and set(sql) <= set(q)
    real = e.import_module

    def without(name):
        if name == "needs.more":
            raise ModuleNotFoundError("No module named 'regex'", name="regex")
        return real(name)

    monkeypatch.setattr(e, "import_module", without)
    monkeypatch.setattr(e, "LLM", "needs.more")
    assert set(e.queries()) == set(q)


def test_contract_of_records(spark):
    from tidewrack.operators import enrichment as N

    good = ['{"cut_id": "a"}', '{"cut_id": "a", "dataset": null, "duration": 1.5, "metrics": {"utmos": {"score": {"utmos": 3}}}, "rover": {"voting": "majority", "primary": "ref", "primary_fallbacks": 0}, "vad": {"speech_pct": 1}, "x": []}']
    bad = {"not an object": ["", "[1]", "{", "null"], "cut_id": ["{}", '{"cut_id": ""}', '{"cut_id": 3}'], "dataset": ['{"cut_id": "a", "dataset": 1}'], "duration": ['{"cut_id": "a", "duration": "1"}'], "metrics.utmos": ['{"cut_id": "a", "metrics": {"utmos": {}}}'],
           "rover.voting": ['{"cut_id": "a", "rover": {"voting": "loudest"}}'], "rover.primary_fallbacks": ['{"cut_id": "a", "rover": {"primary_fallbacks": -1}}', '{"cut_id": "a", "rover": {"primary_fallbacks": 1.5}}'],
           "vad.speech_pct": ['{"cut_id": "a", "vad": {"speech_pct": 1.01}}'], "filtered_reason": ['{"cut_id": "a", "filtered_reason": 0}']}
    rows = [(v, None) for v in good] + [(v, k) for k, vs in bad.items() for v in vs] + [(None, "not an object")]
    checked = N.validated(spark.createDataFrame(rows, "value string, want string"))
    assert [(r.value, r.problem) for r in checked.collect()] == rows
    assert N.require_valid(checked).count() == len(good) and N.require_valid(checked.limit(0)).count() == 0
    with pytest.raises(ValueError, match="no record"):
        N.require_valid(checked.where("want is not null"))


def test_reports_and_broadcasts_are_bounded(spark):
    with pytest.raises(ValueError, match="more than 3"):
        records.markdown(spark.range(4), most=3)
    assert records.markdown(spark.range(2), most=3).count("\n") == 3
    plan = lambda df: df._jdf.queryExecution().logical().toString()
    wide = spark.createDataFrame([("x" * 1000,)] * 50, "s string")
    assert "ResolvedHint" in J.bounded(wide)._jdf.queryExecution().analyzed().toString() and "ResolvedHint" not in J.bounded(wide, most=10_000)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in J.bounded(wide, limit=49)._jdf.queryExecution().analyzed().toString() and plan(wide)
