"""Sharded corpora: cuts in gzipped JSON lines beside tars of payloads, an index, locators and random access.

A corpus is a folder with `shar_index.json` ({"version", "fields": {"cuts": [...], "recording": [...]}}); line i of a cuts
shard belongs to the i-th member of the tar of the same folder and number.
"""

from __future__ import annotations

import gzip
import io
import json
import os
import re
import tarfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "dataset string, cut_id string, recording_id string, language string, text string, duration_secs double, num_samples bigint, tar_path string, tar_offset bigint, tar_size bigint, audio_format string, custom string"
NOT_PAYLOAD = ("json", "nometa", "nodata")


def shard_number(path: str) -> str:
    """The digits before the extensions of a shard's name."""
    m = re.search(r"\.(\d+)\.", Path(path).name)
    return m[1] if m else ""


def dataset_tag(root: str, folder: str, overrides: dict[str, str] | None = None) -> str:
    """A name for a corpus folder: an override, its path below the root, else its name, with its parent's if that is a language code."""
    folder = os.path.normpath(folder)
    if overrides and folder in overrides:
        return overrides[folder]
    rel = os.path.relpath(folder, root) if root else "."
    if root and not rel.startswith("..") and rel != ".":
        return rel
    leaf = os.path.basename(folder)
    return f"{os.path.basename(os.path.dirname(folder))}/{leaf}" if re.fullmatch(r"[A-Za-z]{1,4}", leaf) else leaf


def discover(folders: list[str], root: str = "", overrides: dict[str, str] | None = None) -> list[dict]:
    """Shard pairs of the folders in a stable order: {dataset, cuts, tar}; absolute paths in an index are refused."""
    out = []
    for folder in folders:
        index = json.loads(Path(folder, "shar_index.json").read_text())
        fields = index["fields"]
        for paths in fields.values():
            if any(os.path.isabs(p) for p in paths):
                raise ValueError(f"{folder}: absolute path in the index")
        tars = {(os.path.dirname(p), shard_number(p)): p for p in fields.get("recording", [])}
        for p in fields["cuts"]:
            tar = tars.get((os.path.dirname(p), shard_number(p)))
            out.append({"dataset": dataset_tag(root, folder, overrides), "cuts": str(Path(folder, p)), "tar": str(Path(folder, tar)) if tar else None})
    return sorted(out, key=lambda s: (s["dataset"], s["cuts"]))


def tar_members(path: str) -> list[tuple[str, int, int, str]]:
    """(stem, offset, size, format) of the payload members in order; an unreadable tar has none."""
    try:
        with tarfile.open(path) as t:
            return [(m.name.removeprefix("./").rpartition(".")[0], m.offset_data, m.size, m.name.rpartition(".")[2]) for m in t if m.isfile() and m.name.rpartition(".")[2] not in NOT_PAYLOAD]
    except (tarfile.TarError, OSError, EOFError):
        return []


def cuts_of(path: str) -> Iterator[dict]:
    """The JSON objects of a gzipped file; blank and broken lines are left out."""
    with gzip.open(path, "rt", encoding="utf-8") as f:
        for line in f:
            try:
                cut = json.loads(line)
            except ValueError:
                continue
            if isinstance(cut, dict) and cut.get("id"):
                yield cut


def row_of(cut: dict, spec: dict, place: tuple | None) -> tuple:
    sup = (cut.get("supervisions") or [{}])[0]
    custom = cut.get("custom") or {}
    rec = cut.get("recording") or {}
    _, offset, size, fmt = place or (None, None, None, None)
    return (
        custom.get("dataset") or spec["dataset"], str(cut["id"]).removeprefix("./"), rec.get("id"), custom.get("language") or sup.get("language"), sup.get("text"),
        float(cut["duration"]) if cut.get("duration") is not None else None, rec.get("num_samples"), spec["tar"] if place else None, offset, size, fmt,
        json.dumps(custom, sort_keys=True, ensure_ascii=False))


class _Shard(InputPartition):
    def __init__(self, spec: dict):
        self.spec = spec


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.specs = discover([p for p in options["path"].split(",") if p], options.get("root", ""))
        self.positional = str(options.get("positional", "false")).lower() == "true"

    def partitions(self):
        return [_Shard(s) for s in self.specs]

    def read(self, partition):
        spec = partition.spec
        members = tar_members(spec["tar"]) if spec["tar"] else []
        cuts = list(cuts_of(spec["cuts"])) if self.positional else cuts_of(spec["cuts"])
        if self.positional and members and len(members) != len(cuts):
            raise ValueError(f"{spec['cuts']}: {len(cuts)} cuts, {len(members)} payloads")
        by_name = {m[0]: m for m in members}
        for i, cut in enumerate(cuts):
            place = (members[i] if members else None) if self.positional else by_name.get(str(cut["id"]).removeprefix("./"))
            yield row_of(cut, spec, place)


class ShardSource(DataSource):
    """`spark.read.format("shards").load(folder)`: one row a cut with the place of its payload; one task a shard.

    Options: path (folders separated by commas), root (for dataset names), positional (members by place, not by name).
    """

    @classmethod
    def name(cls):
        return "shards"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _Reader(dict(self.options))


def read_shards(spark: SparkSession, folders: list[str], root: str = "", positional: bool = False) -> DataFrame:
    spark.dataSource.register(ShardSource)
    return spark.read.format("shards").option("root", root).option("positional", str(positional).lower()).load(",".join(folders))


def remaining_seconds(cuts: DataFrame, done: DataFrame, low: float, high: float) -> DataFrame:
    """One row: cuts and seconds not yet done and within the range of durations; payloads are not touched."""
    rest = cuts.where(F.col("duration_secs").between(low, high)).join(done.select("cut_id").distinct(), "cut_id", "left_anti")
    return rest.agg(F.count(F.lit(1)).alias("cuts"), F.coalesce(F.sum("duration_secs"), F.lit(0.0)).alias("seconds"))


def read_payloads(locators: DataFrame) -> DataFrame:
    """(dataset, cut_id, payload) of rows with a place: a tar's rows come together, shorter ones first, and are sought and read.

    Rows without a place give none; a tar cut short raises. Within a task one tar is open at a time.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, f = None, None
        for batch in batches:
            data = []
            for p, offset, size in zip(*[batch.column(i).to_pylist() for i in (2, 3, 4)]):
                if p != path:
                    if f:
                        f.close()
                    path, f = p, open(p, "rb")
                f.seek(offset)
                got = f.read(size)
                if len(got) != size:
                    raise ValueError(f"{p} ends before {offset + size}")
                data.append(got)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(data, pa.binary())], names=["dataset", "cut_id", "payload"])
        if f:
            f.close()

    rows = locators.where("tar_path is not null and tar_offset is not null").select("dataset", "cut_id", "tar_path", "tar_offset", "tar_size", "num_samples")
    ordered = rows.repartition("tar_path").sortWithinPartitions("tar_path", "num_samples", "tar_offset")
    return ordered.mapInArrow(run, "dataset string, cut_id string, payload binary")


def write_shards(rows: DataFrame, folder: str, per_shard: int = 1000) -> DataFrame:
    """(shard, n) of the shards written to `folder` (seen by all executors): rows of dataset, cut_id, text, language,
    duration_secs, payload, in the order of cut_id. Each file appears under its name only when complete."""
    Path(folder).mkdir(parents=True, exist_ok=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held: list[dict] = []
        at = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, at
            name = f"{TaskContext.get().partitionId() * 10_000 + at:08d}"
            cuts, tar = Path(folder, f"cuts.{name}.jsonl.gz"), Path(folder, f"recording.{name}.tar")
            mark = f".{TaskContext.get().taskAttemptId()}"
            with gzip.open(f"{cuts}{mark}", "wt", encoding="utf-8") as c, tarfile.open(f"{tar}{mark}", "w") as t:
                for r in held:
                    cut = {"id": r["cut_id"], "duration": r["duration_secs"], "supervisions": [{"text": r["text"], "language": r["language"]}], "recording": {"id": r["cut_id"], "num_samples": len(r["payload"])}, "custom": {"dataset": r["dataset"]}}
                    c.write(json.dumps(cut, ensure_ascii=False) + "\n")
                    info = tarfile.TarInfo(f"{r['cut_id']}.raw")
                    info.size = len(r["payload"])
                    t.addfile(info, io.BytesIO(r["payload"]))
            os.replace(f"{tar}{mark}", tar)
            os.replace(f"{cuts}{mark}", cuts)
            n, held, at = len(held), [], at + 1
            return pa.RecordBatch.from_pydict({"shard": [name], "n": [n]}, schema=pa.schema([("shard", pa.string()), ("n", pa.int64())]))

        for batch in batches:
            for r in batch.to_pylist():
                held.append(r)
                if len(held) == per_shard:
                    yield flush()
        if held:
            yield flush()

    done = rows.select("dataset", "cut_id", "text", "language", "duration_secs", "payload").sortWithinPartitions("cut_id").mapInArrow(run, "shard string, n bigint")
    return done


def write_index(folder: str, expected: int | None = None) -> dict:
    """Index the complete shards of a folder; a cuts file without its tar, or fewer shards than expected, raises."""
    cuts = sorted(p.name for p in Path(folder).glob("cuts.*.jsonl.gz"))
    tars = {shard_number(p.name): p.name for p in Path(folder).glob("recording.*.tar")}
    lacking = [c for c in cuts if shard_number(c) not in tars]
    if lacking or expected is not None and len(cuts) != expected:
        raise ValueError(f"{folder}: {len(cuts)} shards, without payloads: {lacking}")
    index = {"version": 1, "fields": {"cuts": cuts, "recording": [tars[shard_number(c)] for c in cuts]}}
    tmp = Path(folder, ".shar_index.json")
    tmp.write_text(json.dumps(index))
    os.replace(tmp, Path(folder, "shar_index.json"))
    return index


def offset_index(spark: SparkSession, folders: list[str]) -> DataFrame:
    """(dataset, cut_id, tar_path, tar_offset, tar_size) by place; shards whose lengths differ raise."""
    return read_shards(spark, folders, positional=True).select("dataset", "cut_id", "tar_path", "tar_offset", "tar_size")


def merged_shards(spark: SparkSession, folder: str, out: str, group: int) -> int:
    """Repack groups of `group` aligned shards into one each: tars member by member, gzipped text by its members.

    Fields of unequal length raise. One task a group; returns the number of new shards.
    """
    specs = discover([folder])
    if any(s["tar"] is None for s in specs):
        raise ValueError("a shard has no payloads")
    groups = [(i, json.dumps(specs[i * group : (i + 1) * group])) for i in range(-(-len(specs) // group))]
    Path(out).mkdir(parents=True, exist_ok=True)

    def run(batches):
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with open(f"{out}/.cuts.{i}", "wb") as c, tarfile.open(f"{out}/.tar.{i}", "w") as t:
                    for s in json.loads(text):
                        c.write(Path(s["cuts"]).read_bytes())
                        with tarfile.open(s["tar"]) as src:
                            for m in src:
                                t.addfile(m, src.extractfile(m))
                os.replace(f"{out}/.tar.{i}", f"{out}/recording.{i:08d}.tar")
                os.replace(f"{out}/.cuts.{i}", f"{out}/cuts.{i:08d}.jsonl.gz")
            yield pa.RecordBatch.from_pydict({"i": batch.column(0)}, schema=pa.schema([("i", pa.int32())]))

    spark.createDataFrame(groups, "i int, specs string").repartition(max(1, len(groups)), "i").mapInArrow(run, "i int").collect()
    write_index(out, len(groups))
    return len(groups)


def tar_cuts(spark: SparkSession, tars: list[str]) -> DataFrame:
    """(tar_path, stem, format, size, text, meta) of tars whose members belong together by stem: a payload and its .txt and
    .json (or .metadata.json). A tar that is corrupt or cut short is left out whole."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows: dict[str, dict] = {}
                try:
                    with tarfile.open(path) as t:
                        for m in t:
                            if not m.isfile():
                                continue
                            name = m.name.removeprefix("./")
                            stem, _, ext = name.rpartition(".")
                            r = rows.setdefault(stem.removesuffix(".metadata"), dict.fromkeys(("format", "size", "text", "meta")))
                            data = t.extractfile(m).read()
                            if len(data) != m.size:
                                raise EOFError(path)
                            if ext == "txt":
                                r["text"] = data.decode("utf-8", errors="replace").strip()
                            elif ext == "json":
                                r["meta"] = data.decode("utf-8", errors="replace")
                            else:
                                r["format"], r["size"] = ext, m.size
                except (tarfile.TarError, OSError, EOFError):
                    continue
                some = [(s, r) for s, r in rows.items() if r["format"]]
                yield pa.RecordBatch.from_pydict({"tar_path": [path] * len(some), "stem": [s for s, _ in some], **{k: [r[k] for _, r in some] for k in ("format", "size", "text", "meta")}}, schema=pa.schema(
                    [(k, pa.int64() if k == "size" else pa.string()) for k in ("tar_path", "stem", "format", "size", "text", "meta")]))

    return spark.createDataFrame([(t,) for t in tars], "p string").repartition(max(1, len(tars)), "p").mapInArrow(run, "tar_path string, stem string, format string, size bigint, text string, meta string")


def language_folders(root: str, prefix: str = "", suffix: str = "", only: list[str] | None = None) -> list[tuple[str, str]]:
    """(language, folder) of the sub-folders named prefix + language + suffix, or of the languages given."""
    names = [d.name for d in Path(root).iterdir() if d.is_dir()]
    found = [(n[len(prefix) : len(n) - len(suffix) or None], str(Path(root, n))) for n in names if n.startswith(prefix) and n.endswith(suffix) and len(n) > len(prefix) + len(suffix)]
    return sorted(x for x in found if only is None or x[0] in only)
