"""Sorted tables in the shared folder, searched by range at the cost of what is asked.

A table has a signed 64-bit column `at`, spread evenly over its values. Its rows lie in folders `part=K` by the top bits of
`at`, sorted, in small row groups. A search reads the footers of the parts that its ranges fall into, and of their row
groups only those whose bounds hold a range; it runs inside the tasks that ask, so the table itself is never shuffled.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_TOP = np.uint64(1 << 63)
#: Rows a part is to have, and the most bits by which a table is parted.
PART_ROWS, MOST_BITS = 1 << 18, 14
_GROUP_BYTES = 1 << 20
_PAIRS_AT_ONCE = 1 << 18


def part_bits(rows: int) -> int:
    return max(1, min(MOST_BITS, math.ceil(math.log2(max(1, rows / PART_ROWS)))))


def _part(at: Column, bits: int) -> Column:
    return F.shiftrightunsigned(at.bitwiseXOR(F.lit(-(1 << 63)).cast("bigint")), 64 - bits).cast("int")


def write_sorted(df: DataFrame, path: str, bits: int, order: list[str], placed: bool = False) -> None:
    """Write `df` as a sorted table; `placed` if every partition of it already holds one part."""
    rows = df.withColumn("part", _part(F.col("at"), bits))
    rows = rows if placed else rows.repartitionById(1 << bits, F.col("part"))
    out = rows.sortWithinPartitions("part", "at", *order).write.partitionBy("part").option("compression", "zstd").option("parquet.block.size", _GROUP_BYTES)
    out.option("parquet.enable.dictionary", "false").option("parquet.writer.version", "PARQUET_2_0").parquet(path)


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and its path there; a plain path is one of a mounted file system."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path)


class Reader:
    """One sorted table, opened where it is searched. `read` counts the bytes of the column chunks that were read."""

    def __init__(self, path: str, bits: int, columns: list[str]):
        self.path, self.bits, self.columns = path, bits, columns
        self.parts: dict[int, list[tuple[pq.ParquetFile, np.ndarray, np.ndarray]]] = {}
        self.last: dict[int, tuple[int, np.ndarray, pa.Table | None]] = {}
        self.read = 0

    def __reduce__(self):
        return Reader, (self.path, self.bits, self.columns)

    def _files(self, part: int) -> list[tuple[pq.ParquetFile, np.ndarray, np.ndarray]]:
        if part not in self.parts:
            if len(self.parts) >= 64:
                self.parts.clear()
                self.last.clear()
            fs, root = file_system(self.path)
            found = fs.get_file_info(pafs.FileSelector(f"{root}/part={part}", allow_not_found=True))
            files = []
            for f in sorted(x.path for x in found if x.path.endswith(".parquet")):
                file = pq.ParquetFile(fs.open_input_file(f))
                meta = file.metadata
                k = meta.schema.to_arrow_schema().get_field_index("at")
                bounds = [meta.row_group(g).column(k).statistics for g in range(meta.num_row_groups)]
                files.append((file, np.array([b.min for b in bounds], np.int64), np.array([b.max for b in bounds], np.int64)))
            self.parts[part] = files
        return self.parts[part]

    def _count(self, file: pq.ParquetFile, group: int, columns: list[str]) -> None:
        meta = file.metadata.row_group(group)
        self.read += sum(c.total_compressed_size for c in map(meta.column, range(meta.num_columns)) if c.path_in_schema in columns)

    def _at(self, file: pq.ParquetFile, group: int) -> np.ndarray:
        kept = self.last.get(id(file))
        if kept is None or kept[0] != group:
            self._count(file, group, ["at"])
            kept = self.last[id(file)] = (group, file.read_row_group(group, columns=["at"]).column(0).to_numpy(), None)
        return kept[1]

    def _rest(self, file: pq.ParquetFile, group: int) -> pa.Table:
        _, at, rest = self.last[id(file)]
        if rest is None:
            self._count(file, group, self.columns)
            rest = file.read_row_group(group, columns=self.columns).combine_chunks()
            self.last[id(file)] = (group, at, rest)
        return rest

    def ranges(self, lo: np.ndarray, hi: np.ndarray, first: int = 0, until: int | None = None, passed: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, pa.Table, np.ndarray]]:
        """(range, rows, row) for the rows within each of the ranges [lo, hi], which must be sorted and either equal or apart.

        Of every range the rows from number `first` to before `until`; `passed` comes out with the number of rows of each.
        """
        passed = np.zeros(len(lo), np.int64) if passed is None else passed
        part = (lo.view(np.uint64) ^ _TOP) >> np.uint64(64 - self.bits)
        for k in np.unique(part):
            a, b = np.searchsorted(part, k), np.searchsorted(part, k, "right")
            for file, least, most in self._files(int(k)):
                for g in range(len(least)):
                    i, j = a + np.searchsorted(hi[a:b], least[g]), a + np.searchsorted(lo[a:b], most[g], "right")
                    if i >= j:
                        continue
                    at = self._at(file, g)
                    start, stop = np.searchsorted(at, lo[i:j]), np.searchsorted(at, hi[i:j], "right")
                    seen = passed[i:j].copy()
                    passed[i:j] += stop - start
                    begin = start + np.maximum(0, first - seen)
                    end = stop if until is None else np.minimum(stop, start + np.maximum(0, until - seen))
                    take = np.cumsum(np.maximum(0, end - begin))
                    for x in range(0, int(take[-1]), _PAIRS_AT_ONCE):
                        at_once = np.arange(x, min(x + _PAIRS_AT_ONCE, int(take[-1])))
                        q = np.searchsorted(take, at_once, "right")
                        yield i + q, self._rest(file, g), begin[q] + at_once - np.where(q > 0, take[q - 1], 0)

    def part(self, k: int, bits: int) -> Iterator[pa.RecordBatch]:
        """All rows whose top `bits` are `k`, with `at` and the columns."""
        lo, hi = k << 64 - bits, (k + 1 << 64 - bits) - 1
        for p in range(lo >> 64 - self.bits, (hi >> 64 - self.bits) + 1):
            for file, least, most in self._files(p):
                for g in range(len(least)):
                    if int(least[g]) + (1 << 63) <= hi and int(most[g]) + (1 << 63) >= lo:
                        rows = file.read_row_group(g, columns=["at", *self.columns])
                        at = rows.column("at").to_numpy().view(np.uint64) ^ _TOP
                        yield from rows.filter(pa.array((at >= np.uint64(lo)) & (at <= np.uint64(hi)))).combine_chunks().to_batches()


def merged(spark: SparkSession, readers: list[Reader], path: str, bits: int, order: list[str], fields: str) -> None:
    """One sorted table of several: every task reads its part of each, so nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                for r in readers:
                    yield from r.part(k, bits)

    parts = spark.range(0, 1 << bits, 1, 1 << bits)
    write_sorted(parts.mapInArrow(run, f"at bigint, {fields}"), path, bits, order, placed=True)


def save_state(path: str, state: dict) -> None:
    """The next state of a folder, under a number of its own, so that a reader sees the old or the new one whole."""
    fs, root = file_system(path)
    fs.create_dir(root, recursive=True)
    name = f"{root}/state-{_newest(fs, root) + 1:08d}.json"
    with fs.open_output_stream(f"{name}.new") as f:
        f.write(json.dumps(state).encode())
    fs.move(f"{name}.new", name)


def _newest(fs: pafs.FileSystem, root: str) -> int:
    found = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
    return max((int(f.base_name[6:14]) for f in found if f.base_name.startswith("state-") and f.base_name.endswith(".json")), default=-1)


def load_state(path: str) -> dict | None:
    fs, root = file_system(path)
    n = _newest(fs, root)
    if n < 0:
        return None
    with fs.open_input_stream(f"{root}/state-{n:08d}.json") as f:
        return json.loads(f.read())


def remove(path: str) -> None:
    """Delete a folder of intermediate rows that is no longer read."""
    fs, root = file_system(path)
    if fs.get_file_info(root).type == pafs.FileType.Directory:
        fs.delete_dir(root)
