"""Texts that share a bucket of their signatures and are near by character runs, without a table of candidates.

A bucket of texts with a common phrase holds hardly any near pair, and the number of its pairs grows with the square of its texts. So
no pair and no set is written: a bucket's row is two numbers, and the task that has the bucket compares its texts in blocks of arrays
by sketches in a shared file, which prove most pairs too far apart, and the rest by their shingles. Only links that join two trees
of the task are returned.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewrack.operators.components import connected_components
from tidewrack.session import cut, mounted, scratch_path, stored

#: Bits of a sketch: bit i is the parity of the shingles whose hash is i modulo BITS, so two sketches differ in no more bits than the
#: sets differ in shingles.
BITS = 512
#: A text in the shared file: its place among the texts, its length there and in characters, its shingles, its sketch.
RECORD = [("at", "<i8"), ("bytes", "<i4"), ("chars", "<i4"), ("n", "<i4"), ("sketch", "<u8", (BITS // 64,))]
#: A node is 28 bits of the task that wrote it and 28 of its place there; 8 bits above hold the band.
PLACE, NODE = 28, 56
#: Pairs compared at a time; shingles hashed at a time; sets that a task remembers.
PAIRS, SHINGLES, SETS = 1 << 16, 1 << 13, 4_000
#: A bucket that more texts hold than this is met in several shards.
SHARD = 8_000
#: Links that one union-find holds at most.
LINKS = 500_000


def _runs(raw: bytes, chars: int, n: int) -> set[bytes]:
    """The distinct runs of `n` characters of a text in UTF-8; a shorter one is filled up with NUL."""
    if chars < n:
        return {raw + bytes(n - chars)}
    if chars == len(raw):
        return {raw[j : j + n] for j in range(chars - n + 1)}
    at = [*np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80).tolist(), len(raw)]
    return {raw[i:j] for i, j in zip(at, at[n:])}


def signed(df: DataFrame, key: str, text: str, n: int, bands: int, width: int, hashes: list[tuple[int, int]], prime: int) -> tuple[DataFrame, str]:
    """(id, node, first) and the folder of the sketches, buckets and texts: equal texts are one node, signed in its first row.

    A node's place in the folder is in its number, with the attempt that wrote it, so what a repeated task wrote is not read.
    """
    if len(hashes) < bands * width:
        raise ValueError("the bands are longer than the signature")
    if bands > 256:
        raise ValueError("more than 256 bands")
    kind = df.schema[key].dataType.simpleString()
    folder = mounted(scratch_path(df.sparkSession, "sketches"))
    os.makedirs(folder)

    def packed(values: np.ndarray) -> list[int]:
        """A band's values as one number, exact for up to two; hashes of more may at worst be equal by chance."""
        if width <= 2:
            return (values[0] if width == 1 else values[0] << 31 | values[1]).tolist()
        return [int.from_bytes(hashlib.md5(x.tobytes()).digest()[:8], "little", signed=True) for x in np.ascontiguousarray(values.T)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        try:
            from _md5 import md5  # less to set up for a short text
        except ImportError:
            from hashlib import md5

        attempt = TaskContext.get().taskAttemptId()
        nodes, at, last = 0, 0, None

        def image(h: np.ndarray, a: int, b: int) -> np.ndarray:
            """(h * a + b) % prime, for a prime of 2 ** 31 - 1 by folding, without a division."""
            if prime != 2**31 - 1:
                return (h * a + b) % prime
            x = h * a
            x += b
            high = x >> 31
            x &= prime
            x += high
            return np.minimum(x.view(np.uint64), (x - prime).view(np.uint64)).view(np.int64)  # below zero is large here

        def sign(block: list[set[bytes]]) -> tuple[np.ndarray, list[list[int]]]:
            """Sketches and buckets of texts by their shingles."""
            sizes = [len(s) for s in block]
            digests = np.frombuffer(b"".join([md5(x).digest() for s in block for x in s]), ">u8")[::2]
            h = (digests >> np.uint64(4)).astype(np.int64) % prime
            first = np.cumsum([0, *sizes[:-1]])
            least = [np.minimum.reduceat(image(h, a, b), first) for a, b in hashes[: bands * width]]
            bits = np.bincount(np.repeat(np.arange(len(block)), sizes) * BITS + h % BITS, minlength=len(block) * BITS) & 1
            sketches = np.packbits(bits.astype(np.uint8).reshape(len(block), BITS), axis=1, bitorder="little").view("<u8")
            return sketches, list(zip(*(packed(np.array(least[i * width : (i + 1) * width])) for i in range(bands))))

        with open(f"{folder}/{attempt}.records", "wb") as records, open(f"{folder}/{attempt}.texts", "wb") as texts, open(f"{folder}/{attempt}.buckets", "wb") as places:
            for batch in batches:
                numbers, firsts, block, held, size = [], [], [], [], 0

                def settle():
                    nonlocal block, held, size
                    if block:
                        sketches, buckets = sign(block)
                        rows = np.zeros(len(block), RECORD)
                        rows["at"], rows["bytes"], rows["chars"] = ([x[i] for x in held] for i in range(3))
                        rows["n"] = [len(x) for x in block]
                        rows["sketch"] = sketches
                        rows.tofile(records)
                        np.array(buckets, np.int64).tofile(places)
                    block, held, size = [], [], 0

                for t in batch.column(1).to_pylist():
                    firsts.append(t != last)
                    if t != last:
                        last, raw = t, t.encode()
                        block.append(_runs(raw, len(t), n))
                        held.append((at, len(raw), len(t)))
                        texts.write(raw)
                        at, nodes, size = at + len(raw), nodes + 1, size + len(block[-1])
                    numbers.append(attempt << PLACE | nodes - 1)
                    if size > SHINGLES:
                        settle()
                settle()
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(numbers, pa.int64()), pa.array(firsts, pa.bool_())], names=["id", "node", "first"])

    rows = df.select(F.col(key).alias("id"), F.col(text).alias("t")).where("t <> ''").repartition("t").sortWithinPartitions("t", "id")
    return stored(rows.mapInArrow(run, f"id {kind}, node bigint, first boolean"), "signed"), folder


def _reader(folder: str):
    """A function over nodes that gives their records (0) or buckets (1), and by task the records, buckets and texts it has mapped."""
    files: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def read(nodes: np.ndarray, what: int) -> np.ndarray:
        out, tasks = None, nodes >> PLACE
        for k in np.unique(tasks).tolist():
            if k not in files:
                name, kinds = f"{folder}/{k}", ((".records", RECORD), (".buckets", np.int64), (".texts", np.uint8))
                records, buckets, texts = (np.asarray(np.memmap(name + end, kind, "r")) for end, kind in kinds)
                files[k] = records, buckets.reshape(len(records), -1), texts
            mine = tasks == k
            got = files[k][what][nodes[mine] & ((1 << PLACE) - 1)]
            out = np.empty((len(nodes), *got.shape[1:]), got.dtype) if out is None else out
            out[mine] = got
        return out

    return read, files


def _members(folder: str):
    """A function over Arrow batches of nodes: (bucket, member), a row a band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, _ = _reader(folder)
        for batch in batches:
            if batch.num_rows:
                nodes = batch.column(0).to_numpy()
                buckets = read(nodes, 1)
                members = np.arange(buckets.shape[1], dtype=np.int64)[None, :] << NODE | nodes[:, None]
                yield pa.RecordBatch.from_arrays([pa.array(buckets.ravel()), pa.array(members.ravel())], names=["bucket", "member"])

    return run


class _Trees(dict):
    """Union-find over numbers, by the smallest."""

    def root(self, x: int) -> int:
        if x not in self:
            self[x] = x
        while (up := self[x]) != x:
            self[x] = x = self[up]
        return x

    def joined(self, a: int, b: int) -> bool:
        """Whether a and b stood in two trees until now."""
        a, b = self.root(a), self.root(b)
        if a != b:
            self[max(a, b)] = min(a, b)
        return a != b


def _near(folder: str, n: int, threshold: float, shard: int):
    """A function over sorted (bucket, member): (0, a, b), links of a spanning forest of the task's near pairs, or (bucket, member,
    null), a member of a bucket that is too large. With `shard` 0 it is over sorted (bucket, part, node, own), where a part is
    band, shard and shard in 20 bits each, and meets any size; of two shards it meets only pairs across them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, files = _reader(folder)
        sets: dict[int, set[bytes]] = {}
        trees = _Trees()

        def runs(node: int, r: np.void) -> set[bytes]:
            if node not in sets:
                if len(sets) > SETS:
                    sets.clear()
                sets[node] = _runs(bytes(files[node >> PLACE][2][r["at"] : r["at"] + r["bytes"]]), int(r["chars"]), n)
            return sets[node]

        def links(nodes: np.ndarray, ends: np.ndarray, own: np.ndarray, part: np.ndarray) -> Iterator[tuple[int, int]]:
            """Of places in groups that end at `ends`, each with every later one of its group."""
            across = (part >> 20 & 0xFFFFF) != (part & 0xFFFFF)
            r, band = read(nodes, 0), part >> (0 if shard else 40) & 0xFF
            size, sketch = r["n"].astype(np.int64), np.ascontiguousarray(r["sketch"])
            partners = ends - np.arange(len(nodes)) - 1
            upto = np.cumsum(partners)
            i = 0
            while i < len(nodes):
                j = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + PAIRS, "right")))
                p = partners[i:j]
                x = np.repeat(np.arange(i, j), p)
                y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(p) - p, p)
                i = j
                if not shard:
                    met = ~across[x] | (own[x] != own[y])
                    x, y = x[met], y[met]
                near = np.minimum(size[x], size[y]) >= np.maximum(size[x], size[y]) * threshold - 1e-9
                x, y = x[near], y[near]
                near = np.bitwise_count(sketch[x] ^ sketch[y]).sum(axis=1, dtype=np.int64) <= (size[x] + size[y]) * (1 - threshold) / (1 + threshold) + 1e-9
                x, y = x[near], y[near]
                if len(x):  # a pair of several buckets is met in the first
                    first = (read(nodes[x], 1) == read(nodes[y], 1)).argmax(axis=1) == band[x]
                    x, y = x[first], y[first]
                for k, m, a, b in zip(x.tolist(), y.tolist(), nodes[x].tolist(), nodes[y].tolist()):
                    if a != b and trees.root(a) != trees.root(b):
                        u, v = runs(a, r[k]), runs(b, r[m])
                        shared = len(u & v)
                        if shared and shared / (len(u) + len(v) - shared) >= threshold:
                            trees.joined(a, b)
                            yield a, b

        def worked(bucket: np.ndarray, part: np.ndarray, node: np.ndarray, own: np.ndarray) -> Iterator[pa.RecordBatch]:
            """Whole groups, one after the other."""
            starts = np.flatnonzero(np.r_[True, (bucket[1:] != bucket[:-1]) | (part[1:] != part[:-1])])
            sizes = np.diff(np.r_[starts, len(bucket)])
            each = np.repeat(sizes, sizes)
            if shard and (large := each > shard).any():
                yield pa.RecordBatch.from_arrays([pa.array(bucket[large]), pa.array(part[large] << NODE | node[large]), pa.nulls(int(large.sum()), pa.int64())], names=["bucket", "a", "b"])
                each = np.where(large, 0, each)
            if (some := each > 1).any():
                ends = (np.cumsum(some))[np.repeat(starts + sizes - 1, sizes)[some]]
                rows = list(links(node[some], ends, own[some], part[some]))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in ([0] * len(rows), [a for a, _ in rows], [b for _, b in rows])], names=["bucket", "a", "b"])

        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = [c.to_numpy() for c in batch.columns]
            if shard:
                new = [new[0], new[1] >> NODE, new[1] & ((1 << NODE) - 1), np.zeros(len(new[0]), np.int64)]
            rest = new if rest is None else [np.concatenate(z) for z in zip(rest, new)]
            differ = np.flatnonzero((rest[0] != rest[0][-1]) | (rest[1] != rest[1][-1]))
            if len(differ):
                yield from worked(*(c[: differ[-1] + 1] for c in rest))
                rest = [c[differ[-1] + 1 :] for c in rest]
        if rest is not None:
            yield from worked(*rest)

    return run


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trees = _Trees()
    for batch in batches:
        keep = [trees.joined(a, b) for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        yield batch.filter(pa.array(keep, pa.bool_()))


def near_nodes(rows: DataFrame, folder: str, n: int, threshold: float, shard: int = SHARD, most: int = LINKS) -> DataFrame:
    """(node, root): the components of the nodes of `signed` that share a bucket and reach the Jaccard similarity.

    A bucket of more than `shard` members is met in pairs of shards, none of which is the work of more than one task.
    """
    found = "bucket bigint, a bigint, b bigint"
    members = rows.where("first").select("node").mapInArrow(_members(folder), "bucket bigint, member bigint")
    met = cut(members.repartition("bucket").sortWithinPartitions("bucket", "member").mapInArrow(_near(folder, n, threshold, shard), found))
    links, large = met.where("b is not null").select("a", "b"), met.where("b is null").select("bucket", F.col("a").alias("member"))
    if not large.isEmpty():
        large = large.select("bucket", F.shiftrightunsigned("member", NODE).alias("band"), F.col("member").bitwiseAND((1 << NODE) - 1).alias("node"))
        counts = cut(large.groupBy("bucket", "band").agg(F.ceil(F.count(F.lit(1)) * 2 / shard).alias("shards")))
        tasks = int(counts.agg(F.sum(F.col("shards") * (F.col("shards") + 1) / 2)).first()[0])  # few rows, but much work in each
        own = large.join(counts, ["bucket", "band"]).withColumn("own", F.pmod(F.xxhash64("node"), "shards"))
        pairs = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shards") - 1)))
        part = F.shiftleft("band", 40).bitwiseOR(F.shiftleft(F.least("own", "other"), 20)).bitwiseOR(F.greatest("own", "other"))
        pairs = pairs.select("bucket", part.alias("part"), "node", "own").repartition(min(tasks, 8 * rows.sparkSession.sparkContext.defaultParallelism), "bucket", "part").sortWithinPartitions("bucket", "part")
        links = links.union(cut(pairs.mapInArrow(_near(folder, n, threshold, 0), found)).select("a", "b"))
    count = links.count()
    if count > most:
        links = cut(links.repartition(-(-count // most), "a").mapInArrow(_forest, "a bigint, b bigint"))
    return connected_components(links, in_one_task=most)
