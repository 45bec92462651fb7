"""Problem 3: duplicates of new batches against all history, by a prefix-tree hash forest.

A text of six or more words is brought to the words it shows (case, punctuation, spacing and look-alikes do not count).
Its signature holds TREES permutations of DEPTH consistent weighted samples of its words: two texts agree in a sample with
the probability of their weighted Jaccard similarity, where very common words weigh little and rare ones much. The samples
of a permutation, one after the other, are a 64-bit number; sorted, the numbers of all texts are a prefix tree in which
the texts below a node are one range.

`HashForest` keeps these sorted permutations in a folder, one run an addition, beside the texts, the exact texts and the
records, each sorted by a hash. An addition writes its run, searches all runs by range at the full prefix, verifies what it
met by the edit distance of the words, estimates from the verified pairs which share of all pairs the prefix meets, and
shortens the prefix for what is still open until that share reaches the target. History is read only where ranges and
candidates lie. Runs are merged part by part when there are many.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewrack.llm import runs
from tidewrack.llm.confusables import LookAlikes, look_alikes_of
from tidewrack.operators.errorrate import edits
from tidewrack.session import scratch_path, stored

MIN_WORDS = 6
#: Words changed, added or dropped: at most one in CHANGED.
CHANGED = 5
TREES, DEPTH = 14, 3
#: Bits of a number that the first one, two and three samples fill.
PREFIX = (24, 44, 64)
#: The share of all pairs, as estimated from those found, at which prefixes are no longer shortened.
RECALL = 0.99
#: Of the texts in a range, so many are compared at once; the rest with those texts only that are still open.
FEW = 4
#: Words with more than this share of all (text, word) occurrences are common; with more than VERY of them, very common.
COMMON, VERY = 1.25e-4, 1.5e-3
WEIGHTS = {"very": 0.02, "common": 1.0, "rare": 2.0}
#: Phrases of PHRASE words with more than this share of all phrases belong to one text with many variants.
PHRASE, REPEATED = 5, 5e-4
#: Runs beyond this number are merged.
MOST_RUNS = 8
#: `repeated` adds batches together until they have this many times the rows that the forest holds: an addition costs some
#: twenty small jobs, whatever its size.
STEP = 1.5
_MASK = np.uint64(0xFFFFFFFFFFFFFFFF)
_APOSTROPHES = re.compile(r"['’‘`´]")
_WORDS = re.compile(r"[^\W_]+")
_LINE_BITS = 40  # an id is batch_no and line_no in one number, so that the order of ids is that of batches
_AT_ONCE = 2000


class Words:
    """The words that a text shows, remembered by the ASCII-space-separated piece they come from."""

    def __init__(self, table: LookAlikes):
        self.table, self.known, self.bit = table, {}, {}

    def __call__(self, text: str) -> list[str]:
        out: list[str] = []
        for piece in text.split(" "):
            hit = self.known.get(piece)
            if hit is None:
                if len(self.known) >= 200_000:
                    self.known.clear()
                hit = self.known[piece] = _WORDS.findall(_APOSTROPHES.sub("", self.table.shown(piece)))
            out += hit
        return out

    def bits(self, words: list[str]) -> int:
        """A signed 64-bit map of the words: texts one edit apart differ in at most one bit on either side."""
        bit, out = self.bit, 0
        for w in words:
            b = bit.get(w)
            if b is None:
                if len(bit) >= 200_000:
                    bit.clear()
                b = bit[w] = 1 << hashlib.blake2b(w.encode(), digest_size=1).digest()[0] % 64
            out |= b
        return out - ((out & 1 << 63) << 1)


def read_rows(df: DataFrame) -> DataFrame:
    """(line_no, batch_no, record, record2, text, text2, words, n, map): two hashes each of the record and of the words, null
    for records without a name and below MIN_WORDS words; the words joined by spaces, their number and their bit map."""
    table = look_alikes_of(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of = Words(table)
        for batch in batches:
            keys, keys2, texts, sizes, maps = [], [], [], [], []
            for t in batch.column(4).to_pylist():
                w = words_of(t) if t else ()
                if len(w) < MIN_WORDS:
                    for c in (keys, keys2, texts, sizes, maps):
                        c.append(None)
                    continue
                joined = " ".join(w)
                key = hashlib.blake2b(joined.encode(), digest_size=16).digest()
                keys.append(int.from_bytes(key[:8], "little", signed=True))
                keys2.append(int.from_bytes(key[8:], "little", signed=True))
                texts.append(joined)
                sizes.append(len(w))
                maps.append(words_of.bits(w))
            cols = [pa.array(keys, pa.int64()), pa.array(keys2, pa.int64()), pa.array(texts, pa.string()), pa.array(sizes, pa.int32()), pa.array(maps, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *cols], names=["line_no", "batch_no", "record", "record2", "text", "text2", "words", "n", "map"])

    named = F.col("dataset").isNotNull() & F.col("cut_id").isNotNull()
    record = [F.when(named, F.xxhash64(*s, "dataset", "cut_id")).alias(c) for c, s in (("record", ()), ("record2", (F.lit(7),)))]
    rows = df.select(F.col("line_no").cast("bigint"), F.col("batch_no").cast("int"), *record, F.col("text").alias("_text"))
    return rows.mapInArrow(run, "line_no bigint, batch_no int, record bigint, record2 bigint, text bigint, text2 bigint, words string, n int, map bigint")


def texts(rows: DataFrame) -> DataFrame:
    """One row per distinct text: (text, text2, id, words, n, map); its id tells its first batch and smallest line there."""
    some = rows.where("text is not null and batch_no is not null")
    first = F.min(F.shiftleft(F.col("batch_no").cast("bigint"), _LINE_BITS) + F.col("line_no")).alias("id")
    return some.groupBy("text", "text2").agg(first, *[F.first(c).alias(c) for c in ("words", "n", "map")])


def batch_of(id_: Column) -> Column:
    return F.shiftright(id_, _LINE_BITS)


class Phrases:
    """Runs of PHRASE words of many texts as 64-bit numbers."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def __call__(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(numbers, text of each, its place in the text)."""
        known, flat, where, at = self.known, [], [], []
        for i, words in enumerate(texts):
            for w in words:
                h = known.get(w)
                if h is None:
                    if len(known) >= 200_000:
                        known.clear()
                    h = known[w] = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
                flat.append(h)
            where += [i] * len(words)
            at += range(len(words))
        flat, where, at = np.array(flat, np.uint64), np.array(where, np.int64), np.array(at, np.int64)
        n = max(0, len(flat) - PHRASE + 1)
        number = np.zeros(n, np.uint64)
        for k in range(PHRASE):
            number = _mix(number + flat[k : k + n])
        whole = where[:n] == where[PHRASE - 1 :]
        return number[whole].view(np.int64), where[:n][whole], at[:n][whole]


def repeated_phrases(known: DataFrame) -> list[int]:
    """The phrases with more than REPEATED of all phrases; there are at most 1 / REPEATED of them, so they fit anywhere.

    A task forgets from time to time what has half that share of its phrases or less, and reports the rest with at most
    that much missing. A phrase above the share in all is above half of it in the sum of the reports.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases, kept, counts, total, missing = Phrases(), np.empty(0, np.int64), np.empty(0, np.int64), 0, 0
        for batch in batches:
            number, _, _ = phrases([t.split(" ") for t in batch.column(0).to_pylist()])
            value, c = np.unique(number, return_counts=True)
            total += len(number)
            kept, at = np.unique(np.concatenate([kept, value]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, c]), len(kept)).astype(np.int64)
            cut = int(REPEATED / 2 * total) - missing
            if cut > 0 and len(kept) > 1_000_000:
                some = counts > cut
                kept, counts, missing = kept[some], counts[some], missing + cut
        some = counts > REPEATED / 2 * total - missing
        yield pa.RecordBatch.from_arrays([pa.array(kept[some]), pa.array(counts[some]), pa.array(np.full(some.sum(), False))], names=["p", "c", "sum"])
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([total], pa.int64()), pa.array([True])], names=["p", "c", "sum"])

    seen = stored(known.select("words").mapInArrow(run, "p bigint, c bigint, sum boolean").groupBy("sum", "p").agg(F.sum("c").alias("c")), "phrases")
    total = seen.where("sum").agg(F.sum("c")).first()[0] or 0
    return sorted(r.p for r in seen.where(~F.col("sum") & (F.col("c") > F.lit(REPEATED / 2 * total))).collect())


def word_weights(known: DataFrame) -> dict[str, float]:
    """The weights of the common words of all texts; there are at most 1 / COMMON of them, so they fit anywhere.

    A word is counted once a text, where it is not part of a phrase that many texts repeat: else the words of a text with
    very many variants would pass for common ones, and its variants would no longer be recognised by them.
    """
    often_said = np.array(repeated_phrases(known), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases()
        for batch in batches:
            texts = [t.split(" ") for t in batch.column(0).to_pylist()]
            total = sum(len(set(words)) for words in texts)
            if len(often_said):
                number, where, at = phrases(texts)
                hit = np.isin(number, often_said)
                for i, k in zip(where[hit].tolist(), at[hit].tolist()):
                    texts[i][k : k + PHRASE] = [None] * PHRASE
            seen: Counter[str] = Counter()
            for words in texts:
                seen.update(set(words))
            seen.pop(None, None)
            yield pa.RecordBatch.from_arrays([pa.array([None, *seen], pa.string()), pa.array([total, *seen.values()], pa.int64())], names=["w", "c"])

    seen = stored(known.select("words").mapInArrow(run, "w string, c bigint").groupBy("w").agg(F.sum("c").alias("c")), "words")
    total = seen.where("w is null").agg(F.sum("c")).first()[0] or 0
    often = seen.where(F.col("w").isNotNull() & (F.col("c") > F.lit(COMMON * total))).collect()
    return {r.w: WEIGHTS["very" if r.c > VERY * total else "common"] for r in often}


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit integers (the splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9) & _MASK
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB) & _MASK
    return x ^ (x >> np.uint64(31))


class Signer:
    """The place of a text in every permutation, as signed 64-bit numbers in the order of the unsigned ones."""

    def __init__(self, weights: dict[str, float], trees: int):
        self.weights, self.trees = weights, trees
        self.steps = _mix(np.arange(1, trees * DEPTH + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.salt = _mix(np.arange(1, trees + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
        self.row: dict[str, int] = {}
        self.draws = np.empty((1024, trees * DEPTH), np.float32)

    def _new(self, word: str) -> int:
        if len(self.row) == len(self.draws):
            self.draws = np.concatenate([self.draws, np.empty_like(self.draws)])
        seed = np.uint64(int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little"))
        u = ((_mix(self.steps ^ seed) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
        i = self.row[word] = len(self.row)
        self.draws[i] = -np.log(u) / self.weights.get(word, WEIGHTS["rare"])
        return i

    def places(self, texts: list[list[str]]) -> np.ndarray:
        """(texts, trees): the number of each text in each permutation."""
        row = self.row
        if len(row) + sum(map(len, texts)) > 65_536:
            row.clear()
        index, starts = [], []
        for words in texts:
            starts.append(len(index))
            for w in words:
                i = row.get(w)
                index.append(self._new(w) if i is None else i)
        least = np.minimum.reduceat(self.draws[index], starts, axis=0).view(np.uint32).reshape(len(texts), self.trees, DEPTH)
        node, out, filled = np.tile(self.salt, (len(texts), 1)), np.zeros((len(texts), self.trees), np.uint64), 0
        for d, bits in enumerate(PREFIX):
            node = _mix(node ^ least[:, :, d])
            out |= node >> np.uint64(64 - (bits - filled)) << np.uint64(64 - bits)
            filled = bits
        return (out ^ np.uint64(1 << 63)).view(np.int64)


def signed(known: DataFrame, weights: dict[str, float], trees: int) -> DataFrame:
    """(at, id, n, map): one row per text and permutation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(weights, trees)
        for batch in batches:
            for first in range(0, batch.num_rows, _AT_ONCE):
                some = batch.slice(first, _AT_ONCE)
                at = signer.places([t.split(" ") for t in some.column(3).to_pylist()])
                rest = [pa.array(np.repeat(some.column(k).to_numpy(zero_copy_only=False), trees)) for k in range(3)]
                yield pa.RecordBatch.from_arrays([pa.array(at.ravel()), *rest], names=["at", "id", "n", "map"])

    return known.select("id", "n", "map", "words").mapInArrow(run, "at bigint, id bigint, n int, map bigint")


def near(a: list[str], b: list[str]) -> bool:
    """Whether the edit distance of the words is at most the longer length / CHANGED."""
    most = max(len(a), len(b)) // CHANGED
    return abs(len(a) - len(b)) <= most and edits(a, b) <= most


def similarity(a: set[str], b: set[str], weights: dict[str, float]) -> float:
    """The weighted Jaccard similarity that the samples follow."""
    weight = lambda words: sum(weights.get(w, WEIGHTS["rare"]) for w in words)
    return weight(a & b) / max(weight(a | b), 1e-9)


def at_once(*jobs: Callable):
    """The results of jobs that do not need each other, run side by side; each alone would leave most cores idle."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]


def _place(id_: Column) -> Column:
    return F.xxhash64(id_)


def searched(asked: DataFrame, paths: list[runs.Reader], depth: int, first: int, until: int | None, read) -> DataFrame:
    """(q, c, at, n, map): texts c of lower batches that share the prefix of `depth` samples with text q in a permutation.

    Only those that may be near by their maps come out. Of each range the rows from `first` to before `until` are compared;
    a range with more comes out once with a null c. `asked` has at, id, n and map; `read` counts the bytes read.
    """
    free = np.int64((1 << 64 - PREFIX[depth - 1]) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["q", "c", "at", "n", "map"]
        for batch in batches:
            batch = batch.take(pa.array(np.argsort(batch.column(0).to_numpy(), kind="stable")))
            at, ids, sizes, maps = (batch.column(k).to_numpy() for k in range(4))
            lo, hi = at & ~free, at | free
            more = np.zeros(len(at), bool)
            for r in paths:
                passed = np.zeros(len(at), np.int64)
                for q, rows, row in r.ranges(lo, hi, first, until, passed):
                    c, size, other = (rows.column(k).to_numpy()[row] for k in ("id", "n", "map"))
                    most = np.maximum(size, sizes[q]) // CHANGED
                    ok = (c >> _LINE_BITS < ids[q] >> _LINE_BITS) & (abs(size - sizes[q]) <= most)
                    ok &= (np.bitwise_count(maps[q] & ~other) <= most) & (np.bitwise_count(other & ~maps[q]) <= most)
                    if ok.any():
                        n = int(ok.sum())
                        none = [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64())]
                        yield pa.RecordBatch.from_arrays([pa.array(ids[q[ok]]), pa.array(c[ok]), *none], names=names)
                if until is not None:
                    more |= passed > until
            if more.any():
                some = [pa.array(x[more]) for x in (ids, at, sizes, maps)]
                yield pa.RecordBatch.from_arrays([some[0], pa.nulls(int(more.sum()), pa.int64()), *some[1:]], names=names)
        for r in paths:
            read.add(r.read)

    return asked.select("at", "id", "n", "map").mapInArrow(run, "q bigint, c bigint, at bigint, n int, map bigint")


def looked_up(asked: DataFrame, readers: list[runs.Reader], keys: str, fields: str, read) -> DataFrame:
    """The rows of sorted tables at the exact places of `asked` (`at` and more columns): the columns of `asked`, then theirs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.take(pa.array(np.argsort(batch.column(0).to_numpy(), kind="stable")))
            at = batch.column(0).to_numpy()
            for r in readers:
                for q, rows, row in r.ranges(at, at):
                    theirs = rows.select(r.columns).take(pa.array(row))
                    names = [*batch.schema.names, *[f"their_{c}" for c in r.columns]]
                    yield from pa.table([*[c.take(pa.array(q)) for c in batch.columns], *theirs.columns], names=names).combine_chunks().to_batches()
        for r in readers:
            read.add(r.read)

    return asked.mapInArrow(run, f"{keys}, {fields}")


class HashForest:
    """The forest of everything accepted so far, in a folder that all executors share.

    Opening the folder again, in this process or another, goes on where it was left: its newest state names the runs and the
    word weights, which are those of the first addition, so that signatures stay comparable. `last` tells of the latest
    addition how many texts it brought, the bytes of history and own run it read, the prefix depth and the estimated recall.
    """

    TABLES = {"paths": "id bigint, n int, map bigint", "texts": "id bigint, words string", "keys": "rest bigint, batch int", "records": "rest bigint, batch int"}

    def __init__(self, spark: SparkSession, path: str | None = None, trees: int = TREES):
        self.spark, self.path, self.last = spark, path or scratch_path(spark, "forest"), {}
        self.state = runs.load_state(self.path) or {"trees": trees, "weights": None, "runs": []}

    @property
    def weights(self) -> dict[str, float]:
        return self.state["weights"]

    def _readers(self, name: str, held: list[dict]) -> list[runs.Reader]:
        columns = [f.split(" ")[0] for f in self.TABLES[name].split(", ")]
        return [runs.Reader(f"{self.path}/{r['name']}/{name}", r["bits"][name], columns) for r in held]

    def _spread(self, df: DataFrame) -> DataFrame:
        """Partitions of equal ranges of `at`, which is spread evenly, each sorted."""
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        place = F.shiftright((F.shiftright("at", 32) + F.lit(1 << 31)) * n, 32).cast("int")
        return df.repartitionById(n, place).sortWithinPartitions("at")

    def add(self, batch: DataFrame) -> DataFrame:
        """(line_no) of the rows of one or more batches of which a lower batch_no holds the same record or a near text; lower
        batches are those in the forest and those added together. Then the rows become a run of the forest."""
        return self.add_rows(stored(read_rows(batch), "rows"))

    def add_rows(self, rows: DataFrame) -> DataFrame:
        """`add` of rows as of `read_rows`, which are read several times."""
        read, before = self.spark.sparkContext.accumulator(0), self.state["runs"]
        first = F.min("batch_no").alias("batch")
        records = rows.where("record is not null and batch_no is not null").groupBy(F.col("record").alias("at"), F.col("record2").alias("rest")).agg(first)
        here, records = at_once(lambda: stored(texts(rows), "texts"), lambda: stored(records, "records"))
        same = None
        if before:
            keys, fields = "at bigint, rest bigint, batch int", "their_rest bigint, their_batch int"
            asked = self._spread(here.select(F.col("text").alias("at"), F.col("text2").alias("rest"), batch_of(F.col("id")).cast("int").alias("batch")))
            same = looked_up(asked, self._readers("keys", before), keys, fields, read).where("rest = their_rest")
            same = stored(same.groupBy(F.col("at").alias("text"), F.col("rest").alias("text2")).agg(F.min("their_batch").alias("earlier")), "same")
            new = stored(here.join(same, ["text", "text2"], "left_anti"), "new")
            theirs = looked_up(self._spread(records), self._readers("records", before), keys, fields, read).where("rest = their_rest")
            earliest = records.select("at", "rest", "batch").union(theirs.select("at", "rest", F.col("their_batch").alias("batch")))
            earliest = earliest.groupBy("at", "rest").agg(F.min("batch").alias("batch"))
        else:
            new, earliest = here, records
        run = self._write(new, records)
        held = [*before, run]
        near_ids = self._near(new, held, read)
        state = here.select("text", "text2", "id", batch_of(F.col("id")).alias("first"))
        if same is not None:
            state = state.join(same, ["text", "text2"], "left").withColumn("first", F.least("first", "earlier"))
        if near_ids is not None:
            state = state.join(near_ids.select(F.col("q").alias("id"), F.lit(True).alias("near")), "id", "left")
        else:
            state = state.withColumn("near", F.lit(False))
        earliest = earliest.select(F.col("at").alias("record"), F.col("rest").alias("record2"), F.col("batch").alias("earliest"))
        out = rows.select("line_no", "batch_no", "record", "record2", "text", "text2")
        out = out.join(state.select("text", "text2", "first", "near"), ["text", "text2"], "left").join(earliest, ["record", "record2"], "left")
        late = [F.col("earliest") < F.col("batch_no"), F.col("first") < F.col("batch_no"), F.col("near") & F.col("batch_no").isNotNull()]
        found = stored(out.where(F.coalesce(late[0], F.lit(False)) | F.coalesce(late[1], F.lit(False)) | F.coalesce(late[2], F.lit(False))).select("line_no"), "found")
        self.state = {**self.state, "runs": held}
        runs.save_state(self.path, self.state)
        self.last |= {"bytes": read.value}
        if len(held) > MOST_RUNS:
            self.merge()
        return found

    def _write(self, new: DataFrame, records: DataFrame) -> dict:
        """The run of these texts and records; it counts once the state names it."""
        if self.state["weights"] is None:
            self.state["weights"] = word_weights(new)
        n, lowest = new.agg(F.count(F.lit(1)), F.min(batch_of(F.col("id")))).first()
        trees, run = self.state["trees"], {"name": f"run-{uuid.uuid4().hex}", "texts": n, "lowest": lowest}
        run["bits"] = {t: runs.part_bits(n * (trees if t == "paths" else 1)) for t in self.TABLES}
        path = f"{self.path}/{run['name']}"
        tables = {
            "paths": signed(new, self.weights, trees), "texts": new.select(_place(F.col("id")).alias("at"), "id", "words"), "records": records.select("at", "rest", "batch"),
            "keys": new.select(F.col("text").alias("at"), F.col("text2").alias("rest"), batch_of(F.col("id")).cast("int").alias("batch")),
        }
        at_once(*[lambda t=t, df=df: runs.write_sorted(df, f"{path}/{t}", run["bits"][t], ["id"] if t == "paths" else []) for t, df in tables.items()])
        return run

    def _near(self, new: DataFrame, held: list[dict], read) -> DataFrame | None:
        """(q): the ids of the new texts near to one of a lower batch."""
        lowest = min((r["lowest"] for r in held if r["lowest"] is not None), default=None)
        own = held[-1]
        self.last = {"texts": own["texts"], "depth": DEPTH, "recall": 1.0}
        if not own["texts"] or new.where(batch_of(F.col("id")) > lowest).isEmpty():
            return None
        paths = self._readers("paths", held)
        asked = self.spark.read.schema(f"at bigint, {self.TABLES['paths']}").parquet(f"{self.path}/{own['name']}/paths").where(batch_of(F.col("id")) > lowest)
        settled, depth = None, DEPTH
        while True:
            met = stored(searched(asked, paths, depth, 0, FEW, read), "met")
            settled = self._with(settled, self._verified(met.where("c is not null").select("q", "c").distinct(), new, held, depth, read))
            more = met.where("c is null").join(settled, "q", "left_anti").select("at", F.col("q").alias("id"), "n", "map")
            hot = searched(more.repartitionByRange("at", "id").sortWithinPartitions("at"), paths, depth, FEW, None, read).select("q", "c").distinct()
            settled = self._with(settled, self._verified(stored(hot, "hot"), new, held, depth, read))
            n, all_ = settled.agg(F.count(F.lit(1)), F.sum(1 / F.col("chance"))).first()
            self.last |= {"depth": depth, "recall": n / all_ if n else 1.0}
            if depth == 1 or self.last["recall"] >= RECALL:
                return settled.select("q")
            depth -= 1
            asked = asked.join(settled.select(F.col("q").alias("id")), "id", "left_anti")

    @staticmethod
    def _with(settled: DataFrame | None, more: DataFrame) -> DataFrame:
        return more if settled is None else settled.union(more)

    def _verified(self, pairs: DataFrame, new: DataFrame, held: list[dict], depth: int, read) -> DataFrame:
        """(q, chance): the q of pairs (q, c) whose texts are near, with the largest chance that a permutation shares the prefix."""
        weights, trees = self.weights, self.state["trees"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                q, chance = [], []
                for i, a, b in zip(*(batch.column(k).to_pylist() for k in range(3))):
                    a, b = a.split(" "), b.split(" ")
                    if near(a, b):
                        q.append(i)
                        chance.append(1 - (1 - similarity(set(a), set(b), weights) ** depth) ** trees)
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(chance, pa.float64())], names=["q", "chance"])

        places = self._spread(pairs.select(_place(F.col("c")).alias("at"), "c").distinct())
        theirs = looked_up(places, self._readers("texts", held), "at bigint, c bigint", "their_id bigint, their_words string", read)
        theirs = theirs.where("c = their_id").select("c", F.col("their_words").alias("b"))
        ours = new.select(F.col("id").alias("q"), F.col("words").alias("a"))
        both = pairs.select("q", "c").join(theirs, "c").join(ours, "q").select("q", "a", "b")
        return stored(both.mapInArrow(run, "q bigint, chance double").groupBy("q").agg(F.max("chance").alias("chance")), "settled")

    def merge(self) -> None:
        """All runs as one, part by part; nothing is signed again, and a reader of the old state finds its runs in place."""
        held = self.state["runs"]
        if len(held) < 2:
            return
        run = {"name": f"run-{uuid.uuid4().hex}", "texts": sum(r["texts"] for r in held), "lowest": min((r["lowest"] for r in held if r["lowest"] is not None), default=None)}
        run["bits"] = {t: runs.part_bits(run["texts"] * (self.state["trees"] if t == "paths" else 1)) for t in self.TABLES}
        path = f"{self.path}/{run['name']}"
        at_once(*[lambda t=t, fields=fields: runs.merged(self.spark, self._readers(t, held), f"{path}/{t}", run["bits"][t], ["id"] if t == "paths" else [], fields) for t, fields in self.TABLES.items()])
        self.state = {**self.state, "runs": [run]}
        runs.save_state(self.path, self.state)


def additions(rows: DataFrame) -> list[tuple[int, int]]:
    """Ranges of batches to add together: the first batch, then at least STEP times what was added before; what is left over goes
    with the last. One number a batch comes to the driver."""
    sizes = sorted((r.batch_no, r["count"]) for r in rows.where("batch_no is not null").groupBy("batch_no").count().collect())
    out, held, here, start = [], 0, 0, None
    for b, n in sizes:
        start, here = b if start is None else start, here + n
        if here >= STEP * held:
            out.append((start, b))
            held, here, start = held + here, 0, None
    if start is None:
        return out
    return [*out[:-1], (out[-1][0], sizes[-1][0])] if len(out) > 1 else [*out, (start, sizes[-1][0])]


def repeated(manifest: DataFrame) -> DataFrame:
    """(line_no) of the rows of `manifest` that a lower batch_no already delivered, exactly or nearly.

    A row repeats another if both name the same record (dataset, cut_id), or their texts of six or more words differ in at
    most one word in five. Null, blank and shorter texts repeat by record only; rows with a null dataset or cut_id by text
    only; rows without a batch never. Rows of the same batch do not count against each other. The batches are added to a new
    forest in their order, several small ones at a time.
    """
    rows, forest = stored(read_rows(manifest), "rows"), HashForest(manifest.sparkSession)
    found = rows.limit(0).select("line_no")
    for a, b in additions(rows):
        found = found.union(forest.add_rows(rows.where(F.col("batch_no").between(a, b))))
    return found
