"""Problem 9: sources mixed to target shares in tokens, small ones repeated at most a capped number of times.

The tokens of each source, its documents in the order of their ids, are one stream that is cut into blocks of a fixed
length. The output has as many block slots as the corpus has blocks, in shards of a fixed number of slots; how many slots of
a shard each source gets is one multinomial draw by the target weights, made where the shard is. The k-th slot that a source
gets in all is its block number perm(k mod blocks) of its (k div blocks)-th use, perm being a pseudorandom permutation of
the source and use; slots past the last allowed use stay empty, which is why a source may fall short. Slots and blocks are
joined by (source, block): neither a source nor a shard is ever in one task. Every text is tokenised once.
"""

from __future__ import annotations

import itertools
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewrack.llm.tokens import Encoder, Vocabulary, public_vocabulary
from tidewrack.operators.ordering import running_total
from tidewrack.session import cut, stored

BLOCK = 1024
#: Slots of a shard of the output.
SHARD = 4096
SEED = 20
_ROUND = np.arange(1, 5, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)


@dataclass(frozen=True)
class Source:
    name: str
    weight: float
    max_repeats: int
    tokens: int
    blocks: int

    @property
    def room(self) -> int:
        """The slots that its blocks can fill within the allowed uses."""
        return self.blocks * max(0, self.max_repeats)


@dataclass(frozen=True)
class Mix:
    """The sources, as many as are named, and the tokenised documents: (row, source, doc_id, tokens[, ids]), a written table."""

    documents: DataFrame
    total: int
    block: int
    shard: int
    seed: int
    sources: list[Source]

    @property
    def slots(self) -> int:
        return -(-self.total // self.block)


def tokenised(documents: DataFrame, vocabulary: Vocabulary | None = None, with_ids: bool = False) -> DataFrame:
    """(row, source, doc_id, tokens[, ids]): every document once, under a row number of its own, whatever its ids are."""
    vocabulary = vocabulary or public_vocabulary()
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            flat, ends = array("i"), array("i", [0])
            for pieces in encoder.batch(batch.column(3).to_pylist()):
                if with_ids:
                    flat.extend(itertools.chain.from_iterable(pieces))
                    ends.append(len(flat))
                else:
                    ends.append(ends[-1] + sum(map(len, pieces)))
            ends = pa.array(ends, pa.int32())
            cols = [*batch.columns[:3], pa.array(np.diff(ends.to_numpy()).astype(np.int64))]
            names = ["row", "source", "doc_id", "tokens"]
            if with_ids:
                cols, names = [*cols, pa.ListArray.from_arrays(ends, pa.array(flat, pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    rows = documents.select(F.monotonically_increasing_id().alias("row"), F.col("source").cast("string").alias("source"), "doc_id", "text")
    return stored(rows.mapInArrow(run, f"row bigint, source string, doc_id {kind}, tokens bigint" + ", ids array<int>" * with_ids), "tokens")


def prepare(documents: DataFrame, weights: DataFrame, vocabulary: Vocabulary | None = None, block: int = BLOCK, shard: int = SHARD, seed: int = SEED, with_ids: bool = False) -> Mix:
    """Tokenise the documents and size the sources.

    Documents of unnamed or null sources count in the total only. A source named twice counts with its larger weight and
    its larger cap; rows without a source, a weight or a cap are left out. A source without documents has no tokens.
    """
    named = weights.where("source is not null and target_weight is not null and max_repeats is not null and not isnan(target_weight)")
    named = named.groupBy("source").agg(F.max("target_weight").alias("w"), F.max("max_repeats").alias("r"))
    rows = tokenised(documents, vocabulary, with_ids)
    sizes = cut(rows.groupBy("source").agg(F.sum("tokens").alias("tokens")))
    total = int(sizes.agg(F.sum("tokens")).first()[0] or 0)
    named = sorted(named.join(sizes, "source", "left").collect(), key=lambda r: r.source)
    return Mix(rows, total, block, shard, seed, [Source(r.source, float(r.w), int(r.r), int(r.tokens or 0), -(-int(r.tokens or 0) // block)) for r in named])


def permuted(k: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A permutation of 0..n-1 for each key, at k: four Feistel rounds on the next even number of bits, walked until below n."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2))).astype(np.int64) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = k.astype(np.uint64), np.ones(len(k), bool)
    while todo.any():
        left, right = out[todo] >> half[todo], out[todo] & mask[todo]
        for r in range(4):
            x = (right + key[todo]) * np.uint64(0x9E3779B97F4A7C15) + _ROUND[r]
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((x ^ (x >> np.uint64(32))) & mask[todo])
        out[todo] = (left << half[todo]) | right
        todo[todo] = out[todo] >= n[todo].astype(np.uint64)
    return out.astype(np.int64)


def drawn(spark, mix: Mix) -> DataFrame:
    """(shard, at, number, source, n, start, blocks, room): by shard and source the slots drawn, the first of them in the shard and
    how many of the source lie in lower shards."""
    p = np.array([max(0.0, s.weight) for s in mix.sources])
    p = p / p.sum() if p.sum() > 0 else p
    slots, shard, seed = mix.slots, mix.shard, mix.seed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            n = [np.random.Generator(np.random.Philox(key=seed, counter=int(i))).multinomial(min(shard, slots - int(i) * shard), p) for i in ids]
            n = np.array(n, np.int64).reshape(len(ids), len(p))
            cols = [np.repeat(ids, len(p)), (np.cumsum(n, axis=1) - n).ravel(), np.tile(np.arange(len(p), dtype=np.int32), len(ids)), n.ravel()]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, cols)), names=["shard", "at", "number", "n"])

    each = spark.range(-(-slots // shard) if p.sum() > 0 else 0).mapInArrow(run, "shard bigint, at bigint, number int, n bigint").where("n > 0")
    return _with_sources(spark, running_total(each, ["number"], [F.col("shard")], "n", "upto").withColumn("start", F.col("upto") - F.col("n")).drop("upto"), mix)


def demanded(spark, mix: Mix) -> DataFrame:
    """As `drawn`, with every source given, in shards of its own, the slots after which its target is sure to be reached.

    All blocks of a use but one are full, so as many slots as the target has blocks and one more for every use are enough.
    """
    rows = []
    for i, s in enumerate(mix.sources):
        need = min(s.room, int(np.ceil(max(0.0, s.weight) * mix.total / mix.block)) + max(0, s.max_repeats))
        rows.append((i, need, -(-need // mix.shard)))
    plan = spark.createDataFrame(rows, "number int, need bigint, shards bigint").where("need > 0")
    # a source's shards are counted out in two steps of a bounded width
    step = 1 << 14
    plan = plan.withColumn("a", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("shards") - 1) / step))))
    plan = plan.withColumn("shard", F.explode(F.sequence(F.col("a") * step, F.least(F.col("a") * step + step, F.col("shards")) - 1)))
    start = F.col("shard") * mix.shard
    return _with_sources(spark, plan.select("shard", F.lit(0).cast("bigint").alias("at"), "number", F.least(F.lit(mix.shard), F.col("need") - start).alias("n"), start.alias("start")), mix)


def _with_sources(spark, rows: DataFrame, mix: Mix) -> DataFrame:
    about = spark.createDataFrame([(i, s.name, s.blocks, s.room) for i, s in enumerate(mix.sources)], "number int, source string, blocks bigint, room bigint")
    return rows.join(F.broadcast(about), "number")  # one row a named source


def filled(spark, mix: Mix, plan: DataFrame) -> DataFrame:
    """(shard, slot, source, use, block): every slot of the plan that is filled; `use` counts from 0."""
    here = F.least(F.col("n"), F.col("room") - F.col("start"))
    each = plan.where(here > 0).withColumn("i", F.explode(F.sequence(F.lit(0).cast("bigint"), here - 1)))  # at most a shard's slots
    seed = mix.seed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard, slot, number, source, k, blocks = batch.columns
            k, n, number = k.to_numpy(), blocks.to_numpy(), number.to_numpy()
            use = k // n
            key = (number.astype(np.uint64) << np.uint64(32)) + use.astype(np.uint64) + (np.uint64(seed) << np.uint64(48))
            yield pa.RecordBatch.from_arrays([shard, slot, source, *map(pa.array, (use, permuted(k % n, n, key)))], names=["shard", "slot", "source", "use", "block"])

    flat = each.select("shard", (F.col("at") + F.col("i")).alias("slot"), "number", "source", (F.col("start") + F.col("i")).alias("k"), "blocks")
    return flat.mapInArrow(run, "shard bigint, slot bigint, source string, use bigint, block bigint")


def segments(mix: Mix) -> DataFrame:
    """(row, source, block, at, first, n): which tokens of which documents a block holds, `at` being their place in it.

    A source's documents follow each other by doc_id, those of equal or null ids by their place in the table.
    """
    names = mix.documents.sparkSession.createDataFrame([(s.name,) for s in mix.sources], "source string")
    rows = mix.documents.select("row", "source", "doc_id", "tokens").join(F.broadcast(names), "source", "left_semi").where("tokens > 0")
    ends = running_total(rows, ["source"], [F.col("doc_id"), F.col("row")], "tokens", "end").withColumn("start", F.col("end") - F.col("tokens"))
    return _cut_up(ends, mix.block)


def _cut_up(ends: DataFrame, block: int, *more: str) -> DataFrame:
    size = F.lit(block)
    rows = ends.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / size), F.floor((F.col("end") - 1) / size))))
    first = F.greatest(F.col("block") * size - F.col("start"), F.lit(0))
    until = F.least((F.col("block") + 1) * size - F.col("start"), F.col("tokens"))
    at = (F.col("start") + first - F.col("block") * size).cast("int")
    return rows.select("row", "source", "block", at.alias("at"), first.cast("int").alias("first"), (until - first).cast("int").alias("n"), *more)


def blocks(mix: Mix) -> DataFrame:
    """(source, block, tokens): every block of every named source."""
    return segments(mix).groupBy("source", "block").agg(F.sum("n").alias("tokens"))


def report(spark, mix: Mix) -> DataFrame:
    """(source, target_weight, max_repeats, own_tokens, target_tokens, reachable, drawn_slots, filled_slots, tokens, share, share_of_plan).

    `share` is of the tokens that were filled, `share_of_plan` of those that were planned (those of all documents)."""
    rows = [(s.name, s.weight, s.max_repeats, s.tokens, s.weight * mix.total, s.max_repeats * s.tokens >= s.weight * mix.total) for s in mix.sources]
    about = spark.createDataFrame(rows, "source string, target_weight double, max_repeats int, own_tokens bigint, target_tokens double, reachable boolean")
    plan = stored(drawn(spark, mix), "drawn")
    got = filled(spark, mix, plan).join(blocks(mix), ["source", "block"]).groupBy("source").agg(F.count(F.lit(1)).alias("filled_slots"), F.sum("tokens").alias("tokens"))
    out = about.join(plan.groupBy("source").agg(F.sum("n").alias("drawn_slots")), "source", "left").join(got, "source", "left")
    out = out.na.fill(0, ["drawn_slots", "filled_slots", "tokens"])
    share = F.col("tokens") / F.greatest(F.sum("tokens").over(_all()), F.lit(1))
    return out.withColumn("share", share).withColumn("share_of_plan", F.col("tokens") / max(mix.total, 1))


def _all():
    from pyspark.sql import Window

    return Window.partitionBy(F.lit(1))  # one row per named source


def short_sources(documents: DataFrame, weights: DataFrame, vocabulary: Vocabulary | None = None, block: int = BLOCK) -> DataFrame:
    """(source) of those that cannot reach their target: slots enough for it are given to each, and filled within the cap."""
    spark = documents.sparkSession
    mix = prepare(documents, weights, vocabulary, block)
    got = filled(spark, mix, demanded(spark, mix)).join(blocks(mix), ["source", "block"]).groupBy("source").agg(F.sum("tokens").alias("tokens"))
    targets = spark.createDataFrame([(s.name, s.weight * mix.total) for s in mix.sources], "source string, target double")
    return targets.join(got, "source", "left").where(F.coalesce("tokens", F.lit(0)) < F.col("target")).select("source")


def mixture(documents: DataFrame, weights: DataFrame, vocabulary: Vocabulary | None = None, block: int = BLOCK) -> DataFrame:
    """(shard, slot, source, use, block, ids): the mixed corpus itself, one row per filled slot with its token ids.

    Documents keep their texts apart by row, so repeated and null doc_ids lose and mix up nothing; a document is cut into its
    blocks where its ids are, and only the pieces move.
    """
    spark = documents.sparkSession
    mix = prepare(documents, weights, vocabulary, block, with_ids=True)
    names = spark.createDataFrame([(s.name,) for s in mix.sources], "source string")
    rows = mix.documents.select("row", "source", "doc_id", "tokens").join(F.broadcast(names), "source", "left_semi").where("tokens > 0")
    ends = running_total(rows, ["source"], [F.col("doc_id"), F.col("row")], "tokens", "end").select("row", "source", "tokens", "end", (F.col("end") - F.col("tokens")).alias("start"))
    parts = _cut_up(ends.join(mix.documents.select("row", "ids"), "row"), block, "ids").select("source", "block", "at", F.slice("ids", F.col("first") + 1, F.col("n")).alias("ids"))
    whole = parts.groupBy("source", "block").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("at", "ids"))), lambda x: x["ids"])).alias("ids"))
    return filled(spark, mix, drawn(spark, mix)).join(whole, ["source", "block"]).select("shard", "slot", "source", "use", "block", "ids")
