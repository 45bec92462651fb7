"""Problem 8: token ids of a public byte-level BPE vocabulary, by a sentencepiece model made from its ranks.

The vocabulary's own merges are those of its ranks: of all neighbouring pieces whose union is a piece, the union of the
lowest rank is formed first. That is what a sentencepiece BPE model does with scores, so a model is written (in its
protobuf form, nothing is trained) whose pieces are the vocabulary's byte strings, each byte as one letter, with minus
the rank as score, and whose normalisation is the identity. Pre-tokens are cut by the vocabulary's pattern; as distinct
ones are few, each worker remembers the ids of the pieces between single spaces, up to a bounded number of them.
"""

from __future__ import annotations

import base64
import importlib
import itertools
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "byte_bpe_50k.tiktoken"
_KEPT = 300_000
#: Longer pieces (a sentence without spaces) are encoded but not remembered.
_LONG = 64


@dataclass(frozen=True)
class Vocabulary:
    """Where the ranks are, and the pattern that cuts a text before the merges."""

    path: str
    pattern: str


def public_vocabulary(name: str = VOCABULARY, package: str = "public_tokenizers") -> Vocabulary:
    """A vocabulary of the installed package of public tokenizers."""
    own = importlib.import_module(package)
    return Vocabulary(own.path(name), own.PATTERN)


def byte_letters() -> list[str]:
    """By byte, the letter that stands for it: itself if it is visible in Latin-1, else one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = itertools.count(0x100)
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int | float) -> bytes:
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """A serialised model: piece 0 is <unk>, piece i the i-th vocabulary entry by rank, scored by minus its rank."""
    letters = byte_letters()
    normal, unknown, bpe = 1, 2, 2
    pieces = [_field(1, b"<unk>") + _field(2, 0.0) + _field(3, unknown)]
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        pieces.append(_field(1, "".join(letters[b] for b in token).encode()) + _field(2, float(-rank)) + _field(3, normal))
    trainer = _field(3, bpe) + _field(4, len(pieces)) + _field(40, 0) + _field(41, 2**31 - 1) + _field(42, 2**31 - 1) + _field(43, 2**31 - 1)
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(_field(1, p) for p in pieces) + _field(2, trainer) + _field(3, normaliser)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Encoder:
    """Ids of whole texts. One per worker; its memory is bounded by the model and `_KEPT` remembered pieces."""

    def __init__(self, vocabulary: Vocabulary):
        import sentencepiece

        ranks = load_ranks(vocabulary.path)
        self.by_rank = sorted(ranks, key=ranks.get)
        self.id_of = [0, *(ranks[t] for t in self.by_rank)]
        self.bytes_of = {ranks[t]: t for t in ranks}
        self.letters = byte_letters()
        self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(ranks))
        self.cut = regex.compile(vocabulary.pattern)
        self.spaces = regex.compile(r"^ | $|\s \S| \s")
        self.inner = regex.compile(r"(?<=\S)(?= \S)", regex.V1)
        self.known: dict[str, tuple[int, ...]] = {}
        self.pre: dict[str, tuple[int, ...]] = {}

    def _learn(self, stretches: list[str]) -> None:
        """Remember the ids of stretches; the pre-tokens not met before go through the model in one call."""
        if len(self.pre) > _KEPT:
            self.pre.clear()
        cuts = [self.cut.findall(s) for s in stretches]
        new = list({p for c in cuts for p in c}.difference(self.pre))
        letters, ids = self.letters, self.id_of
        for p, found in zip(new, self.model.encode(["".join([letters[b] for b in p.encode()]) for p in new], num_threads=1)):
            self.pre[p] = tuple([ids[i] for i in found])
        for s, c in zip(stretches, cuts):
            self.known[s] = self.pre[c[0]] if len(c) == 1 else tuple(itertools.chain.from_iterable([self.pre[p] for p in c]))
        for long in [p for p in new if len(p) > _LONG]:
            del self.pre[long]

    def stretches(self, text: str) -> list[str]:
        """The text, cut before each single space between two visible characters, where a pre-token always begins."""
        if self.spaces.search(text):
            return self.inner.split(text)
        words = text.split(" ")
        return [words[0], *[" " + w for w in words[1:]]]

    def batch(self, texts: list[str | None]) -> list[list[tuple[int, ...]]]:
        """By text, the ids of its stretches; nothing for null and empty texts."""
        cut = [self.stretches(t) if t else [] for t in texts]
        out = []
        for first in range(0, len(cut), 500):
            some = cut[first : first + 500]
            new = list(set(itertools.chain.from_iterable(some)).difference(self.known))
            if len(self.known) + len(new) > _KEPT:
                self.known.clear()
                new = list(set(itertools.chain.from_iterable(some)))
            if new:
                self._learn(new)
            known = self.known
            out += [[known[s] for s in c] for c in some]
            for long in [s for s in new if len(s) > _LONG]:
                del known[long]
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.bytes_of[i] for i in ids).decode("utf-8", errors="replace")


def encoded(documents: DataFrame, vocabulary: Vocabulary | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): the token ids of every text, without special tokens; null and empty texts give an empty list.

    Strings of special tokens in a text are ordinary text. Rows are kept one for one, repeated or null keys included.
    """
    vocabulary = vocabulary or public_vocabulary()
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            flat, ends = array("i"), array("i", [0])
            for pieces in encoder.batch(batch.column(1).to_pylist()):
                flat.extend(itertools.chain.from_iterable(pieces))
                ends.append(len(flat))
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=[key, "ids"])

    return documents.select(key, text).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def counted(documents: DataFrame, columns: list[str], vocabulary: Vocabulary | None = None, text: str = "text") -> DataFrame:
    """`columns` and `tokens`, the number of token ids of every text; null and empty texts count 0."""
    vocabulary = vocabulary or public_vocabulary()
    fields = ", ".join(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            sizes = [sum(map(len, pieces)) for pieces in encoder.batch(batch.column(len(columns)).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], pa.array(sizes, pa.int64())], names=[*columns, "tokens"])

    return documents.select(*columns, F.col(text).alias("_text")).mapInArrow(run, f"{fields}, tokens bigint")


def decoded(ids: DataFrame, vocabulary: Vocabulary | None = None, key: str = "doc_id") -> DataFrame:
    """(key, text): the texts of lists of ids; the inverse of `encoded`, an empty list giving an empty text."""
    vocabulary = vocabulary or public_vocabulary()
    kind = ids.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            texts = [encoder.decode(i) if i is not None else None for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    return ids.select(key, "ids").mapInArrow(run, f"`{key}` {kind}, text string")
