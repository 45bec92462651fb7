"""Problem 10: text decoded with the wrong encoding, found and restored through the garbled forms of the clean words.

Every distinct word of the corpus is run forward through every chain of encodings; the garbled forms are a table that
the documents' own words are joined with. Beside whole words the table has their non-ASCII stretches and single
characters, so that a word whose clean form stands nowhere in the corpus, or a script without spaces, is met by its
parts: for these only chains over UTF-8 count, whose garbled parts are sequences that no language writes. A word met is
verified by running the chain back; then documents are joined with the words that are certain.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewrack.operators.joins import bounded
from tidewrack.session import cut, stored

#: Encodings that bytes of UTF-8 are wrongly read as.
READ_AS = ["cp1252", "latin-1", "cp1250", "cp1251", "cp1253", "cp1254", "cp437", "cp850", "cp866", "mac_roman", "koi8-r", "iso8859-2", "iso8859-15"]
#: What is read as UTF-8 by mistake and read once more: the second garbling of a text.
TWICE = [("latin-1", "latin-1"), ("cp1252", "cp1252"), ("latin-1", "cp1252"), ("cp1252", "latin-1")]
#: Encodings of the bytes, and what they are wrongly read as, where neither is UTF-8.
CROSSED = [
    ("cp1250", "cp1252"), ("cp1250", "latin-1"), ("iso8859-2", "cp1252"), ("iso8859-2", "latin-1"), ("cp1251", "cp1252"),
    ("cp1251", "latin-1"), ("koi8-r", "cp1251"), ("cp1251", "koi8-r"), ("koi8-r", "cp1252"), ("koi8-r", "latin-1"),
    ("cp1253", "cp1252"), ("cp1253", "latin-1"), ("iso8859-7", "cp1252"), ("iso8859-7", "latin-1"), ("mac_roman", "cp1252"),
    ("mac_roman", "latin-1"), ("cp1252", "mac_roman"), ("cp1252", "cp437"), ("cp437", "cp1252"), ("cp850", "cp1252"),
    ("cp1252", "cp850"), ("cp866", "cp1251"), ("cp1251", "cp866"), ("cp1252", "cp1250"), ("shift_jis", "cp1252"),
    ("shift_jis", "latin-1"), ("euc_jp", "cp1252"), ("euc_jp", "latin-1"),
]
#: Bytes of these encodings are wrongly read as UTF-8, where what is none becomes U+FFFD and is lost.
LOST = ["cp1252", "cp1250", "iso8859-2", "cp1251", "koi8-r", "cp1253", "mac_roman", "shift_jis"]
TOKEN = re.compile(r"[0-9A-Za-z]*[^\x00-\x7f][0-9A-Za-z\x80-\U0010ffff]*")
_STRETCH = re.compile(r"[^\x00-\x7f]+")
#: Signs that may follow a word; a garbled letter that ends in one of them, at the end of a word, proves nothing by itself.
_CLOSING = "…’”»›–—\xa0"
_BITS = 23
#: Longer stretches, of scripts without spaces, are mostly met by their characters; as wholes they are garbled all the same,
#: but only those forms go into the table that stand in the corpus.
LONGEST = 40


def _reader(encoding: str) -> list[str]:
    """The characters of the 256 bytes; bytes that the encoding leaves undefined are read as controls, as common decoders do."""
    out = []
    for b in range(256):
        try:
            out.append(bytes([b]).decode(encoding))
        except UnicodeDecodeError:
            out.append(chr(b))
    return out


_READ = {e: _reader(e) for e in {*READ_AS, *(b for _, b in CROSSED), *(x for p in TWICE for x in p)}}
_BYTE = {e: {c: b for b, c in enumerate(t)} for e, t in _READ.items()}


def read(data: bytes, encoding: str) -> str:
    t = _READ[encoding]
    return "".join([t[b] for b in data])


def chains() -> list[tuple[str, ...]]:
    """All chains: encodings written and read in turn."""
    once = [("utf-8", r) for r in READ_AS]
    twice = [("utf-8", a, "utf-8", b) for a, b in TWICE]
    return once + twice + CROSSED + [(e, "utf-8") for e in LOST]


def over_utf8(chain: tuple[str, ...]) -> bool:
    return chain[0] == "utf-8"


def garble(text: str, chain: tuple[str, ...]) -> str | None:
    """The text as it comes out of a chain; None where it could not have gone in."""
    for out, back in zip(chain[::2], chain[1::2]):
        try:
            data = text.encode(out)
        except UnicodeEncodeError:
            return None
        text = data.decode("utf-8", errors="replace") if back == "utf-8" else read(data, back)
    return text if chain[-1] != "utf-8" or "�" in text else None  # bytes that happen to be UTF-8 are not lost


def ungarble(text: str, chain: tuple[str, ...]) -> str | None:
    """The text that went in; None where characters were lost or the chain could not have given it."""
    for out, back in zip(chain[-2::-2], chain[::-2]):
        byte = _BYTE.get(back)
        if byte is None:
            return None
        try:
            text = bytes([byte[c] for c in text]).decode(out)
        except (KeyError, UnicodeDecodeError):
            return None
    return text


def _tally(documents: DataFrame) -> DataFrame:
    """(w, df): the distinct words with a non-ASCII character, and in how many documents they stand."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                if t and not t.isascii():
                    seen.update(set(TOKEN.findall(t)))
            if len(seen) > 100_000:
                yield _counts(seen)
                seen.clear()
        yield _counts(seen)

    return documents.select("text").mapInArrow(run, "w string, n bigint").groupBy("w").agg(F.sum("n").alias("df"))


def _counts(seen: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["w", "n"])


def parts_of(word: str) -> set[str]:
    """Its non-ASCII stretches and their characters."""
    runs = _STRETCH.findall(word)
    return {c for r in runs for c in r} | set(runs)


def lookups_of(word: str) -> set[str]:
    """The stretches by which a word can be met: whole ones, and all pieces of two to four characters."""
    out = set()
    for r in _STRETCH.findall(word):
        out.add(r)
        for n in (2, 3, 4):
            out.update(r[i : i + n] for i in range(len(r) - n + 1))
        if "�" in r:
            out.add("�")
    return out


class Bitmap:
    """A map of 2**_BITS bits of the words of a table, of one size whatever the table; it lets words pass, exact joins follow."""

    def __init__(self, words: DataFrame, column: str):
        slot = F.pmod(F.crc32(F.col(column).cast("binary")), F.lit(1 << _BITS))
        self.bits = bytearray(1 << _BITS - 3)
        words32 = words.select(slot.alias("s")).groupBy(F.shiftright("s", 5).cast("int").alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 31 as int))")).alias("b"))
        for r in words32.toLocalIterator():  # at most 2 ** (_BITS - 5) rows
            self.bits[4 * r.at : 4 * r.at + 4] = r.b.to_bytes(4, "little")

    def may_hold(self, word: str) -> int:
        s = zlib.crc32(word.encode()) & (1 << _BITS) - 1
        return self.bits[s >> 3] >> (s & 7) & 1


def _word_table(words: DataFrame, present: Bitmap) -> DataFrame:
    """(g, w, wdf, chain): the garbled forms of all words, over UTF-8 also those put into lower or upper case afterwards."""
    every = chains()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g, w, df, chain = [], [], [], []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if "�" in word:
                    continue
                met = {word}
                for k, c in enumerate(every):
                    out = garble(word, c)
                    if out is None:
                        continue
                    # a no-break space at the end of a word may have been taken for a space
                    for form in {out, out.lower(), out.upper(), *([out[:-1]] if out[-1] == "\xa0" and len(out) > 2 else [])} if over_utf8(c) else (out,):
                        if form not in met and present.may_hold(form):
                            g.append(form)
                            w.append(word)
                            df.append(n)
                            chain.append(k)
                        met.add(form)
            yield pa.RecordBatch.from_arrays([pa.array(g, pa.string()), pa.array(w, pa.string()), pa.array(df, pa.int64()), pa.array(chain, pa.int32())], names=["g", "w", "wdf", "chain"])

    return words.mapInArrow(run, "g string, w string, wdf bigint, chain int")


def _part_table(words: DataFrame) -> DataFrame:
    """(p, chain): the garbled forms of the parts of words, over UTF-8, and of single letters of two bytes; and U+FFFD.

    Forms longer than LONGEST stand in it only where the corpus has them."""
    every = list(enumerate(chains()))
    lost = next(k for k, c in every if c[-1] == "utf-8")

    def long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = list({r for word in batch.column(0).to_pylist() if len(word) > LONGEST for r in _STRETCH.findall(word) if len(r) > LONGEST})
            yield pa.RecordBatch.from_arrays([pa.array(seen, pa.string())], names=["part"])

    present = Bitmap(words.select("w").mapInArrow(long, "part string"), "part")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = list({p for word in batch.column(0).to_pylist() for p in parts_of(word)})
            yield pa.RecordBatch.from_arrays([pa.array(seen, pa.string())], names=["part"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: set[tuple[str, int]] = set()
            for part in batch.column(0).to_pylist():
                if "�" in part:
                    out.add(("�", lost))
                    continue
                for k, c in every:
                    if c[-1] == "utf-8" or not over_utf8(c) and (len(part) > 1 or ord(part) < 0x2E80):
                        continue
                    g = garble(part, c)
                    if g is not None and len(g) > len(part):
                        out.update((form, k) for form in ({g, g.lower(), g.upper()} if over_utf8(c) else {g}) if len(form) > 1 and not form.isascii() and (len(form) <= LONGEST or present.may_hold(form)))
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.string()), pa.array([b for _, b in out], pa.int32())], names=["p", "chain"])

    parts = words.mapInArrow(split, "part string").distinct()
    return parts.mapInArrow(run, "p string, chain int").distinct()


def _telling(word: str, part: str) -> bool:
    """Whether the part proves anything where it stands: letters of one script only as a capital inside a word before small
    letters, a letter with a closing sign only where the word goes on after it."""
    if part.isalpha() and len({unicodedata.name(c, "?").split(" ")[0] for c in part}) == 1:
        return part[0].isupper() and part[1:].islower() and bool(re.search(r"[^\W\d_A-Z]" + re.escape(part), word))
    if part[-1] not in _CLOSING or len(part) > 2:
        return True
    at = word.find(part)
    while at >= 0:
        end = at + len(part)
        if end < len(word) and word[end] not in _CLOSING:
            return True
        at = word.find(part, at + 1)
    return False


def judge(word: str, df: int, whole: list, parts: list, every: list[tuple[str, ...]]) -> tuple[bool, int, str | None] | None:
    """(certain, chain, original or None) of a word met, or None if it proves nothing.

    `whole`: (chain, original, its documents, documents of all originals of that form); `parts`: (part, chain).
    """
    best: tuple | None = None
    for chain, origin, n, of_all in whole:
        c = every[chain]
        if over_utf8(c):
            rank = (3, n)
        elif c[-1] == "utf-8":
            rank = (2, n)
        else:
            odd = [x for x in word if ord(x) > 127]
            if n <= df:
                continue
            inside = any(not x.isalpha() for x in word[1:-1] if ord(x) > 127) or any("\x80" <= x <= "\x9f" for x in word)
            certain = len(word) > 1 and (inside or len(odd) > 2 or len(odd) == 2 and len(word) > 2)
            rank = (1 if certain else 0, n)
        if best is None or rank > best[0]:
            best = (rank, chain, origin, 2 * n > of_all)
    if best and best[0][0] >= 1:
        return True, best[1], best[2] if best[0][0] != 2 or best[3] else None
    met: dict[int, set[str]] = {}
    for part, chain in parts:
        if _telling(word, part):
            met.setdefault(chain, set()).add(part)
    for chain in sorted(met, key=lambda k: (-max(map(len, met[k])), -len(met[k]), k)):
        c = every[chain]
        if c[-1] == "utf-8":
            return True, chain, None
        if over_utf8(c) or len(met[chain]) > 2:
            return True, chain, _undone(word, c)
    return (False, best[1], best[2]) if best else None


def _undone(word: str, chain: tuple[str, ...]) -> str | None:
    """The word, or each of its non-ASCII stretches for which that is possible, with the chain run back and checked forward."""
    back = ungarble(word, chain)
    if back is not None and garble(back, chain) == word:
        return back
    done = False

    def one(m: re.Match) -> str:
        nonlocal done
        r = ungarble(m[0], chain)
        if r is None or garble(r, chain) != m[0]:
            return m[0]
        done = True
        return r

    out = _STRETCH.sub(one, word)
    return out if done else None


def garbled_words(documents: DataFrame) -> DataFrame:
    """(word, certain, chain, original): the words that came out of a chain of encodings, by the forward table.

    Over UTF-8 one garbled letter is proof; between other encodings a word must be rarer than its original, and is certain
    only if it holds a sign or control inside or several letters that the original has otherwise. `original` is null where
    characters were lost and no original stands out.
    """
    every = chains()
    words = stored(_tally(documents), "words")
    present = Bitmap(words, "w")
    known = bounded(words)
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    forms = _word_table(words.repartition(tasks, "w"), present).join(known.select(F.col("w").alias("g"), "df"), "g")
    whole = forms.groupBy("g", "df", "chain").agg(F.max(F.struct("wdf", "w")).alias("b"), F.sum("wdf").alias("all"))
    whole = whole.select(F.col("g").alias("word"), "df", F.struct("chain", F.col("b.w").alias("origin"), F.col("b.wdf").alias("n"), F.col("all").alias("of_all")).alias("whole"), F.lit(None).cast("struct<part:string,chain:int>").alias("part"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w, df, p = [], [], []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = lookups_of(word)
                p += found
                w += [word] * len(found)
                df += [n] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(w, pa.string()), pa.array(df, pa.int64()), pa.array(p, pa.string())], names=["word", "df", "p"])

    table = bounded(cut(_part_table(words)))
    met = words.select("w", "df").repartition(tasks, "w").mapInArrow(pieces, "word string, df bigint, p string").join(table, "p")
    part = met.select("word", "df", F.lit(None).cast(whole.schema["whole"].dataType).alias("whole"), F.struct(F.col("p").alias("part"), "chain").alias("part"))
    both = whole.unionByName(part).groupBy("word", "df").agg(F.collect_list("whole").alias("whole"), F.collect_list("part").alias("part"))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for word, df, w, p in zip(*[c.to_pylist() for c in batch.columns]):
                found = judge(word, df, [(x["chain"], x["origin"], x["n"], x["of_all"]) for x in w], [(x["part"], x["chain"]) for x in p], every)
                if found:
                    out.append((word, *found))
            cols = list(zip(*out)) or [(), (), (), ()]
            kinds = [pa.string(), pa.bool_(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["word", "certain", "chain", "original"])

    return stored(both.mapInArrow(decide, "word string, certain boolean, chain int, original string"), "garbled")


def met_in(documents: DataFrame, words: DataFrame) -> DataFrame:
    """(doc_id, word, certain, chain, original): the garbled words of each document."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    wanted = Bitmap(words, "word")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may_hold = wanted.may_hold
        known: dict[str, int] = {}
        for batch in batches:
            at, found = [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                if t and not t.isascii():
                    for w in set(TOKEN.findall(t)):
                        hit = known.get(w)
                        if hit is None:
                            if len(known) > 300_000:
                                known.clear()
                            hit = known[w] = may_hold(w)
                        if hit:
                            at.append(i)
                            found.append(w)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(found, pa.string())], names=["doc_id", "word"])

    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, word string").join(bounded(words), "word")


def _proven(rows: DataFrame) -> DataFrame:
    """(doc_id): documents with a certain word, or with two different words of one chain that alone would not be certain."""
    by_chain = rows.where(F.col("certain") | (F.length("word") > 1)).groupBy("doc_id", "chain").agg(F.max("certain").alias("certain"), F.min("word").alias("a"), F.max("word").alias("z"))
    return by_chain.where(F.col("certain") | (F.col("a") != F.col("z"))).select("doc_id").distinct()


def garbled_documents(documents: DataFrame) -> DataFrame:
    """(doc_id) of the documents whose text, wholly or in part, was decoded with a wrong encoding.

    Null, empty and plain ASCII texts are never found. A null doc_id is returned as any other. Whole texts are read.
    """
    return _proven(met_in(documents, garbled_words(documents)))


def restored(documents: DataFrame) -> DataFrame:
    """(doc_id, text, lost): every document found, its text with the garbled words put back, and how many remain lost.

    A document without a doc_id is found, but not put back, as nothing tells which row it is.
    """
    rows = met_in(documents, garbled_words(documents))
    fix = F.struct("word", "original", "certain", "chain")
    fixes = rows.join(_proven(rows), "doc_id", "left_semi").groupBy("doc_id").agg(F.collect_set(fix).alias("fixes"))
    every = chains()
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lost = [], []
            for t, fixes in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                by = {f["word"]: f["original"] for f in fixes}
                crossed = sorted({f["chain"] for f in fixes if f["certain"] and "utf-8" not in every[f["chain"]]})
                gone = 0

                def one(m: re.Match) -> str:
                    nonlocal gone
                    if m[0] not in by:  # a word that stands nowhere else, by a chain that is certain in this text
                        for k in crossed:
                            back = ungarble(m[0], every[k])
                            if back and max(m[0]) < "Ā" and back.isalpha() and min(back) > "ͯ":
                                return back
                        return m[0]
                    if by[m[0]] is None:
                        gone += 1
                    return by[m[0]] or m[0]

                texts.append(TOKEN.sub(one, t))
                lost.append(gone)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(lost, pa.int32())], names=["doc_id", "text", "lost"])

    return documents.select("doc_id", "text").join(fixes, "doc_id").select("doc_id", "text", "fixes").mapInArrow(run, f"doc_id {kind}, text string, lost int")
