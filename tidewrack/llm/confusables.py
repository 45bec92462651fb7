"""Problem 4: text that looks the same in one form, by confusables skeletons.

A text is taken word by word; of the spaces between, unusual ones count as words of their own. The skeleton of a word is its decomposition with every character
replaced by its prototype and decomposed again; words of equal skeleton look the same and are one group. The prototypes are
the whole published look-alike table, as the ICU library that comes with Spark holds it. A word is unusual if it holds
compatibility forms, split accents, unseen characters or letters of another script; it is replaced by the most frequent
usual spelling of its group, or, where the corpus has none, by a form made from the prototypes.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewrack.operators.joins import bounded
from tidewrack.session import stored

#: Characters with a compatibility form that are nevertheless the usual ones for what is seen.
USUAL = set("…‥ªº¹²³¼½¾µ™℠№´¨¯¸℃℉")
#: Marks without a glyph of their own beside those of the Unicode category Cf.
UNSEEN = set("͏ᅟᅠ឴឵᠋᠌᠍ㅤﾠ") | {chr(c) for c in range(0xFE00, 0xFE10)}
_CJK = {"CJK", "HIRAGANA", "KATAKANA", "KATAKANA-HIRAGANA", "HANGUL", "BOPOMOFO", "IDEOGRAPHIC", "HALFWIDTH", "FULLWIDTH"}
_LETTERS = re.compile(r"[^\W\d_][^\W\d_̀-ͯ]*(?:[̀-ͯ]*['’]?[^\W\d_̀-ͯ]+)*")
_SMALL_CAPITAL = re.compile(r"LATIN LETTER SMALL CAPITAL ([A-Z])$")
#: Words, and each space that is no plain one; the ideographic space stays within what it stands in.
_PIECES = re.compile("(?:\\S|\u3000)+|[^\\S \\t\\n\\r\\f\\v]")
_WORDS_AT_ONCE = 200_000
_TABLES: dict[str, "LookAlikes"] = {}  # by application


def _script(ch: str) -> str:
    """The script of a letter, after the first word of its Unicode name; empty for anything else."""
    name = unicodedata.name(ch, "") if ch.isalpha() else ""
    return name.split(" ")[0] if "LETTER" in name or "IDEOGRAPH" in name or "SYLLABLE" in name else ""


def _cased(ch: str) -> bool:
    return ch.lower() != ch.upper()


def _pictured(ch: str) -> bool:
    return unicodedata.category(ch) in ("So", "Sk") or ch in "‍️" or ch in "0123456789#*"


def _unseen(word: str, i: int) -> bool:
    ch = word[i]
    if ch not in UNSEEN and unicodedata.category(ch) != "Cf":
        return False
    if ch in "‍️︎":  # parts of an emoji
        return not (i and _pictured(word[i - 1]) and (ch != "‍" or i + 1 < len(word) and _pictured(word[i + 1])))
    return not 0xE0020 <= ord(ch) <= 0xE007F


class LookAlikes:
    """The look-alike table and what follows from it. `prototype` maps single characters to what they look like."""

    def __init__(self, prototype: dict[str, str]):
        self.prototype = prototype
        letters = [c for c in {*prototype, *"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"} if _cased(c) and len(c) == 1]
        #: By script, (prototype, whether a capital): its first letter of that look.
        self.own: dict[str, dict[tuple[str, bool], str]] = {}
        for c in sorted(letters):
            self.own.setdefault(_script(c), {}).setdefault((self._look(c), c.isupper()), c)
        #: Every letter of another script that looks like a Latin one, small ones also where only the capital does.
        self.latin = {c: latin for c in [*prototype, *(c.lower() for c in letters)] if len(c) == 1 and not c.isascii() and _script(c) != "LATIN" and (latin := self.like(c, "LATIN")) and latin.isascii()}
        self.to_latin = str.maketrans(self.latin)
        self._map = str.maketrans(prototype | {c: self._look(latin) for c, latin in self.latin.items()})
        #: Letters of the phonetic alphabet and small capitals, as the ordinary letters that they look like.
        self.phonetic = {}
        for c in [*map(chr, range(0x250, 0x2B0)), *map(chr, range(0x1D00, 0x1D80)), *map(chr, range(0xA720, 0xA800))]:
            name = _SMALL_CAPITAL.match(unicodedata.name(c, ""))
            look = name[1].lower() if name else self._look(c)
            if unicodedata.name(c, "").startswith("LATIN") and len(look) == 1 and look.isascii() and look.isalpha():
                self.phonetic[c] = look
        self._phonetic = str.maketrans(self.phonetic)

    def _look(self, c: str) -> str:
        return self.prototype.get(c, c)

    def like(self, c: str, script: str) -> str | None:
        """The letter of `script` that looks like `c`, or whose capital looks like its capital; None if there is none."""
        table = self.own.get(script, {})
        found = [table.get((self._look(c), c.isupper()))]
        if not c.isupper() and len(c.upper()) == 1:
            capital = table.get((self._look(c.upper()), True))
            found.append(capital.lower() if capital and len(capital.lower()) == 1 else None)
        if script == "LATIN":
            return next(filter(None, sorted(found, key=lambda x: x is None or not x.isascii())), None)
        return min(filter(None, found), default=None)

    def _alike(self, c: str, script: str) -> bool:
        """Whether `script` has a letter that looks like `c` itself; of Latin letters only the unmarked ones count."""
        found = self.own.get(script, {}).get((self._look(c), c.isupper()))
        return found is not None and (script != "LATIN" or found.isascii())

    def skeleton(self, text: str) -> str:
        """Decomposed, every character by its prototype, decomposed again; equal for texts that look the same.

        A small letter whose capital looks like a Latin one also goes to that one's small letter, as disguised capitals may
        have been put into lower case since.
        """
        kept = text if text.isascii() else "".join(c for i, c in enumerate(text) if not _unseen(text, i))
        return unicodedata.normalize("NFKD", unicodedata.normalize("NFKD", kept).translate(self._map))

    def _one_script(self, m: re.Match) -> str:
        """A word in the script of most of its letters that look like no letter of another; of equally many, Latin first."""
        word = m[0].translate(self._phonetic) if len(m[0]) > 1 else m[0]
        scripts = _mixed(word)
        if not scripts:
            return word
        sure = dict.fromkeys(sorted(scripts), 0)
        bare = unicodedata.normalize("NFD", word)
        for c in unicodedata.normalize("NFC", word):
            s = _script(c)
            if s in sure:
                base = unicodedata.normalize("NFD", c)[0]
                sure[s] += not (self._alike(base, "LATIN") if s != "LATIN" else c == base and any(self._alike(base, o) for o in scripts - {s}))
        to = max(sure, key=lambda s: (sure[s], s == "LATIN", s))
        return unicodedata.normalize("NFC", "".join((self.like(c, to) or c) if _script(c) in scripts - {to} else c for c in bare))

    def scan(self, word: str) -> tuple[str, bool]:
        """The word in its usual form, and whether that differs in more than what `USUAL` allows or scripts are mixed in it."""
        if word.isascii():
            return word, False
        unseen = [_unseen(word, i) for i in range(len(word))]
        found = any(unseen)
        seen = "".join(c for c, u in zip(word, unseen) if not u) if found else word
        if unicodedata.normalize("NFC", seen) != seen:
            found = True
        cjk = any(_script(c) in _CJK and ord(c) < 0xFF00 for c in seen)
        plain = []
        for c in seen:
            usual = unicodedata.normalize("NFKC", c)
            if usual != c and (c in USUAL or cjk and (0xFF00 <= ord(c) < 0xFF61 or c == "　") and not c.isalnum()):
                usual = c
            found |= usual != c
            plain.append(usual)
        form = unicodedata.normalize("NFC", "".join(plain))
        single = _LETTERS.sub(self._one_script, form)
        return single, found or single != form or any(_mixed(w) for w in _LETTERS.findall(form))

    def shown(self, word: str) -> str:
        """What a word shows, without case and with every letter that looks like a Latin one as that letter.

        Words of one script lose their case first, so that both cases come to the same; in mixed words the capitals count.
        """
        if word.isascii():
            return word.casefold()
        kept = "".join(c for i, c in enumerate(word) if not _unseen(word, i))
        form = unicodedata.normalize("NFKD", kept).translate(self._phonetic)
        if any(_mixed(w) for w in _LETTERS.findall(form)):
            form = form.translate(self.to_latin)
        return unicodedata.normalize("NFC", form.casefold().translate(self.to_latin))


def _mixed(word: str) -> set[str]:
    """The scripts with capitals whose letters are mixed in the word; empty if there are not two."""
    scripts = {_script(c) for c in word if _cased(c)} - {"", "COMBINING", "MODIFIER"} - _CJK
    return scripts if len(scripts) > 1 else set()


def look_alikes_of(spark: SparkSession) -> LookAlikes:
    """The published look-alike table from the ICU library on Spark's class path; read once by application.

    Its size is that of the table (some thousand characters), whatever the data are.
    """
    app = spark.sparkContext.applicationId
    if app not in _TABLES:
        checker = spark._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
        each = [c for c in map(chr, range(0x21, 0x30000)) if unicodedata.category(c) not in ("Cn", "Co", "Cs", "Cc") and unicodedata.normalize("NFKD", c) == c]
        shown = checker.getSkeleton("\n".join(each)).split("\n")
        _TABLES[app] = LookAlikes({c: s for c, s in zip(each, shown, strict=True) if s != c})
    return _TABLES[app]


def pieces(text: str) -> list[str]:
    return text.split() if text.isascii() else _PIECES.findall(text)


class Scanner:
    """`scan` of whole texts, remembering the words seen so far."""

    def __init__(self, table: LookAlikes):
        self.table, self.words = table, {}

    def word(self, w: str) -> tuple[str, bool]:
        hit = self.words.get(w)
        if hit is None:
            if len(self.words) >= _WORDS_AT_ONCE:
                self.words.clear()
            hit = self.words[w] = self.table.scan(w)
        return hit

    def odd(self, text: str | None) -> list[str]:
        """The distinct unusual words of a text, in order."""
        return [] if not text or text.isascii() else list(dict.fromkeys(w for w in _PIECES.findall(text) if self.word(w)[1]))


def spellings(df: DataFrame, columns: list[str], table: LookAlikes) -> DataFrame:
    """(form, n, skeleton, usual, odd): every distinct word of `columns`, its count, its skeleton, the form made from prototypes.

    Counted by Arrow batch before the shuffle, so a word that fills a third of the rows is no load.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter[str] = Counter()
            for column in batch.columns:
                for t in column.to_pylist():
                    if t:
                        seen.update(pieces(t))
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["form", "n"])

    def bones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = batch.column(0).to_pylist()
            scanned = [table.scan(w) for w in forms]
            cols = [pa.array([table.skeleton(w) for w in forms], pa.string()), pa.array([s[0] for s in scanned], pa.string()), pa.array([s[1] for s in scanned], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], names=["form", "n", "skeleton", "usual", "odd"])

    words = df.select(*columns).mapInArrow(count, "form string, n bigint").groupBy("form").agg(F.sum("n").alias("n"))
    return words.mapInArrow(bones, "form string, n bigint, skeleton string, usual string, odd boolean")


def canonical(words: DataFrame) -> DataFrame:
    """(form, usual, canonical) of the unusual words of `spellings`: the spelling that their skeleton's group comes to.

    It is the most frequent usual spelling of the group, of equally frequent ones the smallest; where no spelling of the
    group is usual, the smallest form made from the prototypes of its members.
    """
    good = F.when(~F.col("odd"), F.struct((-F.col("n")).alias("less"), "form"))
    groups = words.groupBy("skeleton").agg(F.min(good).alias("_good"), F.min(F.when(F.col("odd"), F.col("usual"))).alias("_made"))
    odd = words.where("odd").select("skeleton", "form", "usual")
    return odd.join(groups, "skeleton").select("form", "usual", F.coalesce("_good.form", "_made").alias("canonical"))


def _odd_words(rows: DataFrame, kind: str, table: LookAlikes) -> DataFrame:
    """(row, form): the unusual words of the rows; `rows` has its identity first, then texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(table)
        for batch in batches:
            at, forms = [], []
            for k in range(1, batch.num_columns):
                for i, t in enumerate(batch.column(k).to_pylist()):
                    odd = scanner.odd(t)
                    at += [i] * len(odd)
                    forms += odd
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(forms, pa.string())], names=["row", "form"])

    return rows.mapInArrow(run, f"row {kind}, form string")


def unusual(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key) of the rows with a word that is not the canonical spelling of its skeleton's group, each key once.

    Null and empty texts are no case; a null key comes out as one row. Other columns of `df` do not matter.
    """
    table = look_alikes_of(df.sparkSession)
    wrong = bounded(stored(canonical(spellings(df, columns, table)).where("canonical <> form").select("form"), "spellings"))
    rows = _odd_words(df.select(key, *columns), df.schema[key].dataType.simpleString(), table)
    return rows.join(wrong, "form", "left_semi").select(F.col("row").alias(key)).distinct()


def unified(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, each of `columns` in its canonical form, `found`): found if any of the columns holds an unusual word.

    Null texts stay null, empty ones empty; neither is found. Other columns of `df` are not touched or returned; rows are
    kept one for one. Words whose group has a usual spelling take it from there by a join; only rows with such words move.
    """
    table = look_alikes_of(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()
    rows = stored(df.select(F.monotonically_increasing_id().alias("_row"), F.col(key).alias("_key"), *columns), "rows")
    words = stored(canonical(spellings(rows, columns, table)), "spellings")
    moved = bounded(words.where("canonical <> usual").select("form", "canonical"))
    swaps = _odd_words(rows.select("_row", *columns), "bigint", table).join(moved, "form")
    swaps = swaps.groupBy(F.col("row").alias("_row")).agg(F.map_from_entries(F.collect_set(F.struct("form", "canonical"))).alias("_swap"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(table)
        for batch in batches:
            swap = [dict(s) if s else {} for s in batch.column(1).to_pylist()]
            found = [False] * batch.num_rows
            out = [batch.column(0)]
            for k in range(2, batch.num_columns):
                forms = []
                for i, t in enumerate(batch.column(k).to_pylist()):
                    if t and not t.isascii():
                        own = swap[i]

                        def usual(m: re.Match, i: int = i, own: dict[str, str] = own) -> str:
                            form, odd = scanner.word(m[0])
                            form = own.get(m[0], form)
                            found[i] |= odd and form != m[0]
                            return form

                        t = _PIECES.sub(usual, t)
                    forms.append(t)
                out.append(pa.array(forms, pa.string()))
            yield pa.RecordBatch.from_arrays([*out, pa.array(found, pa.bool_())], names=[key, *columns, "found"])

    schema = ", ".join([f"`{key}` {kind}", *[f"`{c}` string" for c in columns], "found boolean"])
    return rows.join(swaps, "_row", "left").select("_key", "_swap", *columns).mapInArrow(run, schema)


def look_alikes(df: DataFrame, columns: list[str]) -> DataFrame:
    """(skeleton, forms, words, smallest, largest): words that look the same but are spelled in more than one way.

    `forms` counts the spellings, `words` the occurrences. Null and empty texts hold no words.
    """
    groups = spellings(df, columns, look_alikes_of(df.sparkSession)).groupBy("skeleton")
    return groups.agg(F.count(F.lit(1)).alias("forms"), F.sum("n").alias("words"), F.min("form").alias("smallest"), F.max("form").alias("largest")).where("forms > 1")
