"""Scalar functions on text: normal forms, keys, shingles, validators."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters removed as pictures, marks and letters folded in right-to-left scripts, and their languages.
PICTURES = "[\U0001f300-\U0001f6ff\U0001f900-\U0001f9ff\U0001fa70-\U0001faff☀-⛿✀-➿︀-️\U0001f1e6-\U0001f1ff‍]+"
RTL_MARKS = "[ً-ٰٟۖ-ۭ]"
RTL_LETTERS = {"آ": "ا", "أ": "ا", "إ": "ا", "ٱ": "ا", "ة": "ه", "ى": "ي"}
RTL_LANGUAGES = ["ar", "he", "fa", "ur"]
PUNCTUATION = "[!-/:-@[-`{-~¡-¿]"

# Language presets.
LANGUAGE_PRESETS = {
    "european": "en fr de nl es pt it ca gl eu oc sv da no nn fi is fo pl cs sk hu ro bg hr sr bs sl mk uk ru be lt lv et el sq mt cy br ka yi la".split(),
    "southeast_asian": "vi th id ms tl jw km my".split(),
    "african": "sw yo sn so am af".split(),
    "east_asian": "zh ja ko mn yue".split(),
    "all": None,
}
# Tags spoken for punctuation, and tags that mark a segment as no speech.
TAG_SIGNS = {"<COMMA>": ",", "<PERIOD>": ".", "<QUESTIONMARK>": "?", "<EXCLAMATIONPOINT>": "!"}
NON_SPEECH_TAGS = ["<OTHER>", "<MUSIC>", "<NOISE>", "<SIL>"]


def normal_form(text: str | None, language: str | None, strip_punctuation: bool) -> str:
    """The comparison key of a transcript: compatible form, case folded, pictures out, punctuation runs to one sign.

    In right-to-left languages (the tag up to its first hyphen) marks go and letter variants are folded; with
    `strip_punctuation` signs become spaces; white space is collapsed last. Null gives an empty text.
    """
    out = unicodedata.normalize("NFKC", text or "").casefold()
    out = re.sub(PICTURES, "", out)
    out = re.sub(f"({PUNCTUATION})\\1+", r"\1", out)
    if (language or "").lower().partition("-")[0] in RTL_LANGUAGES:
        out = re.sub(RTL_MARKS, "", out).translate(str.maketrans(RTL_LETTERS))
    if strip_punctuation:
        out = re.sub(f"{PUNCTUATION}+", " ", out)
    return " ".join(out.split())


def normalize_text(text: Column, language: Column | None = None, strip_punctuation: bool = False) -> Column:
    """`normal_form` as an Arrow-batched column function."""

    @F.pandas_udf("string")
    def run(texts: pd.Series, languages: pd.Series) -> pd.Series:
        return pd.Series([normal_form(t, lang, strip_punctuation) for t, lang in zip(texts, languages)], dtype=object)

    return run(text, language if language is not None else F.lit(None).cast("string"))


def sample_key(c: Column) -> Column:
    """Key used across files: trimmed, lower case."""
    return F.lower(F.trim(c))


def file_key(path: Column) -> Column:
    """Key of a file path: without a leading /data/ and without the extension of its last part."""
    return sample_key(F.regexp_replace(F.regexp_replace(path, "^/data/", ""), r"(?<=[^/.])\.[^./]*$", ""))


def record_id(c: Column) -> Column:
    """Identifier without one leading './'."""
    return F.regexp_replace(c, r"^\./", "")


def base_language(c: Column) -> Column:
    """Tag up to the first hyphen, in lower case."""
    return F.lower(F.substring_index(c, "-", 1))


def allowed_language(c: Column, preset: str) -> Column:
    """Whether the tag belongs to the preset; `all` takes every tag but 'nospeech'. Null belongs to none."""
    codes = LANGUAGE_PRESETS[preset]
    return F.coalesce(c != "nospeech" if codes is None else c.isin(codes), F.lit(False))


def clean_tagged(text: Column) -> Column:
    """Tags to signs, no space before a sign, lower case; null for blank texts and those with a non-speech tag."""
    out = F.trim(text)
    speech = out != ""
    for tag in NON_SPEECH_TAGS:
        speech = speech & ~out.contains(tag)
    for tag, sign in TAG_SIGNS.items():
        out = F.replace(out, F.lit(tag), F.lit(sign))
    return F.when(speech, F.lower(F.regexp_replace(out, r"\s+([.,?!])", "$1")))


def let(value: Column, f) -> Column:
    """f(value), with the value computed once a row; written out in a lambda it would be computed once an element."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def words(text: Column) -> Column:
    """Words between white space; none for null and blank texts."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[ \t\n\r]+"), lambda w: w != "")


def ngrams(tokens: Column, n: int, sep: str = " ") -> Column:
    """Runs of `n` tokens; fewer tokens give one run of all, none give none."""

    def of(t: Column) -> Column:
        # elements one by one: taking a slice copies the whole array each time
        runs = F.transform(F.sequence(F.lit(0), F.size(t) - n), lambda i: F.concat_ws(sep, *[F.get(t, i + k) for k in range(n)]))
        return F.when(F.size(t) >= n, runs).when(F.size(t) > 0, F.array(F.array_join(t, sep))).otherwise(F.array().cast("array<string>"))

    return let(tokens, of)


def char_shingles(text: Column, n: int, pad: bool = True) -> Column:
    """Distinct runs of `n` characters. A shorter text is one shingle, padded with U+0000 if `pad`; an empty one has none.

    The text is split into characters once; taking substrings of the whole text for every place would cost the square.
    """
    chars = F.split(text, "")
    short = F.array(F.rpad(text, n, "\0") if pad else text)
    return F.when(F.length(text) >= n, F.array_distinct(ngrams(chars, n, ""))).when(F.length(text) > 0, short).otherwise(F.array().cast("array<string>"))


def error_key(text: Column) -> Column:
    """The form in which errors are counted: lower case, everything but a-z, 0-9, apostrophe and space is a space."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^a-z0-9'\s]", " "), r"\s+", " "))


def excess_repetition(tokens: Column, n: int = 15, times: int = 5) -> Column:
    """Whether any run of `n` tokens occurs at least `times` times; sorted runs are compared with the one `times` - 1 on."""
    runs = F.sort_array(ngrams(tokens, n))
    hits = let(runs, lambda r: F.exists(F.sequence(F.lit(1), F.size(r) - (times - 1)), lambda i: F.get(r, i - 1) == F.get(r, i + (times - 2))))
    return F.when(F.size(tokens) >= n + times - 1, hits).otherwise(F.lit(False))


def valid_rewrite(original: Column, rewritten: Column, low: float = 0.5, high: float = 2.0, leaks: tuple[str, ...] = ("Input:", "Output:"), examples: tuple[str, ...] = ()) -> Column:
    """The rewritten text if it is not blank, its length is within bounds of the original's and it repeats no prompt; else the original.

    A phrase of the prompt's examples is no leak where the original has it too, in whatever case."""
    ratio = F.length(rewritten) / F.greatest(F.length(original), F.lit(1))
    ok = (F.trim(F.coalesce(rewritten, F.lit(""))) != "") & ratio.between(low, high)
    for leak in leaks:
        ok = ok & ~rewritten.contains(leak)
    for phrase in examples:
        ok = ok & (~F.lower(rewritten).contains(phrase.lower()) | F.lower(original).contains(phrase.lower()))
    return F.when(ok, rewritten).otherwise(original)


def marked_region(text: Column, begin: str, end: str) -> Column:
    """What stands between two markers, trimmed; without the first marker from the start, without the second to the end."""
    after = F.when(text.contains(begin), F.substring(text, F.instr(text, begin) + len(begin), F.length(text))).otherwise(text)
    return F.trim(F.substring_index(after, end, 1))


def universal_id(source: Column, number: Column) -> Column:
    """'{source}@{number, six digits}'; a negative number raises."""
    return F.when(number < 0, F.raise_error(F.lit("negative clip number")).cast("string")).otherwise(F.format_string("%s@%06d", source, number.cast("bigint")))
