"""Per-row text features as column expressions; Arrow UDFs only for what Spark has no expression for.

Patterns are written with explicit code points so that they mean the same in Java and in RE2.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructType

#: Unicode white space.
SPACE = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: Scripts written without spaces between words.
NO_SPACE_SCRIPTS = ("Hans", "Hant", "Jpan", "Kore", "Hang", "Thai", "Laoo", "Khmr", "Mymr")
#: An HTML tag, and terminal punctuation that isn't Unicode STerm.
HTML_TAG = r"<[a-zA-Z][^>]*>"
EXTRA_TERMINALS = ".?!;…¿¡。۔।॥"
#: Fixed value: the punctuation score where a side is empty.
NO_PUNCTUATION_SCORE = -20.0


@cache
def terminal_marks() -> str:
    """Terminal punctuation: Unicode STerm and a few more."""
    sterm = regex.compile(r"\p{STerm}")
    points = {i for i in range(0x20000) if not 0xD800 <= i < 0xE000 and sterm.match(chr(i))} | set(map(ord, EXTRA_TERMINALS))
    return "".join(map(chr, sorted(points)))


@cache
def terminal_class() -> str:
    """The marks as a character class."""
    return "[" + "".join(rf"\x{{{ord(c):x}}}" for c in terminal_marks()) + "]"


def strip(text: Column) -> Column:
    """The text without Unicode white space at its ends."""
    return F.regexp_replace(text, f"^[{SPACE}]+|[{SPACE}]+$", "")


def is_no_space(lang: Column) -> Column:
    """Whether a language code's script has no spaces between words; false without a code."""
    return F.coalesce(F.substring_index(lang, "_", -1).isin(*NO_SPACE_SCRIPTS) & lang.contains("_"), F.lit(False))


def words(text: Column) -> Column:
    """White-space tokens; white space at an end yields an empty token, and the empty text has one."""
    return F.split(text, f"[{SPACE}]+")


def word_stats(text: Column, lang: Column | None = None, mode: str = "compat") -> dict[str, Column]:
    """``word_len``, ``max_word_len`` and ``avg_word_len`` of a text, all null where it is null.

    In scripts without spaces each character counts as a word of length 1. Mode ``compat`` truncates the average to an
    integer, ``fixed`` doesn't.
    """
    sizes = F.transform(words(text), F.length)
    count, total = F.size(words(text)), F.aggregate(sizes, F.lit(0), lambda a, x: a + x)
    average = (F.floor(total / count) if mode == "compat" else total / count).cast("double")
    dense = is_no_space(lang) if lang is not None else F.lit(False)
    known = text.isNotNull()
    return {
        "word_len": F.when(known, F.when(dense, F.length(text)).otherwise(count)).cast("bigint"),
        "max_word_len": F.when(known, F.when(dense, F.lit(1)).otherwise(F.array_max(sizes))).cast("double"),
        "avg_word_len": F.when(known, F.when(dense, F.lit(1.0)).otherwise(average)),
    }


def length_ratio(a: Column, b: Column, mode: str = "compat") -> Column:
    """The larger over the smaller, a smaller of 0 counting as 1; truncated in mode ``compat``. A null side is ignored."""
    ratio = F.greatest(a, b) / F.greatest(F.least(a, b), F.lit(1))
    return (F.floor(ratio) if mode == "compat" else ratio).cast("double")


def html_flag(text: Column) -> Column:
    return F.coalesce(text.rlike(HTML_TAG), F.lit(False))


def regex_flag(text: Column, pattern: str | None) -> Column:
    """Whether a user's pattern occurs; false without a text or a pattern."""
    return F.coalesce(text.rlike(pattern), F.lit(False)) if pattern else F.lit(False)


def _no_text(a: Column, b: Column) -> Column:
    return a.isNull() | b.isNull() | (a == "") | (b == "")


def terminal_punctuation_score(source: Column, target: Column) -> Column:
    """-ln(1 + |s - t| + max(s - 1, 0) + max(t - 1, 0)) of the numbers of terminal marks; -20 if a side is empty."""
    # A table lookup per character; a class of so many marks is slow to match. The counts are bound once.
    marks = lambda t: F.length(t) - F.length(F.translate(t, terminal_marks(), ""))
    counts = F.array(F.struct(marks(source).alias("s"), marks(target).alias("t")))
    excess = lambda n: F.greatest(n - 1, F.lit(0))
    score = F.transform(counts, lambda c: -F.log(F.abs(c["s"] - c["t"]) + excess(c["s"]) + excess(c["t"]) + F.lit(1.0)))[0]
    return F.when(_no_text(source, target), F.lit(NO_PUNCTUATION_SCORE)).otherwise(score)


def levenshtein_similarity(source: Column, target: Column) -> Column:
    """1 - distance / longer length; null counts as empty, and two empty texts are equal."""
    s, t = F.coalesce(source, F.lit("")), F.coalesce(target, F.lit(""))
    longer = F.greatest(F.length(s), F.length(t))
    return F.when(longer == 0, 1.0).otherwise(1.0 - F.levenshtein(s, t) / F.greatest(longer, F.lit(1)))


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel over the longer text."""
    if len(a) < len(b):
        a, b = b, a
    places: dict[str, int] = {}
    for i, char in enumerate(a):
        places[char] = places.get(char, 0) | 1 << i
    full = (1 << len(a)) - 1
    free = full  # a zero bit: a step of the row
    for char in b:
        hit = free & places.get(char, 0)
        free = ((free + hit) | (free - hit)) & full
    return len(a) - free.bit_count()


@F.arrow_udf(DoubleType())
def lcs_ratio(source: pa.Array, target: pa.Array) -> pa.Array:
    """Longest common subsequence over the shorter length; 0 if a side is empty or null."""
    return pa.array([lcs_length(s, t) / min(len(s), len(t)) if s and t else 0.0 for s, t in zip(source.to_pylist(), target.to_pylist())], pa.float64())


_DIGIT = regex.compile(r"\p{Nd}")


def nonzero_digits(text: str) -> str:
    return "".join(str(unicodedata.digit(c)) for c in _DIGIT.findall(text)).replace("0", "")


def numeral_ratio(source: str | None, target: str | None) -> float:
    """Normalised indel similarity of the non-zero digits of two texts: 1 if neither has any, 0 if only one has."""
    if not source or not target:
        return 0.0
    s, t = nonzero_digits(source), nonzero_digits(target)
    if not s or not t:
        return float(s == t)
    return 2 * lcs_length(s, t) / (len(s) + len(t))


@F.arrow_udf(DoubleType())
def numeral_score(source: pa.Array, target: pa.Array) -> pa.Array:
    return pa.array([numeral_ratio(s, t) for s, t in zip(source.to_pylist(), target.to_pylist())], pa.float64())


#: Marks the end of a text where many are searched at once; no character has this number.
_STOP = 0xFFFFFFFF
_BLANK = np.array([i for i in range(0x3001) if regex.match(r"\s", chr(i))], np.uint32)


def repetitions(texts: list[str | None], size: int = 3, times: int = 2) -> np.ndarray:
    """For each text the repeats of its first segment of ``size`` characters that follows itself at least ``times``
    times, with or without spaces between; 0 if there is none. A segment begins with no white space and doesn't go
    beyond a line.

    All texts are searched together and in time linear in their length: from each place the next segment begins behind
    any spaces, and where it is equal the repeats there are one more than at that next place."""
    lengths = np.array([len(t) if t else 0 for t in texts], np.int64)
    begin = np.cumsum(lengths + size) - lengths - size
    total = int((lengths + size).sum())
    points = np.full(total + size + 1, _STOP, np.uint32)
    for at, text in zip(begin.tolist(), texts):
        if text:
            points[at : at + len(text)] = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    place = np.arange(total, dtype=np.int64)
    beyond = np.minimum.accumulate(np.where(points == 32, len(points), np.arange(len(points)))[::-1])[::-1]
    following = np.minimum(beyond[place + size], total)
    usable = ~np.isin(points[:total], _BLANK) & (points[:total] != _STOP)
    for k in range(1, size):
        usable &= (points[place + k] != 10) & (points[place + k] != _STOP)
    for k in range(size):
        usable &= points[place + k] == points[following + k]
    repeats, onward = np.zeros(total + 1, np.int64), following.tolist()
    for i in np.flatnonzero(usable)[::-1].tolist():
        repeats[i] = repeats[onward[i]] + 1
    found = np.flatnonzero(repeats >= times)
    owner, first = np.unique(np.searchsorted(begin, found, "right") - 1, return_index=True)
    out = np.zeros(len(texts), np.int64)
    out[owner] = repeats[found[first]]
    return out


def repetition(text: str | None, size: int = 3, times: int = 2) -> int:
    """``repetitions`` of one text."""
    return int(repetitions([text], size, times)[0])


@F.arrow_udf(IntegerType())
def repetition_score(texts: pa.Array) -> pa.Array:
    return pa.array(repetitions(texts.to_pylist()).astype(np.int32))


@F.arrow_udf(BooleanType())
def same_text(source: pa.Array, target: pa.Array) -> pa.Array:
    """Whether two texts are equal after NFC with white space collapsed; null if one is null."""
    clean = lambda t: " ".join(unicodedata.normalize("NFC", t).split())
    return pa.array([None if s is None or t is None else clean(s) == clean(t) for s, t in zip(source.to_pylist(), target.to_pylist())], pa.bool_())


#: The Unicode scripts of a script code that isn't its own name.
SCRIPTS = {
    "Latn": ("Latin",), "Cyrl": ("Cyrillic",), "Grek": ("Greek",), "Arab": ("Arabic",), "Hans": ("Han",), "Hant": ("Han",), "Hani": ("Han",),
    "Jpan": ("Han", "Hiragana", "Katakana"), "Kore": ("Hangul", "Han"), "Hang": ("Hangul", "Han"), "Thai": ("Thai",), "Laoo": ("Lao",),
    "Khmr": ("Khmer",), "Mymr": ("Myanmar",), "Deva": ("Devanagari",), "Hebr": ("Hebrew",), "Armn": ("Armenian",), "Geor": ("Georgian",),
    "Beng": ("Bengali",), "Taml": ("Tamil",), "Telu": ("Telugu",), "Ethi": ("Ethiopic",),
}


def letter_count(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[^\p{L}]", ""))


def script_share(text: Column, script: Column) -> Column:
    """Share of a text's letters that are of the script with that code; null without letters or for an unknown code."""
    # One pattern a script, looked up per row: what is no letter or of another script is left out.
    patterns = {code: r"[^\p{L}]|[^" + "".join(rf"\p{{Is{n}}}" for n in names) + "]" for code, names in SCRIPTS.items()}
    pattern = F.create_map(*[F.lit(x) for kv in patterns.items() for x in kv])[script]
    in_script = F.length(F.regexp_replace(text, pattern, F.lit("")))
    letters = letter_count(text)
    return F.when(letters > 0, in_script / letters)


def spaced_words(text: Column) -> tuple[Column, Column]:
    """Words without empty tokens, and their mean length."""
    count = F.regexp_count(text, F.lit(f"[^{SPACE}]+"))
    return count, F.length(F.regexp_replace(text, f"[{SPACE}]+", "")) / F.greatest(count, F.lit(1))


@F.arrow_udf(StructType().add("n", "integer").add("mean", "double").add("max", "double"))
def word_sizes(texts: pa.Array) -> pa.Array:
    """Number of words without empty tokens, their mean and their largest length; null counts as empty."""
    out = []
    for text in texts.to_pylist():
        sizes = [len(w) for w in (text or "").split()]
        out.append({"n": len(sizes), "mean": sum(sizes) / max(len(sizes), 1), "max": float(max(sizes, default=0))})
    return pa.array(out, pa.struct([("n", pa.int32()), ("mean", pa.float64()), ("max", pa.float64())]))
