"""Scalar helpers: numbers, codes, prompts and model replies."""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType

from corpusloom.functions.text import SPACE, strip

#: Spellings of a true flag and of a false one.
TRUTHY = ("true", "t", "1", "yes", "y", "supported", "covered")
FALSY = ("false", "f", "0", "no", "n", "unsupported", "uncovered")
#: Rescaling of metrics to [0, 1].
METRICX_WORST, LLM_BEST = 25.0, 100.0


def finite(value: Column) -> Column:
    """The value, or null where it is NaN or infinite."""
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


def truth(text: Column) -> Column:
    """True or false by spelling; null for anything else, which means unknown."""
    t = F.lower(strip(text))
    return F.when(t.isin(*TRUTHY), True).when(t.isin(*FALSY), False)


def clip(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def score_bin(score: Column, bins: int) -> Column:
    """Bin of a score clipped to [0, 1]; the last bin is closed."""
    return F.least(F.floor(clip(score, 0.0, 1.0) * bins), F.lit(bins - 1)).cast("int")


def metricx_to_unit(score: Column) -> Column:
    return 1.0 - score / METRICX_WORST


def llm_to_unit(score: Column) -> Column:
    return score / LLM_BEST


def input_token_estimate(text: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(text) / 3)).cast("bigint")


def output_token_estimate(batch: Column) -> Column:
    return (60 + 20 * batch).cast("bigint")


def seconds_of(time: Column) -> Column:
    """Seconds of ``HH:MM:SS``; null for other forms."""
    part = F.split(time, ":")
    value = part[0].try_cast("int") * 3600 + part[1].try_cast("int") * 60 + part[2].try_cast("int")
    return F.when(time.rlike(r"^\d+:\d+:\d+$"), value)


def safe_name(model: Column) -> Column:
    """The last part of a model's path in letters, digits, dots, hyphens and single underscores; ``model`` if none is left."""
    last = F.substring_index(strip(model), "/", -1)
    token = F.regexp_replace(F.regexp_replace(F.regexp_replace(last, r"[^0-9A-Za-z_.-]", "_"), "_+", "_"), "^[._-]+|[._-]+$", "")
    return F.when(token == "", "model").otherwise(token)


def trimmed_error(error: Column, most: int = 1000, head: int = 650) -> Column:
    """An error text of at most ``most`` characters: its head, an ellipsis on a line, its tail; null if empty."""
    tail = most - head - 5
    short = F.concat(F.regexp_replace(F.substring(error, 1, head), r"\s+$", ""), F.lit("\n...\n"), F.regexp_replace(F.right(error, F.lit(tail)), r"^\s+", ""))
    return F.when(F.length(error) > most, short).otherwise(F.nullif(error, F.lit("")))


def truncated(text: Column, limit: int) -> Column:
    """At most ``limit`` characters on one line, the last an ellipsis if something was cut."""
    line = strip(F.regexp_replace(text, r"[\r\n]+", " "))
    return F.when(F.length(line) <= limit, line).otherwise(F.concat(strip(F.substring(line, 1, limit - 1)), F.lit("…")))


def clean_prediction(text: Column, labels: list[str]) -> Column:
    """The first line of a model's output without leading ``label:`` marks, in any case."""
    line = strip(F.regexp_extract(F.regexp_replace(text, f"^[{SPACE}]+", ""), r"^([^\r\n]*)", 1))
    for label in labels:
        quoted = "".join(c if c.isalnum() or c == "_" else rf"\x{{{ord(c):x}}}" for c in label)
        line = F.regexp_replace(line, rf"(?i)^\s*{quoted}\s*:\s*", "")
    return strip(line)


def reply_scores(reply: Column, expected: int, out_of_range: str = "clip") -> Column:
    """Scores in [0, 1] of items 0 .. expected - 1 from a model's JSON reply, null where the reply has none.

    Thoughts, code fences and text around the outermost braces are dropped; a reply that isn't JSON gives nulls only.
    Of several results of one item the last counts. ``out_of_range``: ``clip`` or ``null``.
    """
    text = F.regexp_replace(reply, r"(?s)<think>.*?</think>", "")
    text = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    results = F.from_json(text, "struct<results array<struct<id int, overall_0to100 double>>>")["results"]
    def one(i: int) -> Column:
        value = F.try_element_at(F.filter(results, lambda r: r["id"] == i), F.lit(-1))["overall_0to100"] / 100
        return clip(value, 0.0, 1.0) if out_of_range == "clip" else F.when(value.between(0, 1), value)

    # greatest and least skip nulls, so a missing score is kept apart.
    def kept(i: int) -> Column:
        there = F.exists(F.coalesce(results, F.array()), lambda r: (r["id"] == i) & r["overall_0to100"].isNotNull())
        return F.when(there, one(i)).cast("double")

    return F.array(*[kept(i) for i in range(expected)])


# --- hashes -----------------------------------------------------------------------------------------------------------


def stable_uniform(seed: int, *columns: Column) -> Column:
    """A number in [0, 1) by hash, in the JVM."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11) / F.lit(float(2**53))


#: SplitMix64's increment, its shifts and multipliers, and its last shift.
SPLITMIX_STEP, SPLITMIX_ROUNDS, SPLITMIX_END = 0x9E3779B97F4A7C15, ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)), 31


def splitmix_uniform_np(offsets: np.ndarray, salt: int) -> np.ndarray:
    """Uniform numbers in [0, 1) of 53 bits: SplitMix64's output at ``salt`` plus each offset, modulo 2**64."""
    word = np.asarray(offsets).astype(np.uint64)
    fold = lambda w, by: np.bitwise_xor(w, np.right_shift(w, np.uint64(by)))
    with np.errstate(over="ignore"):
        word = word + np.uint64((salt + SPLITMIX_STEP) % 2**64)
        for by, factor in SPLITMIX_ROUNDS:
            word = fold(word, by) * np.uint64(factor)
    return np.ldexp(np.right_shift(fold(word, SPLITMIX_END), np.uint64(11)).astype(np.float64), -53)


@cache
def shard_salt(seed: int, pair: str, shard: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{seed}:{pair}:{shard}".encode(), digest_size=8).digest(), "little")


@F.arrow_udf(DoubleType())
def splitmix_uniform(seed: pa.Array, pair: pa.Array, shard: pa.Array, offset: pa.Array) -> pa.Array:
    """Row uniforms that depend on the seed, the pair, its shard and the row's offset there only."""
    salts = np.array([shard_salt(*key) for key in zip(seed.to_pylist(), pair.to_pylist(), shard.to_pylist())], np.uint64)
    offsets = offset.to_numpy(zero_copy_only=False).astype(np.uint64)
    with np.errstate(over="ignore"):
        return pa.array(splitmix_uniform_np(offsets + salts, 0))


def blake2b_int(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=16).digest(), "big")


@F.arrow_udf(LongType())
def blake2b_shard(key: pa.Array, shards: pa.Array) -> pa.Array:
    """Shard of a key: its 128-bit BLAKE2b digest modulo the number of shards; null for a null key."""
    return pa.array([None if k is None else blake2b_int(k) % n for k, n in zip(key.to_pylist(), shards.to_pylist())], pa.int64())


def fnv1a(data: bytes) -> int:
    """32-bit FNV-1a with sign-extended bytes, as fastText's hash."""
    h = 2166136261
    for b in data:
        h = ((h ^ (b if b < 128 else b | 0xFFFFFF00)) * 16777619) & 0xFFFFFFFF
    return h


def subword_buckets(word: str, shortest: int, longest: int, buckets: int) -> list[int]:
    """Hash buckets of a word's character n-grams, the word set in angle brackets; single marks at its ends left out."""
    padded = f"<{word}>"
    out = []
    for i in range(len(padded)):
        for n in range(1, longest + 1):
            if i + n > len(padded):
                break
            if n >= shortest and not (n == 1 and (i == 0 or i + n == len(padded))):
                out.append(fnv1a(padded[i : i + n].encode()) % buckets)
    return out


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two float arrays with norms kept from 0, clipped to [-1, 1]; stays in the JVM."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x)) + 1e-9
    return clip(dot / (norm(a) * norm(b)), -1.0, 1.0)


@F.arrow_udf(ArrayType(LongType()))
def subword_ids(words: pa.Array, shortest: pa.Array, longest: pa.Array, buckets: pa.Array) -> pa.Array:
    """``subword_buckets`` of a column; null for a null word."""
    given = zip(words.to_pylist(), shortest.to_pylist(), longest.to_pylist(), buckets.to_pylist())
    return pa.array([None if w is None else subword_buckets(w, a, b, n) for w, a, b, n in given], pa.list_(pa.int64()))


def pair_checker(source_lang: Column, target_lang: Column, own: list[str]) -> Column:
    """Name of the classifier for a direction: ``full-<root>`` from English into a root that has its own, ``full-en-xx``
    for any other pair with English, ``none`` without it or without a code."""
    root = lambda c: F.split_part(c, F.lit("_"), F.lit(1))
    special = (source_lang == "eng_Latn") & root(target_lang).isin(*own)
    english = (root(source_lang) == "eng") | (root(target_lang) == "eng")
    return F.when(special, F.concat(F.lit("full-"), root(target_lang))).when(english, "full-en-xx").otherwise("none")
