"""Corpus metrics of translations from n-gram counts that add up: BLEU and chrF++."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDER, CHAR_ORDER, WORD_ORDER, BETA = 4, 6, 2, 2.0
_TOKEN = regex.compile(r"\p{N}+(?:[.,]\p{N}+)*|[\p{L}\p{M}]+|[^\s\p{L}\p{M}\p{N}]")


def ngrams(items, n: int) -> Counter:
    return Counter(tuple(items[i : i + n]) for i in range(len(items) - n + 1))


def match_counts(hypothesis: str, reference: str) -> list[int]:
    """For words (1 to 4) and then characters (1 to 6): matches, n-grams of the hypothesis, n-grams of the reference;
    before them the lengths of both in words."""
    h, r = _TOKEN.findall(hypothesis), _TOKEN.findall(reference)
    out = [len(h), len(r)]
    for a, b, orders in ((h, r, ORDER), ("".join(hypothesis.split()), "".join(reference.split()), CHAR_ORDER)):
        for n in range(1, orders + 1):
            x, y = ngrams(a, n), ngrams(b, n)
            out += [sum((x & y).values()), max(len(a) - n + 1, 0), max(len(b) - n + 1, 0)]
    return out


COUNTS = 2 + 3 * (ORDER + CHAR_ORDER)


def bleu(counts: np.ndarray) -> float:
    """Corpus BLEU in [0, 100]; orders without a match are smoothed by halving."""
    if counts[0] == 0 or counts[1] == 0:
        return 0.0
    logs, smooth = 0.0, 1.0
    for n in range(ORDER):
        hit, total = counts[2 + 3 * n], counts[3 + 3 * n]
        if total == 0:
            return 0.0
        if hit == 0:
            smooth *= 2
            hit = 1 / smooth
        logs += math.log(hit / total)
    return 100 * min(1.0, math.exp(1 - counts[1] / counts[0])) * math.exp(logs / ORDER)


def chrf(counts: np.ndarray) -> float:
    """chrF++ in [0, 100]: the mean F2 over 6 character orders and 2 word orders that the reference has."""
    scores = []
    for base, orders in ((2 + 3 * ORDER, CHAR_ORDER), (2, WORD_ORDER)):
        for n in range(orders):
            hit, h, r = counts[base + 3 * n : base + 3 * n + 3]
            if r == 0:
                continue
            p, q = (hit / h if h else 0.0), hit / r
            scores.append((1 + BETA**2) * p * q / (BETA**2 * p + q) if p + q else 0.0)
    return 100 * float(np.mean(scores)) if scores else 0.0


def corpus_metrics(rows: DataFrame, keys: list[str], hypothesis: str, reference: str) -> DataFrame:
    """``keys, n, bleu, chrf`` per group. Counts are taken row by row, added up on the map side, and only the sums make
    a score. A null text counts as empty."""

    @F.arrow_udf("array<bigint>")
    def count(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([match_counts(x or "", y or "") for x, y in zip(a.to_pylist(), b.to_pylist())], pa.list_(pa.int64()))

    @F.arrow_udf("struct<bleu double, chrf double>")
    def score(sums: pa.Array) -> pa.Array:
        arrays = [np.array(s, float) for s in sums.to_pylist()]
        return pa.array([{"bleu": bleu(s), "chrf": chrf(s)} for s in arrays], pa.struct([("bleu", pa.float64()), ("chrf", pa.float64())]))

    counted = rows.select(*keys, count(F.col(hypothesis), F.col(reference)).alias("c"))
    sums: list[Column] = [F.sum(F.get("c", F.lit(i))).alias(f"s{i}") for i in range(COUNTS)]
    total = counted.groupBy(*keys).agg(F.count("*").alias("n"), *sums)
    return total.select(*keys, "n", score(F.array(*[f"s{i}" for i in range(COUNTS)])).alias("m")).select(*keys, "n", "m.bleu", "m.chrf")
