"""Deterministic samples by hash: the same rows whatever the partitioning or the number of tasks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.values import clip, stable_uniform
from corpusloom.operators.keys import join_groups, join_table
from corpusloom.operators.prefix import row_numbers, running_sum
from corpusloom.storage import materialize

#: Rows a group up to which Spark limits a ranking before the shuffle (its windowGroupLimitThreshold).
WINDOW_ROWS = 1000
#: Bins of the weight histogram, and the length at which preference for long texts ends.
WEIGHT_BINS, LENGTH_CAP = 65_536, 512


def fraction_sample(rows: DataFrame, fraction: float, seed: int, *ids: str) -> DataFrame:
    return rows.filter(stable_uniform(seed, *[F.col(i) for i in ids]) < fraction)


def _lowest(rows: DataFrame, keys: list[str], wanted: DataFrame, u: Column, ids: list[str]) -> DataFrame:
    """Of each group the ``_take`` rows with the lowest ``u``, ties by ``ids``. ``wanted``: ``keys, _n, _take``, with the group's size.

    Rows far above the place of the last one taken are dropped where they are read: ``u`` is uniform, so the bound lies
    twelve deviations above it. Groups in which that left too few, however unlikely, keep all their rows. What remains
    is numbered over slices, so neither a large group nor a large sample of it comes to one task."""
    take = F.col("_take").cast("double")
    wanted = materialize(wanted.filter("_take > 0").withColumn("_below", (take + 12 * F.sqrt(take) + 100) / F.col("_n")), "wanted")
    near = join_table(rows.withColumn("_u", u), wanted, keys).filter(F.col("_u") < F.col("_below"))
    near = materialize(near, "near")  # a bounded multiple of the sample
    found = near.groupBy(*keys).agg(F.count("*").alias("_found"))
    short = materialize(join_groups(wanted, found, keys, "left").filter("coalesce(_found, 0) < least(_take, _n)").select(*wanted.columns), "short")
    if not short.isEmpty():
        rest = join_table(rows.withColumn("_u", u), short, keys).filter(F.col("_u") >= F.col("_below"))
        near = near.unionByName(rest)
    numbered = row_numbers(near, keys, [F.col("_u"), *[F.col(i) for i in ids]], "_place")
    return numbered.filter("_place <= _take").select(*rows.columns)


def sample_k(rows: DataFrame, keys: list[str], k: int, seed: int, *ids: str) -> DataFrame:
    """Exactly min(k, n) rows of each group, uniform without replacement.

    Up to ``WINDOW_ROWS``, Spark keeps k rows of a group and task before it shuffles. Beyond, it would bring the group
    together, and the same rows are found by ``_lowest``."""
    u, own = stable_uniform(seed, *[F.col(i) for i in ids]), [F.col(i) for i in ids]
    if k <= WINDOW_ROWS:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(u, *own))
        return rows.withColumn("_place", place).filter(F.col("_place") <= k).drop("_place")
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("_n")).withColumn("_take", F.least(F.col("_n"), F.lit(k)))
    return _lowest(rows, keys, sizes, u, list(ids))


def proportional_sizes(sizes: DataFrame, keys: list[str], stratum: str, n: str, k: int) -> DataFrame:
    """``keys, stratum, take``: round(n / total * k) of each stratum, at most its size."""
    total = sizes.groupBy(*keys).agg(F.sum(n).alias("_total"))
    take = F.least(F.col(n), F.floor(F.col(n) * k / F.col("_total") + 0.5))
    return sizes.join(total, keys).select(*keys, stratum, take.cast("bigint").alias("take"))


def proportional_sample(rows: DataFrame, keys: list[str], stratum: str, k: int, seed: int, *ids: str) -> DataFrame:
    """About k rows of each group, spread over its strata in proportion to their sizes."""
    sizes = materialize(rows.groupBy(*keys, stratum).agg(F.count("*").alias("_n")), "sizes")
    takes = proportional_sizes(sizes, keys, stratum, "_n", k).withColumnRenamed("take", "_take")
    wanted = join_groups(sizes, takes, [*keys, stratum])
    return _lowest(rows, [*keys, stratum], wanted, stable_uniform(seed, *[F.col(i) for i in ids]), list(ids))


def repeat_to(rows: DataFrame, keys: list[str], targets: DataFrame, seed: int, *ids: str) -> DataFrame:
    """Rows repeated to about ``target`` rows a group: whole copies, and the rest by chance. ``copy_no`` from 1."""
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    rates = join_groups(targets, sizes, keys).select(*keys, (F.col("target") / F.col("_n")).alias("_rate"))
    u = stable_uniform(seed, *[F.col(i) for i in ids])
    copies = F.floor(F.col("_rate")).cast("int") + (u < F.col("_rate") - F.floor("_rate")).cast("int")
    joined = join_table(rows, rates, keys).withColumn("_copies", copies).filter("_copies > 0")
    return joined.withColumn("copy_no", F.explode(F.sequence(F.lit(1), "_copies"))).drop("_rate", "_copies")


def quality_log_weight(similarity: Column, qe: Column, source_chars: Column, target_chars: Column, strength: float) -> Column:
    """Log of the sampling weight: similarity, quality and the log length of the shorter side, each in [0, 1]."""
    unit = lambda c: clip(F.coalesce(F.when(~F.isnan(c.cast("double")) & (F.abs(c) < float("inf")), c.cast("double")), F.lit(0.0)), 0.0, 1.0)
    shorter = F.least(F.coalesce(source_chars, F.lit(0)), F.coalesce(target_chars, F.lit(0))).cast("double")
    length = F.log1p(clip(shorter, 0.0, float(LENGTH_CAP))) / float(np.log1p(LENGTH_CAP))
    return strength * (unit(similarity) + unit(qe) + length)


def inclusion_scale(weights: np.ndarray, counts: np.ndarray, target: float) -> float:
    """The scale at which sum(counts * min(1, scale * weights)) is the target; infinite if the target is out of reach.

    Solved exactly on the sorted weights: those that reach 1 first are the largest.
    """
    if target >= counts.sum():
        return float("inf")
    order = np.argsort(-weights)
    w, n = weights[order], counts[order].astype(float)
    rest = (w * n)[::-1].cumsum()[::-1]  # weight not yet at 1, before step i
    full = np.concatenate([[0.0], n.cumsum()[:-1]])
    scale = np.divide(target - full, rest, out=np.full(len(w), np.inf), where=rest > 0)
    good = scale * w <= 1 + 1e-12
    return float(scale[good][0]) if good.any() else float("inf")


def weighted_probabilities(rows: DataFrame, log_weight: str, most: float, target: int) -> DataFrame:
    """``rows`` with ``probability``, proportional to exp(log_weight) but at most 1, with sum about ``target``.

    Only a histogram of fixed size reaches the driver."""
    bin_ = F.least(F.floor(F.col(log_weight) / most * WEIGHT_BINS), F.lit(WEIGHT_BINS - 1)) if most > 0 else F.lit(0)
    hist = rows.groupBy(bin_.alias("bin")).agg(F.count("*").alias("n"), F.avg(F.exp(log_weight)).alias("w")).collect()
    scale = inclusion_scale(np.array([r.w for r in hist], float), np.array([r.n for r in hist], float), target) if hist else 0.0
    return rows.withColumn("probability", F.least(F.lit(1.0), F.exp(log_weight) * scale) if np.isfinite(scale) else F.lit(1.0))


def systematic_sample(rows: DataFrame, keys: list[str], order: list[Column], probability: str, start: float = 0.5) -> DataFrame:
    """Systematic sampling: rows at which the running sum of probabilities passes start, start + 1, ..."""
    summed = running_sum(rows, keys, order, F.round(F.col(probability) * 1e9).cast("bigint"), "_sum")  # exact sums
    passed = lambda s: F.floor(s / 1e9 - start)
    before = F.col("_sum") - F.round(F.col(probability) * 1e9).cast("bigint")
    return summed.filter(passed(F.col("_sum")) > passed(before)).drop("_sum")


def shuffled(rows: DataFrame, seed: int, *ids: str) -> DataFrame:
    """All rows in an order by hash."""
    return rows.orderBy(stable_uniform(seed, *[F.col(i) for i in ids]), *ids)


def oriented(rows: DataFrame, swaps: dict[str, str], first_lang: str, second_lang: str, english: str = "eng_Latn") -> DataFrame:
    """``rows`` turned so that English, where it is on one side only, comes first; ``swaps`` names the columns to exchange."""
    turn = (F.col(second_lang) == english) & ~F.coalesce(F.col(first_lang) == english, F.lit(False))
    other = swaps | {v: k for k, v in swaps.items()} | {first_lang: second_lang, second_lang: first_lang}
    return rows.select(*[F.when(F.coalesce(turn, F.lit(False)), F.col(other[c])).otherwise(F.col(c)).alias(c) if c in other else F.col(c) for c in rows.columns])
