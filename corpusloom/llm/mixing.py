"""Mixing sources to target weights by Poisson replication.

A source's wanted rate is its target amount over its size; no source may be used more than ``max_repeat`` times. Each
record draws from a hash of its id and the source's plan a uniform number, and its number of copies is the inverse at
that number of a Poisson distribution cut off at the cap; the distribution's mean is solved for so that the expected
number of copies is the rate, and a source at its cap has that many copies of each record. Copies are drawn without
any exchange of data: the plan is small and joined to the records, and only its sums are shuffled.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructType

from corpusloom.llm.tokens import current_plan
from corpusloom.storage import materialize

KEYS = ["dataset", "target_pair", "source_pair"]


def _below(mean: float, cap: int) -> tuple[int, np.ndarray]:
    """P(copies <= i) of a Poisson distribution with that mean, for i = first .. cap - 1: ``first`` and the values, up to
    where they are 1. Below ``first`` they are 0 to the last digit. Terms are computed in logarithms around the mean, so
    neither a large mean nor a large cap costs more than their spread."""
    reach = 45.0 * math.sqrt(mean) + 60.0
    first, last = max(0, math.floor(mean - reach)), min(cap, math.ceil(mean + reach))
    if first >= last:
        return cap, np.zeros(0)
    i = np.arange(first, last, dtype=float)
    logs = -mean + first * math.log(mean) - math.lgamma(first + 1) + np.concatenate([[0.0], np.cumsum(math.log(mean) - np.log(i[1:]))])
    return first, np.minimum(np.cumsum(np.exp(logs)), 1.0)


def replication(rate: float, cap: int) -> tuple[int, list[float]]:
    """``first`` and P(copies <= i) for i = first, first + 1, .. of min(Poisson, cap) with mean ``rate``. A record with
    uniform number u has ``first`` copies and one more for each value up to u. A rate at the cap or above it gives
    ``cap`` copies of everything, one of 0 or less none."""
    if rate <= 0 or cap <= 0:
        return 0, []
    if rate >= cap:
        return cap, []

    def mean_of(m: float) -> float:
        first, below = _below(m, cap)
        return first + float((1.0 - below).sum())

    low, high = 0.0, 2.0 * cap + 800.0  # there the cut-off distribution's mean is the cap to the last digit
    for _ in range(200):
        middle = (low + high) / 2
        if middle in (low, high):
            break
        low, high = (middle, high) if mean_of(middle) < rate else (low, middle)
    first, below = _below(high, cap)
    kept = below[below < 1.0]
    return first, kept.tolist()


def truncated_cdf(rate: float, cap: int) -> list[float]:
    """P(copies <= i) for i = 0 .. cap - 1, of min(Poisson, cap) with mean ``rate``."""
    first, below = replication(rate, cap)
    return [*[0.0] * first, *below, *[1.0] * (cap - first - len(below))]


@F.pandas_udf(StructType().add("first", IntegerType()).add("below", ArrayType(DoubleType())))
def _copies(rate: pd.Series, cap: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([replication(r, int(c)) for r, c in zip(rate, cap)], columns=["first", "below"])


def mixing_plan(source_plan: DataFrame, pair_plan: DataFrame) -> DataFrame:
    """One row per current source of ``source_plan`` whose dataset and target pair ``pair_plan`` has:
    ``total_tokens, alloc_tokens, quota, max_repeat, planned_share, planned_tokens, rate, falls_short``.

    ``planned_share`` is the source's part of its target's allocations (null if they sum to 0), ``planned_tokens`` that
    part of the quota, or the allocation itself where it is less. ``rate`` is the planned amount over the total, at
    most ``max_repeat``, and 0 for a source without tokens. ``falls_short``: the allocation is greater than
    ``max_repeat`` times the total. Amounts that are null or negative are 0; so are a null quota and repeat. Of several
    rows of one target in ``pair_plan`` the one with the largest quota counts.
    """
    zero = lambda c: F.greatest(F.coalesce(F.col(c), F.lit(0)), F.lit(0)).cast("bigint").alias(c)
    target = pair_plan.groupBy("dataset", "target_pair").agg(F.max(F.struct("quota", "max_repeat")).alias("r")).select("dataset", "target_pair", "r.*")
    target = target.select("dataset", "target_pair", zero("quota"), zero("max_repeat"))
    plan = current_plan(source_plan).join(target, ["dataset", "target_pair"])
    sums = plan.groupBy("dataset", "target_pair").agg(F.sum("alloc_tokens").alias("all_tokens"))
    share = F.when(F.col("all_tokens") > 0, F.col("alloc_tokens") / F.col("all_tokens"))
    wanted = F.coalesce(F.least(share * F.col("quota"), F.col("alloc_tokens").cast("double")), F.lit(0.0))
    rate = F.when(F.col("total_tokens") > 0, F.least(F.col("planned_tokens") / F.col("total_tokens"), F.col("max_repeat").cast("double"))).otherwise(0.0)
    return (
        plan.join(sums, ["dataset", "target_pair"])
        .withColumn("planned_share", share).withColumn("planned_tokens", wanted).withColumn("rate", rate)
        .withColumn("falls_short", F.col("alloc_tokens") > F.col("max_repeat") * F.col("total_tokens"))
        .drop("all_tokens")
    )


def uniform(seed: int, *columns: Column) -> Column:
    """A number in [0, 1) by hash."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11) / F.lit(float(2**53))


def replicate(records: DataFrame, plan: DataFrame, seed: int = 0) -> DataFrame:
    """Each record with each source of the plan that uses it: the keys, ``record_id, size, copies`` (0 included).

    ``records`` has ``source_pair, record_id, size``; null sizes count 0, records of no source are left out."""
    chances = materialize(plan.select(*KEYS, _copies("rate", "max_repeat").alias("c")).select(*KEYS, "c.first", "c.below"), "mix-plan")
    u = uniform(seed, *[F.col(k) for k in KEYS], F.col("record_id"))
    joined = records.select("source_pair", "record_id", "size").join(chances, "source_pair").withColumn("u", u)
    return joined.select(*KEYS, "record_id", F.coalesce("size", F.lit(0)).alias("size"), (F.col("first") + F.size(F.filter("below", lambda c: c <= F.col("u")))).alias("copies"))


def mixing_report(records: DataFrame, plan: DataFrame, seed: int = 0) -> DataFrame:
    """The plan with what the mixture came to: ``actual_records`` and ``actual_tokens`` drawn, with copies, and
    ``actual_share`` within the dataset and target pair (null where nothing was drawn)."""
    drawn = replicate(records, plan, seed).groupBy(*KEYS).agg(F.sum("copies").alias("actual_records"), F.sum(F.col("size") * F.col("copies")).alias("actual_tokens"))
    drawn = materialize(drawn, "mix-drawn")
    full = plan.join(drawn, KEYS, "left").fillna(0, ["actual_records", "actual_tokens"])
    sums = full.groupBy("dataset", "target_pair").agg(F.sum("actual_tokens").alias("all_tokens"))
    share = F.when(F.col("all_tokens") > 0, F.col("actual_tokens") / F.col("all_tokens"))
    return materialize(full.join(sums, ["dataset", "target_pair"]).withColumn("actual_share", share).drop("all_tokens"), "mix-report")


def mixture(records: DataFrame, plan: DataFrame, seed: int = 0) -> DataFrame:
    """The mixed records, one row per copy (``copy_no`` from 1), in an order shuffled over all of them."""
    copies = replicate(records, plan, seed).filter("copies > 0").withColumn("copy_no", F.explode(F.sequence(F.lit(1), "copies"))).drop("copies")
    place = F.xxhash64(F.lit(seed + 1), *[F.col(k) for k in KEYS], "record_id", "copy_no")
    return copies.withColumn("_place", place).repartitionByRange("_place").sortWithinPartitions("_place").drop("_place")
