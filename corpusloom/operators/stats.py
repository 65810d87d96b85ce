"""Descriptive statistics by group, in forms that combine on the map side."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.values import finite
from corpusloom.operators.keys import join_groups
from corpusloom.operators.prefix import exact_quantiles, value_ranks
from corpusloom.storage import materialize

#: The quantiles of feature summaries and of score summaries.
TAILS = {"p001": 0.001, "p01": 0.01, "p05": 0.05, "median": 0.5, "p95": 0.95, "p99": 0.99, "p999": 0.999}
SCORE_QUANTILES = {"p01": 0.01, "p05": 0.05, "p10": 0.10, "p25": 0.25, "p50": 0.50, "p75": 0.75, "p90": 0.90, "p95": 0.95, "p99": 0.99}


def correlation(a: str, b: str) -> Column:
    """Pearson's correlation; null where a side doesn't vary."""
    spread = F.stddev_pop(a) * F.stddev_pop(b)
    return F.when(spread > 0, F.covar_pop(a, b) / spread)


def unpivot(rows: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    """``keys, feature, value``; values as doubles."""
    return rows.select(*keys, *[F.col(f).cast("double").alias(f) for f in features]).unpivot(keys, features, "feature", "value")


def describe(rows: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    """Per group and feature: count, missing, min, max, mean, sample deviation, and exact quantiles of ``TAILS``."""
    long = unpivot(rows, keys, features)
    by = [*keys, "feature"]
    moments = long.groupBy(*by).agg(
        F.count("value").alias("count"), F.count_if(F.col("value").isNull()).alias("missing"), F.min("value").alias("min"), F.max("value").alias("max"),
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
    )
    return join_groups(moments, exact_quantiles(long, by, "value", TAILS), by, "left")


def pooled(summary: DataFrame) -> DataFrame:
    """Moments of each feature over all groups from the groups' own: within plus between variance."""
    n, m, s = F.col("count"), F.col("mean"), F.coalesce("std", F.lit(0.0))
    sums = summary.filter("count > 0").groupBy("feature").agg(
        F.sum("count").alias("n"), F.sum("missing").alias("missing"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.sum(n * m).alias("s1"), F.sum((n - 1) * s * s + n * m * m).alias("s2"),
    )
    mean = F.col("s1") / F.col("n")
    return sums.select("feature", F.col("n").alias("count"), "missing", "min", "max", mean.alias("mean"),
                       F.when(F.col("n") > 1, F.sqrt(F.greatest((F.col("s2") - F.col("n") * mean * mean) / (F.col("n") - 1), F.lit(0.0)))).alias("std"))


def flag_rates(rows: DataFrame, keys: list[str], flags: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), *[F.avg(F.col(f).cast("int")).alias(f"{f}_rate") for f in flags])


def score_summary(rows: DataFrame, keys: list[str], score: str) -> DataFrame:
    """Per group: finite scores, mean, population deviation, min, max and quantiles of ``SCORE_QUANTILES``."""
    rows = rows.select(*keys, finite(F.col(score).cast("double")).alias("v"))
    moments = rows.groupBy(*keys).agg(
        F.count("*").alias("n_rows"), F.count("v").alias("n_scored"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max")
    )
    return join_groups(moments, exact_quantiles(rows, keys, "v", SCORE_QUANTILES), keys, "left")


def confidence_moments(rows: DataFrame, lang: str, confidence: str) -> DataFrame:
    """Per language over finite confidences clipped to [0, 1]: n, sum, sum of squares, min and max."""
    c = finite(F.col(confidence).cast("double"))
    c = F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0)))
    clean = rows.select(F.col(lang).alias("lang"), c.alias("c")).filter("c is not null and lang is not null")
    return clean.groupBy("lang").agg(F.count("*").alias("n"), F.sum("c").alias("total"), F.sum(F.col("c") * F.col("c")).alias("squares"), F.min("c").alias("min"), F.max("c").alias("max"))


def histogram(rows: DataFrame, keys: list[str], score: str, bins: int = 20) -> DataFrame:
    """Rows per bin of equal width over [0, 1], the last bin closed; null and NaN scores are left out."""
    v = F.nanvl(F.col(score).cast("double"), F.lit(None).cast("double"))
    number = F.least(F.greatest(F.floor(v * bins), F.lit(0)), F.lit(bins - 1)).cast("int")
    return rows.filter(v.isNotNull()).groupBy(*keys, number.alias("bin")).agg(F.count("*").alias("n"))


def spearman(rows: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    """Rank correlation of every two features per group, in long form; rows with a null feature are left out, and a
    feature that doesn't vary has none.

    All features are ranked in one sort of their long form. A group's ranks have a known mean, so they are centred
    before products are summed and nothing cancels.
    """
    clean = rows.select(*keys, *[F.col(f).cast("double").alias(f) for f in features]).dropna(subset=features)
    clean = materialize(clean.withColumn("_row", F.monotonically_increasing_id()), "spearman")
    long = clean.unpivot(["_row", *keys], features, "_f", "_v")
    centred = (F.col("_less") + (F.col("_equal") + 1) / 2.0 - (F.col("_all") + 1) / 2.0).alias("_c")
    ranked = value_ranks(long, [*keys, "_f"], "_v").select("_row", *keys, "_f", centred)
    wide = ranked.groupBy("_row", *keys).agg(*[F.max(F.when(F.col("_f") == f, F.col("_c"))).alias(f"_{i}") for i, f in enumerate(features)])
    pairs = list(combinations_with_replacement(range(len(features)), 2))
    sums = wide.groupBy(*keys).agg(*[F.sum(F.col(f"_{i}") * F.col(f"_{j}")).alias(f"_s{i}_{j}") for i, j in pairs])
    own = lambda i: F.col(f"_s{i}_{i}")
    found = [
        F.struct(F.lit(features[i]).alias("feature_a"), F.lit(features[j]).alias("feature_b"), F.when((own(i) > 0) & (own(j) > 0), F.col(f"_s{i}_{j}") / F.sqrt(own(i)) / F.sqrt(own(j))).alias("correlation"))
        for i, j in pairs
    ]
    return sums.select(*keys, F.explode(F.array(*found)).alias("_x")).select(*keys, "_x.*")


def agreement(rows: DataFrame, keys: list[str], a: str, b: str, within: float = 0.05, ranks: bool = False) -> DataFrame:
    """Per group: how two scores agree where both are there; ``ranks``: with their rank correlation ``spearman`` too."""
    both = rows.select(*keys, F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b")).filter("a is not null and b is not null")
    both = both.withColumn("d", F.col("a") - F.col("b"))
    moments = both.groupBy(*keys).agg(
        F.count("*").alias("n"), correlation("a", "b").alias("pearson"), F.avg("d").alias("mean_diff"), F.stddev_pop("d").alias("std_diff"),
        F.avg((F.abs("d") <= within).cast("int")).alias("share_close"),
    )
    out = join_groups(moments, exact_quantiles(both, keys, "d", {"median_diff": 0.5}), keys, "left")
    if ranks:
        pair = spearman(both, keys, ["a", "b"]).filter("feature_a = 'a' and feature_b = 'b'")
        out = join_groups(out, pair.select(*keys, F.col("correlation").alias("spearman")), keys, "left")
    return out


def share(part: Column, whole: Column) -> Column:
    """Part over whole; null where the whole is 0."""
    return F.when(whole != 0, part / whole)
