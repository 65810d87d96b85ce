"""Thresholds per group from statistics, and the filters that apply them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.keys import join_groups, join_table
from corpusloom.operators.stats import SCORE_QUANTILES

#: The widest bounds that statistics may not narrow, and on which side a feature is bounded.
SAFEGUARDS = {
    "char_len_ratio": (0.25, 4.0), "word_len_ratio": (0.25, 4.0), "score_lcs_ratio": (0.01, None), "score_levenshtein": (0.01, None),
    "src_char_len": (1.0, 2500.0), "trg_char_len": (1.0, 2500.0), "src_word_len": (1.0, 500.0), "trg_word_len": (1.0, 500.0),
    "score_numerals": (0.1, None), "score_term_punct": (0.0, None), "score_repeat_src": (None, 150.0), "score_repeat_trg": (None, 150.0),
    "src_max_word_len": (None, 150.0), "trg_max_word_len": (None, 150.0), "src_avg_word_len": (None, 50.0), "trg_avg_word_len": (None, 50.0),
}
LOWER_ONLY = ("score_numerals", "score_term_punct")
UPPER_ONLY = ("score_repeat_src", "score_repeat_trg", "src_max_word_len", "trg_max_word_len", "src_avg_word_len", "trg_avg_word_len")


def eda_bounds(summary: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, feature, lower, upper`` from a feature summary.

    The statistical bounds are the tails at 0.1 % and 99.9 % or four deviations from the mean, whichever is wider; the
    safeguards widen them further. A missing side is null: features in ``LOWER_ONLY`` have no upper bound and so on. A
    feature without a lower (upper) safeguard is widened to 0 (without limit).
    """
    f = F.col("feature")
    low, high = F.lit(0.0), F.lit(float("inf"))
    for name, (a, b) in SAFEGUARDS.items():
        low = F.when(f == name, 0.0 if a is None else a).otherwise(low)
        high = F.when(f == name, float("inf") if b is None else b).otherwise(high)
    spread = 4 * F.col("std")
    lower = F.least(F.col("p001"), F.col("mean") - spread, low)  # a null deviation is skipped
    upper = F.greatest(F.col("p999"), F.col("mean") + spread, high)
    known = F.col("count") > 0
    return summary.select(
        *keys, "feature", F.when(known & ~f.isin(*UPPER_ONLY), lower).alias("lower"), F.when(known & ~f.isin(*LOWER_ONLY), upper).alias("upper")
    )


def wide_bounds(bounds: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    """One row per group with ``<feature>_lower`` and ``<feature>_upper``."""
    pick = lambda f, c: F.max(F.when(F.col("feature") == f, F.col(c))).alias(f"{f}_{c}")
    return bounds.groupBy(*keys).agg(*[pick(f, c) for f in features for c in ("lower", "upper")])


def within_bounds(rows: DataFrame, bounds: DataFrame, keys: list[str], features: list[str], flags: list[str] = ()) -> DataFrame:
    """Rows inside all their group's bounds and without a true flag. A null feature or bound keeps the row; a group
    without bounds is dropped as a whole."""
    joined = join_table(rows, wide_bounds(bounds, keys, features).dropna(subset=keys), keys)
    keep = F.lit(True)
    for f in features:
        v, lo, hi = F.col(f), F.col(f"{f}_lower"), F.col(f"{f}_upper")
        keep = keep & (v.isNull() | lo.isNull() | (v >= lo)) & (v.isNull() | hi.isNull() | (v <= hi))
    for f in flags:
        keep = keep & ~F.coalesce(F.col(f), F.lit(False))
    return joined.filter(keep).select(*rows.columns)


# --- score thresholds -------------------------------------------------------------------------------------------------


def _knots() -> Column:
    """The summary's quantiles with its minimum and maximum, as an array of score and share below, by score."""
    points = [("min", 0.0), *SCORE_QUANTILES.items(), ("max", 1.0)]
    return F.array_sort(F.array(*[F.struct(F.col(c).alias("x"), F.lit(p).alias("p")) for c, p in points]))


def kept_fraction(threshold: Column) -> Column:
    """Share of scores at or above a threshold, by linear interpolation over the summary's quantiles."""
    knots = _knots()
    i = F.size(F.filter(knots, lambda k: k["x"] < threshold))  # knots below it
    a, b = F.get(knots, i - 1), F.get(knots, i)
    below = F.when(b["x"] == a["x"], b["p"]).otherwise(a["p"] + (b["p"] - a["p"]) * F.try_divide(threshold - a["x"], b["x"] - a["x"]))
    share = F.least(F.greatest(1.0 - below, F.lit(0.0)), F.lit(1.0))
    return F.when(F.col("min").isNull(), None).when(threshold <= F.col("min"), 1.0).when(threshold >= F.col("max"), 0.0).otherwise(share)


def threshold_keeping(fraction: float) -> Column:
    """The score at which the estimated kept share is ``fraction``: infinite for 0 or less, the minimum for 1 or more."""
    if fraction <= 0:
        return F.lit(float("inf"))
    if fraction >= 1:
        return F.col("min")
    target, knots = 1.0 - fraction, _knots()
    i = F.size(F.filter(knots, lambda k: k["p"] < target))
    a, b = F.get(knots, i - 1), F.get(knots, i)
    return F.when(b["p"] == a["p"], a["x"]).otherwise(a["x"] + (b["x"] - a["x"]) * F.try_divide(F.lit(target) - a["p"], b["p"] - a["p"]))


def gold_threshold(
    stats: DataFrame, data_quantile: str = "p10", gold_quantile: str = "gold_p01", gold_cap: str = "gold_p25", k: float = 2.0,
    low_mrr: float = 0.80, high_mrr: float = 0.95, floor: float = 0.30, cap: float = 0.95, min_keep: float = 0.0, sanity: str | None = "p50",
) -> DataFrame:
    """``stats`` with ``confidence`` and ``threshold``, anchored on gold scores where the embedding can be trusted.

    ``stats`` has a score summary and, where known, ``mrr`` and the gold scores' ``gold_mean``, ``gold_std`` and
    quantiles. Low or unknown MRR: the data's p01. Else the data's quantile, raised to the gold bound (0.02 lower in
    the middle tier). It is clipped to ``floor`` and to the cap, itself lowered to a gold quantile but not below
    ``floor``; the data's sanity quantile and ``min_keep`` then cap it, even below ``floor``.
    """
    mrr, has_gold = F.nanvl(F.col("mrr"), F.lit(None).cast("double")), F.col("gold_mean").isNotNull()
    tier = F.when(mrr.isNull(), "no_benchmark").when(mrr >= high_mrr, "high").when(mrr >= low_mrr, "mid").otherwise("low")
    gold = F.greatest(F.col(gold_quantile), F.col("gold_mean") - k * F.col("gold_std"))
    data = F.col(data_quantile)
    anchored = F.greatest(gold - F.when(tier == "mid", 0.02).otherwise(0.0), data)
    raw = F.when(tier.isin("low", "no_benchmark"), F.col("p01")).when(has_gold, anchored).otherwise(data)
    top = F.greatest(F.when(has_gold, F.least(F.lit(cap), F.col(gold_cap))).otherwise(cap), F.lit(floor))
    clipped = F.least(F.greatest(raw, F.lit(floor)), top)
    limits = [clipped, *([F.col(sanity)] if sanity else []), threshold_keeping(min_keep)]
    final = F.when(F.col(data_quantile).isNotNull(), F.least(*limits) if len(limits) > 1 else clipped)
    return stats.withColumn("confidence", tier).withColumn("raw_threshold", raw).withColumn("threshold", final)


def data_threshold(
    stats: DataFrame, data_quantile: str = "p10", floor: float = 0.30, cap: float = 0.95, min_keep: float = 0.0, sanity: str | None = "p50"
) -> DataFrame:
    """``stats`` with ``threshold`` from the data alone; ``floor`` is a hard bound, applied after all caps."""
    top = max(cap, floor)
    limits = [F.least(F.greatest(F.col(data_quantile), F.lit(floor)), F.lit(top)), threshold_keeping(min_keep)]
    limits += [F.col(sanity)] if sanity else []
    final = F.least(F.greatest(F.least(*limits), F.lit(floor)), F.lit(top))
    return stats.withColumn("threshold", F.when(F.col(data_quantile).isNotNull(), final))


def above_threshold(rows: DataFrame, thresholds: DataFrame, keys: list[str], score: str) -> DataFrame:
    """Rows whose score reaches their group's threshold. Null and NaN scores and groups without threshold are dropped."""
    s = F.col(score)
    t = thresholds.select(*keys, F.col("threshold").alias("_t"))
    return join_table(rows, t.dropna(subset=keys), keys).filter(s.isNotNull() & ~F.isnan(s) & (s >= F.col("_t"))).select(*rows.columns)


def retention(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of each group before and after a filter, and the share kept."""
    a = before.groupBy(*keys).agg(F.count("*").alias("rows_before"))
    b = after.groupBy(*keys).agg(F.count("*").alias("rows_after"))
    joined = join_groups(a, b, keys, "left").fillna(0, ["rows_after"])
    return joined.withColumn("kept_fraction", F.col("rows_after") / F.col("rows_before"))
