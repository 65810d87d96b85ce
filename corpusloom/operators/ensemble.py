"""Scores of several models: normalisation, ensembles, weights and coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.values import truth
from corpusloom.operators.keys import join_groups, join_table
from corpusloom.operators.prefix import percent_ranks

VARIANTS = ("both_seen", "src_seen", "tgt_seen", "both_unseen")


def normalised(scores: DataFrame, model: str, score: str) -> DataFrame:
    """``scores`` with ``z_score`` and ``percent_rank`` within the model. A null score counts as 0 before it; a model
    without deviation has a null z-score. Moments are aggregated and joined back."""
    filled = scores.withColumn(score, F.coalesce(F.nanvl(score, F.lit(0.0)), F.lit(0.0)))
    moments = filled.groupBy(model).agg(F.avg(score).alias("_mean"), F.stddev_samp(score).alias("_std"))
    z = (F.col(score) - F.col("_mean")) / F.nullif(F.col("_std"), F.lit(0.0))
    return percent_ranks(join_table(filled, moments, [model]).withColumn("z_score", z).drop("_mean", "_std"), [model], score)


def direction_summary(scores: DataFrame, model: str, direction: str, score: str) -> DataFrame:
    """Rows, scored rows, mean and seen flags of each model and direction; NaN is no score."""
    v = F.nanvl(F.col(score), F.lit(None).cast("double"))
    return scores.groupBy(model, direction).agg(
        F.count("*").alias("n_rows"), F.count(v).alias("n_scored"), F.avg(v).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"),
        F.bool_or(truth(F.col("qe_src_seen"))).alias("src_seen"), F.bool_or(truth(F.col("qe_tgt_seen"))).alias("tgt_seen"),
    )


def wide(scores: DataFrame, keys: list[str], model: str, score: str, models: list[str]) -> DataFrame:
    """One row per item with ``<model>_score`` and ``<model>_both_seen`` (1 or 0) for each listed model."""
    aggs: list[Column] = []
    for m in models:
        here = F.col(model) == m
        both = (F.coalesce(truth(F.col("qe_src_seen")), F.lit(False)) & F.coalesce(truth(F.col("qe_tgt_seen")), F.lit(False))).cast("int")
        name = m.replace("-", "_").replace(".", "_")
        aggs += [F.max(F.when(here, F.col(score))).alias(f"{name}_score"), F.max(F.when(here, both)).alias(f"{name}_both_seen")]
    return scores.groupBy(*keys).agg(*aggs)


def mean_median(scores: DataFrame, keys: list[str], score: str) -> DataFrame:
    """Mean and median over an item's models, over all of them and over those that saw both languages; nulls skipped.

    Computed in long form: an item has one value a model, so its group is small.
    """
    both = F.coalesce(truth(F.col("qe_src_seen")) & truth(F.col("qe_tgt_seen")), F.lit(False))
    seen = F.when(both, F.col(score))
    return scores.groupBy(*keys).agg(
        F.count(score).alias("n_models"), F.avg(score).alias("ens_mean_all"), F.median(score).alias("ens_median_all"),
        F.count(seen).alias("n_models_seen"), F.avg(seen).alias("ens_mean_seen"), F.median(seen).alias("ens_median_seen"),
    )


def model_weights(summary: DataFrame, model: str, mean: str = "mean") -> DataFrame:
    """Macro average of each model's direction means, and its share of their sum."""
    macro = summary.groupBy(model).agg(F.avg(mean).alias("macro_mean"))
    total = macro.agg(F.sum("macro_mean").alias("_total"))  # one row
    return macro.crossJoin(F.broadcast(total)).select(model, "macro_mean", (F.col("macro_mean") / F.nullif(F.col("_total"), F.lit(0.0))).alias("weight"))


def weighted(scores: DataFrame, summary: DataFrame, weights: DataFrame, keys: list[str], model: str, direction: str, score: str, n_models: int) -> DataFrame:
    """Weighted means per item: over all models (null unless all ``n_models`` scored it) and over those that saw both
    languages (by row), the source, the target, or neither (by direction).

    A variant is null if no model is eligible, and if an eligible model has no score. Long form keeps the plan small
    whatever the number of models.
    """
    flags = summary.select(model, direction, F.coalesce(F.col("src_seen"), F.lit(False)).alias("_s"), F.coalesce(F.col("tgt_seen"), F.lit(False)).alias("_t"))
    both = F.coalesce(truth(F.col("qe_src_seen")) & truth(F.col("qe_tgt_seen")), F.lit(False))
    joined = join_groups(scores.join(weights.select(model, "weight"), model), flags, [model, direction], "left")
    eligible = {"both_seen": both, "src_seen": F.col("_s"), "tgt_seen": F.col("_t"), "both_unseen": ~F.col("_s") & ~F.col("_t")}
    product = F.col("weight") * F.col(score)
    out = [F.when(F.count(score) == n_models, F.sum(product)).alias("ens_wavg_all")]
    for name, flag in eligible.items():
        complete = F.count_if(flag) == F.count(F.when(flag, F.col(score)))
        mean = F.sum(F.when(flag, product)) / F.nullif(F.sum(F.when(flag, F.col("weight"))), F.lit(0.0))
        out += [F.when(complete, mean).alias(f"ens_wavg_{name}"), F.count_if(flag).alias(f"n_{name}")]
    return joined.groupBy(*keys).agg(*out)


def tau_name(tau: float) -> str:
    return "tau_" + f"{tau:.12g}".replace("-", "neg_").replace(".", "_")


def per_direction(rows: DataFrame, keys: list[str], taus: list[float]) -> DataFrame:
    """Rows of scores brought down to one per ``keys``, model and direction: rows, scored rows, and rows at or above
    each threshold. All that follows counts on this small table."""
    s = F.col("qe_score")
    held = [F.count_if(~F.isnan(s) & (s >= tau)).alias(tau_name(tau)) for tau in taus]
    return rows.groupBy(*keys, "qe_model", "direction_key", "src_lang", "tgt_lang").agg(F.count("*").alias("n"), F.count(s).alias("n_scored"), *held)


def scale(counted: DataFrame, by: list[str], taus: list[float]) -> DataFrame:
    """Distinct models, directions and languages, rows, null scores, and retention in rows and per cent to four places."""
    total = F.coalesce(F.sum("n"), F.lit(0))
    scored = F.coalesce(F.sum("n_scored"), F.lit(0))
    out = [
        F.count_distinct("qe_model").alias("models_scored"), F.count_distinct("direction_key").alias("directions_scored"),
        F.count_distinct("qe_model", "direction_key").alias("model_direction_pairs_scored"), total.alias("sentence_pairs_scored"),
        F.count_distinct("src_lang").alias("source_langs"), F.count_distinct("tgt_lang").alias("target_langs"),
        scored.alias("non_null_scores"), (total - scored).alias("null_scores"),
    ]
    for tau in taus:
        n = F.coalesce(F.sum(tau_name(tau)), F.lit(0))
        out += [n.alias(f"retained_{tau_name(tau)}"), F.round(100.0 * n / F.nullif(total, F.lit(0)), 4).alias(f"retained_{tau_name(tau)}_pct")]
    return counted.groupBy(*by).agg(*out)


def coverage(source: Column, target: Column) -> Column:
    s, t = F.coalesce(source, F.lit(False)), F.coalesce(target, F.lit(False))
    return F.when(s & t, "both-covered").when(s | t, "one-covered").otherwise("both-uncovered")


def english_centric(source: Column, target: Column) -> Column:
    english = lambda c: F.lower(F.split_part(c, F.lit("_"), F.lit(1))).isin("eng", "en")
    return F.when(english(source) | english(target), "english-centric").otherwise("non-english-centric")


def by_category(rows: DataFrame, category: str, names: list[str], taus: list[float]) -> DataFrame:
    """Scale and retention of each listed category in its order; one without rows appears with zeros."""
    listed = rows.sparkSession.createDataFrame([(n, i) for i, n in enumerate(names, 1)], f"{category} string, sort_order int")
    counted = per_direction(rows, [category], taus)
    return scale(listed.join(counted, category, "left"), [category, "sort_order"], taus)
