"""Language re-identification by two models that must agree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.keys import join_groups
from corpusloom.operators.prefix import exact_quantiles
from corpusloom.storage import broadcast_if_small, materialize


def confidence_thresholds(predictions: DataFrame, keys: list[str], confidence: str) -> DataFrame:
    """Per model and language: median less sample deviation of the confidences, kept between 0.3 and 0.9."""
    moments = predictions.filter(F.col(confidence).isNotNull()).groupBy(*keys).agg(F.count("*").alias("n"), F.coalesce(F.stddev_samp(confidence), F.lit(0.0)).alias("std"))
    both = join_groups(moments, exact_quantiles(predictions, keys, confidence, {"median": 0.5}), keys)
    return both.withColumn("threshold", F.greatest(F.lit(0.3), F.least(F.lit(0.9), F.col("median") - F.col("std"))))


def agreed_language(rows: DataFrame, thresholds: DataFrame, original: str, models: dict[str, tuple[str, str]], out: str) -> DataFrame:
    """``rows`` with ``out``: the language both models predict above their thresholds, else the original one.

    ``models`` maps a model to its columns of prediction and confidence; ``thresholds`` has ``model, lang, threshold``.
    A confidence must exceed its threshold; a language without one is never accepted.
    """
    valid, first = F.lit(True), None
    for i, (model, (label, confidence)) in enumerate(models.items()):
        t = thresholds.filter(F.col("model") == model).select(F.col("lang").alias(f"_l{i}"), F.col("threshold").alias(f"_t{i}"))
        rows = rows.join(broadcast_if_small(materialize(t, "lid")), F.col(label) == F.col(f"_l{i}"), "left").drop(f"_l{i}")  # one row a label
        first = label if first is None else first
        valid = valid & (F.col(confidence) > F.coalesce(F.col(f"_t{i}"), F.lit(float("inf")))) & (F.col(label) == F.col(first))
    decided = F.when(F.coalesce(valid, F.lit(False)), F.col(first)).otherwise(F.col(original))
    return rows.withColumn(out, decided).drop(*[f"_t{i}" for i in range(len(models))])


def agreeing(rows: DataFrame, sides: list[tuple[str, str, str]], least: float) -> DataFrame:
    """Rows of which each side's declared language is the predicted one with at least that confidence."""
    for declared, predicted, confidence in sides:
        rows = rows.filter((F.col(declared) == F.col(predicted)) & (F.col(confidence) >= least))
    return rows


def route_small(rows: DataFrame, pair: str, least: int, out: str = "route") -> DataFrame:
    """``rows`` with the pair, or ``_mixed`` for pairs of fewer than ``least`` rows; counted by aggregation, not window."""
    small = rows.groupBy(pair).agg(F.count("*").alias("_n")).select(F.col(pair).alias("_p"), (F.col("_n") < least).alias("_small"))
    joined = rows.join(small, F.col(pair).eqNullSafe(F.col("_p")))
    return joined.withColumn(out, F.when(F.col("_small"), "_mixed").otherwise(F.col(pair))).drop("_p", "_small")
