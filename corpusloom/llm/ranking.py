"""One ranking from scores on unlike scales.

Each score is turned so that higher is better, standardised by its model's median and median absolute deviation,
squashed by the logistic function into (0, 1), and an item's values are combined by their weighted geometric mean. A
model's scale, offset and outliers cancel; how much it counts is its weight alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.cutoff import kth_value
from corpusloom.operators.prefix import value_ranks
from corpusloom.storage import materialize

#: Makes the median absolute deviation of a normal distribution its standard deviation.
NORMAL = 1.4826


def _lower_median(rows: DataFrame, group: str, value: str) -> DataFrame:
    """The median of each group; of an even number of values the lower of the middle two."""
    ranks = rows.groupBy(group).agg(F.expr("count(*) div 2 + 1").alias("k"))
    return kth_value(rows, group, value, ranks).select(group, F.col("cutoff"))


def robust_scales(scores: DataFrame, model: str, value: str) -> DataFrame:
    """``model, middle, spread`` of each model. Where more than half of the values are equal the deviation's median is
    0; the mean absolute deviation stands in for it, and where that is 0 too the spread is null."""
    middle = materialize(_lower_median(scores, model, value).withColumnRenamed("cutoff", "middle"), "middle")
    away = materialize(scores.join(middle, model).select(model, F.abs(F.col(value) - F.col("middle")).alias("d")), "deviation")
    mean = away.groupBy(model).agg(F.avg("d").alias("mean"))
    mad = _lower_median(away, model, "d").withColumnRenamed("cutoff", "mad")
    spread = F.when(F.col("mad") > 0, F.col("mad") * NORMAL).when(F.col("mean") > 0, F.col("mean") * 1.2533)
    return materialize(middle.join(mad, model).join(mean, model).select(model, "middle", spread.alias("spread")), "scales")


def combined_ranking(scores: DataFrame, item: str, model: str, score: str, weights: dict[str, float] | None = None) -> DataFrame:
    """``item, n_models, combined, rank`` of every item with a score.

    ``scores`` has one row per item and model with ``score`` and ``higher_is_better``. ``combined`` is rounded to nine
    places and ``rank`` is 1 + the number of items with a greater one, so ties share a rank. An item that some models
    didn't score is judged by the others. ``weights`` default to 1; models of weight 0 or less don't count. Null and
    NaN scores are no scores; of a model without spread every score is 0.5.
    """
    value = F.nanvl(F.col(score), F.lit(None).cast("double")) * F.when(F.col("higher_is_better"), 1.0).otherwise(-1.0)
    rows = materialize(scores.select(F.col(item).alias("item"), F.col(model).alias("m"), value.alias("v")).filter("v is not null and m is not null"), "ranking")
    z = F.coalesce((F.col("v") - F.col("middle")) / F.col("spread"), F.lit(0.0))
    log_p = -F.log1p(F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))
    weight = F.lit(1.0)
    for name, w in (weights or {}).items():
        weight = F.when(F.col("m") == name, float(w)).otherwise(weight)
    squashed = rows.join(robust_scales(rows, "m", "v"), "m").select("item", log_p.alias("p"), weight.alias("w")).filter("w > 0")
    mean = squashed.groupBy("item").agg(F.count("*").alias("n_models"), F.round(F.exp(F.sum(F.col("p") * F.col("w")) / F.sum("w")), 9).alias("combined"))
    return with_rank(materialize(mean, "combined"), "combined").withColumnRenamed("item", item)


def with_rank(rows: DataFrame, score: str) -> DataFrame:
    """``rows`` with ``rank``: 1 + the number of rows with a greater score, so ties share the smallest; rows without a
    score are left out. Ranks come from range slices, so a score that most rows share is spread over the cluster."""
    ranked = value_ranks(rows, [], score)
    return ranked.select(*rows.columns, (F.col("_all") - F.col("_less") - F.col("_equal") + 1).alias("rank"))
