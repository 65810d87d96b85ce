"""The current valid score of each pair and model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.storage import materialize


#: Fixed value: Unicode white space.
SPACES = "\t\n\v\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def model_key(name: Column) -> Column:
    return F.lower(F.btrim(name, F.lit(SPACES)))


def current_scores(scored: DataFrame, models: DataFrame, only: str | None = None) -> DataFrame:
    """``pair_id, qe_model, qe_score, higher_is_better`` of every current valid score.

    The current score of a pair and model is that of the latest ``scored_at``, even where that run failed. It is valid
    if it is a finite number within the model's bounds. Of several scores of one time the largest counts, a failed one
    least. Rows without a pair or of a model that ``models`` doesn't name are no records; ``models`` gives the
    spelling. ``only`` restricts to one model.
    """
    known = models.select(model_key(F.col("qe_model")).alias("m"), "qe_model", "higher_is_better", "min_score", "max_score").dropDuplicates(["m"])
    known = materialize(known.withColumn("k", F.monotonically_increasing_id()), "models")  # one row a model
    rows = scored.select("pair_id", model_key(F.col("qe_model")).alias("m"), "scored_at", F.nanvl("qe_score", F.lit(None).cast("double")).alias("s"))
    if only is not None:
        rows = rows.filter(F.col("m") == only.strip().lower())
    rows = rows.filter("pair_id is not null").join(known.select("m", "k"), "m")
    # Keys and buffers of fixed width in both steps, so both are hash aggregations: the best score of a time, then that of the last time.
    times = rows.groupBy("pair_id", "k", "scored_at").agg(F.max("s").alias("s"))
    last = F.when(F.max("scored_at").isNull(), F.max("s")).otherwise(F.max_by("s", "scored_at"))
    latest = times.groupBy("pair_id", "k").agg(last.alias("qe_score"))
    inside = (F.abs("qe_score") < float("inf")) & F.col("qe_score").between(F.col("min_score"), F.col("max_score"))
    return latest.join(known, "k").filter(inside).select("pair_id", "qe_model", "qe_score", "higher_is_better")
