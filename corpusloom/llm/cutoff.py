"""Exact order statistics per group by iterative histogram refinement.

For each group the interval that holds the wanted rank starts as the range of its values. Each pass counts the values
in that interval into bins, with the least and the greatest value of each bin, and zooms into the bin that holds the
rank; the next interval is that bin's own range, so both ends are values that occur and the interval shrinks in every
pass. It ends when the interval is one value. A pass shuffles at most ``bins`` partial counts per group and task: no
group's values are ever brought together, whatever share of the rows it holds. The state is one row a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.storage import discard, materialize

BINS = 4096
#: Up to so many groups the state of the refinement is broadcast.
BROADCAST_GROUPS = 100_000


def kth_value(rows: DataFrame, group: str, value: str, ranks: DataFrame, bins: int = BINS) -> DataFrame:
    """The ``k``-th largest ``value`` of each group of ``ranks`` (columns ``group`` and ``k``, from 1).

    Returns ``group, cutoff, above``: ``above`` is the number of values greater than the cutoff. ``rows`` is read once
    a pass, so it should be a table or cached. Null values are no values and NaN must not occur; a group whose rank is
    null, below 1 or beyond its values has no row. A null group is a group like any other.
    """
    kind = rows.schema[value].dataType.simpleString()
    if kind not in ("double", "bigint"):
        raise TypeError(f"{value} is {kind}; double and bigint can be ranked")
    rows = rows.select(F.col(group).alias("g"), F.col(value).alias("v")).filter("v is not null")
    ranks = ranks.select(F.col(group).alias("g"), F.col("k").cast("bigint").alias("k")).filter("k >= 1")
    found = (
        rows.groupBy("g").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).alias("a")
        .join(ranks.alias("r"), F.col("a.g").eqNullSafe(F.col("r.g")))
        .filter("k <= n")
        .select("a.g", "k", "lo", "hi", F.lit(0).cast("bigint").alias("above"))
    )
    state = materialize(found, "cutoff")
    small = state.count() <= BROADCAST_GROUPS  # it never grows
    while not state.filter("lo < hi").isEmpty():
        before, state = state, materialize(_zoom(rows, state, bins, kind, small), "cutoff")
        discard(before)
    return state.select(F.col("g").alias(group), F.col("lo").alias("cutoff"), "above")


def _zoom(rows: DataFrame, state: DataFrame, bins: int, kind: str, small: bool) -> DataFrame:
    # k is the rank within the interval; both differences are taken so that neither overflows.
    v, lo, hi = F.col("v"), F.col("lo"), F.col("hi")
    if kind == "double":
        ratio = (v / 2 - lo / 2) / (hi / 2 - lo / 2)
    else:
        wide = hi.cast("double") - lo.cast("double") > 2.0**52
        ratio = F.when(wide, (v.cast("double") - lo.cast("double")) / (hi.cast("double") - lo.cast("double"))).otherwise(
            (v - lo).cast("double") / (hi - lo).cast("double")
        )
    number = F.when(v == lo, 0).when(v == hi, bins - 1).otherwise(F.least(F.greatest(F.floor(ratio * bins), F.lit(0)), F.lit(bins - 1)))
    open_ = state.filter("lo < hi").select(F.col("g").alias("sg"), "lo", "hi")
    counted = (
        rows.join(F.broadcast(open_) if small else open_, F.col("g").eqNullSafe(F.col("sg")))
        .filter(v.between(lo, hi))
        .groupBy("g", number.cast("int").alias("bin"))
        .agg(F.count("*").alias("n"), F.min("v").alias("bin_lo"), F.max("v").alias("bin_hi"))
    )
    down = Window.partitionBy("g").orderBy(F.desc("bin"))  # at most ``bins`` rows a group
    ranked = counted.withColumn("to_here", F.sum("n").over(down)).alias("c")
    moved = (
        ranked.join(state.filter("lo < hi").alias("s"), F.col("c.g").eqNullSafe(F.col("s.g")))
        .filter((F.col("to_here") >= F.col("k")) & (F.col("to_here") - F.col("n") < F.col("k")))
        .select(
            "s.g",
            (F.col("k") - (F.col("to_here") - F.col("n"))).alias("k"),
            F.col("bin_lo").alias("lo"),
            F.col("bin_hi").alias("hi"),
            (F.col("above") + F.col("to_here") - F.col("n")).alias("above"),
        )
    )
    return moved.unionByName(state.filter("lo >= hi"))


def keep_fraction(scores: DataFrame, source: str, score: str, fractions: DataFrame, bins: int = BINS) -> tuple[DataFrame, DataFrame]:
    """The cutoff of each source that keeps a fraction of its records, and the records kept.

    ``fractions`` has ``source``, ``keep_permille`` and ``higher_is_better``. Of n records, k = n * permille / 1000
    rounded up, the cutoff is the k-th best score and all records at least as good are kept, ties included. The report
    has ``source, n_records, k, cutoff, n_kept``; a source with k = 0 keeps none and has no row, one without records
    neither. Null and NaN scores are no records.
    """
    way = F.when(F.col("higher_is_better"), 1.0).otherwise(-1.0)
    wanted = fractions.select(F.col(source).alias("_source"), F.col("keep_permille").alias("_permille"), way.alias("_way"))
    best = scores.join(wanted, F.col(source) == F.col("_source")).filter(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double"))).withColumn("_value", F.col(score) * F.col("_way"))
    best = materialize(best, "scores")
    sizes = best.groupBy("_source").agg(F.count("*").alias("n_records"), F.first("_permille").alias("p"), F.first("_way").alias("way"))
    sizes = materialize(sizes.select("_source", "n_records", "way", F.expr("(n_records * p + 999) div 1000").alias("k")), "sizes")
    cutoffs = kth_value(best, "_source", "_value", sizes, bins).select("_source", F.col("cutoff").alias("_cutoff"))
    kept = best.join(cutoffs, "_source").filter("_value >= _cutoff")
    report = (
        kept.groupBy("_source").agg(F.count("*").alias("n_kept")).join(sizes, "_source").join(cutoffs, "_source")
        .select(F.col("_source").alias(source), "n_records", "k", (F.col("_cutoff") * F.col("way")).alias("cutoff"), "n_kept")
    )
    return report, kept.select(*scores.columns)
