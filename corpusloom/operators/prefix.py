"""Running sums, row numbers, ranks and exact quantiles without a window over an unbounded group.

Rows are range-partitioned by (group, order), each slice is summed, and the sums of the slices before it are added:
two narrow passes and a table of one row per slice and group. A group, or a value, that holds most rows is spread over
many slices; nothing is joined on a value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.keys import join_groups
from corpusloom.storage import materialize


def _over(group: list[str], *order: str):
    """A window over the table of slices."""
    window = Window.partitionBy(*group)
    return window.orderBy(*order) if order else window


def running_sum(rows: DataFrame, group: list[str], order: list[Column], weight: Column, name: str, total: str | None = None) -> DataFrame:
    """``rows`` with ``name``: the sum of ``weight`` over the rows of the same group up to this one in ``order``, and, if
    wanted, the group's whole sum as ``total``.

    ``order`` should be total; rows that tie get an arbitrary but fixed order among themselves. Null groups are groups
    of their own and null weights count 0.
    """
    keys = [F.col(g) for g in group]
    sliced = rows.withColumn("_w", F.coalesce(weight, F.lit(0))).repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    sliced = materialize(sliced.withColumn("_slice", F.spark_partition_id()).withColumn("_place", F.monotonically_increasing_id()), "prefix")
    sums = sliced.groupBy(*group, "_slice").agg(F.sum("_w").alias("_s"))
    earlier = _over(group, "_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*group, "_slice", F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_before"), *([F.sum("_s").over(_over(group)).alias(total)] if total else []))
    within = Window.partitionBy(*group, "_slice").orderBy("_place")
    out = join_groups(sliced.withColumn("_in", F.sum("_w").over(within)), offsets, [*group, "_slice"], "left")
    return out.withColumn(name, F.col("_in") + F.col("_before")).drop("_w", "_slice", "_place", "_in", "_before")


def row_numbers(rows: DataFrame, group: list[str], order: list[Column], name: str = "row_no") -> DataFrame:
    """``rows`` with their number from 1 within the group, in a total order."""
    return running_sum(rows, group, order, F.lit(1).cast("bigint"), name)


def value_ranks(rows: DataFrame, group: list[str], value: str, less: str = "_less", equal: str = "_equal", n: str = "_all", nulls: bool = False) -> DataFrame:
    """``rows`` with how many rows of their group have a lower value, how many the same one (themselves included), and
    how many there are. All ranks follow from these. NaN is one value, the highest; null is the lowest if ``nulls``, else
    rows without a value are left out.

    Equal values are spread over slices by a hash of the rows, so a value may hold any share of them. Counts within a
    slice are windows over it; a value at the edge of a slice may go on in others, and its counts are put together in a
    table of at most two rows a slice and group.
    """
    keys, v = [F.col(g) for g in group], F.col(value)
    known = (rows if nulls else rows.filter(v.isNotNull())).withColumn("_tie", F.xxhash64(*rows.columns))
    sliced = known.repartitionByRange(*keys, v, "_tie").withColumn("_slice", F.spark_partition_id()).drop("_tie")
    here = [*group, "_slice"]
    local = sliced.withColumn("_in_less", F.rank().over(Window.partitionBy(*here).orderBy(v)) - 1).withColumn("_in_equal", F.count("*").over(Window.partitionBy(*here, value)))
    local = materialize(local, "ranks")
    slices = local.groupBy(*here).agg(
        F.count("*").alias("_n"), F.when(F.bool_and(v.isNotNull()), F.min(v)).alias("_lo"), F.max(v).alias("_hi"), F.max("_in_less").alias("_hi_less"),
        F.max(F.when(F.col("_in_less") == 0, F.col("_in_equal"))).alias("_lo_equal"),
    )
    before = F.coalesce(F.sum("_n").over(_over(group, "_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    slices = materialize(slices.withColumn("_before", before).withColumn(n, F.sum("_n").over(_over(group))), "slices")
    low = F.struct(F.col("_lo").alias("_v"), F.col("_before").alias("_l"), F.col("_lo_equal").alias("_e"))
    high = F.struct(F.col("_hi").alias("_v"), (F.col("_before") + F.col("_hi_less")).alias("_l"), (F.col("_n") - F.col("_hi_less")).alias("_e"))
    edges = slices.select(*group, F.explode(F.when(F.col("_hi_less") > 0, F.array(low, high)).otherwise(F.array(low))).alias("_x"))
    edges = edges.groupBy(*group, F.col("_x._v").alias("_v")).agg(F.min("_x._l").alias("_l"), F.sum("_x._e").alias("_e"))
    for side in ("_lo", "_hi"):
        own = edges.select(*group, F.col("_v").alias(side), F.col("_l").alias(f"{side}_l"), F.col("_e").alias(f"{side}_e"))
        slices = join_groups(slices, own, [*group, side])
    parts = slices.select(*here, "_lo", "_hi", "_before", n, *[f"{s}_{x}" for s in ("_lo", "_hi") for x in ("l", "e")])
    out = join_groups(local, parts, here)
    at_lo, at_hi = v.eqNullSafe(F.col("_lo")), v.eqNullSafe(F.col("_hi"))
    out = out.withColumn(less, F.when(at_lo, F.col("_lo_l")).when(at_hi, F.col("_hi_l")).otherwise(F.col("_before") + F.col("_in_less")))
    out = out.withColumn(equal, F.when(at_lo, F.col("_lo_e")).when(at_hi, F.col("_hi_e")).otherwise(F.col("_in_equal")))
    return out.select(*rows.columns, less, equal, n)


def exact_quantiles(rows: DataFrame, keys: list[str], value: str, probabilities: dict[str, float]) -> DataFrame:
    """``keys`` with one column per name of ``probabilities``: the quantile by linear interpolation.

    Equal values are counted before anything is sorted, so ties cost nothing. Null and NaN values are left out; a group
    of which nothing is left has no row.
    """
    counted = (
        rows.select(*keys, F.col(value).cast("double").alias("_v")).filter("_v is not null and not isnan(_v)")
        .groupBy(*keys, "_v").agg(F.count("*").alias("_n"))
    )
    counted = materialize(counted, "counted")  # sorting reads it twice
    ranked = running_sum(counted, keys, [F.col("_v")], F.col("_n"), "_to", "_all")
    picks = []
    for name, p in probabilities.items():
        at = (F.col("_all") - 1) * F.lit(float(p))
        here = lambda place: F.max(F.when((place < F.col("_to")) & (place >= F.col("_to") - F.col("_n")), F.col("_v")))  # noqa: B023, E731
        picks += [here(F.floor(at)).alias(f"{name}_a"), here(F.ceil(at)).alias(f"{name}_b"), F.max(at - F.floor(at)).alias(f"{name}_f")]
    found = ranked.groupBy(*keys).agg(*picks)
    return found.select(*keys, *[(F.col(f"{n}_a") + (F.col(f"{n}_b") - F.col(f"{n}_a")) * F.col(f"{n}_f")).alias(n) for n in probabilities])


def percent_ranks(rows: DataFrame, group: list[str], value: str, name: str = "percent_rank") -> DataFrame:
    """``rows`` with SQL's ``percent_rank`` of ``value`` within the group: (rank - 1) / (n - 1), 0 for a single row.

    Null values sort first."""
    ranked = value_ranks(rows, group, value, nulls=True)
    share = F.when(F.col("_all") > 1, F.col("_less") / (F.col("_all") - 1)).otherwise(0.0)
    return ranked.select(*rows.columns, share.alias(name))
