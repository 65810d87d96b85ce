"""Joins with checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def positional_join(left: DataFrame, right: DataFrame, position: list[str], check: list[str] = ()) -> DataFrame:
    """Row i of one result beside row i of another, by their stable positions (file and row number, or an id).

    ``check``: columns that must agree where both are there, or the query fails; they appear once, like the positions.
    Rows without a partner are dropped, as a shorter file ends a zip. Other columns of equal names are refused.
    """
    if clash := sorted(set(left.columns) & set(right.columns) - set(position) - set(check)):
        raise ValueError(f"on both sides: {clash}")
    renamed = right.withColumnsRenamed({c: f"_{c}" for c in check})
    joined = left.join(renamed, position)
    for c in check:
        wrong = F.raise_error(F.lit(f"{c} differs between the two results"))
        joined = joined.withColumn(c, F.when(F.col(c).eqNullSafe(F.col(f"_{c}")), F.col(c)).otherwise(wrong)).drop(f"_{c}")
    return joined


def pick_groups(stats: DataFrame, n: int, key: str, worst: str, biggest: str, seed: int = 0) -> DataFrame:
    """``n`` groups with the lowest ``worst``, ``n`` with the highest ``biggest`` and ``n`` by hash, with ``why``."""
    order = {"worst": [F.asc_nulls_last(worst), key], "biggest": [F.desc_nulls_last(biggest), key], "random": [F.xxhash64(F.lit(seed), key), key]}
    out = None
    for why, by in order.items():
        part = stats.orderBy(*by).limit(n).select(F.lit(why).alias("why"), "*")
        out = part if out is None else out.unionByName(part)
    return out
