"""Joins on group keys in which null is a key like any other."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.storage import BROADCAST_ROWS, materialize

#: Parts into which the rows of a group are dealt where the table of groups is too large to broadcast.
SALTS = 64


def join_groups(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``left`` with the other columns of ``right``; ``how`` is inner or left, and the keys appear once."""
    renamed = right.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[c for c in right.columns if c not in keys])
    same = reduce(lambda a, ik: a & F.col(ik[1]).eqNullSafe(F.col(f"_k{ik[0]}")), enumerate(keys), F.lit(True))
    return left.join(renamed, same, how).drop(*[f"_k{i}" for i in range(len(keys))])


def join_table(rows: DataFrame, groups: DataFrame, keys: list[str], how: str = "inner", most: int = BROADCAST_ROWS) -> DataFrame:
    """``join_groups`` of rows with a table of one row a group, for groups of any size.

    The table is written and counted. Up to ``most`` rows of it are broadcast; a larger one is repeated for each of
    ``SALTS`` parts into which the rows of a group are dealt by hash, so that no task gets a whole group."""
    groups = materialize(groups, "groups")
    if groups.limit(most + 1).count() <= most:
        return join_groups(rows, F.broadcast(groups), keys, how)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int"))
    repeated = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return join_groups(salted, repeated, [*keys, "_salt"], how).drop("_salt")
