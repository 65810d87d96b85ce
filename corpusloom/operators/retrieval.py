"""Bitext retrieval quality of embeddings, and comparison of models."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.keys import join_groups, join_table
from corpusloom.storage import materialize

#: Vectors of one side that a task compares at a time.
BLOCK = 1024


def unit_rows(x: np.ndarray) -> np.ndarray:
    return x / (np.linalg.norm(x, axis=1, keepdims=True) + 1e-9)


def diagonal_ranks(vectors: DataFrame, keys: list[str], row_id: str, a: str, b: str, block: int = BLOCK, queries: Column | None = None) -> DataFrame:
    """``keys, row_id, rank``: the place of each row's own ``b`` among all ``b`` of its group by cosine with its ``a``.

    rank = 1 + the number of others that are more similar, so ties don't count against a row. The rows that ask (those
    for which ``queries`` holds) are cut into blocks by their own number, each group by itself. A group whose queries fit
    one block reads its candidates once; of more, every block of queries reads them once. Candidates are dealt by hash to
    tasks of about eight blocks, so what is shuffled grows with candidates times query blocks, no task gets a group, and
    no pair is ever a row. Rows with a null vector or id are left out.
    """
    vectors = vectors.dropna(subset=[row_id, a, b])
    asking = vectors if queries is None else vectors.filter(queries)
    candidates = vectors.groupBy(*keys).agg(F.ceil(F.count("*") / (8 * block)).cast("int").alias("_tasks"))
    sizes = asking.groupBy(*keys).agg(F.ceil(F.count("*") / block).cast("int").alias("_blocks"))
    sizes = materialize(join_groups(candidates, sizes, keys), "retrieval")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    place = lambda n: F.pmod(F.xxhash64(row_id), F.col(n)).cast("int")
    asked = join_table(asking, sizes, keys).withColumn("_q", place("_blocks")).withColumn("_c", each("_tasks"))
    asked = asked.select(*keys, "_q", "_c", F.lit(0).alias("_side"), row_id, F.col(a).alias("v"), F.col(b).alias("own"))
    offered = join_table(vectors, sizes, keys).withColumn("_c", place("_tasks")).withColumn("_q", each("_blocks"))
    offered = offered.select(*keys, "_q", "_c", F.lit(1).alias("_side"), row_id, F.col(b).alias("v"), F.lit(None).alias("own"))

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        q, c = frame[frame["_side"] == 0], frame[frame["_side"] == 1]
        more = np.zeros(len(q), np.int64)
        if len(q) and len(c):
            x, own = (unit_rows(np.stack(s.to_numpy()).astype(float)) for s in (q["v"], q["own"]))
            diagonal, ids = np.clip((x * own).sum(axis=1), -1, 1), q[row_id].to_numpy()
            for at in range(0, len(c), block):
                part = c.iloc[at : at + block]
                sims = np.clip(x @ unit_rows(np.stack(part["v"].to_numpy()).astype(float)).T, -1, 1)
                # The row's own candidate isn't more similar than itself, whatever the rounding.
                sims[ids[:, None] == part[row_id].to_numpy()[None, :]] = -2
                more += (sims > diagonal[:, None] + 1e-12).sum(axis=1)
        return q[[*keys, row_id]].assign(more=more)

    kinds = ", ".join(f"{k} {vectors.schema[k].dataType.simpleString()}" for k in [*keys, row_id])
    counted = asked.unionByName(offered).groupBy(*keys, "_q", "_c").applyInPandas(count, f"{kinds}, more bigint")
    return counted.groupBy(*keys, row_id).agg((F.sum("more") + 1).alias("rank"))


def retrieval_summary(ranks: DataFrame, keys: list[str]) -> DataFrame:
    return ranks.groupBy(*keys).agg(F.count("*").alias("n"), F.avg(1.0 / F.col("rank")).alias("mrr"), F.avg("rank").alias("avg_rank"))


def best_model(results: DataFrame, keys: list[str]) -> DataFrame:
    """One row per pair: highest MRR, single models before ensembles, then the fastest, then by name."""
    w = Window.partitionBy(*keys).orderBy(F.desc_nulls_last("mrr"), F.col("model").startswith("ensemble").cast("int"), F.asc_nulls_last("seconds"), "model")
    return results.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def merged_results(a: DataFrame, b: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Full outer merge of two benchmarks; a measure is the mean of those there."""
    joined = a.select(*keys, *[F.col(m).alias(f"a_{m}") for m in measures]).join(b.select(*keys, *[F.col(m).alias(f"b_{m}") for m in measures]), keys, "full_outer")
    mean = lambda m: F.coalesce((F.col(f"a_{m}") + F.col(f"b_{m}")) / 2, F.col(f"a_{m}"), F.col(f"b_{m}")).alias(m)
    return joined.select(*keys, *[mean(m) for m in measures])


def competition_ranks(results: DataFrame, variant: str, measures: list[str]) -> DataFrame:
    """Rank of each variant by each measure (1 is best, ties share it), their mean, and the rank by that.

    One row a variant."""
    ranked = results.select(variant, *[F.rank().over(Window.orderBy(F.desc(m))).alias(f"{m}_rank") for m in measures])
    mean = sum((F.col(f"{m}_rank") for m in measures[1:]), F.col(f"{measures[0]}_rank")) / len(measures)
    return ranked.withColumn("mean_rank", mean).withColumn("overall_rank", F.rank().over(Window.orderBy("mean_rank")))


def macro_average(rows: DataFrame, levels: list[str], measures: list[str]) -> DataFrame:
    """Averages of averages: the levels are averaged away from the last to all but the first, each with equal weight."""
    for depth in range(len(levels), 0, -1):
        rows = rows.groupBy(*levels[:depth]).agg(*[F.avg(m).alias(m) for m in measures])
    return rows


def mean_embedding(columns: list[str]) -> Column:
    """Mean of several embeddings of equal size, as a UDF over their columns."""

    @F.arrow_udf("array<double>")
    def mean(*vectors: pa.Array) -> pa.Array:
        stacked = [[np.asarray(v, float) for v in one.to_pylist()] for one in vectors]
        return pa.array([np.mean([unit_rows(v[None])[0] for v in row], axis=0).tolist() for row in zip(*stacked)], pa.list_(pa.float64()))

    return mean(*columns)


def cca(x: np.ndarray, y: np.ndarray, components: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Canonical variates of two row-aligned matrices: both standardised, whitened by SVD, rotated onto each other."""
    standard = lambda m: (m - m.mean(axis=0)) / np.where(m.std(axis=0) > 0, m.std(axis=0), 1.0)
    (ux, sx, _), (uy, sy, _) = (np.linalg.svd(standard(np.asarray(m, float)), full_matrices=False) for m in (x, y))
    ux, uy = ux[:, sx > 1e-10 * sx[0]], uy[:, sy > 1e-10 * sy[0]]
    left, _, right = np.linalg.svd(ux.T @ uy, full_matrices=False)
    k = components or left.shape[1]
    return ux @ left[:, :k], uy @ right.T[:, :k]


def cca_fit(vectors: DataFrame, x: str, y: str, components: int | None = None) -> tuple[np.ndarray, ...]:
    """``mean_x, map_x, mean_y, map_y`` of the canonical variates of two vector columns: ``(x - mean_x) @ map_x`` is as
    ``cca`` has it, up to the signs of components.

    Rows are never brought together: their sums and products are added up on the map side, and the driver gets one
    matrix of (2d + 1) squared numbers. Rows with a null vector are left out."""

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for frame in frames:
            if len(frame):
                m = np.hstack([np.ones((len(frame), 1)), *(np.stack(frame[c].to_numpy()).astype(float) for c in ("x", "y"))])
                total = m.T @ m if total is None else total + m.T @ m
        if total is not None:
            yield pd.DataFrame({"i": np.arange(total.size), "s": total.ravel()})

    both = vectors.select(F.col(x).alias("x"), F.col(y).alias("y")).dropna()
    flat = both.mapInPandas(sums, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).orderBy("i").collect()
    if not flat:
        raise ValueError("no vectors to fit on")
    gram = np.array([r.s for r in flat]).reshape(int(len(flat) ** 0.5), -1)
    d = len(both.first().x)
    mean = gram[0, 1:] / gram[0, 0]
    cov = gram[1:, 1:] / gram[0, 0] - np.outer(mean, mean)

    def whitened(part: slice) -> np.ndarray:
        scale = np.sqrt(np.clip(np.diag(cov)[part], 0, None))
        scale = np.where(scale > 1e-12, scale, 1.0)
        values, axes = np.linalg.eigh(cov[part, part] / np.outer(scale, scale))
        good = values > 1e-10 * values.max()
        return (axes[:, good] / np.sqrt(values[good] * gram[0, 0])) / scale[:, None]

    left, right = slice(0, d), slice(d, len(mean))
    wx, wy = whitened(left), whitened(right)
    u, _, vt = np.linalg.svd(wx.T @ cov[left, right] @ wy * gram[0, 0], full_matrices=False)
    k = components or u.shape[1]
    return mean[left], wx @ u[:, :k], mean[right], wy @ vt.T[:, :k]


def cca_apply(vectors: DataFrame, x: str, y: str, fitted: tuple[np.ndarray, ...]) -> DataFrame:
    """``vectors`` with both columns replaced by their canonical variates; null stays null."""
    shared = vectors.sparkSession.sparkContext.broadcast(fitted)  # two d x d matrices

    def project(side: int):
        @F.arrow_udf("array<double>")
        def run(column: pa.Array) -> pa.Array:
            mean, axes = shared.value[2 * side : 2 * side + 2]
            return pa.array([None if v is None else ((np.asarray(v, float) - mean) @ axes).tolist() for v in column.to_pylist()], pa.list_(pa.float64()))

        return run

    return vectors.withColumn(x, project(0)(F.col(x))).withColumn(y, project(1)(F.col(y)))
