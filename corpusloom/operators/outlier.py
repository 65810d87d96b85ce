"""Isolation forests over numeric features: one from a bounded sample, or one a group; applied to every row in Arrow batches."""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.values import stable_uniform
from corpusloom.operators.prefix import exact_quantiles
from corpusloom.operators.sampling import fraction_sample, sample_k
from corpusloom.operators.stats import unpivot
from corpusloom.storage import materialize

#: Rows the forest is fitted on, and rows of each tree.
SAMPLE_ROWS, TREE_ROWS = 100_000, 256
#: Trees of a forest, and about how many rows of a group one task scores.
TREES, PART_ROWS = 100, 20_000


def average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among n points."""
    n = np.asarray(n, float)
    h = np.log(np.maximum(n - 1, 1)) + np.euler_gamma
    return np.where(n > 2, 2 * h - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


class IsolationForest:
    """Trees in arrays: feature (-1 at leaves), cut, children and the path length added at a leaf."""

    def __init__(self, x: np.ndarray, trees: int = TREES, seed: int = 0, contamination: float | None = 0.005, median: np.ndarray | None = None):
        rng = np.random.default_rng(seed)
        self.median = np.array([np.median(c[np.isfinite(c)]) if np.isfinite(c).any() else 0.0 for c in x.T]) if median is None else median
        x = self.clean(x)
        self.size = min(TREE_ROWS, len(x))
        self.depth = int(np.ceil(np.log2(max(self.size, 2))))
        self.trees = [self._grow(x[rng.choice(len(x), self.size, replace=False)], rng) for _ in range(trees)]
        self.threshold = float(np.quantile(self.score(x), 1 - contamination)) if contamination is not None else None

    def clean(self, x: np.ndarray) -> np.ndarray:
        return np.where(np.isfinite(x), x, self.median)

    def _grow(self, x: np.ndarray, rng) -> tuple[np.ndarray, ...]:
        feature, cut, left, right, extra = [], [], [], [], []
        stack = [(np.arange(len(x)), 0, -1, 0)]
        while stack:
            rows, depth, parent, side = stack.pop()
            node = len(feature)
            for column, value in ((feature, -1), (cut, 0.0), (left, 0), (right, 0), (extra, 0.0)):
                column.append(value)
            if parent >= 0:
                (left, right)[side][parent] = node
            part = x[rows]
            low, high = part.min(axis=0), part.max(axis=0)
            usable = np.flatnonzero(high > low)
            if depth >= self.depth or len(rows) <= 1 or not len(usable):
                extra[node] = depth + float(average_path(len(rows)))
                continue
            f = rng.choice(usable)
            feature[node], cut[node] = int(f), float(rng.uniform(low[f], high[f]))
            below = part[:, f] < cut[node]
            stack += [(rows[~below], depth + 1, node, 1), (rows[below], depth + 1, node, 0)]
        return np.array(feature), np.array(cut), np.array(left), np.array(right), np.array(extra)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly scores in (0, 1); higher is more isolated."""
        x, paths = self.clean(x), np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, cut, left, right, extra in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth + 1):
                f = feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                go_left = x[rows, np.maximum(f, 0)] < cut[node]
                node = np.where(inner, np.where(go_left, left[node], right[node]), node)
            paths += extra[node]
        return 2.0 ** (-paths / len(self.trees) / max(float(average_path(self.size)), 1e-9))


def fit(rows: DataFrame, features: list[str], ids: list[str], sample: int = SAMPLE_ROWS, **options) -> IsolationForest:
    """Fit on about ``sample`` rows drawn by hash of ``ids``; features may be null."""
    n = rows.count()
    columns = [F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)]
    drawn = fraction_sample(rows, min(1.0, sample / max(n, 1)), 0, *ids).orderBy(*ids).select(*columns)
    x = np.array([[np.nan if v is None else v for v in r] for r in drawn.collect()], float)
    if not len(x):
        raise ValueError("no row to fit on")
    return IsolationForest(x, **options)


def score_rows(rows: DataFrame, features: list[str], forest: IsolationForest, out: str = "anomaly") -> DataFrame:
    """``rows`` with the forest's score and ``is_outlier``, whether it exceeds the contamination quantile."""
    shared = rows.sparkSession.sparkContext.broadcast(forest)  # bounded by trees and rows a tree

    @F.arrow_udf("double")
    def anomaly(*columns: pa.Array) -> pa.Array:
        x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in columns], axis=1)
        return pa.array(shared.value.score(x))

    scored = rows.withColumn(out, anomaly(*[F.col(f).cast("double") for f in features]))
    return scored.withColumn("is_outlier", F.col(out) > forest.threshold)


def score_by_group(rows: DataFrame, group: str, features: list[str], ids: list[str], out: str = "anomaly", contamination: float = 0.005) -> DataFrame:
    """``rows`` with the score of their group's own forest and ``is_outlier``, whether it exceeds the group's contamination quantile.

    A tree grows on its 256 rows, drawn from as many rows of the group as all trees take together, themselves drawn
    uniformly from all of it. Medians, scores and cutoffs are those of all rows. The forest goes to where about
    ``PART_ROWS`` rows of the group are, so neither the driver nor one task holds a group. Rows are read several times;
    ``group`` and ``ids`` must not be null.
    """
    names = [f"_f{i}" for i in range(len(features))]
    numbers = rows.select(group, *ids, *[F.col(f).cast("double").alias(n) for f, n in zip(features, names)])
    pool = sample_k(numbers, [group], TREES * TREE_ROWS, 0, *ids)
    middle = exact_quantiles(unpivot(numbers, [group], names), [group, "feature"], "value", {"m": 0.5})
    middle = middle.groupBy(group).agg(*[F.max(F.when(F.col("feature") == n, F.col("m"))).alias(f"{n}m") for n in names])
    kind = rows.schema[group].dataType.simpleString()

    def grow(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(ids)
        median = np.nan_to_num(frame[[f"{n}m" for n in names]].iloc[0].to_numpy(float))
        forest = IsolationForest(frame[names].to_numpy(float), contamination=None, median=median)
        return pd.DataFrame({group: [frame[group].iloc[0]], "_forest": [pickle.dumps(forest)]})

    forests = materialize(pool.join(middle, group, "left").groupBy(group).applyInPandas(grow, f"{group} {kind}, _forest binary"), "forests")
    parts = rows.groupBy(group).agg(F.ceil(F.count("*") / PART_ROWS).cast("int").alias("_parts"))
    spread = forests.join(parts, group).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).select(group, "_part", "_forest")
    place = F.floor(stable_uniform(1, *[F.col(i) for i in ids]) * F.col("_parts")).cast("int")
    placed = numbers.join(parts, group).withColumn("_part", place).drop("_parts")

    def score(frame: pd.DataFrame, forest: pd.DataFrame) -> pd.DataFrame:
        if not len(frame):
            return pd.DataFrame(columns=[group, *ids, out])
        return frame[[group, *ids]].assign(**{out: pickle.loads(forest["_forest"].iloc[0]).score(frame[names].to_numpy(float))})

    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in (group, *ids)) + f", {out} double"
    scored = placed.groupBy(group, "_part").cogroup(spread.groupBy(group, "_part")).applyInPandas(score, schema)
    scored = materialize(scored, "anomaly")
    cuts = exact_quantiles(scored, [group], out, {"_cut": 1 - contamination})
    return scored.join(cuts, group).withColumn("is_outlier", F.col(out) > F.col("_cut")).drop("_cut")
