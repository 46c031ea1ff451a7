"""Isolation forest (Liu, Ting and Zhou, 2008) over readings.

Each tree is grown on a small sample, so growing is a grouped map over bounded
groups, one per tree.  Scoring is an Arrow UDF that walks all trees of a batch at
once.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.functions.calendar import day_of_week
from wattlake.operators.keyed import first_per_key

# Ship the functions below with the tasks, so that workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Defaults (fixed values).
FEATURES = ("hour", "day_of_week", "power_kw", "voltage_v", "current_a", "power_factor")
TREES = 100
SAMPLE = 256
OVERSAMPLE = 4  # readings a tree draws from, in samples
CONTAMINATION = 0.02
SEED = 42

TREE_SCHEMA = ("tree int, feature array<int>, threshold array<double>, left array<int>, "
               "right array<int>, path array<double>, sample_size int")
HASH_SPAN = 2 ** 62


def with_features(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Adds the calendar features the forest uses."""
    return df.withColumns({"hour": F.hour(ts), "day_of_week": day_of_week(F.col(ts))})


def _uniform(*columns) -> Column:
    """A number in [0, 1) that depends only on the given values."""
    return F.pmod(F.xxhash64(*columns), F.lit(HASH_SPAN)).cast("double") / float(HASH_SPAN)


def training_sample(df: DataFrame, cols: Sequence[str] = FEATURES, trees: int = TREES, sample: int = SAMPLE,
                    seed: int = SEED, key: str = "event_id", oversample: int = OVERSAMPLE) -> DataFrame:
    """J-01, sampling: ``sample`` distinct readings per tree, chosen by hash and thus repeatable.

    A first hash keeps a pool of about ``trees * oversample`` samples, so that the
    trees draw independently however large the table is; copies of one event fall
    together and count once (the pool is grouped by event, which combines before
    its shuffle).  Inside the pool each tree keeps about ``oversample`` samples'
    worth by a second hash and then takes the smallest hashes.
    """
    known = df.dropna("any", subset=[*cols, key])
    distinct = known.agg(F.approx_count_distinct(key)).first()[0] or 1
    share = min(1.0, float(trees) * oversample * sample / distinct)
    pool = known.where(_uniform(F.col(key), F.lit(seed)) < share) \
        .groupBy(key).agg(F.min(F.struct(*cols)).alias("reading"))
    per_tree = min(1.0, float(oversample) * sample / max(1.0, share * distinct))
    draws = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda tree: F.struct(
        tree.alias("tree"), _uniform(F.col(key), F.lit(seed), tree).alias("draw")))
    # the outer form keeps the draws of each tree out of the filter on the raw rows
    drawn = pool.select(key, "reading", F.explode_outer(F.filter(draws, lambda d: d["draw"] < per_tree)).alias("d"))
    drawn = drawn.where(F.col("d").isNotNull()).select(key, "d.tree", "d.draw", "reading.*")
    return first_per_key(drawn, ["tree"], [F.asc("draw"), F.asc(key)], sample)


def _average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search in a binary tree of n points."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3.0)
    longer = 2.0 * (np.log(safe - 1.0) + np.euler_gamma) - 2.0 * (safe - 1.0) / safe
    return np.where(n > 2, longer, np.where(n == 2, 1.0, 0.0))


def _grow(points: np.ndarray, rng: np.random.Generator) -> dict[str, list]:
    """One tree as parallel arrays; a leaf points to itself and stores its path length."""
    limit = int(np.ceil(np.log2(max(len(points), 2))))
    tree = {name: [] for name in ("feature", "threshold", "left", "right", "path")}

    def node(rows: np.ndarray, depth: int) -> int:
        index = len(tree["feature"])
        for name, value in (("feature", 0), ("threshold", float("inf")), ("left", index), ("right", index),
                            ("path", float(depth + _average_path(len(rows))))):
            tree[name].append(value)
        low, high = rows.min(axis=0), rows.max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or not len(usable):
            return index
        feature = int(rng.choice(usable))
        threshold = float(rng.uniform(low[feature], high[feature]))
        goes_left = rows[:, feature] <= threshold
        tree["feature"][index], tree["threshold"][index] = feature, threshold
        tree["left"][index] = node(rows[goes_left], depth + 1)
        tree["right"][index] = node(rows[~goes_left], depth + 1)
        return index

    node(points, 0)
    return tree


@dataclass(frozen=True)
class IsolationForest:
    """Grown trees as padded arrays (trees x nodes) and the score offset."""

    cols: tuple[str, ...]
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    path: np.ndarray
    depth: int
    sample_size: int
    offset: float = 0.0

    def normality(self, points: np.ndarray) -> np.ndarray:
        """Minus two to the minus relative path length: near -1 is anomalous, above -0.5 normal."""
        flat = np.ascontiguousarray(points).ravel()
        base = np.arange(len(points)) * points.shape[1]
        total = np.zeros(len(points))
        for tree in range(len(self.feature)):  # one tree at a time: its nodes stay in the cache
            children = np.stack([self.left[tree], self.right[tree]], axis=1).ravel()
            feature, threshold = self.feature[tree], self.threshold[tree]
            at = np.zeros(len(points), dtype=np.intp)
            for _ in range(self.depth):
                go_right = flat.take(base + feature.take(at)) > threshold.take(at)
                at = children.take(2 * at + go_right)
            total += self.path[tree].take(at)
        mean_path = total / len(self.feature)
        return -np.power(2.0, -mean_path / max(float(_average_path(self.sample_size)), 1e-12))

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """The trees as rows, one per tree, with the offset; small by construction."""
        rows = [(tree, *[getattr(self, name)[tree].tolist() for name in
                         ("feature", "threshold", "left", "right", "path")], self.sample_size)
                for tree in range(len(self.feature))]
        return spark.createDataFrame(rows, TREE_SCHEMA).withColumn("offset", F.lit(self.offset)) \
            .withColumn("cols", F.array(*[F.lit(name) for name in self.cols]))

    @staticmethod
    def from_frame(trees: DataFrame) -> "IsolationForest":
        rows = trees.orderBy("tree").collect()  # a row per tree, at most 2 * sample nodes each
        return _pack([row.asDict() for row in rows], tuple(rows[0]["cols"]), rows[0]["offset"])


def _pack(rows: list[dict], cols: tuple[str, ...], offset: float = 0.0) -> IsolationForest:
    width = max(len(row["feature"]) for row in rows)

    def padded(name: str, kind) -> np.ndarray:
        out = np.zeros((len(rows), width), dtype=kind)
        for index, row in enumerate(rows):
            out[index, :len(row[name])] = row[name]
        return out

    size = max(row["sample_size"] for row in rows)
    return IsolationForest(
        cols, padded("feature", np.intp), padded("threshold", float), padded("left", np.intp),
        padded("right", np.intp), padded("path", float), int(np.ceil(np.log2(max(size, 2)))), size, offset)


def isolation_forest_fit(df: DataFrame, cols: Sequence[str] = FEATURES, trees: int = TREES,
                         sample: int = SAMPLE, contamination: float = CONTAMINATION, seed: int = SEED,
                         key: str = "event_id") -> IsolationForest:
    """J-01: grows the forest and sets the offset so that ``contamination`` of the rows lie below it.

    Eager, like any ML fit: one pass to count, one to sample, one to score.
    """
    names = list(cols)

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        ordered = pdf.sort_values(["draw", key])
        tree = int(ordered["tree"].iloc[0])
        grown = _grow(ordered[names].to_numpy(dtype=float), np.random.default_rng([seed, tree]))
        return pd.DataFrame([{"tree": tree, **grown, "sample_size": len(ordered)}])

    drawn = training_sample(df, cols, trees, sample, seed, key)
    grown = drawn.groupBy("tree").applyInPandas(build, TREE_SCHEMA).orderBy("tree").collect()
    if not grown:
        raise ValueError("no reading has all features")
    model = _pack([row.asDict() for row in grown], tuple(names))
    scored = df.select(_normality(model).alias("score"))
    offset = scored.agg(F.percentile_approx("score", float(contamination), 100_000)).first()[0]
    return IsolationForest(**{**model.__dict__, "offset": float(offset)})


def _normality(model: IsolationForest) -> Column:
    @F.pandas_udf("double")
    def score(*features: pd.Series) -> pd.Series:
        points = np.column_stack([column.to_numpy(dtype=float) for column in features])
        known = ~np.isnan(points).any(axis=1)
        out = np.full(len(points), np.nan)
        if known.any():
            out[known] = model.normality(points[known])
        return pd.Series(out).where(known, None)

    return score(*[F.col(name).cast("double") for name in model.cols])


def isolation_forest_score(df: DataFrame, model: IsolationForest) -> DataFrame:
    """J-02: ``anomaly_score`` (negative is anomalous) and ``ml_anomaly``; a reading with a gap gets no score."""
    scored = df.withColumn("anomaly_score", _normality(model) - F.lit(model.offset))
    return scored.withColumn("ml_anomaly", F.coalesce(F.col("anomaly_score") < 0, F.lit(False)))
