"""Model explanation.

Importances come from the fitted model (a handful of numbers on the
driver).  Attributions are per-row column expressions or Spark jobs over
the scored rows; only per-feature summaries are small.
"""

from __future__ import annotations

import math
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carepath.operators.hist_boost import BoostedTrees
from carepath.operators.models import Fitted
from carepath.session import ensure_checkpoint_dir

# Functions of this module go to the executors by value, so these need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def importance_table(fitted: Fitted, top: int | None = 20) -> DataFrame:
    """``(feature, importance)`` sorted descending, first ``top`` rows."""
    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame([(f, float(v)) for f, v in fitted.importance()],
                               "feature string, importance double")
    df = df.orderBy(F.desc("importance"), F.asc("feature"))
    return df.limit(top) if top else df


def linear_attribution(fitted: Fitted, df: DataFrame, keys: list[str],
                       background: DataFrame | None = None) -> DataFrame:
    """Exact attributions of a linear model: ``coef_j * (x_j - mean_j)`` with
    the means of ``background`` (default: ``df`` itself), long form
    ``(keys..., feature, attribution)`` (I2)."""
    est = fitted.estimator
    coefs = [float(c) for c in est.coefficients.toArray()]
    bg = background if background is not None else df
    means = bg.agg(*[F.avg(f).alias(f"m{i}") for i, f in enumerate(fitted.features)]).first()
    items = [F.struct(F.lit(f).alias("feature"),
                      (F.lit(c) * (F.col(f) - F.lit(means[f"m{i}"]))).alias("attribution"))
             for i, (f, c) in enumerate(zip(fitted.features, coefs))]
    return df.select(*keys, F.inline(F.array(*items)))


def attribution_summary(att: DataFrame, top: int | None = 20) -> DataFrame:
    """Mean |attribution| per feature, largest first (I4)."""
    s = (att.groupBy("feature").agg(F.avg(F.abs("attribution")).alias("mean_abs_attribution"))
            .orderBy(F.desc("mean_abs_attribution"), F.asc("feature")))
    return s.limit(top) if top else s


def monte_carlo_shapley(fitted, df: DataFrame, key: str, background: DataFrame,
                        n_permutations: int = 10, n_background: int = 100, seed: int = 42) -> DataFrame:
    """Sampling (permutation) Shapley values for any fitted model, as one
    Spark job over ``df``.

    Every row is expanded to ``n_permutations`` feature orders (seeded by
    hash of key, permutation and feature) and, per order, ``p + 1`` hybrid
    points that switch features from a background row to the row's own
    values one at a time.  The model scores all hybrid points in one
    ``transform``; consecutive differences are attributed to the switched
    feature and averaged per ``(key, feature)``, with their standard error.
    Where both rows have the same value, the point is the one before: it isn't
    scored again, and its difference of 0 counts like any other.

    The background is a sample of ``n_background`` rows of ``background``,
    those with the smallest seeded hash of their key (``key``, ties by the row),
    so repeated feature vectors keep their weight; it is a numbered table of
    bounded size, joined by number, and each permutation draws one of its rows
    by hash.  Scored rows are never capped: every row of ``df`` is explained.
    """
    feats = fitted.features
    p = len(feats)
    numeric = [F.col(f).cast("double").alias(f) for f in feats]
    drawn = (background.select(F.xxhash64(F.lit(seed), F.col(key)).alias("_h"), F.col(key).alias("_key"), *numeric)
             .orderBy("_h", "_key", *feats).limit(n_background))
    # One row per background row: at most n_background x p numbers.
    bg = (drawn.withColumn("_no", F.row_number().over(Window.orderBy("_h", "_key", *feats)) - 1)
          .select("_no", F.array(*feats).alias("_z")))
    m = drawn.count()
    if not m:
        raise ValueError("empty background")

    base = df.select(F.col(key).alias("_key"), F.array(*[F.col(f).cast("double") for f in feats]).alias("_x"))
    perm = base.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(n_permutations - 1))))
    order = F.transform(
        F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(p - 1)),
                                 lambda j: F.struct(F.xxhash64(F.col("_key"), F.col("_k"), j, F.lit(seed)).alias("h"),
                                                    j.alias("j")))),
        lambda s: s["j"])
    perm = (perm.withColumn("_order", order)
                .withColumn("_no", F.pmod(F.xxhash64(F.col("_key"), F.col("_k"), F.lit(seed + 1)), F.lit(m)).cast("int"))
                .join(F.broadcast(bg), "_no").drop("_no"))
    def same(j):
        return F.get("_x", j).eqNullSafe(F.get("_z", j))

    # A feature takes the row's value once its position is below the step number, else the background value.
    # Step 0 (the background row) carries the features whose switch changes nothing.
    moved = F.filter(F.sequence(F.lit(1), F.lit(p)), lambda t: ~same(F.get("_order", t - 1)))
    steps = perm.withColumn("_t", F.explode(F.concat(F.array(F.lit(0)), moved)))
    hybrid = steps.select(
        "_key", "_k", "_t", F.when(F.col("_t") > 0, F.array(F.get("_order", F.col("_t") - 1))).otherwise(F.filter("_order", same)).alias("_js"),
        *[F.when(F.array_position(F.col("_order"), F.lit(j)) - 1 < F.col("_t"), F.get("_x", F.lit(j)))
           .otherwise(F.get("_z", F.lit(j))).alias(f) for j, f in enumerate(feats)])
    # Only these five narrow columns are shuffled.
    scored = fitted.score(hybrid, "_f").select("_key", "_k", "_t", "_js", "_f")
    w = Window.partitionBy("_key", "_k").orderBy("_t")
    diffs = (scored.withColumn("_d", F.when(F.col("_t") > 0, F.col("_f") - F.lag("_f").over(w)).otherwise(0.0))
             .select("_key", F.explode("_js").alias("_j"), "_d"))
    names = F.array(*[F.lit(f) for f in feats])
    return (diffs.groupBy(F.col("_key").alias(key), F.element_at(names, F.col("_j") + 1).alias("feature"))
                 .agg(F.avg("_d").alias("attribution"),
                      (F.stddev_samp("_d") / F.sqrt(F.count(F.lit(1)))).alias("std_error")))


# --- exact attribution of tree ensembles -----------------------------------------------

#: Patterns of so many conditions are numbered by a table of all of them.
MOST_BITS = 12
ROWS_AT_ONCE = 1 << 15


@dataclass
class LeafTable:
    """Every leaf of an ensemble as a box: its value and, per feature on its
    path, the interval (low, high] that a row must lie in (padded to the longest path)."""
    features: list[str]
    constant: float
    value: np.ndarray       # (leaf,)
    size: np.ndarray        # (leaf,) number of features on the path
    feature: np.ndarray     # (leaf, most) feature numbers
    low: np.ndarray
    high: np.ndarray

    def inside(self, leaf: int, x: np.ndarray) -> np.ndarray:
        """Rows' patterns: bit k is set where the row is in the interval of the path's k-th feature (NaN goes left)."""
        d = self.size[leaf]
        v, low, high = x[:, self.feature[leaf, :d]], self.low[leaf, :d], self.high[leaf, :d]
        return (~(v > high) & ((v > low) | np.isneginf(low))) @ (1 << np.arange(d))


def _leaf_table(features, constant, trees) -> LeafTable:
    """From trees given as {node: (feature, threshold, left, right) or leaf value} with root 0."""
    leaves = []
    for tree in trees:
        todo = [(0, {})]
        while todo:
            node, box = todo.pop()
            at = tree[node]
            if not isinstance(at, tuple):
                if at:
                    leaves.append((at, box))
                continue
            f, cut, left, right = at
            low, high = box.get(f, (-np.inf, np.inf))
            todo += [(left, {**box, f: (low, min(high, cut))}), (right, {**box, f: (max(low, cut), high)})]
    most = max((len(b) for _, b in leaves), default=0)
    shape = (len(leaves), most)
    feature, low, high = np.zeros(shape, np.int32), np.full(shape, -np.inf), np.full(shape, np.inf)
    for i, (_, box) in enumerate(leaves):
        for k, (f, (a, b)) in enumerate(box.items()):
            feature[i, k], low[i, k], high[i, k] = f, a, b
    return LeafTable(features, constant, np.array([v for v, _ in leaves]), np.array([len(b) for _, b in leaves], np.int64), feature, low, high)


def leaf_table(fitted) -> LeafTable:
    """Leaves of a fitted forest or booster, weighted so that the values of the
    leaves a row falls in add up to: the positive-class probability of a
    forest classifier, the prediction of a regressor, the raw margin of a boosted classifier."""
    if isinstance(fitted, BoostedTrees):
        trees = [{n: (t.feature[n], t.cut[n], t.left[n], t.right[n]) if t.feature[n] >= 0 else fitted.settings.learning_rate * t.value[n]
                  for n in range(len(t.feature))} for t in fitted.trees]
        return _leaf_table(fitted.features, fitted.base, trees)
    # Spark writes a model as a table of its nodes; their number is bounded by the model's settings.
    spark = SparkSession.getActiveSession()
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    fitted.estimator.write().save(path)
    n = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").select(
        "treeID", "id", "prediction", "impurityStats", "leftChild", "rightChild", F.col("split.featureIndex").alias("f"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("cut"), F.col("split.numCategories").alias("cats")).collect()
    weights = list(fitted.estimator.treeWeights)
    boosted = "GBT" in type(fitted.estimator).__name__
    total = 1.0 if boosted else sum(weights)
    trees = [{} for _ in weights]
    for r in n:
        if r["leftChild"] >= 0:
            if r["cats"] != -1:
                raise ValueError("categorical splits have no intervals")
            trees[r["treeID"]][r["id"]] = (r["f"], r["cut"], r["leftChild"], r["rightChild"])
        else:
            value = r["prediction"] if boosted or fitted.kind == "regressor" else r["impurityStats"][1] / sum(r["impurityStats"])
            trees[r["treeID"]][r["id"]] = value * weights[r["treeID"]] / total
    return _leaf_table(fitted.features, 0.0, trees)


def _interventional(table: LeafTable, background: np.ndarray):
    """Function (rows, features) -> exact interventional Shapley values.

    Of one leaf, one row x and one background row z: with A the path's features
    where only x is inside, B those where only z is, and none where neither
    is, a feature of A gets value * (|A| - 1)! |B|! / (|A| + |B|)! and one of B gets
    - value * |A|! (|B| - 1)! / (|A| + |B|)!.  Rows matter through their
    patterns only, so each leaf's sums are made once per pattern that occurs."""
    most = int(table.size.max(initial=0))
    fact = [math.factorial(i) for i in range(2 * most + 1)]
    grid = range(most + 1)
    for_a = np.array([[fact[a - 1] * fact[b] / fact[a + b] if a else 0.0 for b in grid] for a in grid])
    for_b = np.array([[fact[a] * fact[b - 1] / fact[a + b] if b else 0.0 for b in grid] for a in grid])
    known = []
    for leaf in range(len(table.value)):
        z, n = np.unique(table.inside(leaf, background), return_counts=True)
        known.append((z, n / len(background)))

    # Every bound of every interval, once: a leaf's conditions are combined from whole columns of "is above the bound".
    used = np.arange(most)[None, :] < table.size[:, None]
    bounds = sorted({(int(f), float(v)) for side in (table.low, table.high) for f, v in zip(table.feature[used], side[used])})
    place = {b: i for i, b in enumerate(bounds)}

    def attribute(x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(table.features), len(x)))
        above = np.array([x[:, f] > v if np.isfinite(v) else np.full(len(x), v < 0) for f, v in bounds], np.uint16).reshape(len(bounds), len(x))
        for leaf, (z, share) in enumerate(known):
            d = int(table.size[leaf])
            if not d:
                continue
            bits = np.arange(d)
            pattern = np.zeros(len(x), np.uint16 if d <= 16 else np.int64)
            for k in range(d):
                f = int(table.feature[leaf, k])
                pattern |= (above[place[f, float(table.low[leaf, k])]] & ~above[place[f, float(table.high[leaf, k])]]).astype(pattern.dtype) << k
            pattern = pattern.astype(np.int64)
            if d <= MOST_BITS:
                patterns = np.flatnonzero(np.bincount(pattern, minlength=1 << d))
            else:                                              # too many patterns to number them all: those that occur
                patterns, pattern = np.unique(pattern, return_inverse=True)
            reaches = (patterns[:, None] | z[None, :]) == (1 << d) - 1
            alive = reaches.any(1)
            if not alive.any():
                continue
            at = np.flatnonzero(alive)
            not_x, not_z = 1 - ((patterns[at, None] >> bits) & 1), 1 - ((z[:, None] >> bits) & 1)
            reached = reaches[at].astype(float)
            a, b, gains = not_z.sum(1), not_x.sum(1), np.zeros((len(at), d))
            for n in np.unique(b):                             # weights depend on a pattern through their number only
                some = np.flatnonzero(b == n)
                gains[some] = reached[some] @ ((share * for_a[a, n])[:, None] * not_z) - not_x[some] * (reached[some] @ (share * for_b[a, n]))[:, None]
            # Number of the pattern among those that gain anything, 0 for the others.
            number = np.zeros(1 << d if d <= MOST_BITS else len(patterns), np.int64)
            number[patterns[at] if d <= MOST_BITS else at] = np.arange(1, len(at) + 1)
            mine = number[pattern]
            rows = np.flatnonzero(mine)
            mine = mine[rows] - 1
            for k in range(d):
                out[table.feature[leaf, k]][rows] += (table.value[leaf] * gains[:, k])[mine]
        return out.T

    return attribute


def exact_tree_attribution(fitted, df: DataFrame, key: str, background: DataFrame, n_background: int = 100, seed: int = 42) -> DataFrame:
    """Exact interventional Shapley values of a tree ensemble, long form
    ``(key, feature, attribution, base_value)``: a row's attributions add up to
    its score less the base value, the mean score of the background.

    The background is the same bounded sample as in ``monte_carlo_shapley``;
    every row of ``df`` is explained, in one pass without a shuffle."""
    feats = fitted.features
    numeric = [F.col(f).cast("double").alias(f) for f in feats]
    drawn = (background.select(F.xxhash64(F.lit(seed), F.col(key)).alias("_h"), F.col(key).alias("_key"), *numeric)
             .orderBy("_h", "_key", *feats).limit(n_background).collect())
    if not drawn:
        raise ValueError("empty background")
    table = leaf_table(fitted)
    z = np.array([[np.nan if r[f] is None else r[f] for f in feats] for r in drawn], float)
    full = [(1 << int(d)) - 1 for d in table.size]
    base = table.constant + sum(v * float((table.inside(i, z) == full[i]).mean()) for i, v in enumerate(table.value))
    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        # What a leaf's patterns gain is found once for many rows.
        attribute, held, n = _interventional(table, z), [], 0

        def done():
            return pd.Series(list(attribute(np.concatenate(held))), dtype=object)

        for rows in batches:
            held.append(rows.to_numpy(float))
            n += len(rows)
            if n >= ROWS_AT_ONCE:
                yield done()
                held, n = [], 0
        if n:
            yield done()

    values = F.pandas_udf(explain, "array<double>")(F.struct(*[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(feats)]))
    names = F.array(*[F.lit(f) for f in feats])
    pairs = df.select(key, F.explode(F.arrays_zip(names.alias("feature"), values.alias("attribution"))).alias("_p"))
    return pairs.select(key, F.col("_p.feature").alias("feature"), F.col("_p.attribution").alias("attribution"), F.lit(float(base)).alias("base_value"))
