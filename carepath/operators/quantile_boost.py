"""Gradient-boosted quantile regression, all quantiles at once.

Per round one tree for each quantile is fitted to the negative gradient of the
pinball loss, ``q - 1[y <= prediction]``, and each of its leaves steps by the
q-quantile of its residuals.  The trees grow in step on the binned matrix of
``hist_boost``: a pass gives the histograms that every quantile's tree asks
for, and a few passes give all leaf steps, so a round costs as many
jobs for three quantiles as for one.  A gradient is one of two numbers, so a
histogram is two counts; features of few bins are counted in joint cells.

Predictions never cross: a row's predictions are put in rising order over the
quantiles (which can only lower the pinball loss).

Start values are actual values from one mergeable sketch, their rank off by a
share of at most 1 / ``ACCURACY``.  Leaf steps are exact: tasks send the ends of
a bounded number of sorted runs of their residuals, which bound the wanted rank's value;
only values between the bounds are looked at again, until both are one value.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names, not the module: what goes to the executors by value stays small.
from carepath.operators.hist_boost import (_CELLS, Boosting, Tree, _advance, _ByValue, _summed, binned, blocks_of, ends_by_bin, feature_cuts,
                                           grow_together, growing, refreshed)

# Functions of this module go to the executors by value, so these need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ACCURACY = 100_000
MAX_BINS = 64
JOINT = 1 << 9                      # most cells of features that are counted together


def quantile_name(q: float) -> str:
    return f"q{int(round(q * 100))}"


@dataclass
class QuantileTrees:
    """Boosters of several quantiles: start value + learning rate x sum of leaf steps, in rising order."""
    features: list[str]
    label: str
    quantiles: list[float]
    learning_rate: float
    base: list[float]
    cuts: list[list[float]]
    trees: list[list[Tree]] = field(default_factory=list)        # by quantile, then round

    def __iter__(self):
        return iter(quantile_name(q) for q in self.quantiles)

    def raw(self, x: np.ndarray) -> np.ndarray:
        """(row, quantile) predictions."""
        out = np.tile(np.array(self.base), (len(x), 1))
        for i, trees in enumerate(self.trees):
            for t in trees:
                out[:, i] += self.learning_rate * np.array(t.value)[t.leaves_of(_ByValue(t, x))]
        # Rising over the quantiles, whatever order they were given in.
        order = np.argsort(self.quantiles)
        out[:, order] = np.sort(out, axis=1)
        return out

    def predict(self, df: DataFrame, target: str) -> DataFrame:
        """Add ``predicted_<target>_<q>`` for every quantile."""
        def work(rows: pd.DataFrame) -> pd.Series:
            return pd.Series(list(self.raw(rows.to_numpy(float))), dtype=object)

        columns = F.struct(*[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(self.features)])
        out = df.withColumn("_quantiles", F.pandas_udf(work, "array<double>")(columns))
        return out.withColumns({f"predicted_{target}_{name}": F.get("_quantiles", F.lit(i)) for i, name in enumerate(self)}).drop("_quantiles")


def _packs(sizes: list[int]) -> list[list[int]]:
    """Features (by their numbers of bins) dealt into packs of at most ``JOINT`` joint cells: flags are counted by the dozen."""
    packs: list[list[int]] = []
    room = 0
    for j in sorted(range(len(sizes)), key=lambda j: (-sizes[j], j)):
        if sizes[j] > room:
            packs.append([])
            room = JOINT
        packs[-1].append(j)
        room //= sizes[j]
    return packs


def _marginal(total: np.ndarray, joint: np.ndarray, pack: list[int], sizes: list[int]):
    """Write a pack's counts by (node, below, joint cell) to (node, below, feature, bin)."""
    joint = joint.reshape(len(total), 2, *[sizes[j] for j in pack])
    for i, j in enumerate(pack):
        total[:, :, j, :sizes[j]] = joint.sum(tuple(2 + k for k in range(len(pack)) if k != i))


def _codes(bins: np.ndarray, sizes: list[int], packs: list[list[int]]) -> list[np.ndarray]:
    """Each row's joint cell in every pack."""
    out = []
    for pack in packs:
        code = bins[pack[0]].astype(np.int32)
        for j in pack[1:]:
            code *= sizes[j]
            code += bins[j]
        out.append(code)
    return out


def _chunks(values: np.ndarray, low: float, high: float, keep: int, name: tuple[int, int]) -> np.ndarray:
    """A task's values of leaf ``name`` from ``low`` to ``high`` (NaN: any) as at most ``keep``
    runs in rising order, and one of all that are less: rows (quantile, leaf, least, largest, number of values).
    A value that fills a run is a run of its own: one that shared it with others would bound the rank no better the next time."""
    below = int((values < low).sum())
    inside = np.sort(values if np.isnan(high) else values[(values >= low) & (values <= high)])
    at = inside[::max(1, -(-2 * len(inside) // keep))]
    start = np.unique(np.r_[np.searchsorted(inside, at, "left"), np.searchsorted(inside, at, "right")])
    start = start[start < len(inside)]
    end = np.r_[start[1:], len(inside)] if len(start) else start
    out = np.empty((len(start) + (below > 0), 5))
    out[:, :2] = name
    out[:len(start), 2], out[:len(start), 3], out[:len(start), 4] = inside[start], inside[end - 1], end - start
    if below:
        out[-1, 2:] = -np.inf, -np.inf, below
    return out


def _bracket(chunks: np.ndarray, rank: int) -> tuple[float, float]:
    """Bounds of the ``rank``-th smallest (from 1) of the values that ``chunks`` stand for: equal once it is known."""
    by_low, by_high = chunks[np.argsort(chunks[:, 2])], chunks[np.argsort(chunks[:, 3])]
    before = np.cumsum(by_low[:, 4]) - by_low[:, 4]
    low = by_low[np.searchsorted(before, rank - 1, side="right") - 1, 2]
    return low, by_high[np.searchsorted(np.cumsum(by_high[:, 4]), rank), 3]


def fit_quantile_set(train: DataFrame, features: list[str], label: str, quantiles: tuple[float, ...] = (0.5, 0.75, 0.9),
                     n_stages: int = 100, max_depth: int = 4, learning_rate: float = 0.1, checkpoint_every: int = 10,
                     max_bins: int = MAX_BINS) -> QuantileTrees:
    """Fit the boosters of all ``quantiles`` together."""
    quantiles = [float(q) for q in quantiles]
    y = F.col(label).cast("double")
    first = train.agg(F.percentile_approx(y, quantiles, ACCURACY).alias("q"), F.count(F.lit(1)).alias("n")).first()
    if first["q"] is None:
        raise ValueError("no training rows")
    base, p, n = [float(v) for v in first["q"]], len(features), len(quantiles)
    model = QuantileTrees(features, label, quantiles, learning_rate, base, feature_cuts(train, features, max_bins), [[] for _ in quantiles])
    n_bins = max(2, max(len(c) for c in model.cuts) + 1)
    work = binned(train, features, label, model.cuts, base, first["n"], tasks=train.sparkSession.sparkContext.defaultParallelism)
    parts = work.rdd.getNumPartitions()                         # of the written table; nothing is run
    settings = Boosting(loss="squared", max_leaves=None, max_depth=max_depth, min_rows=1, min_hessian=1.0)
    columns = np.arange(p)
    pending: list[list[Tree]] = [[] for _ in quantiles]

    sizes = [max(2, len(c) + 1) for c in model.cuts]
    packs = _packs(sizes)

    def histograms(asked):
        """One pass for the requests of all quantiles' trees: rows at or below their prediction and above it
        are counted, and gradients follow from the counts."""
        orders, begin, size = [], [], 0
        for a in asked:
            orders.append(None)
            begin.append(size)
            if a is not None:
                orders[-1] = np.full(len(a[0].feature), 2 * len(a[1]))
                orders[-1][a[1]] = 2 * np.arange(len(a[1]))
                size += len(a[1])
        # A row's place is 2 x node + below; rows of other nodes are past the last one and left out.
        shape, at = (size, 2, p, n_bins), [list(x) for x in pending]

        def task(batches):
            from pyspark import TaskContext
            total, cells = np.zeros(shape), [int(np.prod([sizes[j] for j in pack])) for pack in packs]
            joint = [[np.zeros(2 * len(a[1]) * size, np.int64) if a is not None else None for size in cells] for a in asked]
            for batch in batches:
                for _, truth, _, scores, bins in blocks_of(batch, p, n):
                    codes = _codes(bins, sizes, packs)
                    for i, a in enumerate(asked):
                        if a is None:
                            continue
                        place = orders[i][ends_by_bin(a[0], bins)] + (truth <= _advance(scores[i], bins, at[i], learning_rate))
                        for found, code, size in zip(joint[i], codes, cells):
                            found += np.bincount(place * size + code, minlength=len(found))[:len(found)]
            for i, a in enumerate(asked):
                for pack, found in zip(packs, joint[i] if a is not None else []):
                    _marginal(total[begin[i]:begin[i] + len(a[1])], found, pack, sizes)
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                             names=["part", "cells"])

        above, below = _summed(work.mapInArrow(task, _CELLS), parts, shape).transpose(1, 0, 2, 3)
        q = np.repeat(quantiles, [0 if a is None else len(a[1]) for a in asked])[:, None, None]
        sums = np.stack([below * (1 - q) - above * q, below + above, below + above], axis=1)
        return [None if a is None else {node: sums[begin[i] + k] for k, node in enumerate(a[1])} for i, a in enumerate(asked)]

    def leaf_steps(trees):
        """{(quantile, leaf): quantile of the residuals of its rows}, by rank: the ceil(q n)-th smallest."""
        at, keep = [list(x) for x in pending], max(32, (1 << 13) // parts)
        within: dict[tuple[int, int], tuple[float, float]] = {}
        found: dict[tuple[int, int], float] = {}
        rank: dict[tuple[int, int], int] = {}

        def task(batches, within=within):
            from pyspark import TaskContext
            held: dict[tuple[int, int], list] = {}
            for batch in batches:
                for _, truth, _, scores, bins in blocks_of(batch, p, n):
                    for i, t in enumerate(trees):
                        wanted = [w for w in within if w[0] == i]
                        if within and not wanted:
                            continue
                        leaf, r = ends_by_bin(t, bins), truth - _advance(scores[i], bins, at[i], learning_rate)
                        for w in wanted or [(i, int(x)) for x in np.flatnonzero(np.bincount(leaf))]:
                            held.setdefault(w, []).append(r[leaf == w[1]])
            chunks = [_chunks(np.concatenate(v), *within.get(w, (-np.inf, np.nan)), keep, w) for w, v in held.items()]
            if chunks:
                yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()),
                                                  pa.array([np.concatenate(chunks).tobytes()], pa.binary())], names=["part", "cells"])

        while not found or within:
            rows = np.concatenate([np.frombuffer(r["cells"]).reshape(-1, 5) for r in work.mapInArrow(task, _CELLS).collect()])
            order = np.lexsort((rows[:, 1], rows[:, 0]))
            rows = rows[order]
            starts = np.flatnonzero(np.r_[True, (np.diff(rows[:, 0]) != 0) | (np.diff(rows[:, 1]) != 0)])
            within.clear()
            for c in np.split(rows, starts[1:]):
                w = (int(c[0, 0]), int(c[0, 1]))
                if w not in rank:
                    rank[w] = max(1, int(np.ceil(quantiles[w[0]] * c[:, 4].sum())))
                low, high = _bracket(c, rank[w])
                if low == high or np.isnan(high):
                    found[w] = high
                else:
                    within[w] = (low, high)
        return found

    for _ in range(n_stages):
        if len(pending[0]) >= checkpoint_every:
            work, pending = refreshed(work, pending, learning_rate, p), [[] for _ in quantiles]
        trees = grow_together([growing(settings, model.cuts, columns) for _ in quantiles], histograms)
        steps = leaf_steps(trees)
        for i, t in enumerate(trees):
            t.value = [steps.get((i, node), 0.0) if f < 0 else 0.0 for node, f in enumerate(t.feature)]
            model.trees[i].append(t)
            pending[i].append(t)
    return model


def predict_quantiles(models: QuantileTrees, df: DataFrame, target: str) -> DataFrame:
    """``predicted_<target>_<q>`` per quantile beside the input columns."""
    return models.predict(df, target)
