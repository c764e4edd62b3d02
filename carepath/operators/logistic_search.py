"""Cross-validated search of logistic regressions on shared passes (H1).

Every draw on every fold minimises what Spark's solver does without
standardization, sum(w loss) / sum(w) + l2 |v|^2 / 2 + l1 |v|_1 with a free
intercept, by Newton steps.  All fits advance in step: a pass over the rows
returns loss, gradient and second derivatives of every fit that is not done,
so the number of passes is that of the slowest fit, not the sum over fits.

* The rows are written once, in blocks of one fold and at most ``BLOCK`` rows; a row is
  seen by the fits that don't hold out its fold.  Features are shifted
  and scaled inside (penalties follow), constant ones have coefficient 0.
* The driver holds features squared numbers per fit: an l2 step is a linear system, an
  l1 step coordinate descent on the same matrix; a step that doesn't lower the objective is halved.
* The held-out AUC is exact, ties by half.  Scores are cut into ranges at approximate quantiles,
  pairs are counted by a window per (draw, fold, range), and ranges are joined by their totals.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carepath.operators import moments as mo
from carepath.operators.hist_boost import FAN, LEAST_ROWS, MOST_ROWS, _CELLS, _summed
from carepath.session import checkpoint

# Functions of this module go to the executors by value, so these need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK, CHUNK = 1 << 13, 1 << 11
TOLERANCE, PASSES = 1e-10, 100
_BLOCK = "fold int, y binary, w binary, z binary"
_LONG = "draw int, fold int, rg int, score double, pos long, neg long"


@dataclass
class Fit:
    """One draw on the rows outside one fold: where it is (``at``), the step tried, what is known where it is."""
    draw: int
    fold: int
    l1: np.ndarray                # per coefficient; the intercept, last, has 0
    l2: np.ndarray
    total: float                  # weight of its rows
    at: np.ndarray
    tried: np.ndarray
    objective: float = np.inf
    share: float = 1.0
    step: np.ndarray | None = None
    promised: float = 0.0
    done: bool = False

    def penalty(self, v: np.ndarray) -> float:
        return float(self.l2 @ (v * v) / 2 + self.l1 @ np.abs(v))

    def tell(self, loss: float, gradient: np.ndarray, second: np.ndarray):
        """Results at ``tried`` (sums over rows): go there and choose the next step, or halve the last one."""
        value = loss / self.total + self.penalty(self.tried)
        slack = 1e-12 * max(1.0, abs(value))
        if self.step is not None and not value <= self.objective + 1e-4 * self.share * self.promised + slack:
            self.share /= 2
            if self.share < 1e-10:
                self.done = True
            self.tried = self.at + self.share * self.step
            return
        self.at, self.objective, self.share = self.tried, value, 1.0
        g, h = gradient / self.total, second / self.total
        target = self._minimum(g, h)
        self.step = target - self.at
        self.promised = float(g @ self.step) + self.penalty(target) - self.penalty(self.at)
        self.tried = target
        if -self.promised <= TOLERANCE * max(abs(value), 1e-300):   # the step left is taken unseen
            self.at, self.done = target, True

    def _minimum(self, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Minimum of the second-order model of the loss plus the penalty."""
        if not self.l1.any():
            return self.at + np.linalg.lstsq(h + np.diag(self.l2), -(g + self.l2 * self.at), rcond=None)[0]
        u, pull = self.at.copy(), g - h @ self.at                   # slope of the model at u: pull + h u
        down = np.diag(h) + self.l2
        for _ in range(1000):
            most = 0.0
            for j in range(len(u) - 1, -1, -1):
                if down[j] <= 0:
                    continue
                rho = h[j, j] * u[j] - pull[j] - h[j] @ u
                new = np.sign(rho) * max(abs(rho) - self.l1[j], 0.0) / down[j]
                most = max(most, abs(new - u[j]) * np.sqrt(down[j]))
                u[j] = new
            if most <= 1e-11:
                break
        return u


def _blocks(df: DataFrame, features: list[str], label: str, fold: str, weight: str, mean: np.ndarray, spread: np.ndarray, rows: int) -> DataFrame:
    """The rows as blocks of one fold, written once: label, weight, scaled features and, last, a one."""
    p = len(features)

    def block(k, parts):
        x = np.concatenate(parts)
        if not np.isin(x[:, 0], (0.0, 1.0)).all():
            raise ValueError("a label that is neither 0 nor 1")
        z = np.column_stack([(x[:, 2:] - mean) / spread, np.ones(len(x))])
        cells = [pa.array([k], pa.int32())] + [pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for c in (x[:, 0], x[:, 1], z)]
        return pa.RecordBatch.from_arrays(cells, names=["fold", "y", "w", "z"])

    def task(batches):
        held: dict[int, list] = {}
        for batch in batches:
            x = np.stack([batch.column(i + 1).to_numpy(zero_copy_only=False).astype(float) for i in range(p + 2)], 1)
            at = batch.column(0).to_numpy(zero_copy_only=False)
            for k in np.unique(at):
                mine = x[at == k]
                while len(mine):
                    parts = held.setdefault(int(k), [])
                    room = BLOCK - sum(map(len, parts))
                    parts.append(mine[:room])
                    mine = mine[room:]
                    if sum(map(len, parts)) == BLOCK:
                        yield block(int(k), held.pop(int(k)))
        for k, parts in sorted(held.items()):
            yield block(k, parts)

    columns = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate([label, weight, *features])]
    parts = max(1, -(-rows // MOST_ROWS), min(FAN, -(-rows // LEAST_ROWS)))
    return checkpoint(df.select(F.col(fold).cast("int").alias("fold"), *columns).mapInArrow(task, _BLOCK).repartition(parts))


def _arrays(batch: pa.RecordBatch, q: int):
    """(fold, y, w, z) of each block of a batch."""
    get = lambda c, i: np.frombuffer(batch.column(batch.schema.get_field_index(c))[i].as_buffer(), float)
    for i in range(batch.num_rows):
        yield batch.column(batch.schema.get_field_index("fold"))[i].as_py(), get("y", i), get("w", i), get("z", i).reshape(-1, q)


def _pass(work: DataFrame, parts: int, fits: list[Fit], q: int):
    """Loss, gradient and second derivatives of every fit at the point it tries, in one pass."""
    first, second = np.triu_indices(q)
    folds, points = np.array([f.fold for f in fits]), np.stack([f.tried for f in fits], 1)
    shape = (len(fits), 1 + q + len(first))

    def task(batches):
        from pyspark import TaskContext
        total = np.zeros(shape)
        for batch in batches:
            for k, y, w, z in _arrays(batch, q):
                mine = np.flatnonzero(folds != k)
                if not len(mine):
                    continue
                at = points[:, mine]
                for a in range(0, len(y), CHUNK):
                    x, yy, ww = z[a:a + CHUNK], y[a:a + CHUNK, None], w[a:a + CHUNK, None]
                    m = x @ at
                    e = np.exp(-np.abs(m))
                    prob = np.where(m >= 0, 1.0, e) / (1.0 + e)
                    total[mine, 0] += (ww * (np.log1p(e) + np.maximum(m, 0.0) - yy * m)).sum(0)
                    total[mine, 1:1 + q] += (x.T @ (ww * (prob - yy))).T
                    total[mine, 1 + q:] += ((x[:, first] * x[:, second]).T @ (ww * prob * (1.0 - prob))).T
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                         names=["part", "cells"])

    for fit, sums in zip(fits, _summed(work.mapInArrow(task, _CELLS), parts, shape)):
        h = np.zeros((q, q))
        h[first, second] = h[second, first] = sums[1 + q:]
        fit.tell(float(sums[0]), sums[1:1 + q], h)


def held_out_auc(work: DataFrame, points: dict[tuple[int, int], np.ndarray], draws: int, q: int) -> dict[tuple[int, int], float]:
    """{(draw, fold): AUC} of the fit of each draw that doesn't see the fold; as Spark's evaluator
    has it, 0 without positive and 1 without negative rows."""
    def scores(k, z):
        # Column by column: equal rows must have equal scores wherever they stand in a block.
        for d in range(draws):
            v, s = points[d, k], np.zeros(len(z))
            for j in range(q):
                s += z[:, j] * v[j]
            yield d, s + 0.0

    def wide(batches):
        for batch in batches:
            for k, _, _, z in _arrays(batch, q):
                yield pa.RecordBatch.from_arrays([pa.array(s) for _, s in scores(k, z)], names=[f"s{d}" for d in range(draws)])

    ranges = max(1, int(work.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")))
    probs = [i / ranges for i in range(1, ranges)]
    table = work.mapInArrow(wide, ", ".join(f"s{d} double" for d in range(draws)))
    cuts = [np.unique(c) for c in (table.approxQuantile([f"s{d}" for d in range(draws)], probs, 0.001) if probs else [[]] * draws)]

    def long(batches):
        for batch in batches:
            for k, y, _, z in _arrays(batch, q):
                pos = (y > 0.5).astype(np.int64)
                for d, s in scores(k, z):
                    ints = [pa.array(np.full(len(s), v, np.int32)) for v in (d, k)]
                    yield pa.RecordBatch.from_arrays([*ints, pa.array(np.searchsorted(cuts[d], s).astype(np.int32)), pa.array(s), pa.array(pos), pa.array(1 - pos)],
                                                     names=["draw", "fold", "rg", "score", "pos", "neg"])

    group = ["draw", "fold", "rg"]
    w = Window.partitionBy(*group).orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = work.mapInArrow(long, _LONG).groupBy(*group, "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    # Twice the number of pairs in order within the range, ties by half.
    pairs = counts.withColumn("above", F.sum("pos").over(w)).groupBy(*group).agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum(F.col("neg") * (2 * F.col("above") - F.col("pos"))).alias("twice"))
    by: dict[tuple[int, int], list] = {}
    for r in sorted(pairs.collect(), key=lambda r: -r["rg"]):
        pos, neg, twice = by.get((r["draw"], r["fold"]), (0, 0, 0))
        by[r["draw"], r["fold"]] = pos + r["pos"], neg + r["neg"], twice + r["twice"] + 2 * pos * r["neg"]
    return {key: 0.0 if not pos else 1.0 if not neg else twice / (2 * pos * neg) for key, (pos, neg, twice) in by.items()}


def cross_validated(df: DataFrame, features: list[str], label: str, weight: str, fold: str, penalties: list[tuple[float, float]]) -> list[float]:
    """Mean held-out AUC over the folds for each (l1, l2) of ``penalties``."""
    moments = mo.fold_moments(df, features, label, fold)
    if len(moments) < 2:
        raise ValueError("cross-validation needs rows in two folds")
    every = mo.total(moments)
    spread = np.sqrt(np.maximum(np.diag(every.square)[:-1], 0.0) / every.n)
    mean = every.mean[:-1]
    moves = spread > 1e-12 * np.maximum(1.0, np.abs(mean))
    used, mean, spread = [f for f, m in zip(features, moves) if m], mean[moves], spread[moves]
    y, w = F.col(label).cast("double"), F.col(weight).cast("double")
    sums = {r["k"]: r for r in df.groupBy(F.col(fold).alias("k")).agg(F.sum(w).alias("w"), F.sum(w * y).alias("wy")).collect()}
    work = _blocks(df, used, label, fold, weight, mean, spread, int(every.n))
    parts, q = work.rdd.getNumPartitions(), len(used) + 1      # of the written table; nothing is run
    fits = []
    for d, (l1, l2) in enumerate(penalties):
        for k in sorted(moments):
            all_w, all_wy = (sum(r[c] for j, r in sums.items() if j != k) for c in ("w", "wy"))
            at = np.zeros(q)
            one_class = not 0 < all_wy < all_w
            if not one_class:
                at[-1] = np.log(all_wy / (all_w - all_wy))
            fits.append(Fit(d, k, np.append(l1 / spread, 0.0), np.append(l2 / spread ** 2, 0.0), all_w, at, at, done=one_class))
    for _ in range(PASSES):
        open_ = [f for f in fits if not f.done]
        if not open_:
            break
        _pass(work, parts, open_, q)
    auc = held_out_auc(work, {(f.draw, f.fold): f.at for f in fits}, len(penalties), q)
    return [sum(auc[d, k] for k in sorted(moments)) / len(moments) for d in range(len(penalties))]
