"""Boosted trees on a binned matrix: leaf-wise (M3, M9) and second-order (M4).

* Features are cut at approximate quantiles into at most ``max_bins`` bins; the
  matrix of bin numbers (one byte a cell, feature by feature) is written once
  with label, weight and running score, in blocks of at most ``BLOCK`` rows: a
  block is one table row of a few byte strings, so that a pass costs a copy of
  these bytes and no work per row outside numpy.
* A tree grows from histograms of gradient, second derivative and row count
  per (node, feature, bin).  Tasks add up the histograms of their rows and return
  one array each; arrays are added over groups of ``FAN`` partitions until few
  are left, so what reaches the driver is bounded by nodes x features x bins,
  not by rows or partitions.
* Only the smaller child of a split is scanned; its sibling is the parent's
  histogram less that.  The sums of the last children come from their parent.
* ``leafwise`` growth always splits the leaf of the largest gain, up to
  ``max_leaves`` and ``max_depth``.  A pass finds the histograms one level below
  all nodes that later choices may reach, so a tree takes as many
  passes as it is deep, not as many as it has splits.  Level growth (no
  ``max_leaves``) splits all leaves of a level, one pass each.
* Gain is G_l^2 / (H_l + lambda) + G_r^2 / (H_r + lambda) - G^2 / (H + lambda),
  a leaf's value -G / (H + lambda): one Newton step on the loss.
* A tree may see a share of the rows (by hash of row key and tree, the same in
  every run) and one mask of the columns.

Trees since the last refresh are applied to the bytes inside the tasks; every
``refresh`` rounds the scores are advanced and the table is written anew
(``checkpoint``), so the lineage stays short and a lost executor costs a
rescan.  Null and NaN features are a bin of their own, left of every cut.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carepath.session import checkpoint

# Functions of this module go to the executors by value, so these need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FAN, MOST_ROWS, LEAST_ROWS, BLOCK = 64, 1 << 18, 1 << 16, 1 << 15
PASS_ROWS = 2 * MOST_ROWS
_BLOCK = "k binary, y binary, w binary, score binary, bins binary"
_CELLS = "part int, cells binary"
_SEED_MIX, _TREE_MIX = np.uint64(0xBF58476D1CE4E5B9), 0x9E3779B97F4A7C15


@dataclass
class Tree:
    """Arrays by node: feature (-1: a leaf), bin and cut of the split (left: bin <= split bin), children, value."""
    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    cut: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, bin_: int, cut: float) -> tuple[int, int]:
        for values, new in ((self.feature, -1), (self.bin, 0), (self.cut, 0.0), (self.left, -1), (self.right, -1), (self.value, 0.0)):
            values += [new, new]
        self.feature[node], self.bin[node], self.cut[node] = feature, bin_, cut
        self.left[node], self.right[node] = len(self.feature) - 2, len(self.feature) - 1
        return self.left[node], self.right[node]

    def leaves_of(self, goes_left) -> np.ndarray:
        """Node where each row ends; ``goes_left(rows, features, nodes)`` decides a step."""
        f, left, right = (np.array(x) for x in (self.feature, self.left, self.right))
        at = np.zeros(goes_left.n, np.int64)
        todo = np.flatnonzero(f[at] >= 0)
        while len(todo):
            nodes = at[todo]
            at[todo] = np.where(goes_left(todo, f[nodes], nodes), left[nodes], right[nodes])
            todo = todo[f[at[todo]] >= 0]
        return at


class _ByValue:
    """Steps by feature values (scoring)."""
    def __init__(self, tree: Tree, x: np.ndarray):
        self.x, self.cut, self.n = x, np.array(tree.cut), len(x)

    def __call__(self, rows, features, nodes):
        return ~(self.x[rows, features] > self.cut[nodes])      # NaN goes left


@dataclass
class Boosting:
    """Settings of one booster.  ``loss`` is 'logistic' or 'squared'."""
    loss: str = "logistic"
    rounds: int = 100
    learning_rate: float = 0.1
    max_leaves: int | None = 31
    max_depth: int = 6
    min_rows: int = 20
    min_hessian: float = 1e-3
    reg_lambda: float = 0.0
    subsample: float = 1.0
    colsample: float = 1.0
    positive_weight: float = 1.0
    max_bins: int = 64
    seed: int = 42
    refresh: int = 10

    def gradients(self, y, w, score):
        if self.loss == "logistic":
            p = 1 / (1 + np.exp(-score))
            w = np.where(y > 0, w * self.positive_weight, w)
            return w * (p - y), np.maximum(w * p * (1 - p), 1e-16)
        return w * (score - y), w

    def sampled(self, keys: np.ndarray, tree: int) -> np.ndarray | None:
        """Which rows tree number ``tree`` sees (None: all)."""
        if self.subsample >= 1:
            return None
        shift = (_TREE_MIX * (tree + 1) + self.seed) % (1 << 64)
        h = keys.astype(np.uint64) + np.uint64(shift)
        h = (h ^ (h >> np.uint64(30))) * _SEED_MIX
        h ^= h >> np.uint64(31)
        return (h >> np.uint64(11)).astype(float) / float(1 << 53) < self.subsample

    def columns(self, p: int, tree: int) -> np.ndarray:
        """The columns that tree number ``tree`` may split on."""
        n = max(1, int(round(self.colsample * p)))
        return np.sort(np.random.default_rng([self.seed, tree]).permutation(p)[:n])


@dataclass
class BoostedTrees:
    """A fitted booster: raw score = base + learning rate x sum of leaf values."""
    features: list[str]
    settings: Boosting
    base: float
    cuts: list[list[float]]
    trees: list[Tree] = field(default_factory=list)

    def raw(self, x: np.ndarray, rounds: int | None = None) -> np.ndarray:
        out = np.full(len(x), self.base)
        for t in self.trees[:rounds]:
            out += self.settings.learning_rate * np.array(t.value)[t.leaves_of(_ByValue(t, x))]
        return out

    def score(self, df: DataFrame, out: str, rounds: int | None = None) -> DataFrame:
        """Add the positive-class probability (logistic) or the prediction."""
        logistic = self.settings.loss == "logistic"

        def predict(rows: pd.DataFrame) -> pd.Series:
            raw = self.raw(rows.to_numpy(float), rounds)
            return pd.Series(1 / (1 + np.exp(-raw)) if logistic else raw)

        columns = F.struct(*[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(self.features)])
        return df.withColumn(out, F.pandas_udf(predict, "double")(columns))

    def importance(self) -> list[tuple[str, float]]:
        """Number of splits per feature."""
        counts = np.bincount([f for t in self.trees for f in t.feature if f >= 0], minlength=len(self.features))
        return list(zip(self.features, counts.astype(float).tolist()))


# --- binning ---------------------------------------------------------------------------

def feature_cuts(df: DataFrame, features: list[str], max_bins: int, accuracy: int = 10_000) -> list[list[float]]:
    """Rising cut points per feature, at most ``max_bins`` - 1: the distinct
    approximate quantiles below the largest value (one aggregate), after
    minus infinity where values are missing, so that these have a bin."""
    probs = [i / max_bins for i in range(1, max_bins)]
    x = [F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")) for f in features]
    row = df.agg(*[F.percentile_approx(c, probs, accuracy).alias(f"q{i}") for i, c in enumerate(x)],
                 *[F.max(c).alias(f"m{i}") for i, c in enumerate(x)],
                 *[F.count_if(c.isNull()).alias(f"n{i}") for i, c in enumerate(x)]).first()
    return [([float("-inf")] if row[f"n{i}"] else []) + sorted({v for v in row[f"q{i}"] or [] if v < row[f"m{i}"]})
            for i in range(len(features))]


def binned(df: DataFrame, features: list[str], label: str, cuts: list[list[float]], base: list[float], rows: int, key: Column | None = None,
           weight: str | None = None, tasks: int | None = None) -> DataFrame:
    """The binned matrix of ``df`` (``rows`` rows) as blocks, written once, with a score
    for each value of ``base``; ``k`` (a number per row) and ``w`` are empty without key and weight.
    ``tasks``: how many run at once; a task of a pass costs a tenth of a second, whatever it reads."""
    edges, p, keyed, weighted = [np.array(c) for c in cuts], len(features), key is not None, weight is not None

    def block(table: pa.Table):
        get = lambda c: table.column(c).to_numpy()
        bins = np.zeros((p, len(table)), np.uint8)
        for j, e in enumerate(edges):
            x = get(f"x{j}").astype(float)
            bins[j] = np.where(np.isnan(x), 0, np.searchsorted(e, x, side="left"))
        score = np.repeat(np.array(base, float), len(table))
        cells = [get("k").astype(np.int64) if keyed else b"", get("y").astype(float), get("w").astype(float) if weighted else b"", score, bins]
        return pa.RecordBatch.from_arrays([pa.array([bytes(c)], pa.binary()) for c in cells], names=["k", "y", "w", "score", "bins"])

    def blocks(batches):
        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, BLOCK - n)
                batch = batch.slice(part.num_rows)
                held.append(part)
                n += part.num_rows
                if n == BLOCK:
                    yield block(pa.Table.from_batches(held))
                    held, n = [], 0
        if n:
            yield block(pa.Table.from_batches(held))

    columns = df.select(*([key.alias("k")] if keyed else []), F.col(label).cast("double").alias("y"),
                        *([F.col(weight).cast("double").alias("w")] if weighted else []),
                        *[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)])
    # Blocks are dealt evenly, however the rows came: over as many tasks as one reduction takes (and run at once), or more of MOST_ROWS (PASS_ROWS) rows.
    parts = max(1, -(-rows // (PASS_ROWS if tasks else MOST_ROWS)), min(FAN, -(-rows // LEAST_ROWS), tasks or FAN))
    return checkpoint(columns.mapInArrow(blocks, _BLOCK).repartition(parts))


def blocks_of(batch: pa.RecordBatch, p: int, scores: int = 1):
    """(k, y, w, (score, row) scores, (feature, row) bins) of each block of a batch; k and w may be None."""
    get = lambda c, i, t: np.frombuffer(batch.column(batch.schema.get_field_index(c))[i].as_buffer(), t)
    for i in range(batch.num_rows):
        k, y, w = get("k", i, np.int64), get("y", i, float), get("w", i, float)
        yield (k if len(k) else None, y, w if len(w) else None, get("score", i, float).reshape(scores, -1), get("bins", i, np.uint8).reshape(p, -1))


def ends_by_bin(tree: Tree, bins: np.ndarray) -> np.ndarray:
    """Node where each column of ``bins`` ends: from the leaves up, every split
    picks between what its children found, over the whole block at once."""
    kind = np.uint8 if len(tree.feature) <= 256 else np.int32
    found: dict[int, np.ndarray] = {}
    for node in range(len(tree.feature) - 1, -1, -1):         # children have larger numbers than their parent
        f = tree.feature[node]
        if f < 0:
            found[node] = kind(node)
        else:                                                 # by bits, which is ten times as fast as np.where
            left, right = found.pop(tree.left[node]), found.pop(tree.right[node])
            goes_right = (bins[f] > tree.bin[node]).view(np.uint8).astype(kind, copy=False)
            found[node] = left ^ ((left ^ right) & np.negative(goes_right))
    return np.broadcast_to(found[0], bins.shape[1:])


def _advance(score, bins, trees: list[Tree], rate: float):
    for i, t in enumerate(trees):
        step = (rate * np.array(t.value))[ends_by_bin(t, bins)]
        score = np.add(score, step, out=score if i else None)      # the score given stays as it is
    return score


def refreshed(work: DataFrame, pending: list[list[Tree]], rate: float, p: int) -> DataFrame:
    """The blocks with each score advanced by its pending trees, written anew."""
    def advance(batches):
        for batch in batches:
            if batch.num_rows:
                new = [np.stack([_advance(s, bins, trees, rate) for s, trees in zip(scores, pending)]).tobytes()
                       for _, _, _, scores, bins in blocks_of(batch, p, len(pending))]
                yield batch.set_column(batch.schema.get_field_index("score"), "score", pa.array(new, pa.binary()))

    return checkpoint(work.mapInArrow(advance, _BLOCK))


# --- histograms -------------------------------------------------------------------------

def _summed(cells: DataFrame, parts: int, shape: tuple) -> np.ndarray:
    """Sum of one array per partition, in partition order (so that it is the
    same in every run); groups of ``FAN`` are added inside tasks first."""
    def add(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["part"].to_pylist(), table["cells"].to_pylist()))
        total = sum(np.frombuffer(c) for _, c in rows)
        return pa.table({"part": pa.array([rows[0][0] // FAN], pa.int32()), "cells": pa.array([total.tobytes()], pa.binary())})

    while parts > FAN:
        cells = cells.groupBy(F.floor(F.col("part") / FAN)).applyInArrow(add, _CELLS)
        parts = -(-parts // FAN)
    total = np.zeros(int(np.prod(shape)))
    for r in sorted(cells.collect(), key=lambda r: r["part"]):
        total = total + np.frombuffer(r["cells"])
    return total.reshape(shape)


def add_up(total: np.ndarray, node: np.ndarray, bins: np.ndarray, rows: np.ndarray | None, values: tuple):
    """Add ``values`` (None: 1) of the rows ``rows`` (None: all) of a block, which are at ``node``, to (node, value, feature, bin)."""
    nodes, _, p, n_bins = total.shape
    first = node.astype(np.intp) * n_bins
    for j in range(p):
        cell = first + (bins[j] if rows is None else bins[j][rows])
        for i, v in enumerate(values):
            total[:, i, j] += np.bincount(cell, weights=v, minlength=nodes * n_bins).reshape(-1, n_bins)


def node_histograms(work: DataFrame, parts: int, settings: Boosting, pending: list[Tree], tree: Tree, wanted: list[int], number: int,
                    p: int, n_bins: int) -> dict[int, np.ndarray]:
    """{node: (3, feature, bin) sums of gradient, second derivative, rows} of nodes of a growing tree."""
    order = np.full(len(tree.feature), -1)
    order[wanted] = np.arange(len(wanted))
    shape = (len(wanted), 3, p, n_bins)

    def task(batches):
        from pyspark import TaskContext
        total = np.zeros(shape)
        for batch in batches:
            for k, y, w, scores, bins in blocks_of(batch, p):
                node = order[ends_by_bin(tree, bins)]
                seen = settings.sampled(k, number) if k is not None else None
                rows = np.flatnonzero(node >= 0 if seen is None else (node >= 0) & seen)
                every = len(rows) == len(y)
                score = _advance(scores[0], bins, pending, settings.learning_rate)
                if not every:
                    node, y, score = node[rows], y[rows], score[rows]
                w = np.ones(len(y)) if w is None else w[rows]
                g, h = settings.gradients(y, w, score)
                add_up(total, node, bins, None if every else rows, (g, h, None))
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                         names=["part", "cells"])

    sums = _summed(work.mapInArrow(task, _CELLS), parts, shape)
    return {node: sums[i] for i, node in enumerate(wanted)}


def best_split(hist: np.ndarray, settings: Boosting, columns: np.ndarray):
    """(gain, feature, bin, left sums) of the best allowed split, or None; ties to the first feature, then bin."""
    total = hist[:, 0].sum(1)
    left = np.cumsum(hist[:, columns], axis=2)[:, :, :-1]
    right = total[:, None, None] - left
    lam = settings.reg_lambda
    value = lambda s: s[0] ** 2 / np.maximum(s[1] + lam, 1e-300)
    gain = value(left) + value(right) - value(total)
    ok = ((left[2] >= settings.min_rows) & (right[2] >= settings.min_rows) & (left[1] >= settings.min_hessian) & (right[1] >= settings.min_hessian))
    gain = np.where(ok, gain, -np.inf)
    if not gain.size or not gain.max() > 1e-10:
        return None
    j, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
    return float(gain[j, b]), int(columns[j]), int(b), left[:, j, b]


def growing(settings: Boosting, cuts: list[list[float]], columns: np.ndarray):
    """Generator of one tree: asks for histograms of nodes by yielding (draft
    tree, nodes), is sent {node: histogram}, and returns the tree, so that several trees can grow in step on the same passes.

    Leaves are split on a draft that runs ahead of the tree proper: before a
    leaf can be chosen, the gains below it must be known, and one pass finds
    them for every node that the remaining choices may reach (no more than
    there are choices left, by gain)."""
    draft = Tree()
    found = yield draft, [0]
    sums, split, children, depth = {0: found[0][:, 0].sum(1)}, {0: best_split(found[0], settings, columns)}, {}, {0: 0}
    tree, place = Tree(), {0: 0}                                # draft node -> node of the tree proper
    budget = settings.max_leaves or 1 << 30
    leaves = 1

    def order(nodes):
        return sorted((d for d in nodes if split.get(d) and depth[d] < settings.max_depth), key=lambda d: (-split[d][0], d))

    def known(d):
        return d in children and all(c in split for c in children[d])

    while leaves < budget and (ready := order(d for d in place if tree.feature[place[d]] < 0)):
        chosen = ready[:1] if settings.max_leaves else ready
        if all(map(known, chosen)):
            for d in chosen:
                _, f, b, _ = split[d]
                place.update(zip(children[d], tree.split(place[d], f, b, cuts[f][b])))
                leaves += 1
            continue
        # One level more below every node of the draft that the coming choices may reach: the smaller child's histogram.
        ahead = order(d for d in sums if d not in children)[:budget - leaves]
        wanted = []
        for d in ahead:
            _, f, b, left = split[d]
            children[d] = draft.split(d, f, b, cuts[f][b])
            sums[children[d][0]], sums[children[d][1]] = left, sums[d] - left
            depth.update({c: depth[d] + 1 for c in children[d]})
            if depth[d] + 1 < settings.max_depth:
                wanted.append(min(children[d], key=lambda c: (sums[c][2], c)))
            else:                                               # never split again: sums are all they need
                split.update({c: None for c in children[d]})
        new = (yield draft, wanted) if wanted else {}
        for d in ahead:
            small = next((c for c in children[d] if c in new), None)
            if small is not None:
                other = children[d][0] + children[d][1] - small
                found[small], found[other] = new[small], found.pop(d) - new[small]
                for c in children[d]:
                    split[c] = best_split(found[c], settings, columns)
    for d, t in place.items():
        if tree.feature[t] < 0:
            tree.value[t] = float(-sums[d][0] / (sums[d][1] + settings.reg_lambda)) if sums[d][1] + settings.reg_lambda > 0 else 0.0
    return tree


def grow_tree(histograms, settings: Boosting, cuts: list[list[float]], columns: np.ndarray) -> Tree:
    """One tree; ``histograms(tree, nodes)`` returns the histograms of leaves of ``tree``."""
    return grow_together([growing(settings, cuts, columns)], lambda asked: [histograms(*asked[0])])[0]


def grow_together(trees: list, histograms) -> list[Tree]:
    """Drive generators of ``growing`` in step: ``histograms`` answers one
    request (or None, once a tree is done) of each at a time."""
    done: list[Tree | None] = [None] * len(trees)
    asked = [next(t) for t in trees]
    while any(a is not None for a in asked):
        answers = histograms(asked)
        for i, answer in enumerate(answers):
            if asked[i] is not None:
                try:
                    asked[i] = trees[i].send(answer)
                except StopIteration as end:
                    asked[i], done[i] = None, end.value
    return done


def base_score(df: DataFrame, label: str, settings: Boosting, weight: str | None = None) -> tuple[float, int]:
    """Weighted mean label (its log-odds for the logistic loss), and the number of rows."""
    y, w = F.col(label).cast("double"), F.col(weight).cast("double") if weight else F.lit(1.0)
    if settings.loss == "logistic":
        w = F.when(y > 0, w * settings.positive_weight).otherwise(w)
    r = df.agg(F.sum(w * y).alias("s"), F.sum(w).alias("w"), F.count(F.lit(1)).alias("n")).first()
    if not r["w"]:
        raise ValueError("no training rows")
    mean = float(r["s"]) / float(r["w"])
    if settings.loss == "squared":
        return mean, r["n"]
    mean = min(max(mean, 1e-15), 1 - 1e-15)
    return float(np.log(mean / (1 - mean))), r["n"]


def fit_boosting(train: DataFrame, features: list[str], label: str, settings: Boosting, key: str | None = "hadm_id",
                 weight: str | None = None) -> BoostedTrees:
    """Fit a booster; ``key`` (for row sampling) should name the rows."""
    if settings.max_bins > 255:
        raise ValueError("a bin number is one byte, and one bin is for missing values")
    base, n = base_score(train, label, settings, weight)
    model = BoostedTrees(features, settings, base, feature_cuts(train, features, settings.max_bins))
    hashed = F.xxhash64(F.col(key) if key else F.struct(*[F.col(f).cast("double") for f in features]))
    work = binned(train, features, label, model.cuts, [base], n, hashed if settings.subsample < 1 else None, weight)
    parts = work.rdd.getNumPartitions()                         # of the written table; nothing is run
    p, n_bins, pending = len(features), max(2, max(len(c) for c in model.cuts) + 1), []
    for number in range(settings.rounds):
        if len(pending) >= settings.refresh:
            work, pending = refreshed(work, [pending], settings.learning_rate, p), []
        columns = settings.columns(p, number)
        tree = grow_tree(lambda t, nodes: node_histograms(work, parts, settings, pending, t, nodes, number, p, n_bins),
                         settings, model.cuts, columns)
        if tree.feature[0] < 0 and settings.subsample >= 1 and settings.colsample >= 1:
            break                                               # nothing left to split, nor will there be
        model.trees.append(tree)
        pending.append(tree)
    return model


# --- the analysed pipeline's boosters (fixed values) ------------------------------------

def leafwise_classifier(train: DataFrame, features: list[str], label: str, **options) -> BoostedTrees:
    """M3: 100 rounds at rate 0.1, best-first to 31 leaves and depth 6, at least 20 rows a leaf."""
    return fit_boosting(train, features, label, Boosting(**{"loss": "logistic", "max_depth": 6, **options}))


def leafwise_regressor(train: DataFrame, features: list[str], label: str, **options) -> BoostedTrees:
    """M9: the same on squared loss, to depth 7."""
    return fit_boosting(train, features, label, Boosting(**{"loss": "squared", "max_depth": 7, **options}))


def newton_classifier(train: DataFrame, features: list[str], label: str, **options) -> BoostedTrees:
    """M4: 100 depth-3 trees at rate 0.1 on 0.8 of the rows and 0.8 of the
    columns each, lambda 1, child second derivatives of at least 1, positives weighted by n_neg / n_pos."""
    y = F.col(label).cast("int")
    n = train.agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")).first()
    return fit_boosting(train, features, label, Boosting(**{
        "loss": "logistic", "max_leaves": None, "max_depth": 3, "min_rows": 1, "min_hessian": 1.0, "reg_lambda": 1.0, "subsample": 0.8,
        "colsample": 0.8, "positive_weight": float(n["neg"]) / n["pos"] if n["pos"] else 1.0, **options}))
