"""Histogram boosting against a plain grower that rescans the rows of every leaf."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from carepath.operators import hist_boost as hb


def made(n=700, p=5, seed=1, loss="logistic"):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, p))
    x[:, 3] = rng.integers(0, 4, n)
    z = x[:, 0] * x[:, 1] + 0.8 * x[:, 2] + 0.5 * (x[:, 3] == 2) + 0.5 * rng.normal(size=n)
    y = (z > 0.2).astype(float) if loss == "logistic" else z
    return x, y


def frame(spark, x, y):
    names = [f"f{j}" for j in range(x.shape[1])]
    rows = [(i, *map(float, x[i]), float(y[i])) for i in range(len(x))]
    return spark.createDataFrame(rows, "hadm_id long, " + ", ".join(f"{c} double" for c in names) + ", y double").repartition(3), names


def brute(x, y, cuts, s, base, keys):
    """Trees as nested tuples (feature, bin, left, right) / leaf value, and the final scores, by rescans."""
    bins = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)
    score, trees = np.full(len(x), base), []
    for number in range(s.rounds):
        seen = s.sampled(keys, number)
        rows = np.arange(len(x)) if seen is None else np.flatnonzero(seen)
        g, h = s.gradients(y, np.ones(len(x)), score)
        columns = s.columns(x.shape[1], number)

        def best(at):
            top = None
            for j in columns:
                for b in range(len(cuts[j])):
                    left = bins[at, j] <= b
                    parts = [(g[at[m]].sum(), h[at[m]].sum(), m.sum()) for m in (left, ~left)]
                    if any(c < s.min_rows or k < s.min_hessian for _, k, c in parts):
                        continue
                    value = sum(a * a / (k + s.reg_lambda) for a, k, _ in parts)
                    gain = value - g[at].sum() ** 2 / (h[at].sum() + s.reg_lambda)
                    if gain > 1e-10 and (top is None or gain > top[0] + 1e-12):
                        top = (gain, int(j), b)
            return top

        class Node:
            def __init__(self, at, depth):
                self.at, self.depth, self.kids = at, depth, None
                self.split = best(at) if depth < s.max_depth else None

            def tuple(self):
                if self.kids:
                    return (self.split[1], self.split[2], self.kids[0].tuple(), self.kids[1].tuple())
                return float(-g[self.at].sum() / (h[self.at].sum() + s.reg_lambda))

        root = Node(rows, 0)
        leaves = [root]
        while len(leaves) < (s.max_leaves or 10 ** 9) and any(n.split for n in leaves):
            n = max((n for n in leaves if n.split), key=lambda n: n.split[0])
            left = bins[n.at, n.split[1]] <= n.split[2]
            n.kids = [Node(n.at[left], n.depth + 1), Node(n.at[~left], n.depth + 1)]
            leaves.remove(n)
            leaves += n.kids
        tree = root.tuple()
        trees.append(tree)
        for i in range(len(x)):
            t = tree
            while isinstance(t, tuple):
                t = t[2] if bins[i, t[0]] <= t[1] else t[3]
            score[i] += s.learning_rate * t
    return trees, score


def nested(tree, node=0):
    if tree.feature[node] < 0:
        return tree.value[node]
    return (tree.feature[node], tree.bin[node], nested(tree, tree.left[node]), nested(tree, tree.right[node]))


def same(a, b):
    if isinstance(a, tuple) != isinstance(b, tuple):
        return False
    if not isinstance(a, tuple):
        return a == pytest.approx(b, abs=1e-9)
    return a[:2] == b[:2] and same(a[2], b[2]) and same(a[3], b[3])


@pytest.mark.parametrize("options", [
    {"rounds": 3, "max_leaves": 12, "max_depth": 6, "max_bins": 16, "refresh": 2},
    {"rounds": 2, "max_leaves": 31, "max_depth": 20, "min_rows": 5, "max_bins": 24},
    {"rounds": 3, "max_leaves": None, "max_depth": 3, "min_rows": 1, "min_hessian": 1.0, "reg_lambda": 1.0, "subsample": 0.8, "colsample": 0.6,
     "max_bins": 16, "refresh": 1},
    {"rounds": 2, "loss": "squared", "max_leaves": 10, "max_depth": 7, "max_bins": 16},
])
def test_trees_equal_a_plain_grower(spark, options):
    settings = hb.Boosting(**options)
    x, y = made(loss=settings.loss)
    df, names = frame(spark, x, y)
    model = hb.fit_boosting(df, names, "y", settings)
    keys = np.array([r.k for r in df.select("hadm_id", F.xxhash64("hadm_id").alias("k")).orderBy("hadm_id").collect()])
    trees, score = brute(x, y, [np.array(c) for c in model.cuts], settings, model.base, keys)
    assert len(model.trees) == len(trees) and all(same(nested(a), b) for a, b in zip(model.trees, trees))
    got = np.array([r.s for r in model.score(df, "s").orderBy("hadm_id").collect()])
    assert got == pytest.approx(1 / (1 + np.exp(-score)) if settings.loss == "logistic" else score, abs=1e-9)


def test_newton_gain_and_leaf_values_on_200_rows(spark):
    """One second-order tree: gain and values from the definition."""
    x, y = made(200, 4, 3)
    df, names = frame(spark, x, y)
    model = hb.newton_classifier(df, names, "y", rounds=1, subsample=1.0, colsample=1.0)
    s, t = model.settings, model.trees[0]
    assert s.positive_weight == pytest.approx((y == 0).sum() / (y == 1).sum())
    g, h = s.gradients(y, np.ones(200), np.full(200, model.base))
    gains = {(j, c): sum(g[m].sum() ** 2 / (h[m].sum() + 1) for m in (x[:, j] <= c, x[:, j] > c)) - g.sum() ** 2 / (h.sum() + 1)
             for j in range(4) for c in model.cuts[j] if min(h[x[:, j] <= c].sum(), h[x[:, j] > c].sum()) >= 1}
    assert (t.feature[0], t.cut[0]) == max(gains, key=gains.get)
    leaf = t.leaves_of(hb._ByValue(t, x))
    for n in np.unique(leaf):
        assert t.value[n] == pytest.approx(-g[leaf == n].sum() / (h[leaf == n].sum() + 1), abs=1e-9)
    assert max(len(np.unique(leaf)), 1) <= 8


def test_arrays_of_many_partitions_are_added_in_groups(spark, monkeypatch):
    monkeypatch.setattr(hb, "FAN", 2)
    x, y = made(300, 3 + 1, 5)
    df, names = frame(spark, x, y)
    settings = hb.Boosting(rounds=2, max_leaves=6, max_bins=16, min_rows=5)
    many = hb.fit_boosting(df.repartition(7, "hadm_id"), names, "y", settings)
    monkeypatch.setattr(hb, "FAN", 64)
    one = hb.fit_boosting(df.coalesce(1), names, "y", settings)
    assert [nested(t)[:2] for t in many.trees] == [nested(t)[:2] for t in one.trees]


def test_missing_values_constants_and_empty_input(spark):
    rows = [(i, None if i % 5 == 0 else float(i % 7), float("nan") if i % 3 == 0 else float(i), 1.0, float(i % 5 == 0)) for i in range(200)]
    df = spark.createDataFrame(rows, "hadm_id long, a double, b double, c double, y double")
    model = hb.leafwise_classifier(df, ["a", "b", "c"], "y", rounds=5, min_rows=5)
    got = {r.hadm_id: r.s for r in model.score(df, "s").collect()}
    assert min(v for i, v in got.items() if i % 5 == 0) > max(v for i, v in got.items() if i % 5)
    assert dict(model.importance())["c"] == 0
    with pytest.raises(ValueError):
        hb.leafwise_classifier(df.limit(0), ["a"], "y")
    flat = hb.leafwise_regressor(df.withColumn("y", F.lit(2.0)), ["a", "b"], "y", rounds=3)
    assert flat.trees == [] and flat.score(df.limit(1), "s").first().s == 2.0


def test_staged_scores_equal_shorter_fits(spark):
    x, y = made(300, 4, 8)
    df, names = frame(spark, x, y)
    long = hb.leafwise_classifier(df, names, "y", rounds=6, max_leaves=5)
    short = hb.leafwise_classifier(df, names, "y", rounds=3, max_leaves=5)
    a = [r.s for r in long.score(df, "s", rounds=3).orderBy("hadm_id").collect()]
    assert a == pytest.approx([r.s for r in short.score(df, "s").orderBy("hadm_id").collect()], abs=1e-12)


def test_quantile_trees_of_one_quantile_and_of_several_are_the_same(spark):
    """Growing together changes no tree; predictions don't cross; steps are leaf quantiles."""
    from carepath.operators import quantile_boost as qb
    rng = np.random.default_rng(12)
    x = rng.uniform(size=(500, 2))
    y = np.exp(x[:, 0] + 0.5 * rng.normal(size=500))
    df = spark.createDataFrame([(i, float(a), float(b), float(t)) for i, ((a, b), t) in enumerate(zip(x, y))], "hadm_id long, a double, b double, y double")
    many = qb.fit_quantile_set(df, ["a", "b"], "y", quantiles=(0.9, 0.5), n_stages=4, checkpoint_every=2, max_bins=16)
    for i, q in enumerate(many.quantiles):
        one = qb.fit_quantile_set(df, ["a", "b"], "y", quantiles=(q,), n_stages=4, max_bins=16)
        assert [nested(t) for t in one.trees[0]] == [nested(t) for t in many.trees[i]]
        first = many.trees[i][0]
        leaf = first.leaves_of(hb._ByValue(first, x))
        for n in np.unique(leaf):
            residuals = np.sort(y[leaf == n] - many.base[i])
            assert first.value[n] == pytest.approx(residuals[int(np.ceil(q * len(residuals))) - 1], abs=1e-9)
    rows = many.predict(df, "y").collect()
    assert list(many) == ["q90", "q50"] and all(r.predicted_y_q50 <= r.predicted_y_q90 for r in rows)
    with pytest.raises(ValueError):
        qb.fit_quantile_set(df.limit(0), ["a"], "y")


def test_blocks_hold_every_row_and_walk_like_single_rows(spark, monkeypatch):
    """Blocks of 64 rows, dealt over tasks: every row once, in its bins, with the leaf that a walk from the root finds."""
    monkeypatch.setattr(hb, "BLOCK", 64)
    monkeypatch.setattr(hb, "LEAST_ROWS", 100)
    x, y = made(500, 4, 7, "squared")
    x[::9, 1] = np.nan
    df, names = frame(spark, x, y)
    cuts = hb.feature_cuts(df, names, 16)
    work = hb.binned(df, names, "y", cuts, [0.5, -0.5], 500, F.col("hadm_id"))
    assert work.rdd.getNumPartitions() == 5
    rows = {}
    tree = hb.Tree()
    a, b = tree.split(0, 0, 7, cuts[0][7])
    tree.split(a, 1, 0, cuts[1][0])
    tree.split(b, 3, 1, cuts[3][1])
    for batch in work.toArrow().to_batches():
        for k, truth, w, scores, bins in hb.blocks_of(batch, 4, 2):
            assert len(k) <= 64 and w is None and (scores.T == [0.5, -0.5]).all()
            rows |= {int(i): (t, *b, leaf) for i, t, b, leaf in zip(k, truth, bins.T.tolist(), hb.ends_by_bin(tree, bins))}
    walked = tree.leaves_of(hb._ByValue(tree, x))
    for i in range(500):
        want = [0 if np.isnan(x[i, j]) else int(np.searchsorted(c, x[i, j])) for j, c in enumerate(cuts)]
        assert rows[i] == (y[i], *want, walked[i])


def test_many_nodes_walk_by_bin():
    """More nodes than a byte holds."""
    tree, bins = hb.Tree(), np.arange(200, dtype=np.uint8)[None, :]
    node = 0
    for cut in range(150):
        node = tree.split(node, 0, cut, float(cut))[1]
    assert hb.ends_by_bin(tree, bins).tolist() == tree.leaves_of(hb._ByValue(tree, np.arange(200.0)[:, None])).tolist()


def test_leaf_step_of_values_shared_by_many_rows_is_found():
    # More rows of few values than a task may send runs: a run of two values stayed what it was, pass after pass.
    from carepath.operators import quantile_boost as qb
    r = np.random.default_rng(3)
    tasks = [np.repeat([-1.5, 0.0, 2.0], [1_000 + i, 900, 1_100]) for i in range(5)] + [np.r_[np.zeros(900), r.uniform(0.1, 4, 4_000)]]
    every = np.sort(np.concatenate(tasks))
    first = 5_010                                             # as many values of -1.5
    for rank in (1, first - 60, first, first + 1, first + 60, 10_000, 12_000, len(every)):
        bounds = (-np.inf, np.nan)
        for _ in range(6):
            chunks = [qb._chunks(t, *bounds, 32, (0, 3)) for t in tasks]
            assert all(len(c) <= 33 + 1 for c in chunks) and sum(c[:, 4].sum() for c in chunks) <= len(every)
            bounds = qb._bracket(np.concatenate(chunks), rank)
            if bounds[0] == bounds[1]:
                break
        assert bounds == (every[rank - 1], every[rank - 1])


def test_joint_counts_of_packed_features():
    from carepath.operators import quantile_boost as qb
    r = np.random.default_rng(4)
    sizes = [64, 2, 2, 250, 3, 2, 2, 2, 2, 2, 2, 2, 2, 5]
    bins = np.stack([r.integers(0, s, 3_000) for s in sizes]).astype(np.uint8)
    place = r.integers(0, 2 * 3 + 2, 3_000)                   # places 6 and 7 are past the last node
    packs = qb._packs(sizes)
    assert sorted(j for pack in packs for j in pack) == list(range(len(sizes)))
    got = np.zeros((3, 2, len(sizes), 250))
    for pack, code in zip(packs, qb._codes(bins, sizes, packs)):
        size = int(np.prod([sizes[j] for j in pack]))
        assert size <= qb.JOINT
        qb._marginal(got, np.bincount(place * size + code, minlength=6 * size)[:6 * size], pack, sizes)
    want = np.zeros_like(got)
    for j in range(len(sizes)):
        np.add.at(want, (place[place < 6] // 2, place[place < 6] % 2, j, bins[j][place < 6]), 1)
    assert (got == want).all()
