"""Exact tree attributions against all subsets of features, and against sampling."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from carepath.operators import explain as xp
from carepath.operators import hist_boost as hb
from carepath.operators import models as md

NAMES = ["a", "b", "c", "d", "e"]


@pytest.fixture(scope="module")
def df(spark):
    rng = np.random.default_rng(7)
    x = np.round(rng.normal(size=(300, 5)), 2)
    z = x[:, 0] * x[:, 1] + x[:, 2] - 0.5 * x[:, 3] * x[:, 4]
    return spark.createDataFrame([(i, *map(float, x[i]), int(z[i] > 0), float(z[i])) for i in range(300)],
                                 "hadm_id long, " + ", ".join(f"{c} double" for c in NAMES) + ", y int, z double")


def predict(table, x):
    full = [(1 << int(d)) - 1 for d in table.size]
    return table.constant + sum(v * (table.inside(i, x) == full[i]) for i, v in enumerate(table.value))


def brute(table, x, z):
    """Interventional Shapley values of one row by all 2^5 subsets."""
    p = len(x)
    worth = {}
    for s in itertools.chain.from_iterable(itertools.combinations(range(p), k) for k in range(p + 1)):
        mixed = z.copy()
        mixed[:, list(s)] = x[list(s)]
        worth[s] = predict(table, mixed).mean()
    return [sum(math.factorial(len(s)) * math.factorial(p - len(s) - 1) / math.factorial(p) * (worth[tuple(sorted((*s, j)))] - worth[s])
                for s in worth if j not in s) for j in range(p)]


def models(df):
    yield md.random_forest_classifier(df, NAMES, "y", num_trees=8, max_depth=5), lambda f, d: f.score(d, "s")
    yield md.random_forest_regressor(df, NAMES, "z", num_trees=5, max_depth=4), lambda f, d: f.score(d, "s")
    yield md.gbt_regressor(df, NAMES, "z", max_iter=5, max_depth=3), lambda f, d: f.score(d, "s")
    boosted = hb.leafwise_classifier(df, NAMES, "y", rounds=4, max_leaves=8)
    yield boosted, lambda f, d: f.score(d, "s").withColumn("s", F.log(F.col("s") / (1 - F.col("s"))))       # attributions are of the margin


def test_sums_and_all_subsets(spark, df):
    rows = df.limit(40).toPandas()
    for fitted, score in models(df):
        table = xp.leaf_table(fitted)
        att = xp.exact_tree_attribution(fitted, df.limit(40), "hadm_id", df, n_background=30).toPandas()
        wide = att.pivot(index="hadm_id", columns="feature", values="attribution")[NAMES]
        scores = {r.hadm_id: r.s for r in score(fitted, df.limit(40)).collect()}
        base = att["base_value"].iloc[0]
        for i, total in wide.sum(axis=1).items():
            assert total == pytest.approx(scores[i] - base, abs=1e-9)
        z = np.array([[r[c] for c in NAMES] for r in df.select(F.xxhash64(F.lit(42), "hadm_id").alias("h"), "hadm_id", *NAMES)
                      .orderBy("h", "hadm_id").limit(30).collect()])
        for i in rows["hadm_id"][:4]:
            x = rows.set_index("hadm_id").loc[i, NAMES].to_numpy(float)
            assert wide.loc[i].to_numpy() == pytest.approx(brute(table, x, z), abs=1e-9)


def test_sampling_agrees_within_its_error(spark, df):
    fitted = md.random_forest_classifier(df, NAMES, "y", num_trees=8, max_depth=5)
    some = df.limit(10)
    exact = {(r.hadm_id, r.feature): r.attribution for r in xp.exact_tree_attribution(fitted, some, "hadm_id", df, n_background=20).collect()}
    near = xp.monte_carlo_shapley(fitted, some, "hadm_id", df, n_permutations=200, n_background=20).collect()
    assert len(exact) == len(near) == 50
    assert max(abs(r.attribution - exact[r.hadm_id, r.feature]) / (r.std_error + 1e-12) for r in near if r.std_error) < 5


def test_missing_values_and_empty_background(spark, df):
    fitted = hb.leafwise_classifier(df.withColumn("a", F.when(F.col("hadm_id") % 3 > 0, F.col("a"))), NAMES, "y", rounds=3, max_leaves=6)
    rows = df.limit(9).withColumn("a", F.lit(None).cast("double"))
    att = xp.exact_tree_attribution(fitted, rows, "hadm_id", df).groupBy("hadm_id", "base_value").agg(F.sum("attribution").alias("t"))
    scores = {r.hadm_id: math.log(r.s / (1 - r.s)) for r in fitted.score(rows, "s").collect()}
    for r in att.collect():
        assert r.t == pytest.approx(scores[r.hadm_id] - r.base_value, abs=1e-9)
    with pytest.raises(ValueError):
        xp.exact_tree_attribution(fitted, rows, "hadm_id", df.limit(0))


def test_patterns_against_pairs_and_without_sorting_rows(monkeypatch):
    """Leaves of few and of many conditions, missing values: pair by pair; rows are never sorted for short paths."""
    import math

    rng = np.random.default_rng(4)
    p, sizes = 15, [3, 1, 14, 5, 0, 13]
    feature, low, high = np.zeros((6, 14), np.int32), np.full((6, 14), -np.inf), np.full((6, 14), np.inf)
    for i, d in enumerate(sizes):
        feature[i, :d] = rng.permutation(p)[:d]
        low[i, :d] = np.where(rng.random(d) < 0.5, -np.inf, -1.0)
        high[i, :d] = np.where(rng.random(d) < 0.5, np.inf, 1.0)
    table = xp.LeafTable([f"f{j}" for j in range(p)], 0.0, rng.normal(size=6), np.array(sizes, np.int64), feature, low, high)
    x, z = rng.normal(size=(80, p)), rng.normal(size=(9, p))
    x[::7, ::3] = np.nan
    want = np.zeros((80, p))
    for i, d in enumerate(sizes):
        ins = lambda v: ~(v[:, feature[i, :d]] > high[i, :d]) & ((v[:, feature[i, :d]] > low[i, :d]) | np.isneginf(low[i, :d]))
        for r, mine in enumerate(ins(x)):
            for other in ins(z):
                if (mine | other).all():
                    a, b = int((~other).sum()), int((~mine).sum())
                    for k in range(d):
                        if mine[k] and not other[k]:
                            want[r, feature[i, k]] += table.value[i] * math.factorial(a - 1) * math.factorial(b) / math.factorial(a + b) / 9
                        if other[k] and not mine[k]:
                            want[r, feature[i, k]] -= table.value[i] * math.factorial(a) * math.factorial(b - 1) / math.factorial(a + b) / 9
    explain, calls, plain = xp._interventional(table, z), [], np.unique
    monkeypatch.setattr(np, "unique", lambda *a, **k: (k.get("return_inverse") and calls.append(1)) or plain(*a, **k))
    assert explain(x) == pytest.approx(want, abs=1e-12)
    assert len(calls) == 2
