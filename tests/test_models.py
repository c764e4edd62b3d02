"""M1, M5-M7 against NumPy solves; S9 round trip; M10 coverage; I2/I3."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from carepath.operators import explain, models as md, quantile_boost as qb, tune
from carepath.sources.tables import load_model, save_model


@pytest.fixture(scope="module")
def reg_data(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(300, 3))
    y = 2.0 + X @ np.array([1.5, -0.7, 0.3]) + rng.normal(scale=0.5, size=300)
    rows = [(i, *map(float, X[i]), float(y[i])) for i in range(300)]
    df = spark.createDataFrame(rows, "hadm_id long, a double, b double, c double, y double")
    return df, X, y


def test_ols_matches_lstsq(reg_data):
    df, X, y = reg_data
    f = md.linear_regression(df, ["a", "b", "c"], "y")
    A = np.c_[np.ones(len(X)), X]
    beta = np.linalg.lstsq(A, y, rcond=None)[0]
    assert f.estimator.intercept == pytest.approx(beta[0], abs=1e-8)
    assert f.estimator.coefficients.toArray() == pytest.approx(beta[1:], abs=1e-8)


def test_ridge_matches_closed_form(reg_data):
    df, X, y = reg_data
    alpha = 5.0
    f = md.ridge(df, ["a", "b", "c"], "y", alpha=alpha)
    Xc, yc = X - X.mean(0), y - y.mean()
    w = np.linalg.solve(Xc.T @ Xc + alpha * np.eye(3), Xc.T @ yc)
    assert f.estimator.coefficients.toArray() == pytest.approx(w, abs=1e-6)
    assert f.estimator.intercept == pytest.approx(y.mean() - X.mean(0) @ w, abs=1e-6)


def test_elastic_net_one_feature_closed_form(reg_data):
    df, X, y = reg_data
    f = md.elastic_net(df, ["a"], "y", alpha=0.3, l1_ratio=0.5)
    x, n = X[:, 0] - X[:, 0].mean(), len(y)
    rho = x @ (y - y.mean()) / n
    w = np.sign(rho) * max(abs(rho) - 0.15, 0) / (x @ x / n + 0.15)
    assert f.estimator.coefficients[0] == pytest.approx(w, abs=1e-4)


def test_logistic_matches_newton(spark):
    rng = np.random.default_rng(1)
    X = rng.normal(size=(400, 2))
    p = 1 / (1 + np.exp(-(0.3 + X @ np.array([1.2, -0.8]))))
    y = (rng.random(400) < p).astype(int)
    df = spark.createDataFrame([(float(a), float(b), int(t)) for (a, b), t in zip(X, y)],
                               "a double, b double, y int")
    f = md.logistic_regression(df, ["a", "b"], "y", C_=1.0, weights=None)
    # Newton on C*sum(loss) + 0.5*||w||^2, intercept unpenalised
    A = np.c_[np.ones(len(X)), X]
    beta = np.zeros(3)
    for _ in range(50):
        q = 1 / (1 + np.exp(-A @ beta))
        g = A.T @ (q - y) + np.r_[0, beta[1:]]
        H = A.T @ (A * (q * (1 - q))[:, None]) + np.diag([0, 1, 1])
        beta -= np.linalg.solve(H, g)
    assert f.estimator.intercept == pytest.approx(beta[0], abs=1e-4)
    assert f.estimator.coefficients.toArray() == pytest.approx(beta[1:], abs=1e-4)


def test_model_save_load_round_trip(reg_data, tmp_path):
    df, _, _ = reg_data
    f = md.linear_regression(df, ["a", "b", "c"], "y")
    path = str(tmp_path / "m")
    save_model(f.model, path)
    g = md.Fitted("again", load_model(path), f.features, "y", "regressor")
    a = [r.p for r in f.score(df, "p").orderBy("hadm_id").collect()]
    b = [r.p for r in g.score(df, "p").orderBy("hadm_id").collect()]
    assert a == b


def test_empty_fit_raises(spark):
    empty = spark.createDataFrame([], "a double, y double")
    with pytest.raises(Exception):
        md.linear_regression(empty, ["a"], "y")


def test_quantile_boost_coverage(spark):
    rng = np.random.default_rng(2)
    X = rng.uniform(0, 1, size=(1200, 2))
    y = np.exp(1.0 + X[:, 0] + 0.4 * rng.normal(size=1200))
    df = spark.createDataFrame([(i, float(a), float(b), float(t)) for i, ((a, b), t) in enumerate(zip(X, y))],
                               "hadm_id long, a double, b double, y double")
    tr, te = df.filter("hadm_id % 4 != 0"), df.filter("hadm_id % 4 = 0")
    ms = qb.fit_quantile_set(tr, ["a", "b"], "y", quantiles=(0.5, 0.9), n_stages=25, checkpoint_every=5)
    pred = qb.predict_quantiles(ms, te, "y")
    cov = pred.agg(*[F.avg((F.col("y") <= F.col(f"predicted_y_{q}")).cast("double")).alias(q) for q in ms]).first()
    assert abs(cov["q50"] - 0.5) < 0.08 and abs(cov["q90"] - 0.9) < 0.06


def test_shapley_exact_for_linear_model_with_one_background_row(reg_data):
    df, X, _ = reg_data
    f = md.linear_regression(df, ["a", "b", "c"], "y")
    bg = df.limit(1)
    z = bg.first()
    att = explain.monte_carlo_shapley(f, df.limit(20), "hadm_id", bg, n_permutations=3)
    coefs = dict(zip(f.features, f.estimator.coefficients.toArray()))
    rows = {(r.hadm_id, r.feature): r.attribution for r in att.collect()}
    for r in df.limit(20).collect():
        for feat in f.features:
            assert rows[(r.hadm_id, feat)] == pytest.approx(coefs[feat] * (r[feat] - z[feat]), abs=1e-9)


def test_linear_attribution_and_summary(reg_data):
    df, X, _ = reg_data
    f = md.linear_regression(df, ["a", "b", "c"], "y")
    att = explain.linear_attribution(f, df, ["hadm_id"])
    s = {r.feature: r.mean_abs_attribution for r in explain.attribution_summary(att).collect()}
    coefs = f.estimator.coefficients.toArray()
    for j, feat in enumerate(["a", "b", "c"]):
        assert s[feat] == pytest.approx(np.mean(np.abs(coefs[j] * (X[:, j] - X[:, j].mean()))), abs=1e-9)
    top = explain.importance_table(f, top=2).collect()
    assert [r.feature for r in top] == ["a", "b"]


def test_draws_use_whole_small_grid():
    assert len(tune.draw(tune.CLASSIFIER_SPACES["logistic"], 20, 42)) == 14
    a = tune.draw(tune.CLASSIFIER_SPACES["random_forest"], 20, 42)
    assert len(a) == 20 and a == tune.draw(tune.CLASSIFIER_SPACES["random_forest"], 20, 42)


def test_out_of_fold_scores_cover_every_row(spark):
    rng = np.random.default_rng(5)
    X = rng.normal(size=(300, 2))
    y = (X[:, 0] + rng.normal(size=300) > 0).astype(int)
    df = spark.createDataFrame([(i, float(a), float(b), int(t)) for i, ((a, b), t) in enumerate(zip(X, y))],
                               "hadm_id long, a double, b double, y int")
    oof = md.out_of_fold_scores(df, ["a", "b"], "y", folds=3)
    assert oof.count() == 300 and oof.select("hadm_id").distinct().count() == 300


def test_shapley_efficiency_for_tree_model(spark):
    rng = np.random.default_rng(9)
    X = rng.normal(size=(200, 3))
    y = (X[:, 0] + X[:, 1] * X[:, 2] > 0).astype(int)
    df = spark.createDataFrame([(i, *map(float, X[i]), int(y[i])) for i in range(200)],
                               "hadm_id long, a double, b double, c double, y int")
    f = md.random_forest_classifier(df, ["a", "b", "c"], "y", num_trees=10, max_depth=4)
    bg = df.limit(1)                      # one background row: efficiency is exact
    z = f.score(bg, "p").first().p
    rows = df.limit(15)
    att = explain.monte_carlo_shapley(f, rows, "hadm_id", bg, n_permutations=4)
    sums = {r.hadm_id: r.s for r in att.groupBy("hadm_id").agg(F.sum("attribution").alias("s")).collect()}
    for r in f.score(rows, "p").collect():
        assert sums[r.hadm_id] == pytest.approx(r.p - z, abs=1e-9)


def test_shapley_background_counts_repeated_rows(spark):
    """Repeating the input a hundred times leaves the attributions within their error."""
    rows = [(i, float(i % 10), float(i % 3)) for i in range(100)]
    df = spark.createDataFrame(rows, "hadm_id long, a double, b double").withColumn("y", F.expr("2 * a + b"))
    f = md.linear_regression(df, ["a", "b"], "y")
    many = spark.range(100).crossJoin(df).select((F.col("id") * 1000 + F.col("hadm_id")).alias("hadm_id"), "a", "b")
    one = df.limit(1)
    for background in (df, many):
        att = {r.feature: r for r in explain.monte_carlo_shapley(f, one, "hadm_id", background, n_permutations=200).collect()}
        z = one.first()
        for name, coef, mean in (("a", 2.0, 4.5), ("b", 1.0, 0.99)):
            assert abs(att[name].attribution - coef * (z[name] - mean)) < 5 * att[name].std_error + 0.6


def test_tree_models_come_close_to_the_best_possible_score(spark):
    """Bounds for M2-M4, M8, M9: labels drawn with known probabilities, so the
    best AUC and R² that any model can reach are known; every model gets within a margin."""
    from carepath.operators import evaluate as ev
    from carepath.operators import hist_boost as hb
    rng = np.random.default_rng(17)
    n = 3000
    X = rng.uniform(-1, 1, size=(n, 3))
    signal = 2.5 * np.sign(X[:, 0]) * (X[:, 1] > -0.3)
    p = 1 / (1 + np.exp(-signal))
    y, z = (rng.random(n) < p).astype(int), signal + rng.normal(size=n)
    df = spark.createDataFrame([(i, *map(float, X[i]), int(y[i]), float(z[i]), float(p[i]), float(signal[i])) for i in range(n)],
                               "hadm_id long, a double, b double, c double, y int, z double, p double, s double")
    train, test = df.filter("hadm_id % 3 > 0"), df.filter("hadm_id % 3 = 0")
    best = ev.roc_auc(test, "y", "p").first().roc_auc
    for trainer, kw in ((md.random_forest_classifier, {"num_trees": 20, "max_depth": 6}), (md.gbt_classifier, {"max_iter": 15}),
                        (md.gbt_classifier_sampled, {"max_iter": 15}), (hb.leafwise_classifier, {"rounds": 15, "max_leaves": 6}),
                        (hb.newton_classifier, {"rounds": 15})):
        got = ev.roc_auc(trainer(train, ["a", "b", "c"], "y", **kw).score(test, "q"), "y", "q").first().roc_auc
        assert best - 0.04 < got <= best + 0.02, trainer.__name__
    best = ev.regression_metrics(test, "z", "s").first().r2
    for trainer, kw in ((md.random_forest_regressor, {"num_trees": 20, "max_depth": 6}), (md.gbt_regressor, {"max_iter": 30}),
                        (hb.leafwise_regressor, {"rounds": 40, "max_leaves": 6})):
        got = ev.regression_metrics(trainer(train, ["a", "b", "c"], "z", **kw).score(test, "q"), "z", "q").first().r2
        assert best - 0.08 < got <= best + 0.02, trainer.__name__


def test_quantile_leaf_steps_are_exact_by_rank(spark):
    """One stage without a split: base value plus the exact quantile of what is left, also over many tasks and few runs."""
    rng = np.random.default_rng(5)
    parts = [rng.normal(size=n) for n in (1, 40, 700, 3000)] + [np.full(900, 0.25)]
    values = np.sort(np.concatenate(parts))
    for rank in (1, 2, 1000, 2320, 4000, len(values)):
        low, high, passes = -np.inf, np.nan, 0
        while not low == high:
            low, high = qb._bracket(np.concatenate([qb._chunks(v, low, high, 8, (0, 0)) for v in parts]), rank)
            passes += 1
        assert high == values[rank - 1] and passes < 12
    y = rng.gamma(2.0, 3.0, 2501)
    df = spark.createDataFrame([(float(v), 1.0) for v in y], "y double, a double").repartition(3)
    m = qb.fit_quantile_set(df, ["a"], "y", quantiles=(0.5, 0.9), n_stages=1, learning_rate=1.0)
    for q, base, trees in zip((0.5, 0.9), m.base, m.trees):
        want = np.sort(y)[int(np.ceil(q * len(y))) - 1]
        assert base + trees[0].value[0] == pytest.approx(want, abs=1e-12)


def test_shapley_scores_no_point_twice_where_a_switch_changes_nothing(spark):
    class Counted:
        features, seen = ["a", "b", "c"], []

        def score(self, df, out):
            self.seen.append(df)
            return df.withColumn(out, F.expr("2 * a + 3 * b * c"))

    bg = spark.createDataFrame([(9, 1.0, 0.0, 1.0)], "hadm_id long, a double, b double, c double")
    rows = spark.createDataFrame([(1, 1.0, 0.0, 1.0), (2, 3.0, 0.0, 1.0), (3, 1.0, 1.0, 1.0), (4, 0.0, 1.0, 2.0)], bg.schema)
    fitted = Counted()
    att = {(r.hadm_id, r.feature): r for r in explain.monte_carlo_shapley(fitted, rows, "hadm_id", bg, n_permutations=8).collect()}
    assert len(att) == 12
    assert [(r["_key"], r["count"]) for r in fitted.seen[0].groupBy("_key").count().orderBy("_key").collect()] == [(1, 8), (2, 16), (3, 16), (4, 32)]
    assert {k: r.attribution for k, r in att.items() if k[0] < 4 and r.attribution} == {(2, "a"): 4.0, (3, "b"): 3.0}
    assert all(r.std_error == 0 for k, r in att.items() if k[0] < 4)
    assert att[4, "a"].attribution == -2 and att[4, "b"].attribution + att[4, "c"].attribution == pytest.approx(6)
    assert 3 <= att[4, "b"].attribution <= 6 and att[4, "b"].std_error >= 0


def test_forests_keep_node_ids_and_grow_the_same_trees(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, float(a), float(b), int(a + b > 1), float(a * b)) for i, (a, b) in enumerate(rng.random((400, 2)))],
                               "hadm_id long, a double, b double, y int, z double")
    for trainer, label in ((md.random_forest_classifier, "y"), (md.random_forest_regressor, "z")):
        kept = trainer(df, ["a", "b"], label, num_trees=5, max_depth=6).estimator
        plain = trainer(df, ["a", "b"], label, num_trees=5, max_depth=6, cacheNodeIds=False).estimator
        assert kept.getCacheNodeIds() and not plain.getCacheNodeIds()
        assert [t.toDebugString.split("\n")[1:] for t in kept.trees] == [t.toDebugString.split("\n")[1:] for t in plain.trees]
