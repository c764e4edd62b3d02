"""E1-E11 against brute force on small literal frames."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from carepath.operators import evaluate as ev
from carepath.operators.cumulative import running_sums


def brute_auc(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y == 1]
    neg = [s for s, y in zip(scores, labels) if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


def brute_ap(scores, labels):
    P = sum(labels)
    ap = 0.0
    for t in sorted(set(scores), reverse=True):
        tp = sum(1 for s, y in zip(scores, labels) if s >= t and y == 1)
        fp = sum(1 for s, y in zip(scores, labels) if s >= t and y == 0)
        pos_at = sum(1 for s, y in zip(scores, labels) if s == t and y == 1)
        ap += pos_at / P * tp / (tp + fp)
    return ap


@pytest.fixture
def scored(spark):
    rng = np.random.default_rng(3)
    scores = np.round(rng.random(400), 2).tolist()          # many ties
    labels = (rng.random(400) < np.array(scores)).astype(int).tolist()
    df = spark.createDataFrame(list(zip(scores, labels)), "score double, label int")
    return df, scores, labels


def test_auc_and_ap(spark, scored):
    df, s, y = scored
    assert ev.roc_auc(df).first().roc_auc == pytest.approx(brute_auc(s, y), abs=1e-12)
    assert ev.average_precision(df).first().average_precision == pytest.approx(brute_ap(s, y), abs=1e-12)


def test_running_sums_many_ranges(spark):
    df = spark.range(1, 501).select(F.col("id").cast("double").alias("x"), F.lit(1).alias("one"))
    out = running_sums(df, "x", ["one"], n_ranges=13).orderBy("x").collect()
    assert [r.cum_one for r in out] == list(range(1, 501))


def test_classification_metrics(spark):
    df = spark.createDataFrame([(0.9, 1), (0.6, 0), (0.5, 1), (0.2, 1), (0.1, 0)], "score double, label int")
    m = ev.classification_metrics(df).first()
    assert (m.tp, m.fp, m.fn, m.tn) == (2, 1, 1, 1)
    assert m.precision == pytest.approx(2 / 3) and m.recall == pytest.approx(2 / 3)
    assert m.accuracy == pytest.approx(0.6)
    cm = {(r.label, r.predicted): r.n for r in ev.confusion_matrix(df).collect()}
    assert cm == {(0, 0): 1, (0, 1): 1, (1, 0): 1, (1, 1): 2}
    rep = {r["class"]: r for r in ev.classification_report(df).collect()}
    assert rep["1"].support == 3 and rep["macro avg"].support == 5


def test_zero_division_is_zero(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 1)], "score double, label int")
    m = ev.classification_metrics(df).first()
    assert (m.precision, m.recall, m.f1_score) == (0.0, 0.0, 0.0)


def test_regression_vectors(spark):
    a, p = [2.0, 9.5, 4.25, 12.0, 1.5], [2.5, 8.0, 4.0, 13.5, 1.0]
    df = spark.createDataFrame(list(zip(a, p)), "actual double, predicted double")
    m = ev.regression_metrics(df).first()
    A, P = np.array(a), np.array(p)
    assert m.rmse == pytest.approx(math.sqrt(np.mean((A - P) ** 2)))
    assert m.mae == pytest.approx(np.mean(np.abs(A - P)))
    assert m.r2 == pytest.approx(1 - np.sum((A - P) ** 2) / np.sum((A - A.mean()) ** 2))
    assert m.mape == pytest.approx(np.mean(np.abs((A - P) / A)) * 100)
    res = ev.residuals(df).collect()
    assert [round(r.residual, 6) for r in res] == [round(x - y, 6) for x, y in zip(a, p)]
    rng = ev.prediction_range(df).first()
    assert (rng.range_min, rng.range_max) == (1.0, 13.5)


def test_histogram_matches_numpy(spark):
    vals = np.random.default_rng(1).normal(size=300)
    df = spark.createDataFrame([(float(v),) for v in vals], "r double")
    h = ev.histogram(df, "r", 30).orderBy("bin").collect()
    counts, _ = np.histogram(vals, bins=30)
    assert [r.n for r in h] == counts.tolist()


def test_quantile_coverage_and_capacity(spark):
    df = spark.createDataFrame([(1.0, 1.0, 2.0, 3.0), (2.0, 1.5, 1.8, 3.0), (5.0, 2.0, 3.0, 4.0)],
                               "y double, q50 double, q75 double, q90 double")
    qc = {"q50": "q50", "q75": "q75", "q90": "q90"}
    c = ev.quantile_coverage(df, "y", qc).first()
    assert c.q75_coverage == pytest.approx(1 / 3) and c.q90_coverage == pytest.approx(2 / 3)
    s = ev.capacity_summary(df, qc, "qb", "total_los_days").first()
    assert s.median_prediction == 1.5 and s.q90_capacity_need == 10.0 and "q50_capacity_need" not in s


def test_degenerate_inputs_do_not_raise(spark):
    one_class = spark.createDataFrame([(0.2, 0), (0.7, 0)], "score double, label int")
    assert ev.roc_auc(one_class).first().roc_auc is None
    assert ev.average_precision(one_class).first().average_precision is None
    assert all(r.tpr is None for r in ev.roc_points(one_class).collect())
    assert all(r.recall is None for r in ev.pr_points(one_class).collect())
    const = spark.createDataFrame([(3.0, 3.0), (3.0, 3.0)], "actual double, predicted double")
    assert ev.regression_metrics(const).first().r2 == 1.0
    off = spark.createDataFrame([(3.0, 2.0), (3.0, 4.0)], "actual double, predicted double")
    assert ev.regression_metrics(off).first().r2 == 0.0
    from carepath.operators.clean import null_profile
    from carepath.operators.models import class_weights
    empty = spark.createDataFrame([], "a int, label int")
    assert {r.null_share for r in null_profile(empty).collect()} == {None}
    assert class_weights(empty, "label").first().scale_pos_weight is None


def test_exact_quantile_has_one_method_at_every_size(spark):
    import random
    from carepath.operators.quantiles import exact_quantile, order_statistics
    r = random.Random(5)
    for values in ([3.0], [1.0, 2.0], [5.0] * 50, [r.gauss(0, 1) for _ in range(999)] + [1e300, -1e300],
                   [r.choice([0.0, 1e-300, 7.0]) for _ in range(500)], list(range(10_001))):
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double")
        s = sorted(map(float, values))
        ranks = sorted({0, len(s) // 2, len(s) - 1})
        assert order_statistics(df, "v", ranks) == [s[k] for k in ranks]
        mid = (s[(len(s) - 1) // 2] + s[len(s) // 2]) / 2
        assert exact_quantile(df, "v", 0.5) == pytest.approx(mid)
    assert exact_quantile(df.where("v > 1e9"), "v", 0.5) is None


def test_curves_by_model_equal_the_single_model_ones(spark):
    rng = np.random.default_rng(4)
    rows = [(int(rng.random() < 0.3), float(np.round(rng.random(), 2)), float(rng.random()), 0.5) for _ in range(500)]
    df = spark.createDataFrame(rows, "label int, a double, b double, c double")
    long = ev.scores_by_model(df, {"A": "a", "B": "b", "C": "c"})
    roc, pr = ev.roc_points_by_model(long).collect(), ev.pr_points_by_model(long).collect()
    both = {r.model: r for r in ev.classification_metrics_by_model(long).collect()}
    for name, c in (("A", "a"), ("B", "b"), ("C", "c")):
        one = df.select("label", F.col(c).alias("score"))
        assert sorted(tuple(r)[1:] for r in roc if r.model == name) == sorted(map(tuple, ev.roc_points(one).collect()))
        assert sorted(tuple(r)[1:] for r in pr if r.model == name) == sorted(map(tuple, ev.pr_points(one).collect()))
        m = ev.classification_metrics(one).first()
        assert all(both[name][k] == m[k] for k in ("n", "tp", "fp", "fn", "tn", "accuracy", "precision", "recall", "f1_score"))
        assert both[name].roc_auc == pytest.approx(ev.roc_auc(one).first().roc_auc, abs=1e-12)
        assert both[name].average_precision == pytest.approx(ev.average_precision(one).first()[0], abs=1e-12)
    plan = ev.roc_points_by_model(long)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert ev.roc_points_by_model(long.limit(0)).collect() == []


def test_areas_where_positives_times_negatives_pass_32_bits(spark):
    """60,000 of each class: their product is no 32-bit number."""
    df = spark.range(120_000).select((F.col("id") % 2).cast("int").alias("label"), ((F.col("id") % 8) / 8.0).alias("score"))
    rows = ev.classification_metrics_by_model(ev.scores_by_model(df, {"a": "score", "b": "score"})).collect()
    one = ev.roc_auc(df).first()
    assert one.n_pos * one.n_neg > 1 << 31
    # Per pair of classes: scores 1, 3, 5, 7 against 0, 2, 4, 6 eighths.
    assert [r.roc_auc for r in rows] == pytest.approx([10 / 16] * 2) and one.roc_auc == pytest.approx(10 / 16)
    assert {r.model for r in rows} == {"a", "b"} and all(r.n == 120_000 for r in rows)
