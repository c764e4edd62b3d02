"""H1: the search of logistic regressions on shared passes against Spark's own fits and evaluator."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml import classification as C
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.tuning import CrossValidator

from carepath.operators import logistic_search as ls
from carepath.operators import models as md
from carepath.operators import tune

NAMES = ["a", "b", "c", "flag", "same"]


def rows(spark, n=700, seed=3):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), 40 + 9 * rng.integers(0, 4, n), rng.normal(size=n), rng.integers(0, 2, n), np.full(n, 2.0)])
    y = rng.random(n) < 1 / (1 + np.exp(1.5 - x[:, 0] - 0.03 * (x[:, 1] - 50) + 0.5 * x[:, 3]))
    return spark.createDataFrame([(i, *map(float, x[i]), int(y[i])) for i in range(n)], "hadm_id long, " + ", ".join(f"{c} double" for c in NAMES) + ", y int").repartition(3)


def spark_auc(df, l1, l2, fold):
    reg = l1 + l2
    est = C.LogisticRegression(labelCol="y", weightCol=md.WEIGHT, standardization=False, maxIter=1000, tol=1e-12, regParam=reg, elasticNetParam=l1 / reg)
    model = Pipeline(stages=[VectorAssembler(inputCols=NAMES, outputCol="features"), est]).fit(df.filter(f"_fold != {fold}"))
    return BinaryClassificationEvaluator(labelCol="y", numBins=0).evaluate(model.transform(df.filter(f"_fold = {fold}")))


def test_search_equals_a_fit_of_every_draw_on_every_fold(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("a fit for every draw and fold")
    monkeypatch.setattr(CrossValidator, "fit", refuse)
    df = rows(spark)
    best, results = tune.random_search(df, NAMES, "y", "classifier", "logistic", folds=3, space={"C": [0.01, 0.1, 10.0], "penalty": ["l1", "l2"]})
    got = {r.params: r.mean_auc for r in results.collect()}
    work = md.with_weights(tune.with_folds(df, folds=3), "y", "balanced").cache()
    n = work.agg({md.WEIGHT: "sum"}).first()[0]
    for c in (0.01, 0.1, 10.0):
        for penalty in ("l1", "l2"):
            reg = 1 / (c * n)
            want = np.mean([spark_auc(work, *((reg, 0.0) if penalty == "l1" else (0.0, reg)), k) for k in range(3)])
            assert got[repr({"C": c, "penalty": penalty})] == pytest.approx(want, abs=2e-5)
    assert best.estimator.getRegParam() == pytest.approx(1 / (eval(max(got, key=got.get))["C"] * n))


def test_fits_advance_in_shared_passes(spark, monkeypatch):
    passes, once = [], ls._pass
    monkeypatch.setattr(ls, "_pass", lambda work, parts, fits, q: (passes.append(len(fits)), once(work, parts, fits, q)))
    tune.random_search(rows(spark), NAMES, "y", "classifier", "logistic")
    assert passes[0] == 70 and len(passes) <= 15


def test_auc_of_ties_and_of_folds_with_one_class(spark):
    # Fold 0 mixed with a feature of three values, fold 1 all positive, fold 2 all negative; blocks smaller than a fold.
    data = [(i, float(i % 3), i % 2 if i < 40 else int(i < 60), 0 if i < 40 else 1 if i < 60 else 2) for i in range(90)]
    df = md.with_weights(spark.createDataFrame(data, "hadm_id long, x double, y int, _fold int"), "y", None)
    got = ls.cross_validated(df, ["x"], "y", md.WEIGHT, "_fold", [(0.0, 0.01)])
    want = []
    for k in range(3):
        est = C.LogisticRegression(labelCol="y", standardization=False, regParam=0.01, tol=1e-12)
        model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"), est]).fit(df.filter(f"_fold != {k}"))
        want.append(BinaryClassificationEvaluator(labelCol="y", numBins=0).evaluate(model.transform(df.filter(f"_fold = {k}"))))
    assert got == pytest.approx([np.mean(want)])


def test_missing_values_and_other_labels_raise(spark):
    good = [(i, float(i % 5), i % 2) for i in range(60)]
    for bad, words in (((60, None, 1), "null or NaN"), ((60, 1.0, None), "null or NaN"), ((60, 1.0, 2), "neither 0 nor 1")):
        df = spark.createDataFrame([*good, bad], "hadm_id long, x double, y int")
        with pytest.raises(Exception, match=words):
            tune.random_search(df, ["x"], "y", "classifier", "logistic")
