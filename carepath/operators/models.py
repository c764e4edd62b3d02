"""Model training on Spark ML.

Every estimator is a ``Pipeline(VectorAssembler, estimator)`` fitted on a
keyed DataFrame: the label and optional weight are columns of the same
table, so rows never have to be re-aligned by position.  Parameters are
translated from the scikit-learn / boosting settings of the analysed
pipeline; the comments give each translation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml import classification as C
from pyspark.ml import regression as R
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WEIGHT = "weight"
# A row's node in each tree is kept from pass to pass, so that no pass walks the trees from their roots; the trees are the same.
FOREST = {"cacheNodeIds": True}


def class_weights(train: DataFrame, label: str) -> DataFrame:
    """Class counts and the weights derived from them (A15):
    ``scale_pos_weight = n_neg / n_pos`` and balanced ``n / (2 n_k)``."""
    y = F.col(label).cast("int")
    c = train.agg(F.count(F.lit(1)).cast("long").alias("n"),
                  F.count_if(y == 1).cast("long").alias("n_pos"),
                  F.count_if(y == 0).cast("long").alias("n_neg"))
    return c.select("n", "n_pos", "n_neg",
                    F.try_divide(F.col("n_neg"), F.col("n_pos")).alias("scale_pos_weight"),
                    F.try_divide(F.col("n"), 2.0 * F.col("n_neg")).alias("weight_neg"),
                    F.try_divide(F.col("n"), 2.0 * F.col("n_pos")).alias("weight_pos"))


def weighted(df: DataFrame, label: str, mode: str | None, stats_df: DataFrame | None = None
             ) -> tuple[DataFrame, float]:
    """``df`` with a ``weight`` column, and the sum of the weights.

    'balanced' gives class k the weight n / (2 n_k), 'scale_pos' weights
    positives by n_neg / n_pos, None weights every row 1.  The class counts
    are one aggregate applied as literals; the weight sum follows from them."""
    w = class_weights(stats_df if stats_df is not None else df, label).first()
    n, n_pos, n_neg = int(w["n"]), int(w["n_pos"]), int(w["n_neg"])
    if mode is None:
        return df.withColumn(WEIGHT, F.lit(1.0)), float(n)
    y = F.col(label).cast("int")
    if mode == "balanced":
        wp, wn = float(w["weight_pos"] or 1.0), float(w["weight_neg"] or 1.0)
    elif mode == "scale_pos":
        wp, wn = float(w["scale_pos_weight"] or 1.0), 1.0
    else:
        raise ValueError(f"unknown weight mode {mode!r}")
    total = wp * n_pos + wn * n_neg + (n - n_pos - n_neg)   # other labels keep weight wn
    return df.withColumn(WEIGHT, F.when(y == 1, F.lit(wp)).otherwise(F.lit(wn))), float(total)


def with_weights(df: DataFrame, label: str, mode: str | None, stats_df: DataFrame | None = None
                 ) -> DataFrame:
    """Add a ``weight`` column (see ``weighted``)."""
    if mode is None:
        return df.withColumn(WEIGHT, F.lit(1.0))
    return weighted(df, label, mode, stats_df)[0]


def _pipeline(features: list[str], estimator) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features",
                                            handleInvalid="error"), estimator])


@dataclass
class Fitted:
    """A fitted pipeline and what is needed to score or explain it."""
    name: str
    model: PipelineModel
    features: list[str]
    label: str
    kind: str  # 'classifier' or 'regressor'

    @property
    def estimator(self):
        return self.model.stages[-1]

    def score(self, df: DataFrame, out: str | None = None) -> DataFrame:
        """Classifier: positive-class probability (R8); regressor: prediction."""
        scored = self.model.transform(df)
        if self.kind == "classifier":
            col = vector_to_array("probability").getItem(1)
        else:
            col = F.col("prediction")
        out = out or ("probability_1" if self.kind == "classifier" else f"predicted_{self.label}")
        return scored.withColumn(out, col).drop("features", "rawPrediction", "probability", "prediction")

    def importance(self) -> list[tuple[str, float]]:
        """Tree importances, else |coefficient|."""
        est = self.estimator
        if hasattr(est, "featureImportances"):
            vals = est.featureImportances.toArray().tolist()
        elif hasattr(est, "coefficients"):
            vals = [abs(v) for v in est.coefficients.toArray().tolist()]
        else:
            raise ValueError(f"{self.name} has neither importances nor coefficients")
        return list(zip(self.features, vals))


def _fit(name, kind, train, features, label, estimator) -> Fitted:
    return Fitted(name, _pipeline(features, estimator).fit(train), features, label, kind)


# ---------------------------------------------------------------- classifiers

def logistic_regression(train: DataFrame, features: list[str], label: str, C_: float = 1.0,
                        max_iter: int = 1000, weights: str | None = "balanced") -> Fitted:
    """M1: L2 logistic regression.  scikit-learn minimises
    ``0.5||w||² + C Σ w_i loss_i``; Spark minimises ``Σ w_i loss_i / Σ w_i +
    λ/2 ||w||²``, so ``λ = 1 / (C Σ w_i)``; balanced weights sum to n."""
    df, wsum = weighted(train, label, weights)
    wsum = wsum or 1.0
    est = C.LogisticRegression(featuresCol="features", labelCol=label, weightCol=WEIGHT,
                               regParam=1.0 / (C_ * wsum), elasticNetParam=0.0, standardization=False,
                               maxIter=max_iter, tol=1e-6, family="binomial")
    return _fit("LogisticRegression", "classifier", df, features, label, est)


def random_forest_classifier(train: DataFrame, features: list[str], label: str, num_trees: int = 100,
                             max_depth: int = 10, weights: str | None = "balanced", seed: int = 42,
                             **params) -> Fitted:
    """M2: 100 trees, √p features per split, balanced class weights.
    Unlimited depth has no Spark twin (the cap is 30); 10 is the default here."""
    df = with_weights(train, label, weights)
    est = C.RandomForestClassifier(featuresCol="features", labelCol=label, weightCol=WEIGHT,
                                   numTrees=num_trees, maxDepth=max_depth, featureSubsetStrategy="sqrt",
                                   seed=seed, **{**FOREST, **params})
    return _fit("RandomForest", "classifier", df, features, label, est)


def gbt_classifier(train: DataFrame, features: list[str], label: str, max_iter: int = 100,
                   step_size: float = 0.1, max_depth: int = 5, seed: int = 42, **params) -> Fitted:
    """M3: boosted trees, 100 rounds, learning rate 0.1; leaf-wise growth with
    31 leaves is approximated by depth 5."""
    est = C.GBTClassifier(featuresCol="features", labelCol=label, maxIter=max_iter, stepSize=step_size,
                          maxDepth=max_depth, seed=seed, **params)
    return _fit("BoostedTrees", "classifier", train, features, label, est)


def gbt_classifier_sampled(train: DataFrame, features: list[str], label: str, max_iter: int = 100,
                           max_depth: int = 3, step_size: float = 0.1, subsample: float = 0.8,
                           colsample: float = 0.8, seed: int = 42, **params) -> Fitted:
    """M4: depth-3 boosting with row and column sampling and positives weighted
    by ``n_neg / n_pos``.  Column sampling is per node in Spark."""
    df = with_weights(train, label, "scale_pos")
    est = C.GBTClassifier(featuresCol="features", labelCol=label, weightCol=WEIGHT, maxIter=max_iter,
                          maxDepth=max_depth, stepSize=step_size, subsamplingRate=subsample,
                          featureSubsetStrategy=str(colsample), seed=seed, **params)
    return _fit("BoostedTreesSampled", "classifier", df, features, label, est)


# ---------------------------------------------------------------- regressors

def _label_std(train: DataFrame, label: str, population: bool = False) -> tuple[float, int]:
    """Label std as each Spark solver uses it: the normal-equation solver
    standardises with the population std, L-BFGS with the sample std."""
    std = F.stddev_pop(label) if population else F.stddev_samp(label)
    r = train.agg(std.alias("s"), F.count(F.lit(1)).alias("n")).first()
    return float(r["s"] or 0.0), int(r["n"])


def linear_regression(train: DataFrame, features: list[str], label: str) -> Fitted:
    """M5: ordinary least squares (closed-form normal equations)."""
    est = R.LinearRegression(featuresCol="features", labelCol=label, regParam=0.0, solver="normal",
                             standardization=False)
    return _fit("LinearRegression", "regressor", train, features, label, est)


def ridge(train: DataFrame, features: list[str], label: str, alpha: float = 1.0) -> Fitted:
    """M6: ``||y - Xw||² + α||w||²``.  Spark divides its penalty by the label's
    std σ_y and the loss by 2n, so ``regParam = α σ_y / n`` (population σ_y
    for the exact normal-equation solver used here)."""
    sy, n = _label_std(train, label, population=True)
    est = R.LinearRegression(featuresCol="features", labelCol=label, regParam=alpha * sy / max(n, 1),
                             elasticNetParam=0.0, solver="normal", standardization=False)
    return _fit("Ridge", "regressor", train, features, label, est)


def elastic_net(train: DataFrame, features: list[str], label: str, alpha: float = 1.0,
                l1_ratio: float = 0.5) -> Fitted:
    """M7: ``1/(2n)||y - Xw||² + α r ||w||₁ + α(1-r)/2 ||w||²``.  With
    ``l1 = α r`` and ``l2 = α (1-r) σ_y``: ``regParam = l1 + l2``,
    ``elasticNetParam = l1 / (l1 + l2)``, solved by L-BFGS/OWL-QN."""
    sy, _ = _label_std(train, label)
    l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio) * sy
    reg = l1 + l2
    est = R.LinearRegression(featuresCol="features", labelCol=label, regParam=reg,
                             elasticNetParam=(l1 / reg) if reg else 0.0, solver="l-bfgs",
                             standardization=False, maxIter=1000, tol=1e-10)
    return _fit("ElasticNet", "regressor", train, features, label, est)


def random_forest_regressor(train: DataFrame, features: list[str], label: str, num_trees: int = 100,
                            max_depth: int = 10, seed: int = 42, **params) -> Fitted:
    """M8: 100 trees using all features at each split (scikit-learn's default
    for regression)."""
    est = R.RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=num_trees,
                                  maxDepth=max_depth, featureSubsetStrategy="all", seed=seed, **{**FOREST, **params})
    return _fit("RandomForest", "regressor", train, features, label, est)


def gbt_regressor(train: DataFrame, features: list[str], label: str, max_iter: int = 100,
                  step_size: float = 0.1, max_depth: int = 5, seed: int = 42, **params) -> Fitted:
    """M9: boosted regression trees, 100 rounds, learning rate 0.1."""
    est = R.GBTRegressor(featuresCol="features", labelCol=label, maxIter=max_iter, stepSize=step_size,
                         maxDepth=max_depth, seed=seed, **params)
    return _fit("BoostedTrees", "regressor", train, features, label, est)


CLASSIFIERS = {
    "logistic": logistic_regression,
    "random_forest": random_forest_classifier,
    "gbt": gbt_classifier,
    "gbt_sampled": gbt_classifier_sampled,
}
REGRESSORS = {
    "linear": linear_regression,
    "ridge": ridge,
    "elastic_net": elastic_net,
    "random_forest": random_forest_regressor,
    "gbt": gbt_regressor,
}


def fit_many(trainers: dict, train: DataFrame, features: list[str], label: str,
             parallelism: int = 4) -> dict[str, Fitted]:
    """Fit several independent models as concurrent Spark jobs."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        futures = {n: ex.submit(t, train, features, label) for n, t in trainers.items()}
        return {n: f.result() for n, f in futures.items()}


def coefficients(fitted: Fitted) -> DataFrame:
    """Intercept and coefficients of a linear model as rows ``(term, value)``."""
    from pyspark.sql import SparkSession
    est = fitted.estimator
    rows = [("intercept", float(est.intercept))] + list(
        zip(fitted.features, [float(v) for v in est.coefficients.toArray()]))
    return SparkSession.getActiveSession().createDataFrame(rows, "term string, value double")


def out_of_fold_scores(df: DataFrame, features: list[str], label: str, trainer=logistic_regression,
                       key: str = "hadm_id", folds: int = 5, seed: int = 42,
                       out: str = "readmission_probability") -> DataFrame:
    """Score every training row with a model that did not see it.  Folds
    are ``hash(seed|key) mod folds``; the union of the fold scores is keyed,
    so it can be joined back by ``key``."""
    from concurrent.futures import ThreadPoolExecutor

    from carepath.functions.expressions import hash_key
    fold = F.pmod(hash_key(F.col(key), seed), F.lit(folds))
    df = df.withColumn("_fold", fold)

    def one(k):
        m = trainer(df.filter(F.col("_fold") != k), features, label)
        return m.score(df.filter(F.col("_fold") == k), out).drop("_fold", WEIGHT)

    # the fold models are independent: fit them as concurrent Spark jobs
    with ThreadPoolExecutor(max_workers=folds) as ex:
        parts = list(ex.map(one, range(folds)))
    result = parts[0]
    for p in parts[1:]:
        result = result.unionByName(p)
    return result
