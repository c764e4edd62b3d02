"""Entry B: train, evaluate, compare and explain readmission classifiers.

Input is the keyed, split table from ``etl.preprocess``; every output is a
DataFrame (metrics, leaderboard, importances, attributions) plus the fitted
models.  Nothing is aligned by row position.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepath.operators import evaluate as ev
from carepath.operators import explain as xp
from carepath.operators import models as md
from carepath.operators import tune as tn
from carepath.operators.clean import remove_leakage
from carepath.session import checkpoint
from carepath.sources.tables import save_model

TARGET = "is_readmission"


@dataclass
class ReadmissionRun:
    models: dict[str, md.Fitted]
    metrics: dict[str, DataFrame]
    leaderboard: DataFrame
    best: str
    importance: DataFrame | None
    attributions: DataFrame | None
    extra: dict = field(default_factory=dict)


def evaluate_classifiers(fitted: dict[str, md.Fitted], test: DataFrame, target: str = TARGET) -> DataFrame:
    """E1, E3, E4 of all models from one scoring of the test rows: their
    scores are written once in long form (model, label, score), and every
    metric of every model comes from it.  A row per model, collected."""
    scored, cols = test, {name: f"_s_{name}" for name in fitted}
    for name, c in cols.items():
        scored = fitted[name].score(scored, c)
    long = checkpoint(ev.scores_by_model(scored, cols, target))
    rows = ev.classification_metrics_by_model(long).withColumnRenamed("model", "model_name")
    return test.sparkSession.createDataFrame(rows.collect(), rows.schema)


def run(data: DataFrame, features: list[str], models: tuple[str, ...] = tuple(md.CLASSIFIERS),
        tune_models: bool = False, selection: str | None = None, explain: bool = True,
        save_dir: str | None = None, target: str = TARGET) -> ReadmissionRun:
    data = remove_leakage(data)
    train, test = data.filter(F.col("split") == "train"), data.filter(F.col("split") == "test")
    extra = {}
    if selection:
        sel = tn.select_features(train, features, target, method=selection)
        features = [r.feature for r in sel.filter("selected").collect()]
        extra["selection"] = sel
    fitted, metrics = {}, {}
    if tune_models:
        for name in models:
            fitted[name], extra[f"tuning_{name}"] = tn.random_search(train, features, target, "classifier", name)
    else:
        fitted = md.fit_many({n: md.CLASSIFIERS[n] for n in models}, train, features, target)
    rows = evaluate_classifiers({name: fitted[name] for name in models}, test, target)
    for name in models:
        metrics[name] = rows.filter(F.col("model_name") == name)
        if save_dir:
            save_model(fitted[name].model, f"{save_dir.rstrip('/')}/{name}")
    board = ev.ranked_models(rows, "roc_auc", list(models))
    best = ev.best_model(board, "roc_auc")
    imp = xp.importance_table(fitted[best], top=20) if best else None
    att = None
    if explain and best:
        if best == "logistic":
            att = xp.linear_attribution(fitted[best], test, ["hadm_id"])
        else:
            att = xp.monte_carlo_shapley(fitted[best], test, "hadm_id", train)
        extra["attribution_summary"] = xp.attribution_summary(att)
    return ReadmissionRun(fitted, metrics, board, best, imp, att, extra)
