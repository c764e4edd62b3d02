"""Fitted state as Spark ML transformers (S9): one ``PipelineModel`` carries
raw rows to predictions, and is saved and loaded by Spark ML's own writer.

Each transformer holds its state as JSON in a param, so ``write``/``read`` and
``PipelineModel.load`` in a fresh session need nothing else; ``fitted`` gives
back the model that the plans work with.
"""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from carepath.operators.encode import OneHotModel, ScalerModel
from carepath.operators.hist_boost import BoostedTrees, Boosting, Tree
from carepath.operators.quantile_boost import QuantileTrees


def _tree_state(t: Tree) -> dict:
    # Bin numbers matter in training only; a cut of minus infinity (missing values left) has no JSON number.
    return {"feature": t.feature, "cut": [None if c == float("-inf") else c for c in t.cut], "left": t.left, "right": t.right, "value": t.value}


def _tree(state: dict) -> Tree:
    return Tree(state["feature"], [0] * len(state["feature"]), [float("-inf") if c is None else c for c in state["cut"]],
                state["left"], state["right"], state["value"])


class _State(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A transformer whose fitted state is a JSON param."""

    state = Param(Params._dummy(), "state", "fitted state, as JSON", TypeConverters.toString)

    def __init__(self, state: dict | None = None):
        super().__init__()
        if state is not None:
            self._set(state=json.dumps(state))

    def value(self) -> dict:
        return json.loads(self.getOrDefault(self.state))


class ScaledColumns(_State):
    """columns scaled by fitted means and deviations."""

    @classmethod
    def of(cls, model: ScalerModel) -> "ScaledColumns":
        return cls({"stats": {c: list(v) for c, v in model.stats.items()}})

    def fitted(self) -> ScalerModel:
        return ScalerModel({c: tuple(v) for c, v in self.value()["stats"].items()})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.fitted().transform(dataset)


class OneHotColumns(_State):
    """columns replaced by the indicators of a fitted vocabulary."""

    @classmethod
    def of(cls, model: OneHotModel) -> "OneHotColumns":
        return cls({"categories": model.categories, "drop_first": model.drop_first})

    def fitted(self) -> OneHotModel:
        state = self.value()
        return OneHotModel(state["categories"], state["drop_first"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.fitted().transform(dataset)


class BoostedScore(_State):
    """M3, M4, M9: adds the score of a booster on binned histograms."""

    @classmethod
    def of(cls, model: BoostedTrees, out: str) -> "BoostedScore":
        return cls({"features": model.features, "settings": vars(model.settings), "base": model.base, "out": out,
                    "trees": [_tree_state(t) for t in model.trees]})

    def fitted(self) -> BoostedTrees:
        s = self.value()
        return BoostedTrees(s["features"], Boosting(**s["settings"]), s["base"], [], [_tree(t) for t in s["trees"]])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.fitted().score(dataset, self.value()["out"])


class QuantileColumns(_State):
    """Adds a prediction column per quantile."""

    @classmethod
    def of(cls, model: QuantileTrees, target: str) -> "QuantileColumns":
        return cls({"features": model.features, "label": model.label, "quantiles": model.quantiles, "rate": model.learning_rate, "base": model.base,
                    "target": target, "trees": [[_tree_state(t) for t in trees] for trees in model.trees]})

    def fitted(self) -> QuantileTrees:
        s = self.value()
        return QuantileTrees(s["features"], s["label"], s["quantiles"], s["rate"], s["base"], [], [[_tree(t) for t in trees] for trees in s["trees"]])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.fitted().predict(dataset, self.value()["target"])


class PositiveScore(_State):
    """The positive-class probability of Spark's classifiers as a plain column, their own columns dropped."""

    @classmethod
    def of(cls, out: str) -> "PositiveScore":
        return cls({"out": out})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        from pyspark.ml.functions import vector_to_array
        scored = dataset.withColumn(self.value()["out"], vector_to_array("probability").getItem(1))
        return scored.drop("features", "rawPrediction", "probability", "prediction")


def scoring_pipeline(*stages) -> PipelineModel:
    """One model of fitted stages (transformers, or whole pipelines, which are opened)."""
    flat = []
    for s in stages:
        flat += s.stages if isinstance(s, PipelineModel) else [s]
    return PipelineModel(stages=flat)


def save_best_classifier(run, path: str, out: str = "readmission_probability") -> None:
    """The leaderboard's best classifier with what makes its probability a column."""
    scoring_pipeline(run.models[run.best].model, PositiveScore.of(out)).write().overwrite().save(path)


def with_saved_probability(data: DataFrame, path: str, label: str = "is_readmission") -> DataFrame:
    """Score rows with a saved classifier (keyed rows in, one column more)."""
    model = PipelineModel.load(path)
    if any(label in s.getInputCols() for s in model.stages if isinstance(s, VectorAssembler)):
        raise ValueError("the saved classifier reads the label")
    return model.transform(data)
