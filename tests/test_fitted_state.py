"""Saved pipelines score raw rows alike, also in a session that never saw the models."""

import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from carepath.operators import encode, fitted_state as fs, hist_boost as hb, quantile_boost as qb
from carepath.plans import readmission_plan as rp
from carepath.plans import resource_plan as rs

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def raw(spark):
    rng = np.random.default_rng(31)
    rows = [(i, float(rng.normal(60, 15)), None if i % 11 == 0 else float(rng.normal()), str(rng.choice(["A", "B", "C"])), float(rng.random()))
            for i in range(300)]
    df = spark.createDataFrame(rows, "hadm_id long, age double, lab double, unit string, u double")
    return df.withColumns({"y": (F.col("age") / 30 + F.when(F.col("unit") == "B", 1).otherwise(0) + F.col("u") > 2.6).cast("int"),
                           "days": F.col("age") / 10 + 5 * F.col("u")})


def test_one_pipeline_from_raw_rows_to_predictions(spark, raw, tmp_path):
    scaler = encode.fit_scaler(raw, ["age"])
    hot = encode.fit_one_hot(raw, ["unit"])
    ready = hot.transform(scaler.transform(raw))
    features = ["age", "lab", "unit_B", "unit_C"]
    booster = hb.leafwise_classifier(ready, features, "y", rounds=4, min_rows=5)
    quantiles = qb.fit_quantile_set(ready, features, "days", (0.5, 0.9), n_stages=3)
    model = fs.scoring_pipeline(fs.ScaledColumns.of(scaler), fs.OneHotColumns.of(hot), fs.BoostedScore.of(booster, "risk"),
                                fs.QuantileColumns.of(quantiles, "days"))
    path, data, out = str(tmp_path / "model"), str(tmp_path / "raw"), str(tmp_path / "out")
    model.write().overwrite().save(path)
    columns = ["hadm_id", "risk", "predicted_days_q50", "predicted_days_q90"]
    want = quantiles.predict(booster.score(ready, "risk"), "days").select(*columns).orderBy("hadm_id").collect()
    assert PipelineModel.load(path).transform(raw).select(*columns).orderBy("hadm_id").collect() == want
    raw.write.parquet(data)
    code = ("import sys; sys.path.insert(0, %r)\nfrom carepath.session import get_session\nspark = get_session('local[1]', 'fresh', 1)\n"
            "from pyspark.ml import PipelineModel\nPipelineModel.load(%r).transform(spark.read.parquet(%r)).select(*%r).write.parquet(%r)\n"
            % (ROOT, path, data, columns, out))
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300, capture_output=True)
    assert spark.read.parquet(out).orderBy("hadm_id").collect() == want


def test_resource_features_from_the_saved_best_classifier(spark, raw, tmp_path):
    table = raw.fillna(0.0, ["lab"]).withColumns({"split": F.when(F.col("hadm_id") % 4 == 0, "test").otherwise("train"), "is_readmission": F.col("y"),
                                                   "total_los_days": F.col("days")})
    run = rp.run(table, ["age", "lab", "u"], models=("logistic", "random_forest"), explain=False)
    path = str(tmp_path / "best")
    fs.save_best_classifier(run, path)
    data, features = rs.with_saved_readmission_probability(table, ["age", "lab", "u"], path)
    got = [r.readmission_probability for r in data.orderBy("hadm_id").collect()]
    assert got == [r.p for r in run.models[run.best].score(table, "p").orderBy("hadm_id").collect()]
    assert features[-1] == "readmission_probability" and set(data.columns) == {*table.columns, "readmission_probability"}
    with pytest.raises(ValueError):
        fs.with_saved_probability(table, path, label="age")


def test_empty_and_missing_state_come_back(spark):
    for model in (encode.ScalerModel({"a": (None, 0.0)}), encode.OneHotModel({"k": ["x", None]}, False)):
        kind = fs.ScaledColumns if isinstance(model, encode.ScalerModel) else fs.OneHotColumns
        assert kind.of(model).fitted() == model
    t = hb.Tree()
    t.split(0, 1, 0, float("-inf"))
    assert fs._tree(fs._tree_state(t)).cut == t.cut
