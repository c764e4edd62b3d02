"""Entry B and C plans end to end on a small keyed table."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from carepath.plans import readmission_plan as rp
from carepath.plans import resource_plan as rs
from carepath.plans.reports import write_run


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(11)
    n = 600
    X = rng.normal(size=(n, 3))
    y = (X[:, 0] - 0.5 * X[:, 1] + rng.normal(size=n) > 0.3).astype(int)
    los = np.exp(1.2 + 0.3 * X[:, 2] + 0.2 * rng.normal(size=n))
    rows = [(i, i // 3, "test" if i % 5 == 0 else "train", int(y[i]), float(los[i]), *map(float, X[i]))
            for i in range(n)]
    return spark.createDataFrame(
        rows, "hadm_id long, subject_id long, split string, is_readmission int, total_los_days double, "
              "a double, b double, c double")


def test_readmission_plan(table, tmp_path):
    out = rp.run(table, ["a", "b", "c"], models=("logistic", "random_forest"), explain=True)
    board = out.leaderboard.orderBy("rank").collect()
    assert [r["rank"] for r in board] == [1, 2] and out.best == board[0].model_name
    assert board[0].roc_auc >= board[1].roc_auc and board[0].roc_auc > 0.7
    assert out.attributions.select("hadm_id").distinct().count() == table.filter("split = 'test'").count()
    written = write_run(out, str(tmp_path), "run1")
    assert "leaderboard" in written and "importance" in written


def test_resource_plan(table):
    data, feats = rs.with_readmission_probability(table, ["a", "b", "c"])
    assert data.filter(F.col("readmission_probability").isNull()).count() == 0
    out = rs.run(data, feats, models=("linear", "ridge"), quantiles=(0.5, 0.9),
                 quantile_params={"n_stages": 15, "checkpoint_every": 5})
    assert out.target == "total_los_days" and out.best in ("linear", "ridge")
    s = out.summary.first()
    assert s.min_prediction <= s.median_prediction <= s.max_prediction
    cap = out.capacity.first()
    assert cap.q90_capacity_need == pytest.approx(cap.q90_total)
    cov = out.extra["quantile_coverage"].first()
    assert 0.75 <= cov.q90_coverage <= 1.0


def test_choose_target(table):
    assert rs.choose_target(table.drop("total_los_days").withColumn("icu_los_days", F.lit(1.0))) == "icu_los_days"
    with pytest.raises(ValueError):
        rs.choose_target(table.drop("total_los_days"))
