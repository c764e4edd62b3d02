"""Quality classifier: fitting against plain solvers, held-out accuracy, defined cases."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from carepath.llm import quality as q
from carepath.llm.queries import op12_quality

SF01 = "/root/testdata/sf0.01"


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    for s in np.unique(score):
        rank[score == s] = rank[score == s].mean()
    n1 = int(y.sum())
    return (rank[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


def test_descent_reaches_the_hinge_loss_minimum():
    """The dual solution has no gap to the primal one."""
    rng = np.random.default_rng(3)
    rows, y = [], []
    for _ in range(120):
        at = np.sort(rng.choice(30, 8, replace=False))
        rows.append((at, rng.standard_normal(8)))
        y.append(1.0 if rows[-1][1][at < 15].sum() + 0.5 * rng.standard_normal() > 0 else -1.0)
    y, cost = np.array(y), np.full(120, 0.7)
    w = q.dual_coordinate_descent(rows, y, cost, 30, epochs=3000, tolerance=1e-7).astype(float)
    x = np.zeros((120, 30))
    for i, (at, v) in enumerate(rows):
        x[i, at] = v
    primal = lambda w: w @ w / 2 + (cost * np.maximum(0, 1 - y * (x @ w))).sum()
    best = primal(w)
    v = w.copy()
    for step in range(20000):                                   # subgradient steps can't do better
        g = v - ((cost * y)[:, None] * x)[(y * (x @ v)) < 1].sum(0)
        v = v - g / (step + 10)
    assert best <= primal(v) + 1e-4


def test_logistic_curve_is_the_likelihood_maximum():
    rng = np.random.default_rng(4)
    m = rng.standard_normal(400)
    y = np.where(rng.random(400) < 1 / (1 + np.exp(-(2 * m - 0.5))), 1, -1)
    a, b = q.logistic_curve(m, y)
    n1, n0 = (y > 0).sum(), (y < 0).sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    p = 1 / (1 + np.exp(-(a * m + b)))
    assert abs((p - t).sum()) < 1e-6 and abs(((p - t) * m).sum()) < 1e-6
    assert all(np.isfinite(q.logistic_curve(np.array([-1.0, -2, 1, 2]), np.array([-1, -1, 1, 1]))))


def test_indicators_see_words_bytes_and_repetition():
    ind = q.Indicators()
    a, b = ind("alpha beta gamma"), ind("alpha beta gamma")
    assert a.tolist() == b.tolist() == sorted(set(a.tolist())) and not ind.flag.any()
    assert len(ind("")) == len(ind(None)) == 0 and len(ind(" \n\t")) > 0
    shared = lambda x, y: len(np.intersect1d(ind(x), ind(y)))
    # Words never met: a run of one word looks like another run of one word.
    assert shared("zq zq zq zq zq", "kx kx kx kx kx") > shared("zq zw ze zr zt", "kx kx kx kx kx")
    # The hash of a word doesn't depend on its place.
    words = [f"w{i}" for i in range(50)]
    assert set(ind(words[7])) - set(ind(" ".join(words))) == set()


def test_slices_of_long_texts_keep_the_indicators(monkeypatch):
    rng = random.Random(1)
    text = " ".join("".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(400))
    whole = set(q.Indicators()(text).tolist())
    monkeypatch.setattr(q, "SLICE", 100)
    parts = set(q.Indicators()(text).tolist())
    assert len(parts & whole) > 0.8 * len(whole)
    assert len(q.Indicators()("x" * 1000)) > 0                  # no space to cut at


def test_query_learns_from_its_fold_only_and_ranks_held_out_rows(spark):
    got = op12_quality(spark, SF01).join(spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id", "left").collect()
    assert len(got) == spark.read.parquet(f"{SF01}/documents.parquet").count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1
    held = [r for r in got if r.held_out and r.quality is not None]
    score, y = np.array([r.score for r in held]), np.array([r.quality for r in held])
    assert auc(score, y) > 0.97 and (score[y == 1] >= 0.3).mean() > 0.95


def test_held_out_labels_change_nothing(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").limit(300)
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    turned = labels.withColumn("quality", F.when(q.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r.doc_id: r.score for r in q.quality(docs, x).collect()} for x in (labels, turned))
    assert a == b


@pytest.mark.parametrize("labels, want", [([], 0.5), ([(1, 1), (2, None)], 1.0), ([(1, 0), (2, 0)], 0.0)])
def test_without_both_classes_every_score_is_the_share(spark, labels, want):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (3, "")], "doc_id long, text string")
    got = q.quality(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert [r.score for r in got] == [want] * 3


def test_defined_cases(spark):
    rng = random.Random(9)
    good = lambda: " ".join(rng.choice("the of and to in is it for".split()) for _ in range(30))
    bad = lambda: " ".join(rng.choice("$$$ ### %%% &&&".split()) for _ in range(30))
    rows = [(i, good() if i % 2 else bad(), i, "x") for i in range(200)]
    rows += [(None, good(), 0, "x"), (None, None, 0, "x"), (7, bad(), 0, "x"), (8, bad(), 0, "x"), (8, rows[8][1], 0, "x"), (900, "", 0, "x"),
             (901, bad() * 300, 0, "x"), (902, good() * 300, 0, "x")]
    labels = [(i, int(i % 2)) for i in range(200)] + [(3, 0), (None, 1), (5, None), (5000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int, _y string")
    table = spark.createDataFrame([(*x, 1.0) for x in labels], "doc_id long, quality int, text double")
    got = q.quality(docs, table).collect()
    again = q.quality(docs.repartition(5), table).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.score)
    assert len(got) == len(rows) and sorted(map(key, got)) == sorted(map(key, again))
    by = {r.doc_id: r for r in got}
    assert by[901].score < 0.3 < by[902].score and not [r for r in got if r.doc_id is None and r.held_out]
    assert all(r.predicted == 1 for r in got if r.doc_id is not None and r.doc_id < 200 and r.doc_id % 2 and r.doc_id != 7)
    assert all(r.predicted == 0 for r in got if r.doc_id is not None and r.doc_id < 200 and r.doc_id % 2 == 0)
    assert q.quality(docs.limit(0), table).collect() == []
