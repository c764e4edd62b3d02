"""Hard-negative mining against plain scans of all rows."""

import math
import random

import numpy as np
import pyarrow.parquet as pq

from carepath.llm import hard_negatives as hn
from carepath.llm.queries import op13_hard_negatives

SF001 = "/root/testdata/sf0.001"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, every=50, shift=7, labels=10, positives=5, negatives=3):
    """Result rows for (id, vector, label), by scanning all rows for every anchor."""
    good = {}
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = tuple(math.floor(min(max(256 * float(x), -(1 << 24)), 1 << 24)) for x in v)
        good[(i, (label + 1) % labels if i % shift == 0 else label, q)] = True
    good = list(good)
    out = []
    for a in good:
        if a[0] % every:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(a[2], b[2])), b[0], b) for b in good if b != a and len(a[2]) == len(b[2])),
                        key=lambda s: s[:2])
        for s, i, _ in [x for x in scored if x[2][1] == a[1]][:positives]:
            hard = [(t, j) for t, j, b in scored if b[1] != a[1] and 50 * -s <= 100 * -t <= 95 * -s][:negatives]
            out += [(a[0], i, n + 1, j, -s, -t) for n, (t, j) in enumerate(hard)]
    return sorted(out)


def result(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def made(n, dim, seed, spread=0.4):
    """Clustered vectors with labels that mostly follow the cluster."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, dim))
    at = rng.integers(0, 6, n)
    x = centres[at] + spread * rng.standard_normal((n, dim))
    return [(i, [float(v) for v in x[i] / np.linalg.norm(x[i])], int(at[i] if rng.random() < 0.6 else rng.integers(0, 10))) for i in range(n)]


def test_query_equals_brute_force_on_the_whole_table(spark):
    t = pq.read_table(f"{SF001}/embeddings.parquet").to_pydict()
    want = brute(zip(t["vec_id"], t["embedding"], t["label"]))
    assert want and result(op13_hard_negatives(spark, SF001)) == want


def test_many_pages_clusters_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(hn, "PAGE", 37)
    monkeypatch.setattr(hn, "CLUSTER_MEMBERS", 8)
    monkeypatch.setattr(hn, "MEMBERS_PER_TASK", 5)
    rows = made(900, 8, 3)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    want = brute(rows, every=20)
    assert want and result(hn.hard_negatives(df, every=20)) == want


def test_a_walk_ends_early_on_clustered_vectors(spark, monkeypatch):
    """Members stop before the end of the list where the bounds certify it."""
    monkeypatch.setattr(hn, "PAGE", 10)
    monkeypatch.setattr(hn, "CLUSTER_MEMBERS", 4)
    asked = []
    real = hn.cut
    monkeypatch.setattr(hn, "cut", lambda df, name: (lambda out: (asked.append(out.count()) if name == "asked" else None, out)[1])(real(df, name)))
    rows = made(300, 8, 4, spread=0.02)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert result(hn.hard_negatives(df)) == brute(rows)
    anchors = sum(i % 50 == 0 for i, _, _ in rows)
    assert sum(asked) < 0.8 * anchors * 2 * 30          # of two walks over 30 pages each


def test_hard_cases(spark):
    rng = random.Random(2)
    nan, inf = float("nan"), float("inf")
    rows = [(i, [rng.randint(-2, 2) / 4 for _ in range(3)], rng.randint(0, 2)) for i in range(0, 200, 5)]      # ties in plenty
    rows += [(i, [0.0, 0.0, 0.0], 1) for i in range(1000, 1120, 10)]                                            # zero vectors, anchors too
    rows += [(i, [1.0, 2.0], i % 3) for i in range(2000, 2100, 10)] + [(2050, [1.0, 2.0], 2)]                    # another length; a repeated row
    rows += [(100, [0.5, 0.5, 0.5], 0), (100, [0.5, 0.25, 0.5], 1)]                                             # rows that share an id
    rows += [(3000, None, 1), (3050, [], 1), (3100, [None, 1.0, 1.0], 1), (3150, [nan, 1.0, 1.0], 1), (3200, [inf, 0.0, 0.0], 1),
             (3250, [1.0, 1.0, 1.0], None), (None, [1.0, 1.0, 1.0], 1)]
    rows += [(4000 + i, [1e30, -1e30, 1e9], i % 2) for i in (0, 50, 51, 53)] + [(-50, [0.5, 0.5, 0.5], 2)]
    rows += [(5000 + i, [0.9, 0.9, 0.9], 2) for i in range(40)] + [(6000 + i, [0.6, 0.6, 0.6], 1) for i in range(40)]   # groups of copies
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, tie string, cluster int")
    assert result(hn.hard_negatives(df, every=50)) == brute(rows)
    assert hn.hard_negatives(df.limit(0)).collect() == []
    assert hn.hard_negatives(df.where("vec_id = 51")).collect() == []


def test_products_are_exact_integers():
    a, b = np.array([[1 << 24, -(1 << 24), 3]]), np.array([[1 << 24, 1 << 24, 5], [1 << 24, -(1 << 24), 7]])
    assert hn._products(a.astype(np.int64), b.astype(np.int64)).tolist() == [[15, (1 << 49) + 21]]
