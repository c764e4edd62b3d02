import random

import numpy as np
import pytest

from carepath.llm.minhash_dedup import minhash_dedup
from carepath.llm.rp_forest import rp_forest_dedup
from carepath.llm.substring_dedup import deduped_texts, substring_dedup

from . import brute

SCHEMA = "doc_id long, text string, n_words string, _key int"


def texts(seed=1, n=60):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    shared = [" ".join(r.choices(vocabulary, k=k)) for k in (34, 35, 50, 90)]
    out = []
    for i in range(n):
        words = r.choices(vocabulary, k=r.choice([0, 5, 34, 60, 200]))
        at = r.randint(0, len(words))
        out.append("  ".join(words[:at]) + " " + r.choice([*shared, ""]) + "\n" + " ".join(words[at:]))
    out += [None, "", " \t\n", "x", "a a " * 60, "same " * 200, "same " * 90, out[3], out[3],
            " ".join(f"u{i}" for i in range(5000)), " ".join(f"u{i}" for i in range(20, 4000)), "tab one\x0bword " * 30]
    return out


def rows(ts):
    return [(i, t, "extra", 7) for i, t in enumerate(ts)]


def test_substring_against_brute_force(spark):
    data = rows(texts())
    got = substring_dedup(spark.createDataFrame(data, SCHEMA)).collect()
    want = brute.substring([(d, t) for d, t, *_ in data])
    assert sorted(map(tuple, got)) == sorted(want)
    assert sum(w[2] > 0 for w in want) > 20


def test_substring_other_widths(spark):
    data = [(i, t, "", 0) for i, t in enumerate(texts(5, 30))]
    for width, anchor in ((35, 10), (20, 20), (50, 12)):
        got = substring_dedup(spark.createDataFrame(data, SCHEMA), min_words=width, anchor=anchor).collect()
        assert sorted(map(tuple, got)) == sorted(brute.substring([(d, t) for d, t, *_ in data], width))


def test_substring_repeated_rows_null_ids_and_empty_table(spark):
    t = " ".join(f"v{i}" for i in range(40))
    df = spark.createDataFrame([(1, t, "", 0), (1, t, "", 0), (None, "lone", "", 0), (None, None, "", 0)], SCHEMA)
    got = sorted(((r.doc_id or -1), r.n_words, r.n_removed) for r in substring_dedup(df).collect())
    assert got == [(-1, 0, 0), (-1, 1, 0), (1, 40, 40), (1, 40, 40)]
    assert substring_dedup(df.limit(0)).collect() == []


def test_deduped_texts_keep_columns(spark):
    passage = " ".join(f"p{i}" for i in range(50))
    data = [(1, f"one  two {passage}\nthree", 9, "a"), (2, f"{passage} four", 9, None), (3, "five", 9, "b")]
    df = spark.createDataFrame(data, "doc_id long, text string, n_chars long, spots string")
    out = {r.doc_id: r for r in deduped_texts(df).collect()}
    assert deduped_texts(df).columns == df.columns
    assert [out[i].text for i in (1, 2, 3)] == ["one  two\nthree", " four", "five"]
    assert out[1].n_chars == len(out[1].text) and out[1].spots == "a"


def near_copies(seed=2):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    out = []
    for _ in range(12):
        base = r.choices(vocabulary, k=r.choice([3, 12, 80, 150]))
        for _ in range(r.choice([1, 2, 9])):
            copy = list(base)
            for _ in range(r.choice([0, 1, 2, 4, 7])):
                copy[r.randrange(len(copy))] = r.choice(vocabulary)
            out.append(" ".join(copy).upper() if r.random() < 0.2 else " ".join(copy))
    return out + [None, "", "one", "ONE", "two", "a b", "A  B", " \n"]


@pytest.mark.parametrize("size", [2, 5])
def test_minhash_against_brute_force(spark, size):
    data = rows(near_copies())
    got = minhash_dedup(spark.createDataFrame(data, SCHEMA), shingle=size).collect()
    want = brute.near_duplicates([(d, t) for d, t, *_ in data], size)
    assert sorted(map(tuple, got)) == sorted(want)
    assert sum(not w[3] for w in want) > 5


def test_minhash_links_through_the_centre_of_a_family(spark):
    """Copies that differ from the original, and more from one another, are one component."""
    r = random.Random(3)
    base = [f"b{i}" for i in range(100)]
    family = [base]
    for i in range(40):
        copy = list(base)
        for p in r.sample(range(0, 100, 10), 5):
            copy[p] = f"x{i}_{p}"
        family.append(copy)
    data = rows([" ".join(c) for c in family[1:]] + [" ".join(base)])
    got = minhash_dedup(spark.createDataFrame(data, SCHEMA), shingle=2).collect()
    want = brute.near_duplicates([(d, t) for d, t, *_ in data], 2)
    assert sorted(map(tuple, got)) == sorted(want)


def test_minhash_null_ids_repeated_rows_empty_table(spark):
    df = spark.createDataFrame([(5, "a b c", "", 0), (5, "a b c", "", 0), (None, "a b c", "", 0), (7, "a b c", "", 0)], SCHEMA)
    got = sorted(((r.doc_id is None, r.doc_id, r.component_id, r.kept) for r in minhash_dedup(df, shingle=2).collect()), key=str)
    assert got == [(False, 5, 5, True), (False, 5, 5, True), (False, 7, 5, False), (True, None, None, True)]
    assert minhash_dedup(df.limit(0)).collect() == []


def vectors(seed=4, dim=24):
    rng = np.random.default_rng(seed)
    out = [rng.standard_normal(dim) for _ in range(300)]
    for c in range(4):
        centre = rng.standard_normal(dim)
        out += [centre + rng.standard_normal(dim) * s for s in rng.choice([0.02, 0.1, 0.2], 60)]
    out += [out[0] * 3, out[0], -out[0], np.zeros(dim)]
    return [x.tolist() for x in out]


def test_rp_forest_against_brute_force(spark):
    data = vectors() + [None, [], [float("nan")] * 24, [1.0, None] * 12, [1.0, 2.0]]
    df = spark.createDataFrame([(i, v, "x") for i, v in enumerate(data)], "vec_id long, embedding array<double>, n string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in rp_forest_dedup(df, leaf=64, block=32).collect()}
    assert got == brute.cosine_links({i: v if v is None or len(v) != 2 else None for i, v in enumerate(data)})


def test_rp_forest_dense_knot_is_dealt_in_blocks(spark):
    rng = np.random.default_rng(5)
    centre = rng.standard_normal(16)
    data = [(i, (centre + rng.standard_normal(16) * 0.01).tolist()) for i in range(300)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    got = rp_forest_dedup(df, leaf=32, block=50).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(299, 0)}


def test_rp_forest_links_within_a_large_group_of_near_copies(spark):
    # Production parameters; pairs of a group have cosines on both sides of 0.95.
    rng = np.random.default_rng(6)
    x = rng.standard_normal(64) / 8 + rng.standard_normal((5000, 64)) * np.sqrt((1 / 0.95 - 1) / 64)
    x = np.vstack([x, rng.standard_normal((1500, 64))])
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = [int((unit[i:i + 500] @ unit.T >= 0.95)[j].sum()) - 1 for i in range(0, len(x), 500) for j in range(min(500, len(x) - i))]
    got = {r.vec_id: r.n_links for r in rp_forest_dedup(df).collect()}
    assert [got[i] for i in range(len(x))] == want


def test_rp_forest_null_ids_repeats_empty(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0]), (2, [2.0, 0.0])], "vec_id long, embedding array<double>")
    got = sorted((tuple(r) for r in rp_forest_dedup(df).collect()), key=str)
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (None, 0, None, True)]
    assert rp_forest_dedup(df.limit(0)).collect() == []


def test_rp_forest_compares_every_length_and_every_row_of_an_id(spark):
    rng = np.random.default_rng(8)
    rows = []
    for dim in (3, 24, 40):
        centre = rng.standard_normal(dim)
        rows += [(centre + rng.standard_normal(dim) * s).tolist() for s in rng.choice([0.05, 0.3, 2.0], 60)]
    rows += [[1.0, 2.0], [2.0, 4.0]]
    ids = [i % 70 for i in range(len(rows))]                     # ids shared by different vectors, of different lengths too
    data = list(zip(ids, rows)) + [(ids[3], rows[3]), (500, rows[3]), (501, rows[3])]
    df = spark.createDataFrame([(i, v, 1) for i, v in data], "vec_id long, embedding array<double>, key int")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in rp_forest_dedup(df, leaf=16, block=10).collect())
    units = sorted({(i, tuple(v)) for i, v in data})
    unit = [np.array(v) / np.linalg.norm(v) for _, v in units]
    links = [(a, b) for a in range(len(units)) for b in range(a) if len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.95]
    comp = brute.components(range(len(units)), links)
    least = {}
    for a in range(len(units)):
        least[comp[a]] = min(least.get(comp[a], 10 ** 9), units[a][0])
    n = [sum(a in pair for pair in links) for a in range(len(units))]
    want = {u: (n[a], least[comp[a]], units[a][0] == least[comp[a]]) for a, u in enumerate(units)}
    assert got == sorted((i, *want[i, tuple(v)]) for i, v in data)
    assert sum(w[0] for w in want.values()) > 500


def test_rp_forest_broadcasts_no_table_of_vectors(spark, monkeypatch):
    # Their files are far smaller than their rows, and AQE keeps a broadcast that was planned by file size.
    from carepath.llm import common, rp_forest
    plans, cut = {}, common.cut

    def joins(df):
        lines = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].splitlines()
        return [x for x in lines if "BroadcastHashJoin" in x or "BroadcastNestedLoopJoin" in x]

    def planned(df, name):
        plans.setdefault(name, []).extend(joins(df))
        return cut(df, name)

    monkeypatch.setattr(common, "cut", planned)
    monkeypatch.setattr(rp_forest, "cut", planned)
    r = np.random.default_rng(5)
    v = r.standard_normal((300, 16))
    v[150:] = v[:150] + 0.01 * r.standard_normal((150, 16))
    got = rp_forest_dedup(spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>"))
    assert (joins(got), plans["cc"]) == ([], [])
    assert len(plans["links"]) <= 1 and all("[leaf#" in x for x in plans["links"])        # one row a leaf
    assert {(r.vec_id, r.n_links, r.component_id) for r in got.collect()} == {(i, 1, i % 150) for i in range(300)}
