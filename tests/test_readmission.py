"""W1-W3 golden cases (FIXTURES §4) and the skew-split path."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from carepath.operators.readmission import flag_readmissions, readmission_rate

SCHEMA = "subject_id long, hadm_id long, admittime timestamp, dischtime timestamp"


def T(*a):
    return dt.datetime(*a)


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    out = flag_readmissions(df, **kw).orderBy("subject_id", "admittime", "hadm_id").collect()
    return [(r.hadm_id, r.is_readmission, r.days_until_readmission) for r in out]


def test_inside_window(spark):
    rows = [(1, 10, T(2020, 1, 1), T(2020, 1, 1, 12)), (1, 11, T(2020, 1, 11), T(2020, 1, 12))]
    assert run(spark, rows) == [(10, False, None), (11, True, 9.5)]


def test_window_bounds(spark):
    d = T(2020, 1, 1)
    rows = [(1, 1, T(2019, 12, 30), d), (1, 2, d + dt.timedelta(days=30), d + dt.timedelta(days=31)),
            (2, 3, T(2019, 12, 30), d), (2, 4, d + dt.timedelta(days=30, seconds=1), d + dt.timedelta(days=32))]
    got = dict((h, f) for h, f, _ in run(spark, rows))
    assert got == {1: False, 2: True, 3: False, 4: False}


def test_zero_gap_overlap_single_and_null(spark):
    rows = [(1, 1, T(2020, 1, 1), T(2020, 1, 5)), (1, 2, T(2020, 1, 5), T(2020, 1, 6)),   # gap 0
            (2, 3, T(2020, 1, 1), T(2020, 1, 10)), (2, 4, T(2020, 1, 5), T(2020, 1, 12)),  # overlap
            (3, 5, T(2020, 1, 1), T(2020, 1, 2)),                                         # single
            (4, 6, T(2020, 1, 1), None), (4, 7, T(2020, 1, 3), T(2020, 1, 4))]            # null discharge
    got = {h: (f, d) for h, f, d in run(spark, rows)}
    assert all(not f for f, _ in got.values())
    assert got[5] == (False, None)


def test_three_stays(spark):
    rows = [(1, i, T(2020, 1, 1) + dt.timedelta(days=11 * i), T(2020, 1, 2) + dt.timedelta(days=11 * i))
            for i in range(3)]
    assert [f for _, f, _ in run(spark, rows)] == [False, True, True]


def test_repeated_id_flags_every_row(spark):
    rows = [(1, 7, T(2020, 1, 1), T(2020, 1, 2)), (1, 8, T(2020, 1, 5), T(2020, 1, 6)),
            (2, 8, T(2021, 1, 1), T(2021, 1, 2))]
    got = run(spark, rows, propagate_ids=True)
    assert [f for h, f, _ in got if h == 8] == [True, True]


def test_hot_key_buckets_match_plain_window(spark):
    # One patient with many stays forced through the bucketed path.
    base = T(2020, 1, 1)
    rows = [(1, i, base + dt.timedelta(days=3 * i + (i % 5)), base + dt.timedelta(days=3 * i + 1))
            for i in range(200)]
    rows += [(2, 1000 + i, base + dt.timedelta(days=40 * i), base + dt.timedelta(days=40 * i + 2))
             for i in range(10)]
    plain = run(spark, rows)
    split = run(spark, rows, rows_per_bucket=7)
    assert plain == split
    assert sum(f for _, f, _ in plain) > 100


def test_rate(spark):
    rows = [(1, 1, T(2020, 1, 1), T(2020, 1, 2)), (1, 2, T(2020, 1, 5), T(2020, 1, 6))]
    df = flag_readmissions(spark.createDataFrame(rows, SCHEMA))
    r = readmission_rate(df).first()
    assert (r.n_readmissions, r.n_admissions, r.readmission_rate) == (1, 2, 0.5)


def test_rate_empty_is_null(spark):
    df = flag_readmissions(spark.createDataFrame([], SCHEMA))
    r = readmission_rate(df).first()
    assert (r.n_readmissions, r.n_admissions, r.readmission_rate) == (0, 0, None)


def test_fixture_counts(spark):
    from carepath.plans.queries import QUERIES
    r = QUERIES["readmission_rate"](spark, "/root/testdata/sf0.01").first()
    assert (r.n_admissions, r.n_readmissions) == (6487, 746)
