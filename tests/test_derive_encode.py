"""X3-X12, F1-F3 golden cases (FIXTURES §3-4 and the reference's test assertions)."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from carepath.functions.expressions import python_title, race_standardized
from carepath.functions.names import clean_feature_names
from carepath.operators import derive, encode


def test_language_and_marital_flags(spark):
    df = spark.createDataFrame([(None, "MARRIED"), ("english", None), ("Other", "SINGLE")],
                               "language string, marital_status string")
    got = [(r.english_lang, r.is_married) for r in derive.with_binary_flags(df).collect()]
    assert got == [(0, 1), (1, 0), (0, 0)]


def test_race_cases(spark):
    df = spark.createDataFrame([("HISPANIC/LATINO - CUBAN",), (None,), ("PORTUGUESE",), ("BLACK/CAPE VERDEAN",),
                                ("MULTI-RACE ETHNICITY",)], "race string")
    got = [r.s for r in df.select(race_standardized(F.col("race")).alias("s")).collect()]
    assert got == ["Latino", "Other", "Portuguese", "Black", "Multi-Race"]


@settings(max_examples=40, deadline=None)
@given(st.text(alphabet="abcXYZ-'9 éÉ/", min_size=0, max_size=12))
def test_python_title_matches_python(spark, s):
    got = spark.createDataFrame([(s,)], "s string").select(python_title(F.col("s")).alias("t")).first().t
    assert got == s.title()


def test_los_clip_and_null(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 5), dt.datetime(2020, 1, 1)),
                                (dt.datetime(2020, 1, 1), None),
                                (dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2, 12))],
                               "admittime timestamp, dischtime timestamp")
    assert [r.total_los_days for r in derive.with_los(df).collect()] == [0.0, None, 1.5]


def test_icu_split_golden(spark):
    # FIXTURES §3: seven stays, maximum comorbidity score 5.
    los = [4, 6, 3, 6, 3, 6, 3]
    scores = [2, 3, 4, 2, 1, 5, 2]
    rows = []
    for i, (l, s) in enumerate(zip(los, scores)):
        flags = [1] * s + [0] * (8 - s)
        rows.append((101 + i, dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 1) + dt.timedelta(days=l), *flags))
    cols = ["hadm_id long", "admittime timestamp", "dischtime timestamp"] + [f"{c} int" for c in
        ["hypertension", "diabetes", "kidney_disease", "copd", "atrial_fibrillation",
         "coronary_artery_disease", "obesity", "anemia"]]
    out = derive.length_of_stay(spark.createDataFrame(rows, ", ".join(cols))).orderBy("hadm_id").collect()
    assert out[0].total_los_days == 4.0
    icu = [round(r.icu_los_days, 2) for r in out]
    assert icu == [1.28, 2.28, 1.32, 1.92, 0.78, 3.0, 0.96]
    assert all(abs(r.icu_los_days + r.non_icu_los_days - r.total_los_days) < 1e-12 for r in out)


def test_scaler_population_std(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (6.0, 5.0)], "x double, c double")
    out, model = encode.standard_scale(df, ["x", "c", "absent"])
    assert model.stats["x"][1] == pytest.approx(1.870829, abs=1e-6)
    assert [r.c for r in out.collect()] == [0.0] * 4
    assert [round(r.x, 6) for r in out.collect()][0] == round((1 - 3) / 1.8708286933869707, 6)


def test_one_hot_reference_shapes(spark):
    df = spark.createDataFrame([("A", "X", 1), ("B", "Y", 2), ("A", "Y", 3), ("C", "Z", 4)],
                               "categorical_col1 string, categorical_col2 string, numerical_col int")
    out, model = encode.one_hot(df, ["categorical_col1", "categorical_col2"])
    assert set(out.columns) == {"numerical_col", "categorical_col1_B", "categorical_col1_C",
                                "categorical_col2_Y", "categorical_col2_Z"}
    assert (out.count(), len(out.columns)) == (4, 5)
    same, none = encode.one_hot(df, [])
    assert none is None and same is df


def test_one_hot_fit_train_apply_test_unseen(spark):
    tr = spark.createDataFrame([(1, 1.0, "A"), (2, 2.0, "B"), (3, 3.0, "C"), (4, 4.0, "A"), (5, 5.0, "B")],
                               "feature1 int, feature2 double, categorical string")
    te = spark.createDataFrame([(6, 6.0, "A"), (7, 7.0, "D")], "feature1 int, feature2 double, categorical string")
    model = encode.fit_one_hot(tr, ["categorical"])
    a, b = model.transform(tr), model.transform(te)
    assert (a.count(), len(a.columns)) == (5, 4) and (b.count(), len(b.columns)) == (2, 4)
    assert [(r.categorical_B, r.categorical_C) for r in b.collect()] == [(0.0, 0.0), (0.0, 0.0)]


def test_one_hot_null_is_a_category(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "c string")
    out, _ = encode.one_hot(df, ["c"])
    assert out.columns == ["c_b", "c_nan"]


def test_one_hot_cardinality_cap(spark):
    df = spark.range(20).selectExpr("cast(id as string) as c")
    with pytest.raises(ValueError):
        encode.fit_one_hot(df, ["c"], max_categories=10)


def test_clean_feature_names(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `c/d` int")
    assert clean_feature_names(df).columns == ["a_b", "c_d"]
    with pytest.raises(ValueError):
        clean_feature_names(spark.createDataFrame([(1, 2)], "`a b` int, `a_b` int"))


def test_parse_timestamps(spark):
    from carepath.functions.expressions import parse_timestamps
    df = spark.createDataFrame([("2020-01-01 12:00:00", "x"), ("garbage", "y"), (None, "z")], "admittime string, k string")
    out = parse_timestamps(df, ["admittime", "missing"]).collect()
    assert out[0].admittime == dt.datetime(2020, 1, 1, 12) and out[1].admittime is None and out[2].admittime is None
    assert dict(parse_timestamps(df, ["admittime"]).dtypes)["admittime"] == "timestamp"
