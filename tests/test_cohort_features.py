"""C1/C2, J1, A4-A6, J4 on literal frames."""

from pyspark.sql import functions as F

from carepath.operators import cohort, features
from carepath.operators import features as ft

DX = "subject_id long, hadm_id long, icd_code string, icd_version int"


def test_cohort_prefix_and_version(spark):
    dx = spark.createDataFrame([(1, 1, "I501", 10), (2, 2, "I501", 9), (3, 3, "I5", 10), (3, 4, "I509", 10)], DX)
    rows = cohort.cohort_diagnoses(dx)
    assert sorted(r.subject_id for r in rows.collect()) == [1, 3]
    c = cohort.cohort_counts(rows).first()
    assert (c.n_diagnoses, c.n_patients) == (2, 2)


def test_empty_cohort_keeps_schema(spark):
    dx = spark.createDataFrame([(1, 1, "X00", 10)], DX)
    rows = cohort.cohort_diagnoses(dx)
    assert rows.columns == dx.columns
    c = cohort.cohort_counts(rows).first()
    assert (c.n_diagnoses, c.n_patients) == (0, 0)


def test_prefix_filter_pushed_to_parquet(spark, tmp_path):
    p = str(tmp_path / "dx")
    spark.createDataFrame([(1, 1, "I501", 10)], DX).write.parquet(p)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = cohort.cohort_diagnoses(spark.read.parquet(p))._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(icd_code,I50)" in plan and "EqualTo(icd_version,10)" in plan


def test_semi_join_keeps_all_admissions(spark):
    adm = spark.createDataFrame([(1, 10), (1, 11), (2, 12)], "subject_id long, hadm_id long")
    ids = spark.createDataFrame([(1,)], "subject_id long")
    assert sorted(r.hadm_id for r in cohort.cohort_admissions(adm, ids).collect()) == [10, 11]


def test_comorbidities_default_map(spark):
    dx = spark.createDataFrame([(1, 1, "0414", 9), (1, 1, "42731", 9), (2, 2, "E119", 10),
                                (2, 2, "I2510", 10)], DX)
    subj = spark.createDataFrame([(1,), (2,), (3,)], "subject_id long")
    got = {r.subject_id: r.asDict() for r in features.comorbidity_flags(dx, subj).collect()}
    assert got[1]["coronary_artery_disease"] == 0      # 0414 is not a 414 prefix
    assert got[1]["atrial_fibrillation"] == 1
    assert got[2]["diabetes"] == 1 and got[2]["coronary_artery_disease"] == 1
    assert all(got[3][k] == 0 for k in features.COMORBIDITIES)   # no code -> zeros
    m = features.comorbidity_matches(dx, subj).first()
    assert m.total_matches == 3


def test_demographics_dedupe_and_optional_age(spark):
    pts = spark.createDataFrame([(1, "M", 70), (1, "F", 60), (2, "F", 50)],
                                "subject_id long, gender string, anchor_age int")
    subj = spark.createDataFrame([(1,)], "subject_id long")
    got = features.demographics(pts, subj).collect()
    assert [(r.subject_id, r.gender, r.anchor_age) for r in got] == [(1, "F", 60)]
    no_age = features.demographics(pts.drop("anchor_age"), subj)
    assert no_age.columns == ["subject_id", "gender"]


def test_patient_features_full_outer(spark):
    demo = spark.createDataFrame([(1, "M")], "subject_id long, gender string")
    com = spark.createDataFrame([(2, 1)], "subject_id long, copd int")
    got = sorted((r.subject_id, r.gender, r.copd) for r in features.patient_features(demo, com).collect())
    assert got == [(1, "M", None), (2, None, 1)]


def test_lab_means_pivot(spark):
    labs = spark.createDataFrame([(1, "NA", 140.0), (1, "NA", 136.0), (1, "K", 4.0), (2, "K", 5.0)],
                                 "hadm_id long, item string, value double")
    got = {r.hadm_id: r for r in features.lab_means(labs, {"NA": "sodium", "K": "potassium"}).collect()}
    assert got[1].sodium_mean == 138.0 and got[2].sodium_mean is None and got[2].potassium_mean == 5.0


def test_cohort_counts_approx(spark):
    from pyspark.sql import functions as F
    rows = spark.range(5000).select((F.col("id") % 1234).alias("subject_id"))
    exact = cohort.cohort_counts(rows).first()
    approx = cohort.cohort_counts(rows, approx=True).first()
    assert exact.n_patients == 1234 and abs(approx.n_patients - 1234) <= 50
    assert approx.n_diagnoses == exact.n_diagnoses == 5000


def test_prefix_dictionary_equals_prefix_tests_with_thousands_of_prefixes(spark):
    import itertools
    import random
    rng = random.Random(6)
    letters = "ABCDEFGHIJ"
    every = ["".join(t) for n in (2, 3, 4) for t in itertools.product(letters, repeat=n)]
    chosen = rng.sample(every, 5000)
    cmap = {f"c{i}": {9: chosen[i::8], 10: chosen[(i + 1) % 8::16]} for i in range(8)}
    codes = ["".join(rng.choice(letters[:8]) for _ in range(rng.randint(0, 6))) for _ in range(3000)] + [None]
    rows = [(rng.randint(0, 400), i, rng.choice([9, 10, None]), c) for i, c in enumerate(codes)]
    dx = spark.createDataFrame(rows, "subject_id int, hadm_id int, icd_version int, icd_code string")
    subjects = spark.range(350).select(F.col("id").cast("int").alias("subject_id"))
    got = {r.subject_id: tuple(r)[1:] for r in ft.comorbidity_flags_by_dictionary(dx, subjects, cmap).collect()}
    want = {s: tuple(int(any(v is not None and c is not None and s == p and any(c.startswith(x) for x in cmap[k].get(v, []))
                             for p, _, v, c in rows)) for k in cmap) for s in range(0, 350, 25)}
    assert len(got) == 350 and all(got[s] == w for s, w in want.items())
    small = {"x": {9: ["A", "AB"]}, "y": {}}
    assert (sorted(map(tuple, ft.comorbidity_flags_by_dictionary(dx, subjects, small).collect()))
            == sorted(map(tuple, ft.comorbidity_flags(dx, subjects, small).collect())))
