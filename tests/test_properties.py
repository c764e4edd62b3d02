"""Properties from the survey's test plan, checked on the fixture tables."""

from pyspark.sql import functions as F

from tests.conftest import SF001


def test_pipeline_properties(spark):
    import __spark_entry__ as e
    q = e.queries()
    cohort = q["cohort_patients"](spark, SF001)
    adm = q["cohort_admissions"](spark, SF001)
    assert adm.join(cohort, "subject_id", "left_anti").count() == 0          # ids all in the cohort
    flags = q["comorbidity_flags"](spark, SF001)
    conds = [c for c in flags.columns if c != "subject_id"]
    bad = flags.filter(" OR ".join(f"{c} NOT IN (0, 1)" for c in conds)).count()
    assert bad == 0
    r = q["readmissions"](spark, SF001)
    flagged = r.filter("is_readmission")
    assert flagged.filter("days_until_readmission <= 0 OR days_until_readmission > 30").count() == 0
    assert r.filter("NOT is_readmission AND days_until_readmission IS NOT NULL").count() == 0
    los = q["los_icu_split"](spark, SF001)
    assert los.filter(F.abs(F.col("icu_los_days") + F.col("non_icu_los_days") - F.col("total_los_days")) > 1e-5).count() == 0
    s = q["split_disjoint"](spark, SF001).first()
    assert s.n_both == 0 and s.n_train + s.n_test == adm.count()
