"""Plan assertions: no Python UDF in SQL plans, no single-partition exchange
on row data, pruned scans; and the registered queries' contract."""

import pytest

from tests.conftest import SF001

ROW_LEVEL = ["readmissions", "final_dataset", "preprocessed", "comorbidity_flags", "stratified_split",
             "los_icu_split", "roc_points", "lab_means"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ROW_LEVEL)
def test_no_python_udf_no_single_partition(spark, name):
    import __spark_entry__ as e
    df = e.queries()[name](spark, SF001)
    df.count()
    plan = plan_of(df)
    for bad in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "SinglePartition"):
        assert bad not in plan, f"{name}: {bad} in plan"


def test_colocated_tables_need_no_exchange(spark, tmp_path):
    """The stay window, the semi join under it and the flags by patient run on buckets as they lie."""
    import __spark_entry__ as e
    from carepath.operators import features as ft
    from carepath.plans import etl
    from carepath.sources import fixtures as fx
    df = e.queries()["readmissions_colocated"](spark, SF001)
    assert sorted(map(str, df.collect())) == sorted(map(str, e.queries()["readmissions"](spark, SF001).collect()))
    plan = plan_of(df)
    assert "Window" in plan and "hashpartitioning" not in plan and "Bucketed: true" in plan
    t = etl.colocated({"admissions": fx.admissions(spark, SF001), "diagnoses_icd": fx.diagnoses(spark, SF001), "other": spark.range(3)},
                      str(tmp_path), buckets=4)
    assert t["other"].columns == ["id"] and not [x for x in spark.catalog.listTables() if x.name.startswith("colocated_")]
    flags = ft.comorbidity_flags(t["diagnoses_icd"], t["admissions"].select("subject_id").distinct(), fx.FIXTURE_COMORBIDITY_MAP)
    flags.count()
    assert "hashpartitioning" not in plan_of(flags)


def test_scan_prunes_columns(spark):
    import __spark_entry__ as e
    plan = plan_of(e.queries()["cohort_patients"](spark, SF001))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linestatus:string>" in plan


def test_contract(spark):
    import __spark_entry__ as e
    qs, oracle = e.queries(), e.oracle_sql()
    assert set(oracle) <= set(qs)
    df = e.entry(spark)
    assert df.columns[:2] == ["subject_id", "hadm_id"] and df.count() > 0
