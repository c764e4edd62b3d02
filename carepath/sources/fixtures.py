"""Encounter views over the supplied TPC-H-style test tables.

The driver's tables carry no hospital data, so tests and oracle queries
run on views that give them the encounter shape:

* ``patients``      <- customer  (one row per customer)
* ``admissions``    <- orders    (one stay per order, 1-14 days long)
* ``diagnoses_icd`` <- lineitem  (one code per line item)
* ``labevents``     <- lineitem  (one lab value per line item)

The mapping rules below are fixed values shared with the DuckDB oracle
(``carepath.plans.oracle``); change them in both places or neither.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture mapping (same text as the oracle SQL):
#   gender        F when key is even, else M
#   anchor_age    NULL when key % 29 = 0, else 18 + (key * 7) % 73
#   stay length   1 + orderkey % 14 days
#   marital       orderkey % 5: 0 MARRIED, 1 SINGLE, 2 WIDOWED, 3 DIVORCED, 4 NULL
#   insurance     status P Medicare, F Medicaid, else Other
#   language      orderkey % 7: 0 NULL, 1 Other, 2 English, else ENGLISH
#   race          custkey % 8: 0 WHITE, 1 BLACK/AFRICAN AMERICAN, 2 ASIAN - CHINESE,
#                 3 HISPANIC/LATINO - CUBAN, 4 PORTUGUESE, 5 UNKNOWN,
#                 6 WHITE - OTHER EUROPEAN, 7 NULL
#   icd_version   9 when l_linestatus = 'F', else 10
#   icd_code      first letter of p_type + p_size left-padded to two digits
MARITAL = ["MARRIED", "SINGLE", "WIDOWED", "DIVORCED"]
LANGUAGE = {1: "Other", 2: "English"}
RACE = ["WHITE", "BLACK/AFRICAN AMERICAN", "ASIAN - CHINESE", "HISPANIC/LATINO - CUBAN",
        "PORTUGUESE", "UNKNOWN", "WHITE - OTHER EUROPEAN"]

# Cohort used by tests and queries on the fixture views.
FIXTURE_COHORT_PREFIX = "E1"
FIXTURE_COHORT_VERSION = 10

# Comorbidity prefixes for the fixture views (codes there are a letter of
# E, L, M, P, S plus two digits).  Same shape as the clinical default map.
FIXTURE_COMORBIDITY_MAP: dict[str, dict[int, list[str]]] = {
    "hypertension": {9: ["L0", "L1"], 10: ["L2", "L3"]},
    "diabetes": {9: ["E0"], 10: ["E2", "E3"]},
    "kidney_disease": {9: ["M0"], 10: ["M1"]},
    "copd": {9: ["P0"], 10: ["P1"]},
    "atrial_fibrillation": {9: ["S0"], 10: ["S1"]},
    "coronary_artery_disease": {9: ["S2"], 10: ["S3"]},
    "obesity": {9: ["E4"], 10: ["E5"]},
    "anemia": {9: ["M2", "M3"], 10: ["M4", "P2"]},
}


_SCANS: dict[tuple, DataFrame] = {}


def _scan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy scan handle, reused per session and path (like a catalog entry):
    listing the file and reading its footer happen once, not per query."""
    key = (spark._jsparkSession.hashCode(), os.path.abspath(sf_dir), name)
    df = _SCANS.get(key)
    if df is None:
        df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
        _SCANS[key] = df
    return df


def _case_mod(key: Column, mod: int, values: dict[int, str]) -> Column:
    expr = None
    for k, v in values.items():
        expr = (F.when(key % mod == k, F.lit(v)) if expr is None
                else expr.when(key % mod == k, F.lit(v)))
    return expr


_VIEWS: dict[tuple, DataFrame] = {}


def _view(fn):
    """Memoise a view per session, path and arguments: the same lazy plan
    object is handed out again (no data is cached)."""
    def wrapper(spark: SparkSession, sf_dir: str, *args, **kw):
        key = (fn.__name__, spark._jsparkSession.hashCode(), os.path.abspath(sf_dir), args,
               tuple(sorted(kw.items())))
        df = _VIEWS.get(key)
        if df is None:
            df = fn(spark, sf_dir, *args, **kw)
            _VIEWS[key] = df
        return df
    wrapper.__name__, wrapper.__doc__ = fn.__name__, fn.__doc__
    return wrapper


@_view
def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return _scan(spark, sf_dir, "customer").select(
        k.alias("subject_id"),
        F.when(k % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
        F.when(k % 29 == 0, F.lit(None).cast("int"))
         .otherwise((F.lit(18) + (k * 7) % 73).cast("int")).alias("anchor_age"),
    )


@_view
def admissions(spark: SparkSession, sf_dir: str, with_charge: bool = False) -> DataFrame:
    """One stay per order.  ``with_charge`` keeps ``o_totalprice`` as
    ``total_charge`` (used to derive deterministic predictions)."""
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    stay_days = (F.lit(1) + ok % 14).cast("int")
    return _scan(spark, sf_dir, "orders").select(
        ck.alias("subject_id"),
        ok.alias("hadm_id"),
        F.col("o_orderdate").alias("admittime"),
        (F.col("o_orderdate") + F.make_dt_interval(days=stay_days)).alias("dischtime"),
        _case_mod(ok, 5, dict(enumerate(MARITAL))).alias("marital_status"),
        F.when(F.col("o_orderstatus") == "P", F.lit("Medicare"))
         .when(F.col("o_orderstatus") == "F", F.lit("Medicaid"))
         .otherwise(F.lit("Other")).alias("insurance"),
        F.when(ok % 7 == 0, F.lit(None).cast("string"))
         .when(ok % 7 == 1, F.lit(LANGUAGE[1]))
         .when(ok % 7 == 2, F.lit(LANGUAGE[2]))
         .otherwise(F.lit("ENGLISH")).alias("language"),
        _case_mod(ck, 8, dict(enumerate(RACE))).alias("race"),
        *([F.col("o_totalprice").alias("total_charge")] if with_charge else []),
    )


@_view
def diagnoses(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The code is built on the (small) part side and the version on the
    # line-item side, so predicates on them are plain column tests after the
    # joins instead of re-evaluated string expressions.
    li = _scan(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey",
        F.when(F.col("l_linestatus") == "F", F.lit(9)).otherwise(F.lit(10)).alias("icd_version"))
    o = _scan(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    p = _scan(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat(F.substring("p_type", 1, 1),
                 F.lpad(F.col("p_size").cast("string"), 2, "0")).alias("icd_code"))
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
           .join(p, li.l_partkey == p.p_partkey))
    return j.select(
        F.col("o_custkey").alias("subject_id"),
        F.col("o_orderkey").alias("hadm_id"),
        "icd_version", "icd_code",
    )


@_view
def labevents(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _scan(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    p = _scan(spark, sf_dir, "part").select("p_partkey", "p_type")
    return li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("l_orderkey").alias("hadm_id"),
        F.col("p_type").alias("item"),
        F.col("l_quantity").alias("value"),
    )


@_view
def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic score/label pairs for the evaluation operators:
    score = n_chars / 20000, label = labels.quality, keyed by doc_id."""
    d = _scan(spark, sf_dir, "documents").select("doc_id", "n_chars")
    lab = _scan(spark, sf_dir, "labels").select("doc_id", "quality")
    return lab.join(d, "doc_id").select(
        "doc_id",
        (F.col("n_chars") / F.lit(20000.0)).alias("score"),
        F.col("quality").cast("int").alias("label"),
    )


def scored_documents_by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deterministic stand-in classifiers of the same rows in long form
    (model, label, score): by length, by its opposite, and by id in 97 classes (many ties)."""
    from carepath.operators.evaluate import scores_by_model
    rows = scored_documents(spark, sf_dir).withColumns({"opposite": 1.0 - F.col("score"), "ties": (F.col("doc_id") % 97) / F.lit(97.0)})
    return scores_by_model(rows, {"length": "score", "opposite": "opposite", "ties": "ties"})


def stay_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actual stay length with deterministic stand-in predictions for the
    regression evaluators: predicted = charge / 25,000 days, and quantile
    columns at 1.0x, 1.3x and 1.7x of it."""
    from carepath.operators.derive import with_los
    adm = with_los(admissions(spark, sf_dir, with_charge=True))
    pred = F.col("total_charge") / F.lit(25000.0)
    return adm.select("hadm_id", F.col("total_los_days").alias("actual"), pred.alias("predicted"),
                      pred.alias("q50"), (pred * 1.3).alias("q75"), (pred * 1.7).alias("q90"))


def load_fixture_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "patients": patients(spark, sf_dir),
        "admissions": admissions(spark, sf_dir),
        "diagnoses_icd": diagnoses(spark, sf_dir),
        "labevents": labevents(spark, sf_dir),
    }
