"""Cohort selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepath.functions.expressions import any_prefix, hash_fraction

DEFAULT_PREFIX = "I50"
DEFAULT_VERSION = 10


def cohort_condition(prefix: str | list[str] = DEFAULT_PREFIX, version: int = DEFAULT_VERSION):
    prefixes = [prefix] if isinstance(prefix, str) else list(prefix)
    return any_prefix(F.col("icd_code"), prefixes) & (F.col("icd_version") == F.lit(version))


def cohort_diagnoses(diagnoses: DataFrame, prefix: str | list[str] = DEFAULT_PREFIX,
                     version: int = DEFAULT_VERSION) -> DataFrame:
    """Diagnosis rows whose code starts with ``prefix`` under ``version``.

    Row grain is kept.  Both predicates reach the Parquet scan as
    ``StringStartsWith`` / ``EqualTo`` pushed filters.
    """
    return diagnoses.filter(cohort_condition(prefix, version))


def cohort_patient_ids(cohort_rows: DataFrame) -> DataFrame:
    """Distinct patient ids of the cohort."""
    return cohort_rows.select("subject_id").distinct()


def cohort_counts(cohort_rows: DataFrame, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Number of matching diagnosis rows and distinct patients.

    Exact: a partial aggregate per ``subject_id`` then a global sum, so a
    patient with very many rows is folded map-side.  ``approx=True`` uses a
    HyperLogLog sketch (relative error ``rsd``) and needs no shuffle by
    patient at all.
    """
    if approx:
        return cohort_rows.agg(
            F.count(F.lit(1)).cast("long").alias("n_diagnoses"),
            F.approx_count_distinct("subject_id", rsd).cast("long").alias("n_patients"))
    per_patient = cohort_rows.groupBy("subject_id").agg(F.count(F.lit(1)).alias("_rows"))
    return per_patient.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("long").alias("n_diagnoses"),
        F.count(F.lit(1)).cast("long").alias("n_patients"),
    )


def semi_join(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows of ``df`` whose ``on`` is in ``keys``.

    No broadcast hint: AQE broadcasts the key side when its measured size is
    under ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and keeps a
    shuffle join (with skew splitting) otherwise.
    """
    return df.join(keys.select(on), on, "left_semi")


def cohort_admissions(admissions: DataFrame, cohort_ids: DataFrame) -> DataFrame:
    """All admissions of cohort patients, not only the coded ones."""
    return semi_join(admissions, cohort_ids, "subject_id")


def patient_subset(patients: DataFrame, share: float = 0.2, seed: int = 42) -> DataFrame:
    """Deterministic share of patients by hash (F9).  Semi-join other tables
    to the result so that no patient's stay sequence is cut."""
    return patients.filter(hash_fraction(F.col("subject_id"), seed) < F.lit(share))
