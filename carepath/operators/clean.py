"""Cleaning and data-quality reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carepath.functions.names import existing

# Columns whose NULL drops the row (the target is added).
CRITICAL_COLUMNS = [
    "anchor_age", "gender", "marital_status", "insurance", "language",
    "hypertension", "diabetes", "kidney_disease", "copd", "coronary_artery_disease", "obesity", "anemia",
]
# Admission columns never used as features.
EXCLUDED_COLUMNS = [
    "admittime", "dischtime", "deathtime", "days_until_readmission",
    "admission_type", "admission_location", "discharge_location",
    "edregtime", "edouttime", "hospital_expire_flag",
]
ID_COLUMNS = ["subject_id", "hadm_id"]
LEAKY_COLUMNS = ["days_until_readmission"]


def critical_present(df: DataFrame, target: str = "is_readmission",
                     critical: list[str] | None = None) -> list[str]:
    return existing(df, (critical or CRITICAL_COLUMNS) + [target])


def drop_missing_critical(df: DataFrame, target: str = "is_readmission",
                          critical: list[str] | None = None) -> DataFrame:
    """Drop rows with a NULL in any critical column or the target."""
    return df.dropna(subset=critical_present(df, target, critical))


def drop_report(df: DataFrame, target: str = "is_readmission",
                critical: list[str] | None = None) -> DataFrame:
    """Rows before, after and dropped by P6, in one pass (A10)."""
    cols = critical_present(df, target, critical)
    keep = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]) if cols else F.lit(True)
    return (df.agg(F.count(F.lit(1)).cast("long").alias("rows_before"),
                   F.count_if(keep).cast("long").alias("rows_after"))
              .withColumn("rows_dropped", F.col("rows_before") - F.col("rows_after")))


def target_distribution(df: DataFrame, target: str = "is_readmission") -> DataFrame:
    """Count and share per target value (A8).  The share uses a window over
    the handful of aggregated rows, never over raw rows."""
    counts = df.groupBy(target).agg(F.count(F.lit(1)).cast("long").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counts.withColumn("share", F.col("n") / total)


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per-column NULL count and share from one aggregate, then unpivoted."""
    cols = columns or df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    stacked = agg.select(
        "_rows",
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_n{i}").alias("n_null"))
                            for i, c in enumerate(cols)])).alias("_s"))
    return stacked.select(
        F.col("_s.column").alias("column"),
        F.col("_s.n_null").cast("long").alias("n_null"),
        F.try_divide(F.col("_s.n_null"), F.col("_rows")).alias("null_share"))


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop by name; absent names are ignored."""
    return df.drop(*existing(df, names))


def remove_leakage(df: DataFrame, leaky: list[str] | None = None) -> DataFrame:
    """Remove outcome-derived columns before training."""
    return drop_columns(df, leaky or LEAKY_COLUMNS)


def require_target(df: DataFrame, target: str) -> None:
    """P10: the target must be a column; it stays in the same DataFrame."""
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not found; columns: {df.columns}")
