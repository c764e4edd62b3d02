"""Derived columns: length of stay, binary flags, race, comorbidity score
and the ICU split (X2-X12, A13, R1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepath.functions.expressions import (MAJOR_RACES, clip_lower, days_between, eq_flag,
                                            race_standardized, row_sum)
from carepath.functions.names import existing
from carepath.operators.features import COMORBIDITIES

# Fixed values of the ICU estimate: fraction = BASE + SPAN * score / max(max score, 1).
ICU_BASE = 0.2
ICU_SPAN = 0.3


def with_los(df: DataFrame, admit: str = "admittime", disch: str = "dischtime",
             out: str = "total_los_days") -> DataFrame:
    """Length of stay in fractional days, negatives clipped to 0, NULL kept."""
    return df.withColumn(out, clip_lower(days_between(F.col(admit), F.col(disch)), 0.0))


def with_binary_flags(df: DataFrame) -> DataFrame:
    """``english_lang`` (case-insensitive) and ``is_married``; NULL -> 0."""
    if "language" in df.columns:
        df = df.withColumn("english_lang", eq_flag("language", "ENGLISH", case_insensitive=True))
    if "marital_status" in df.columns:
        df = df.withColumn("is_married", eq_flag("marital_status", "MARRIED"))
    return df


def with_race(df: DataFrame, indicators: bool = True) -> DataFrame:
    """``race_standardized`` and ``Is_<race>`` indicator columns."""
    if "race" not in df.columns:
        return df
    df = df.withColumn("race_standardized", race_standardized(F.col("race")))
    if indicators:
        for r in MAJOR_RACES:
            df = df.withColumn(f"Is_{r}", (F.col("race_standardized") == F.lit(r)).cast("int"))
    return df


def with_comorbidity_score(df: DataFrame, cols: list[str] | None = None,
                           out: str = "comorbidity_score") -> DataFrame:
    """Row-wise sum of the condition flags, NULLs skipped (X11)."""
    return df.withColumn(out, row_sum(existing(df, cols or COMORBIDITIES)))


def with_icu_split(df: DataFrame, los: str = "total_los_days",
                   score: str = "comorbidity_score", score_rows: DataFrame | None = None) -> DataFrame:
    """Estimated ICU and non-ICU days.

    The global maximum score is a one-row aggregate fetched as a scalar and
    folded in as a literal; nothing is cached.  ``score_rows`` may name a narrower table with the same
    scores to take the maximum from.
    """
    top = (score_rows if score_rows is not None else df).agg(F.max(score)).first()[0]
    frac = F.lit(ICU_BASE) + F.lit(ICU_SPAN) * F.col(score) / F.lit(float(max(top or 0, 1)))
    return (df.withColumn("icu_los_days", F.col(los) * frac)
              .withColumn("non_icu_los_days", F.col(los) - F.col("icu_los_days")))


def length_of_stay(df: DataFrame, cols: list[str] | None = None, flags: DataFrame | None = None) -> DataFrame:
    """Total LOS, comorbidity score, ICU and non-ICU days.

    ``flags`` may name the table that the condition columns of ``df`` were joined
    from (a row per patient, each with a stay in ``df``): the largest score then
    comes from it, without the joins behind ``df``."""
    out = with_los(df) if "total_los_days" not in df.columns else df
    out = with_comorbidity_score(out, cols)
    # Only the flag columns reach the maximum's scan.
    scores = out if flags is None else with_comorbidity_score(flags, cols)
    return with_icu_split(out, score_rows=scores.select("comorbidity_score"))
