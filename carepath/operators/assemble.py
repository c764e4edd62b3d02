"""Assembly of the modelling table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def target_mismatch(flagged: DataFrame, adm_features: DataFrame,
                    target: str = "is_readmission") -> DataFrame:
    """Admission ids whose target differs between the two tables.

    Null-safe comparison over a full outer join on ``hadm_id``; an id present
    on one side only is a mismatch too.
    """
    a = flagged.select("hadm_id", F.col(target).alias("_a"))
    b = adm_features.select("hadm_id", F.col(target).alias("_b"))
    return (a.join(b, "hadm_id", "full_outer")
             .filter(~F.col("_a").eqNullSafe(F.col("_b")))
             .select("hadm_id", F.col("_a").alias("target_left"), F.col("_b").alias("target_right")))


def check_target_consistency(flagged: DataFrame, adm_features: DataFrame,
                             target: str = "is_readmission") -> None:
    """Raise when J8 finds any mismatch (one small action)."""
    bad = target_mismatch(flagged, adm_features, target).limit(1).count()
    if bad:
        raise ValueError(f"the {target!r} column differs between the two admission tables")


def final_dataset(flagged: DataFrame, patient_feats: DataFrame,
                  adm_features: DataFrame | None = None, target: str = "is_readmission",
                  check: bool = False) -> DataFrame:
    """Admissions with patient features and admission features (F4 = J8, J6, J7).

    The duplicate target of ``adm_features`` is dropped; when nothing but the
    key is left, the J7 join is skipped because it cannot add a column (the
    admission table is one row per id).  ``check=True`` runs J8 first.
    """
    if check and adm_features is not None and target in adm_features.columns:
        check_target_consistency(flagged, adm_features, target)
    out = flagged.join(patient_feats, "subject_id", "left")
    if adm_features is not None:
        extra = [c for c in adm_features.columns if c not in ("hadm_id", target)]
        if extra:
            out = out.join(adm_features.select("hadm_id", *extra), "hadm_id", "left")
    return out
