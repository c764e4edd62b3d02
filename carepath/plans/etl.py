"""Entry A: cohort -> readmissions -> features -> preprocessing, as one lazy plan.

Only the preprocessing statistics (class counts, split cut points, scaler
moments, one-hot vocabularies) are actions; everything else stays lazy.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepath.session import checkpoint as _ckpt

from carepath.functions.names import clean_feature_names, existing, string_columns
from carepath.operators import assemble, clean, cohort, derive, encode, features, readmission, split
from carepath.sources.tables import require_inputs, write_colocated

# Numeric columns that are scaled when present.
NUMERICAL_COLUMNS = ["anchor_age", "total_los_days", "icu_los_days", "non_icu_los_days",
                     "sodium_mean", "potassium_mean", "bnp_mean", "creatinine_mean",
                     "hgb_mean", "troponin_mean"]
TARGET = "is_readmission"


def materialize(df: DataFrame, mode: str = "checkpoint") -> DataFrame:
    """Cut the lineage of a table that several actions reuse.

    ``checkpoint`` writes it to ``spark.checkpoint.dir`` (survives executor
    loss); ``persist`` keeps it in executor memory/disk; ``none`` stays lazy.
    """
    if mode == "checkpoint":
        return _ckpt(df)
    if mode == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    return df


def colocated(tables: dict[str, DataFrame], folder: str, key: str = "subject_id", buckets: int | None = None) -> dict[str, DataFrame]:
    """The tables that hold ``key``, written in buckets of it (S5): the cohort semi
    joins, stay gaps (W1), condition flags (A4) and the assembly by patient (J6) then
    run without an exchange.  Worth it where the tables are read more than once."""
    order = {"admissions": ["admittime", "hadm_id"]}
    return {name: write_colocated(df, f"{folder.rstrip('/')}/{name}", key, [c for c in order.get(name, []) if c in df.columns], buckets)
            if key in df.columns else df for name, df in tables.items()}


@dataclass
class EtlResult:
    cohort_rows: DataFrame
    cohort_ids: DataFrame
    admissions: DataFrame
    flagged: DataFrame
    demographics: DataFrame
    comorbidities: DataFrame
    patient_features: DataFrame
    admission_features: DataFrame
    final: DataFrame
    extra: dict = field(default_factory=dict)


def build_features(tables: dict[str, DataFrame], prefix="I50", version=10,
                   cmap=None, window_days: float = 30, lab_items: dict | None = None, lab_columns: tuple[str, str] = ("itemid", "valuenum"),
                   check_target: bool = False, as_of: str = "patient",
                   shared_scan: bool = True, id_tables: str = "checkpoint") -> EtlResult:
    """Stages A1 and A2 plus the assembly of A3.

    ``as_of='admission'`` builds comorbidities per stay from earlier-or-same
    stays only (ledger D6).  ``lab_items`` maps lab items to feature names and
    ``lab_columns`` names the item and value columns of ``labevents``.
    ``shared_scan`` (the default) reads the diagnoses once: rows matching the cohort or any condition are checkpointed (a small
    share of the table) and both stages read that copy, which trades one
    full scan of the largest table for one write of its matching rows.
    """
    require_inputs(tables, ["patients", "admissions", "diagnoses_icd"])
    cmap = cmap or features.COMORBIDITY_MAP
    dx = tables["diagnoses_icd"]
    if shared_scan:
        dx = materialize(dx.select("subject_id", "hadm_id", "icd_version", "icd_code")
                           .filter(cohort.cohort_condition(prefix, version) | features.any_condition(cmap)))
    rows = cohort.cohort_diagnoses(dx, prefix, version)
    # The two id lists feed several semi joins each; written once (one row per
    # cohort patient), they spare repeated scans of the diagnoses and
    # admissions tables, and no cached table stays behind.
    ids = materialize(cohort.cohort_patient_ids(rows), id_tables)
    adm = cohort.cohort_admissions(tables["admissions"], ids)
    flagged = readmission.flag_readmissions(adm, window_days, stats_from=tables["admissions"])
    subjects = materialize(cohort.cohort_patient_ids(adm), id_tables)
    demo = features.demographics(tables["patients"], subjects)
    afeat = features.admission_features(flagged)
    if as_of == "admission":
        comorb = features.comorbidity_flags_as_of(dx, adm, cmap, stats_from=tables["admissions"])
        pfeat = demo
        afeat = afeat.join(comorb.drop("subject_id"), "hadm_id", "left")
    else:
        comorb = features.comorbidity_flags(dx, subjects, cmap)
        pfeat = features.patient_features(demo, comorb)
    if lab_items and "labevents" in tables:
        labs = features.lab_means(tables["labevents"], lab_items, item_col=lab_columns[0], value_col=lab_columns[1])
        afeat = afeat.join(labs, "hadm_id", "left")
    final = assemble.final_dataset(flagged, pfeat, afeat, TARGET, check=check_target)
    return EtlResult(rows, ids, adm, flagged, demo, comorb, pfeat, afeat, final,
                     extra={"subjects": subjects})


@dataclass
class Preprocessed:
    data: DataFrame
    feature_columns: list[str]
    scaler: encode.ScalerModel
    encoder: encode.OneHotModel | None
    categorical_columns: list[str]


def preprocess(final: DataFrame, target: str = TARGET, test_size: float = 0.2, seed: int = 42,
               fit_on: str = "train", drop_dummies: tuple[str, ...] = ("insurance_Other",),
               materialize_mode: str = "checkpoint") -> Preprocessed:
    """Stage A3 (F5): clean, derive, split, scale, encode, prune.

    Keys ``subject_id``/``hadm_id`` and the targets ``is_readmission`` and
    ``total_los_days`` stay on every row; ``split`` says train or test.
    Scaler and encoder are fitted on the training rows (``fit_on='all'``
    reproduces fitting before the split).
    """
    clean.require_target(final, target)
    excluded = list(clean.EXCLUDED_COLUMNS)
    categorical = string_columns(final, exclude=NUMERICAL_COLUMNS + clean.ID_COLUMNS + [target] + excluded)

    df = clean.drop_missing_critical(final, target)
    df = derive.with_los(df).drop("admittime", "dischtime")
    df = derive.with_binary_flags(df)
    for c in ("language", "marital_status"):
        if c in categorical:
            categorical.remove(c)
        excluded.append(c)
    df = derive.with_race(df)
    if "race" in categorical:
        categorical.remove("race")
    excluded += ["race", "race_standardized"]
    df = df.withColumn(target, F.col(target).cast("int"))
    # Several small actions follow (class counts, cut points, moments,
    # vocabularies): read them from one materialised copy, not the lineage.
    df = materialize(df, materialize_mode)
    df = split.stratified_split(df, "hadm_id", target, test_size, seed)

    fit_df = df.filter(F.col("split") == "train") if fit_on == "train" else df
    numerical = existing(final, NUMERICAL_COLUMNS)
    df, scaler = encode.standard_scale(df, numerical, fit_df)
    # A stay without a lab gets the training mean, which is 0 once scaled, and says so.
    for c in [c for c in numerical if c.endswith("_mean") and c in df.columns]:
        df = df.withColumns({f"{c}_missing": F.col(c).isNull().cast("int"), c: F.coalesce(F.col(c), F.lit(0.0))})
    df, encoder = encode.one_hot(df, categorical, fit_df)

    df = clean.drop_columns(df, excluded)
    if "anchor_age" in df.columns:
        df = df.withColumnRenamed("anchor_age", "age")
    df = clean.drop_columns(df, list(drop_dummies))
    # Ledger D14: feature names are cleaned once here, so every model sees
    # the same names (one-hot values may carry spaces or slashes).
    df = clean_feature_names(df)
    non_features = set(clean.ID_COLUMNS + [target, "split", "total_los_days"])
    feats = [c for c in df.columns if c not in non_features]
    return Preprocessed(df, feats, scaler, encoder, categorical)
