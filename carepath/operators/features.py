"""Patient and admission features."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepath.functions.expressions import any_prefix
from carepath.operators.cohort import semi_join

# Default comorbidity map, condition -> ICD version -> code
# prefixes, as in the analysed pipeline (ICD-9 numeric, ICD-10 letter codes).
COMORBIDITY_MAP: dict[str, dict[int, list[str]]] = {
    "hypertension": {9: ["401", "402", "403", "404", "405"], 10: ["I10", "I11", "I12", "I13", "I15"]},
    "diabetes": {9: ["250"], 10: ["E10", "E11", "E13"]},
    "kidney_disease": {9: ["585", "586"], 10: ["N18", "N19"]},
    "copd": {9: ["496"], 10: ["J44"]},
    "atrial_fibrillation": {9: ["4273"], 10: ["I48"]},
    "coronary_artery_disease": {9: ["414"], 10: ["I25"]},
    "obesity": {9: ["278"], 10: ["E66"]},
    "anemia": {9: ["280", "281", "282", "283", "284", "285"], 10: ["D50", "D51", "D52", "D53"]},
}
COMORBIDITIES = list(COMORBIDITY_MAP)

# Lab features named by the analysed pipeline.
LAB_FEATURES = ["sodium", "potassium", "bnp", "creatinine", "hgb", "troponin"]


def demographics(patients: DataFrame, subjects: DataFrame) -> DataFrame:
    """``subject_id, gender[, anchor_age]`` of the given patients, one row each
    (P1, J2, A6).  Duplicates are resolved by the smallest
    ``(gender, anchor_age)`` so the result does not depend on file order;
    the per-patient aggregate is combined map-side, so a patient with many
    rows costs no skew."""
    if "gender" not in patients.columns:
        return subjects.select("subject_id").limit(0).withColumn("gender", F.lit(None).cast("string"))
    keep = ["gender"] + (["anchor_age"] if "anchor_age" in patients.columns else [])
    rows = semi_join(patients.select("subject_id", *keep), subjects, "subject_id")
    return (rows.groupBy("subject_id")
                .agg(F.min(F.struct(*keep)).alias("_d"))
                .select("subject_id", *[F.col(f"_d.{c}").alias(c) for c in keep]))


def _condition(cmap: dict[str, dict[int, list[str]]], name: str):
    tests = [(F.col("icd_version") == F.lit(v)) & any_prefix(F.col("icd_code"), prefixes)
             for v, prefixes in cmap[name].items() if prefixes]
    return reduce(lambda a, b: a | b, tests) if tests else F.lit(False)


def _mapped_diagnoses(diagnoses: DataFrame, subjects: DataFrame, cmap) -> DataFrame:
    """Diagnoses of ``subjects`` that match any condition.

    The filter is kept as a raw OR of ``(version AND prefixes)`` terms on the
    scanned columns: Catalyst then pushes the prefix tests into the scan (or,
    behind a join, extracts a prefix-only predicate for the code side), so
    unmapped rows are dropped before any join or shuffle.  The cohort semi
    join follows on the reduced rows."""
    any_code = reduce(lambda a, b: a | b, [_condition(cmap, k) for k in cmap])
    dx = diagnoses.select("subject_id", "icd_version", "icd_code").filter(any_code)
    return semi_join(dx, subjects, "subject_id")


def comorbidity_flags(diagnoses: DataFrame, subjects: DataFrame,
                      cmap: dict[str, dict[int, list[str]]] | None = None) -> DataFrame:
    """One row per patient in ``subjects`` with a 0/1 column per condition (A4).

    One scan of the diagnoses, filtered to mapped codes of cohort patients,
    then one grouped aggregate with a conditional ``max`` per condition,
    combined map-side.  Patients without a mapped code get zeros through the
    left join from ``subjects``.
    """
    cmap = cmap or COMORBIDITY_MAP
    flags = _mapped_diagnoses(diagnoses, subjects, cmap).groupBy("subject_id").agg(
        *[F.max(F.when(_condition(cmap, k), F.lit(1)).otherwise(F.lit(0))).alias(k) for k in cmap])
    return (subjects.select("subject_id").distinct()
            .join(flags, "subject_id", "left")
            .select("subject_id", *[F.coalesce(F.col(k), F.lit(0)).cast("int").alias(k) for k in cmap]))


#: Largest dictionary (in entries) that is sent to every task; a larger one is joined by shuffle.
MAX_BROADCAST_PREFIXES = 200_000


def prefix_dictionary(spark, cmap: dict[str, dict[int, list[str]]]) -> tuple[DataFrame, list[int], int]:
    """The map as a table (icd_version, prefix, condition), its distinct prefix lengths and its size."""
    rows = sorted({(int(v), p, name) for name, versions in cmap.items() for v, prefixes in versions.items() for p in prefixes})
    table = spark.createDataFrame(rows, "icd_version int, prefix string, condition string")
    return table, sorted({len(p) for _, p, _ in rows}), len(rows)


def dictionary_matches(diagnoses: DataFrame, cmap: dict[str, dict[int, list[str]]]) -> DataFrame:
    """(subject_id, condition) of every diagnosis that begins with a prefix of the map.

    For maps of thousands of prefixes, where an OR of prefix tests outgrows
    generated code: a code is cut to each distinct prefix length, and each
    cut is one equality join with the dictionary."""
    spark = diagnoses.sparkSession
    table, lengths, n = prefix_dictionary(spark, cmap)
    dx = diagnoses.select("subject_id", F.col("icd_version").cast("int").alias("icd_version"), "icd_code")
    cuts = F.array(*[F.lit(x) for x in lengths]) if lengths else F.array().cast("array<int>")
    # A shorter code has the same cut at every greater length; only lengths it reaches can match.
    keys = (dx.withColumn("_n", F.explode(F.filter(cuts, lambda x: x <= F.length("icd_code"))))
            .select("subject_id", "icd_version", F.substring("icd_code", F.lit(1), F.col("_n")).alias("prefix")))
    table = F.broadcast(table) if n <= MAX_BROADCAST_PREFIXES else table
    return keys.join(table, ["icd_version", "prefix"]).select("subject_id", "condition")


def comorbidity_flags_by_dictionary(diagnoses: DataFrame, subjects: DataFrame,
                                    cmap: dict[str, dict[int, list[str]]] | None = None) -> DataFrame:
    """The rows of ``comorbidity_flags`` (A4, X1) through the prefix dictionary."""
    cmap = cmap or COMORBIDITY_MAP
    found = dictionary_matches(semi_join(diagnoses.select("subject_id", "icd_version", "icd_code"), subjects, "subject_id"), cmap)
    flags = found.groupBy("subject_id").agg(*[F.max((F.col("condition") == k).cast("int")).alias(k) for k in cmap])
    return (subjects.select("subject_id").distinct().join(flags, "subject_id", "left")
            .select("subject_id", *[F.coalesce(F.col(k), F.lit(0)).cast("int").alias(k) for k in cmap]))


def any_condition(cmap: dict[str, dict[int, list[str]]] | None = None):
    """True when a diagnosis row matches any condition of ``cmap``."""
    cmap = cmap or COMORBIDITY_MAP
    return reduce(lambda a, b: a | b, [_condition(cmap, k) for k in cmap])


def comorbidity_flags_as_of(diagnoses: DataFrame, admissions: DataFrame,
                            cmap: dict[str, dict[int, list[str]]] | None = None,
                            stats_from: DataFrame | None = None) -> DataFrame:
    """Per-admission flags from the diagnoses of the patient's stays admitted
    no later than this one (ledger D6, ``as_of='admission'``), so no future
    diagnosis leaks into a stay's features.

    Flags per stay come from one grouped aggregate; the running max over a
    patient's stays uses the skew-aware ``running_max_within``."""
    from carepath.operators.sequence import running_max_within
    cmap = cmap or COMORBIDITY_MAP
    stays = admissions.select("subject_id", "hadm_id", "admittime")
    dx = semi_join(diagnoses.select("hadm_id", "icd_version", "icd_code").filter(any_condition(cmap)),
                   stays, "hadm_id")
    per_stay = dx.groupBy("hadm_id").agg(
        *[F.max(F.when(_condition(cmap, k), F.lit(1)).otherwise(F.lit(0))).alias(k) for k in cmap])
    base = (stays.join(per_stay, "hadm_id", "left")
                 .select("subject_id", "hadm_id", "admittime",
                         *[F.coalesce(F.col(k), F.lit(0)).cast("int").alias(k) for k in cmap]))
    out = running_max_within(base, "subject_id", "admittime", list(cmap), stats_from=stats_from)
    return out.select("subject_id", "hadm_id", *[F.col(f"cum_{k}").alias(k) for k in cmap])


def comorbidity_matches(diagnoses: DataFrame, subjects: DataFrame,
                        cmap: dict[str, dict[int, list[str]]] | None = None) -> DataFrame:
    """Matching diagnosis rows per condition, and their total (A5)."""
    cmap = cmap or COMORBIDITY_MAP
    dx = _mapped_diagnoses(diagnoses, subjects, cmap)
    out = dx.agg(*[F.count_if(_condition(cmap, k)).cast("long").alias(f"{k}_matches") for k in cmap])
    return out.withColumn("total_matches",
                          reduce(lambda a, b: a + b, [F.col(f"{k}_matches") for k in cmap]))


def patient_features(demo: DataFrame, comorb: DataFrame) -> DataFrame:
    """Demographics full-outer-joined with comorbidity flags."""
    return demo.join(comorb, "subject_id", "full_outer")


def admission_features(flagged: DataFrame) -> DataFrame:
    """One row per ``hadm_id`` with the max of its readmission flag."""
    return flagged.groupBy("hadm_id").agg(F.bool_or("is_readmission").alias("is_readmission"))


def lab_means(labs: DataFrame, items: dict[str, str], key: str = "hadm_id",
              item_col: str = "item", value_col: str = "value") -> DataFrame:
    """Mean lab value per admission and item, one ``<name>_mean`` column per
    item (F10).  ``items`` maps source item -> feature name; the pivot values
    are given, so no extra job collects them.  Partial aggregation per
    ``(key, item)`` keeps a busy admission cheap."""
    wide = (labs.filter(F.col(item_col).isin(list(items)))
                .groupBy(key).pivot(item_col, list(items)).agg(F.avg(value_col)))
    return wide.select(key, *[F.col(f"`{src}`").alias(f"{dst}_mean") for src, dst in items.items()])
