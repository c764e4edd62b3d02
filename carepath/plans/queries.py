"""Registered queries: one per operator of SURVEY §2, each ``(spark, sf_dir) -> DataFrame``.

All of them read the supplied tables through the encounter views of
``carepath.sources.fixtures`` and run over the whole tables.  Column
names and rounding match ``carepath.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carepath.operators import cohort as coh
from carepath.operators import readmission as rd
from carepath.sources import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# ---------------------------------------------------------------- shared stages

def cohort_rows(spark, sf_dir) -> DataFrame:
    return coh.cohort_diagnoses(fx.diagnoses(spark, sf_dir),
                                fx.FIXTURE_COHORT_PREFIX, fx.FIXTURE_COHORT_VERSION)


def cohort_ids(spark, sf_dir) -> DataFrame:
    return coh.cohort_patient_ids(cohort_rows(spark, sf_dir))


def cohort_adm(spark, sf_dir) -> DataFrame:
    return coh.cohort_admissions(fx.admissions(spark, sf_dir), cohort_ids(spark, sf_dir))


def readmissions_table(spark, sf_dir) -> DataFrame:
    return rd.flag_readmissions(cohort_adm(spark, sf_dir), stats_from=fx.admissions(spark, sf_dir))


# ---------------------------------------------------------------- §2.1 – §2.5

@query("scan_admissions")
def q_scan_admissions(spark, sf_dir):
    return fx.admissions(spark, sf_dir)


@query("cohort_rows")
def q_cohort_rows(spark, sf_dir):
    return cohort_rows(spark, sf_dir).select("subject_id", "hadm_id", "icd_version", "icd_code")


@query("cohort_counts")
def q_cohort_counts(spark, sf_dir):
    return coh.cohort_counts(cohort_rows(spark, sf_dir))


@query("cohort_patients")
def q_cohort_patients(spark, sf_dir):
    return cohort_ids(spark, sf_dir)


@query("cohort_admissions")
def q_cohort_admissions(spark, sf_dir):
    return cohort_adm(spark, sf_dir)


@query("readmissions")
def q_readmissions(spark, sf_dir):
    return readmissions_table(spark, sf_dir).withColumn(
        "days_until_readmission", r6("days_until_readmission"))


@query("readmissions_colocated")
def q_readmissions_colocated(spark, sf_dir):
    """S5 + W1: the rows of ``readmissions`` from tables bucketed by patient, no exchange under the window."""
    import uuid

    from carepath.session import ensure_checkpoint_dir
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/colocated-{uuid.uuid4().hex}"
    t = etl.colocated({"admissions": fx.admissions(spark, sf_dir), "diagnoses_icd": fx.diagnoses(spark, sf_dir)}, folder)
    rows = coh.cohort_diagnoses(t["diagnoses_icd"], fx.FIXTURE_COHORT_PREFIX, fx.FIXTURE_COHORT_VERSION)
    adm = coh.cohort_admissions(t["admissions"], coh.cohort_patient_ids(rows))
    out = rd.flag_readmissions(adm, stats_from=t["admissions"])
    return out.withColumn("days_until_readmission", r6("days_until_readmission"))


@query("readmission_rate")
def q_readmission_rate(spark, sf_dir):
    return rd.readmission_rate(readmissions_table(spark, sf_dir)).withColumn(
        "readmission_rate", r6("readmission_rate"))


@query("readmissions_dup_ids")
def q_readmissions_dup_ids(spark, sf_dir):
    # Admission ids made to repeat (four stays share one id) to exercise W3.
    dup = cohort_adm(spark, sf_dir).select(
        "subject_id", (F.col("hadm_id") / 4).cast("long").alias("hadm_id"),
        F.col("hadm_id").alias("source_id"), "admittime", "dischtime")
    out = rd.flag_readmissions(dup, propagate_ids=True,
                               order_cols=["admittime", "hadm_id", "source_id"],
                               stats_from=fx.admissions(spark, sf_dir))
    return out.select("subject_id", "hadm_id", "source_id", "admittime", "dischtime",
                      "is_readmission", r6("days_until_readmission").alias("days_until_readmission"))


@query("patient_subset")
def q_patient_subset(spark, sf_dir):
    return coh.patient_subset(fx.patients(spark, sf_dir), 0.2, 42)


# ---------------------------------------------------------------- features, assembly, cleaning

from carepath.operators import assemble as asm  # noqa: E402
from carepath.operators import clean as cl  # noqa: E402
from carepath.operators import derive as dv  # noqa: E402
from carepath.operators import encode as enc  # noqa: E402
from carepath.operators import features as ft  # noqa: E402
from carepath.operators import split as sp  # noqa: E402
from carepath.plans import etl  # noqa: E402

LAB_ITEMS = dict(zip(["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"], ft.LAB_FEATURES))


def etl_result(spark, sf_dir, labs: bool = False) -> etl.EtlResult:
    return etl.build_features(fx.load_fixture_tables(spark, sf_dir), fx.FIXTURE_COHORT_PREFIX,
                              fx.FIXTURE_COHORT_VERSION, fx.FIXTURE_COMORBIDITY_MAP,
                              lab_items=LAB_ITEMS if labs else None, lab_columns=("item", "value"))


@query("demographics")
def q_demographics(spark, sf_dir):
    return etl_result(spark, sf_dir).demographics


@query("comorbidity_flags")
def q_comorbidity_flags(spark, sf_dir):
    return etl_result(spark, sf_dir).comorbidities


@query("comorbidity_flags_dictionary")
def q_comorbidity_flags_dictionary(spark, sf_dir):
    """A4 + X1 through the prefix dictionary (same rows as ``comorbidity_flags``)."""
    return ft.comorbidity_flags_by_dictionary(fx.diagnoses(spark, sf_dir), coh.cohort_patient_ids(cohort_adm(spark, sf_dir)),
                                              fx.FIXTURE_COMORBIDITY_MAP)


@query("comorbidity_matches")
def q_comorbidity_matches(spark, sf_dir):
    return ft.comorbidity_matches(fx.diagnoses(spark, sf_dir), etl_result(spark, sf_dir).extra["subjects"],
                                  fx.FIXTURE_COMORBIDITY_MAP)


@query("patient_features")
def q_patient_features(spark, sf_dir):
    return etl_result(spark, sf_dir).patient_features


@query("admission_features")
def q_admission_features(spark, sf_dir):
    return ft.admission_features(readmissions_table(spark, sf_dir))


@query("target_mismatch")
def q_target_mismatch(spark, sf_dir):
    # Ids made to repeat: several stays share one, so their targets can differ from the id's.
    flagged = readmissions_table(spark, sf_dir).withColumn("hadm_id", F.expr("hadm_id div 32"))
    return asm.target_mismatch(flagged, ft.admission_features(flagged))


@query("final_dataset")
def q_final_dataset(spark, sf_dir):
    return etl_result(spark, sf_dir).final.withColumn(
        "days_until_readmission", r6("days_until_readmission"))


@query("final_dataset_labs")
def q_final_dataset_labs(spark, sf_dir):
    """F4 with lab means (F10), which takes the admission-feature join."""
    df = etl_result(spark, sf_dir, labs=True).final
    return df.withColumns({c: r6(c) for c in df.columns if c == "days_until_readmission" or c.endswith("_mean")})


@query("drop_missing_critical")
def q_drop_missing_critical(spark, sf_dir):
    return cl.drop_missing_critical(etl_result(spark, sf_dir).final).withColumn(
        "days_until_readmission", r6("days_until_readmission"))


@query("drop_report")
def q_drop_report(spark, sf_dir):
    return cl.drop_report(etl_result(spark, sf_dir).final)


@query("target_distribution")
def q_target_distribution(spark, sf_dir):
    return cl.target_distribution(etl_result(spark, sf_dir).final).withColumn("share", r6("share"))


@query("null_profile")
def q_null_profile(spark, sf_dir):
    return cl.null_profile(etl_result(spark, sf_dir).final).withColumn("null_share", r6("null_share"))


@query("los_days")
def q_los_days(spark, sf_dir):
    return dv.with_los(cohort_adm(spark, sf_dir)).select(
        "hadm_id", "admittime", "dischtime", r6("total_los_days").alias("total_los_days"))


@query("binary_flags")
def q_binary_flags(spark, sf_dir):
    return dv.with_binary_flags(fx.admissions(spark, sf_dir)).select(
        "hadm_id", "language", "marital_status", "english_lang", "is_married")


@query("race_standardized")
def q_race_standardized(spark, sf_dir):
    return dv.with_race(fx.admissions(spark, sf_dir), indicators=False).select(
        "hadm_id", "race", "race_standardized")


@query("race_indicators")
def q_race_indicators(spark, sf_dir):
    return dv.with_race(fx.admissions(spark, sf_dir)).select(
        "hadm_id", *[f"Is_{r}" for r in ["White", "Black", "Asian", "Latino"]])


@query("comorbidity_score")
def q_comorbidity_score(spark, sf_dir):
    return dv.with_comorbidity_score(q_comorbidity_flags(spark, sf_dir))


@query("standard_scale")
def q_standard_scale(spark, sf_dir):
    scaled, _ = enc.standard_scale(fx.patients(spark, sf_dir), ["anchor_age"])
    return scaled.select("subject_id", r6("anchor_age").alias("anchor_age"))


@query("one_hot")
def q_one_hot(spark, sf_dir):
    adm = fx.admissions(spark, sf_dir).select("hadm_id", "insurance", "marital_status")
    out, _ = enc.one_hot(adm, ["insurance", "marital_status"])
    return out


@query("one_hot_unseen")
def q_one_hot_unseen(spark, sf_dir):
    # Vocabulary from the readmitted stays only, applied to every cohort stay.
    flagged = readmissions_table(spark, sf_dir).select("hadm_id", "is_readmission", "race")
    out, _ = enc.one_hot(flagged.drop("is_readmission"), ["race"],
                         fit_df=flagged.filter("is_readmission"))
    return out


@query("stratified_split")
def q_stratified_split(spark, sf_dir):
    return sp.stratified_split(readmissions_table(spark, sf_dir), "hadm_id", "is_readmission",
                               0.2, 42).select("hadm_id", "is_readmission", "split")


def split_table(spark, sf_dir) -> DataFrame:
    return sp.stratified_split(readmissions_table(spark, sf_dir), "hadm_id", "is_readmission", 0.2, 42)


@query("split_balance")
def q_split_balance(spark, sf_dir):
    return sp.split_balance(split_table(spark, sf_dir)).withColumn(
        "positive_share", r6("positive_share"))


@query("split_disjoint")
def q_split_disjoint(spark, sf_dir):
    return sp.split_disjoint(split_table(spark, sf_dir))


@query("tuning_sample")
def q_tuning_sample(spark, sf_dir):
    adm = fx.admissions(spark, sf_dir)
    flagged = rd.flag_readmissions(adm, stats_from=adm)
    return sp.tuning_sample(flagged, "hadm_id", "is_readmission", 0.3, 42).select(
        "hadm_id", "subject_id", "is_readmission")


@query("sample_fixed")
def q_sample_fixed(spark, sf_dir):
    return sp.sample_fixed(fx.admissions(spark, sf_dir), "hadm_id", 50)


@query("lab_means")
def q_lab_means(spark, sf_dir):
    out = ft.lab_means(fx.labevents(spark, sf_dir), LAB_ITEMS)
    return out.select("hadm_id", *[r6(f"{n}_mean").alias(f"{n}_mean") for n in ft.LAB_FEATURES])


def preprocessed(spark, sf_dir) -> etl.Preprocessed:
    return etl.preprocess(etl_result(spark, sf_dir).final)


@query("preprocessed")
def q_preprocessed(spark, sf_dir):
    df = preprocessed(spark, sf_dir).data
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.withColumns({c: r6(c) for c in doubles})


@query("preprocessed_labs")
def q_preprocessed_labs(spark, sf_dir):
    """F5 with lab means: scaled by the training rows, missing labs marked."""
    df = etl.preprocess(etl_result(spark, sf_dir, labs=True).final).data
    labs = [c for c in df.columns if c.endswith("_mean") or c.endswith("_missing")]
    return df.select("hadm_id", "split", *[r6(c).alias(c) if c.endswith("_mean") else F.col(c) for c in labs])


# ---------------------------------------------------------------- evaluation, LOS, resources

from carepath.operators import evaluate as ev  # noqa: E402

QCOLS = {"q50": "q50", "q75": "q75", "q90": "q90"}


def rounded(df: DataFrame) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: r6(c) for c in doubles}) if doubles else df


@query("eval_classification")
def q_eval_classification(spark, sf_dir):
    return rounded(ev.classification_metrics(fx.scored_documents(spark, sf_dir)))


@query("confusion_matrix")
def q_confusion_matrix(spark, sf_dir):
    return ev.confusion_matrix(fx.scored_documents(spark, sf_dir))


@query("classification_report")
def q_classification_report(spark, sf_dir):
    return rounded(ev.classification_report(fx.scored_documents(spark, sf_dir)))


@query("roc_auc")
def q_roc_auc(spark, sf_dir):
    return rounded(ev.roc_auc(fx.scored_documents(spark, sf_dir)))


@query("average_precision")
def q_average_precision(spark, sf_dir):
    return rounded(ev.average_precision(fx.scored_documents(spark, sf_dir)))


@query("roc_points")
def q_roc_points(spark, sf_dir):
    return rounded(ev.roc_points(fx.scored_documents(spark, sf_dir)))


@query("pr_points")
def q_pr_points(spark, sf_dir):
    return rounded(ev.pr_points(fx.scored_documents(spark, sf_dir)))


@query("roc_points_by_model")
def q_roc_points_by_model(spark, sf_dir):
    """E5 of several classifiers from one scan of their scores."""
    return rounded(ev.roc_points_by_model(fx.scored_documents_by_model(spark, sf_dir)))


@query("pr_points_by_model")
def q_pr_points_by_model(spark, sf_dir):
    """E6 of several classifiers from one scan of their scores."""
    return rounded(ev.pr_points_by_model(fx.scored_documents_by_model(spark, sf_dir)))


@query("classification_by_model")
def q_classification_by_model(spark, sf_dir):
    """E1, E3, E4 of several classifiers from one scan of their scores."""
    return rounded(ev.classification_metrics_by_model(fx.scored_documents_by_model(spark, sf_dir)))


@query("eval_regression")
def q_eval_regression(spark, sf_dir):
    return rounded(ev.regression_metrics(fx.stay_predictions(spark, sf_dir)))


@query("quantile_coverage")
def q_quantile_coverage(spark, sf_dir):
    return rounded(ev.quantile_coverage(fx.stay_predictions(spark, sf_dir), "actual", QCOLS))


@query("residuals")
def q_residuals(spark, sf_dir):
    return rounded(ev.residuals(fx.stay_predictions(spark, sf_dir), keys=["hadm_id"]))


@query("residual_histogram")
def q_residual_histogram(spark, sf_dir):
    res = ev.residuals(fx.stay_predictions(spark, sf_dir), keys=["hadm_id"])
    return rounded(ev.histogram(res, "residual", 30))


@query("pred_range")
def q_pred_range(spark, sf_dir):
    return rounded(ev.prediction_range(fx.stay_predictions(spark, sf_dir)))


@query("resource_summary")
def q_resource_summary(spark, sf_dir):
    return rounded(ev.prediction_summary(fx.stay_predictions(spark, sf_dir), "predicted",
                                         "charge_rule", "total_los_days"))


@query("capacity_summary")
def q_capacity_summary(spark, sf_dir):
    return rounded(ev.capacity_summary(fx.stay_predictions(spark, sf_dir), QCOLS,
                                       "charge_rule", "total_los_days"))


@query("quantile_curve")
def q_quantile_curve(spark, sf_dir):
    # Rows sorted by the actual value, carrying every quantile prediction.
    return rounded(fx.stay_predictions(spark, sf_dir).select("hadm_id", "actual", *QCOLS)
                   .orderBy("actual", "hadm_id"))


def los_table(spark, sf_dir) -> DataFrame:
    r = etl_result(spark, sf_dir)
    return dv.length_of_stay(r.final, list(fx.FIXTURE_COMORBIDITY_MAP), flags=r.comorbidities)


@query("los_icu_split")
def q_los_icu_split(spark, sf_dir):
    return rounded(los_table(spark, sf_dir).select(
        "hadm_id", "total_los_days", "comorbidity_score", "icu_los_days", "non_icu_los_days"))


@query("los_stats")
def q_los_stats(spark, sf_dir):
    return rounded(los_table(spark, sf_dir).agg(F.avg("total_los_days").alias("mean_total_los_days"),
                                                F.avg("icu_los_days").alias("mean_icu_los_days")))


@query("los_by_split")
def q_los_by_split(spark, sf_dir):
    los = los_table(spark, sf_dir).select("hadm_id", "total_los_days", "icu_los_days", "non_icu_los_days")
    return rounded(sp.by_split(los, split_table(spark, sf_dir)))


@query("class_weights")
def q_class_weights(spark, sf_dir):
    from carepath.operators.models import class_weights
    return rounded(class_weights(split_table(spark, sf_dir).filter(F.col("split") == "train"),
                                 "is_readmission"))


# ---------------------------------------------------------------- models

from carepath.operators import models as md  # noqa: E402


def model_data(spark, sf_dir):
    """Preprocessed table with its feature list (readmission models)."""
    pre = preprocessed(spark, sf_dir)
    return pre.data, pre.feature_columns


def _scored_test(spark, sf_dir, trainer, label="is_readmission", **params):
    data, feats = model_data(spark, sf_dir)
    fitted = trainer(data.filter(F.col("split") == "train"), feats, label, **params)
    scored = fitted.score(data.filter(F.col("split") == "test"), "score")
    return scored.select("hadm_id", F.col(label).alias("label"), r6("score").alias("score"))


@query("model_logistic")
def q_model_logistic(spark, sf_dir):
    return _scored_test(spark, sf_dir, md.logistic_regression)


@query("model_random_forest")
def q_model_random_forest(spark, sf_dir):
    return _scored_test(spark, sf_dir, md.random_forest_classifier)


@query("model_gbt")
def q_model_gbt(spark, sf_dir):
    return _scored_test(spark, sf_dir, md.gbt_classifier)


@query("model_gbt_sampled")
def q_model_gbt_sampled(spark, sf_dir):
    return _scored_test(spark, sf_dir, md.gbt_classifier_sampled)


@query("model_rf_regressor")
def q_model_rf_regressor(spark, sf_dir):
    return _scored_test(spark, sf_dir, md.random_forest_regressor, label="total_los_days")


@query("model_gbt_regressor")
def q_model_gbt_regressor(spark, sf_dir):
    return _scored_test(spark, sf_dir, md.gbt_regressor, label="total_los_days")


def _boosted_test(spark, sf_dir, trainer, label="is_readmission"):
    data, feats = model_data(spark, sf_dir)
    model = trainer(data.filter(F.col("split") == "train"), feats, label)
    scored = model.score(data.filter(F.col("split") == "test"), "score")
    return scored.select("hadm_id", F.col(label).alias("label"), r6("score").alias("score"))


@query("model_leafwise")
def q_model_leafwise(spark, sf_dir):
    """M3: best-first boosting on binned histograms."""
    from carepath.operators import hist_boost as hb
    return _boosted_test(spark, sf_dir, hb.leafwise_classifier)


@query("model_leafwise_regressor")
def q_model_leafwise_regressor(spark, sf_dir):
    """M9: the same on squared loss."""
    from carepath.operators import hist_boost as hb
    return _boosted_test(spark, sf_dir, hb.leafwise_regressor, "total_los_days")


@query("model_newton_boost")
def q_model_newton_boost(spark, sf_dir):
    """M4: second-order trees with row and column sampling."""
    from carepath.operators import hist_boost as hb
    return _boosted_test(spark, sf_dir, hb.newton_classifier)


def _one_feature(spark, sf_dir, trainer, **params):
    data = fx.stay_predictions(spark, sf_dir).select("hadm_id", "actual", F.col("predicted").alias("x"))
    return trainer(data, ["x"], "actual", **params), data


@query("model_linear")
def q_model_linear(spark, sf_dir):
    fitted, _ = _one_feature(spark, sf_dir, md.linear_regression)
    return md.coefficients(fitted).withColumn("value", r6("value"))


@query("model_ridge")
def q_model_ridge(spark, sf_dir):
    fitted, _ = _one_feature(spark, sf_dir, md.ridge, alpha=1.0)
    return md.coefficients(fitted).withColumn("value", F.round("value", 4))


@query("model_elastic_net")
def q_model_elastic_net(spark, sf_dir):
    fitted, _ = _one_feature(spark, sf_dir, md.elastic_net, alpha=1.0, l1_ratio=0.5)
    return md.coefficients(fitted).withColumn("value", F.round("value", 4))


@query("top_importance")
def q_top_importance(spark, sf_dir):
    from carepath.operators import explain as xp
    data, feats = model_data(spark, sf_dir)
    fitted = md.random_forest_classifier(data.filter(F.col("split") == "train"), feats, "is_readmission")
    return xp.importance_table(fitted, top=20).withColumn("importance", r6("importance"))


@query("explain_linear")
def q_explain_linear(spark, sf_dir):
    from carepath.operators import explain as xp
    fitted, data = _one_feature(spark, sf_dir, md.linear_regression)
    return xp.linear_attribution(fitted, data, keys=["hadm_id"]).withColumn(
        "attribution", r6("attribution"))


@query("explain_summary")
def q_explain_summary(spark, sf_dir):
    from carepath.operators import explain as xp
    fitted, data = _one_feature(spark, sf_dir, md.linear_regression)
    att = xp.linear_attribution(fitted, data, keys=["hadm_id"])
    return xp.attribution_summary(att, top=20).withColumn("mean_abs_attribution", r6("mean_abs_attribution"))


@query("model_quantile")
def q_model_quantile(spark, sf_dir):
    """M10 + R5: quantile boosters (q50/q75/q90, 100 stages each) scored on
    the test split."""
    from carepath.operators import quantile_boost as qb
    data, feats = model_data(spark, sf_dir)
    models = qb.fit_quantile_set(data.filter(F.col("split") == "train"), feats, "total_los_days")
    pred = qb.predict_quantiles(models, data.filter(F.col("split") == "test"), "total_los_days")
    return rounded(pred.select("hadm_id", F.col("total_los_days").alias("actual"),
                               *[f"predicted_total_los_days_{q}" for q in models]))


@query("readmission_probability")
def q_readmission_probability(spark, sf_dir):
    """Out-of-fold readmission probability for training rows, and the
    full-train model's probability for test rows, keyed by hadm_id."""
    data, feats = model_data(spark, sf_dir)
    train, test = data.filter(F.col("split") == "train"), data.filter(F.col("split") == "test")
    oof = md.out_of_fold_scores(train, feats, "is_readmission")
    full = md.logistic_regression(train, feats, "is_readmission").score(test, "readmission_probability")
    cols = ["hadm_id", "split", "readmission_probability"]
    return rounded(oof.select(*cols).unionByName(full.select(*cols)))


# ---------------------------------------------------------------- tuning, selection, tree attribution

from carepath.operators import tune as tn  # noqa: E402


@query("tune_logistic")
def q_tune_logistic(spark, sf_dir):
    """H1: 14-map grid (whole grid, fewer than 20 draws), 5 hash folds, ROC AUC."""
    data, feats = model_data(spark, sf_dir)
    _, results = tn.random_search(data.filter(F.col("split") == "train"), feats, "is_readmission",
                                  "classifier", "logistic")
    return rounded(results)


@query("tune_ridge")
def q_tune_ridge(spark, sf_dir):
    """H2: ridge over seven penalties, 5 hash folds, mean squared error."""
    data, feats = model_data(spark, sf_dir)
    _, results = tn.random_search(data.filter(F.col("split") == "train"), feats, "total_los_days",
                                  "regressor", "ridge")
    return rounded(results)


@query("tune_elastic_net")
def q_tune_elastic_net(spark, sf_dir):
    """H2: 20 seeded draws of penalty and l1 ratio, 5 hash folds, from one scan for moments."""
    data, feats = model_data(spark, sf_dir)
    _, results = tn.random_search(data.filter(F.col("split") == "train"), feats, "total_los_days",
                                  "regressor", "elastic_net")
    return rounded(results)


def _one_feature_search(spark, sf_dir, model):
    data = fx.stay_predictions(spark, sf_dir).select("hadm_id", "actual", F.col("predicted").alias("x"))
    _, results = tn.linear_search(data, ["x"], "actual", model, n_iter=63)
    return results.select("draw", F.round("mean_mse", 4).alias("mean_mse"))


@query("tune_ridge_one_feature")
def q_tune_ridge_one_feature(spark, sf_dir):
    """H2 on one feature, where SQL has the closed form: seven penalties."""
    return _one_feature_search(spark, sf_dir, "ridge")


@query("tune_elastic_net_one_feature")
def q_tune_elastic_net_one_feature(spark, sf_dir):
    """H2 on one feature: the whole grid of 63 penalties and l1 ratios."""
    return _one_feature_search(spark, sf_dir, "elastic_net")


@query("cv_r2_linear")
def q_cv_r2_linear(spark, sf_dir):
    """H3 of the linear models on one feature, from one scan for moments."""
    data = fx.stay_predictions(spark, sf_dir).select("hadm_id", "actual", F.col("predicted").alias("x"))
    out = tn.cv_r2(data, ["x"], "actual", models={})
    return out.select("model", F.round("mean_r2", 5).alias("mean_r2"), F.round("std_r2", 5).alias("std_r2"))


@query("cv_r2")
def q_cv_r2(spark, sf_dir):
    """H3: five regressors, 5 hash folds, mean and std of R²."""
    data, feats = model_data(spark, sf_dir)
    return rounded(tn.cv_r2(data.filter(F.col("split") == "train"), feats, "total_los_days"))


@query("feature_selection")
def q_feature_selection(spark, sf_dir):
    """F8: L1-logistic importances, keep those at or above the median."""
    data, feats = model_data(spark, sf_dir)
    return rounded(tn.select_features(data.filter(F.col("split") == "train"), feats, "is_readmission"))


@query("explain_tree")
def q_explain_tree(spark, sf_dir):
    """Monte-Carlo Shapley values of the random forest for every test row."""
    from carepath.operators import explain as xp
    data, feats = model_data(spark, sf_dir)
    train, test = data.filter(F.col("split") == "train"), data.filter(F.col("split") == "test")
    fitted = md.random_forest_classifier(train, feats, "is_readmission")
    return rounded(xp.monte_carlo_shapley(fitted, test, "hadm_id", train))


@query("explain_tree_exact")
def q_explain_tree_exact(spark, sf_dir):
    """Exact interventional attributions of the random forest for every test row."""
    from carepath.operators import explain as xp
    data, feats = model_data(spark, sf_dir)
    train, test = data.filter(F.col("split") == "train"), data.filter(F.col("split") == "test")
    fitted = md.random_forest_classifier(train, feats, "is_readmission")
    return rounded(xp.exact_tree_attribution(fitted, test, "hadm_id", train))


@query("regression_leaderboard")
def q_regression_leaderboard(spark, sf_dir):
    """OLS, ridge and elastic net on one feature, scored on the
    whole stay table, ranked by R² (first model wins ties)."""
    rows = []
    for name, trainer, kw in (("LinearRegression", md.linear_regression, {}),
                              ("Ridge", md.ridge, {"alpha": 1.0}),
                              ("ElasticNet", md.elastic_net, {"alpha": 1.0, "l1_ratio": 0.5})):
        fitted, data = _one_feature(spark, sf_dir, trainer, **kw)
        m = ev.regression_metrics(fitted.score(data, "p"), "actual", "p")
        rows.append(m.select(F.lit(name).alias("model_name"),
                             *[F.round(c, 4).alias(c) for c in ("rmse", "mae", "r2", "mape")]))
    return ev.model_comparison(rows, "r2")


@query("readmission_leaderboard")
def q_readmission_leaderboard(spark, sf_dir):
    """Entry B: four classifiers trained on the train split, compared on the
    test split by ROC AUC."""
    from carepath.plans import readmission_plan as rp
    data, feats = model_data(spark, sf_dir)
    out = rp.run(data, feats, explain=False)
    return rounded(out.leaderboard)


@query("resource_leaderboard")
def q_resource_leaderboard(spark, sf_dir):
    """Entry C: five LOS regressors (with the out-of-fold readmission
    probability as a feature), compared on the test split by R²."""
    from carepath.plans import resource_plan as rs
    data, feats = model_data(spark, sf_dir)
    data, feats = rs.with_readmission_probability(data, feats)
    out = rs.run(data, feats, "total_los_days", quantiles=None, summarize=False)
    return rounded(out.leaderboard)


@query("comorbidity_flags_as_of")
def q_comorbidity_flags_as_of(spark, sf_dir):
    """Ledger D6: per-stay flags from the patient's stays admitted no later."""
    adm = fx.admissions(spark, sf_dir)
    return ft.comorbidity_flags_as_of(fx.diagnoses(spark, sf_dir), cohort_adm(spark, sf_dir),
                                      fx.FIXTURE_COMORBIDITY_MAP, stats_from=adm)


@query("final_dataset_shared_scan")
def q_final_dataset_shared_scan(spark, sf_dir):
    """F4 with one shared diagnoses scan (same rows as ``final_dataset``)."""
    r = etl.build_features(fx.load_fixture_tables(spark, sf_dir), fx.FIXTURE_COHORT_PREFIX,
                           fx.FIXTURE_COHORT_VERSION, fx.FIXTURE_COMORBIDITY_MAP, shared_scan=True)
    return r.final.withColumn("days_until_readmission", r6("days_until_readmission"))
