"""DuckDB oracle SQL for every registered query (correctness gate).

The fixture views repeat the mapping of ``carepath.sources.fixtures`` in
SQL.  Doubles are rounded to 6 places on both sides.
"""

from __future__ import annotations

FX = """
fx_patients AS (
  SELECT c_custkey AS subject_id,
         CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE CAST(18 + (c_custkey * 7) % 73 AS INTEGER) END AS anchor_age
  FROM customer),
fx_admissions AS (
  SELECT o_custkey AS subject_id, o_orderkey AS hadm_id, o_orderdate AS admittime,
         o_orderdate + to_days(CAST(1 + o_orderkey % 14 AS INTEGER)) AS dischtime,
         CASE o_orderkey % 5 WHEN 0 THEN 'MARRIED' WHEN 1 THEN 'SINGLE' WHEN 2 THEN 'WIDOWED'
                             WHEN 3 THEN 'DIVORCED' END AS marital_status,
         CASE o_orderstatus WHEN 'P' THEN 'Medicare' WHEN 'F' THEN 'Medicaid' ELSE 'Other' END AS insurance,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 7 = 1 THEN 'Other'
              WHEN o_orderkey % 7 = 2 THEN 'English' ELSE 'ENGLISH' END AS language,
         CASE o_custkey % 8 WHEN 0 THEN 'WHITE' WHEN 1 THEN 'BLACK/AFRICAN AMERICAN'
              WHEN 2 THEN 'ASIAN - CHINESE' WHEN 3 THEN 'HISPANIC/LATINO - CUBAN'
              WHEN 4 THEN 'PORTUGUESE' WHEN 5 THEN 'UNKNOWN' WHEN 6 THEN 'WHITE - OTHER EUROPEAN' END AS race
  FROM orders),
fx_diagnoses AS (
  SELECT o_custkey AS subject_id, o_orderkey AS hadm_id,
         CASE WHEN l_linestatus = 'F' THEN 9 ELSE 10 END AS icd_version,
         concat(substr(p_type, 1, 1), lpad(CAST(p_size AS VARCHAR), 2, '0')) AS icd_code
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
fx_labs AS (
  SELECT l_orderkey AS hadm_id, p_type AS item, l_quantity AS value
  FROM lineitem JOIN part ON l_partkey = p_partkey),
coh_rows AS (
  SELECT * FROM fx_diagnoses WHERE starts_with(icd_code, 'E1') AND icd_version = 10),
coh_ids AS (SELECT DISTINCT subject_id FROM coh_rows),
coh_adm AS (SELECT * FROM fx_admissions WHERE subject_id IN (SELECT subject_id FROM coh_ids)),
readm_gap AS (
  SELECT *, (epoch_us(admittime) - epoch_us(lag(dischtime) OVER (PARTITION BY subject_id ORDER BY admittime, hadm_id)))
            / 86400000000.0 AS gap
  FROM coh_adm),
readm AS (
  SELECT subject_id, hadm_id, admittime, dischtime, marital_status, insurance, language, race,
         coalesce(gap > 0 AND gap <= 30, false) AS is_readmission,
         CASE WHEN gap > 0 AND gap <= 30 THEN gap END AS days_until_readmission
  FROM readm_gap)
"""


def with_fx(body: str) -> str:
    return "WITH " + FX.strip() + "\n" + body


def hash_frac(key: str, seed: int = 42) -> str:
    """Same value as ``carepath.functions.expressions.hash_fraction``."""
    return (f"(CAST(('0x' || substr(md5('{seed}|' || CAST({key} AS VARCHAR)), 1, 15))::BIGINT AS DOUBLE)"
            f" / 1152921504606846976.0)")


def hash_key(key: str, seed: int = 42) -> str:
    return f"('0x' || substr(md5('{seed}|' || CAST({key} AS VARCHAR)), 1, 15))::BIGINT"


ORACLE: dict[str, str] = {}


def sql(name: str, body: str, fx: bool = True) -> None:
    ORACLE[name] = with_fx(body) if fx else body


sql("scan_admissions", "SELECT * FROM fx_admissions")

sql("cohort_rows", "SELECT subject_id, hadm_id, icd_version, icd_code FROM coh_rows")

sql("cohort_counts", """
SELECT CAST(count(*) AS BIGINT) AS n_diagnoses, CAST(count(DISTINCT subject_id) AS BIGINT) AS n_patients
FROM coh_rows""")

sql("cohort_patients", "SELECT subject_id FROM coh_ids")

sql("cohort_admissions", "SELECT * FROM coh_adm")

sql("readmissions", """
SELECT subject_id, hadm_id, admittime, dischtime, marital_status, insurance, language, race,
       is_readmission, round(days_until_readmission, 6) AS days_until_readmission
FROM readm""")

sql("readmission_rate", """
SELECT CAST(coalesce(sum(CAST(is_readmission AS INTEGER)), 0) AS BIGINT) AS n_readmissions,
       CAST(count(*) AS BIGINT) AS n_admissions,
       round(avg(CAST(is_readmission AS INTEGER)), 6) AS readmission_rate
FROM readm""")

sql("readmissions_dup_ids", """
, dup AS (SELECT subject_id, hadm_id // 4 AS hadm_id, hadm_id AS source_id, admittime, dischtime FROM coh_adm),
g AS (SELECT *, (epoch_us(admittime) - epoch_us(lag(dischtime) OVER
        (PARTITION BY subject_id ORDER BY admittime, hadm_id, source_id))) / 86400000000.0 AS gap FROM dup),
q AS (SELECT hadm_id, max_by(gap, {'s': subject_id, 'a': admittime, 'h': hadm_id, 'o': source_id}) AS d
      FROM g WHERE gap > 0 AND gap <= 30 GROUP BY hadm_id)
SELECT g.subject_id, g.hadm_id, g.source_id, g.admittime, g.dischtime,
       q.d IS NOT NULL AS is_readmission, round(q.d, 6) AS days_until_readmission
FROM g LEFT JOIN q ON g.hadm_id = q.hadm_id""")

sql("patient_subset", f"""
SELECT * FROM fx_patients WHERE {hash_frac('subject_id')} < 0.2""")


# ---------------------------------------------------------------- features, assembly, cleaning

from carepath.sources.fixtures import FIXTURE_COMORBIDITY_MAP as _CMAP  # noqa: E402

_CONDS = list(_CMAP)
_CRITICAL = ["anchor_age", "gender", "marital_status", "insurance", "language", "hypertension", "diabetes",
             "kidney_disease", "copd", "coronary_artery_disease", "obesity", "anemia", "is_readmission"]
_FINAL_COLS = ["subject_id", "hadm_id", "admittime", "dischtime", "marital_status", "insurance", "language",
               "race", "is_readmission", "days_until_readmission", "gender", "anchor_age"] + _CONDS
_LAB = {"ECONOMY": "sodium", "LARGE": "potassium", "MEDIUM": "bnp", "PROMO": "creatinine",
        "SMALL": "hgb", "STANDARD": "troponin"}


def _cond(name: str) -> str:
    parts = []
    for v, prefixes in _CMAP[name].items():
        tests = " OR ".join(f"starts_with(icd_code, '{p}')" for p in prefixes)
        parts.append(f"(icd_version = {v} AND ({tests}))")
    return "(" + " OR ".join(parts) + ")"


_ANY = "(" + " OR ".join(_cond(k) for k in _CONDS) + ")"
_LOS = "((epoch_us(dischtime) - epoch_us(admittime)) / 86400000000.0)"
_TOK = "split_part(split_part(coalesce(race, 'Unknown'), ' ', 1), '/', 1)"
_TITLE = f"(upper(substr({_TOK}, 1, 1)) || lower(substr({_TOK}, 2)))"
_RACE_STD = (f"CASE {_TITLE} WHEN 'PORTUGUESE' THEN 'Latino' WHEN 'Hispanic' THEN 'Latino' "
             f"WHEN 'Unknown' THEN 'Other' ELSE {_TITLE} END")

FEAT = f"""
, subj AS (SELECT DISTINCT subject_id FROM readm),
demo AS (SELECT subject_id, gender, anchor_age FROM fx_patients WHERE subject_id IN (SELECT subject_id FROM subj)),
cf AS (SELECT s.subject_id,
  {", ".join(f"CAST(coalesce(max(CASE WHEN {_cond(k)} THEN 1 ELSE 0 END), 0) AS INTEGER) AS {k}" for k in _CONDS)}
  FROM subj s LEFT JOIN fx_diagnoses d ON d.subject_id = s.subject_id GROUP BY s.subject_id),
pf AS (SELECT coalesce(demo.subject_id, cf.subject_id) AS subject_id, gender, anchor_age,
  {", ".join(_CONDS)} FROM demo FULL OUTER JOIN cf ON demo.subject_id = cf.subject_id),
fin AS (SELECT r.*, pf.gender, pf.anchor_age, {", ".join("pf." + k for k in _CONDS)}
  FROM readm r LEFT JOIN pf ON r.subject_id = pf.subject_id),
cln AS (SELECT * FROM fin WHERE {" AND ".join(c + " IS NOT NULL" for c in _CRITICAL)})
"""


def feat(body: str) -> str:
    return FEAT + body


sql("demographics", feat("SELECT * FROM demo"))
sql("comorbidity_flags", feat("SELECT * FROM cf"))
sql("comorbidity_matches", feat(f"""
, m AS (SELECT {", ".join(f"CAST(count_if({_cond(k)}) AS BIGINT) AS {k}_matches" for k in _CONDS)}
  FROM fx_diagnoses WHERE subject_id IN (SELECT subject_id FROM subj) AND {_ANY})
SELECT *, {" + ".join(f"{k}_matches" for k in _CONDS)} AS total_matches FROM m"""))
sql("patient_features", feat("SELECT * FROM pf"))
sql("admission_features", "SELECT hadm_id, bool_or(is_readmission) AS is_readmission FROM readm GROUP BY hadm_id")
sql("target_mismatch", """
, rs AS (SELECT hadm_id // 32 AS hadm_id, is_readmission FROM readm),
af AS (SELECT hadm_id, bool_or(is_readmission) AS is_readmission FROM rs GROUP BY hadm_id)
SELECT coalesce(a.hadm_id, b.hadm_id) AS hadm_id, a.is_readmission AS target_left, b.is_readmission AS target_right
FROM rs a FULL OUTER JOIN af b ON a.hadm_id = b.hadm_id
WHERE a.is_readmission IS DISTINCT FROM b.is_readmission""")
sql("final_dataset", feat("SELECT * REPLACE (round(days_until_readmission, 6) AS days_until_readmission) FROM fin"))
_LAB_MEANS = ("lab AS (SELECT hadm_id AS lab_id, " + ", ".join(
    f"avg(value) FILTER (WHERE item = '{k}') AS {v}_mean" for k, v in _LAB.items())
    + " FROM fx_labs WHERE item IN (" + ", ".join(f"'{k}'" for k in _LAB) + ") GROUP BY hadm_id)")
sql("final_dataset_labs", feat(", " + _LAB_MEANS + """
SELECT fin.* REPLACE (round(days_until_readmission, 6) AS days_until_readmission), """
    + ", ".join(f"round({v}_mean, 6) AS {v}_mean" for v in _LAB.values())
    + " FROM fin LEFT JOIN lab ON lab.lab_id = fin.hadm_id"))
sql("drop_missing_critical", feat("SELECT * REPLACE (round(days_until_readmission, 6) AS days_until_readmission) FROM cln"))
sql("drop_report", feat("""
SELECT CAST((SELECT count(*) FROM fin) AS BIGINT) AS rows_before, CAST((SELECT count(*) FROM cln) AS BIGINT) AS rows_after,
       CAST((SELECT count(*) FROM fin) - (SELECT count(*) FROM cln) AS BIGINT) AS rows_dropped"""))
sql("target_distribution", feat("""
SELECT is_readmission, CAST(count(*) AS BIGINT) AS n, round(count(*) / (SELECT count(*) FROM fin), 6) AS share
FROM fin GROUP BY is_readmission"""))
sql("null_profile", feat("\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column, CAST(count_if({c} IS NULL) AS BIGINT) AS n_null, "
    f"round(count_if({c} IS NULL) / count(*), 6) AS null_share FROM fin" for c in _FINAL_COLS)))
sql("los_days", f"""
SELECT hadm_id, admittime, dischtime, round(CASE WHEN {_LOS} < 0 THEN 0.0 ELSE {_LOS} END, 6) AS total_los_days
FROM coh_adm""")
sql("binary_flags", """
SELECT hadm_id, language, marital_status,
       CAST(coalesce(upper(language) = 'ENGLISH', false) AS INTEGER) AS english_lang,
       CAST(coalesce(marital_status = 'MARRIED', false) AS INTEGER) AS is_married
FROM fx_admissions""")
sql("race_standardized", f"SELECT hadm_id, race, {_RACE_STD} AS race_standardized FROM fx_admissions")
sql("race_indicators", f"""
SELECT hadm_id, {", ".join(f"CAST(rs = '{r}' AS INTEGER) AS Is_{r}" for r in ["White", "Black", "Asian", "Latino"])}
FROM (SELECT hadm_id, {_RACE_STD} AS rs FROM fx_admissions)""")
sql("comorbidity_score", feat(f"SELECT *, {' + '.join(_CONDS)} AS comorbidity_score FROM cf"))
sql("standard_scale", """
SELECT subject_id, round((anchor_age - m) / CASE WHEN sd = 0 OR sd IS NULL THEN 1 ELSE sd END, 6) AS anchor_age
FROM fx_patients, (SELECT avg(anchor_age) AS m, stddev_pop(anchor_age) AS sd FROM fx_patients)""")
sql("one_hot", """
SELECT hadm_id,
  CAST(coalesce(insurance = 'Medicare', false) AS DOUBLE) AS insurance_Medicare,
  CAST(coalesce(insurance = 'Other', false) AS DOUBLE) AS insurance_Other,
  CAST(coalesce(marital_status = 'MARRIED', false) AS DOUBLE) AS marital_status_MARRIED,
  CAST(coalesce(marital_status = 'SINGLE', false) AS DOUBLE) AS marital_status_SINGLE,
  CAST(coalesce(marital_status = 'WIDOWED', false) AS DOUBLE) AS marital_status_WIDOWED,
  CAST(marital_status IS NULL AS DOUBLE) AS marital_status_nan
FROM fx_admissions""")
_RACES_SORTED = ["BLACK/AFRICAN AMERICAN", "HISPANIC/LATINO - CUBAN", "PORTUGUESE", "UNKNOWN", "WHITE",
                 "WHITE - OTHER EUROPEAN"]
sql("one_hot_unseen", "SELECT hadm_id, " + ", ".join(
    f"CAST(coalesce(race = '{r}', false) AS DOUBLE) AS \"race_{r}\"" for r in _RACES_SORTED)
    + ", CAST(race IS NULL AS DOUBLE) AS race_nan FROM readm")

_SPLIT = f"""
, sr AS (SELECT *, row_number() OVER (PARTITION BY is_readmission ORDER BY {hash_key('hadm_id')}, hadm_id) AS rn,
                count(*) OVER (PARTITION BY is_readmission) AS ncls FROM readm),
spl AS (SELECT *, CASE WHEN rn <= floor(0.2 * ncls + 0.5) THEN 'test' ELSE 'train' END AS split FROM sr)
"""
sql("stratified_split", _SPLIT + "SELECT hadm_id, is_readmission, split FROM spl")
sql("split_balance", _SPLIT + """
SELECT split, CAST(count(*) AS BIGINT) AS n, CAST(sum(CAST(is_readmission AS INTEGER)) AS BIGINT) AS positives,
       round(avg(CAST(is_readmission AS INTEGER)), 6) AS positive_share FROM spl GROUP BY split""")
sql("split_disjoint", _SPLIT + """
SELECT CAST(count_if(split = 'train') AS BIGINT) AS n_train, CAST(count_if(split = 'test') AS BIGINT) AS n_test,
       CAST((SELECT count(DISTINCT hadm_id) FROM spl AS t WHERE split = 'train'
             AND EXISTS (SELECT 1 FROM spl AS e WHERE e.hadm_id = t.hadm_id AND e.split = 'test')) AS BIGINT) AS n_both,
       CAST(count_if(split = 'train') AS BIGINT) AS n_train_only FROM spl""")
sql("tuning_sample", f"""
, ag AS (SELECT *, (epoch_us(admittime) - epoch_us(lag(dischtime) OVER (PARTITION BY subject_id ORDER BY admittime, hadm_id)))
            / 86400000000.0 AS gap FROM fx_admissions),
af AS (SELECT hadm_id, subject_id, coalesce(gap > 0 AND gap <= 30, false) AS is_readmission FROM ag),
rk AS (SELECT *, row_number() OVER (PARTITION BY is_readmission ORDER BY {hash_key('hadm_id')}, hadm_id) AS rn,
              count(*) OVER (PARTITION BY is_readmission) AS ncls FROM af)
SELECT hadm_id, subject_id, is_readmission FROM rk
WHERE rn <= floor(0.3 * ncls + 0.5)""")
sql("sample_fixed", "SELECT * FROM fx_admissions ORDER BY md5(CAST(hadm_id AS VARCHAR)), hadm_id LIMIT 50")
sql("lab_means", "SELECT hadm_id, " + ", ".join(
    f"round(avg(value) FILTER (WHERE item = '{k}'), 6) AS {v}_mean" for k, v in _LAB.items())
    + " FROM fx_labs WHERE item IN (" + ", ".join(f"'{k}'" for k in _LAB) + ") GROUP BY hadm_id")

_RACE_IND = ", ".join(f"CAST(({_RACE_STD}) = '{r}' AS INTEGER) AS Is_{r}" for r in ["White", "Black", "Asian", "Latino"])
PRE = f"""
, d AS (SELECT hadm_id, subject_id, CAST(is_readmission AS INTEGER) AS is_readmission,
   CASE WHEN {_LOS} < 0 THEN 0.0 ELSE {_LOS} END AS total_los_days,
   CAST(coalesce(upper(language) = 'ENGLISH', false) AS INTEGER) AS english_lang,
   CAST(coalesce(marital_status = 'MARRIED', false) AS INTEGER) AS is_married,
   {_RACE_IND}, anchor_age, gender, insurance, {", ".join(_CONDS)} FROM cln),
ds AS (SELECT *, row_number() OVER (PARTITION BY is_readmission ORDER BY {hash_key('hadm_id')}, hadm_id) AS rn,
              count(*) OVER (PARTITION BY is_readmission) AS ncls FROM d),
dsp AS (SELECT * EXCLUDE (rn, ncls), CASE WHEN rn <= floor(0.2 * ncls + 0.5) THEN 'test' ELSE 'train' END AS split FROM ds),
st AS (SELECT avg(anchor_age) AS m, stddev_pop(anchor_age) AS sd FROM dsp WHERE split = 'train'),
pre AS (SELECT hadm_id, subject_id, split, is_readmission, total_los_days,
   (anchor_age - m) / CASE WHEN sd = 0 OR sd IS NULL THEN 1 ELSE sd END AS age,
   {", ".join(_CONDS)}, english_lang, is_married, Is_White, Is_Black, Is_Asian, Is_Latino,
   CAST(coalesce(insurance = 'Medicare', false) AS DOUBLE) AS insurance_Medicare,
   CAST(coalesce(gender = 'M', false) AS DOUBLE) AS gender_M
   FROM dsp, st)
"""


def pre(body: str) -> str:
    return FEAT + PRE + body


sql("preprocessed_labs", pre(", " + _LAB_MEANS + ", pl AS (SELECT * FROM pre LEFT JOIN lab ON lab.lab_id = pre.hadm_id)"
    ", lst AS (SELECT " + ", ".join(f"avg({v}_mean) AS {v}_m, stddev_pop({v}_mean) AS {v}_s" for v in _LAB.values())
    + " FROM pl WHERE split = 'train') SELECT hadm_id, split, " + ", ".join(
        f"round(coalesce(({v}_mean - coalesce({v}_m, 0)) / CASE WHEN {v}_s = 0 OR {v}_s IS NULL THEN 1 ELSE {v}_s END, 0.0), 6) AS {v}_mean, "
        f"CAST({v}_mean IS NULL AS INTEGER) AS {v}_mean_missing" for v in _LAB.values()) + " FROM pl, lst"))
sql("preprocessed", pre("SELECT * REPLACE (round(total_los_days, 6) AS total_los_days, round(age, 6) AS age) FROM pre"))


# ---------------------------------------------------------------- evaluation, LOS, resources

SD = """
, sd AS (SELECT l.doc_id, d.n_chars / 20000.0 AS score, CAST(l.quality AS INTEGER) AS label
         FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
cc AS (SELECT CAST(count(*) AS BIGINT) AS n,
              CAST(count_if(label = 1 AND score >= 0.5) AS BIGINT) AS tp,
              CAST(count_if(label = 0 AND score >= 0.5) AS BIGINT) AS fp,
              CAST(count_if(label = 1 AND score < 0.5) AS BIGINT) AS fn,
              CAST(count_if(label = 0 AND score < 0.5) AS BIGINT) AS tn FROM sd),
g AS (SELECT score, CAST(count_if(label = 1) AS BIGINT) AS pos, CAST(count_if(label = 0) AS BIGINT) AS neg
      FROM sd GROUP BY score),
gc AS (SELECT *, sum(pos) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos,
                 sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg,
                 sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM g),
gt AS (SELECT *, P - cum_pos + pos AS tp, N - cum_neg + neg AS fp FROM gc)
"""


def _dz(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) = 0 THEN 0.0 ELSE ({a}) / ({b}) END"


sql("eval_classification", SD + f"""
SELECT n, tp, fp, fn, tn, round({_dz('tp + tn', 'n')}, 6) AS accuracy, round({_dz('tp', 'tp + fp')}, 6) AS precision,
       round({_dz('tp', 'tp + fn')}, 6) AS recall, round({_dz('2 * tp', '2 * tp + fp + fn')}, 6) AS f1_score FROM cc""")
sql("confusion_matrix", SD + """
SELECT 0 AS label, 0 AS predicted, tn AS n FROM cc UNION ALL SELECT 0, 1, fp FROM cc
UNION ALL SELECT 1, 0, fn FROM cc UNION ALL SELECT 1, 1, tp FROM cc""")
sql("classification_report", SD + f"""
, pc AS (SELECT '0' AS class, {_dz('tn', 'tn + fn')} AS p, {_dz('tn', 'tn + fp')} AS r, tn + fp AS s, n FROM cc
         UNION ALL SELECT '1', {_dz('tp', 'tp + fp')}, {_dz('tp', 'tp + fn')}, tp + fn, n FROM cc),
pf AS (SELECT *, {_dz('2 * p * r', 'p + r')} AS f FROM pc)
SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1_score, CAST(s AS BIGINT) AS support FROM pf
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(max(n) AS BIGINT) FROM pf
UNION ALL SELECT 'weighted avg', round({_dz('sum(p * s)', 'max(n)')}, 6), round({_dz('sum(r * s)', 'max(n)')}, 6),
                 round({_dz('sum(f * s)', 'max(n)')}, 6), CAST(max(n) AS BIGINT) FROM pf""")
sql("roc_auc", SD + """
SELECT round(CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * (cum_neg - neg * 0.5)) / (sum(pos) * sum(neg)) END, 6)
       AS roc_auc, CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM gc""")
sql("average_precision", SD + "SELECT round(sum(pos / P * tp / (tp + fp)), 6) AS average_precision FROM gt")
sql("roc_points", SD + "SELECT round(score, 6) AS threshold, round(fp / N, 6) AS fpr, round(tp / P, 6) AS tpr FROM gt")
sql("pr_points", SD + """
SELECT round(score, 6) AS threshold, round(tp / (tp + fp), 6) AS precision, round(tp / P, 6) AS recall,
       round(P / (P + N), 6) AS baseline FROM gt""")

SDM = SD + """
, lg AS (SELECT 'length' AS model, label, score FROM sd UNION ALL SELECT 'opposite', label, 1.0 - score FROM sd
         UNION ALL SELECT 'ties', label, doc_id % 97 / 97.0 FROM sd),
mg AS (SELECT model, score, count_if(label = 1) AS pos, count_if(label = 0) AS neg FROM lg GROUP BY model, score),
mc AS (SELECT *, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg, sum(pos) OVER (PARTITION BY model) AS P, sum(neg) OVER (PARTITION BY model) AS N
       FROM mg WINDOW w AS (PARTITION BY model ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
mt AS (SELECT *, P - cum_pos + pos AS tp, N - cum_neg + neg AS fp FROM mc)
"""
sql("roc_points_by_model", SDM + "SELECT model, round(score, 6) AS threshold, round(fp / N, 6) AS fpr, round(tp / P, 6) AS tpr FROM mt")
sql("pr_points_by_model", SDM + """
SELECT model, round(score, 6) AS threshold, round(tp / (tp + fp), 6) AS precision, round(tp / P, 6) AS recall,
       round(P / (P + N), 6) AS baseline FROM mt""")
sql("classification_by_model", SDM + f"""
, k AS (SELECT model, CAST(count(*) AS BIGINT) AS n, CAST(count_if(label = 1 AND score >= 0.5) AS BIGINT) AS tp,
               CAST(count_if(label = 0 AND score >= 0.5) AS BIGINT) AS fp, CAST(count_if(label = 1 AND score < 0.5) AS BIGINT) AS fn,
               CAST(count_if(label = 0 AND score < 0.5) AS BIGINT) AS tn FROM lg GROUP BY model),
ar AS (SELECT model, sum(pos * (cum_neg - neg * 0.5)) / (max(P) * max(N)) AS auc, sum(pos / P * tp / (tp + fp)) AS ap FROM mt GROUP BY model)
SELECT k.model, n, tp, fp, fn, tn, round({_dz('tp + tn', 'n')}, 6) AS accuracy, round({_dz('tp', 'tp + fp')}, 6) AS precision,
       round({_dz('tp', 'tp + fn')}, 6) AS recall, round({_dz('2 * tp', '2 * tp + fp + fn')}, 6) AS f1_score,
       round(auc, 6) AS roc_auc, round(ap, 6) AS average_precision FROM k JOIN ar USING (model)""")

SP = f"""
, spd AS (SELECT hadm_id, CASE WHEN {_LOS} < 0 THEN 0.0 ELSE {_LOS} END AS actual,
                 total_charge / 25000.0 AS predicted, total_charge / 25000.0 AS q50,
                 total_charge / 25000.0 * 1.3 AS q75, total_charge / 25000.0 * 1.7 AS q90
          FROM (SELECT o_orderkey AS hadm_id, o_orderdate AS admittime, o_totalprice AS total_charge,
                       o_orderdate + to_days(CAST(1 + o_orderkey % 14 AS INTEGER)) AS dischtime FROM orders)),
rs AS (SELECT hadm_id, actual, predicted, actual - predicted AS residual FROM spd)
"""
sql("eval_regression", SP + """
SELECT CAST(count(*) AS BIGINT) AS n, round(sqrt(avg((actual - predicted) ^ 2)), 6) AS rmse,
       round(avg(abs(actual - predicted)), 6) AS mae,
       round(1 - sum((actual - predicted) ^ 2) / (var_pop(actual) * count(*)), 6) AS r2,
       round(avg(abs((actual - predicted) / CASE WHEN actual = 0 THEN 1e-10 ELSE actual END)) * 100, 6) AS mape,
       CAST(count_if(actual = 0) AS BIGINT) AS n_zero_actuals FROM spd""")
sql("quantile_coverage", SP + """
SELECT round(avg(CAST(actual <= q75 AS DOUBLE)), 6) AS q75_coverage,
       round(avg(CAST(actual <= q90 AS DOUBLE)), 6) AS q90_coverage FROM spd""")
sql("residuals", SP + "SELECT hadm_id, round(actual, 6) AS actual, round(predicted, 6) AS predicted, "
                      "round(residual, 6) AS residual FROM rs")
sql("residual_histogram", SP + """
, mm AS (SELECT min(residual) AS lo, max(residual) AS hi FROM rs),
w AS (SELECT CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo, CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi FROM mm),
ww AS (SELECT lo, (hi - lo) / 30 AS width FROM w),
b AS (SELECT CAST(least(29, floor((residual - lo) / width)) AS INTEGER) AS bin FROM rs, ww),
bins AS (SELECT CAST(range AS INTEGER) AS bin FROM range(30))
SELECT bins.bin, round(lo + bins.bin * width, 6) AS lower, round(lo + (bins.bin + 1) * width, 6) AS upper,
       CAST(count(b.bin) AS BIGINT) AS n
FROM bins CROSS JOIN ww LEFT JOIN b ON b.bin = bins.bin GROUP BY bins.bin, lo, width""")
sql("pred_range", SP + """
SELECT round(least(min(actual), min(predicted)), 6) AS range_min, round(greatest(max(actual), max(predicted)), 6) AS range_max
FROM spd""")
sql("resource_summary", SP + """
SELECT 'charge_rule' AS model_name, 'total_los_days' AS target, round(avg(predicted), 6) AS mean_prediction,
       round(median(predicted), 6) AS median_prediction, round(min(predicted), 6) AS min_prediction,
       round(max(predicted), 6) AS max_prediction, round(sum(predicted), 6) AS total_resource_needs FROM spd""")
sql("capacity_summary", SP + """
SELECT 'charge_rule (q50)' AS model_name, 'total_los_days' AS target, round(avg(q50), 6) AS mean_prediction,
       round(median(q50), 6) AS median_prediction, round(min(q50), 6) AS min_prediction,
       round(max(q50), 6) AS max_prediction, round(sum(q50), 6) AS total_resource_needs,
       round(avg(q50), 6) AS q50_mean, round(sum(q50), 6) AS q50_total,
       round(avg(q75), 6) AS q75_mean, round(sum(q75), 6) AS q75_total, round(sum(q75), 6) AS q75_capacity_need,
       round(avg(q90), 6) AS q90_mean, round(sum(q90), 6) AS q90_total, round(sum(q90), 6) AS q90_capacity_need
FROM spd""")
sql("quantile_curve", SP + "SELECT hadm_id, round(actual, 6) AS actual, round(q50, 6) AS q50, round(q75, 6) AS q75, "
                           "round(q90, 6) AS q90 FROM spd ORDER BY actual, hadm_id")

LOS = f"""
, lo AS (SELECT hadm_id, CASE WHEN {_LOS} < 0 THEN 0.0 ELSE {_LOS} END AS total_los_days,
                {" + ".join(f"coalesce({k}, 0)" for k in _CONDS)} AS comorbidity_score FROM fin),
li AS (SELECT *, total_los_days * (0.2 + 0.3 * comorbidity_score / greatest((SELECT max(comorbidity_score) FROM lo), 1))
              AS icu_los_days FROM lo),
los AS (SELECT *, total_los_days - icu_los_days AS non_icu_los_days FROM li)
"""
sql("los_icu_split", feat(LOS + """
SELECT hadm_id, round(total_los_days, 6) AS total_los_days, comorbidity_score, round(icu_los_days, 6) AS icu_los_days,
       round(non_icu_los_days, 6) AS non_icu_los_days FROM los"""))
sql("los_stats", feat(LOS + """
SELECT round(avg(total_los_days), 6) AS mean_total_los_days, round(avg(icu_los_days), 6) AS mean_icu_los_days FROM los"""))
sql("los_by_split", feat(LOS + _SPLIT + """
SELECT los.hadm_id, round(total_los_days, 6) AS total_los_days, round(icu_los_days, 6) AS icu_los_days,
       round(non_icu_los_days, 6) AS non_icu_los_days, spl.split FROM los JOIN spl ON los.hadm_id = spl.hadm_id"""))
sql("class_weights", _SPLIT + """
, tr AS (SELECT CAST(count(*) AS BIGINT) AS n, CAST(count_if(is_readmission) AS BIGINT) AS n_pos,
                CAST(count_if(NOT is_readmission) AS BIGINT) AS n_neg FROM spl WHERE split = 'train')
SELECT n, n_pos, n_neg, round(n_neg / n_pos, 6) AS scale_pos_weight,
       round(n / (2.0 * n_neg), 6) AS weight_neg, round(n / (2.0 * n_pos), 6) AS weight_pos FROM tr""")


# ---------------------------------------------------------------- models (closed forms on one feature)

_OLS = SP + """
, st AS (SELECT regr_slope(actual, predicted) AS b, regr_intercept(actual, predicted) AS a,
                regr_sxy(actual, predicted) AS sxy, regr_sxx(actual, predicted) AS sxx,
                avg(actual) AS my, avg(predicted) AS mx, count(*) AS n FROM spd)
"""
sql("model_linear", _OLS + """
SELECT 'intercept' AS term, round(a, 6) AS value FROM st UNION ALL SELECT 'x', round(b, 6) FROM st""")
sql("model_ridge", _OLS + """
, rg AS (SELECT sxy / (sxx + 1.0) AS w, my, mx FROM st)
SELECT 'intercept' AS term, round(my - w * mx, 4) AS value FROM rg UNION ALL SELECT 'x', round(w, 4) FROM rg""")
sql("model_elastic_net", _OLS + """
, en AS (SELECT sign(sxy / n) * greatest(abs(sxy / n) - 0.5, 0) / (sxx / n + 0.5) AS w, my, mx FROM st)
SELECT 'intercept' AS term, round(my - w * mx, 4) AS value FROM en UNION ALL SELECT 'x', round(w, 4) FROM en""")
sql("explain_linear", _OLS + """
SELECT hadm_id, 'x' AS feature, round(b * (predicted - mx), 6) AS attribution FROM spd, st""")
sql("explain_summary", _OLS + """
SELECT 'x' AS feature, round(avg(abs(b * (predicted - mx))), 6) AS mean_abs_attribution FROM spd, st""")
sql("regression_leaderboard", _OLS + """
, rg AS (SELECT sxy / (sxx + 1.0) AS w, my, mx FROM st),
en AS (SELECT sign(sxy / n) * greatest(abs(sxy / n) - 0.5, 0) / (sxx / n + 0.5) AS w, my, mx FROM st),
coef AS (SELECT 'LinearRegression' AS model_name, a AS c0, b AS c1, 0 AS pos FROM st
         UNION ALL SELECT 'Ridge', my - w * mx, w, 1 FROM rg
         UNION ALL SELECT 'ElasticNet', my - w * mx, w, 2 FROM en),
sc AS (SELECT model_name, pos, actual, c0 + c1 * predicted AS p FROM coef, spd),
m AS (SELECT model_name, pos, round(sqrt(avg((actual - p) ^ 2)), 4) AS rmse, round(avg(abs(actual - p)), 4) AS mae,
             round(1 - sum((actual - p) ^ 2) / (var_pop(actual) * count(*)), 4) AS r2,
             round(avg(abs((actual - p) / CASE WHEN actual = 0 THEN 1e-10 ELSE actual END)) * 100, 4) AS mape
      FROM sc GROUP BY model_name, pos)
SELECT model_name, rmse, mae, r2, mape, CAST(row_number() OVER (ORDER BY r2 DESC NULLS LAST, pos) AS INTEGER) AS rank
FROM m""")
sql("comorbidity_flags_as_of", f"""
, ps AS (SELECT hadm_id, {", ".join(f"max(CASE WHEN {_cond(k)} THEN 1 ELSE 0 END) AS {k}" for k in _CONDS)}
         FROM fx_diagnoses WHERE hadm_id IN (SELECT hadm_id FROM coh_adm) AND {_ANY} GROUP BY hadm_id),
st AS (SELECT a.subject_id, a.hadm_id, a.admittime, {", ".join(f"CAST(coalesce(ps.{k}, 0) AS INTEGER) AS {k}" for k in _CONDS)}
       FROM coh_adm a LEFT JOIN ps ON a.hadm_id = ps.hadm_id)
SELECT subject_id, hadm_id, {", ".join(f"max({k}) OVER (PARTITION BY subject_id ORDER BY admittime RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {k}" for k in _CONDS)}
FROM st""")
# ---------------------------------------------------------------- searches on one feature, by fold

_FOLDS = SP + f"""
, fo AS (SELECT CAST({hash_key('hadm_id')} % 5 AS INTEGER) AS fold, actual, predicted AS x FROM spd),
ks AS (SELECT DISTINCT fold AS k FROM fo),
tr AS (SELECT k, regr_sxy(actual, x) AS sxy, regr_sxx(actual, x) AS sxx, avg(actual) AS my, avg(x) AS mx, count(*) AS n
       FROM ks JOIN fo ON fold <> k GROUP BY k)
"""
_MSE = """
mse AS (SELECT draw, k, avg((actual - (my + w * (x - mx))) ^ 2) AS mse FROM fit JOIN fo ON fold = k GROUP BY draw, k)
SELECT CAST(draw AS INTEGER) AS draw, round(avg(mse), 4) AS mean_mse FROM mse GROUP BY draw"""
sql("tune_ridge_one_feature", _FOLDS + """
, al AS (SELECT e + 3 AS draw, pow(10.0, e) AS a FROM range(-3, 4) r(e)),
fit AS (SELECT draw, k, my, mx, sxy / (sxx + a) AS w FROM tr, al),
""" + _MSE)
sql("tune_elastic_net_one_feature", _FOLDS + """
, al AS (SELECT (e + 3) * 9 + i - 1 AS draw, pow(10.0, e) AS a, i / 10.0 AS r FROM range(-3, 4) t(e), range(1, 10) u(i)),
fit AS (SELECT draw, k, my, mx, sign(sxy / n) * greatest(abs(sxy / n) - a * r, 0) / (sxx / n + a * (1 - r)) AS w FROM tr, al),
""" + _MSE)
sql("cv_r2_linear", _FOLDS + """
, fit AS (SELECT 'Linear Regression' AS model, k, my, mx, sxy / sxx AS w FROM tr
          UNION ALL SELECT 'Ridge Regression', k, my, mx, sxy / (sxx + 1.0) FROM tr
          UNION ALL SELECT 'Elastic Net', k, my, mx, sign(sxy / n) * greatest(abs(sxy / n) - 0.5, 0) / (sxx / n + 0.5) FROM tr),
r AS (SELECT model, k, 1 - sum((actual - (my + w * (x - mx))) ^ 2) / (var_pop(actual) * count(*)) AS r2 FROM fit JOIN fo ON fold = k GROUP BY model, k)
SELECT model, round(avg(r2), 5) AS mean_r2, round(stddev_pop(r2), 5) AS std_r2 FROM r GROUP BY model""")
ORACLE["readmissions_colocated"] = ORACLE["readmissions"]
ORACLE["comorbidity_flags_dictionary"] = ORACLE["comorbidity_flags"]
ORACLE["final_dataset_shared_scan"] = ORACLE["final_dataset"]
