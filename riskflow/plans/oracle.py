"""The same queries as SQL for another engine, written independently of the operators.

Steps are written as ``0.05e0`` because a bare ``0.05`` is a decimal there, whose
exact sums would differ from sums of doubles near the 0.5 threshold.
"""

from __future__ import annotations

from riskflow.sources.views import DIABETES_COLUMNS, HEART_COLUMNS

_KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
_FA = f"fa AS (SELECT {', '.join(DIABETES_COLUMNS)} FROM lineitem)"
_FB = (
    f"fb AS (SELECT {', '.join(HEART_COLUMNS)}"
    " FROM orders JOIN customer ON o_custkey = c_custkey)"
)
# The heart records as numbers.
_FBN = f"""{_FB}, fbn AS (
  SELECT patient_id, age, CASE WHEN gender = 'Male' THEN 1 ELSE 0 END AS gender,
    diabetes, hypertension, obesity,
    CASE WHEN smoking = 'Yes' THEN 1 ELSE 0 END AS smoking,
    CASE WHEN alcohol = 'Yes' THEN 1 ELSE 0 END AS alcohol,
    physical_activity, diet_score, cholesterol, triglycerides, ldl, hdl,
    systolic_bp, diastolic_bp, family_history, stress, heart_attack_risk
  FROM fb)"""
_F8 = ("pregnancies", "glucose", "blood_pressure", "skin_thickness", "insulin", "bmi", "dpf", "age")
_F17 = (
    "age", "gender", "diabetes", "hypertension", "obesity", "smoking", "alcohol",
    "physical_activity", "diet_score", "cholesterol", "triglycerides", "ldl", "hdl",
    "systolic_bp", "diastolic_bp", "family_history", "stress",
)
_ZERO = ("glucose", "blood_pressure", "skin_thickness", "insulin", "bmi")

_MEANS = (
    "means AS (SELECT "
    + ", ".join(f"AVG(CASE WHEN {c} <> 0 THEN {c} END) AS m_{c}" for c in _ZERO)
    + " FROM fa)"
)
_FILLED = (
    f"{_FA}, {_MEANS}, filled AS (SELECT {_KEY}, pregnancies, dpf, age, outcome, "
    + ", ".join(f"CASE WHEN {c} = 0 THEN m_{c} ELSE {c} END AS {c}" for c in _ZERO)
    + " FROM fa, means)"
)


def _z_stats(columns, source):
    return (
        "z_stats AS (SELECT "
        + ", ".join(f"AVG({c}) AS a_{c}, STDDEV_SAMP({c}) AS s_{c}" for c in columns)
        + f" FROM {source})"
    )


def _z(c):
    return f"(CAST({c} AS DOUBLE) - a_{c}) / s_{c}"


def _scaled(columns):
    return ", ".join(f"ROUND({_z(c)}, 6) AS {c}" for c in columns)


# --- the two rule books ------------------------------------------------------

# The published tiers and steps, from here to the steps of the heart book.

_GLUCOSE = """CASE WHEN glucose <= 90 THEN 0.05e0 WHEN glucose <= 110 THEN 0.15e0
  WHEN glucose <= 125 THEN 0.3e0 WHEN glucose <= 140 THEN 0.45e0
  WHEN glucose <= 160 THEN 0.55e0 WHEN glucose <= 180 THEN 0.65e0 ELSE 0.75e0 END"""
_BMI = """CASE WHEN bmi < 18.5 THEN 0.05e0 WHEN bmi < 25 THEN 0e0 WHEN bmi < 30 THEN 0.1e0
  WHEN bmi < 35 THEN 0.15e0 WHEN bmi < 40 THEN 0.2e0 ELSE 0.25e0 END"""
_AGE = """CASE WHEN age < 35 THEN -0.05e0 WHEN age < 45 THEN 0e0 WHEN age < 55 THEN 0.1e0
  WHEN age < 65 THEN 0.15e0 ELSE 0.2e0 END"""
_DPF = "CASE WHEN dpf > 0.8e0 THEN 0.15e0 WHEN dpf > 0.5e0 THEN 0.07e0 ELSE 0e0 END"
_BP = "CASE WHEN blood_pressure > 140 THEN 0.1e0 ELSE 0e0 END"
_INSULIN = "CASE WHEN insulin < 15 AND glucose > 125 THEN 0.2e0 ELSE 0e0 END"


def _rules_diabetes(source):
    unreadable = " OR ".join(f"{c} IS NULL" for c in _F8)
    return f"""rules AS (SELECT *, CASE WHEN {unreadable} THEN 0.2e0
  WHEN pregnancies = 0 AND glucose = 120 AND blood_pressure = 70 AND skin_thickness = 20
    AND insulin = 80 AND bmi = 25 AND dpf = 0.5e0 AND age = 30 THEN 0.2e0
  ELSE GREATEST(0.05e0, LEAST(0.95e0,
    0.1e0 + {_GLUCOSE} + {_BMI} + {_AGE} + {_DPF} + {_BP} + {_INSULIN})) END AS probability
  FROM {source}), scored AS (
  SELECT *, CASE WHEN probability >= 0.5e0 THEN 1 ELSE 0 END AS prediction FROM rules)"""


_H_AGE = """CASE WHEN age < 40 THEN -0.05e0 WHEN age < 50 THEN 0.05e0 WHEN age < 60 THEN 0.15e0
  WHEN age < 70 THEN 0.25e0 ELSE 0.3e0 END"""
_H_CHOLESTEROL = """CASE WHEN cholesterol > 240 THEN 0.15e0
  WHEN cholesterol > 200 THEN 0.1e0 ELSE 0e0 END"""
_H_STRESS = "CASE WHEN stress >= 8 THEN 0.15e0 WHEN stress >= 5 THEN 0.05e0 ELSE 0e0 END"


def _flag(column, step):
    return f"CASE WHEN {column} = 1 THEN {step}e0 ELSE 0e0 END"


_H_STEPS = {
    "age": _H_AGE,
    "gender": _flag("gender", 0.1),
    "diabetes": _flag("diabetes", 0.15),
    "hypertension": _flag("hypertension", 0.15),
    "obesity": _flag("obesity", 0.1),
    "smoking": _flag("smoking", 0.2),
    "cholesterol": _H_CHOLESTEROL,
    "physical_activity": _flag("physical_activity", -0.1),
    "stress": _H_STRESS,
    "family_history": _flag("family_history", 0.15),
}
_H_UNTOUCHED = """age = 40 AND gender = 0 AND diabetes = 0 AND hypertension = 0 AND obesity = 0
  AND smoking = 0 AND alcohol = 0 AND physical_activity = 0 AND diet_score = 5"""
# The table has nulls in age and cholesterol only.
_H_READ = """heart AS (SELECT * REPLACE (COALESCE(age, 50) AS age,
  COALESCE(cholesterol, 200e0) AS cholesterol) FROM fbn)"""


def _rules_heart(source="heart"):
    return f"""rules AS (SELECT *, CASE WHEN {_H_UNTOUCHED} THEN 0.2e0
  ELSE GREATEST(0.05e0, LEAST(0.95e0, 0.15e0 + {' + '.join(_H_STEPS.values())})) END AS probability
  FROM {source}), scored AS (
  SELECT *, CASE WHEN probability >= 0.5e0 THEN 1 ELSE 0 END AS prediction FROM rules)"""


_SCORED_A = f"{_FA}, {_rules_diabetes('fa')}"
_SCORED_B = f"{_FBN}, {_H_READ}, {_rules_heart()}"

# --- metrics -------------------------------------------------------------------

# Both tasks, all candidates: rank statistic over distinct scores, ties half.
_AUC = f"""{_FA}, {_rules_diabetes('fa').replace('rules AS', 'ra AS').replace('FROM rules', 'FROM ra')
    .replace('scored AS', 'sa AS')},
  {_FBN}, {_H_READ}, {_rules_heart().replace('rules AS', 'rb AS').replace('FROM rules', 'FROM rb')
    .replace('scored AS', 'sb AS')},
  candidates AS (
    SELECT 'diabetes' AS task, 'rule_score' AS candidate, probability AS score, outcome AS y FROM sa
    UNION ALL SELECT 'diabetes', 'glucose', glucose, outcome FROM sa
    UNION ALL SELECT 'diabetes', 'bmi', bmi, outcome FROM sa
    UNION ALL SELECT 'diabetes', 'dpf', dpf, outcome FROM sa
    UNION ALL SELECT 'heart', 'rule_score', probability, heart_attack_risk FROM sb
    UNION ALL SELECT 'heart', 'age', CAST(age AS DOUBLE), heart_attack_risk FROM fbn
    UNION ALL SELECT 'heart', 'cholesterol', cholesterol, heart_attack_risk FROM fbn),
  counts AS (
    SELECT task, candidate, score, CAST(SUM(y) AS DOUBLE) AS p, CAST(SUM(1 - y) AS DOUBLE) AS n
    FROM candidates WHERE score IS NOT NULL GROUP BY task, candidate, score),
  ranked AS (
    SELECT *, COALESCE(SUM(n) OVER (PARTITION BY task, candidate ORDER BY score
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0) AS below FROM counts),
  aucs AS (
    SELECT task, candidate, CAST(SUM(p + n) AS BIGINT) AS n_rows,
      SUM(p * (below + n / 2e0)) / (SUM(p) * SUM(n)) AS auc
    FROM ranked GROUP BY task, candidate)"""

_BEST = f"""{_AUC}, best AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY task ORDER BY auc DESC,
    CASE candidate WHEN 'rule_score' THEN 1 WHEN 'glucose' THEN 2 WHEN 'bmi' THEN 3
      WHEN 'dpf' THEN 4 WHEN 'age' THEN 5 ELSE 6 END) AS place FROM aucs)"""


def _ratios(tp="tp", fp="fp", fn="fn", tn="tn"):
    return f"""ROUND(CAST({tp} + {tn} AS DOUBLE) / ({tp} + {fp} + {fn} + {tn}), 6) AS accuracy,
  ROUND(CAST({tp} AS DOUBLE) / NULLIF({tp} + {fp}, 0), 6) AS precision,
  ROUND(CAST({tp} AS DOUBLE) / NULLIF({tp} + {fn}, 0), 6) AS recall,
  ROUND(CAST(2 * {tp} AS DOUBLE) / NULLIF(2 * {tp} + {fp} + {fn}, 0), 6) AS f1"""


def _confusion(label):
    return f"""CAST(SUM(CASE WHEN prediction = 1 AND {label} = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
  CAST(SUM(CASE WHEN prediction = 1 AND {label} = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
  CAST(SUM(CASE WHEN prediction = 0 AND {label} = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
  CAST(SUM(CASE WHEN prediction = 0 AND {label} = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn"""


# --- validation ------------------------------------------------------------------

# The documented ranges and choices of the input forms.
_HEART_FAILS = {
    "age": "age BETWEEN 20 AND 100",
    "gender": "gender IN ('Female', 'Male')",
    "diabetes": "diabetes IN (0, 1)",
    "hypertension": "hypertension IN (0, 1)",
    "obesity": "obesity IN (0, 1)",
    "smoking": "smoking IN ('Yes', 'No')",
    "alcohol": "alcohol IN ('Yes', 'No')",
    "physical_activity": "physical_activity IN (0, 1)",
    "diet_score": "diet_score BETWEEN 1 AND 10",
    "stress": "stress BETWEEN 1 AND 10",
    "cholesterol": "cholesterol BETWEEN 100 AND 400",
    "systolic_bp": "systolic_bp BETWEEN 80 AND 200",
    "diastolic_bp": "diastolic_bp BETWEEN 50 AND 150",
    "family_history": "family_history IN (0, 1)",
}
_DIABETES_FAILS = {
    "pregnancies": "pregnancies BETWEEN 0 AND 20",
    "glucose": "glucose BETWEEN 0 AND 300",
    "blood_pressure": "blood_pressure BETWEEN 0 AND 200",
    "skin_thickness": "skin_thickness BETWEEN 0 AND 100",
    "insulin": "insulin BETWEEN 0 AND 900",
    "bmi": "bmi BETWEEN 0 AND 70",
    "dpf": "dpf BETWEEN 0 AND 3",
    "age": "age BETWEEN 0 AND 120",
}


def _violations(checks):
    failed = ", ".join(
        f"CASE WHEN NOT COALESCE({check}, FALSE) THEN '{name}' END" for name, check in checks.items()
    )
    return f"CONCAT_WS(',', {failed})"


def _failed_counts(checks, source):
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, CAST(SUM(CASE WHEN COALESCE({check}, FALSE) THEN 0 ELSE 1 END)"
        f" AS BIGINT) AS n_failed FROM {source}"
        for name, check in checks.items()
    )


def _profile(source, columns):
    return " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, '{kind}' AS data_type, COUNT(*) AS n_rows,"
        f" COUNT(*) - COUNT({name}) AS n_null, "
        + (
            "CAST(NULL AS BIGINT)"
            if kind == "string"
            else f"COUNT(CASE WHEN {name} = 0 THEN 1 END)"
        )
        + f" AS n_zero FROM {source}"
        for name, kind in columns.items()
    )


_FA_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "pregnancies": "int", "glucose": "double", "blood_pressure": "double",
    "skin_thickness": "double", "insulin": "double", "bmi": "double", "dpf": "double",
    "age": "int", "outcome": "int",
}
_FB_TYPES = {
    "patient_id": "bigint", "state_name": "string", "age": "int", "gender": "string",
    "diabetes": "int", "hypertension": "int", "obesity": "int", "smoking": "string",
    "alcohol": "string", "physical_activity": "int", "diet_score": "int",
    "cholesterol": "double", "triglycerides": "double", "ldl": "double", "hdl": "double",
    "systolic_bp": "double", "diastolic_bp": "double", "family_history": "int",
    "stress": "int", "heart_attack_risk": "int",
}

# --- texts -----------------------------------------------------------------------

# The shown texts.
_HEALTHY = "Maintain a healthy lifestyle and regular check-ups."
_BAND = "CASE WHEN prediction = 1 THEN 'high-risk' ELSE 'low-risk' END AS risk_band"


def _texts(subject, high, low, advice):
    return f"""prediction, {_BAND},
  CASE WHEN prediction = 1 THEN '{high}' ELSE '{low}' END AS headline,
  'The prediction indicates a ' || printf('%.1f%%', probability * 100) || ' probability of {subject}.'
    AS message,
  CASE WHEN prediction = 1 THEN '{advice}' ELSE '{_HEALTHY}' END AS recommendation"""


_TEXTS_A = _texts(
    "diabetes", "High Risk of Diabetes", "Low Risk of Diabetes",
    "Further clinical tests are recommended.",
)
_TEXTS_B = _texts(
    "heart attack risk", "High Risk of Heart Attack", "Low Risk of Heart Attack",
    "Immediate medical consultation is advised.",
)
_RULES_ONLY = """probability, 'rule_based' AS model_used,
  CAST(NULL AS INTEGER) AS logistic_regression_prediction,
  CAST(NULL AS DOUBLE) AS logistic_regression_probability,
  CAST(NULL AS INTEGER) AS random_forest_prediction,
  CAST(NULL AS DOUBLE) AS random_forest_probability,
  prediction AS rule_based_prediction, probability AS rule_based_probability"""

_SUMMARY_A = f"""WITH {_FA} SELECT outcome, COUNT(*) AS n_rows, SUM(glucose) AS sum_glucose,
  ROUND(SUM(dpf), 4) AS sum_dpf, CAST(SUM(age) AS BIGINT) AS sum_age, MAX(bmi) AS max_bmi
  FROM fa GROUP BY outcome"""


def _digest(key, start):
    return f"CAST('0x' || SUBSTR(MD5(CONCAT_WS('|', {key})), {start}, 7) AS BIGINT)"


_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in _F17)
_WEIGHTS = (0.1, 1.2, -0.15, 0.05, -0.1, 0.7, 0.3, 0.4)
_MARGIN = "-0.85e0 + " + " + ".join(f"({w}e0) * ({_z(c)})" for c, w in zip(_F8, _WEIGHTS))

ORACLE: dict[str, str] = {
    "risk_screening": f"""WITH {_FILLED}, {_rules_diabetes('filled')}
        SELECT {_KEY}, probability, prediction, {_BAND} FROM scored""",
    "diabetes_scan": f"WITH {_FA} SELECT * FROM fa",
    "heart_scan": f"WITH {_FB} SELECT * FROM fb",
    "csv_roundtrip": _SUMMARY_A,
    "csv_inferred": f"""WITH {_FB} SELECT gender, smoking, COUNT(*) AS n_rows,
        CAST(SUM(age) AS BIGINT) AS sum_age, COUNT(cholesterol) AS n_cholesterol,
        SUM(cholesterol) AS sum_cholesterol FROM fb GROUP BY gender, smoking""",
    "read_first_available": _SUMMARY_A,
    "prepared_roundtrip": f"""WITH {_FILLED}, {_z_stats(_F8, 'filled')}
        SELECT {_KEY}, {_scaled(_F8)}, outcome FROM filled, z_stats""",
    "prepared_heart_roundtrip": f"""WITH {_FBN}, complete AS (SELECT * FROM fbn WHERE {_COMPLETE}),
        {_z_stats(_F17, 'complete')}
        SELECT patient_id, {_scaled(_F17)}, heart_attack_risk FROM complete, z_stats""",
    "cleaned_export_diabetes": f"""WITH {_FILLED} SELECT {_KEY}, pregnancies, dpf, age, outcome,
        {', '.join(f'ROUND({c}, 6) AS {c}' for c in _ZERO)} FROM filled""",
    "cleaned_export_heart": f"""WITH {_FB} SELECT * EXCLUDE (patient_id, state_name)
        REPLACE (CASE gender WHEN 'Male' THEN 1 WHEN 'Female' THEN 0 END AS gender)
        FROM fb WHERE age IS NOT NULL AND cholesterol IS NOT NULL""",
    "drop_columns": f"WITH {_FB} SELECT * EXCLUDE (patient_id, state_name) FROM fb",
    "all_but_label": f"""WITH {_FBN} SELECT heart_attack_risk,
        {', '.join(f'CAST(SUM({c}) AS DOUBLE) AS sum_{c}' for c in _F17)}
        FROM fbn WHERE {_COMPLETE} GROUP BY heart_attack_risk""",
    "encode_binary": f"""WITH {_FB}
        SELECT patient_id, CASE WHEN gender = 'Male' THEN 1 ELSE 0 END AS gender FROM fb""",
    "encode_mapped": f"""WITH {_FB} SELECT patient_id,
        CASE gender WHEN 'Male' THEN 1 WHEN 'Female' THEN 0 END AS gender FROM fb""",
    "encode_yes_no": f"""WITH {_FBN} SELECT patient_id, gender, diabetes, hypertension, obesity,
        smoking, alcohol, physical_activity, family_history FROM fbn""",
    "drop_nulls": f"WITH {_FB} SELECT * FROM fb WHERE age IS NOT NULL AND cholesterol IS NOT NULL",
    "validate_ranges": f"""WITH {_FA}, checked AS (
        SELECT {_KEY}, {_violations(_DIABETES_FAILS)} AS violations FROM fa)
        SELECT *, violations = '' AS valid FROM checked""",
    "validate_ranges_heart": f"""WITH {_FB}, checked AS (
        SELECT patient_id, {_violations(_HEART_FAILS)} AS violations FROM fb)
        SELECT *, violations = '' AS valid FROM checked""",
    "rejected_rows": f"""WITH {_FB}, checked AS (
        SELECT patient_id, age, gender, cholesterol, {_violations(_HEART_FAILS)} AS violations FROM fb)
        SELECT * FROM checked WHERE violations <> ''""",
    "valid_rows": f"WITH {_FB} SELECT * FROM fb WHERE {' AND '.join(_HEART_FAILS.values())}",
    "violations_by_rule": f"WITH {_FB} {_failed_counts(_HEART_FAILS, 'fb')}",
    "validate_pregnancies": f"""WITH {_FA}, g AS (SELECT *,
        CASE WHEN l_suppkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender FROM fa)
        {_failed_counts(_DIABETES_FAILS
            | {'male_pregnancies': "gender <> 'Male' OR pregnancies = 0"}, 'g')}""",
    "sample_rows": f"""WITH {_FA} SELECT * FROM fa
        ORDER BY {_KEY}, {', '.join(_F8)} LIMIT 5""",
    "profile_diabetes": f"WITH {_FA} {_profile('fa', _FA_TYPES)}",
    "profile_heart": f"WITH {_FB} {_profile('fb', _FB_TYPES)}",
    "zero_impute_stats": f"WITH {_FA} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(CASE WHEN {c} = 0 THEN 1 END) AS n_zero,"
        f" ROUND(AVG(CASE WHEN {c} <> 0 THEN {c} END), 6) AS mean_nonzero FROM fa"
        for c in _ZERO
    ),
    "zero_impute": f"""WITH {_FILLED}
        SELECT {_KEY}, {', '.join(f'ROUND({c}, 6) AS {c}' for c in _ZERO)} FROM filled""",
    "vector_from_columns": f"""WITH {_FA}
        SELECT {_KEY}, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _F8)} FROM fa""",
    "scaler_stats": f"WITH {_FA} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, ROUND(AVG({c}), 8) AS mean,"
        f" ROUND(STDDEV_SAMP({c}), 8) AS std FROM fa"
        for c in _F8
    ),
    "standardize": f"""WITH {_FA}, {_z_stats(_F8, 'fa')}
        SELECT {_KEY}, {_scaled(_F8)} FROM fa, z_stats""",
    "preparation_stats": f"WITH {_FILLED} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, ROUND(AVG({c}), 8) AS mean,"
        f" ROUND(STDDEV_SAMP({c}), 8) AS std FROM filled"
        for c in _F8
    ),
    "split_hash": f"WITH {_FA} SELECT {_KEY}, {_digest(_KEY, 1)} % 100 < 80 AS train FROM fa",
    "split_sizes": f"""WITH {_FB} SELECT
        CASE WHEN {_digest('patient_id', 1)} % 100 < 80 THEN 'train' ELSE 'test' END AS part,
        heart_attack_risk AS label, COUNT(*) AS n_rows FROM fb GROUP BY 1, 2""",
    "fold_assignment": f"""WITH {_FA}
        SELECT {_KEY}, CAST({_digest(_KEY, 8)} % 3 AS INTEGER) AS fold FROM fa""",
    "score_rules_diabetes": f"WITH {_SCORED_A} SELECT {_KEY}, probability, prediction FROM scored",
    "score_rules_diabetes_missing": f"""WITH {_FA}, gaps AS (SELECT * REPLACE (
        NULLIF(glucose, 0) AS glucose, NULLIF(blood_pressure, 0) AS blood_pressure,
        NULLIF(bmi, 0) AS bmi) FROM fa), {_rules_diabetes('gaps')}
        SELECT {_KEY}, probability, prediction FROM scored""",
    "score_rules_heart": f"WITH {_SCORED_B} SELECT patient_id, probability, prediction FROM scored",
    # Positions 16 and 17 are beyond the 14 fields of the form.
    "score_rules_heart_positional": f"""WITH {_FBN}, heart AS (SELECT * REPLACE (
        COALESCE(age, 50) AS age, COALESCE(cholesterol, 200e0) AS cholesterol,
        0 AS family_history, 5 AS stress) FROM fbn), {_rules_heart()}
        SELECT patient_id, probability, prediction FROM scored""",
    "default_profile": f"""WITH {_FBN}, {_H_READ}
        SELECT patient_id, {_H_UNTOUCHED} AS is_default FROM heart""",
    "feature_defaults": f"""WITH {_FBN}, {_H_READ} SELECT patient_id,
        {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _F17
                   if c not in ('triglycerides', 'hdl', 'stress'))},
        50e0 AS hdl, 5e0 AS stress FROM heart""",
    "tier_contributions": f"""WITH {_FA} SELECT {_KEY}, {_GLUCOSE} AS glucose_step,
        {_BMI} AS bmi_step, {_AGE} AS age_step, {_DPF} AS dpf_step,
        {_BP} AS blood_pressure_step, {_INSULIN} AS insulin_step FROM fa""",
    "tier_contributions_heart": f"""WITH {_FBN}, {_H_READ} SELECT patient_id,
        {', '.join(f'{step} AS {name}_step' for name, step in _H_STEPS.items())} FROM heart""",
    "auc_rank": f"WITH {_AUC} SELECT task, candidate, n_rows, ROUND(auc, 6) AS auc FROM aucs",
    "auc_many_scores": """WITH counts AS (SELECT l_extendedprice AS score,
        CAST(SUM(CASE WHEN l_quantity >= 25 THEN 1 ELSE 0 END) AS DOUBLE) AS p,
        CAST(SUM(CASE WHEN l_quantity >= 25 THEN 0 ELSE 1 END) AS DOUBLE) AS n
        FROM lineitem GROUP BY l_extendedprice),
        ranked AS (SELECT *, COALESCE(SUM(n) OVER (ORDER BY score
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0) AS below FROM counts)
        SELECT 'price' AS candidate, CAST(SUM(p + n) AS BIGINT) AS n_rows,
        ROUND(SUM(p * (below + n / 2e0)) / (SUM(p) * SUM(n)), 6) AS auc FROM ranked""",
    "accuracy": f"""WITH {_SCORED_A} SELECT COUNT(*) AS n_rows, ROUND(AVG(
        CASE WHEN prediction = outcome THEN 1e0 ELSE 0e0 END), 6) AS accuracy FROM scored""",
    "classification_report": f"""WITH {_SCORED_B}, c AS (
        SELECT gender, {_confusion('heart_attack_risk')} FROM scored GROUP BY gender)
        SELECT *, {_ratios()} FROM c""",
    "rule_quality": f"""WITH {_AUC}, c AS (
        SELECT 'diabetes' AS task, {_confusion('outcome')} FROM sa
        UNION ALL SELECT 'heart', {_confusion('heart_attack_risk')} FROM sb)
        SELECT task, n_rows, ROUND(auc, 6) AS auc, {_ratios()}
        FROM c JOIN aucs USING (task) WHERE candidate = 'rule_score'""",
    "quality_gate": f"""WITH {_AUC} SELECT task, candidate, ROUND(auc, 6) AS auc,
        CASE WHEN auc >= 0.8 THEN 'deployable' WHEN auc >= 0.7 THEN 'acceptable'
          ELSE 'rejected' END AS gate FROM aucs""",
    "registry_best": f"""WITH {_BEST} SELECT task, candidate AS family,
        CASE task WHEN 'heart' THEN 'mlruns/heart_model_rf'
          ELSE 'mlruns/diabetes_logistic_regression' END AS path, ROUND(auc, 6) AS auc
        FROM best WHERE place = 1""",
    "registry_text_roundtrip": """SELECT * FROM (VALUES
        ('diabetes', 'mlruns/diabetes_logistic_regression', 'logistic_regression'),
        ('heart', 'mlruns/heart_model_rf', 'random_forest')) AS t(task, path, family)""",
    "score_chain_rules_only": f"""WITH {_SCORED_B}
        SELECT patient_id, {_RULES_ONLY}, {_TEXTS_B} FROM scored""",
    "score_result": f"WITH {_SCORED_A} SELECT {_KEY}, prediction, {_RULES_ONLY} FROM scored",
    "risk_report_diabetes": f"WITH {_SCORED_A} SELECT {_KEY}, {_TEXTS_A} FROM scored",
    "risk_report_heart": f"WITH {_SCORED_B} SELECT patient_id, {_TEXTS_B} FROM scored",
    "lr_formula": f"""WITH {_FILLED}, {_z_stats(_F8, 'filled')}, p AS (
        SELECT {_KEY}, 1e0 / (1e0 + EXP(-({_MARGIN}))) AS probability FROM filled, z_stats)
        SELECT {_KEY}, ROUND(probability, 6) AS probability,
        CASE WHEN probability >= 0.5e0 THEN 1 ELSE 0 END AS prediction FROM p""",
    "stream_score": f"""WITH {_SCORED_A} SELECT {_KEY}, prediction, probability,
        'rule_based' AS model_used, {_BAND} FROM scored""",
    "stream_score_heart": f"""WITH {_SCORED_B} SELECT patient_id, prediction, probability,
        'rule_based' AS model_used, {_BAND} FROM scored""",
    # Every record is scored, and no score changes by saving and loading.
    "model_roundtrip": """SELECT COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS n_different
        FROM lineitem""",
    # The model answers complete records, the rule book the others.
    "score_chain_coverage": f"""WITH {_SCORED_B}, marked AS (
        SELECT scored.probability, NOT ({' AND '.join(f'fbn.{c} IS NOT NULL' for c in _F17)})
          AS by_rules FROM scored JOIN fbn USING (patient_id))
        SELECT by_rules, COUNT(*) AS n_rows,
        ROUND(SUM(CASE WHEN by_rules THEN probability END), 4) AS sum_rule_answers,
        ROUND(SUM(probability), 4) AS sum_rule_scores FROM marked GROUP BY by_rules""",
}
_FAMILIES = "(VALUES ('logistic_regression'), ('random_forest')) AS f(family)"
_TASK_NAMES = "(VALUES ('diabetes'), ('heart')) AS t(task)"
_TEST_ROWS = f"""test_rows AS (
  SELECT 'diabetes' AS task, COUNT(*) AS n_rows FROM fa WHERE {_digest(_KEY, 1)} % 100 >= 80
  UNION ALL SELECT 'heart', COUNT(*) FROM fb
  WHERE {_digest('patient_id', 1)} % 100 >= 80 AND {_COMPLETE})"""
_HOLDS = "TRUE AS better_than_chance, TRUE AS in_range, TRUE AS gate_holds"


def _single_fit(family):
    return f"""WITH {_FA}, {_FB}, {_TEST_ROWS}
        SELECT task, '{family}' AS family, n_rows, {_HOLDS}, TRUE AS timed FROM test_rows"""


def _grid(family, **points):
    """Every point of the grid, its figures valid, one of them chosen."""
    lists = ", ".join(
        f"(VALUES {', '.join(f'({v}e0)' for v in values)}) AS g{i}({name})"
        for i, (name, values) in enumerate(points.items())
    )
    return f"""SELECT task, '{family}' AS family, {', '.join(points)}, TRUE AS auc_valid,
        TRUE AS chosen_is_best, CAST(1 AS BIGINT) AS n_chosen FROM {_TASK_NAMES}, {lists}"""


def _features(columns, task):
    names = ", ".join(f"('{c}')" for c in columns)
    return f"""SELECT '{task}' AS task, family, feature, TRUE AS valid,
        CASE family WHEN 'random_forest' THEN 1e0 END AS sum_weights
        FROM {_FAMILIES}, (VALUES {names}) AS c(feature)"""


# Facts that hold for any good fit: the fitted numbers themselves are not SQL's to tell.
ORACLE |= {
    "csv_with_key": _SUMMARY_A,
    "validate_ranges_form": ORACLE["validate_ranges_heart"],
    "auc_other_prediction": f"""WITH r AS (SELECT l_quantity AS score,
        CASE WHEN l_extendedprice >= 30000 THEN 1 ELSE 0 END AS label,
        l_linenumber % 2 AS prediction FROM lineitem),
        counts AS (SELECT score, CAST(SUM(label) AS DOUBLE) AS p,
          CAST(SUM(1 - label) AS DOUBLE) AS n FROM r GROUP BY score),
        ranked AS (SELECT *, COALESCE(SUM(n) OVER (ORDER BY score
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0) AS below FROM counts),
        aucs AS (SELECT CAST(SUM(p + n) AS BIGINT) AS n_rows,
          ROUND(SUM(p * (below + n / 2e0)) / (SUM(p) * SUM(n)), 6) AS auc FROM ranked),
        c AS (SELECT {_confusion('label')} FROM r),
        ratios AS (SELECT *, {_ratios()} FROM c)
        SELECT 'quantity' AS candidate, n_rows, auc, accuracy, precision, recall, f1
        FROM aucs, ratios""",
    "train_lr": _single_fit("logistic_regression"),
    "train_rf": _single_fit("random_forest"),
    "fit_repeatable": f"""WITH {_FA}, {_FB}, {_TEST_ROWS}
        SELECT n_rows, CAST(0 AS BIGINT) AS n_different FROM test_rows WHERE task = 'heart'""",
    "tune_lr": _grid(
        "logistic_regression", regParam=(0.01, 0.1, 0.3), elasticNetParam=(0.0, 0.5, 1.0)
    ),
    "tune_rf": _grid("random_forest", numTrees=(10, 20), maxDepth=(5, 10)),
    "feature_weights": f"{_features(_F8, 'diabetes')} UNION ALL {_features(_F17, 'heart')}",
    "registry_rows": f"""WITH {_FB}, dropped AS (
        SELECT 'heart' AS task, COUNT(*) AS n FROM fb WHERE NOT ({_COMPLETE}))
        SELECT task, family, TRUE AS complete, COALESCE(n, 0) AS dropped_rows,
        TRUE AS path_names_it
        FROM {_TASK_NAMES} LEFT JOIN dropped USING (task), {_FAMILIES}""",
    "model_leaderboard": f"""SELECT task, family, {_HOLDS}, TRUE AS chosen_is_best,
        CAST(1 AS BIGINT) AS n_chosen FROM {_TASK_NAMES}, {_FAMILIES}""",
    "score_lr": f"""WITH {_FA} SELECT {_KEY}, TRUE AS in_range, TRUE AS agrees,
        TRUE AS as_by_hand FROM fa""",
    "score_rf": f"WITH {_FA} SELECT {_KEY}, TRUE AS in_range, TRUE AS agrees FROM fa",
    "score_chain": f"""WITH {_FBN} SELECT patient_id, TRUE AS in_range, TRUE AS agrees,
        {_COMPLETE} AS by_model FROM fbn""",
    "stream_score_model": """SELECT COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS n_different
        FROM lineitem""",
}
ORACLE["vector_assembler"] = ORACLE["struct_to_vector"] = ORACLE["vector_from_columns"]
