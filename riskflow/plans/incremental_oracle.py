"""The queries over stored parts as SQL over the whole tables, for another engine."""

from __future__ import annotations

from riskflow.plans.oracle import (
    _AUC,
    _F8,
    _FA,
    _FB,
    _FBN,
    _H_READ,
    _HEART_FAILS,
    _KEY,
    _failed_counts,
    _ratios,
    _rules_diabetes,
    _rules_heart,
    _violations,
)
from riskflow.schemas import DIABETES_SCHEMA

# What was planted in the CSV: unreadable texts, and cells that are empty or blank.
_REJECTED = {
    "glucose": ("l_orderkey % 97 = 5", "'14O'"),
    "age": ("l_partkey % 89 = 3", "age || '.5'"),
    "bmi": ("l_suppkey % 31 = 7", "'n/a'"),
}
_EMPTY = {"insulin": "l_orderkey % 53 = 0", "dpf": "l_orderkey % 59 = 1"}


def _quarantine(name: str) -> str:
    rejected = f"COUNT(CASE WHEN {_REJECTED[name][0]} THEN 1 END)" if name in _REJECTED else "0"
    empty = f"COUNT(CASE WHEN {_EMPTY[name]} THEN 1 END)" if name in _EMPTY else "0"
    counts = {
        "n_rows": "COUNT(*)", "n_read": f"COUNT(*) - {rejected} - {empty}", "n_empty": empty,
        "n_rejected": rejected, "n_null": f"{rejected} + {empty}", "n_aside": rejected,
    }
    columns = ", ".join(f"CAST({value} AS BIGINT) AS {key}" for key, value in counts.items())
    return f"SELECT '{name}' AS column_name, {columns} FROM fa"


def _statistics(name: str) -> str:
    value = f"CAST({name} AS DOUBLE)"
    filled = f"CASE WHEN {name} = 0 THEN (SELECT AVG({value}) FROM fa WHERE {name} <> 0) ELSE {value} END"
    return f"""SELECT '{name}' AS feature, COUNT(*) AS n_rows,
        COUNT(CASE WHEN {name} = 0 THEN 1 END) AS n_zero,
        ROUND(AVG(CASE WHEN {name} <> 0 THEN {value} END), 8) AS mean_nonzero,
        ROUND(AVG({value}), 8) AS mean, ROUND(STDDEV_SAMP({value}), 8) AS std,
        ROUND(STDDEV_SAMP({filled}), 8) AS filled_std FROM fa"""


_HIGH = "CAST(SUM(prediction) AS BIGINT) AS n_high"

INCREMENTAL_ORACLE: dict[str, str] = {
    "csv_quarantine": f"WITH {_FA} " + " UNION ALL ".join(map(_quarantine, DIABETES_SCHEMA.fieldNames())),
    "csv_rejected_cells": f"WITH {_FA} "
    + " UNION ALL ".join(
        f"SELECT {', '.join(f'CAST({k} AS VARCHAR) AS {k}' for k in _KEY.split(', '))},"
        f" '{name}' AS \"column\", {raw} AS raw FROM fa WHERE {planted}"
        for name, (planted, raw) in _REJECTED.items()
    ),
    "merged_statistics": f"WITH {_FA} " + " UNION ALL ".join(map(_statistics, _F8)),
    "merged_evaluation": f"""WITH {_AUC}, c AS (SELECT candidate,
        CAST(SUM(CASE WHEN score >= 0.5e0 AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
        CAST(SUM(CASE WHEN score >= 0.5e0 AND y = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
        CAST(SUM(CASE WHEN score < 0.5e0 AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
        CAST(SUM(CASE WHEN score < 0.5e0 AND y = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn
        FROM candidates WHERE task = 'diabetes' GROUP BY candidate)
        SELECT candidate, n_rows, ROUND(auc, 6) AS auc, {_ratios()}
        FROM aucs JOIN c USING (candidate) WHERE task = 'diabetes'""",
    "validated_once": f"""WITH {_FB}, checked AS (SELECT *, {_violations(_HEART_FAILS)} AS violations FROM fb)
        SELECT violations, COUNT(*) AS n_rows FROM checked GROUP BY violations
        UNION ALL SELECT 'n_rows', COUNT(*) FROM checked
        UNION ALL SELECT 'n_rejected', COUNT(*) FROM checked WHERE violations <> ''
        UNION ALL SELECT 'rule ' || rule, n_failed FROM ({_failed_counts(_HEART_FAILS, 'fb')})""",
    "partitions_replaced": f"""WITH {_FBN.replace('SELECT patient_id,', 'SELECT state_name, patient_id,')},
        changed AS (SELECT * REPLACE (CASE WHEN state_name = 'BUILDING' THEN 1 ELSE smoking END AS smoking)
        FROM fbn), {_H_READ.replace('FROM fbn', 'FROM changed')}, {_rules_heart()}
        SELECT state_name, COUNT(*) AS n_rows, {_HIGH}, state_name <> 'BUILDING' AS files_kept
        FROM scored GROUP BY state_name""",
    "stream_refreshed_model": f"""WITH {_FA}, {_rules_diabetes('fa')}
        SELECT CAST(l_orderkey % 2 AS INTEGER) AS batch, COUNT(*) AS n_rows,
        COUNT(CASE WHEN l_orderkey % 2 = 0 THEN 1 END) AS n_by_rules,
        ROUND(SUM(probability), 4) AS sum_rule_scores FROM scored GROUP BY l_orderkey % 2""",
}
