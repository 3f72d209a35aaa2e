"""What the physical plans must and must not contain."""

import pytest

from riskflow.functions import rules
from riskflow.operators.evaluate import score_counts
from riskflow.plans.queries import QUERIES
from riskflow.sources.views import diabetes_records

ROW_WISE = [
    "diabetes_scan", "score_rules_diabetes", "score_result", "risk_report_diabetes",
    "validate_ranges", "split_hash", "fold_assignment", "tier_contributions",
    "vector_from_columns", "zero_impute", "score_lr", "score_rf",
]


def _plan(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ROW_WISE)
def test_row_wise_queries_do_not_shuffle(spark, sf_dir, name):
    plan = _plan(spark, sf_dir, name)
    assert "Exchange" not in plan and "Window" not in plan


def test_scans_read_needed_columns_only(spark, sf_dir):
    plan = _plan(spark, sf_dir, "zero_impute_stats")
    assert "l_shipdate" not in plan and "l_returnflag" not in plan
    plan = _plan(spark, sf_dir, "encode_binary")
    assert "c_acctbal" not in plan and "o_totalprice" not in plan


def test_aggregates_combine_before_the_shuffle(spark, sf_dir):
    for name in ("profile_heart", "violations_by_rule", "classification_report"):
        assert "partial_" in _plan(spark, sf_dir, name)


def test_scores_are_computed_once(spark, sf_dir):
    """Counts per score combine on the map side; the bound of one ladder occurs once, in no
    filter."""
    scored = rules.with_rule_score(diabetes_records(spark, sf_dir), rules.DIABETES_RULES)
    counts = score_counts(scored, (), "rule_probability", "outcome", "rule_prediction")
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "partial_" in plan and plan.count("glucose <= 90.0") == 1
    assert not any("<= 90.0" in line for line in plan.splitlines() if "Filter" in line)
