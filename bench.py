"""Headline timings: prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Each query
is run to completion over all its rows three times, and the median counts;
grids are tuned once, at the scale of the tables and at the size of the published one.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskflow.operators.train import LR, RF, training_set, tune  # noqa: E402
from riskflow.plans import jobs  # noqa: E402
from riskflow.plans.queries import QUERIES, trained  # noqa: E402
from riskflow.schemas import TASKS  # noqa: E402
from riskflow.session import build_session  # noqa: E402
from riskflow.sources.views import (  # noqa: E402
    DIABETES_KEY,
    HEART_KEY,
    diabetes_records,
    heart_records,
)

HEADLINE = [
    "risk_screening", "profile_diabetes", "profile_heart", "zero_impute_stats", "zero_impute",
    "preparation_stats", "standardize", "prepared_roundtrip", "prepared_heart_roundtrip",
    "csv_roundtrip", "cleaned_export_heart", "validate_ranges_heart", "violations_by_rule",
    "split_hash", "score_rules_diabetes", "score_rules_heart", "auc_rank", "auc_many_scores",
    "rule_quality", "registry_best", "risk_report_diabetes", "risk_report_heart",
    "score_chain_rules_only", "lr_formula", "stream_score",
]
MODEL_QUERIES = ["score_lr", "score_rf", "score_chain", "model_leaderboard"]
# Runs of each query; the median counts, so that the first one, which compiles code and reads
# files from disk, does not.
RUNS = 3
# Rows of the published diabetes table, for a run at its size.
PUBLISHED_ROWS = 768


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name, run):
        started = time.monotonic()
        result = run()
        seconds[name] = round(time.monotonic() - started, 3)
        return result

    def elapsed(run):
        started = time.monotonic()
        run()
        return time.monotonic() - started

    def complete(name):
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    for name in HEADLINE:
        seconds[name] = round(median(elapsed(lambda: complete(name)) for _ in range(RUNS)), 3)
    for name, records, key in (
        ("diabetes", diabetes_records(spark, sf_dir), DIABETES_KEY),
        ("heart", heart_records(spark, sf_dir), HEART_KEY),
    ):
        task = TASKS[name]
        data = timed(
            f"training_set_{name}",
            lambda: _loaded(training_set(jobs.training_records(records, task, key), task, key)),
        )
        timed(f"tune_lr_{name}", lambda: tune(data, LR, parallelism=int(cpus)))
        timed(f"tune_rf_{name}", lambda: tune(data, RF, parallelism=int(cpus)))
        data.release()
    small = diabetes_records(spark, sf_dir).orderBy(*DIABETES_KEY).limit(PUBLISHED_ROWS)
    data = _loaded(training_set(jobs.training_records(small, TASKS["diabetes"], DIABETES_KEY),
                                TASKS["diabetes"], DIABETES_KEY, partitions=1))
    timed(f"tune_lr_{PUBLISHED_ROWS}_rows", lambda: tune(data, LR, parallelism=int(cpus)))
    timed(f"tune_rf_{PUBLISHED_ROWS}_rows", lambda: tune(data, RF, parallelism=int(cpus)))
    data.release()
    trained(spark, sf_dir)
    for name in MODEL_QUERIES:
        timed(name, lambda: complete(name))
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "rows": {
                    "lineitem": spark.read.parquet(f"{sf_dir}/lineitem.parquet").count(),
                    "orders": spark.read.parquet(f"{sf_dir}/orders.parquet").count(),
                },
            }
        )
    )
    spark.stop()


def _loaded(data):
    data.train.count()
    return data


if __name__ == "__main__":
    main()
