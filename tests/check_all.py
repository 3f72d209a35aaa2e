"""Run every query against its SQL counterpart: ``python tests/check_all.py [sf_dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from compare import connect, differences  # noqa: E402

import __spark_entry__ as contract  # noqa: E402
from riskflow.session import build_session  # noqa: E402


def main(sf_dir="/root/testdata/sf0.01", *names):
    spark = build_session("check", "local[8]", spark__sql__shuffle__partitions=8,
                          spark__driver__memory="12g", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(sf_dir), contract.oracle_sql(), []
    for name, run in contract.queries().items():
        if names and name not in names:
            continue
        started = time.monotonic()
        try:
            df = run(spark, sf_dir)
            if name in sql:
                outcome = "; ".join(differences(df, con, sql[name])) or "equal"
            else:
                outcome = f"rows only: {df.count()}"
        except Exception as error:
            outcome = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:32s} {time.monotonic() - started:6.2f}s  {outcome}", flush=True)
        if outcome != "equal" and not outcome.startswith("rows only"):
            bad.append(name)
    print("different:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
