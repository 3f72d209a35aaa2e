"""Command line: ``spark-submit`` or ``python -m riskflow prepare|train|score ...``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from riskflow.plans import jobs
from riskflow.schemas import DIABETES_CSV_COLUMNS, DIABETES_CSV_SCHEMA, TASKS
from riskflow.session import build_session
from riskflow.sources.ingest import ingest, read_text
from riskflow.sources.tables import exists, read_csv, read_parquet, typed, write_parquet


def read_records(
    spark: SparkSession, task: str, path: str, kind: str, key: Sequence[str] = (), rejects: str | None = None
) -> DataFrame:
    """Input table with the column names of the task; CSV columns go by their header.

    With a place for ``rejects``, the cells of a CSV that cannot be read go there with their key
    and text, and are logged by column.
    """
    if rejects and kind == "csv" and task == "diabetes":
        text = read_text(spark, path).withColumnsRenamed(DIABETES_CSV_COLUMNS)
        found = ingest(text.toDF(*(name.lower() for name in text.columns)), DIABETES_CSV_SCHEMA, key)
        write_parquet(found.rejects, rejects)
        return found.table
    if kind == "parquet":
        df = read_parquet(spark, path)
    elif task == "diabetes":
        df = spark.read.option("header", True).csv(path)
    else:
        df = read_csv(spark, path)
    df = df.withColumnsRenamed(DIABETES_CSV_COLUMNS) if task == "diabetes" else df
    df = df.toDF(*(name.lower() for name in df.columns))
    return typed(df, DIABETES_CSV_SCHEMA) if kind == "csv" and task == "diabetes" else df


def first_input(spark: SparkSession, paths: list[str], kind: str) -> tuple[str, str]:
    """(path, format) of the first input that exists; a name in .csv is one."""
    for path in paths:
        if exists(spark, path):
            return path, "csv" if path.rstrip("/").endswith(".csv") else kind
    raise FileNotFoundError("none of these exists: " + ", ".join(paths))


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="riskflow", description=__doc__)
    parser.add_argument("step", choices=["prepare", "export", "train", "score"])
    parser.add_argument("task", choices=sorted(TASKS))
    parser.add_argument(
        "--input", required=True, nargs="+", help="table of records; the first that exists is read"
    )
    parser.add_argument("--format", choices=["csv", "parquet"], default="parquet")
    parser.add_argument("--rejects", help="where unreadable cells of a CSV with a declared schema go")
    parser.add_argument("--key", nargs="*", default=[], help="columns that name a record")
    parser.add_argument("--folder", help="models and registry; without it only rules score")
    parser.add_argument(
        "--gate", choices=["acceptable", "deployable"], help="least quality of a model that scores"
    )
    parser.add_argument("--max-training-rows", type=int, help="about so many; default all")
    parser.add_argument("--output", help="where the resulting table goes")
    arguments = parser.parse_args(argv)
    if arguments.step == "train":
        if not arguments.key or not arguments.folder:
            parser.error("train needs --key and --folder")
    elif not arguments.output:
        parser.error(f"{arguments.step} needs --output")
    return arguments


def main(argv: list[str] | None = None) -> None:
    a = _arguments(argv)
    spark = build_session("riskflow")
    task, source = TASKS[a.task], first_input(spark, a.input, a.format)
    records = read_records(spark, a.task, *source, a.key, a.rejects)
    if a.step == "prepare":
        write_parquet(jobs.prepared(records, task, a.key), a.output)
    elif a.step == "export":
        jobs.export_cleaned(records, task, a.output)
    elif a.step == "train":
        jobs.train({a.task: (records, a.key)}, a.folder, max_training_rows=a.max_training_rows)
    else:
        write_parquet(jobs.score_table(records, a.task, a.key, a.folder, a.gate), a.output)


if __name__ == "__main__":
    main()
