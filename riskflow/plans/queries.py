"""One query per operator, each over whole tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskflow.__main__ import read_records

from riskflow.functions import rules
from riskflow.functions.encode import GENDER_CODES, MALE, YES, equals_flag, mapped
from riskflow.functions.scalar import at_threshold
from riskflow.functions.vectors import ensure_vector, unpacked, vector_of
from riskflow.operators import evaluate as ev
from riskflow.operators import prepare, quality, split
from riskflow.operators.report import with_report
from riskflow.operators.score import ChosenModel, flat_result, score, with_model_score
from riskflow.operators.train import LR, RF, feature_importance, fit, grid_table, training_set
from riskflow.plans import jobs
from riskflow.schemas import DIABETES, DIABETES_CSV_COLUMNS, DIABETES_SCHEMA, HEART, TASKS
from riskflow.session import scratch_path
from riskflow.sources import registry, tables
from riskflow.sources.models import load_model, save_model
from riskflow.sources.views import (
    DIABETES_KEY,
    HEART_KEY,
    diabetes_from,
    diabetes_records,
    heart_from,
    heart_records,
    table,
)
from riskflow.streaming.score import score_available

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _rounded(names: Sequence[str], digits: int = 6) -> list[Column]:
    return [F.round(F.col(name), digits).alias(name) for name in names]


# --- the flagship ----------------------------------------------------------


@query
def risk_screening(spark, sf_dir):
    """Fill implausible zeros, score every record by the rule book, attach texts."""
    filled = prepare.zero_impute(diabetes_records(spark, sf_dir), DIABETES.zero_columns)
    scored = flat_result(score(filled, "diabetes"), *DIABETES_KEY)
    return with_report(scored, "diabetes").select(
        *DIABETES_KEY, "probability", "prediction", "risk_band"
    )


# --- scans and sinks -------------------------------------------------------


@query
def diabetes_scan(spark, sf_dir):
    return diabetes_records(spark, sf_dir)


@query
def heart_scan(spark, sf_dir):
    return heart_records(spark, sf_dir)


def _diabetes_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("outcome").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("glucose").alias("sum_glucose"),
        F.round(F.sum("dpf"), 4).alias("sum_dpf"),
        F.sum("age").alias("sum_age"),
        F.max("bmi").alias("max_bmi"),
    )


@query
def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "diabetes_csv")
    tables.write_csv(diabetes_records(spark, sf_dir), path)
    return _diabetes_summary(tables.read_csv(spark, path, DIABETES_SCHEMA))


@query
def csv_with_key(spark, sf_dir):
    """The public header behind a key column, columns in another order."""
    path = scratch_path(spark, "diabetes_keyed")
    public = {column: header for header, column in DIABETES_CSV_COLUMNS.items()}
    records = diabetes_records(spark, sf_dir)
    names = [*DIABETES_KEY, *reversed([n for n in records.columns if n not in DIABETES_KEY])]
    tables.write_csv(records.select(*names).withColumnsRenamed(public), path)
    return _diabetes_summary(read_records(spark, "diabetes", path, "csv"))


@query
def csv_inferred(spark, sf_dir):
    path = scratch_path(spark, "heart_csv")
    tables.write_csv(heart_records(spark, sf_dir), path)
    return tables.read_csv(spark, path).groupBy("gender", "smoking").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("age").alias("sum_age"),
        F.count("cholesterol").alias("n_cholesterol"),
        F.sum("cholesterol").alias("sum_cholesterol"),
    )


@query
def read_first_available(spark, sf_dir):
    """Only the CSV fallback exists, so that is what gets read."""
    folder = scratch_path(spark, "fallback")
    locations = tables.candidates(folder, "diabetes")
    tables.write_csv(diabetes_records(spark, sf_dir), locations[-1][1])
    return _diabetes_summary(tables.read_first_available(spark, locations, DIABETES_SCHEMA))


@query
def prepared_roundtrip(spark, sf_dir):
    folder = scratch_path(spark, "prepared")
    path = jobs.save_prepared(diabetes_records(spark, sf_dir), DIABETES, folder, DIABETES_KEY)
    stored = ensure_vector(tables.read_parquet(spark, path))
    wide = stored.select(*DIABETES_KEY, *unpacked("features", DIABETES.features), "outcome")
    return wide.select(*DIABETES_KEY, *_rounded(DIABETES.features), "outcome")


@query
def prepared_heart_roundtrip(spark, sf_dir):
    folder = scratch_path(spark, "prepared")
    path = jobs.save_prepared(heart_records(spark, sf_dir), HEART, folder, HEART_KEY)
    stored = ensure_vector(tables.read_parquet(spark, path))
    wide = stored.select(*HEART_KEY, *unpacked("features", HEART.features), "heart_attack_risk")
    return wide.select(*HEART_KEY, *_rounded(HEART.features), "heart_attack_risk")


@query
def cleaned_export_diabetes(spark, sf_dir):
    path = scratch_path(spark, "diabetes_cleaned")
    jobs.export_cleaned(diabetes_records(spark, sf_dir), DIABETES, path)
    kinds = {name: "int" for name in ("pregnancies", "age", "outcome")}
    kinds |= {name: "bigint" for name in DIABETES_KEY} | {"l_linenumber": "int"}
    header = spark.read.option("header", True).csv(path).columns
    schema = ", ".join(f"{name} {kinds.get(name, 'double')}" for name in header)
    stored = tables.read_csv(spark, path, schema)
    exact = [name for name in stored.columns if name not in DIABETES.zero_columns]
    return stored.select(*exact, *_rounded(DIABETES.zero_columns))


@query
def cleaned_export_heart(spark, sf_dir):
    path = scratch_path(spark, "heart_cleaned")
    jobs.export_cleaned(heart_records(spark, sf_dir), HEART, path)
    return tables.read_csv(spark, path)


# --- projections, filters, validation --------------------------------------


@query
def drop_columns(spark, sf_dir):
    """``ward`` is in no record; naming it is not an error."""
    return quality.drop_columns(heart_records(spark, sf_dir), (*HEART.drop_columns, "ward"))


@query
def all_but_label(spark, sf_dir):
    """Features named by exclusion only, assembled and summed per label."""
    clean = jobs.cleaned(heart_records(spark, sf_dir), HEART)
    names = quality.numeric_features(clean, {HEART.label})
    wide = prepare.assemble(clean, names).select(HEART.label, *unpacked("features", names))
    return wide.groupBy(HEART.label).agg(*(F.sum(name).alias(f"sum_{name}") for name in names))


@query
def encode_binary(spark, sf_dir):
    records = heart_records(spark, sf_dir)
    return records.select(*HEART_KEY, equals_flag(F.col("gender"), MALE).alias("gender"))


@query
def encode_mapped(spark, sf_dir):
    records = heart_records(spark, sf_dir)
    return records.select(*HEART_KEY, mapped(F.col("gender"), GENDER_CODES).alias("gender"))


@query
def encode_yes_no(spark, sf_dir):
    """All answers of the form, the gender among them, as 0 and 1."""
    answers = HEART.yes_no_columns
    coded = jobs.encoded(_form_answers(heart_records(spark, sf_dir)), HEART)
    return coded.select(*HEART_KEY, HEART.gender_column, *answers)


def _form_answers(records: DataFrame) -> DataFrame:
    """Heart records as the form gives them: every flag as Yes or No."""
    numbers = [n for n in HEART.yes_no_columns if records.schema[n].dataType.simpleString() == "int"]
    return records.withColumns({n: F.when(F.col(n) == 1, YES).otherwise("No") for n in numbers})


@query
def drop_nulls(spark, sf_dir):
    return quality.drop_nulls(heart_records(spark, sf_dir))


def _checked(df: DataFrame, key: Sequence[str], checks: Sequence[quality.Rule]) -> DataFrame:
    return quality.with_violations(df, checks).select(
        *key,
        F.array_join("violations", ",").alias("violations"),
        (F.size("violations") == 0).alias("valid"),
    )


@query
def validate_ranges(spark, sf_dir):
    return _checked(diabetes_records(spark, sf_dir), DIABETES_KEY, quality.DIABETES_INPUT_RULES)


@query
def validate_ranges_heart(spark, sf_dir):
    return _checked(heart_records(spark, sf_dir), HEART_KEY, quality.HEART_INPUT_RULES)


@query
def validate_ranges_form(spark, sf_dir):
    """The same checks on form answers, Yes and No throughout."""
    answers = _form_answers(heart_records(spark, sf_dir))
    return _checked(answers, HEART_KEY, quality.HEART_INPUT_RULES)


@query
def rejected_rows(spark, sf_dir):
    _, rejected = quality.split_valid(heart_records(spark, sf_dir), quality.HEART_INPUT_RULES)
    return rejected.select(
        *HEART_KEY, "age", "gender", "cholesterol",
        F.array_join("violations", ",").alias("violations"),
    )


@query
def valid_rows(spark, sf_dir):
    valid, _ = quality.split_valid(heart_records(spark, sf_dir), quality.HEART_INPUT_RULES)
    return valid


@query
def violations_by_rule(spark, sf_dir):
    return quality.violations_by_rule(heart_records(spark, sf_dir), quality.HEART_INPUT_RULES)


@query
def validate_pregnancies(spark, sf_dir):
    """Records with a gender: no pregnancies for male patients."""
    gender = F.when(F.col("l_suppkey") % 2 == 0, "Male").otherwise("Female")
    records = diabetes_records(spark, sf_dir).withColumn("gender", gender)
    checks = quality.applicable(
        (*quality.DIABETES_INPUT_RULES, quality.PREGNANCY_RULE), records.columns
    )
    return quality.violations_by_rule(records, checks)


@query
def sample_rows(spark, sf_dir):
    """The first five records by key: a top-k, not a full sort."""
    records = diabetes_records(spark, sf_dir)
    return records.orderBy(*DIABETES_KEY, *DIABETES.features).limit(5)


# --- profiles and preparation ----------------------------------------------


@query
def profile_diabetes(spark, sf_dir):
    return quality.profile(diabetes_records(spark, sf_dir))


@query
def profile_heart(spark, sf_dir):
    return quality.profile(heart_records(spark, sf_dir))


@query
def zero_impute_stats(spark, sf_dir):
    stats = prepare.nonzero_stats(diabetes_records(spark, sf_dir), DIABETES.zero_columns)
    return stats.select("column_name", "n_zero", *_rounded(["mean_nonzero"]))


@query
def zero_impute(spark, sf_dir):
    filled = prepare.zero_impute(diabetes_records(spark, sf_dir), DIABETES.zero_columns)
    return filled.select(*DIABETES_KEY, *_rounded(DIABETES.zero_columns))


@query
def vector_from_columns(spark, sf_dir):
    records = diabetes_records(spark, sf_dir)
    vectors = records.select(*DIABETES_KEY, vector_of(DIABETES.features).alias("features"))
    return vectors.select(*DIABETES_KEY, *unpacked("features", DIABETES.features))


@query
def vector_assembler(spark, sf_dir):
    vectors = prepare.assemble(diabetes_records(spark, sf_dir), DIABETES.features)
    return vectors.select(*DIABETES_KEY, *unpacked("features", DIABETES.features))


@query
def struct_to_vector(spark, sf_dir):
    """Vectors stored by another writer as a plain struct."""
    values = F.array(*(F.col(name).cast("double") for name in DIABETES.features))
    plain = F.struct(F.lit(1).alias("type"), values.alias("values"))
    stored = diabetes_records(spark, sf_dir).select(*DIABETES_KEY, plain.alias("features"))
    return ensure_vector(stored).select(*DIABETES_KEY, *unpacked("features", DIABETES.features))


@query
def scaler_stats(spark, sf_dir):
    stats = prepare.scaler_stats(diabetes_records(spark, sf_dir), DIABETES.features)
    return stats.select("feature", *_rounded(["mean", "std"], 8))


@query
def standardize(spark, sf_dir):
    scaled = prepare.standardize(diabetes_records(spark, sf_dir), DIABETES.features)
    wide = scaled.select(*DIABETES_KEY, *unpacked("features", DIABETES.features))
    return wide.select(*DIABETES_KEY, *_rounded(DIABETES.features))


@query
def preparation_stats(spark, sf_dir):
    """Statistics after imputation, out of one pass before it."""
    records = diabetes_records(spark, sf_dir)
    fitted = prepare.fit_preparation(records, DIABETES.features, DIABETES.zero_columns)
    rows = [(name, fitted.mean[name], fitted.std[name]) for name in fitted.features]
    stats = spark.createDataFrame(rows, "feature string, mean double, std double")
    return stats.select("feature", *_rounded(["mean", "std"], 8))


@query
def split_hash(spark, sf_dir):
    records = diabetes_records(spark, sf_dir)
    return records.select(*DIABETES_KEY, split.is_train(DIABETES_KEY).alias("train"))


@query
def split_sizes(spark, sf_dir):
    part = F.when(split.is_train(HEART_KEY), "train").otherwise("test")
    return heart_records(spark, sf_dir).groupBy(
        part.alias("part"), F.col(HEART.label).alias("label")
    ).agg(F.count(F.lit(1)).alias("n_rows"))


@query
def fold_assignment(spark, sf_dir):
    records = diabetes_records(spark, sf_dir)
    return records.select(*DIABETES_KEY, split.fold_of(DIABETES_KEY).alias("fold"))


# --- rule scores -----------------------------------------------------------


def _rule_scores(df: DataFrame, book: rules.RuleBook, key: Sequence[str], fields=None) -> DataFrame:
    scored = rules.with_rule_score(df, book, fields, "probability", "prediction")
    return scored.select(*key, "probability", "prediction")


@query
def score_rules_diabetes(spark, sf_dir):
    return _rule_scores(diabetes_records(spark, sf_dir), rules.DIABETES_RULES, DIABETES_KEY)


@query
def score_rules_diabetes_missing(spark, sf_dir):
    """Zeros taken as missing: an unreadable record gets the conservative estimate."""
    records = diabetes_records(spark, sf_dir).withColumns(
        {name: F.nullif(F.col(name), F.lit(0.0)) for name in ("glucose", "blood_pressure", "bmi")}
    )
    return _rule_scores(records, rules.DIABETES_RULES, DIABETES_KEY)


@query
def score_rules_heart(spark, sf_dir):
    records = jobs.encoded(heart_records(spark, sf_dir), HEART)
    return _rule_scores(records, rules.HEART_RULES, HEART_KEY)


# The record layout of the heart form; shorter than the layout the rules read.
_FORM_ORDER = (
    "age", "gender", "diabetes", "hypertension", "obesity", "smoking", "alcohol",
    "physical_activity", "diet_score", "cholesterol", "systolic_bp", "diastolic_bp",
    "stress", "family_history",
)


@query
def score_rules_heart_positional(spark, sf_dir):
    """Records as bare arrays in form order: later positions take the defaults."""
    records = jobs.encoded(heart_records(spark, sf_dir), HEART)
    values = F.array(*(F.col(name).cast("double") for name in _FORM_ORDER))
    bare = records.select(*HEART_KEY, values.alias("record"))
    fields = rules.positional_fields(rules.HEART_RULES, rules.HEART_POSITIONS, "record")
    return _rule_scores(bare, rules.HEART_RULES, HEART_KEY, fields)


@query
def default_profile(spark, sf_dir):
    records = jobs.encoded(heart_records(spark, sf_dir), HEART)
    fields = rules.named_fields(rules.HEART_RULES, records.columns)
    flag = rules.is_default_profile(rules.HEART_RULES, fields)
    return records.select(*HEART_KEY, flag.alias("is_default"))


@query
def feature_defaults(spark, sf_dir):
    """Defaults for null fields and for two fields the table does not have."""
    records = jobs.encoded(heart_records(spark, sf_dir), HEART).drop("stress", "hdl")
    fields = rules.named_fields(rules.HEART_RULES, records.columns, ("stress", "hdl"))
    return records.select(*HEART_KEY, *(F.expr(sql).alias(name) for name, sql in fields.items()))


def _contributions(df: DataFrame, book: rules.RuleBook, key: Sequence[str]) -> DataFrame:
    fields = rules.named_fields(book, df.columns)
    steps = (ladder.step(fields).alias(f"{ladder.column}_step") for ladder in book.ladders)
    return df.select(*key, *steps)


@query
def tier_contributions(spark, sf_dir):
    return _contributions(diabetes_records(spark, sf_dir), rules.DIABETES_RULES, DIABETES_KEY)


@query
def tier_contributions_heart(spark, sf_dir):
    records = jobs.encoded(heart_records(spark, sf_dir), HEART)
    return _contributions(records, rules.HEART_RULES, HEART_KEY)


# --- metrics ---------------------------------------------------------------


def _diabetes_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(candidate, score, label): the rule score against single measurements."""
    scored = rules.with_rule_score(diabetes_records(spark, sf_dir), rules.DIABETES_RULES)
    scores = {"rule_score": "rule_probability", "glucose": "glucose", "bmi": "bmi", "dpf": "dpf"}
    return ev.unpivot_scores(scored, scores, DIABETES.label)


def _heart_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = jobs.encoded(heart_records(spark, sf_dir), HEART)
    scored = rules.with_rule_score(records, rules.HEART_RULES)
    scores = {"rule_score": "rule_probability", "age": "age", "cholesterol": "cholesterol"}
    return ev.unpivot_scores(scored, scores, HEART.label)


def _auc_by_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    sides = [
        _diabetes_candidates(spark, sf_dir).withColumn("task", F.lit("diabetes")),
        _heart_candidates(spark, sf_dir).withColumn("task", F.lit("heart")),
    ]
    return ev.evaluate(sides[0].unionByName(sides[1]), group=("task", "candidate"))


@query
def auc_rank(spark, sf_dir):
    return _auc_by_candidate(spark, sf_dir).select(
        "task", "candidate", "n_rows", *_rounded(["auc"])
    )


@query
def auc_many_scores(spark, sf_dir):
    """Ranking by a price with almost as many distinct values as rows."""
    lineitem = table(spark, sf_dir, "lineitem")
    label = (F.col("l_quantity") >= 25).cast("int")
    scores = lineitem.select(
        F.lit("price").alias("candidate"), F.col("l_extendedprice").alias("score"), label.alias("label")
    )
    return ev.evaluate(scores).select("candidate", "n_rows", *_rounded(["auc"]))


@query
def auc_other_prediction(spark, sf_dir):
    """Predictions that no threshold on the score gives: ties are ties all the same."""
    scores = table(spark, sf_dir, "lineitem").select(
        F.lit("quantity").alias("candidate"),
        F.col("l_quantity").alias("score"),
        (F.col("l_extendedprice") >= 30_000).cast("int").alias("label"),
        (F.col("l_linenumber") % 2).cast("int").alias("prediction"),
    )
    report = ev.evaluate(scores, prediction="prediction")
    return report.select("candidate", "n_rows", *_rounded(["auc", *_RATIOS]))


@query
def accuracy(spark, sf_dir):
    scored = rules.with_rule_score(diabetes_records(spark, sf_dir), rules.DIABETES_RULES)
    return ev.classification_report(scored, (), "rule_prediction", DIABETES.label).select(
        (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("n_rows"),
        *_rounded(["accuracy"]),
    )


_RATIOS = ["accuracy", "precision", "recall", "f1"]


@query
def classification_report(spark, sf_dir):
    records = jobs.encoded(heart_records(spark, sf_dir), HEART)
    scored = rules.with_rule_score(records, rules.HEART_RULES)
    report = ev.classification_report(scored, ("gender",), "rule_prediction", HEART.label)
    return report.select("gender", "tp", "fp", "fn", "tn", *_rounded(_RATIOS))


@query
def rule_quality(spark, sf_dir):
    """The rule books as candidates."""
    diabetes = rules.with_rule_score(diabetes_records(spark, sf_dir), rules.DIABETES_RULES)
    records = jobs.encoded(heart_records(spark, sf_dir), HEART)
    heart = rules.with_rule_score(records, rules.HEART_RULES)
    sides = [
        scored.select(
            F.lit(task.name).alias("task"),
            F.col("rule_probability").alias("score"),
            F.col("rule_prediction").alias("prediction"),
            F.col(task.label).alias("label"),
        )
        for scored, task in ((diabetes, DIABETES), (heart, HEART))
    ]
    report = ev.evaluate(sides[0].unionByName(sides[1]), ("task",), prediction="prediction")
    return report.select("task", "n_rows", *_rounded(["auc", *_RATIOS]))


@query
def quality_gate(spark, sf_dir):
    gated = ev.with_gate(_auc_by_candidate(spark, sf_dir))
    return gated.select("task", "candidate", *_rounded(["auc"]), "gate")


def _best_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = _auc_by_candidate(spark, sf_dir).select(
        "task",
        F.col("candidate").alias("family"),
        "auc",
        # Both ways of naming a family, in a folder whose own name has a mark in it.
        F.concat(
            F.lit("mlruns/"), "task",
            F.when(F.col("task") == "heart", "_model_rf").otherwise("_logistic_regression"),
        ).alias("path"),
    )
    order = ("rule_score", "glucose", "bmi", "dpf", "age", "cholesterol")
    return registry.best(ranked, order)


@query
def registry_best(spark, sf_dir):
    return _best_candidates(spark, sf_dir).select("task", "family", "path", *_rounded(["auc"]))


@query
def registry_text_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "best_models")
    registry.write_lines(_best_candidates(spark, sf_dir), path)
    return registry.read_lines(spark, path)


# --- scoring chain and texts -----------------------------------------------


@query
def score_chain_rules_only(spark, sf_dir):
    """No model is registered, so the rule book answers every record."""
    folder = scratch_path(spark, "no_models")
    return jobs.score_table(heart_records(spark, sf_dir), "heart", HEART_KEY, folder)


@query
def score_result(spark, sf_dir):
    scored = score(diabetes_records(spark, sf_dir), "diabetes")
    return flat_result(scored, *DIABETES_KEY)


@query
def risk_report_diabetes(spark, sf_dir):
    scored = flat_result(score(diabetes_records(spark, sf_dir), "diabetes"), *DIABETES_KEY)
    return _report_columns(with_report(scored, "diabetes"), DIABETES_KEY)


@query
def risk_report_heart(spark, sf_dir):
    records = jobs.encoded(heart_records(spark, sf_dir), HEART)
    scored = flat_result(score(records, "heart"), *HEART_KEY)
    return _report_columns(with_report(scored, "heart"), HEART_KEY)


def _report_columns(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.select(*key, "prediction", "risk_band", "headline", "message", "recommendation")


# Stand-ins for fitted numbers, so that the formula can be checked by value.
_EXAMPLE_COEFFICIENTS = (0.1, 1.2, -0.15, 0.05, -0.1, 0.7, 0.3, 0.4)
_EXAMPLE_INTERCEPT = -0.85


@query
def lr_formula(spark, sf_dir):
    """Logistic regression written out over the standardised vector."""
    records = diabetes_records(spark, sf_dir)
    fitted = prepare.fit_preparation(records, DIABETES.features, DIABETES.zero_columns)
    scaled = PipelineModel(fitted.stages()).transform(records)
    wide = scaled.select(*DIABETES_KEY, *unpacked("features", DIABETES.features))
    margin = F.lit(_EXAMPLE_INTERCEPT)
    for name, weight in zip(DIABETES.features, _EXAMPLE_COEFFICIENTS):
        margin = margin + F.lit(weight) * F.col(name)
    probability = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
    return wide.select(*DIABETES_KEY, probability.alias("probability")).select(
        *DIABETES_KEY,
        *_rounded(["probability"]),
        at_threshold(F.col("probability")).alias("prediction"),
    )


@query
def stream_score(spark, sf_dir):
    """Every record through the streaming scorer, read back from its sink."""
    return score_available(
        spark,
        f"{sf_dir}/lineitem.parquet",
        table(spark, sf_dir, "lineitem").schema,
        diabetes_from,
        "diabetes",
        list(DIABETES_KEY),
        scratch_path(spark, "stream_sink"),
        scratch_path(spark, "stream_checkpoint"),
    ).select(*DIABETES_KEY, "prediction", "probability", "model_used", "risk_band")


@query
def stream_score_heart(spark, sf_dir):
    """Arriving orders meet the customer table inside the stream."""
    customer = table(spark, sf_dir, "customer")
    return score_available(
        spark,
        f"{sf_dir}/orders.parquet",
        table(spark, sf_dir, "orders").schema,
        lambda orders: jobs.encoded(heart_from(orders, customer), HEART),
        "heart",
        list(HEART_KEY),
        scratch_path(spark, "stream_sink"),
        scratch_path(spark, "stream_checkpoint"),
    ).select(*HEART_KEY, "prediction", "probability", "model_used", "risk_band")


# --- fitted models ---------------------------------------------------------

_TABLES = {"diabetes": (diabetes_records, DIABETES_KEY), "heart": (heart_records, HEART_KEY)}
# Training results per application, input and its version, so that queries over
# the same models do not train them again.
_trained: dict[tuple, tuple] = {}


def trained(spark: SparkSession, sf_dir: str):
    """(folder with models and registry, tuned models per task) for the tables."""
    versions = (
        tables.version(spark, f"{sf_dir}/{name}.parquet") for name in ("lineitem", "orders", "customer")
    )
    place = (spark.sparkContext.applicationId, sf_dir, *versions)
    if place not in _trained:
        folder = scratch_path(spark, "trained")
        inputs = {name: (read(spark, sf_dir), key) for name, (read, key) in _TABLES.items()}
        _trained[place] = (folder, jobs.train(inputs, folder))
    return _trained[place]


def _fit_once(spark: SparkSession, sf_dir: str, family: str) -> DataFrame:
    """One fit without tuning per task: its test rows, and whether its figures hold together."""
    boards = []
    for name, (read, key) in _TABLES.items():
        records = read(spark, sf_dir)
        task = jobs.with_features(TASKS[name], records, key)
        data = training_set(jobs.training_records(records, task, key), task, key)
        fitted = fit(data, family)
        data.release()
        board = jobs.leaderboard(data, [fitted], name)
        boards.append(
            board.select(
                "task", F.col("candidate").alias("family"), "n_rows", *_figure_checks(),
                (F.lit(fitted.seconds) > 0).alias("timed"),
            )
        )
    return boards[0].unionByName(boards[1])


def _figure_checks() -> list[Column]:
    """Better than chance, all shares between 0 and 1, and the gate that the AUC asks for."""
    shares = [F.col(name).between(0.0, 1.0) for name in ("auc", *_RATIOS)]
    gate = (
        F.when(F.col("auc") >= 0.8, "deployable").when(F.col("auc") >= 0.7, "acceptable")
        .otherwise("rejected")
    )
    return [
        (F.col("auc") > 0.5).alias("better_than_chance"),
        reduce(and_, shares).alias("in_range"),
        (F.col("gate") == gate).alias("gate_holds"),
    ]


@query
def train_lr(spark, sf_dir):
    return _fit_once(spark, sf_dir, LR)


@query
def train_rf(spark, sf_dir):
    return _fit_once(spark, sf_dir, RF)


@query
def fit_repeatable(spark, sf_dir):
    """Test records on which two forests differ, their inputs dealt to 1 and to 7 partitions."""
    records = heart_records(spark, sf_dir)
    task = jobs.with_features(HEART, records, HEART_KEY)
    scored = None
    for n in (1, 7):
        ready = jobs.training_records(records.repartition(n), task, HEART_KEY)
        data = training_set(ready, task, HEART_KEY)
        fitted = fit(data, RF, numTrees=10)
        data.release()
        scored = data.test if scored is None else scored
        scored = with_model_score(scored, ChosenModel(RF, fitted.pipeline), f"fit_{n}")
    differs = F.abs(F.col("fit_1_probability") - F.col("fit_7_probability")) > 1e-9
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(differs).alias("n_different")
    )


def _grids(spark: SparkSession, sf_dir: str, family: str) -> DataFrame:
    """The points tried per task, whether their AUC can be one, and whether the best of each
    task, and only that, was chosen."""
    _, models = trained(spark, sf_dir)
    grids = [
        grid_table(spark, fitted).select(F.lit(task).alias("task"), "*")
        for task, fits in models.items()
        for fitted in fits
        if fitted.family == family
    ]
    of_task = Window.partitionBy("task")  # the points of one grid
    best = F.col("mean_auc") == F.max("mean_auc").over(of_task)
    return grids[0].unionByName(grids[1]).select(
        *(name for name in grids[0].columns if name not in ("mean_auc", "chosen")),
        ((F.col("mean_auc") > 0.5) & (F.col("mean_auc") <= 1)).alias("auc_valid"),
        (~F.col("chosen") | best).alias("chosen_is_best"),
        F.sum(F.col("chosen").cast("bigint")).over(of_task).alias("n_chosen"),
    )


@query
def tune_lr(spark, sf_dir):
    return _grids(spark, sf_dir, LR)


@query
def tune_rf(spark, sf_dir):
    return _grids(spark, sf_dir, RF)


@query
def feature_weights(spark, sf_dir):
    """The features of every model; a forest's weights are shares of one."""
    _, models = trained(spark, sf_dir)
    parts = [
        feature_importance(spark, fitted).select(
            F.lit(task).alias("task"), F.lit(fitted.family).alias("family"), "feature", "weight"
        )
        for task, fits in models.items()
        for fitted in fits
    ]
    weights = reduce(DataFrame.unionByName, parts)
    total = F.sum("weight").over(Window.partitionBy("task", "family"))  # a row per feature
    share = F.when(F.col("family") == RF, F.col("weight") >= 0).otherwise(~F.isnan("weight"))
    return weights.select(
        "task", "family", "feature", share.alias("valid"),
        F.when(F.col("family") == RF, F.round(total, 6)).alias("sum_weights"),
    )


@query
def registry_rows(spark, sf_dir):
    folder, _ = trained(spark, sf_dir)
    rows = registry.read(spark, f"{folder}/registry")
    named = F.col("path").endswith(F.concat_ws("_", "task", "family"))
    return rows.select("task", "family", "complete", "dropped_rows", named.alias("path_names_it"))


@query
def model_leaderboard(spark, sf_dir):
    """The models of the last run: figures that hold together, one winner per task."""
    folder, _ = trained(spark, sf_dir)
    rows = registry.latest_run(registry.read(spark, f"{folder}/registry"))
    winners = registry.best(rows).select("task", "family", F.lit(True).alias("chosen"))
    board = rows.join(winners, ["task", "family"], "left")
    of_task = Window.partitionBy("task")  # a row per family
    best = F.col("auc") == F.max("auc").over(of_task)
    return board.select(
        "task", "family", *_figure_checks(),
        (F.col("chosen").isNull() | best).alias("chosen_is_best"),
        F.count("chosen").over(of_task).alias("n_chosen"),
    )


def _model(spark: SparkSession, sf_dir: str, task: str, family: str):
    folder, _ = trained(spark, sf_dir)
    rows = registry.latest_run(registry.read(spark, f"{folder}/registry"))
    path = rows.filter((F.col("task") == task) & (F.col("family") == family)).first()["path"]
    return load_model(path, family)


def _answer_checks(prediction: str, probability: str) -> list[Column]:
    """A share for every record, and the prediction on its side of one half."""
    p, y = F.col(probability), F.col(prediction)
    agrees = F.when(p > 0.5, y == 1).when(p < 0.5, y == 0).otherwise(y.isin(0, 1))
    return [
        F.coalesce(p.between(0.0, 1.0), F.lit(False)).alias("in_range"),
        F.coalesce(agrees, F.lit(False)).alias("agrees"),
    ]


@query
def score_lr(spark, sf_dir):
    """The loaded regression against its own coefficients, written out."""
    model = _model(spark, sf_dir, "diabetes", LR)
    scored = with_model_score(diabetes_records(spark, sf_dir), model)
    classifier = model.pipeline.stages[-1]
    wide = PipelineModel(model.pipeline.stages[:-2]).transform(scored)
    margin = F.lit(float(classifier.intercept))
    for name, weight in zip(model.features, classifier.coefficients.toArray()):
        margin = margin + F.lit(float(weight)) * F.col(f"{prepare.SCALED_PREFIX}{name}")
    by_hand = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
    return wide.select(
        *DIABETES_KEY,
        *_answer_checks("model_prediction", "model_probability"),
        (F.abs(by_hand - F.col("model_probability")) <= 1e-9).alias("as_by_hand"),
    )


@query
def score_rf(spark, sf_dir):
    model = _model(spark, sf_dir, "diabetes", RF)
    scored = with_model_score(diabetes_records(spark, sf_dir), model)
    return scored.select(*DIABETES_KEY, *_answer_checks("model_prediction", "model_probability"))


@query
def model_roundtrip(spark, sf_dir):
    """The same record scored by a model before saving and after loading, in one pass."""
    _, models = trained(spark, sf_dir)
    scored = diabetes_records(spark, sf_dir)
    differs = F.lit(False)
    for fitted in models["diabetes"]:
        path = scratch_path(spark, "model")
        save_model(fitted.pipeline, path)
        before, after = f"{fitted.family}_before", f"{fitted.family}_after"
        in_memory = ChosenModel(fitted.family, fitted.pipeline)
        scored = with_model_score(scored, in_memory, before)
        scored = with_model_score(scored, load_model(path, fitted.family), after)
        differs = differs | ~F.col(f"{before}_probability").eqNullSafe(F.col(f"{after}_probability"))
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(differs).alias("n_different")
    )


@query
def score_chain(spark, sf_dir):
    """Best registered model where a record is complete, else the rule book."""
    folder, _ = trained(spark, sf_dir)
    scored = jobs.score_table(heart_records(spark, sf_dir), "heart", HEART_KEY, folder)
    return scored.select(
        *HEART_KEY,
        *_answer_checks("prediction", "probability"),
        (F.col("model_used") != "rule_based").alias("by_model"),
    )


@query
def score_chain_coverage(spark, sf_dir):
    """Which part of the chain answered, and the rule book's answers in sum."""
    folder, _ = trained(spark, sf_dir)
    scored = jobs.score_table(heart_records(spark, sf_dir), "heart", HEART_KEY, folder)
    by_rules = F.col("model_used") == "rule_based"
    return scored.groupBy(by_rules.alias("by_rules")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.round(F.sum(F.when(by_rules, F.col("probability"))), 4).alias("sum_rule_answers"),
        F.round(F.sum("rule_based_probability"), 4).alias("sum_rule_scores"),
    )


@query
def stream_score_model(spark, sf_dir):
    """Records that the streaming scorer answers otherwise than the batch, with the
    registered model."""
    folder, _ = trained(spark, sf_dir)
    columns = [*DIABETES_KEY, "prediction", "probability", "model_used", "risk_band"]
    streamed = score_available(
        spark,
        f"{sf_dir}/lineitem.parquet",
        table(spark, sf_dir, "lineitem").schema,
        diabetes_from,
        "diabetes",
        list(DIABETES_KEY),
        scratch_path(spark, "stream_sink"),
        scratch_path(spark, "stream_checkpoint"),
        registry.resolve(spark, f"{folder}/registry", "diabetes"),
    ).select(columns)
    batch = jobs.score_table(diabetes_records(spark, sf_dir), "diabetes", DIABETES_KEY, folder)
    both = streamed.withColumn("side", F.lit(1)).unionByName(
        batch.select(columns).withColumn("side", F.lit(-1))
    )
    # Equal rows of both sides cancel out, repeated ones too.
    sums = both.groupBy(columns).agg(
        F.count_if(F.col("side") > 0).alias("streamed"), F.sum("side").alias("surplus")
    )
    return sums.agg(
        F.sum("streamed").alias("n_rows"), F.count_if(F.col("surplus") != 0).alias("n_different")
    )
