"""Profiles, null handling and input validation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions.scalar import quoted
from riskflow.session import counting
from riskflow.sources.tables import write_parquet


def profile(df: DataFrame) -> DataFrame:
    """Rows, nulls and zeros of every column: one aggregate over one scan."""
    measures, entries = ["count(1) AS n_rows"], []
    for i, field in enumerate(df.schema.fields):
        name, zeros = quoted(field.name), "CAST(NULL AS BIGINT)"
        measures.append(f"count_if({name} IS NULL) AS null_{i}")
        if isinstance(field.dataType, T.NumericType):
            measures.append(f"count_if({name} = 0) AS zero_{i}")
            zeros = f"zero_{i}"
        kind = field.dataType.simpleString()
        text = field.name.replace("\\", "\\\\").replace("'", "\\'")
        entries.append(f"'{text}', '{kind}', n_rows, null_{i}, {zeros}")
    # The single result row fans out to one row per column, after the aggregate.
    return df.agg(*map(F.expr, measures)).selectExpr(
        f"stack({len(entries)}, {', '.join(entries)})"
        " AS (column_name, data_type, n_rows, n_null, n_zero)"
    )


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop the named columns; names that are not there are ignored."""
    return df.drop(*names)


def drop_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without any null or NaN in the given columns, by default all.

    One condition per column, unlike the single count of ``na.drop``: Parquet
    readers can skip by them, and the optimizer's work stays linear in the columns.
    """
    return df.filter(is_complete(df, columns or df.columns))


def is_complete(df: DataFrame, columns: Sequence[str]) -> Column:
    """Whether none of the columns is null or NaN."""
    kinds = {field.name: field.dataType for field in df.schema.fields}
    conditions = []
    for name in columns:
        column = F.col(quoted(name))
        conditions.append(column.isNotNull())
        if isinstance(kinds[name], (T.DoubleType, T.FloatType)):
            conditions.append(~F.isnan(column))
    return reduce(and_, conditions)


def numeric_features(df: DataFrame, exclude: Iterable[str]) -> list[str]:
    """Every column but the excluded ones, checked to be numeric before any job runs."""
    exclude = set(exclude)
    fields = [f for f in df.schema.fields if f.name not in exclude]
    wrong = [
        f.name for f in fields if not isinstance(f.dataType, (T.NumericType, T.BooleanType))
    ]
    if wrong:
        raise ValueError(f"not numeric, encode or drop first: {', '.join(wrong)}")
    return [f.name for f in fields]


@dataclass(frozen=True)
class Rule:
    """One input check. A null fails unless ``allow_null`` is set."""

    name: str
    column: str
    low: float | None = None
    high: float | None = None
    values: tuple[str | int, ...] = ()
    # an answer: 0 or 1 in a numeric column, Yes or No in a text column
    answer: bool = False
    # check only where this column has this value
    when: tuple[str, str] | None = None
    allow_null: bool = False

    @property
    def columns(self) -> set[str]:
        return {self.column} | ({self.when[0]} if self.when else set())

    def passes(self) -> Column:
        column = F.col(quoted(self.column))
        checks = []
        if self.answer:
            # Compared as text, so that neither kind of column fails the job by a cast.
            checks.append(column.cast("string").isin("0", "1", "Yes", "No"))
        if self.low is not None:
            checks.append(column >= F.lit(self.low))
        if self.high is not None:
            checks.append(column <= F.lit(self.high))
        if self.values:
            checks.append(column.isin(*self.values))
        passed = F.coalesce(reduce(and_, checks), F.lit(self.allow_null))
        if self.when:
            name, value = self.when
            passed = passed | ~F.coalesce(F.col(name) == F.lit(value), F.lit(False))
        return passed


def _answers(*names: str) -> tuple[Rule, ...]:
    return tuple(Rule(name, name, answer=True) for name in names)


# The documented ranges and choices of the input forms.
DIABETES_INPUT_RULES = (
    Rule("pregnancies", "pregnancies", 0, 20),
    Rule("glucose", "glucose", 0, 300),
    Rule("blood_pressure", "blood_pressure", 0, 200),
    Rule("skin_thickness", "skin_thickness", 0, 100),
    Rule("insulin", "insulin", 0, 900),
    Rule("bmi", "bmi", 0.0, 70.0),
    Rule("dpf", "dpf", 0.0, 3.0),
    Rule("age", "age", 0, 120),
)
HEART_INPUT_RULES = (
    Rule("age", "age", 20, 100),
    Rule("gender", "gender", values=("Female", "Male")),
    *_answers("diabetes", "hypertension", "obesity", "smoking", "alcohol", "physical_activity"),
    Rule("diet_score", "diet_score", 1, 10),
    Rule("stress", "stress", 1, 10),
    Rule("cholesterol", "cholesterol", 100, 400),
    Rule("systolic_bp", "systolic_bp", 80, 200),
    Rule("diastolic_bp", "diastolic_bp", 50, 150),
    *_answers("family_history"),
)
# Documented for male patients; needs a table that has both columns.
PREGNANCY_RULE = Rule("male_pregnancies", "pregnancies", 0, 0, when=("gender", "Male"))


def applicable(rules: Iterable[Rule], columns: Iterable[str]) -> list[Rule]:
    """The rules whose columns are all there."""
    present = set(columns)
    return [rule for rule in rules if rule.columns <= present]


def with_violations(df: DataFrame, rules: Sequence[Rule], column: str = "violations") -> DataFrame:
    """Add the names of the failed rules as an array, empty for a valid row."""
    failed = F.array(*(F.when(~rule.passes(), F.lit(rule.name)) for rule in rules))
    return df.withColumn(column, F.array_compact(failed))


def split_valid(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their violations)."""
    valid = reduce(and_, (rule.passes() for rule in rules))
    return df.filter(valid), with_violations(df.filter(~valid), rules)


@dataclass(frozen=True)
class Validated:
    """Both parts of a validated table, and counts: all rows, those rejected, failures by rule."""

    valid: DataFrame
    rejected: DataFrame
    n_rows: int
    n_rejected: int
    failures: dict[str, int]


def write_validated(df: DataFrame, rules: Sequence[Rule], path: str) -> Validated:
    """Valid and rejected rows, the latter with their ``violations``, from one read: one write parted
    by validity, counted along the way. The counts are there when the write is."""
    failures = (
        F.count_if(F.array_contains("violations", rule.name)).alias(f"rule_{i}")
        for i, rule in enumerate(rules)
    )
    marked = with_violations(df, rules).withColumn("valid", F.size("violations") == 0)
    counted, tally = counting(
        marked, F.count(F.lit(1)).alias("n_rows"), F.count_if(~F.col("valid")).alias("n_rejected"), *failures
    )
    write_parquet(counted, path, partition_by=["valid"])
    # By its own schema: a part without rows has no folder.
    stored = df.sparkSession.read.schema(marked.schema).parquet(path)
    found = tally.get()
    return Validated(
        valid=stored.filter("valid").drop("valid", "violations"),
        rejected=stored.filter("NOT valid").drop("valid"),
        n_rows=found["n_rows"],
        n_rejected=found["n_rejected"],
        failures={rule.name: found[f"rule_{i}"] for i, rule in enumerate(rules)},
    )


def violations_by_rule(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Failed rows per rule, counted in one aggregate without exploding the rows."""
    counts = df.agg(*(F.count_if(~rule.passes()).alias(rule.name) for rule in rules))
    entries = (
        F.struct(F.lit(rule.name).alias("rule"), F.col(rule.name).alias("n_failed"))
        for rule in rules
    )
    return counts.select(F.inline(F.array(*entries)))
