"""Additive rule books as data, turned into SQL expressions.

A book becomes one SQL text that Spark parses once; building the same tree call
by call costs the driver hundreds of round trips.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# input name -> SQL expression of its value
Fields = Mapping[str, str]


def _number(value: float) -> str:
    return f"{float(value)!r}D"


def _holds(fields: Fields, column: str, op: str, bound: float) -> str:
    return f"{fields[column]} {op} {_number(bound)}"


@dataclass(frozen=True)
class Ladder:
    """Ordered tiers over one column; the first bound that matches gives the step."""

    column: str
    op: str
    tiers: tuple[tuple[float, float], ...]
    otherwise: float = 0.0
    # (column, op, bound) that must hold as well
    also: tuple[str, str, float] | None = None

    def step_sql(self, fields: Fields) -> str:
        extra = f" AND {_holds(fields, *self.also)}" if self.also else ""
        tiers = " ".join(
            f"WHEN {_holds(fields, self.column, self.op, bound)}{extra} THEN {_number(step)}"
            for bound, step in self.tiers
        )
        return f"CASE {tiers} ELSE {_number(self.otherwise)} END"

    def step(self, fields: Fields) -> Column:
        return F.expr(self.step_sql(fields))


@dataclass(frozen=True)
class RuleBook:
    name: str
    base: float
    ladders: tuple[Ladder, ...]
    # a record equal to these values is an untouched form
    default_profile: dict[str, float]
    # value of a missing field; a field without one makes the record unreadable
    defaults: dict[str, float]
    inputs: tuple[str, ...]
    conservative: float = 0.20
    low: float = 0.05
    high: float = 0.95
    threshold: float = 0.5


# The published tier tables. The order of the ladders is the order
# of addition, which decides the last bit of a sum near the 0.5 threshold.
DIABETES_RULES = RuleBook(
    name="diabetes",
    base=0.10,
    ladders=(
        Ladder(
            "glucose", "<=",
            ((90, 0.05), (110, 0.15), (125, 0.30), (140, 0.45), (160, 0.55), (180, 0.65)),
            otherwise=0.75,
        ),
        Ladder(
            "bmi", "<",
            ((18.5, 0.05), (25, 0.0), (30, 0.10), (35, 0.15), (40, 0.20)),
            otherwise=0.25,
        ),
        Ladder("age", "<", ((35, -0.05), (45, 0.0), (55, 0.10), (65, 0.15)), otherwise=0.20),
        Ladder("dpf", ">", ((0.8, 0.15), (0.5, 0.07))),
        Ladder("blood_pressure", ">", ((140, 0.10),)),
        Ladder("insulin", "<", ((15, 0.20),), also=("glucose", ">", 125)),
    ),
    default_profile={
        "pregnancies": 0, "glucose": 120, "blood_pressure": 70, "skin_thickness": 20,
        "insulin": 80, "bmi": 25.0, "dpf": 0.5, "age": 30,
    },
    defaults={},
    inputs=(
        "pregnancies", "glucose", "blood_pressure", "skin_thickness",
        "insulin", "bmi", "dpf", "age",
    ),
)
HEART_RULES = RuleBook(
    name="heart",
    base=0.15,
    ladders=(
        Ladder("age", "<", ((40, -0.05), (50, 0.05), (60, 0.15), (70, 0.25)), otherwise=0.30),
        Ladder("gender", "=", ((1, 0.10),)),
        Ladder("diabetes", "=", ((1, 0.15),)),
        Ladder("hypertension", "=", ((1, 0.15),)),
        Ladder("obesity", "=", ((1, 0.10),)),
        Ladder("smoking", "=", ((1, 0.20),)),
        Ladder("cholesterol", ">", ((240, 0.15), (200, 0.10))),
        Ladder("physical_activity", "=", ((1, -0.10),)),
        Ladder("stress", ">=", ((8, 0.15), (5, 0.05))),
        Ladder("family_history", "=", ((1, 0.15),)),
    ),
    default_profile={
        "age": 40, "gender": 0, "diabetes": 0, "hypertension": 0, "obesity": 0,
        "smoking": 0, "alcohol": 0, "physical_activity": 0, "diet_score": 5,
    },
    defaults={
        "age": 50, "gender": 0, "diabetes": 0, "hypertension": 0, "obesity": 0, "smoking": 0,
        "alcohol": 0, "physical_activity": 0, "diet_score": 5, "cholesterol": 200, "ldl": 100,
        "hdl": 50, "systolic_bp": 120, "diastolic_bp": 80, "family_history": 0, "stress": 5,
    },
    inputs=(
        "age", "gender", "diabetes", "hypertension", "obesity", "smoking", "alcohol",
        "physical_activity", "diet_score", "cholesterol", "ldl", "hdl",
        "systolic_bp", "diastolic_bp", "family_history", "stress",
    ),
)
# Position of each heart field in a positional record.
HEART_POSITIONS = {
    "age": 0, "gender": 1, "diabetes": 2, "hypertension": 3, "obesity": 4, "smoking": 5,
    "alcohol": 6, "physical_activity": 7, "diet_score": 8, "cholesterol": 9, "ldl": 11,
    "hdl": 12, "systolic_bp": 13, "diastolic_bp": 14, "family_history": 16, "stress": 17,
}
RULE_BOOKS = {book.name: book for book in (DIABETES_RULES, HEART_RULES)}


def _field(book: RuleBook, name: str, value: str) -> str:
    """The value as double, NaN as null, null as the book's default if it has one."""
    value = f"nanvl(CAST({value} AS DOUBLE), CAST(NULL AS DOUBLE))"
    if name in book.defaults:
        value = f"coalesce({value}, {_number(book.defaults[name])})"
    return value


def named_fields(
    book: RuleBook, available: Iterable[str], absent: Iterable[str] = ()
) -> dict[str, str]:
    """Inputs out of named columns. The fields in ``absent`` may lack a column and then count
    as null; any other field without one is an error."""
    available = set(available)
    missing = sorted(set(book.inputs) - available - set(absent))
    if missing:
        raise ValueError(f"the {book.name} rules need: {', '.join(missing)}")
    return {
        name: _field(book, name, f"`{name}`" if name in available else "NULL")
        for name in book.inputs
    }


def positional_fields(book: RuleBook, positions: Mapping[str, int], record: str) -> dict[str, str]:
    """The same inputs out of an array column whose trailing fields may be missing."""
    return {
        name: _field(book, name, f"try_element_at(`{record}`, {positions[name] + 1})")
        for name in book.inputs
    }


def _default_profile_sql(book: RuleBook, fields: Fields) -> str:
    same = " AND ".join(_holds(fields, name, "=", v) for name, v in book.default_profile.items())
    return f"coalesce({same}, false)"


def is_default_profile(book: RuleBook, fields: Fields) -> Column:
    return F.expr(_default_profile_sql(book, fields))


def _conservative_sql(book: RuleBook, fields: Fields) -> str:
    """A field without a default is null, or the form was left untouched."""
    unreadable = (f"{fields[name]} IS NULL" for name in book.inputs if name not in book.defaults)
    return " OR ".join([*unreadable, _default_profile_sql(book, fields)])


def _score_sql(book: RuleBook, fields: Fields) -> str:
    """Left-to-right sum in doubles; Spark keeps the order of floating additions."""
    return " + ".join([_number(book.base), *(ladder.step_sql(fields) for ladder in book.ladders)])


def rule_probability(book: RuleBook, fields: Fields) -> Column:
    clamped = (
        f"greatest({_number(book.low)}, least({_number(book.high)}, {_score_sql(book, fields)}))"
    )
    return F.expr(
        f"CASE WHEN {_conservative_sql(book, fields)} THEN {_number(book.conservative)}"
        f" ELSE {clamped} END"
    )


def with_rule_score(
    df: DataFrame,
    book: RuleBook,
    fields: Fields | None = None,
    probability: str = "rule_probability",
    prediction: str = "rule_prediction",
    absent: Iterable[str] = (),
) -> DataFrame:
    """Add the rule score of every row; the row's own columns stay as they are.

    ``absent`` names inputs that the table may lack."""
    fields = fields or named_fields(book, df.columns, absent)
    readable = {name: f"__fields.`{name}`" for name in fields}
    values = ", ".join(f"'{name}', {value}" for name, value in fields.items())
    return (
        df.withColumn("__fields", F.expr(f"named_struct({values})"))
        .withColumn(probability, rule_probability(book, readable))
        .withColumn(prediction, F.expr(f"CAST(`{probability}` >= {_number(book.threshold)} AS INT)"))
        .drop("__fields")
    )
