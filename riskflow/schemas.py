"""Column sets, declared schemas and input limits of the two tasks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _schema(columns: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_INT, _DOUBLE, _STRING = T.IntegerType(), T.DoubleType(), T.StringType()


@dataclass(frozen=True)
class Task:
    """What the pipeline has to know about one kind of record."""

    name: str
    subject: str
    label: str
    features: tuple[str, ...]
    zero_columns: tuple[str, ...] = ()
    drop_columns: tuple[str, ...] = ()
    gender_column: str | None = None
    yes_no_columns: tuple[str, ...] = ()
    # train on every column that is not key, label or dropped, not only on ``features``
    open_features: bool = False


# The published column lists of the two data sets, in order.
DIABETES = Task(
    name="diabetes",
    subject="diabetes",
    label="outcome",
    features=(
        "pregnancies", "glucose", "blood_pressure", "skin_thickness",
        "insulin", "bmi", "dpf", "age",
    ),
    zero_columns=("glucose", "blood_pressure", "skin_thickness", "insulin", "bmi"),
)
HEART = Task(
    name="heart",
    subject="heart attack risk",
    label="heart_attack_risk",
    features=(
        "age", "gender", "diabetes", "hypertension", "obesity", "smoking", "alcohol",
        "physical_activity", "diet_score", "cholesterol", "triglycerides", "ldl", "hdl",
        "systolic_bp", "diastolic_bp", "family_history", "stress",
    ),
    drop_columns=("patient_id", "state_name"),
    gender_column="gender",
    yes_no_columns=(
        "diabetes", "hypertension", "obesity", "smoking", "alcohol",
        "physical_activity", "family_history",
    ),
    open_features=True,
)
TASKS = {task.name: task for task in (DIABETES, HEART)}

# Header names of the public diabetes file and their columns here.
DIABETES_CSV_COLUMNS = {
    "Pregnancies": "pregnancies",
    "Glucose": "glucose",
    "BloodPressure": "blood_pressure",
    "SkinThickness": "skin_thickness",
    "Insulin": "insulin",
    "BMI": "bmi",
    "DiabetesPedigreeFunction": "dpf",
    "Age": "age",
    "Outcome": "outcome",
}
# Imputed columns hold means after the export, so they are doubles.
DIABETES_CSV_SCHEMA = _schema(
    {
        column: _DOUBLE if column in (*DIABETES.zero_columns, "dpf") else _INT
        for column in DIABETES_CSV_COLUMNS.values()
    }
)

DIABETES_SCHEMA = _schema(
    {
        "l_orderkey": T.LongType(),
        "l_partkey": T.LongType(),
        "l_suppkey": T.LongType(),
        "l_linenumber": _INT,
        "pregnancies": _INT,
        "glucose": _DOUBLE,
        "blood_pressure": _DOUBLE,
        "skin_thickness": _DOUBLE,
        "insulin": _DOUBLE,
        "bmi": _DOUBLE,
        "dpf": _DOUBLE,
        "age": _INT,
        "outcome": _INT,
    }
)
HEART_SCHEMA = _schema(
    {
        "patient_id": T.LongType(),
        "state_name": _STRING,
        "age": _INT,
        "gender": _STRING,
        "diabetes": _INT,
        "hypertension": _INT,
        "obesity": _INT,
        "smoking": _STRING,
        "alcohol": _STRING,
        "physical_activity": _INT,
        "diet_score": _INT,
        "cholesterol": _DOUBLE,
        "triglycerides": _DOUBLE,
        "ldl": _DOUBLE,
        "hdl": _DOUBLE,
        "systolic_bp": _DOUBLE,
        "diastolic_bp": _DOUBLE,
        "family_history": _INT,
        "stress": _INT,
        "heart_attack_risk": _INT,
    }
)
