"""Clinical record views over the star-schema tables.

The column expressions are plain SQL that other engines read too, so that the
views can be compared value by value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# (l_orderkey, l_linenumber) repeats, so a record is named by all four columns.
DIABETES_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
HEART_KEY = ("patient_id",)

DIABETES_COLUMNS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "CAST(l_linenumber AS INT) AS pregnancies",
    "CAST(CASE WHEN l_partkey % 150 = 0 THEN 0 ELSE l_quantity * 4 END AS DOUBLE) AS glucose",
    "CAST(CASE WHEN l_suppkey % 22 = 0 THEN 0 ELSE FLOOR(l_extendedprice / 700) END AS DOUBLE)"
    " AS blood_pressure",
    "CAST(CASE WHEN l_orderkey % 10 < 3 THEN 0 ELSE l_orderkey % 60 END AS DOUBLE)"
    " AS skin_thickness",
    "CAST(CASE WHEN l_partkey % 2 = 0 THEN 0 ELSE l_partkey % 300 END AS DOUBLE) AS insulin",
    "CAST(CASE WHEN l_suppkey % 70 = 0 THEN 0 ELSE 18 + (l_suppkey % 28) END AS DOUBLE) AS bmi",
    "CAST(l_discount AS DOUBLE) * CAST(10 AS DOUBLE) + CAST(l_tax AS DOUBLE) AS dpf",
    "CAST(21 + l_orderkey % 61 AS INT) AS age",
    "CASE WHEN l_quantity * 4 + (l_orderkey % 61) + (l_partkey % 97) > 220 THEN 1 ELSE 0 END"
    " AS outcome",
)
HEART_COLUMNS = (
    "o_orderkey AS patient_id",
    "c_mktsegment AS state_name",
    "CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE CAST(20 + o_orderkey % 80 AS INT) END AS age",
    "CASE WHEN o_custkey % 2 = 0 THEN 'Male' WHEN o_custkey % 53 = 1 THEN 'Other'"
    " ELSE 'Female' END AS gender",
    "CASE WHEN o_custkey % 3 = 0 THEN 1 ELSE 0 END AS diabetes",
    "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS hypertension",
    "CASE WHEN c_nationkey % 4 = 0 THEN 1 ELSE 0 END AS obesity",
    "CASE WHEN o_orderpriority = '1-URGENT' THEN 'Yes' ELSE 'No' END AS smoking",
    "CASE WHEN o_orderkey % 4 = 1 THEN 'Yes' ELSE 'No' END AS alcohol",
    "CASE WHEN o_custkey % 5 < 2 THEN 1 ELSE 0 END AS physical_activity",
    "CAST(1 + (o_orderkey + 4) % 10 AS INT) AS diet_score",
    "CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(FLOOR(150 + c_acctbal / 50) AS DOUBLE) END"
    " AS cholesterol",
    "CAST(80 + o_custkey % 200 AS DOUBLE) AS triglycerides",
    "CAST(60 + o_orderkey % 120 AS DOUBLE) AS ldl",
    "CAST(30 + o_custkey % 50 AS DOUBLE) AS hdl",
    "CAST(95 + o_orderkey % 90 AS DOUBLE) AS systolic_bp",
    "CAST(55 + o_custkey % 60 AS DOUBLE) AS diastolic_bp",
    "CASE WHEN o_custkey % 11 < 3 THEN 1 ELSE 0 END AS family_history",
    "CAST(1 + o_custkey % 10 AS INT) AS stress",
    "CASE WHEN (o_orderkey % 80) + (o_custkey % 2) * 15 + (o_orderkey * 7919) % 40 > 75"
    " THEN 1 ELSE 0 END AS heart_attack_risk",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def diabetes_from(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(*DIABETES_COLUMNS)


def heart_from(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Many-to-one join; AQE broadcasts a small customer side or splits a hot key."""
    return orders.join(customer, orders.o_custkey == customer.c_custkey).selectExpr(*HEART_COLUMNS)


def diabetes_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diabetes_from(table(spark, sf_dir, "lineitem"))


def heart_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heart_from(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"))
