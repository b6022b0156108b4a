"""Shared derived frames (and their SQL twins) used by several query plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstone.functions.exprs import round_half_up
from turnstone.operators.scoring import fixed_score
from turnstone.sources.tables import employees, table


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Proxy employees with the fixed score and a 0/1 label."""
    emp = employees(spark, sf)
    return fixed_score(emp).withColumn("label", (F.col("Attrition") == "Yes").cast("int"))


SCORED_SQL = """
scored AS (
  SELECT *, CAST(Attrition = 'Yes' AS INTEGER) AS label,
         floor(1.0::DOUBLE / (1.0::DOUBLE + exp(-(
            -6.0::DOUBLE
            + 2.5::DOUBLE * CAST(OverTime = 'Yes' AS DOUBLE)
            + 3.0::DOUBLE * CAST(JobLevel <= 3 AS DOUBLE)
            + 1.0::DOUBLE * CAST(JobLevel = 1 AS DOUBLE)
            + 0.25::DOUBLE * CAST(YearsSinceLastPromotion AS DOUBLE)
            + -0.5::DOUBLE * CAST(JobSatisfaction >= 3 AS DOUBLE)
            + 0.000004::DOUBLE * (250000.0::DOUBLE - CAST(MonthlyIncome AS DOUBLE))
         ))) * 1000000.0 + 0.5) / 1000000.0 AS predicted_probability
  FROM employees
)"""


def prediction_log(spark: SparkSession, sf: str) -> DataFrame:
    """The ``events`` table read as a prediction log with repeats per key."""
    ev = table(spark, sf, "events")
    return ev.select(
        F.col("user_id").alias("EmployeeNumber"),
        F.col("ts").alias("prediction_timestamp"),
        round_half_up(F.col("value") / (F.col("value") + 1.0), 6).alias("predicted_probability"),
        F.col("event_type").alias("prediction_label"),
        F.col("event_id"))


LOG_SQL = """
plog AS (
  SELECT user_id AS EmployeeNumber, ts AS prediction_timestamp,
         floor(value / (value + 1.0::DOUBLE) * 1000000.0 + 0.5) / 1000000.0 AS predicted_probability,
         event_type AS prediction_label, event_id
  FROM events
)"""
