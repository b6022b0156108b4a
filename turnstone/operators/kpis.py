"""Workforce KPIs (headcount, leavers, turnover rate, turnover cost, satisfaction).

Every KPI is one hash aggregate with map-side partial aggregation, so the
shuffle carries one row per group per task regardless of table size. Money is
summed in integer cents, so the cost figures are exact and their rounding does
not depend on float summation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstone.functions.exprs import round_half_up

# Job-level display names used by the satisfaction KPI.
LEVEL_NAMES = {1: "Júnior", 2: "Pleno", 3: "Sênior", 4: "Gerente", 5: "Diretor"}
LEVEL_OTHER = "Outro"


def _left(attr="Attrition"):
    return F.col(attr) == "Yes"


def _cents(income="MonthlyIncome"):
    return F.round(F.col(income) * 100).cast("bigint")


def _half_cents_to_money(total_cents):
    """50% of an integer amount of cents, rounded half-up to the cent."""
    return F.floor((total_cents + 1) / 2).cast("bigint") / F.lit(100.0)


def kpi_overall(emp: DataFrame, attrition: str = "Attrition") -> DataFrame:
    return emp.agg(
        F.count(F.lit(1)).alias("headcount"),
        F.sum(F.when(_left(attrition), 1).otherwise(0)).cast("bigint").alias("leavers"),
    ).select("headcount", "leavers",
             round_half_up(F.col("leavers") / F.col("headcount"), 4).alias("turnover_rate"))


def kpi_turnover_by_department(emp: DataFrame, dept: str = "Department",
                               attrition: str = "Attrition") -> DataFrame:
    g = emp.groupBy(dept).agg(
        F.count(F.lit(1)).alias("headcount"),
        F.sum(F.when(_left(attrition), 1).otherwise(0)).cast("bigint").alias("leavers"))
    return (g.withColumn("turnover_rate_pct",
                         round_half_up(F.col("leavers") * 100.0 / F.col("headcount"), 2))
             .orderBy(F.desc("turnover_rate_pct"), dept))


def kpi_turnover_cost(emp: DataFrame, dept: str = "Department", income: str = "MonthlyIncome",
                      attrition: str = "Attrition") -> DataFrame:
    g = emp.groupBy(dept).agg(
        F.sum(F.when(_left(attrition), 1).otherwise(0)).cast("bigint").alias("leavers"),
        F.sum(_cents(income)).alias("_cents"),
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.when(_left(attrition), _cents(income)).otherwise(0)).cast("bigint").alias("_leaver_cents"))
    return (g.select(
        dept, "leavers",
        round_half_up(F.col("_cents") / F.col("_n"), 0).alias("_avg_cents"),
        _half_cents_to_money(F.col("_leaver_cents")).alias("turnover_cost"))
        .select(dept, "leavers", (F.col("_avg_cents") / 100.0).alias("avg_monthly_income"),
                "turnover_cost")
        .orderBy(F.desc("turnover_cost"), dept))


def kpi_total_cost(emp: DataFrame, income: str = "MonthlyIncome",
                   attrition: str = "Attrition") -> DataFrame:
    return emp.agg(
        F.coalesce(F.sum(F.when(_left(attrition), _cents(income)).otherwise(0)), F.lit(0))
        .cast("bigint").alias("_c")
    ).select(_half_cents_to_money(F.col("_c")).alias("total_turnover_cost"))


def level_name(level) -> "F.Column":
    c = F.col(level) if isinstance(level, str) else level
    out = None
    for k, v in LEVEL_NAMES.items():
        out = F.when(c == k, v) if out is None else out.when(c == k, v)
    return out.otherwise(LEVEL_OTHER)


def kpi_satisfaction_by_level(emp: DataFrame, level: str = "JobLevel") -> DataFrame:
    g = emp.groupBy(level).agg(
        F.avg("JobSatisfaction").alias("_js"), F.avg("EnvironmentSatisfaction").alias("_es"))
    return g.select(level, level_name(level).alias("level_name"),
                    round_half_up(F.col("_js"), 2).alias("avg_job_satisfaction"),
                    round_half_up(F.col("_es"), 2).alias("avg_environment_satisfaction")
                    ).orderBy(level)
