"""Rule-based recommendations carrying measured causal effects (M16, K5 use).

The effect sizes are not constants: they are joined from the
``causal_insights`` table (factor → effect), which the causal operators
fill and ``predictions.upsert`` maintains. The table has one row per factor
(a handful); its two effects enter as scalar subqueries.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstone.functions.exprs import flag, round_half_up

OVERTIME = "overtime"
SATISFACTION = "high_job_satisfaction"

INSIGHTS_SCHEMA = ("factor string, effect double, unit string, analysis_date date, notes string")


def insights_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """``rows``: (factor, effect, unit, notes); analysis date is today."""
    today = date.today()
    return spark.createDataFrame([(f, float(e), u, today, n) for f, e, u, n in rows], INSIGHTS_SCHEMA)


def ui_flags(emp: DataFrame) -> DataFrame:
    """P3/P4 UI columns: leaver 1/0, high satisfaction flag, overtime flag."""
    return emp.withColumn("high_job_satisfaction", flag(F.col("JobSatisfaction") >= 3)) \
              .withColumn("OverTime_Yes", flag(F.col("OverTime") == "Yes"))


def _pct(effect):
    return F.format_string("%+.1f%%", round_half_up(effect * 100.0, 1))


def recommendations(emp: DataFrame, insights: DataFrame, key: str = "EmployeeNumber") -> DataFrame:
    """Per employee an ordered array of advice texts (empty when no rule fires)."""
    eff = insights.agg(F.max(F.when(F.col("factor") == OVERTIME, F.col("effect"))).alias("_eff_ot"),
                       F.max(F.when(F.col("factor") == SATISFACTION, F.col("effect"))).alias("_eff_js"))
    # two scalars from the (tiny) insights table, as scalar subqueries: no join
    e = ui_flags(emp).select("*", eff.select("_eff_ot").scalar().alias("_eff_ot"),
                             eff.select("_eff_js").scalar().alias("_eff_js"))
    ot = F.when(F.col("OverTime_Yes") == 1, F.concat(
        F.lit("Overtime (causal effect "), F.coalesce(_pct(F.col("_eff_ot")), F.lit("n/a")),
        F.lit("): review workload or offer time off in lieu.")))
    js = F.when(F.col("high_job_satisfaction") == 0, F.concat(
        F.lit("Low job satisfaction (causal effect "), F.coalesce(_pct(F.col("_eff_js")), F.lit("n/a")),
        F.lit("): talk through recognition, environment and career path.")))
    return e.select(key, F.array_compact(F.array(ot, js)).alias("recommendations"))
