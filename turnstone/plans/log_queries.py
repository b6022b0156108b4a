"""Prediction-log queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnstone.functions.exprs import round_half_up
from turnstone.operators import advice
from turnstone.operators import predictions as pl
from turnstone.plans.common import LOG_SQL, SCORED_SQL, prediction_log, scored
from turnstone.plans.registry import on_employees, register, with_ctes
from turnstone.sources.tables import employees, table


@register("latest_prediction", with_ctes(LOG_SQL, body="""
SELECT EmployeeNumber, prediction_timestamp, event_id, predicted_probability, prediction_label FROM (
  SELECT *, row_number() OVER (PARTITION BY EmployeeNumber ORDER BY prediction_timestamp DESC, event_id DESC) AS rn
  FROM plog) t WHERE rn = 1"""), ops=("W1", "K4"))
def q_latest(spark, sf):
    return pl.latest_per_key(prediction_log(spark, sf), tiebreak="event_id")


@register("duplicates_removed_count", with_ctes(LOG_SQL, body="""
SELECT count(*) AS rows_before, count(DISTINCT EmployeeNumber) AS rows_after,
       count(*) - count(DISTINCT EmployeeNumber) AS rows_removed FROM plog"""), ops=("K4",))
def q_dups(spark, sf):
    return pl.duplicates_removed(prediction_log(spark, sf))


@register("superseded_rows", with_ctes(LOG_SQL, body="""
SELECT EmployeeNumber, prediction_timestamp, predicted_probability, prediction_label, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY EmployeeNumber ORDER BY prediction_timestamp DESC, event_id DESC) AS rn
  FROM plog) t WHERE rn > 1"""), ops=("J2", "K4"))
def q_superseded(spark, sf):
    return pl.superseded_rows(prediction_log(spark, sf), tiebreak="event_id")


@register("scored_left_join", with_ctes(LOG_SQL, body="""
SELECT c.c_custkey AS EmployeeNumber, c.c_mktsegment AS Department, l.predicted_probability, l.prediction_label
FROM customer c LEFT JOIN (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY EmployeeNumber ORDER BY prediction_timestamp DESC, event_id DESC) AS rn
                 FROM plog) t WHERE rn = 1) l
ON c.c_custkey = l.EmployeeNumber"""), ops=("J1", "W1", "Q13"))
def q_left_join(spark, sf):
    cust = table(spark, sf, "customer").select(F.col("c_custkey").alias("EmployeeNumber"),
                                               F.col("c_mktsegment").alias("Department"))
    latest = pl.latest_per_key(prediction_log(spark, sf), tiebreak="event_id")
    return pl.scored_left_join(cust, latest.select("EmployeeNumber", "predicted_probability", "prediction_label"))


@register("department_risk_rank", on_employees("""
SELECT EmployeeNumber, Department, predicted_probability,
       CAST(rank() OVER (PARTITION BY Department ORDER BY predicted_probability DESC) AS BIGINT) AS risk_rank,
       JobRole || ' (ID: ' || CAST(EmployeeNumber AS VARCHAR) || ')' AS option_text,
       predicted_probability * 100 AS risk_percent
FROM scored""", SCORED_SQL), ops=("W4", "O2", "P19", "P27"))
def q_dept_rank(spark, sf):
    s = scored(spark, sf).select("EmployeeNumber", "Department", "JobRole", "predicted_probability")
    r = pl.department_risk_rank(s)
    return r.select("EmployeeNumber", "Department", "predicted_probability", "risk_rank",
                    F.format_string("%s (ID: %d)", F.col("JobRole"), F.col("EmployeeNumber")).alias("option_text"),
                    (F.col("predicted_probability") * 100).alias("risk_percent"))


_NAIVE_SQL = """
naive AS (
  SELECT 'overtime' AS factor,
         floor((avg(CASE WHEN OverTime = 'Yes' THEN CAST(Attrition = 'Yes' AS INTEGER) END)
               - avg(CASE WHEN OverTime = 'No' THEN CAST(Attrition = 'Yes' AS INTEGER) END)) * 1000000.0 + 0.5) / 1000000.0 AS effect
  FROM employees
  UNION ALL
  SELECT 'high_job_satisfaction' AS factor,
         floor((avg(CASE WHEN JobSatisfaction >= 3 THEN CAST(Attrition = 'Yes' AS INTEGER) END)
               - avg(CASE WHEN JobSatisfaction < 3 THEN CAST(Attrition = 'Yes' AS INTEGER) END)) * 1000000.0 + 0.5) / 1000000.0 AS effect
  FROM employees
)"""


def naive_effects(emp, where=None):
    """Difference in leave rate, treated − control, per factor (rounded to 1e-6)."""
    if where is not None:
        emp = emp.where(where)
    left = (F.col("Attrition") == "Yes").cast("int")

    def diff(t):
        return round_half_up(F.avg(F.when(t, left)) - F.avg(F.when(~t, left)), 6)
    return emp.agg(diff(F.col("OverTime") == "Yes").alias("overtime"),
                   diff(F.col("JobSatisfaction") >= 3).alias("high_job_satisfaction")).selectExpr(
        "stack(2, 'overtime', overtime, 'high_job_satisfaction', high_job_satisfaction) AS (factor, effect)")


@register("upsert_insights", on_employees("""
SELECT factor, effect, 'share of employees' AS unit, notes FROM (
  SELECT factor, effect, 'naive, all levels' AS notes FROM naive WHERE factor <> 'overtime'
  UNION ALL
  SELECT 'overtime' AS factor,
         floor((avg(CASE WHEN OverTime = 'Yes' THEN CAST(Attrition = 'Yes' AS INTEGER) END)
               - avg(CASE WHEN OverTime = 'No' THEN CAST(Attrition = 'Yes' AS INTEGER) END)) * 1000000.0 + 0.5) / 1000000.0,
         'naive, levels 1-3' FROM employees WHERE JobLevel <= 3) t""", _NAIVE_SQL), ops=("K5", "J3"))
def q_upsert(spark, sf):
    emp = employees(spark, sf)
    unit = F.lit("share of employees").alias("unit")
    old = naive_effects(emp).select("factor", "effect", unit, F.lit("naive, all levels").alias("notes"))
    new = naive_effects(emp, F.col("JobLevel") <= 3).where(F.col("factor") == "overtime") \
        .select("factor", "effect", unit, F.lit("naive, levels 1-3").alias("notes"))
    return pl.upsert(old, new, "factor")


@register("recommendations", on_employees("""
SELECT EmployeeNumber, pos, txt AS recommendation FROM (
  SELECT EmployeeNumber, unnest(generate_series(1, len(recs))) AS pos, unnest(recs) AS txt FROM (
    SELECT EmployeeNumber, list_filter([
      CASE WHEN OverTime = 'Yes' THEN 'Overtime (causal effect ' || printf('%+.1f%%', floor(ot * 100.0 * 10.0 + 0.5) / 10.0)
           || '): review workload or offer time off in lieu.' END,
      CASE WHEN NOT coalesce(JobSatisfaction >= 3, false) THEN 'Low job satisfaction (causal effect '
           || printf('%+.1f%%', floor(js * 100.0 * 10.0 + 0.5) / 10.0)
           || '): talk through recognition, environment and career path.' END], lambda x: x IS NOT NULL) AS recs
    FROM employees,
         (SELECT max(CASE WHEN factor = 'overtime' THEN effect END) AS ot,
                 max(CASE WHEN factor = 'high_job_satisfaction' THEN effect END) AS js FROM naive) e) a) b""",
    _NAIVE_SQL), ops=("M16", "K5"))
def q_recommendations(spark, sf):
    emp = employees(spark, sf)
    ins = naive_effects(emp)
    recs = advice.recommendations(emp, ins)
    return recs.select("EmployeeNumber", F.posexplode("recommendations").alias("pos", "recommendation")) \
        .select("EmployeeNumber", (F.col("pos") + 1).cast("bigint").alias("pos"), "recommendation")


@register("model_sanity", on_employees("""
SELECT risk_group, count(*) AS n, sum(CASE WHEN OverTime = 'Yes' THEN 1 ELSE 0 END) / count(*) AS overtime_share,
       floor(avg(MonthlyIncome) * 1000000.0 + 0.5) / 1000000.0 AS mean_income,
       (SELECT avg(MonthlyIncome) FROM scored WHERE predicted_probability > 0.75)
         < (SELECT avg(MonthlyIncome) FROM scored WHERE predicted_probability < 0.25) AS income_order_ok
FROM (SELECT *, CASE WHEN predicted_probability > 0.75 THEN 'high' WHEN predicted_probability < 0.25 THEN 'low' END AS risk_group
      FROM scored) t
WHERE risk_group IS NOT NULL GROUP BY risk_group""", SCORED_SQL), ops=("M22", "J1", "P16", "A7", "A9"))
def q_sanity(spark, sf):
    s = scored(spark, sf)
    emp = employees(spark, sf)
    out = pl.model_sanity(emp, s.select("EmployeeNumber", "predicted_probability"))
    return out.withColumn("mean_income", round_half_up("mean_income", 6))


@register("display_ranking", on_employees("""
SELECT Department, EmployeeNumber AS id, JobRole AS role, predicted_probability * 100 AS risk_percent,
       CAST(row_number() OVER (PARTITION BY Department ORDER BY predicted_probability DESC, EmployeeNumber) AS BIGINT) AS position
FROM scored""", SCORED_SQL), ops=("P27", "O2", "W4", "P19"))
def q_display(spark, sf):
    """Per department the team table, riskiest first: id, role, risk in percent
    and the display position (ties by id). Ranks come from the bucketed
    running count, so a large department is not one sorting task."""
    s = scored(spark, sf).select("EmployeeNumber", "Department", "JobRole", "predicted_probability")
    pos = pl.display_positions(s)
    return pos.select("Department", F.col("EmployeeNumber").alias("id"), F.col("JobRole").alias("role"),
                      (F.col("predicted_probability") * 100).alias("risk_percent"), "position")
