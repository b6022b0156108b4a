"""KPI queries over the proxy employee view."""

from __future__ import annotations

from turnstone.operators import kpis
from turnstone.plans.registry import on_employees, register
from turnstone.sources.tables import employees

_HALF = "CAST(floor((x + 1) / 2) AS BIGINT) / 100.0"


@register("kpi_overall", on_employees("""
SELECT headcount, leavers, floor(leavers / headcount * 10000.0 + 0.5) / 10000.0 AS turnover_rate
FROM (SELECT count(*) AS headcount,
             CAST(sum(CASE WHEN Attrition = 'Yes' THEN 1 ELSE 0 END) AS BIGINT) AS leavers
      FROM employees) t"""), ops=("A1",))
def q_kpi_overall(spark, sf):
    return kpis.kpi_overall(employees(spark, sf))


@register("kpi_turnover_by_department", on_employees("""
SELECT Department, headcount, leavers,
       floor(leavers * 100.0 / headcount * 100.0 + 0.5) / 100.0 AS turnover_rate_pct
FROM (SELECT Department, count(*) AS headcount,
             CAST(sum(CASE WHEN Attrition = 'Yes' THEN 1 ELSE 0 END) AS BIGINT) AS leavers
      FROM employees GROUP BY Department) t
ORDER BY turnover_rate_pct DESC, Department"""), ops=("A2", "O1"))
def q_kpi_dept(spark, sf):
    return kpis.kpi_turnover_by_department(employees(spark, sf))


@register("kpi_turnover_cost", on_employees("""
SELECT Department, leavers,
       floor(cents / n + 0.5) / 100.0 AS avg_monthly_income,
       CAST(floor((lc + 1) / 2) AS BIGINT) / 100.0 AS turnover_cost
FROM (SELECT Department,
             CAST(sum(CASE WHEN Attrition = 'Yes' THEN 1 ELSE 0 END) AS BIGINT) AS leavers,
             CAST(sum(CAST(round(MonthlyIncome * 100) AS BIGINT)) AS BIGINT) AS cents,
             count(*) AS n,
             CAST(sum(CASE WHEN Attrition = 'Yes' THEN CAST(round(MonthlyIncome * 100) AS BIGINT) ELSE 0 END) AS BIGINT) AS lc
      FROM employees GROUP BY Department) t
ORDER BY turnover_cost DESC, Department"""), ops=("A3", "O1"))
def q_kpi_cost(spark, sf):
    return kpis.kpi_turnover_cost(employees(spark, sf))


@register("kpi_total_cost", on_employees("""
SELECT CAST(floor((lc + 1) / 2) AS BIGINT) / 100.0 AS total_turnover_cost
FROM (SELECT CAST(coalesce(sum(CASE WHEN Attrition = 'Yes' THEN CAST(round(MonthlyIncome * 100) AS BIGINT) ELSE 0 END), 0) AS BIGINT) AS lc
      FROM employees) t"""), ops=("A4",))
def q_kpi_total(spark, sf):
    return kpis.kpi_total_cost(employees(spark, sf))


@register("kpi_satisfaction_by_level", on_employees("""
SELECT JobLevel,
       CASE JobLevel WHEN 1 THEN 'Júnior' WHEN 2 THEN 'Pleno' WHEN 3 THEN 'Sênior'
                     WHEN 4 THEN 'Gerente' WHEN 5 THEN 'Diretor' ELSE 'Outro' END AS level_name,
       floor(avg(JobSatisfaction) * 100.0 + 0.5) / 100.0 AS avg_job_satisfaction,
       floor(avg(EnvironmentSatisfaction) * 100.0 + 0.5) / 100.0 AS avg_environment_satisfaction
FROM employees GROUP BY JobLevel ORDER BY JobLevel"""), ops=("A5", "P24", "O1"))
def q_kpi_sat(spark, sf):
    return kpis.kpi_satisfaction_by_level(employees(spark, sf))
