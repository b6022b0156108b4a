"""Explanation queries on the fixed linear score."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnstone.operators import explain as ex
from turnstone.operators import features as fe
from turnstone.operators.scoring import FIXED_TERMS, fixed_terms
from turnstone.plans.feature_queries import CAT_DOMAINS, NUMERIC
from turnstone.plans.registry import on_employees, register
from turnstone.sources.tables import employees

COEFS = dict(FIXED_TERMS[1:])

_TERM_SQL = {
    "OverTime_Yes": "CAST(coalesce(OverTime = 'Yes', false) AS DOUBLE)",
    "JobLevel_le3": "CAST(coalesce(JobLevel <= 3, false) AS DOUBLE)",
    "JobLevel_eq1": "CAST(coalesce(JobLevel = 1, false) AS DOUBLE)",
    "YearsSinceLastPromotion": "CAST(YearsSinceLastPromotion AS DOUBLE)",
    "high_job_satisfaction": "CAST(coalesce(JobSatisfaction >= 3, false) AS DOUBLE)",
    "income_gap": "(250000.0::DOUBLE - CAST(MonthlyIncome AS DOUBLE))",
}


def _attr_sql():
    parts = []
    for pos, (name, coef) in enumerate(FIXED_TERMS[1:]):
        x = _TERM_SQL[name]
        parts.append(
            f"SELECT EmployeeNumber, {pos} AS position, '{name}' AS feature, "
            f"floor({coef}::DOUBLE * ({x} - (SELECT avg({x}) FROM employees)) * 1000000000.0 + 0.5) / 1000000000.0 AS shap "
            "FROM employees")
    return "attr AS (" + " UNION ALL ".join(parts) + ")"


ATTR_SQL = _attr_sql()


def attributed(spark, sf):
    emp = employees(spark, sf)
    return ex.linear_attributions(emp, fixed_terms(emp), COEFS, digits=9).select("EmployeeNumber", "attributions")


@register("linear_attribution", on_employees("SELECT EmployeeNumber, feature, shap FROM attr", ATTR_SQL),
          ops=("M14",))
def q_linear(spark, sf):
    a = attributed(spark, sf)
    return a.select("EmployeeNumber", F.explode("attributions").alias("x")).select(
        "EmployeeNumber", "x.feature", "x.shap")


@register("top_factors", on_employees("""
SELECT EmployeeNumber, CAST(rk AS INTEGER) AS rank, feature, shap FROM (
  SELECT *, row_number() OVER (PARTITION BY EmployeeNumber ORDER BY shap DESC, position) AS rk
  FROM attr WHERE shap > 0) t WHERE rk <= 5""", ATTR_SQL), ops=("O4",))
def q_top(spark, sf):
    a = attributed(spark, sf).withColumn("top", ex.top_factors(F.col("attributions"), 5))
    return ex.explode_ranked(a, "EmployeeNumber", "top").withColumn("rank", F.col("rank").cast("int"))


@register("actionable_factors", on_employees("""
SELECT EmployeeNumber, CAST(row_number() OVER (PARTITION BY EmployeeNumber ORDER BY rk) AS INTEGER) AS rank, feature, shap FROM (
  SELECT *, row_number() OVER (PARTITION BY EmployeeNumber ORDER BY shap DESC, position) AS rk
  FROM attr WHERE shap > 0) t
WHERE rk <= 5 AND split_part(feature, '_', 1) NOT IN ('Age', 'Gender', 'MaritalStatus', 'DistanceFromHome',
                                                      'NumCompaniesWorked', 'TotalWorkingYears')""", ATTR_SQL),
    ops=("M15",))
def q_actionable(spark, sf):
    a = attributed(spark, sf).withColumn("act", ex.actionable_factors(F.col("attributions"), 5))
    return ex.explode_ranked(a, "EmployeeNumber", "act").withColumn("rank", F.col("rank").cast("int"))


@register("abs_sorted_explanation", on_employees("""
SELECT EmployeeNumber, CAST(row_number() OVER (PARTITION BY EmployeeNumber ORDER BY abs(shap) DESC, position) AS INTEGER) AS rank,
       feature, shap FROM attr""", ATTR_SQL), ops=("O5",))
def q_abs(spark, sf):
    a = attributed(spark, sf).withColumn("srt", ex.abs_sorted(F.col("attributions")))
    return ex.explode_ranked(a, "EmployeeNumber", "srt").withColumn("rank", F.col("rank").cast("int"))


@register("global_importance", on_employees("""
SELECT feature, floor(avg(abs(shap)) * 1000000.0 + 0.5) / 1000000.0 AS mean_abs_shap FROM attr GROUP BY feature""",
    ATTR_SQL), ops=("A20",))
def q_global(spark, sf):
    from turnstone.functions.exprs import round_half_up
    g = ex.global_importance(attributed(spark, sf))
    return g.select("feature", round_half_up("mean_abs_shap", 6).alias("mean_abs_shap"))


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _label_sql():
    names = list(NUMERIC) + ["YearsPerCompany", "MonthlyIncome_log", "TotalWorkingYears_log",
                             "Income_Longevity_Interaction", "Stagnation_Index"]
    for col, dom in CAT_DOMAINS:
        names += [f"{col}_{v}" for v in sorted(dom)[1:]]
    rows = []
    for n in names:
        if n in ex.FEATURE_LABELS:
            lab = ex.FEATURE_LABELS[n]
        else:
            lab = None
            for base, m in ex.VALUE_LABELS.items():
                if n.startswith(base + "_"):
                    v = n[len(base) + 1:]
                    lab = f"{ex.FEATURE_LABELS.get(base, base)}: {m.get(v, v)}"
                    break
            if lab is None:
                lab = n.replace("_", " ")
        rows.append(f"({_sql_str(n)}, {_sql_str(lab)})")
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") t(feature, label)"


@register("label_translation", _label_sql(), ops=("J7",))
def q_labels(spark, sf):
    """Display labels for every feature of the catalogue fitted on the data."""
    emp = employees(spark, sf)
    vocab = fe.fit_vocabulary(fe.engineer(emp))
    return ex.translate(vocab.to_df(spark).select("feature"))
