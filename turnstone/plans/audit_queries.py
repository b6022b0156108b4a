"""Profiling / audit queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnstone.functions.exprs import round_half_up
from turnstone.operators import features as fe
from turnstone.operators import model as md
from turnstone.operators import profile as pr
from turnstone.operators.advice import ui_flags
from turnstone.operators.scoring import decision, risk_band, risk_group
from turnstone.plans.common import SCORED_SQL, scored
from turnstone.plans.registry import on_employees, register
from turnstone.sources.tables import employees, table

# The 10-column UI projection.
UI_COLUMNS = ["EmployeeNumber", "Age", "Department", "JobRole", "Attrition", "MonthlyIncome",
              "JobSatisfaction", "OverTime", "high_job_satisfaction", "OverTime_Yes"]


@register("value_counts", on_employees(
    "SELECT Department, count(*) AS count FROM employees GROUP BY Department ORDER BY count DESC, Department"),
    ops=("A6",))
def q_value_counts(spark, sf):
    return pr.value_counts(employees(spark, sf), "Department")


@register("value_shares", on_employees(
    "SELECT OverTime, count(*) AS count, count(*) / sum(count(*)) OVER () AS share "
    "FROM employees GROUP BY OverTime"), ops=("A7", "W3"))
def q_value_shares(spark, sf):
    return pr.value_shares(employees(spark, sf), "OverTime")


_DESC_COLS = ["MonthlyIncome", "TotalWorkingYears", "YearsAtCompany", "JobSatisfaction"]


def _r9(c):
    return f"floor({c} * 1000000000.0 + 0.5) / 1000000000.0"


@register("describe_numeric", on_employees(" UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(count({c}) AS DOUBLE) AS count, {_r9(f'avg(CAST({c} AS DOUBLE))')} AS mean, "
    f"{_r9(f'stddev_samp(CAST({c} AS DOUBLE))')} AS std, CAST(min({c}) AS DOUBLE) AS min, "
    f"{_r9(f'quantile_cont(CAST({c} AS DOUBLE), 0.25)')} AS p25, {_r9(f'quantile_cont(CAST({c} AS DOUBLE), 0.5)')} AS p50, "
    f"{_r9(f'quantile_cont(CAST({c} AS DOUBLE), 0.75)')} AS p75, CAST(max({c}) AS DOUBLE) AS max FROM employees"
    for c in _DESC_COLS)), ops=("A8",))
def q_describe(spark, sf):
    d = pr.describe(employees(spark, sf), _DESC_COLS, exact=True)
    return d.select("column", "count", *[round_half_up(c, 9).alias(c) for c in ("mean", "std")], "min",
                    *[round_half_up(c, 9).alias(c) for c in ("p25", "p50", "p75")], "max")


@register("frame_profile", """
SELECT * FROM (VALUES
 (0, 'event_id', 'bigint'), (1, 'ts', 'timestamp_ntz'), (2, 'user_id', 'bigint'), (3, 'event_type', 'string'),
 (4, 'value', 'double'), (5, 'props', 'string')) t(position, "column", dtype)
JOIN (SELECT unnest([0,1,2,3,4,5]) AS position,
             unnest([count(event_id), count(ts), count(user_id), count(event_type), count(value), count(props)]) AS non_null,
             count(*) AS rows FROM events) c USING (position)""", ops=("A23",))
def q_frame_profile(spark, sf):
    p = pr.frame_profile(table(spark, sf, "events"))
    return p.select(F.col("position").cast("int"), "column", "dtype", "non_null", "rows")


@register("distinct_sorted", on_employees(
    "SELECT DISTINCT Department FROM employees ORDER BY Department"), ops=("A21",))
def q_distinct(spark, sf):
    return pr.distinct_sorted(employees(spark, sf), "Department")


@register("shape", on_employees("SELECT count(*) AS rows, 16 AS columns FROM employees"), ops=("A22",))
def q_shape(spark, sf):
    return pr.shape(employees(spark, sf)).select("rows", F.col("columns").cast("int"))


@register("dataset_equality", on_employees("""
SELECT true AS same_schema, (SELECT count(*) FROM employees) AS rows_a,
       (SELECT count(*) FROM employees WHERE JobLevel <> 5) AS rows_b,
       (SELECT count(*) FROM employees WHERE JobLevel = 5) AS only_in_a, CAST(0 AS BIGINT) AS only_in_b"""),
    ops=("U1", "A22"))
def q_dataset_equality(spark, sf):
    a = employees(spark, sf)
    b = employees(spark, sf).where(F.col("JobLevel") != 5)
    return pr.frame_equality(a, b)


@register("describe_equality", on_employees("""
SELECT c AS column, c <> 'JobLevel' AS identical FROM (VALUES ('MonthlyIncome'), ('JobLevel'), ('YearsAtCompany')) t(c)"""),
    ops=("U2", "A8"))
def q_describe_equality(spark, sf):
    a = employees(spark, sf)
    b = employees(spark, sf).withColumn("JobLevel", F.when(F.col("JobLevel") == 5, 4).otherwise(F.col("JobLevel")))
    return pr.describe_equality(a, b, ["MonthlyIncome", "JobLevel", "YearsAtCompany"])


@register("feature_diff", on_employees("""
SELECT 'Department_' || v AS feature, 'missing' AS status FROM f WHERE v NOT IN (SELECT v FROM p2)
UNION ALL
SELECT 'Department_' || v AS feature, 'extra' AS status FROM p2 WHERE v NOT IN (SELECT v FROM f)""",
    "lv AS (SELECT DISTINCT Department AS v FROM employees)",
    "f AS (SELECT v FROM lv WHERE v > (SELECT min(v) FROM lv))",
    "p AS (SELECT v FROM lv WHERE v <> 'BUILDING')",
    "p2 AS (SELECT v FROM p WHERE v > (SELECT min(v) FROM p))"), ops=("U3", "Q2"))
def q_feature_diff(spark, sf):
    """Catalogue fitted on all rows vs the columns produced when the frame
    lacks one category: the dropped-first-level trap shows as a missing name."""
    emp = employees(spark, sf)
    full = fe.fit_vocabulary(fe.engineer(emp)).to_df(spark)
    part = fe.one_hot(fe.engineer(emp.where(F.col("Department") != "BUILDING")))
    part_names = pr.schema_names(part.drop("EmployeeNumber"))
    return pr.name_diff(full, part_names)


@register("leakage_check", on_employees("""
SELECT CAST(15 + count(DISTINCT OverTime) - 1 + count(DISTINCT Department) - 1 + count(DISTINCT JobRole) - 1
            + count(DISTINCT BusinessTravel) - 1 AS BIGINT) AS n_features,
       CAST(0 AS BIGINT) AS n_forbidden, true AS matches_model
FROM employees"""), ops=("U5",))
def q_leakage(spark, sf):
    """The catalogue against the features that a model fitted on it takes."""
    frame, vocab = fe.feature_pipeline(employees(spark, sf))
    model = md.baseline_logistic(md.assemble(frame, vocab).select("features", "label"), max_iter=5)
    return pr.leakage_check(vocab.to_df(spark), n_model_features=model.numFeatures)


@register("ui_projection", on_employees("""
SELECT EmployeeNumber, Department, JobRole, CASE Attrition WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS Attrition,
       MonthlyIncome, JobSatisfaction, OverTime,
       CAST(coalesce(JobSatisfaction >= 3, false) AS INTEGER) AS high_job_satisfaction,
       CAST(coalesce(OverTime = 'Yes', false) AS INTEGER) AS OverTime_Yes
FROM employees"""), ops=("P2", "P3", "P4", "P15"))
def q_ui_projection(spark, sf):
    emp = employees(spark, sf)
    ui = ui_flags(emp).withColumn("Attrition", fe.recode("Attrition", {"Yes": 1, "No": 0}).cast("int")) \
        .withColumn("EmployeeNumber", F.col("EmployeeNumber").cast("long"))
    return fe.keep_existing(ui, UI_COLUMNS)


@register("risk_groups", on_employees("""
SELECT risk_group, count(*) AS n FROM (
  SELECT CASE WHEN predicted_probability > 0.75 THEN 'high' WHEN predicted_probability < 0.25 THEN 'low' END AS risk_group
  FROM scored) t WHERE risk_group IS NOT NULL GROUP BY risk_group""", SCORED_SQL), ops=("P16",))
def q_risk_groups(spark, sf):
    s = scored(spark, sf).withColumn("risk_group", risk_group())
    return s.where(F.col("risk_group").isNotNull()).groupBy("risk_group").agg(F.count(F.lit(1)).alias("n"))


@register("decision_label", on_employees("""
SELECT EmployeeNumber, predicted_probability, CASE WHEN predicted_probability >= 0.24 THEN 'Yes' ELSE 'No' END AS prediction_label,
       predicted_probability * 100 AS risk_percent
FROM scored""", SCORED_SQL), ops=("P22", "P19"))
def q_decision(spark, sf):
    s = decision(scored(spark, sf), 0.24)
    return s.select("EmployeeNumber", "predicted_probability", "prediction_label",
                    (F.col("predicted_probability") * 100).alias("risk_percent"))


@register("risk_band", on_employees("""
SELECT band, count(*) AS n FROM (
  SELECT CASE WHEN predicted_probability > 0.75 THEN 'high' WHEN predicted_probability > 0.5 THEN 'elevated'
              WHEN predicted_probability > 0.25 THEN 'moderate' WHEN predicted_probability IS NOT NULL THEN 'low' END AS band
  FROM scored) t GROUP BY band""", SCORED_SQL), ops=("P23",))
def q_risk_band(spark, sf):
    return scored(spark, sf).groupBy(risk_band().alias("band")).agg(F.count(F.lit(1)).alias("n"))


@register("employee_lookup", on_employees("""
SELECT EmployeeNumber, Department, JobRole, predicted_probability FROM scored
WHERE EmployeeNumber = (SELECT min(EmployeeNumber) FROM scored)""", SCORED_SQL), ops=("P17", "O8"))
def q_lookup(spark, sf):
    """The default row: the key is one number, so the lookup is a literal that reaches both scans."""
    first = table(spark, sf, "orders").agg(F.min("o_orderkey")).first()[0]
    return scored(spark, sf).where(F.col("EmployeeNumber") == F.lit(first)).select(
        "EmployeeNumber", "Department", "JobRole", "predicted_probability")



@register("top_risk_employees", on_employees("""
SELECT EmployeeNumber, Department, predicted_probability FROM scored
ORDER BY predicted_probability DESC, EmployeeNumber LIMIT 10""", SCORED_SQL), ops=("O3", "O2"))
def q_top_risk(spark, sf):
    """Top-10 report (the limit is the feature; Spark plans it as a bounded top-k)."""
    s = scored(spark, sf)
    return s.orderBy(F.desc("predicted_probability"), "EmployeeNumber").limit(10).select(
        "EmployeeNumber", "Department", "predicted_probability")


def _catalogue_sql():
    from turnstone.plans.feature_queries import CAT_DOMAINS, NUMERIC
    names = list(NUMERIC) + ["YearsPerCompany", "MonthlyIncome_log", "TotalWorkingYears_log",
                             "Income_Longevity_Interaction", "Stagnation_Index"]
    for col, dom in CAT_DOMAINS:
        names += [f"{col}_{v}" for v in sorted(dom)[1:]]
    rows = ", ".join("('" + n.replace("'", "''") + "')" for n in names)
    return f"SELECT feature FROM (VALUES {rows}) t(feature) ORDER BY feature"


@register("feature_catalogue", _catalogue_sql(), ops=("O9", "M21"))
def q_catalogue(spark, sf):
    """The fitted feature catalogue, sorted by name."""
    vocab = fe.fit_vocabulary(fe.engineer(employees(spark, sf)))
    return vocab.to_df(spark).select("feature").orderBy("feature")
