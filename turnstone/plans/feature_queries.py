"""Feature-pipeline queries (P1–P14, M21, M1/M8) over the proxy employee view."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnstone.operators import features as fe
from turnstone.operators import levels as lv
from turnstone.operators import split
from turnstone.plans.registry import on_employees, register
from turnstone.sources.tables import employees, table

# Category domains of the driver tables, used only to spell out
# the oracle SQL (the Spark side fits them from data).
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
NATIONS = [f"NATION_{i}" for i in range(25)]
YES_NO = ["No", "Yes"]

CAT_DOMAINS = [("OverTime", YES_NO), ("Department", SEGMENTS), ("JobRole", NATIONS),
               ("BusinessTravel", PRIORITIES)]

NUMERIC = ["JobLevel", "MonthlyIncome", "JobSatisfaction", "EnvironmentSatisfaction", "Gender",
           "TotalWorkingYears", "NumCompaniesWorked", "YearsAtCompany", "YearsSinceLastPromotion",
           "YearsWithCurrManager"]

ENGINEERED_SQL = """
engineered AS (
  SELECT EmployeeNumber,
         CASE WHEN Attrition = 'Yes' THEN 1 WHEN Attrition = 'No' THEN 0 END AS label,
         JobLevel, OverTime, Department, JobRole, BusinessTravel, MonthlyIncome, JobSatisfaction,
         EnvironmentSatisfaction,
         CASE WHEN Gender = 'Male' THEN 1 WHEN Gender = 'Female' THEN 0 END AS Gender,
         TotalWorkingYears, NumCompaniesWorked, YearsAtCompany, YearsSinceLastPromotion,
         YearsWithCurrManager,
         CAST(TotalWorkingYears AS DOUBLE) / CAST(CASE WHEN NumCompaniesWorked = 0 THEN 1 ELSE NumCompaniesWorked END AS DOUBLE) AS YearsPerCompany,
         ln(1 + CAST(MonthlyIncome AS DOUBLE)) AS MonthlyIncome_log,
         ln(1 + CAST(TotalWorkingYears AS DOUBLE)) AS TotalWorkingYears_log,
         CAST(MonthlyIncome AS DOUBLE) * CAST(YearsAtCompany AS DOUBLE) AS Income_Longevity_Interaction,
         CAST(YearsSinceLastPromotion AS DOUBLE) / CAST(CASE WHEN YearsWithCurrManager = 0 THEN 1 ELSE YearsWithCurrManager END AS DOUBLE) AS Stagnation_Index
  FROM employees
)"""

DERIVED = ["YearsPerCompany", "MonthlyIncome_log", "TotalWorkingYears_log",
           "Income_Longevity_Interaction", "Stagnation_Index"]
LOGS = ["MonthlyIncome_log", "TotalWorkingYears_log"]


def _q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _dummy_sql() -> list[str]:
    out = []
    for col, dom in CAT_DOMAINS:
        for v in sorted(dom)[1:]:
            out.append(f"CASE WHEN {col} = '{v}' THEN 1.0 ELSE 0.0 END::DOUBLE AS {_q(col + '_' + v)}")
    return out


def _round9(c: str) -> str:
    return f"floor({c} * 1000000000.0 + 0.5) / 1000000000.0 AS {c}"


def _logs_rounded(df):
    # log1p (JVM) and ln(1+x) (C library) may differ in the last ulp; the
    # checked projection shows them at 1e-9.
    from turnstone.functions.exprs import round_half_up
    return df.select(*[round_half_up(c, 9).alias(c) if c in LOGS else F.col(c) for c in df.columns])


@register("features_engineered", on_employees(
    "SELECT EmployeeNumber, JobLevel, OverTime, Department, JobRole, BusinessTravel, MonthlyIncome, "
    "JobSatisfaction, EnvironmentSatisfaction, Gender, TotalWorkingYears, NumCompaniesWorked, "
    "YearsAtCompany, YearsSinceLastPromotion, YearsWithCurrManager, YearsPerCompany, "
    + ", ".join(_round9(c) for c in LOGS) + ", Income_Longevity_Interaction, Stagnation_Index "
    "FROM engineered", ENGINEERED_SQL), ops=("P1", "P3", "P5", "P6", "P7", "P9", "P21"))
def q_features_engineered(spark, sf):
    return _logs_rounded(fe.engineer(employees(spark, sf)))


@register("features_onehot", on_employees(
    "SELECT EmployeeNumber, " + ", ".join(_dummy_sql()) + " FROM employees"),
    ops=("P10", "P11", "M21"))
def q_features_onehot(spark, sf):
    emp = employees(spark, sf)
    return fe.one_hot(emp.select("EmployeeNumber", "OverTime", "Department", "JobRole",
                                 "BusinessTravel"))


_TEST_PRED = ("CAST('0x' || substr(md5(CAST(EmployeeNumber AS VARCHAR) || '|42'), 1, 15) AS BIGINT)"
              " % 10000 < 2000")


@register("features_aligned", on_employees(
    "SELECT EmployeeNumber, label, "
    + ", ".join([f"CAST({c} AS DOUBLE) AS {c}" for c in NUMERIC]
                + [f"CAST({c} AS DOUBLE) AS {c}" if c not in LOGS
                   else f"floor({c} * 1000000000.0 + 0.5) / 1000000000.0 AS {c}" for c in DERIVED]
                + _dummy_sql())
    + f" FROM engineered WHERE {_TEST_PRED}", ENGINEERED_SQL),
    ops=("P10", "P11", "P12", "M21", "M1"))
def q_features_aligned(spark, sf):
    """Vocabulary fitted on the train part, applied to the test part."""
    emp = split.hash_split(employees(spark, sf))
    train = emp.where(~F.col("is_test")).drop("is_test")
    test = emp.where(F.col("is_test")).drop("is_test")
    _, vocab = fe.feature_pipeline(train)
    aligned, _ = fe.feature_pipeline(test, vocab)
    return _logs_rounded(aligned)


@register("features_sparse", """
WITH lv AS (
  SELECT 1 AS c, CAST(o_custkey AS VARCHAR) AS v FROM orders UNION SELECT 2, o_orderstatus FROM orders UNION SELECT 3, o_orderpriority FROM orders),
r AS (SELECT c, v, row_number() OVER (PARTITION BY c ORDER BY v) AS k FROM lv WHERE v IS NOT NULL),
p AS (SELECT c, v, row_number() OVER (ORDER BY c, v) AS at FROM r WHERE k > 1)
SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS price,
       concat_ws(',', CASE WHEN o_totalprice <> 0 THEN 0 END, p1.at, p2.at, p3.at) AS positions,
       CAST(1 + (SELECT count(*) FROM p) AS INTEGER) AS n_positions
FROM orders
LEFT JOIN p p1 ON p1.c = 1 AND p1.v = CAST(o_custkey AS VARCHAR)
LEFT JOIN p p2 ON p2.c = 2 AND p2.v = o_orderstatus
LEFT JOIN p p3 ON p3.c = 3 AND p3.v = o_orderpriority""", ops=("P10", "P12", "M21"))
def q_features_sparse(spark, sf):
    """Customers, states and priorities as levels of a table; positions of the row's sparse vector."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("double").alias("o_totalprice"), F.col("o_custkey").cast("string").alias("o_custkey"),
        "o_orderstatus", "o_orderpriority")
    d = lv.fit_levels(orders, exclude=("o_orderkey",))
    rows = lv.encode_arrays(orders, d, keep=("o_orderkey", "o_totalprice"))
    return rows.select("o_orderkey", F.col("o_totalprice").alias("price"), F.array_join(F.col("indices").cast("array<string>"), ",").alias("positions"),
                       F.lit(d.size).alias("n_positions"))


@register("features_rounded_ratio", on_employees("""
SELECT EmployeeNumber,
       floor(CASE WHEN NumCompaniesWorked > 0 THEN CAST(TotalWorkingYears AS DOUBLE) / NumCompaniesWorked
                  ELSE CAST(TotalWorkingYears AS DOUBLE) END * 10000.0 + 0.5) / 10000.0 AS YearsPerCompany
FROM employees"""), ops=("P8", "P25"))
def q_features_rounded_ratio(spark, sf):
    emp = employees(spark, sf).select("EmployeeNumber", "TotalWorkingYears", "NumCompaniesWorked")
    return fe.rounded_ratio(emp).select("EmployeeNumber", "YearsPerCompany")


@register("columns_normalised", on_employees("""
SELECT EmployeeNumber AS employeenumber, JobRole AS jobrole, BusinessTravel AS businesstravel,
       CAST(JobLevel AS DOUBLE) AS "job_level_code", CAST(Gender = 'Male' AS INTEGER) AS "is_male"
FROM employees"""), ops=("P13", "P15"))
def q_columns_normalised(spark, sf):
    emp = employees(spark, sf)
    df = emp.select("EmployeeNumber", "JobRole", "BusinessTravel",
                    F.col("JobLevel").cast("double").alias("Job Level-Code"),
                    (F.col("Gender") == "Male").cast("int").alias("Is-Male"))
    return fe.normalise_names(df)


@register("features_scaled", on_employees("""
SELECT EmployeeNumber,
""" + ",\n".join(
    f"floor(CASE WHEN s_{c} = 0 THEN 0.0 ELSE (CAST({c} AS DOUBLE) - m_{c}) / s_{c} END * 1000000.0 + 0.5) / 1000000.0 AS {c}"
    for c in ["MonthlyIncome", "JobSatisfaction", "TotalWorkingYears", "YearsAtCompany",
              "YearsSinceLastPromotion", "JobLevel"]) + """
FROM employees, (SELECT """ + ", ".join(
    f"avg(CAST({c} AS DOUBLE)) AS m_{c}, stddev_pop(CAST({c} AS DOUBLE)) AS s_{c}"
    for c in ["MonthlyIncome", "JobSatisfaction", "TotalWorkingYears", "YearsAtCompany",
              "YearsSinceLastPromotion", "JobLevel"]) + " FROM employees) st"), ops=("P14",))
def q_features_scaled(spark, sf):
    from turnstone.functions.exprs import round_half_up
    cols = ["MonthlyIncome", "JobSatisfaction", "TotalWorkingYears", "YearsAtCompany",
            "YearsSinceLastPromotion", "JobLevel"]
    emp = employees(spark, sf).select("EmployeeNumber", *cols)
    z = fe.standardise(emp, cols)
    return z.select("EmployeeNumber", *[round_half_up(c, 6).alias(c) for c in cols])


@register("stratified_split", on_employees(f"""
SELECT label, CAST({_TEST_PRED} AS BOOLEAN) AS is_test, count(*) AS n
FROM engineered GROUP BY 1, 2""", ENGINEERED_SQL), ops=("M1",))
def q_stratified_split(spark, sf):
    emp = fe.engineer(employees(spark, sf), label="Attrition")
    return split.hash_split(emp).groupBy("label", "is_test").agg(F.count(F.lit(1)).alias("n"))


@register("stratified_split_exact", on_employees("""
SELECT label, is_test, count(*) AS n FROM (
  SELECT label, row_number() OVER (PARTITION BY label ORDER BY h, EmployeeNumber)
                <= round(count(*) OVER (PARTITION BY label) * 0.2) AS is_test
  FROM (SELECT label, EmployeeNumber,
               CAST('0x' || substr(md5(CAST(EmployeeNumber AS VARCHAR) || '|42'), 1, 15) AS BIGINT) AS h
        FROM engineered) a) b
GROUP BY 1, 2""", ENGINEERED_SQL), ops=("M1",))
def q_stratified_split_exact(spark, sf):
    emp = fe.engineer(employees(spark, sf), label="Attrition").select("EmployeeNumber", "label")
    return (split.stratified_split(emp, exact=True)
            .groupBy("label", "is_test").agg(F.count(F.lit(1)).alias("n")))


@register("stratified_folds", on_employees("""
SELECT label, CAST(CAST('0x' || substr(md5(CAST(EmployeeNumber AS VARCHAR) || '|7961'), 1, 15) AS BIGINT) % 5 AS INTEGER) AS fold,
       count(*) AS n
FROM engineered GROUP BY 1, 2""", ENGINEERED_SQL), ops=("M8",))
def q_stratified_folds(spark, sf):
    emp = fe.engineer(employees(spark, sf), label="Attrition")
    return split.fold_column(emp).groupBy("label", "fold").agg(F.count(F.lit(1)).alias("n"))
