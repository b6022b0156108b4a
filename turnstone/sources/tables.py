"""Scans of the driver tables and the proxy ``employees`` view built from them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One employee per order: ``orders ⋈ customer ⋈ nation ⟕ lines-per-order``.

    Line items are reduced to one row per order *before* the join (partial
    aggregation happens map-side, so a hot order key never ships its raw
    lines). The reduced side and ``orders`` are both keyed by the order key;
    the customer join is a sort-merge join that AQE can split when one
    customer is hot; ``nation`` is a 25-row dimension and is broadcast.
    """
    li = table(spark, sf_dir, "lineitem")
    lines = (li.groupBy("l_orderkey").agg(
        F.sum(F.round(F.col("l_discount") * 100).cast("bigint")).alias("disc_pts"),
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("l_quantity").cast("bigint").alias("qty"),
        F.countDistinct("l_suppkey").alias("n_supp"),
        F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).cast("bigint").alias("n_ret"),
    ))
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))

    joined = (o.join(c, o.o_custkey == c.c_custkey)
               .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
               .join(lines, o.o_orderkey == lines.l_orderkey, "left"))

    level = F.substring("o_orderpriority", 1, 1).cast("int")
    n_lines = F.coalesce(F.col("n_lines"), F.lit(0))
    overtime = F.when(F.coalesce(F.col("disc_pts"), F.lit(0))
                      >= 5 * F.coalesce(F.col("n_lines"), F.lit(1)), "Yes").otherwise("No")
    emp = joined.select(
        F.col("o_orderkey").alias("EmployeeNumber"),
        level.alias("JobLevel"),
        overtime.alias("OverTime"),
        F.col("c_mktsegment").alias("Department"),
        F.col("n_name").alias("JobRole"),
        F.col("o_orderpriority").alias("BusinessTravel"),
        F.col("o_totalprice").alias("MonthlyIncome"),
        (1 + F.col("o_custkey") % 4).cast("int").alias("JobSatisfaction"),
        (1 + n_lines % 4).cast("int").alias("EnvironmentSatisfaction"),
        F.when(F.col("c_acctbal") >= 5000, "Male").otherwise("Female").alias("Gender"),
        F.coalesce(F.col("qty"), F.lit(0)).cast("bigint").alias("TotalWorkingYears"),
        F.coalesce(F.col("n_supp"), F.lit(0)).cast("bigint").alias("NumCompaniesWorked"),
        n_lines.cast("bigint").alias("YearsAtCompany"),
        (2001 - F.year("o_orderdate")).cast("int").alias("YearsSinceLastPromotion"),
        F.coalesce(F.col("n_ret"), F.lit(0)).cast("bigint").alias("YearsWithCurrManager"),
        F.col("o_orderstatus"),
    )
    attrition = F.when((F.col("o_orderstatus") == "F") & (
        (F.col("JobLevel") == 1) | ((F.col("JobLevel") <= 3) & (F.col("OverTime") == "Yes"))),
        "Yes").otherwise("No")
    return emp.withColumn("Attrition", attrition).drop("o_orderstatus")


# DuckDB text of the same view, used by the oracle side of every check.
EMPLOYEES_SQL = """
employees AS (
  SELECT o.o_orderkey AS EmployeeNumber,
         CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS JobLevel,
         CASE WHEN coalesce(l.disc_pts, 0) >= 5 * coalesce(l.n_lines, 1) THEN 'Yes' ELSE 'No' END AS OverTime,
         c.c_mktsegment AS Department,
         n.n_name AS JobRole,
         o.o_orderpriority AS BusinessTravel,
         o.o_totalprice AS MonthlyIncome,
         CAST(1 + o.o_custkey % 4 AS INTEGER) AS JobSatisfaction,
         CAST(1 + coalesce(l.n_lines, 0) % 4 AS INTEGER) AS EnvironmentSatisfaction,
         CASE WHEN c.c_acctbal >= 5000 THEN 'Male' ELSE 'Female' END AS Gender,
         CAST(coalesce(l.qty, 0) AS BIGINT) AS TotalWorkingYears,
         CAST(coalesce(l.n_supp, 0) AS BIGINT) AS NumCompaniesWorked,
         CAST(coalesce(l.n_lines, 0) AS BIGINT) AS YearsAtCompany,
         CAST(2001 - year(o.o_orderdate) AS INTEGER) AS YearsSinceLastPromotion,
         CAST(coalesce(l.n_ret, 0) AS BIGINT) AS YearsWithCurrManager,
         CASE WHEN o.o_orderstatus = 'F' AND (CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) = 1
                OR (CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) <= 3
                    AND coalesce(l.disc_pts, 0) >= 5 * coalesce(l.n_lines, 1)))
              THEN 'Yes' ELSE 'No' END AS Attrition
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN (
    SELECT l_orderkey,
           CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS BIGINT) AS disc_pts,
           count(*) AS n_lines,
           CAST(sum(l_quantity) AS BIGINT) AS qty,
           count(DISTINCT l_suppkey) AS n_supp,
           CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS n_ret
    FROM lineitem GROUP BY l_orderkey
  ) l ON o.o_orderkey = l.l_orderkey
)"""
