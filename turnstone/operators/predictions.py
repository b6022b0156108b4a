"""Prediction log operators: latest per key, cleanup count, joins, ranking,
keyed upsert and the risk-group sanity check (W1, K4, J1, J2, W4, K5, M22)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnstone.operators.scoring import risk_group


def latest_per_key(log: DataFrame, key: str = "EmployeeNumber",
                   ts: str = "prediction_timestamp", tiebreak: str | None = None) -> DataFrame:
    """Keep the newest row per key (ties: larger ``tiebreak``).

    Expressed as ``max(struct(ts, tiebreak, row))`` per key instead of
    ``row_number()`` over a key window: the max is partially aggregated
    map-side, so a key holding a third of the log never lands in one task
    as raw rows and nothing is sorted.
    """
    order = [ts] + ([tiebreak] if tiebreak else [])
    payload = [c for c in log.columns if c not in order and c != key]
    best = F.max(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in payload])).alias("_b")
    return log.groupBy(key).agg(best).select(key, *[F.col(f"_b.{c}").alias(c) for c in order + payload])


def duplicates_removed(log: DataFrame, key: str = "EmployeeNumber") -> DataFrame:
    """K4 report: rows a latest-per-key cleanup deletes (before − after)."""
    per_key = log.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum("n").cast("long").alias("rows_before"),
                       F.count(F.lit(1)).cast("long").alias("rows_after")).select(
        "rows_before", "rows_after", (F.col("rows_before") - F.col("rows_after")).alias("rows_removed"))


def superseded_rows(log: DataFrame, key: str = "EmployeeNumber", ts: str = "prediction_timestamp",
                    row_id: str = "event_id", tiebreak: str | None = None) -> DataFrame:
    """The rows a cleanup deletes, as an anti-join of the survivors."""
    keep = latest_per_key(log.select(key, ts, row_id, *([tiebreak] if tiebreak and tiebreak != row_id else [])),
                          key, ts, tiebreak).select(row_id)
    return log.join(keep, row_id, "left_anti")


def scored_left_join(emp: DataFrame, preds: DataFrame, key: str = "EmployeeNumber") -> DataFrame:
    """J1 after W1: every employee once, with its latest score or null.

    ``preds`` must already be one row per key (use ``latest_per_key``) so
    the join cannot fan out (the log may hold repeats).
    """
    return emp.join(preds, key, "left")


def department_risk_rank(scored: DataFrame, dept: str = "Department",
                         prob: str = "predicted_probability") -> DataFrame:
    """Rank (1 = riskiest, ties share a rank) within each department.

    Ranks are computed on (department, score, count) rows with a bucketed
    running count per department, then joined back on (department, score):
    neither a large department nor a repeated score becomes one task.
    """
    from turnstone.operators.prefix import running_totals
    levels = scored.groupBy(dept, prob).agg(F.count(F.lit(1)).alias("_n"))
    cum = running_totals(levels, prob, ["_n"], descending=True, group=[dept])
    ranks = cum.select(dept, prob, (F.col("cum__n") - F.col("_n") + 1).cast("long").alias("risk_rank"))
    return scored.join(ranks, [dept, prob], "left")


def display_positions(scored: DataFrame, dept: str = "Department", prob: str = "predicted_probability",
                      key: str = "EmployeeNumber") -> DataFrame:
    """1-based display position per department, riskiest first,
    ties by key. Position = rows with a strictly higher score (from the
    aggregated (department, score) counts) + rank by key among the tied rows
    (a bucketed running count per (department, score)). Neither a large
    department nor a heavily repeated score is ever one sorting task."""
    from turnstone.operators.prefix import running_totals
    levels = scored.groupBy(dept, prob).agg(F.count(F.lit(1)).alias("_n"))
    ahead = running_totals(levels, prob, ["_n"], descending=True, group=[dept]) \
        .select(dept, prob, (F.col("cum__n") - F.col("_n")).alias("_ahead"))
    within = running_totals(scored.withColumn("_one", F.lit(1)), key, ["_one"], group=[dept, prob])
    return within.join(ahead, [dept, prob]).withColumn(
        "position", (F.col("_ahead") + F.col("cum__one")).cast("long")).drop("_one", "cum__one", "_ahead")


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """K5: rows of ``new`` replace rows of ``old`` with the same key."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def model_sanity(emp: DataFrame, preds: DataFrame, key: str = "EmployeeNumber",
                 prob: str = "predicted_probability", hi: float = 0.75, lo: float = 0.25) -> DataFrame:
    """Per risk group its size, overtime share and mean income, plus the
    expected ordering (high-risk mean income below low-risk)."""
    j = scored_left_join(emp.select(key, "OverTime", "MonthlyIncome"), preds.select(key, prob), key)
    g = (j.withColumn("risk_group", risk_group(prob, hi, lo)).where(F.col("risk_group").isNotNull())
          .groupBy("risk_group").agg(
              F.count(F.lit(1)).alias("n"),
              (F.sum(F.when(F.col("OverTime") == "Yes", 1).otherwise(0)) / F.count(F.lit(1))).alias("overtime_share"),
              F.avg("MonthlyIncome").alias("mean_income")))
    w = Window.partitionBy()
    hi_inc = F.max(F.when(F.col("risk_group") == "high", F.col("mean_income"))).over(w)
    lo_inc = F.max(F.when(F.col("risk_group") == "low", F.col("mean_income"))).over(w)
    return g.withColumn("income_order_ok", hi_inc < lo_inc)
