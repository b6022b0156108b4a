"""Scores consumed by the evaluation, ranking and advice operators.

``fixed_score`` is a fixed-coefficient logistic score on the proxy view. It
stands in wherever a probability is consumed, so every downstream operator
has an exact oracle (a fitted model cannot have one).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstone.functions.exprs import flag, round_half_up, sigmoid

# Coefficients of the reference score (margin space).
FIXED_TERMS = [
    ("constant", -6.0),
    ("OverTime_Yes", 2.5),
    ("JobLevel_le3", 3.0),
    ("JobLevel_eq1", 1.0),
    ("YearsSinceLastPromotion", 0.25),
    ("high_job_satisfaction", -0.5),
    ("income_gap", 0.000004),
]


def fixed_terms(df: DataFrame) -> dict[str, Column]:
    """The score's inputs as columns (flags 1/0, income gap = 250000 − income)."""
    return {
        "OverTime_Yes": flag(F.col("OverTime") == "Yes").cast("double"),
        "JobLevel_le3": flag(F.col("JobLevel") <= 3).cast("double"),
        "JobLevel_eq1": flag(F.col("JobLevel") == 1).cast("double"),
        "YearsSinceLastPromotion": F.col("YearsSinceLastPromotion").cast("double"),
        "high_job_satisfaction": flag(F.col("JobSatisfaction") >= 3).cast("double"),
        "income_gap": F.lit(250000.0) - F.col("MonthlyIncome").cast("double"),
    }


def fixed_margin(df: DataFrame) -> Column:
    t = fixed_terms(df)
    z = F.lit(FIXED_TERMS[0][1])
    for name, coef in FIXED_TERMS[1:]:
        z = z + F.lit(coef) * t[name]
    return z


def fixed_score(df: DataFrame, col: str = "predicted_probability") -> DataFrame:
    """Adds ``col`` = round(σ(z), 6) of the fixed score."""
    return df.withColumn(col, round_half_up(sigmoid(fixed_margin(df)), 6))


def decision(df: DataFrame, threshold: float, prob: str = "predicted_probability",
             as_label: bool = True, col: str = "prediction_label") -> DataFrame:
    """``p >= t`` → Yes/No (or 1/0)."""
    hit = F.col(prob) >= F.lit(threshold)
    e = F.when(hit, "Yes").otherwise("No") if as_label else hit.cast("int")
    return df.withColumn(col, e)


def risk_band(prob: str = "predicted_probability",
              cuts=((0.75, "high"), (0.5, "elevated"), (0.25, "moderate")),
              lowest: str = "low") -> Column:
    """Named band from descending cut points (``p > cut``)."""
    p = F.col(prob)
    out = None
    for cut, name in cuts:
        out = F.when(p > cut, name) if out is None else out.when(p > cut, name)
    return out.when(p.isNotNull(), lowest)


def risk_group(prob: str = "predicted_probability", hi: float = 0.75, lo: float = 0.25) -> Column:
    """High above ``hi``, low below ``lo``, otherwise null (in neither)."""
    p = F.col(prob)
    return F.when(p > hi, "high").when(p < lo, "low")
