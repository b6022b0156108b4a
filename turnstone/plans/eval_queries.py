"""Evaluation queries on the fixed score (A10–A18, M11, O6, O7, A19 folds)."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnstone.functions.exprs import round_half_up
from turnstone.operators import metrics as me
from turnstone.plans.common import SCORED_SQL, scored
from turnstone.plans.registry import on_employees, register

THRESHOLD = 0.24

GRID_SQL = "grid AS (SELECT i, 0.01::DOUBLE + i * 0.01::DOUBLE AS threshold FROM range(0, 99) t(i))"

SWEEP_SQL = """
sweep AS (
  SELECT g.threshold,
         CAST(sum(CASE WHEN s.label = 1 AND s.predicted_probability >= g.threshold THEN 1 ELSE 0 END) AS BIGINT) AS tp,
         CAST(sum(CASE WHEN s.label = 0 AND s.predicted_probability >= g.threshold THEN 1 ELSE 0 END) AS BIGINT) AS fp,
         CAST(sum(CASE WHEN s.label = 1 AND s.predicted_probability < g.threshold THEN 1 ELSE 0 END) AS BIGINT) AS fn
  FROM grid g, scored s GROUP BY g.threshold
),
sweep2 AS (
  SELECT threshold, tp, fp, fn,
         CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
         CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall
  FROM sweep
),
sweep3 AS (
  SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1_score
  FROM sweep2
)"""


def _sc(spark, sf):
    return scored(spark, sf).select("EmployeeNumber", "label", "predicted_probability")


@register("class_balance", on_employees("""
SELECT CAST(sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS BIGINT) AS negatives,
       CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS positives,
       sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) / sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS scale_pos_weight
FROM scored""", SCORED_SQL), ops=("A10", "M4"))
def q_balance(spark, sf):
    return me.class_balance(_sc(spark, sf))


@register("confusion_matrix", on_employees(f"""
SELECT label AS actual,
       CAST(sum(CASE WHEN predicted_probability < {THRESHOLD} THEN 1 ELSE 0 END) AS BIGINT) AS predicted_0,
       CAST(sum(CASE WHEN predicted_probability >= {THRESHOLD} THEN 1 ELSE 0 END) AS BIGINT) AS predicted_1
FROM scored GROUP BY label""", SCORED_SQL), ops=("A11",))
def q_confusion(spark, sf):
    return me.confusion_matrix(me.with_prediction(_sc(spark, sf), THRESHOLD))


@register("binary_metrics", on_employees(f"""
SELECT tp, fp, fn, tn, precision, recall,
       CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1_score
FROM (SELECT tp, fp, fn, tn,
             CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
             CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall
      FROM (SELECT CAST(sum(CASE WHEN label = 1 AND p >= {THRESHOLD} THEN 1 ELSE 0 END) AS BIGINT) AS tp,
                   CAST(sum(CASE WHEN label = 0 AND p >= {THRESHOLD} THEN 1 ELSE 0 END) AS BIGINT) AS fp,
                   CAST(sum(CASE WHEN label = 1 AND p < {THRESHOLD} THEN 1 ELSE 0 END) AS BIGINT) AS fn,
                   CAST(sum(CASE WHEN label = 0 AND p < {THRESHOLD} THEN 1 ELSE 0 END) AS BIGINT) AS tn
            FROM (SELECT label, predicted_probability AS p FROM scored) x) a) b""", SCORED_SQL), ops=("A13",))
def q_binary(spark, sf):
    return me.binary_metrics(me.with_prediction(_sc(spark, sf), THRESHOLD))


@register("class_report", on_employees(f"""
SELECT * FROM (
  SELECT '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1_score, s0 AS support FROM m
  UNION ALL SELECT '1', p1, r1, f1, s1 FROM m
  UNION ALL SELECT 'accuracy', NULL, NULL, acc, s0 + s1 FROM m
  UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s0 + s1 FROM m
  UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / (s0 + s1), (r0 * s0 + r1 * s1) / (s0 + s1),
                   (f0 * s0 + f1 * s1) / (s0 + s1), s0 + s1 FROM m) t""", SCORED_SQL, f"""
c AS (SELECT CAST(sum(CASE WHEN label = 1 AND p >= {THRESHOLD} THEN 1 ELSE 0 END) AS BIGINT) AS tp,
             CAST(sum(CASE WHEN label = 0 AND p >= {THRESHOLD} THEN 1 ELSE 0 END) AS BIGINT) AS fp,
             CAST(sum(CASE WHEN label = 1 AND p < {THRESHOLD} THEN 1 ELSE 0 END) AS BIGINT) AS fn,
             CAST(sum(CASE WHEN label = 0 AND p < {THRESHOLD} THEN 1 ELSE 0 END) AS BIGINT) AS tn
      FROM (SELECT label, predicted_probability AS p FROM scored) x)""", """
b AS (SELECT CASE WHEN tn + fn = 0 THEN 0.0 ELSE tn / (tn + fn) END AS p0,
             CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn / (tn + fp) END AS r0, tn + fp AS s0,
             CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS p1,
             CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS r1, tp + fn AS s1,
             (tp + tn) / (tp + tn + fp + fn) AS acc FROM c)""", """
m AS (SELECT *, CASE WHEN p0 + r0 = 0 THEN 0.0 ELSE 2 * p0 * r0 / (p0 + r0) END AS f0,
                CASE WHEN p1 + r1 = 0 THEN 0.0 ELSE 2 * p1 * r1 / (p1 + r1) END AS f1 FROM b)"""), ops=("A12",))
def q_report(spark, sf):
    return me.class_report(me.with_prediction(_sc(spark, sf), THRESHOLD))


@register("threshold_sweep", on_employees(
    "SELECT threshold, tp, fp, fn, precision, recall, f1_score FROM sweep3 ORDER BY threshold",
    SCORED_SQL, GRID_SQL, SWEEP_SQL), ops=("A14", "A13"))
def q_sweep(spark, sf):
    return me.threshold_sweep(_sc(spark, sf))


@register("best_threshold", on_employees("""
SELECT threshold, precision, recall, f1_score, constrained FROM (
  SELECT *, true AS constrained, 1 AS pri FROM (
    SELECT * FROM sweep3 WHERE precision >= 0.6 ORDER BY f1_score DESC, threshold LIMIT 1) a
  UNION ALL
  SELECT *, false AS constrained, 2 AS pri FROM (SELECT * FROM sweep3 ORDER BY f1_score DESC, threshold LIMIT 1) b
) t ORDER BY pri LIMIT 1""", SCORED_SQL, GRID_SQL, SWEEP_SQL), ops=("M11", "O7"))
def q_best(spark, sf):
    return me.best_threshold(me.threshold_sweep(_sc(spark, sf)), 0.60)


@register("goal_threshold", on_employees("""
SELECT threshold, tp, fp, fn, precision, recall, f1_score FROM sweep3
WHERE precision >= 0.3 AND recall >= 0.3 AND f1_score >= 0.3 ORDER BY f1_score DESC, threshold LIMIT 1""",
    SCORED_SQL, GRID_SQL, SWEEP_SQL), ops=("O6", "P18"))
def q_goal(spark, sf):
    return me.goal_threshold(me.threshold_sweep(_sc(spark, sf)), 0.30)


_CURVE_SQL = """
sc AS (SELECT predicted_probability AS score,
              CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
              CAST(sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS BIGINT) AS neg
       FROM scored GROUP BY predicted_probability),
cum AS (SELECT score, pos, neg,
               sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
               sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp,
               sum(pos) OVER () AS P, sum(neg) OVER () AS N
        FROM sc)"""


@register("roc_curve", on_employees("""
SELECT threshold, fpr, tpr FROM (
  SELECT 'Infinity'::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
  UNION ALL
  SELECT score, fp / N, tp / P FROM (
    SELECT *, lag(tp) OVER (ORDER BY score DESC) AS tp0, lead(tp) OVER (ORDER BY score DESC) AS tp2,
              lag(fp) OVER (ORDER BY score DESC) AS fp0, lead(fp) OVER (ORDER BY score DESC) AS fp2
    FROM cum) c
  WHERE tp0 IS NULL OR tp2 IS NULL OR (tp0 - 2 * tp + tp2) <> 0 OR (fp0 - 2 * fp + fp2) <> 0) t""",
    SCORED_SQL, _CURVE_SQL), ops=("A15", "W2"))
def q_roc(spark, sf):
    return me.roc_curve(_sc(spark, sf))


@register("roc_auc", on_employees("""
SELECT floor(sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) * 1000000000.0 + 0.5) / 1000000000.0 AS roc_auc FROM (
  SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM sc) t""", SCORED_SQL, _CURVE_SQL), ops=("A16",))
def q_auc(spark, sf):
    return me.roc_auc(_sc(spark, sf)).select(round_half_up("roc_auc", 9).alias("roc_auc"))


@register("pr_curve", on_employees("""
SELECT score AS threshold, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
       CASE WHEN P = 0 THEN 1.0 ELSE tp / P END AS recall FROM cum
UNION ALL SELECT NULL, 1.0, 0.0""", SCORED_SQL, _CURVE_SQL), ops=("A17", "W2"))
def q_pr(spark, sf):
    return me.pr_curve(_sc(spark, sf))


@register("pr_auc", on_employees("""
SELECT floor(sum((recall - r0) * (precision + p0) / 2.0) * 1000000000.0 + 0.5) / 1000000000.0 AS pr_auc FROM (
  SELECT recall, precision, lag(recall) OVER (ORDER BY k DESC) AS r0, lag(precision) OVER (ORDER BY k DESC) AS p0 FROM (
    SELECT score AS k, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision, tp / P AS recall FROM cum
    UNION ALL SELECT 'Infinity'::DOUBLE, 1.0, 0.0) a) b WHERE r0 IS NOT NULL""", SCORED_SQL, _CURVE_SQL),
    ops=("A18",))
def q_prauc(spark, sf):
    return me.pr_auc(_sc(spark, sf)).select(round_half_up("pr_auc", 9).alias("pr_auc"))


@register("cv_fold_f1", on_employees(f"""
SELECT fold, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f1_score FROM (
  SELECT fold, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS p,
               CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS r FROM (
    SELECT CAST(CAST('0x' || substr(md5(CAST(EmployeeNumber AS VARCHAR) || '|7961'), 1, 15) AS BIGINT) % 5 AS INTEGER) AS fold,
           sum(CASE WHEN label = 1 AND predicted_probability >= {THRESHOLD} THEN 1 ELSE 0 END) AS tp,
           sum(CASE WHEN label = 0 AND predicted_probability >= {THRESHOLD} THEN 1 ELSE 0 END) AS fp,
           sum(CASE WHEN label = 1 AND predicted_probability < {THRESHOLD} THEN 1 ELSE 0 END) AS fn
    FROM scored GROUP BY 1) a) b""", SCORED_SQL), ops=("A19", "M8"))
def q_cv_f1(spark, sf):
    """Per-fold F1 of a fixed decision (the aggregation behind cross-validated F1)."""
    from turnstone.operators.split import fold_column
    s = fold_column(me.with_prediction(_sc(spark, sf), THRESHOLD))
    return me.per_group_f1(s, "fold")
