"""kNN / SMOTE / ENN queries on the ``embeddings`` table."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnstone.operators import resample as rs
from turnstone.operators.knn import knn_join
from turnstone.plans.registry import with_ctes
from turnstone.plans.registry import register
from turnstone.sources.tables import table


def embedded(spark, sf):
    """Vectors with the binary label ``label < 5``."""
    e = table(spark, sf, "embeddings")
    return e.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"),
                    (F.col("label") < 5).cast("int").alias("label"))


EMB_SQL = "e AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v, CAST(label < 5 AS INTEGER) AS y FROM embeddings)"


def _knn_sql(name, src, k):
    return (f"{name} AS (SELECT id, nid, rk FROM (SELECT a.id, b.id AS nid, "
            f"row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.v, b.v), b.id) AS rk "
            f"FROM {src} a JOIN {src} b ON a.id <> b.id) t WHERE rk <= {k})")


@register("knn_join", with_ctes(EMB_SQL, _knn_sql("nn", "e", 5), body="""
SELECT id, CAST(rk AS INTEGER) AS rank, nid AS neighbor_id FROM nn"""), ops=("J5",))
def q_knn(spark, sf):
    return knn_join(embedded(spark, sf), k=5).select("id", "rank", "neighbor_id")


_SMOTE_SQL = [
    "cnt AS (SELECT y, count(*) AS n FROM e GROUP BY y)",
    "mi AS (SELECT y, n FROM cnt ORDER BY n, y LIMIT 1)",
    "ma AS (SELECT y, n FROM cnt ORDER BY n DESC, y DESC LIMIT 1)",
    "m AS (SELECT * FROM e WHERE y = (SELECT y FROM mi))",
    _knn_sql("mnn", "m", 5),
    """par AS (SELECT (SELECT n FROM ma) - (SELECT n FROM mi) AS n_new, (SELECT n FROM mi) AS n_min)""",
    """reps AS (
  SELECT id, (SELECT n_new // n_min FROM par)
             + CASE WHEN row_number() OVER (ORDER BY CAST('0x' || substr(md5(CAST(id AS VARCHAR) || '|42'), 1, 15) AS BIGINT), id)
                         <= (SELECT n_new % n_min FROM par) THEN 1 ELSE 0 END AS r
  FROM m)""",
    """gen AS (SELECT id, unnest(range(0, r)) AS rep FROM reps WHERE r > 0)""",
    """kk AS (SELECT id, count(*) AS k FROM mnn GROUP BY id)""",
]


@register("smote", with_ctes(EMB_SQL, *_SMOTE_SQL, body="""
SELECT g.id AS base_id, CAST(g.rep AS INTEGER) AS rep, n.nid AS neighbor_id,
       (CAST('0x' || substr(md5(concat_ws('|', CAST(g.id AS VARCHAR), CAST(g.rep AS VARCHAR), 'gap', '42')), 1, 15) AS BIGINT)
        % 1000000000) / 1e9 AS gap
FROM gen g JOIN kk ON g.id = kk.id
JOIN mnn n ON n.id = g.id AND n.rk = 1 + (CAST('0x' || substr(md5(concat_ws('|', CAST(g.id AS VARCHAR), CAST(g.rep AS VARCHAR), 'nb', '42')), 1, 15) AS BIGINT) % kk.k)"""),
    ops=("M2", "J5"))
def q_smote(spark, sf):
    return rs.smote_plan(embedded(spark, sf), k=5)


@register("smote_counts", with_ctes(EMB_SQL, "cnt AS (SELECT y, count(*) AS n FROM e GROUP BY y)", body="""
SELECT y AS label, synthetic, n FROM (
  SELECT y, false AS synthetic, n FROM cnt
  UNION ALL SELECT (SELECT y FROM cnt ORDER BY n, y LIMIT 1), true, max(n) - min(n) FROM cnt) t WHERE n > 0"""),
    ops=("M2", "U4"))
def q_smote_counts(spark, sf):
    up = rs.smote(embedded(spark, sf), k=5)
    return up.groupBy("label", "synthetic").agg(F.count(F.lit(1)).alias("n"))


@register("enn", with_ctes(EMB_SQL, _knn_sql("nn", "e", 3), body="""
SELECT e.id, e.y AS label, coalesce(d.removed, false) AS removed FROM e LEFT JOIN (
  SELECT nn.id, bool_or(e2.y <> e1.y) AS removed FROM nn JOIN e e1 ON e1.id = nn.id JOIN e e2 ON e2.id = nn.nid
  GROUP BY nn.id) d ON d.id = e.id"""), ops=("M3",))
def q_enn(spark, sf):
    return rs.enn_flags(embedded(spark, sf), k=3)


@register("smote_enn_counts", None, ops=("M2", "M3", "M9"))
def q_smote_enn(spark, sf):
    """Class sizes after SMOTE then ENN (rows-only: synthetic vectors have no SQL twin here)."""
    out = rs.smote_enn(embedded(spark, sf))
    return out.groupBy("label", "synthetic").agg(F.count(F.lit(1)).alias("n"))
