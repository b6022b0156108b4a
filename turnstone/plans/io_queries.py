"""Source / sink round trips and streaming queries.

Each query writes Spark-derived data from the given tables into a fresh
folder under the shared checkpoint location, runs the reader / stream under
test over it, and returns what it read, so the oracle is the plain batch SQL.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from turnstone.operators import features as fe
from turnstone.operators.scoring import decision, fixed_score
from turnstone.plans.common import LOG_SQL, SCORED_SQL, prediction_log
from turnstone.plans.registry import on_employees, register, with_ctes
from turnstone.session import scratch_path
from turnstone.sources import io
from turnstone.sources.tables import employees
from turnstone.streaming import scoring as st

THRESHOLD = 0.24


def _fresh(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


_EMP_COLS = ("EmployeeNumber, JobLevel, OverTime, Department, JobRole, BusinessTravel, MonthlyIncome, JobSatisfaction, "
             "EnvironmentSatisfaction, Gender, TotalWorkingYears, NumCompaniesWorked, YearsAtCompany, "
             "YearsSinceLastPromotion, YearsWithCurrManager, Attrition")


@register("csv_roundtrip", on_employees(f"SELECT {_EMP_COLS} FROM employees"), ops=("S1", "K6", "K1"))
def q_csv(spark, sf):
    emp = employees(spark, sf)
    path = _fresh(spark, "csv")
    io.write_csv(emp, path)
    return io.read_csv(spark, path, emp.schema)


@register("json_scan", on_employees(f"SELECT {_EMP_COLS} FROM employees"), ops=("S4",))
def q_json(spark, sf):
    emp = employees(spark, sf)
    path = _fresh(spark, "json")
    emp.write.mode("overwrite").json(path)
    return io.read_json(spark, path, emp.schema)


@register("table_fallback", on_employees(f"SELECT {_EMP_COLS} FROM employees"), ops=("S5", "S2", "S3"))
def q_fallback(spark, sf):
    """The named catalog table does not exist, so the CSV copy is read."""
    emp = employees(spark, sf)
    path = _fresh(spark, "fallback")
    io.write_csv(emp, path)
    return io.load_with_fallback(spark, "turnstone_missing_employees", path, emp.schema)


@register("log_append", with_ctes(LOG_SQL, body="""
SELECT EmployeeNumber, predicted_probability, prediction_label, true AS stamped FROM plog"""), ops=("K2", "K3"))
def q_log_append(spark, sf):
    """Two appends (first after a truncating overwrite) stamped at write time."""
    log = prediction_log(spark, sf)
    path = _fresh(spark, "log")
    # create-or-replace with an empty table of the log's schema (truncate before load)
    io.write_table(log.where(F.lit(False)).select("EmployeeNumber", "predicted_probability", "prediction_label")
                   .withColumn("prediction_timestamp", F.current_timestamp()), path)
    log = log.select("EmployeeNumber", "predicted_probability", "prediction_label", "prediction_timestamp")
    first_half = F.dayofmonth(F.col("prediction_timestamp")) <= 15
    io.append_log(log.where(first_half), path)
    io.append_log(log.where(~first_half), path)
    back = spark.read.parquet(path)
    return back.select("EmployeeNumber", "predicted_probability", "prediction_label",
                       F.col("prediction_timestamp").isNotNull().alias("stamped"))


@register("artifacts_roundtrip", on_employees(
    "SELECT count(*) AS rows, true AS same_scores FROM employees"), ops=("K7", "S8"))
def q_artifacts(spark, sf):
    """Vocabulary and threshold saved and loaded back encode every row identically."""
    from turnstone.operators.profile import frame_equality
    emp = employees(spark, sf)
    eng = fe.engineer(emp, label="Attrition")
    vocab = fe.fit_vocabulary(eng, exclude=("EmployeeNumber", "label"))
    root = _fresh(spark, "artifacts")
    io.save_vocabulary(vocab, spark, os.path.join(root, "vocabulary"))
    io.save_threshold(spark, THRESHOLD, os.path.join(root, "threshold"))
    v2 = io.load_vocabulary(spark, os.path.join(root, "vocabulary"))
    t2 = io.load_threshold(spark, os.path.join(root, "threshold"))
    a = decision(fixed_score(emp), t2).select("EmployeeNumber", "prediction_label") \
        .join(fe.apply_vocabulary(eng, v2), "EmployeeNumber")
    b = decision(fixed_score(emp), THRESHOLD).select("EmployeeNumber", "prediction_label") \
        .join(fe.apply_vocabulary(eng, vocab), "EmployeeNumber")
    same_meta = v2.entries == vocab.entries
    eq = frame_equality(a, b)
    return eq.select(F.col("rows_a").alias("rows"),
                     (F.lit(same_meta) & F.col("same_schema") & (F.col("only_in_a") == 0)
                      & (F.col("only_in_b") == 0)).alias("same_scores"))


@register("stream_scoring", on_employees(f"""
SELECT EmployeeNumber, predicted_probability,
       CASE WHEN predicted_probability >= {THRESHOLD} THEN 'Yes' ELSE 'No' END AS prediction_label FROM scored""",
    SCORED_SQL), ops=("R1", "R2"))
def q_stream_scoring(spark, sf):
    """Employee records arrive as files; each micro-batch is scored with the
    same projection as batch and appended to a parquet sink."""
    emp = employees(spark, sf)
    root = _fresh(spark, "stream-scoring")
    src, sink, ck = (os.path.join(root, x) for x in ("in", "out", "ck"))
    emp.repartitionByRange(6, "EmployeeNumber").write.parquet(src)
    stream = spark.readStream.schema(emp.schema).option("maxFilesPerTrigger", 2).parquet(src)

    def scorer(df):
        return decision(fixed_score(df), THRESHOLD).select(
            "EmployeeNumber", "predicted_probability", "prediction_label")
    q = st.score_stream(stream, scorer, sink, ck)
    q.awaitTermination()
    return spark.read.parquet(sink)


@register("stream_latest", with_ctes(LOG_SQL, body="""
SELECT EmployeeNumber, prediction_timestamp, event_id, predicted_probability, prediction_label FROM (
  SELECT *, row_number() OVER (PARTITION BY EmployeeNumber ORDER BY prediction_timestamp DESC, event_id DESC) AS rn
  FROM plog) t WHERE rn = 1"""), ops=("R3", "W1", "K4", "K5"))
def q_stream_latest(spark, sf):
    """The prediction log arrives in time order; a stateful aggregate keeps
    the newest row per employee and each update is upserted into a table."""
    log = prediction_log(spark, sf)
    root = _fresh(spark, "stream-latest")
    src, table, ck = (os.path.join(root, x) for x in ("in", "table", "ck"))
    log.repartitionByRange(10, "prediction_timestamp").write.parquet(src)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 3).parquet(src)
    latest = st.latest_stream(stream)
    q = (latest.writeStream.outputMode("update").option("checkpointLocation", ck)
               .foreachBatch(st.upsert_batches(table, "EmployeeNumber")).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(st.current_version(spark, table))
