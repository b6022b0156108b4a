"""Spark helpers shared by the operators: staged tables and deterministic sizes."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstone.session import checkpoint_dir

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the cluster's shared folder and read it back.

    Cuts the lineage (a lost executor re-reads files instead of recomputing
    the upstream) and fixes every value that depends on partitioning. The
    folder is the one named by ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(col):
    """Lower-case A-Z only. ``lower`` is the same thing on pure ASCII text and much faster there."""
    return F.when(F.octet_length(col) == F.length(col), F.lower(col)).otherwise(
        F.translate(col, _UPPER, _UPPER.lower()))


def text_md5(docs: DataFrame):
    """128 bits that tell the texts of one doc_id apart; a null text counts as empty."""
    return F.md5(F.coalesce(docs["text"], F.lit("")).cast("binary"))


def row_name(docs: DataFrame):
    """What names a row where a doc_id may repeat with another text."""
    return F.struct(docs["doc_id"].alias("doc_id"), text_md5(docs).alias("text_md5"))


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
