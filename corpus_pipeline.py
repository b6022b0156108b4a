"""Corpus pipeline: toxicity, exact dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet to the cluster's shared folder and reads again as the next
stage's documents. All stages but the last return the columns of documents.
Near-duplicates are judged on five-word shingles at a similarity of 0.8.
"""

from __future__ import annotations

from turnstone.llm import decontaminate, exact_dedup, minmax_dedup, packing, toxicity
from turnstone.llm.shared import stage, table

SHINGLE = 5


def drop_toxic(spark, docs, sf_dir):
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_exact_copies(spark, docs, sf_dir):
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark, docs, sf_dir):
    return minmax_dedup.drop_near_copies(docs, k=SHINGLE)


def drop_benchmark_leaks(spark, docs, sf_dir):
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack_documents(spark, docs, sf_dir):
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack_documents),
]

#: toxicity, permutations and tokens cannot be expressed in SQL; tests/llm holds run() against a brute-force version
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
