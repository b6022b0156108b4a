"""Exact deduplication with a heavy-hitter split (DataFrame functions only).

1. One scan turns every row into (doc_id, SHA-256 of the text with A-Z folded);
   that narrow table is staged.
2. Misra-Gries (``DataFrame.stat.freqItems`` is the Karp-Shenker-Papadimitriou
   form of it) names every digest that can hold ``support`` of all rows. Its
   answer has at most ``1 / support`` entries whatever the input size, so it is
   safe to broadcast.
3. The named digests are verified: their exact counts and winners come from one
   map-side aggregation. False positives go back to the ordinary rows.
4. Rows of the verified digests get their winner from a broadcast join, without
   a shuffle. All other digests hold less than ``support`` of the rows and are
   grouped and joined by an ordinary shuffle.

Defined cases: a null text counts as empty; a null doc_id is smaller than any
other; rows that repeat both doc_id and text are copies of each other (they
count in ``group_size``) and stay or go together, since no rule tells them
apart. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstone.llm.shared import ascii_lower, stage

SUPPORT = 0.005


def digests(docs: DataFrame) -> DataFrame:
    text = F.coalesce(docs["text"], F.lit(""))
    return docs.select(docs["doc_id"], F.unhex(F.sha2(ascii_lower(text), 256)).alias("digest"))


def exact_dedup(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    d = stage(digests(docs), "digests")
    # as text: Misra-Gries compares values, and byte arrays compare by identity there
    named = d.select(F.hex("digest").alias("hex")).stat.freqItems(["hex"], support)
    named = named.select(F.explode("hex_freqItems").alias("hex")).select(F.unhex("hex").alias("digest")).distinct()
    least = F.lit(support * d.count())  # parquet footers answer the count
    grouped = [F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")]
    winners = stage(d.join(F.broadcast(named), "digest").groupBy("digest").agg(*grouped)
                    .where(F.col("group_size") >= least), "winners")
    hot = d.join(F.broadcast(winners), "digest")
    rest = d.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    rest = rest.join(rest.groupBy("digest").agg(*grouped), "digest")
    return hot.unionByName(rest).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """``docs`` without the rows that lose to an equal text; its columns are kept.

    A row is named by doc_id and digest, so another text under the same doc_id
    is not touched. Rows without a doc_id cannot be told apart by key, so all of
    them stay.
    """
    gone = exact_dedup(docs, support).where(~F.col("kept") & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").alias("gone_id"), F.col("text_sha256").alias("gone_sha256")).distinct()
    digest = F.sha2(ascii_lower(F.coalesce(docs["text"], F.lit(""))), 256)
    return docs.join(gone, (docs["doc_id"] == gone["gone_id"]) & (digest == gone["gone_sha256"]), "left_anti").select(docs.columns)


SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, d.text_sha256
FROM d JOIN g ON d.text_sha256 = g.text_sha256
"""
