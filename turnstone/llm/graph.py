"""Connected components of a link table, by alternating large and small stars.

Both star operations run as joins and grouped minima; a round is staged in the
shared folder, so no lineage grows and nothing but one flag reaches the
driver. The number of rounds is logarithmic in the longest chain. A hub's
links are split by the engine's skew join: both inputs of each join are plain
scans of staged tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstone.llm.shared import stage


def _toward_smaller(e: DataFrame) -> DataFrame:
    """Links as (u, v) with u > v, each once."""
    return e.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _are_stars(e: DataFrame) -> bool:
    """Whether every id either is a smallest one or has one link, to a smallest one."""
    ends = e.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        e.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    ends = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.where("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def components(links: DataFrame, a: str = "u", b: str = "v") -> DataFrame:
    """(id, component) for every id that has a link; component is the smallest id reachable."""
    e = stage(_toward_smaller(links.select(F.col(a).alias("u"), F.col(b).alias("v"))), "links")
    while not _are_stars(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "low")
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(_toward_smaller(large), "large")
        low = stage(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v")))
        e = stage(_toward_smaller(small), "links")
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
