"""Distributed prefix sums and exact order statistics (W2, A8 exact quantiles).

A ``Window`` without ``partitionBy`` pulls every row into one task. Here one
range shuffle cuts the ordered rows into contiguous ranges, whose number grows
with the row count, and the result is materialised with its range id. Per-range
totals (one row per range) are turned into offsets, and the running sum inside
each range is a window partitioned by the range. Callers pass distinct keys
(aggregate first), so no range can hold a hot key.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnstone.session import materialize

ROWS_PER_RANGE = 100_000


def range_bucket(df: DataFrame, order: list, buckets: int | None = None, col: str = "_bucket") -> DataFrame:
    """``df`` range-partitioned by ``order``, materialised with a range id that ascends in that order.

    Without ``buckets`` there are as many ranges as the session has shuffle
    partitions, and more once a range would exceed ``ROWS_PER_RANGE`` rows
    (``df`` is counted, so it should be materialised then).
    """
    if buckets is None:
        least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        buckets = max(least, math.ceil(df.count() / ROWS_PER_RANGE))
    # the bounds are sampled: materialising keeps them the same for all readers
    return materialize(df.repartitionByRange(buckets, *order).withColumn(col, F.spark_partition_id()))


def running_totals(df: DataFrame, key: str, sums: list[str], descending: bool = False,
                   tiebreak: list[str] | None = None, buckets: int | None = None,
                   prefix: str = "cum_", group: list[str] | None = None, materialized: bool = False) -> DataFrame:
    """Adds ``cum_<c>`` = sum of ``c`` over all rows up to and including this
    one in ``key`` order (ties broken by ``tiebreak``), restarting per
    ``group`` when given. Ranges run over (group, key), so a large group spans
    several of them and never becomes one window task. ``materialized`` says
    that ``df`` already is a checkpoint."""
    group = group or []
    order = [F.desc(key) if descending else F.asc(key)] + [F.asc(t) for t in (tiebreak or [])]
    df = df if materialized else materialize(df)
    b = range_bucket(df, [*group, *order], buckets)
    totals = b.groupBy(*group, "_bucket").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    w_small = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*group, "_bucket", *[F.coalesce(F.sum(f"_t_{c}").over(w_small), F.lit(0))
                                                 .alias(f"_o_{c}") for c in sums])
    w = Window.partitionBy(*group, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    keys = [*group, "_bucket"]
    offsets = offsets.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)], *[f"_o_{c}" for c in sums])
    on = F.lit(True)
    for i, c in enumerate(keys):  # null-safe: a null group value is a group of its own
        on = on & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    out = b.join(offsets, on).drop(*[f"_k{i}" for i in range(len(keys))])
    for c in sums:
        out = out.withColumn(f"{prefix}{c}", F.col(f"_o_{c}") + F.sum(c).over(w))
    return out.drop("_bucket", *[f"_o_{c}" for c in sums])


def exact_quantiles_multi(df: DataFrame, cols: list[str], probs: list[float]) -> DataFrame:
    """Exact quantiles with linear interpolation between closest ranks, for several columns in one set of jobs.

    Columns are stacked to (column index, value) and reduced to counts per
    distinct value; the running count restarts per column (grouped, ranged
    prefix sum). Output: (column, prob, value)."""
    sp = df.sparkSession
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v")) for i, c in enumerate(cols)])).alias("x"))
    counts = materialize(stacked.select("x.c", "x.v").where(F.col("v").isNotNull())
                         .groupBy("c", "v").agg(F.count(F.lit(1)).alias("n")))
    totals = {r["c"]: r["N"] for r in counts.groupBy("c").agg(F.sum("n").alias("N")).collect()}
    cum = running_totals(counts, "v", ["n"], group=["c"], materialized=True).withColumn(
        "first_rank", F.col("cum_n") - F.col("n"))
    hits, meta = [], []
    for ci, c in enumerate(cols):
        nr = totals.get(ci, 0)
        for pi, p in enumerate(probs):
            if nr == 0:
                continue
            h = (nr - 1) * p
            lo = int(h // 1)
            hi = min(lo + 1, nr - 1) if h > lo else lo
            meta.append((ci, pi, c, float(p), float(h - lo)))
            for which, r in (("lo", lo), ("hi", hi)):
                inside = (F.col("c") == ci) & (F.lit(r) >= F.col("first_rank")) & (F.lit(r) < F.col("cum_n"))
                hits.append(F.when(inside, F.struct(F.lit(ci).alias("ci"), F.lit(pi).alias("pi"),
                                                    F.lit(which).alias("which"), F.col("v").alias("v"))))
    t = sp.createDataFrame(meta, "ci int, pi int, column string, prob double, frac double")
    if not hits:
        return t.select("column", "prob", F.lit(None).cast("double").alias("value"))
    found = (cum.select(F.explode(F.array_compact(F.array(*hits))).alias("h"))
                .groupBy(F.col("h.ci").alias("ci"), F.col("h.pi").alias("pi"))
                .agg(F.max(F.when(F.col("h.which") == "lo", F.col("h.v"))).alias("vlo"),
                     F.max(F.when(F.col("h.which") == "hi", F.col("h.v"))).alias("vhi")))
    return (found.join(F.broadcast(t), ["ci", "pi"])
                 .select("column", "prob", (F.col("vlo") + (F.col("vhi") - F.col("vlo")) * F.col("frac")).alias("value")))
