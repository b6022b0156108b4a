"""Deterministic, seeded train/test split and K-fold assignment (M1, M8).

Rows are assigned by a hash of (key, seed), never by position or ``rand()``,
so the assignment survives re-execution of a lost partition, needs no
shuffle, and is reproducible in any engine. Stratification holds in
expectation because the hash is independent of the label; ``exact=True``
additionally fixes the per-label test count (see ``stratified_split``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstone.functions.exprs import hash_bucket_expr
from turnstone.session import materialize

HASH_BUCKETS = 10_000


def key_hash(key: str, seed: int = 42, modulus: int = HASH_BUCKETS):
    """Integer in [0, modulus) from md5(key || '|' || seed)."""
    text = F.concat(F.col(key).cast("string"), F.lit(f"|{seed}"))
    return hash_bucket_expr(text, modulus)


def hash_split(df: DataFrame, key: str = "EmployeeNumber", test_fraction: float = 0.2,
               seed: int = 42, col: str = "is_test") -> DataFrame:
    """Adds boolean ``col``: the row belongs to the test part."""
    cut = int(round(test_fraction * HASH_BUCKETS))
    return df.withColumn(col, key_hash(key, seed) < F.lit(cut))


def stratified_split(df: DataFrame, label: str = "label", key: str = "EmployeeNumber",
                     test_fraction: float = 0.2, seed: int = 42, col: str = "is_test",
                     exact: bool = False) -> DataFrame:
    """M1. Default: hash threshold (strata proportional in expectation).

    ``exact=True``: the test part holds exactly ``round(fraction · n_label)``
    rows of each label, the ones with the smallest hash. The cut is found
    from a per-label histogram of the hash (``labels × buckets`` rows, tiny)
    so no window ever spans a whole label; only rows inside the single
    boundary bucket of each label are ranked.
    """
    if not exact:
        return hash_split(df, key, test_fraction, seed, col)
    target = lambda n: _half_up_share(n, test_fraction)
    return mark_lowest(df, key, target, group=label, seed=seed, col=col)


def mark_lowest(df: DataFrame, key: str, target, group: str | None = None, seed: int = 42,
                col: str = "is_low") -> DataFrame:
    """Flag exactly ``target(n_group)`` rows per group: those with the
    smallest (hash(key, seed), key). ``target`` maps the group's row count
    column to the number of rows to flag (an int works too).

    The cut is found from per-group histograms of the hash (two levels of
    4096 buckets), so no window ever spans a whole group; only the rows of
    the one final boundary bucket per group are ranked, and the resulting
    cut (one row per group) is broadcast back.
    """
    keys = [group] if group else []
    if not callable(target):
        fixed = int(target)
        target = lambda n: F.least(n, F.lit(fixed)).cast("long")
    span = 1 << 60
    # The cut needs several passes over (group, key, hash) only: materialise
    # that narrow frame once; the full rows are read once more at the end.
    framed = materialize(df.select(*keys, key).withColumn("_h", key_hash(key, seed, span)))
    # Two histogram levels of 4096 buckets each: the boundary rows that are
    # finally ranked are ~1/16.7M of a group, however large the group is.
    lo_h = None  # per group: (_before0, _target, hash range) of the current boundary bucket
    bits = 60
    for level in range(2):
        bits -= 12
        width = 1 << bits
        cur = framed.withColumn("_b", F.shiftright(F.col("_h"), bits))  # exact integer bucket
        if lo_h is not None:
            cur = _attach(cur, lo_h, keys).where((F.col("_h") >= F.col("_lo")) & (F.col("_h") < F.col("_hi")))
        else:
            cur = cur.withColumn("_before0", F.lit(0).cast("long"))
        hist = cur.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"),
                                            F.first("_before0").alias("_before0"),
                                            *([F.first("_target").alias("_target")] if lo_h is not None else []))
        if lo_h is None:
            hist = hist.withColumn("_target", target(F.sum("_n").over(_win_all(keys))))
        hist = (hist.withColumn("_cum", F.col("_before0") + F.sum("_n").over(_win(keys, "_b")))
                    .withColumn("_before", F.col("_cum") - F.col("_n"))
                    .where((F.col("_before") < F.col("_target")) & (F.col("_target") <= F.col("_cum"))))
        lo_h = hist.select(*keys, (F.col("_b") * F.lit(width)).alias("_lo"),
                           ((F.col("_b") + 1) * F.lit(width)).alias("_hi"),
                           F.col("_before").alias("_before0"), "_target")
    # Rank only the rows of the final boundary range (at most one per group).
    inside = _attach(framed, lo_h, keys).where((F.col("_h") >= F.col("_lo")) & (F.col("_h") < F.col("_hi")))
    cut = (inside.withColumn("_r", F.row_number().over(_win(keys, "_h", key)))
                 .where(F.col("_r") == F.col("_target") - F.col("_before0"))
                 .select(*keys, F.col("_h").alias("_cut_h"), F.col(key).alias("_cut_k")))
    out = _attach(df.withColumn("_h", key_hash(key, seed, span)), cut, keys, how="left")
    is_low = (F.col("_h") < F.col("_cut_h")) | (
        (F.col("_h") == F.col("_cut_h")) & (F.col(key) <= F.col("_cut_k")))
    return out.withColumn(col, F.coalesce(is_low, F.lit(False))).drop("_h", "_cut_h", "_cut_k")


def _attach(df: DataFrame, small: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Columns of a tiny per-group frame (at most one row per group) added to
    ``df``: a broadcast equi-join on the group keys, or — without groups — a
    scalar subquery per column (no join at all; null when the frame is empty).
    An inner attach of an empty frame drops every row, as the join would."""
    if keys:
        return df.join(F.broadcast(small), keys, how)
    extra = [c for c in small.columns]
    out = df.select("*", *[small.select(c).scalar().alias(c) for c in extra])
    return out if how == "left" else out.where(F.col(extra[0]).isNotNull())


def _half_up_share(n, fraction: float, den: int = HASH_BUCKETS):
    """round(n · fraction) half-up in exact integer arithmetic."""
    num = int(round(fraction * den))
    return F.floor((n * (2 * num) + den) / F.lit(2 * den)).cast("long")


def _win(keys, *order):
    """Window over tiny per-group frames (histograms, boundary buckets)."""
    from pyspark.sql import Window
    keys = [keys] if isinstance(keys, str) else keys
    return Window.partitionBy(*keys).orderBy(*order)


def _win_all(keys):
    from pyspark.sql import Window
    keys = [keys] if isinstance(keys, str) else keys
    return Window.partitionBy(*keys)


def fold_column(df: DataFrame, key: str = "EmployeeNumber", k: int = 5, seed: int = 42,
                col: str = "fold") -> DataFrame:
    """M8: fold id in [0, k) from the key hash (salted differently from the split)."""
    return df.withColumn(col, key_hash(key, seed + 7919, k).cast("int"))


def stratified_fold_column(df: DataFrame, label: str = "label", key: str = "EmployeeNumber", k: int = 5,
                           seed: int = 42, col: str = "fold") -> DataFrame:
    """M8: folds whose sizes differ by at most one row within each label.

    Rows are ranked by key hash within their label (a ranged running count, so
    a large class is not one task), and the rank modulo ``k`` is the fold.
    ``key`` must be unique."""
    from turnstone.operators.prefix import running_totals
    narrow = df.select(key, label, key_hash(key, seed + 7919, 1 << 60).alias("_h"), F.lit(1).alias("_one"))
    ranked = running_totals(narrow, "_h", ["_one"], tiebreak=[key], group=[label])
    folds = ranked.select(key, ((F.col("cum__one") - 1) % k).cast("int").alias(col))
    return df.join(folds, key)
