"""Column-expression helpers shared by the operators (all JVM-side, codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c, digits: int) -> Column:
    """Round the binary double half-up: ``floor(x·10^d + 0.5) / 10^d``.

    Spark's ``round`` rounds the decimal string and other engines round the
    binary value, so they disagree on exact ``.xx5`` ties; this form is
    defined by IEEE arithmetic alone and is the same everywhere.
    """
    scale = float(10 ** digits)
    return F.floor(col_(c) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def safe_denominator(c) -> Column:
    """Zero replaced by one (a ratio over an empty count keeps the numerator)."""
    c = col_(c)
    return F.when(c == 0, F.lit(1)).otherwise(c)


def zero_guarded_ratio(num, den) -> Column:
    return col_(num).cast("double") / safe_denominator(den).cast("double")


def positive_guarded_ratio(num, den) -> Column:
    """``num/den`` when ``den > 0`` else ``num``; the row-wise legacy variant."""
    num, den = col_(num).cast("double"), col_(den).cast("double")
    return F.when(den > 0, num / den).otherwise(num)


def recode(c, mapping: dict) -> Column:
    """Dictionary recode; values outside the dictionary become null."""
    c = col_(c)
    out = None
    for k, v in mapping.items():
        out = F.when(c == F.lit(k), F.lit(v)) if out is None else out.when(c == F.lit(k), F.lit(v))
    return out


def flag(cond: Column) -> Column:
    """Boolean → 0/1 with null treated as false."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def uniform_hash(*parts, seed: int = 42) -> Column:
    """Deterministic pseudo-uniform in [0, 1) from md5 of the key and seed.

    Derived from the data only, so recomputing a lost partition gives the
    same value (unlike ``rand()`` after a re-shuffle).
    """
    key = F.concat_ws("|", *[col_(p).cast("string") for p in parts], F.lit(str(seed)))
    return hash_bucket_expr(key, 1_000_000_000) / F.lit(1e9)


def hash_bucket_expr(key: Column, modulus: int) -> Column:
    """First 15 hex digits of md5 as an integer, modulo ``modulus``."""
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint"), F.lit(modulus))
