"""The shared feature pipeline: cleanup, recodes, derived features, a fitted
category vocabulary, and alignment of any frame to that vocabulary.

Every step is a projection, so the whole pipeline compiles into one
whole-stage-codegen span next to the scan. The only driver round trip is
fitting the vocabulary, whose size is bounded by the categorical domains and
checked before it is collected: the vocabulary *is* the output schema, so it
has to be known when the plan is built. Columns with more levels than a schema
holds go through ``levels``, which keeps them in a table.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstone.functions.exprs import (positive_guarded_ratio, recode, round_half_up,
                                       zero_guarded_ratio)

# Administrative / non-predictive columns removed before modelling.
ADMIN_COLUMNS = ["EmployeeCount", "Over18", "StandardHours", "EmployeeNumber", "Attrition"]
# Gender recode.
GENDER_CODES = {"Male": 1, "Female": 0}
# Derived feature names.
YEARS_PER_COMPANY = "YearsPerCompany"
INCOME_LOG = "MonthlyIncome_log"
YEARS_LOG = "TotalWorkingYears_log"
INCOME_LONGEVITY = "Income_Longevity_Interaction"
STAGNATION = "Stagnation_Index"

MAX_LEVELS = 10_000  # columns of a wide catalogue; levels.fit_levels takes any number


def keep_existing(df: DataFrame, names) -> DataFrame:
    """Keep, in the given order, those of ``names`` that exist."""
    return df.select(*[n for n in names if n in df.columns])


def string_columns(df: DataFrame, exclude=()) -> list[str]:
    """Text columns by schema."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def engineer(df: DataFrame, key: str | None = "EmployeeNumber",
             label: str | None = None) -> DataFrame:
    """Drop admin columns, recode gender, add derived features.

    Each derivation runs only when its inputs exist, so partial frames (a
    single request with a few fields) go through the same code. ``key`` is
    carried as the first column (never a feature) so rows stay identifiable.
    """
    cols = set(df.columns)
    keep_key = [key] if key and key in cols else []
    drop = [c for c in ADMIN_COLUMNS if c in cols]
    exprs: list[Column] = [_c(k) for k in keep_key]
    if label and label in cols:
        exprs.append(yes_no_label(label))
    for c in df.columns:
        if c in drop:
            continue
        if c == "Gender":
            exprs.append(recode("Gender", GENDER_CODES).alias("Gender"))
        else:
            exprs.append(_c(c))
    if {"TotalWorkingYears", "NumCompaniesWorked"} <= cols:
        exprs.append(zero_guarded_ratio("TotalWorkingYears", "NumCompaniesWorked").alias(YEARS_PER_COMPANY))
    if "MonthlyIncome" in cols:
        exprs.append(F.log1p(F.col("MonthlyIncome").cast("double")).alias(INCOME_LOG))
    if "TotalWorkingYears" in cols:
        exprs.append(F.log1p(F.col("TotalWorkingYears").cast("double")).alias(YEARS_LOG))
    if {"MonthlyIncome", "YearsAtCompany"} <= cols:
        exprs.append((F.col("MonthlyIncome").cast("double") * F.col("YearsAtCompany").cast("double"))
                     .alias(INCOME_LONGEVITY))
    if {"YearsSinceLastPromotion", "YearsWithCurrManager"} <= cols:
        exprs.append(zero_guarded_ratio("YearsSinceLastPromotion", "YearsWithCurrManager").alias(STAGNATION))
    return df.select(*exprs)


def rounded_ratio(df: DataFrame, num="TotalWorkingYears", den="NumCompaniesWorked",
                  name=YEARS_PER_COMPANY, digits=4) -> DataFrame:
    """Legacy row-wise ratio (guard ``den > 0``) rounded to 4 places."""
    return df.withColumn(name, round_half_up(positive_guarded_ratio(num, den), digits))


@dataclass
class Vocabulary:
    """Ordered feature catalogue: (feature, source column, category or None)."""

    entries: list[tuple[str, str, str | None]] = field(default_factory=list)

    @property
    def features(self) -> list[str]:
        return [e[0] for e in self.entries]

    def __len__(self):
        return len(self.entries)

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [(i, f, s, c) for i, (f, s, c) in enumerate(self.entries)]
        return spark.createDataFrame(
            rows, "position int, feature string, source_col string, category string")

    def to_json(self) -> str:
        return json.dumps(self.entries)

    @classmethod
    def from_json(cls, text: str) -> "Vocabulary":
        return cls([tuple(e) for e in json.loads(text)])

    @classmethod
    def from_df(cls, df: DataFrame) -> "Vocabulary":
        rows = df.orderBy("position").collect()
        return cls([(r.feature, r.source_col, r.category) for r in rows])


def category_levels(df: DataFrame, cat_cols: list[str]) -> DataFrame:
    """Distinct (source_col, category) pairs as a distributed frame.

    One pass over the data; the distinct is partially aggregated map-side,
    so only one row per level per task is shuffled.
    """
    if not cat_cols:
        return df.sparkSession.createDataFrame([], "source_col string, category string")
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("source_col"), _c(c).cast("string").alias("category"))
        for c in cat_cols]))
    return (df.select(pairs.alias("p")).select("p.source_col", "p.category")
              .where(F.col("category").isNotNull()).distinct())


def fit_vocabulary(df: DataFrame, cat_cols: list[str] | None = None, drop_first: bool = True,
                   exclude=("EmployeeNumber",), max_levels: int = MAX_LEVELS) -> Vocabulary:
    """Numeric columns in frame order, then one dummy per level of each
    text column (levels sorted, first dropped when ``drop_first``)."""
    if cat_cols is None:
        cat_cols = string_columns(df, exclude)
    # One job; at most max_levels + 1 rows ever reach the driver.
    rows = category_levels(df, cat_cols).limit(max_levels + 1).collect()
    if len(rows) > max_levels:
        raise ValueError(f"more than max_levels={max_levels} category levels for one column each; "
                         "levels.fit_levels and levels.encode take any number")
    by_col: dict[str, list[str]] = {}
    for r in rows:
        by_col.setdefault(r.source_col, []).append(r.category)
    entries: list[tuple[str, str, str | None]] = []
    for f in df.schema.fields:
        if f.name in exclude or f.name in cat_cols:
            continue
        if isinstance(f.dataType, (T.NumericType, T.BooleanType)):
            entries.append((f.name, f.name, None))
    for c in cat_cols:
        lv = sorted(by_col.get(c, []))
        for v in (lv[1:] if drop_first else lv):
            entries.append((f"{c}_{v}", c, v))
    return Vocabulary(entries)


def apply_vocabulary(df: DataFrame, vocab: Vocabulary, keep=("EmployeeNumber",)) -> DataFrame:
    """Dummies from the *fitted* levels, booleans to double, columns
    reordered to the catalogue, missing ones filled with 0.0, extras dropped.

    Unseen categories give all-zero dummies, so a one-row request is encoded
    exactly like the same row inside a batch.
    """
    present = set(df.columns)
    out: list[Column] = [_c(k) for k in keep if k in present]
    for feat, src, cat in vocab.entries:
        if cat is not None:
            if src in present:
                e = F.coalesce((_c(src).cast("string") == F.lit(cat)).cast("double"), F.lit(0.0))
            else:
                e = F.lit(0.0)
        else:
            e = _c(src).cast("double") if src in present else F.lit(0.0)
        out.append(e.alias(feat))
    return df.select(*out)


def _c(name: str) -> Column:
    """Column by its exact name (dots and backticks taken literally)."""
    return F.col("`" + name.replace("`", "``") + "`")


def one_hot(df: DataFrame, cat_cols: list[str] | None = None, keep=("EmployeeNumber",),
            drop_first: bool = True) -> DataFrame:
    """P10 on a frame by itself (fit + apply on the same rows)."""
    vocab = fit_vocabulary(df, cat_cols, drop_first=drop_first, exclude=tuple(keep))
    return apply_vocabulary(df, vocab, keep)


def normalise_names(df: DataFrame) -> DataFrame:
    """Lower case, spaces and hyphens to underscores."""
    return df.toDF(*[c.lower().replace(" ", "_").replace("-", "_") for c in df.columns])


def standardise(df: DataFrame, cols: list[str] | None = None, exclude=()) -> DataFrame:
    """(x − mean) / population std; constant columns become 0.

    One aggregate pass computes every column's mean and std (a single row of
    2·k numbers), which is inlined as literals into one projection.
    """
    if cols is None:
        cols = numeric_columns(df, exclude)
    if not cols:
        return df
    stats = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)],
                   *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(cols)]
                   ).first()
    repl = {}
    for i, c in enumerate(cols):
        m, s = stats[f"m{i}"], stats[f"s{i}"]
        x = F.col(c).cast("double")
        if s is None or s == 0:
            repl[c] = F.when(x.isNull(), None).otherwise(F.lit(0.0))
        else:
            repl[c] = (x - F.lit(m)) / F.lit(s)
    return df.select(*[repl[c].alias(c) if c in repl else F.col(c) for c in df.columns])


def feature_pipeline(df: DataFrame, vocab: Vocabulary | None = None, key="EmployeeNumber",
                     label: str | None = "Attrition"):
    """Engineer → (fit) vocabulary → aligned numeric frame.

    Returns ``(frame, vocab)``. The frame carries ``key`` and, when present,
    ``label`` recoded to 0/1 next to the features.
    """
    eng = engineer(df, key=key, label=label)
    if vocab is None:
        vocab = fit_vocabulary(eng, exclude=tuple(x for x in (key, "label") if x))
    keep = [k for k in (key, "label") if k in eng.columns]
    return apply_vocabulary(eng, vocab, keep=keep), vocab


def yes_no_label(label: str) -> Column:
    return recode(label, {"Yes": 1, "No": 0}).cast("int").alias("label")
