"""Category levels as a table, for columns of any number of levels.

``features.fit_vocabulary`` makes one column per level, so its levels must fit a
schema. Here the levels stay a distributed table: (source column, category,
position), positions from a ranged count in code-point order. Rows find their
positions by a join per text column and become sparse vectors, in the order of
the wide catalogue: numeric columns first, then the levels of each text column,
the first of each left out when ``drop_first``.

Only one number per text column reaches the driver. The planner broadcasts the
levels of a column when they are small and shuffles them otherwise; a category
that a third of the rows hold is split by the engine's skew join.

Defined cases: a null, unseen or left-out category sets no position; a column
that a frame lacks counts as 0; a null number is NaN, as in the wide catalogue's
vectors; a text column without levels takes no positions; an empty frame gives
an empty result. A vector holds at most 2**31 - 1 positions.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstone.operators.features import _c, category_levels, engineer, string_columns
from turnstone.operators.prefix import running_totals
from turnstone.session import materialize


@dataclass(frozen=True)
class LevelDictionary:
    """Numeric columns, text columns, the table of their levels and the number of positions."""

    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    levels: DataFrame  # source_col, category, position
    size: int

    def save(self, path: str) -> None:
        spark = self.levels.sparkSession
        self.levels.write.mode("overwrite").partitionBy("source_col").parquet(f"{path}/levels")
        spark.createDataFrame([(list(self.numeric), list(self.categorical), self.size)],
                              "numeric array<string>, categorical array<string>, size int").write.mode("overwrite").parquet(f"{path}/shape")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "LevelDictionary":
        r = spark.read.parquet(f"{path}/shape").first()
        levels = spark.read.schema("category string, position bigint, source_col string").parquet(f"{path}/levels")
        return cls(tuple(r["numeric"]), tuple(r["categorical"]), levels.select("source_col", "category", "position"), r["size"])


def fit_levels(df: DataFrame, cat_cols: list[str] | None = None, drop_first: bool = True,
               exclude=("EmployeeNumber",)) -> LevelDictionary:
    """The dictionary of ``df``: any number of levels, none of them collected."""
    cats = string_columns(df, exclude) if cat_cols is None else list(cat_cols)
    numeric = [f.name for f in df.schema.fields if f.name not in exclude and f.name not in cats
               and isinstance(f.dataType, (T.NumericType, T.BooleanType))]
    levels = materialize(category_levels(df, cats).withColumn("one", F.lit(1).cast("bigint")))
    counts = {r["source_col"]: r["n"] for r in levels.groupBy("source_col").agg(F.count(F.lit(1)).alias("n")).collect()}
    skip = int(drop_first)
    base, size = {}, len(numeric)  # position of the first kept level of each column
    for c in cats:
        base[c] = size
        size += max(counts.get(c, 0) - skip, 0)
    if size >= 1 << 31:
        raise ValueError(f"{size} positions do not fit one vector")
    if not counts:
        return LevelDictionary(tuple(numeric), tuple(cats), levels.select("source_col", "category", F.col("one").alias("position")), size)
    ranked = running_totals(levels, "category", ["one"], group=["source_col"], materialized=True)
    first = F.create_map(*[x for c in cats for x in (F.lit(c), F.lit(base[c]))])
    placed = ranked.where(F.col("cum_one") > skip).select(
        "source_col", "category", (F.element_at(first, F.col("source_col")) + F.col("cum_one") - 1 - skip).cast("bigint").alias("position"))
    return LevelDictionary(tuple(numeric), tuple(cats), materialize(placed), size)


def encode_arrays(df: DataFrame, d: LevelDictionary, keep=("EmployeeNumber",)) -> DataFrame:
    """``keep`` and the row's positions other than 0: indices (ascending) and values."""
    kept = [k for k in keep if k in df.columns]
    cats = [c for c in d.categorical if c in df.columns]
    numbers = [(i, c) for i, c in enumerate(d.numeric) if c in df.columns]
    # positional names: a frame's own columns may be called anything
    rows = df.select(F.struct(*[_c(k) for k in kept]).alias("kept") if kept else F.lit(None).alias("kept"),
                     *[F.coalesce(_c(c).cast("double"), F.lit(float("nan"))).alias(f"n{i}") for i, c in numbers],
                     *[_c(c).cast("string").alias(f"c{j}") for j, c in enumerate(cats)])
    for j, c in enumerate(cats):
        own = d.levels.where(F.col("source_col") == c).select(F.col("category").alias(f"c{j}"), F.col("position").cast("int").alias(f"p{j}"))
        rows = rows.join(own, f"c{j}", "left")
    pairs = ([F.struct(F.lit(i).alias("at"), F.col(f"n{i}").alias("value")) for i, _ in numbers]
             + [F.struct(F.col(f"p{j}").alias("at"), F.lit(1.0).alias("value")) for j in range(len(cats))])
    pairs = F.filter(F.array(*pairs), lambda x: x["at"].isNotNull() & (x["value"] != 0)) if pairs else F.array().cast(
        "array<struct<at:int,value:double>>")
    found = rows.select("kept", pairs.alias("pairs"))
    return found.select(*[F.col("kept").getField(k).alias(k) for k in kept],
                        F.col("pairs.at").alias("indices"), F.col("pairs.value").alias("values"))


def encode(df: DataFrame, d: LevelDictionary, keep=("EmployeeNumber",), out: str = "features") -> DataFrame:
    """``keep`` and one sparse vector over all positions of the dictionary."""
    size = d.size

    def vectors(indices: pa.Array, values: pa.Array) -> pa.Array:
        n = len(indices)
        return pa.StructArray.from_arrays([pa.array([0] * n, pa.int8()), pa.array([size] * n, pa.int32()), indices, values],
                                          ["type", "size", "indices", "values"])

    arrays = encode_arrays(df, d, keep)
    rest = [c for c in arrays.columns if c not in ("indices", "values")]
    return arrays.select(*[_c(c) for c in rest], F.arrow_udf(vectors, VectorUDT())("indices", "values").alias(out))


def sparse_pipeline(df: DataFrame, d: LevelDictionary | None = None, key="EmployeeNumber", label: str | None = "Attrition"):
    """``features.feature_pipeline`` with sparse vectors: returns (key, label, features) and the dictionary."""
    eng = engineer(df, key=key, label=label)
    if d is None:
        d = fit_levels(eng, exclude=tuple(x for x in (key, "label") if x))
    return encode(eng, d, keep=[k for k in (key, "label") if k in eng.columns]), d
