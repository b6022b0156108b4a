"""Feature pipeline: the reference's own 2-row fixture plus vocabulary behaviour."""

import math

import pytest
from pyspark.sql import functions as F

from turnstone.operators import features as fe
from turnstone.operators import levels as lv
from turnstone.operators import model as md
from turnstone.operators import profile as pr

COLS = ["EmployeeNumber", "Attrition", "EmployeeCount", "Over18", "StandardHours", "Gender",
        "TotalWorkingYears", "NumCompaniesWorked", "MonthlyIncome", "Department", "YearsAtCompany",
        "YearsSinceLastPromotion", "YearsWithCurrManager"]
ROWS = [(101, "Yes", 1, "Y", 80, "Male", 10, 2, 5000, "Sales", 5, 2, 2),
        (102, "No", 1, "Y", 80, "Female", 5, 0, 1000, "Research & Development", 2, 0, 1)]


@pytest.fixture()
def two_rows(spark):
    return spark.createDataFrame(ROWS, COLS)


def test_reference_unit_fixture(spark, two_rows):
    out = fe.one_hot(fe.engineer(two_rows, key="EmployeeNumber"))
    rows = {r["EmployeeNumber"]: r.asDict() for r in out.collect()}
    for c in ["EmployeeCount", "Over18", "StandardHours", "Attrition"]:
        assert c not in out.columns
    assert rows[101]["Gender"] == 1.0 and rows[102]["Gender"] == 0.0
    assert rows[101]["YearsPerCompany"] == 5.0 and rows[102]["YearsPerCompany"] == 5.0
    assert rows[101]["Income_Longevity_Interaction"] == 25000.0
    assert rows[101]["Stagnation_Index"] == 1.0
    assert rows[101]["Department_Sales"] == 1.0 and rows[102]["Department_Sales"] == 0.0
    assert "MonthlyIncome_log" in out.columns and "TotalWorkingYears_log" in out.columns
    assert math.isclose(rows[101]["MonthlyIncome_log"], math.log1p(5000))


def test_drop_first_is_lexically_first(spark, two_rows):
    vocab = fe.fit_vocabulary(fe.engineer(two_rows))
    assert "Department_Research & Development" not in vocab.features
    assert "Department_Sales" in vocab.features


def test_single_row_encoding_equals_batch(spark, two_rows):
    """A one-row request encoded with the fitted vocabulary equals its batch row
    (the per-call dummy derivation of the reference would zero it)."""
    vocab = fe.fit_vocabulary(fe.engineer(two_rows))
    batch = fe.apply_vocabulary(fe.engineer(two_rows), vocab).where("EmployeeNumber = 101").collect()[0]
    one = spark.createDataFrame([ROWS[0]], COLS)
    single = fe.apply_vocabulary(fe.engineer(one), vocab).collect()[0]
    assert batch.asDict() == single.asDict()
    # the per-call variant drops the only level present: the dummy vanishes
    assert "Department_Sales" not in fe.one_hot(fe.engineer(one)).columns


def test_missing_columns_are_zero_and_extras_dropped(spark, two_rows):
    vocab = fe.fit_vocabulary(fe.engineer(two_rows))
    partial = fe.engineer(two_rows.drop("MonthlyIncome").withColumn("Extra", F.lit(3)))
    out = fe.apply_vocabulary(partial, vocab)
    assert out.columns == ["EmployeeNumber"] + vocab.features
    assert {r["MonthlyIncome"] for r in out.collect()} == {0.0}


def test_empty_frame_keeps_catalogue_schema(spark, two_rows):
    vocab = fe.fit_vocabulary(fe.engineer(two_rows))
    out = fe.apply_vocabulary(fe.engineer(two_rows.limit(0)), vocab)
    assert out.count() == 0 and out.columns == ["EmployeeNumber"] + vocab.features


def test_vocabulary_guard(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("code"))
    with pytest.raises(ValueError):
        fe.fit_vocabulary(df, ["code"], max_levels=10)


def test_standardise_population_std_and_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    out = fe.standardise(df).collect()
    assert [r["a"] for r in out] == [-1.0, 1.0]
    assert [r["b"] for r in out] == [0.0, 0.0]


def test_category_values_with_dots_assemble(spark):
    from turnstone.operators import model as ml
    df = spark.createDataFrame([(1, "Sr. Manager", 3.0, "No"), (2, "Analyst", 4.0, "Yes"), (3, "a`b", 5.0, "No")],
                               "EmployeeNumber long, JobRole string, MonthlyIncome double, Attrition string")
    frame, vocab = fe.feature_pipeline(df)
    assert "JobRole_Sr. Manager" in vocab.features
    out = ml.assemble(frame, vocab).orderBy("EmployeeNumber").collect()
    idx = vocab.features.index("JobRole_Sr. Manager")
    assert [r["features"][idx] for r in out] == [1.0, 0.0, 0.0]


def test_describe_exact_and_approximate_agree(spark):
    from turnstone.operators.profile import describe
    df = spark.range(1, 1001).select((F.col("id") * 1.5).alias("x"), (F.col("id") % 7).alias("y"))
    exact = {r["column"]: r for r in describe(df, ["x", "y"], exact=True).collect()}
    approx = {r["column"]: r for r in describe(df, ["x", "y"], exact=False).collect()}
    assert exact["x"]["p50"] == 750.75 and exact["x"]["count"] == 1000.0
    for c in ("x", "y"):
        for s in ("p25", "p50", "p75"):
            assert abs(exact[c][s] - approx[c][s]) <= 0.01 * max(1.0, abs(exact[c][s])) + 1.5


def test_describe_keeps_a_column_without_values(spark):
    from turnstone.operators.profile import describe, describe_equality
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    got = {r["column"]: r for r in describe(df, ["a", "b"]).collect()}
    assert got["a"]["p50"] == 1.5 and got["b"]["count"] == 0 and got["b"]["p50"] is None
    assert {r["column"]: r["identical"] for r in describe_equality(df, df, ["a", "b"]).collect()} == {"a": True, "b": True}


def test_only_a_missing_path_means_default(spark, tmp_path):
    import pytest
    from turnstone.operators.model import load_params
    from turnstone.sources import io
    assert io.load_threshold(spark, str(tmp_path / "none"), 0.4) == 0.4
    assert load_params(spark, str(tmp_path / "none")) == {}
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_bytes(b"not parquet at all")
    with pytest.raises(Exception):
        io.load_threshold(spark, str(tmp_path / "bad"))


def test_fallback_for_an_empty_table(spark, tmp_path):
    from turnstone.sources import io
    path = str(tmp_path / "csv")
    io.write_csv(spark.createDataFrame([(1, "x")], "a int, b string"), path)
    spark.createDataFrame([], "a int, b string").createOrReplaceTempView("no_rows")
    assert [tuple(r) for r in io.load_with_fallback(spark, "no_rows", path, "a int, b string").collect()] == [(1, "x")]


def test_full_record_gives_49_features(spark, tmp_path):
    """34 inputs and the target, read as JSON request records with the stated schema."""
    import json
    from turnstone.operators.features import feature_pipeline
    from turnstone.sources import io
    levels = {"BusinessTravel": 3, "Department": 3, "EducationField": 6, "JobRole": 9, "MaritalStatus": 3}
    rows = []
    for i in range(36):
        r = {c: (i * 7 + j) % 40 + 1 for j, c in enumerate(io.INT_FIELDS)}
        r |= {c: f"{c}{i % n}" for c, n in levels.items()}
        r |= {"EmployeeNumber": i, "EmployeeCount": 1, "StandardHours": 80, "Over18": "Y", "Gender": ["Male", "Female"][i % 2],
              "OverTime": ["Yes", "No"][i % 2], "Attrition": ["No", "Yes"][i % 4 == 0]}
        rows.append(json.dumps(r))
    (tmp_path / "records.json").write_text("\n".join(rows))
    df = io.read_json(spark, str(tmp_path / "records.json"), io.EMPLOYEE_SCHEMA)
    assert len(df.columns) == 35
    frame, vocab = feature_pipeline(df)
    assert len(vocab) == 49 and frame.count() == 36
    assert not {"EmployeeNumber", "Attrition", "EmployeeCount", "StandardHours", "Over18"} & set(vocab.features)


def _entries(v, width):
    return {i: x for i, x in enumerate(v.toArray()) if x != 0} | {"size": width}


def test_levels_give_the_dense_catalogue(spark):
    rows = [(i, i % 3 - 1, None if i % 5 == 0 else f"d{i % 4}", "é.`x" if i % 2 else "a b", i % 2 == 0) for i in range(1, 40)]
    df = spark.createDataFrame(rows, "EmployeeNumber int, n int, `d.x` string, c string, b boolean")
    vocab = fe.fit_vocabulary(df)
    d = lv.fit_levels(df)
    other = df.limit(5).unionByName(spark.createDataFrame([(99, 7, "unseen", None, None)], df.schema)).drop("n")
    for frame in (df, other):
        dense = {r["EmployeeNumber"]: r["features"] for r in md.assemble(fe.apply_vocabulary(frame, vocab), vocab).collect()}
        got = {r["EmployeeNumber"]: r["features"] for r in lv.encode(frame, d).collect()}
        assert d.size == len(vocab) and got.keys() == dense.keys()
        for k in got:
            assert got[k].size == len(vocab) and str(got[k].toArray()) == str(dense[k].toArray())
    assert lv.encode(df.limit(0), d).collect() == []
    assert lv.fit_levels(df.limit(0)).size == 2


def test_levels_of_a_million_fit_and_score(spark, tmp_path):
    from pyspark.ml.classification import LogisticRegression
    n = 1_000_000
    df = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), "id")).alias("code"),
                               (F.col("id") % 2).cast("double").alias("x"), (F.col("id") % 2).cast("int").alias("label"))
    d = lv.fit_levels(df, exclude=("id", "label"))
    assert d.size == 1 + (n - (n + 2) // 3)  # x, and every level but the first ("hot")
    d.save(str(tmp_path / "levels"))
    back = lv.LevelDictionary.load(spark, str(tmp_path / "levels"))
    rows = lv.encode(df.where("id < 3000"), back, keep=("id", "label"))
    model = LogisticRegression(maxIter=2, regParam=0.1).fit(rows)
    assert model.numFeatures == d.size
    assert model.transform(rows).where("prediction = label").count() == 3000


def test_frame_equality_counts_and_moves_little(spark):
    a = spark.range(2000).select((F.col("id") % 500).alias("k"), F.when(F.col("id") % 7 != 0, F.col("id") % 3).alias("v"),
                                 F.array(F.when(F.col("id") % 2 == 0, 1), F.lit(2)).alias("l"))
    assert pr.frame_equality(a, a.repartition(5)).first()[:] == (True, 2000, 2000, 0, 0)
    assert pr.differing_buckets(a, a.repartition(5)).where("differs").isEmpty()
    b = a.unionByName(a.where("k = 3").limit(2)).where("k <> 9")
    got = pr.frame_equality(a, b).first()
    want = (True, 2000, b.count(), a.exceptAll(b).count(), b.exceptAll(a).count())
    assert got[:] == want and want[3] > 0 and want[4] > 0
    x = spark.createDataFrame([(None, 1), (0.0, 2)], "p double, q int")
    y = spark.createDataFrame([(1.0, None), (-0.0, 2)], "p double, q int")  # 0.0 and -0.0 are one value
    assert pr.frame_equality(x, y).first()[:] == (True, 2, 2, 1, 1)
    assert pr.frame_equality(x, x.select("q", "p")).first()[:] == (False, 2, 2, 0, 0)
    assert pr.frame_equality(x, x.select("p", F.col("q").cast("bigint").alias("q"))).first()[:] == (False, 2, 2, 0, 0)
    assert pr.frame_equality(x.limit(0), x.limit(0)).first()[:] == (True, 0, 0, 0, 0)


def test_leakage_check_asks_the_fitted_model(spark):
    rows = [(i, "Yes" if i % 3 else "No", float(i), "ab"[i % 2]) for i in range(30)]
    df = spark.createDataFrame(rows, "EmployeeNumber int, Attrition string, x double, c string")
    frame, vocab = fe.feature_pipeline(df)
    model = md.baseline_logistic(md.assemble(frame, vocab).select("features", "label"), max_iter=2)
    assert pr.leakage_check(vocab.to_df(spark), n_model_features=model.numFeatures).first()[:] == (2, 0, True)
    leaky = fe.fit_vocabulary(df.withColumn("Attrition", F.lit(1)), exclude=())
    assert pr.leakage_check(leaky.to_df(spark), n_model_features=model.numFeatures).first()[:] == (4, 2, False)
