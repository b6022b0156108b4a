"""Invariants of the fitted / iterative operators, checked against brute force."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnstone.operators import causal as ca
from turnstone.operators import metrics as me
from turnstone.operators import resample as rs
from turnstone.operators.knn import knn_join
from turnstone.operators.split import fold_column, stratified_split

from conftest import SF_SMALL


def _emb(spark):
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    return e.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"),
                    (F.col("label") < 5).cast("int").alias("label"))


def test_knn_exact_against_numpy(spark):
    df = _emb(spark)
    rows = df.orderBy("id").collect()
    ids = np.array([r["id"] for r in rows])
    X = np.array([r["vec"] for r in rows])
    got = {(r["id"], r["rank"]): r["neighbor_id"] for r in knn_join(df, k=4, cell_target=32).collect()}
    D = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(D, np.inf)
    for i, qid in enumerate(ids):
        order = sorted(range(len(ids)), key=lambda j: (D[i, j], ids[j]))[:4]
        for r, j in enumerate(order, 1):
            assert got[(qid, r)] == ids[j]


def test_smote_parity_and_segments(spark):
    df = _emb(spark)
    up = rs.smote(df, k=5)
    counts = {(r["label"], r["synthetic"]): r["n"] for r in up.groupBy("label", "synthetic").count()
              .withColumnRenamed("count", "n").collect()}
    per_label = {}
    for (lab, _), n in counts.items():
        per_label[lab] = per_label.get(lab, 0) + n
    assert len(set(per_label.values())) == 1  # parity
    plan = rs.smote_plan(df, k=5).collect()
    vec = {r["id"]: np.array(r["vec"]) for r in df.collect()}
    syn = {r["id"]: np.array(r["vec"]) for r in up.where("synthetic").collect()}
    assert len(plan) == len(syn)
    # every synthetic vector lies on the segment base → neighbour at the planned gap
    want = [vec[p["base_id"]] + p["gap"] * (vec[p["neighbor_id"]] - vec[p["base_id"]]) for p in plan]
    got = sorted(map(tuple, syn.values()))
    assert np.allclose(sorted(map(tuple, want)), got)


def test_enn_against_brute_force(spark):
    df = _emb(spark)
    rows = df.orderBy("id").collect()
    ids = [r["id"] for r in rows]
    X = np.array([r["vec"] for r in rows])
    y = [r["label"] for r in rows]
    D = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(D, np.inf)
    want = {}
    for i in range(len(ids)):
        nn = sorted(range(len(ids)), key=lambda j: (D[i, j], ids[j]))[:3]
        want[ids[i]] = any(y[j] != y[i] for j in nn)
    got = {r["id"]: r["removed"] for r in rs.enn_flags(df, k=3).collect()}
    assert got == want


def test_exact_stratified_split_counts(spark):
    df = spark.range(1000).select(F.col("id").alias("EmployeeNumber"), (F.col("id") % 7 == 0).cast("int").alias("label"))
    out = stratified_split(df, exact=True).groupBy("label", "is_test").count().collect()
    got = {(r["label"], r["is_test"]): r["count"] for r in out}
    n1 = 143
    assert got[(1, True)] == round(n1 * 0.2) and got[(0, True)] == round((1000 - n1) * 0.2)


def test_folds_disjoint_and_complete(spark):
    df = fold_column(spark.range(500).select(F.col("id").alias("EmployeeNumber")), k=5)
    folds = [r["fold"] for r in df.collect()]
    assert set(folds) == set(range(5)) and len(folds) == 500


def test_threshold_sweep_brute_force(spark):
    rng = np.random.default_rng(3)
    p = np.round(rng.random(400), 2)  # many values exactly on grid points
    y = (rng.random(400) < p).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(p, y)], "predicted_probability double, label int")
    got = {round(r["threshold"], 2): (r["tp"], r["fp"], r["fn"]) for r in me.threshold_sweep(df).collect()}
    for i in range(99):
        t = 0.01 + i * 0.01
        pred = p >= t
        want = (int((pred & (y == 1)).sum()), int((pred & (y == 0)).sum()), int((~pred & (y == 1)).sum()))
        assert got[round(t, 2)] == want


def test_constant_stub_model_confusion_is_2x2(spark):
    df = spark.createDataFrame([(0.2, 0), (0.2, 1), (0.2, 1)], "predicted_probability double, label int")
    cm = me.confusion_matrix(me.with_prediction(df, 0.5)).collect()
    assert len(cm) == 2 and all(len(r) == 3 for r in cm)


def test_roc_auc_brute_force(spark):
    rng = np.random.default_rng(5)
    p = np.round(rng.random(300), 1)
    y = (rng.random(300) < p).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(p, y)], "predicted_probability double, label int")
    got = me.roc_auc(df).first()["roc_auc"]
    pos, neg = p[y == 1], p[y == 0]
    want = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert math.isclose(got, want, rel_tol=1e-12)


def test_nearest_match_brute_force(spark):
    rng = np.random.default_rng(9)
    n = 300
    s = np.round(rng.random(n), 2)
    t = (rng.random(n) < 0.4).astype(int)
    yv = (rng.random(n) < 0.3).astype(int)
    df = spark.createDataFrame([(i, float(a), int(b), int(c)) for i, (a, b, c) in enumerate(zip(s, t, yv))],
                               "id long, score double, t int, y int")
    got = {r["id"]: r["matched_id"] for r in ca.nearest_match(df, "t", "y", "score", "id", buckets=8).collect()}
    for i in range(n):
        opp = [j for j in range(n) if t[j] != t[i]]
        best = min(opp, key=lambda j: (abs(s[i] - s[j]), j))
        assert got[i] == best


def _tree_value(nodes, x, S, nid=None):
    """Path-dependent conditional expectation E[f | x_S] of one tree."""
    nid = min(nodes) if nid is None else nid
    nd = nodes[nid]
    if nd["left"] < 0:
        return nd["value"]
    go_left = x[nd["feature"]] <= nd["thr"][0]
    if nd["feature"] in S:
        return _tree_value(nodes, x, S, nd["left"] if go_left else nd["right"])
    lw = nodes[nd["left"]]["cover"] / nd["cover"]
    return lw * _tree_value(nodes, x, S, nd["left"]) + (1 - lw) * _tree_value(nodes, x, S, nd["right"])


def test_tree_attributions_equal_brute_force_shapley(spark):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    from turnstone.operators.treeshap import attribute_batch, pack, read_trees

    rng = np.random.default_rng(1)
    X = rng.random((300, 4))
    y = ((X[:, 0] + 0.5 * X[:, 1] * X[:, 2] + 0.1 * rng.random(300)) > 0.7).astype(int)
    df = spark.createDataFrame([(i, *map(float, r), int(l)) for i, (r, l) in enumerate(zip(X, y))],
                               "id long, a double, b double, c double, d double, label int")
    df = VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(df)
    model = GBTClassifier(maxIter=4, maxDepth=3, seed=1).fit(df)
    trees = read_trees(model, spark)
    xs = X[:5]
    base, phi = attribute_batch(xs, pack(trees), 4)
    feats = range(4)
    for r, x in enumerate(xs):
        def v(S):
            return 2 * sum(t["weight"] * _tree_value(t["nodes"], x, set(S)) for t in trees)
        for j in feats:
            others = [k for k in feats if k != j]
            val = 0.0
            for size in range(4):
                for S in itertools.combinations(others, size):
                    w = math.factorial(size) * math.factorial(3 - size) / math.factorial(4)
                    val += w * (v(S + (j,)) - v(S))
            assert math.isclose(phi[r, j], val, abs_tol=1e-9)
        assert math.isclose(base + phi[r].sum(), v(tuple(feats)), abs_tol=1e-9)
        assert math.isclose(base, v(()), abs_tol=1e-9)


def test_knn_with_copy_groups_against_numpy(spark):
    """A third of the rows are copies of one vector: collapsed search must
    still give the exact (distance, id)-ordered neighbours of every row."""
    rng = np.random.default_rng(11)
    a, b = rng.random(6), rng.random(6)
    vecs = [a] * 40 + [b] * 7 + [rng.random(6) for _ in range(73)]
    ids = rng.permutation(10_000)[:len(vecs)]
    df = spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, vecs)], "id long, vec array<double>")
    X = np.array(vecs)
    got = {(r["id"], r["rank"]): r["neighbor_id"] for r in knn_join(df, k=4, cell_target=16).collect()}
    D = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    for i in range(len(ids)):
        order = sorted((j for j in range(len(ids)) if j != i), key=lambda j: (D[i, j], ids[j]))[:4]
        for r, j in enumerate(order, 1):
            assert got[(ids[i], r)] == ids[j]


def _tree_fx(nodes, x, nid=None):
    nid = min(nodes) if nid is None else nid
    nd = nodes[nid]
    if nd["left"] < 0:
        return nd["value"]
    return _tree_fx(nodes, x, nd["left"] if x[nd["feature"]] <= nd["thr"][0] else nd["right"])


def test_background_attributions_equal_brute_force(spark):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    from turnstone.operators.treeshap import interventional_batch, pack, read_trees

    rng = np.random.default_rng(4)
    X = rng.random((300, 4))
    y = ((X[:, 0] * X[:, 3] + 0.3 * X[:, 1] + 0.1 * rng.random(300)) > 0.4).astype(int)
    df = spark.createDataFrame([(i, *map(float, r), int(l)) for i, (r, l) in enumerate(zip(X, y))],
                               "id long, a double, b double, c double, d double, label int")
    df = VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(df)
    model = GBTClassifier(maxIter=3, maxDepth=3, seed=2).fit(df)
    trees = read_trees(model, spark)
    bg = X[10:13]
    xs = X[:4]
    base, phi = interventional_batch(xs, bg, pack(trees), 4)

    def f(z):
        return 2 * sum(t["weight"] * _tree_fx(t["nodes"], z) for t in trees)
    for r, x in enumerate(xs):
        want = np.zeros(4)
        for b in bg:
            def v(S):
                z = np.where([k in S for k in range(4)], x, b)
                return f(z)
            for j in range(4):
                others = [k for k in range(4) if k != j]
                for size in range(4):
                    for S in itertools.combinations(others, size):
                        w = math.factorial(size) * math.factorial(3 - size) / math.factorial(4)
                        want[j] += w * (v(S + (j,)) - v(S)) / len(bg)
        assert np.allclose(phi[r], want, atol=1e-9)
        assert math.isclose(base + phi[r].sum(), f(x), abs_tol=1e-9)


def test_background_of_any_size_is_counted_by_pattern(spark, monkeypatch):
    """A whole frame as background equals its rows as a matrix, also with patterns that are not tabled; a path that tests
    a feature twice and the empty background are covered."""
    from pyspark.ml.functions import array_to_vector

    from turnstone.operators import boosting, treeshap
    rng = np.random.default_rng(6)
    X = rng.random((400, 5)).round(2)
    y = ((X[:, 0] * X[:, 3] + 0.4 * X[:, 1] - 0.2 * X[:, 4]) > 0.35).astype(float)
    df = spark.createDataFrame([(i, 0, [float(v) for v in r], float(l), 1.0, False) for i, (r, l) in enumerate(zip(X, y))],
                               "key long, group int, x array<double>, label double, weight double, held boolean")
    df = df.withColumn("features", array_to_vector("x")).persist()
    cuts = boosting.bin_cuts(df)
    model = boosting.to_model(spark, boosting.boost(df, [boosting.Fit(0, {"n_estimators": 4, "max_depth": 5})], cuts)[0], cuts)
    paths = treeshap.pack(treeshap.read_trees(model, spark))
    want_base, want = treeshap.interventional_batch(X[:40], X, paths, 5)
    slow = np.mean([treeshap.interventional_batch(X[:40], X[i:i + 1], paths, 5)[1] for i in range(400)], axis=0)
    assert np.allclose(want, slow, atol=1e-9)
    monkeypatch.setattr(treeshap, "TABLE_BITS", 2)
    fresh = treeshap.pack(treeshap.read_trees(model, spark))
    assert np.allclose(treeshap.interventional_batch(X[:40], X, fresh, 5)[1], want, atol=1e-12)
    assert np.allclose(treeshap.attribute_batch(X, fresh, 5)[1], treeshap.attribute_batch(X, paths, 5)[1], atol=1e-12)
    monkeypatch.undo()
    got = treeshap.background_attributions(model, df.where("key < 40"), df, key="key").orderBy("key").collect()
    assert np.allclose([[a["shap"] for a in r["attributions"]] for r in got], want, atol=1e-9)
    assert all(math.isclose(r["base_value"], want_base, abs_tol=1e-9) for r in got)
    assert all(math.isclose(r["base_value"] + sum(a["shap"] for a in r["attributions"]), r["margin2"], abs_tol=1e-9) for r in got)
    with pytest.raises(ValueError, match="no rows"):
        treeshap.background_attributions(model, df, df.limit(0), key="key")


def test_knn_between_two_frames_keeps_equal_ids(spark):
    from turnstone.operators.knn import knn_join
    q = spark.createDataFrame([(1, [0.0, 0.0])], "id long, vec array<double>")
    d = spark.createDataFrame([(1, [0.1, 0.0]), (2, [5.0, 5.0])], "id long, vec array<double>")
    assert [(r["neighbor_id"], round(r["distance"], 6)) for r in knn_join(q, d, k=1).collect()] == [(1, 0.1)]


def test_stored_parameters_split_trees(spark):
    from turnstone.operators import model as ml
    from pyspark.ml.feature import VectorAssembler
    df = spark.range(400).selectExpr("id AS EmployeeNumber", "id % 7 AS x", "id % 11 AS y",
                                     "CAST((id % 7 > 3) != (id % 11 > 5) AS double) AS label")
    df = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(df)
    m = ml.fit(df, {"n_estimators": 3, "max_depth": 4, "gamma": 0.327, "min_child_weight": 3}, resample=False)
    assert all(t.numNodes > 5 for t in m.trees)


def test_ranges_grow_with_rows(spark):
    from pyspark.sql import functions as F
    from turnstone.operators import prefix
    df = spark.range(3000).selectExpr("id AS k", "1 AS n")
    few = prefix.range_bucket(df, [F.asc("k")]).agg(F.countDistinct("_bucket")).first()[0]
    old, prefix.ROWS_PER_RANGE = prefix.ROWS_PER_RANGE, 100
    try:
        many = prefix.range_bucket(df, [F.asc("k")])
        assert many.agg(F.countDistinct("_bucket")).first()[0] > few
        assert many.groupBy("_bucket").count().agg(F.max("count")).first()[0] <= 300
        got = prefix.running_totals(df, "k", ["n"], descending=True).where("cum_n <> 3000 - k").count()
    finally:
        prefix.ROWS_PER_RANGE = old
    assert got == 0


def test_stratified_folds_are_level_within_each_label(spark):
    from turnstone.operators.split import stratified_fold_column
    df = spark.range(503).selectExpr("id AS EmployeeNumber", "CAST(id % 29 = 0 AS int) AS label")
    got = stratified_fold_column(df, k=5).groupBy("label", "fold").count().collect()
    for y in (0, 1):
        sizes = [r["count"] for r in got if r["label"] == y]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def _causal(spark, n=600):
    return spark.range(n).selectExpr("id", "pmod(xxhash64(id, 1), 1000) / 1000.0D AS x",
                                     "CAST(pmod(xxhash64(id, 2), 2) AS int) AS t", "CAST(pmod(xxhash64(id, 3), 2) AS int) AS y")


def test_unobserved_cause_starts_at_the_estimate_and_moves_it_up(spark):
    df = _causal(spark)
    plain = ca.psm_effect(df, "t", "y", ["x"], "id").first()["ate"]
    got = {r["strength"]: r["effect"] for r in
           ca.refute_unobserved_common_cause(df, "t", "y", ["x"], "id", strengths=[0.0, 0.6]).collect()}
    assert abs(got[0.0] - plain) < 1e-12 and got[0.6] > plain


def test_null_confounders_leave_the_row_out(spark):
    from pyspark.sql import functions as F
    df = _causal(spark).withColumn("x", F.when(F.col("id") >= 10, F.col("x")))
    got = ca.psm_effect(df, "t", "y", ["x", "absent"], "id").first()
    assert got["n_treated"] + got["n_control"] == 590
    rep = {r["confounder"]: (r["kept"], r["null_rows"]) for r in ca.confounder_report(df, ["x", "absent"]).collect()}
    assert rep == {"x": (True, 10), "absent": (False, None)}


def _newton(x, y, steps=60):
    z = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-z @ b))
        b = b + np.linalg.lstsq(z.T @ (z * (p * (1 - p))[:, None]), z.T @ (y - p), rcond=None)[0]
    return b


def test_grouped_logit_equals_newton_fits(spark):
    from turnstone.operators.logit import fit_groups, with_probability
    r = np.random.default_rng(3)
    rows, want = [], {}
    for g in range(4):
        n = 150 + 50 * g
        x = r.normal(size=(n, 2)) * [1.0, 5_000.0] + [0.0, 80_000.0]
        y = (r.random(n) < 1 / (1 + np.exp(-(0.4 * g - 0.5 + x[:, 0] * (g - 1) + (x[:, 1] - 80_000) / 9_000)))).astype(int)
        want[g] = _newton(np.column_stack([x[:, 0], (x[:, 1] - 80_000) / 5_000]), y)
        rows += [(g, float(a), float(b), int(c), 3.5) for (a, b), c in zip(x, y)]
    df = spark.createDataFrame(rows, "g int, a double, b double, y int, same double").repartition(5)
    got = fit_groups(df, "y", ["a", "b", "same"], "g")
    for g in range(4):
        c0, ca_, cb, cs = got[g]
        assert cs == 0 and np.allclose([c0 + 80_000 * cb, ca_, cb * 5_000], want[g], atol=1e-6)
    scored = with_probability(df, got, ["a", "b", "same"], "g", "p")
    for row in scored.groupBy("g").agg(F.sum("y").alias("y"), F.sum("p").alias("p")).collect():
        assert abs(row["y"] - row["p"]) < 1e-6  # the equation of the intercept


def test_grouped_logit_of_one_class_and_of_separated_rows(spark):
    from turnstone.operators.logit import fit_groups, with_probability
    df = spark.createDataFrame([(0, float(i), 1) for i in range(20)] + [(1, float(i), int(i > 9)) for i in range(20)], "g int, a double, y int")
    scored = with_probability(df, fit_groups(df, "y", ["a"], "g"), ["a"], "g", "p").collect()
    assert all(abs(r["p"] - r["y"]) < 0.01 for r in scored)
    assert fit_groups(df.limit(0), "y", ["a"], "g") == {}


def test_random_cause_repeats_and_averages(spark):
    df = _causal(spark, 400)
    got = ca.refute_random_common_cause(df, "t", "y", ["x"], "id", simulations=12).first()
    plain = ca.psm_effect(df, "t", "y", ["x"], "id").first()["ate"]
    assert abs(got["estimated_effect"] - plain) < 1e-12 and abs(got["new_effect"] - plain) < 0.15 and 0 <= got["p_value"] <= 1
    # each simulation is the plain match with its own random confounder
    u = F.shiftrightunsigned(F.xxhash64("id", F.col("simulation"), F.lit(7)), 11) / F.lit(float(1 << 53))
    one = [ca.psm_effect(df.withColumn("simulation", F.lit(j)).withColumn("u", u), "t", "y", ["x", "u"], "id").first()["ate"] for j in (1, 2)]
    two = ca.refute_random_common_cause(df, "t", "y", ["x"], "id", simulations=2).first()
    assert abs(two["new_effect"] - sum(one) / 2) < 1e-9


def test_attribution_work_per_path_is_a_few_columns():
    """Rows x path features, and never rows x all features or 8-byte patterns, is what a short path costs."""
    from turnstone.operators import treeshap as ts
    r = np.random.default_rng(2)
    X = r.random((500, 6))
    tree = {"weight": 0.5, "nodes": {
        0: {"left": 1, "right": 2, "value": 0.0, "cover": 10.0, "feature": 1, "thr": [0.4], "ncat": -1},
        1: {"left": -1, "right": -1, "value": -1.0, "cover": 4.0, "feature": -1, "thr": [], "ncat": -1},
        2: {"left": 3, "right": 4, "value": 0.0, "cover": 6.0, "feature": 4, "thr": [0.7], "ncat": -1},
        3: {"left": -1, "right": -1, "value": 2.0, "cover": 5.0, "feature": -1, "thr": [], "ncat": -1},
        4: {"left": -1, "right": -1, "value": 0.5, "cover": 1.0, "feature": -1, "thr": [], "ncat": -1}}}
    paths = ts.pack([tree])
    assert all(ts.satisfied(X, p).dtype == np.uint8 for p in paths)
    f = np.where(X[:, 1] <= 0.4, -1.0, np.where(X[:, 4] <= 0.7, 2.0, 0.5))
    for base, phi in (ts.attribute_batch(X, ts.pack([tree]), 6), ts.interventional_batch(X, X[:100], ts.pack([tree]), 6)):
        assert np.allclose(base + phi.sum(axis=1), f) and not phi[:, [0, 2, 3, 5]].any()
    want = sorted((i, int(q), int(n)) for i, p in enumerate(paths) for q, n in zip(*np.unique(ts.satisfied(X, p), return_counts=True)))
    assert sorted(ts.pattern_counts(X, paths)) == want
