import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabwright.operators import curves, encode, explain, linear, split, trees, tune
from tabwright.sources.models import Decision, load_decision, save_decision
from tabwright.session import fresh_path
from tabwright.streaming import score as streaming


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(400):
        a, b, c = rng.normal(), rng.normal(), "xyz"[rng.integers(3)]
        z = 1.5 * a - 1.0 * b + (0.8 if c == "x" else 0.0)
        rows.append((i, int(z + rng.normal() > 0), float(a), float(b), c))
    df = spark.createDataFrame(rows, "id long, y int, a double, b double, c string").repartition(4)
    design = encode.fit_design(df, ["a", "b"], ["c"], drop="first", ignore=["id", "y"])
    table = design.assemble(df).persist()
    x = np.array([r["features"].toArray() for r in table.orderBy("id").collect()])
    y = np.array([r["y"] for r in table.orderBy("id").collect()])
    return df, design, table, x, y


def _gradient(model, x, y, w, c):
    m = x @ model.coefficients.toArray() + model.intercept
    err = c * w * (1 / (1 + np.exp(-m)) - y)
    return x.T @ err, err.sum()


def test_l2_logistic_is_optimal(data):
    _, _, table, x, y = data
    for c in (0.1, 1.0):
        model = linear.fit_logistic(table, C=c)
        g, g0 = _gradient(model, x, y, 1.0, c)
        assert np.abs(g + model.coefficients.toArray()).max() < 1e-3 and abs(g0) < 1e-3


def test_l1_logistic_meets_its_conditions(spark, data):
    _, design, table, x, y = data
    model = linear.fit_logistic(table, C=0.03, penalty="l1")
    w = model.coefficients.toArray()
    g, g0 = _gradient(model, x, y, 1.0, 0.03)
    assert abs(g0) < 1e-3
    for gi, wi in zip(g, w):
        assert abs(gi + np.sign(wi)) < 1e-3 if wi else abs(gi) <= 1 + 1e-3
    z = linear.zeroed_coefficients(linear.coefficient_table(spark, design.names, model)).first()
    assert (z["zeroed"], z["coefficients"]) == (int((np.abs(w) <= 1e-8).sum()), len(w)) and z["zeroed"] > 0


def test_weighted_logistic_is_optimal(data):
    _, _, table, x, y = data
    model = linear.fit_logistic(encode.class_weights(table, "y"), weight="weight")
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    g, g0 = _gradient(model, x, y, w, 1.0)
    assert np.abs(g + model.coefficients.toArray()).max() < 1e-3 and abs(g0) < 1e-3


def test_svm_objective_beats_perturbations(data):
    _, _, table, x, y = data
    model = linear.fit_linear_svm(table, C=1.0, max_iter=400, tol=1e-10)
    s = 2 * y - 1

    def objective(w, b):
        return 0.5 * w @ w + np.maximum(0, 1 - s * (x @ w + b)).sum()

    w, b = model.coefficients.toArray(), model.intercept
    best, rng = objective(w, b), np.random.default_rng(1)
    for _ in range(200):
        assert best <= objective(w + rng.normal(0, 0.02, len(w)), b + rng.normal(0, 0.02)) * (1 + 2e-3)
    for tol in (0.0, 1e-3):
        census = {r["class"]: r["support"] for r in linear.support_census(linear.margins(model, table), tol=tol).collect()}
        held = s * (x @ w + b) <= 1 + tol
        assert census == {"0": int((held & (y == 0)).sum()), "1": int((held & (y == 1)).sum()), "(total)": int(held.sum())}


def _mapped(table, rows, kernel, gamma, d=2048):
    df = table("id long, x array<double>", [(i, r.tolist()) for i, r in enumerate(rows)], 2)
    return np.array([r["z"] for r in linear.kernel_map(df, kernel, rows.shape[1], gamma, D=d).orderBy("id").collect()])


def test_kernel_maps(table):
    x = np.random.default_rng(2).normal(0, 0.5, (30, 5))
    z = _mapped(table, x, "poly", 0.7)
    assert np.allclose(z @ z.T, (0.7 * x @ x.T) ** 3)
    z = _mapped(table, x, "rbf", 0.4, 8192)
    want = np.exp(-0.4 * ((x[:, None] - x[None]) ** 2).sum(2))
    assert np.abs(z @ z.T - want).max() < 0.06
    wide = np.random.default_rng(3).normal(0, 0.2, (15, 40))
    exact = _mapped(table, wide, "poly", 1.0)
    assert np.allclose(exact @ exact.T, (wide @ wide.T) ** 3)
    z = _mapped(table, wide, "poly_random", 1.0, 16384)
    assert np.abs(z @ z.T - (wide @ wide.T) ** 3).mean() < 0.25


def test_gamma_scale(table):
    x = np.random.default_rng(4).normal(2, 3, (50, 6))
    df = table("x array<double>", [(r.tolist(),) for r in x])
    assert linear.gamma_scale(df) == pytest.approx(1 / (6 * x.var()))


def test_calibration_is_optimal(data):
    _, _, table, _, _ = data
    folded = split.stratified_folds(table, "id", "y", 3)
    held = linear.out_of_fold(folded, linear.fit_linear_svm, linear.margins, 3).select("id", "y", "margin").orderBy("id").collect()
    m, y = np.array([r["margin"] for r in held]), np.array([r["y"] for r in held])
    df = table.sparkSession.createDataFrame([(int(a), float(b)) for a, b in zip(y, m)], "y int, margin double")
    slope, offset = linear.fit_calibration(df)
    t = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    err = 1 / (1 + np.exp(-(slope * m + offset))) - t
    assert len(held) == 400 and slope > 0 and abs((err * m).mean()) < 1e-4 and abs(err.mean()) < 1e-4


def test_odds_and_row_explanations(spark, data):
    df, design, table, x, _ = data
    model = linear.fit_logistic(table)
    odds = explain.odds_ratios(linear.coefficient_table(spark, design.names, model)).collect()
    assert [r["odds_ratio"] for r in odds] == sorted((r["odds_ratio"] for r in odds), reverse=True)
    assert odds[0]["odds_ratio"] == pytest.approx(np.exp(odds[0]["coefficient"]))
    coefs = [float(c) for c in model.coefficients]
    parts = explain.explain_rows(design, coefs, model.intercept, df, "id").groupBy("id").agg(
        F.sum("contribution").alias("m"), F.first("probability").alias("p")).collect()
    margins = x @ np.array(coefs)
    for r in parts:
        assert r["m"] == pytest.approx(margins[r["id"]]) and r["p"] == pytest.approx(1 / (1 + np.exp(-margins[r["id"]] - model.intercept)))


def test_vif_is_the_uncentred_regression(table):
    rng = np.random.default_rng(5)
    x = rng.normal(1, 1, (200, 4))
    x[:, 3] = x[:, 0] + 0.3 * rng.normal(size=200)
    df = table("a double, b double, c double, d double", [tuple(map(float, r)) for r in x])
    got = {r["feature"]: r["vif"] for r in explain.vif(df, ["a", "b", "c", "d"]).collect()}
    for j, name in enumerate("abcd"):
        rest = np.delete(x, j, 1)
        res = x[:, j] - rest @ np.linalg.lstsq(rest, x[:, j], rcond=None)[0]
        assert got[name] == pytest.approx((x[:, j] ** 2).sum() / (res**2).sum())
    both = df.withColumn("e", F.col("a") + F.col("b"))
    out = explain.vif(both, ["a", "b", "c", "e"])
    assert {r["feature"] for r in out.collect() if np.isinf(r["vif"])} == {"a", "b", "e"}
    s = explain.vif_summary(out).first()
    assert s["infinite"] == 3 and np.isfinite(s["vif_max"])


def test_wide_gram_equals_narrow(table):
    x = np.random.default_rng(6).normal(size=(80, 50))
    cols = [f"c{i}" for i in range(50)]
    df = table(", ".join(f"{c} double" for c in cols), [tuple(map(float, r)) for r in x])
    assert np.allclose(explain.gram(df, cols), x.T @ x) and np.allclose(explain.gram(df, cols[:5]), (x.T @ x)[:5, :5])


def test_permutation_importance(data):
    df = data[0].withColumn("flat", F.lit(1.0)).select("id", "y", "a", "b", "flat")

    def scored(d):
        return d.withColumn("score", F.col("a") * 1.5 + 0.0 * F.col("flat"))

    got = {r["column"]: r["importance"] for r in explain.permutation_importance(df, "id", "y", ["a", "b", "flat"], scored, 4).collect()}
    assert got["a"] > 0.1 and got["b"] == pytest.approx(0.0) and got["flat"] == pytest.approx(0.0)
    moved = explain.shuffled_columns(df, "id", ["a"], 1)
    assert sorted(r["a"] for r in moved.collect()) == sorted(r["a"] for r in df.collect())
    assert moved.join(df.select("id", F.col("a").alias("a0")), "id").where("a = a0").count() < 40


def test_rules_score_like_the_tree(spark, data):
    df, design, table, _, _ = data
    model = trees.fit_tree(table, max_depth=4, min_leaf=10)
    paths = trees.tree_paths(model, design, spark)
    want = {r["id"]: r["prediction"] for r in model.transform(table).collect()}
    classes = {leaf: c for leaf, _, _, c in paths}
    got = {r["id"]: classes[r["leaf"]] for r in trees.apply_rules(df, paths).collect()}
    assert got == want
    rules = trees.tree_rules(df, paths).collect()
    assert sum(r["support"] for r in rules) == 400 and all(0 <= r["purity"] <= 1 for r in rules)
    merged = trees.tree_rules(df, paths, merge=True).collect()
    assert sorted(r["class"] for r in merged) == [0, 1] and sum(r["support"] for r in merged) == 400


def test_leaf_votes_rebuild_the_forest(data):
    _, _, table, _, _ = data
    model = trees.fit_forest(table, n_trees=12, max_depth=4)
    votes = trees.tree_votes(model, table, ["id"]).groupBy("id").agg(F.avg("p").alias("p"))
    whole = model.transform(table).select("id", vector_to_array("probability")[1].alias("q"))
    assert votes.join(whole, "id").where(F.abs(F.col("p") - F.col("q")) > 1e-9).count() == 0


def test_cut_trees_equal_trees_of_their_depth(data):
    _, _, table, _, _ = data
    train, test = encode.class_weights(table.where("id % 3 <> 0"), "y"), table.where("id % 3 = 0")
    curve = {r["max_depth"]: (r["train_accuracy"], r["test_accuracy"]) for r in trees.complexity_curve(train, test, (1, 2, 4, 7), weight="weight", min_leaf=3).collect()}
    for depth, both in curve.items():
        model = trees.fit_tree(train, max_depth=depth, weight="weight", min_leaf=3)
        own = [model.transform(d).agg(F.avg((F.col("prediction") == F.col("y")).cast("double"))).first()[0] for d in (train, test)]
        assert both == pytest.approx(own)


def test_importance_and_audit(spark, data):
    _, design, table, _, _ = data
    imp = trees.impurity_importance(trees.fit_forest(table, n_trees=5, max_depth=3), design.name_table(spark))
    assert imp.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    assert {r["source_column"] for r in trees.importance_by_source(imp).collect()} == {"a", "b", "c"}
    assert {r["source_column"] for r in explain.sensitive_audit(imp, ["c"]).collect()} == {"c"}


def test_grid_search_prefers_first_of_tied_points(data):
    _, _, table, _, _ = data
    folded = split.stratified_folds(table, "id", "y", 3)
    res = tune.grid_search(
        folded, lambda d, p: trees.fit_tree(d, max_depth=p["depth"], max_bins=32),
        lambda m, d: m.transform(d).withColumn("pred", F.col("prediction").cast("int")),
        [{"depth": 3}, {"depth": 3}, {"depth": 0}], k=3)
    rows = {r["point"]: r for r in res.collect()}
    assert rows[0]["rank"] == rows[1]["rank"] == 1 and rows[2]["rank"] == 3
    assert tune.best_point(res, ["depth", "point"], ["point"])["point"] == 0


def test_complexity_curve_fits_training_rows_better_with_depth(data):
    _, _, table, _, _ = data
    got = trees.complexity_curve(table.where("id < 300"), table.where("id >= 300"), [1, 6]).collect()
    assert got[1]["train_accuracy"] >= got[0]["train_accuracy"]


def test_decision_roundtrip(spark):
    rule = Decision(0.15, "malignant", "benign")
    path = fresh_path(spark, "d")
    save_decision(spark, rule, path)
    assert load_decision(spark, path) == rule


def test_stream_equals_batch(spark, data):
    from pyspark.ml.classification import LogisticRegression

    df, design, _, _, _ = data
    model = encode.fit_pipeline(design, LogisticRegression(labelCol="y", regParam=0.01), df)
    folder = fresh_path(spark, "inbox")
    df.repartition(5).write.parquet(folder)
    rule = Decision(0.4, "yes", "no")

    def score(d):
        return linear.score_model(model, d).select("id", "score")

    batch = {tuple(r) for r in streaming.score_rows(df, score, rule).collect()}
    stream = streaming.score_available(spark, streaming.read_stream(spark, folder, df.schema), score, rule)
    assert {tuple(r) for r in stream.collect()} == batch
    assert streaming.score_throughput(df, score).first()["rows"] == 400
