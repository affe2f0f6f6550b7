"""Iterative models on the planted label, the embeddings and the labelled texts.

Their parameters come from an optimiser, so there is no SQL twin; tests check optimality,
invariants and agreement of derived tables with the model.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabwright.operators import clean, encode, explain, linear, metrics, neighbors, score, split, text, trees, tune
from tabwright.plans.encoders import fixed_design, split_campaign
from tabwright.plans.frames import labelled_documents, vectors
from tabwright.plans.registry import query
from tabwright.session import fresh_path, materialize, release
from tabwright.sources import models, tables

KERNELS = ["linear", "rbf", "poly_random"]
# fixed values: trees of explained and ranked forests, of the leak comparison; the reference has no depth limit
TREES, LEAK_TREES, DEPTH, BINS = 400, 200, 10, 128


def _encoded(spark, sf, drop="first"):
    rows = split_campaign(spark, sf)
    design = fixed_design(rows, drop)
    table = materialize(design.assemble(rows).select("id", "y", "split", "features"), "encoded")
    return rows, design, table


def _train(df):
    return df.where("split = 'train'")


def _test(df):
    return df.where("split = 'test'")


@query("logistic_l2")
def logistic_l2(spark, sf):
    _, _, table = _encoded(spark, sf)
    model = linear.fit_logistic(_train(table))
    return linear.score_model(model, _test(table)).select("id", "y", "score", "pred")


@query("logistic_l1")
def logistic_l1(spark, sf):
    _, design, table = _encoded(spark, sf)
    return linear.coefficient_table(spark, design.names, linear.fit_logistic(_train(table), C=0.05, penalty="l1"))


@query("zeroed_coefficients")
def zeroed_coefficients(spark, sf):
    return linear.zeroed_coefficients(logistic_l1(spark, sf))


@query("logistic_weighted")
def logistic_weighted(spark, sf):
    _, _, table = _encoded(spark, sf)
    weighted = encode.class_weights(_train(table), "y")
    model = linear.fit_logistic(weighted, weight="weight")
    scored = linear.score_model(model, _test(table))
    return metrics.binary_scores(scored, "y", "pred", 1)


@query("logistic_text")
def logistic_text(spark, sf):
    """Logistic regression on unit-length tf-idf of one- and two-word terms."""
    docs = materialize(clean.dedup_rows(labelled_documents(spark, sf), ["text"], "id"), "texts")
    docs = split.stratified_split(docs, "id", "y")
    counts = materialize(text.term_counts(docs, "id", "text", 1, 2, keep=["split"]), "counts")
    idf = text.fit_idf(_train(counts), _train(docs).count())
    release(spark)
    table = text.term_vectors(docs.select("id", "y", "split"), text.tfidf(counts, idf), idf)
    model = linear.fit_logistic(_train(table), C=1.0, max_iter=1000, tol=1e-6)
    return linear.score_model(model, _test(table)).select("id", "y", "score", "pred")


@query("odds_ratios")
def odds_ratios(spark, sf):
    _, design, table = _encoded(spark, sf)
    return explain.odds_ratios(linear.coefficient_table(spark, design.names, linear.fit_logistic(_train(table))))


@query("saved_logistic_scores")
def saved_logistic_scores(spark, sf):
    from pyspark.ml.classification import LogisticRegression

    rows = split_campaign(spark, sf)
    est = LogisticRegression(labelCol="y", regParam=0.001, standardization=False)
    path = fresh_path(spark, "logistic")
    models.save_pipeline(encode.fit_pipeline(fixed_design(rows), est, _train(rows)), path)
    return linear.score_model(models.load_pipeline(path), _test(rows)).select("id", "y", "score", "pred")


# ---- margins -----------------------------------------------------------------------------

def _vector_table(spark, sf):
    rows = split.stratified_split3(vectors(spark, sf), "id", "y")
    scaled = neighbors.scale_arrays(_train(rows), rows)
    weighted = encode.class_weights(_train(scaled), "y").select("id", "weight")
    return scaled.join(weighted, "id", "left")


@query("svm_linear")
def svm_linear(spark, sf):
    _, _, table = _encoded(spark, sf)
    model = linear.fit_linear_svm(_train(table))
    return linear.margins(model, _test(table)).select("id", "y", "margin")


@query("svm_kernel_map")
def svm_kernel_map(spark, sf):
    table = _vector_table(spark, sf)
    gamma = linear.gamma_scale(_train(table))
    mapped = materialize(linear.kernel_map(table, "rbf", 64, gamma).select("id", "y", "split", "weight", array_to_vector("z").alias("features")), "mapped")
    model = linear.fit_linear_svm(_train(mapped), weight="weight")
    return linear.margins(model, mapped.where("split = 'val'")).select("id", "y", "margin")


@query("kernel_compare")
def kernel_compare(spark, sf):
    table = materialize(_vector_table(spark, sf), "scaled")
    gamma = linear.gamma_scale(_train(table))
    parts = []
    for kernel in KERNELS:
        mapped = linear.kernel_map(table, kernel, 64, gamma).select(
            "id", "y", "split", "weight", array_to_vector("z").alias("features"))
        mapped = materialize(mapped, f"map-{kernel}")
        model = linear.fit_linear_svm(_train(mapped), weight="weight")
        held = linear.margins(model, mapped.where("split = 'val'"))
        parts.append(held.select(F.lit(kernel).alias("kernel"), "y", (F.col("margin") > 0).cast("int").alias("pred")))
    long = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return metrics.binary_scores(long, "y", "pred", 0, ["kernel"], ["recall"])


def _calibration(spark, sf):
    _, _, table = _encoded(spark, sf)
    folded = materialize(split.stratified_folds(_train(table), "id", "y", 5, "folds"), "folded")
    held = linear.out_of_fold(folded, linear.fit_linear_svm, linear.margins, 5)
    slope, offset = linear.fit_calibration(materialize(held.select("id", "y", "margin"), "held"))
    return table, slope, offset


@query("calibrate")
def calibrate(spark, sf):
    table, slope, offset = _calibration(spark, sf)
    model = linear.fit_linear_svm(_train(table))
    return linear.margins(model, _test(table)).select("id", "y", "margin", linear.calibrated(slope, offset).alias("score"))


@query("support_census")
def support_census(spark, sf):
    _, _, table = _encoded(spark, sf)
    model = linear.fit_linear_svm(_train(table))
    return linear.support_census(linear.margins(model, _train(table)))


# ---- trees -------------------------------------------------------------------------------

def _tree(spark, sf):
    rows, design, table = _encoded(spark, sf, drop=None)
    weighted = encode.class_weights(_train(table), "y")
    return rows, design, trees.fit_tree(weighted, max_depth=4, min_leaf=30, weight="weight")


@query("tree_scores")
def tree_scores(spark, sf):
    _, _, table = _encoded(spark, sf, drop=None)
    model = trees.fit_tree(encode.class_weights(_train(table), "y"), max_depth=6, weight="weight")
    return linear.score_model(model, _test(table)).select("id", "y", "score", "pred")


@query("tree_rules")
def tree_rules(spark, sf):
    rows, design, model = _tree(spark, sf)
    placed = trees.leaf_numbers(model, design.assemble(_train(rows)))
    return trees.tree_rules(placed, trees.tree_paths(model, design, spark), leaf="leaf")


@query("rules_text")
def rules_text(spark, sf):
    path = fresh_path(spark, "rules")
    tables.write_rules(tree_rules(spark, sf), path)
    return spark.read.text(path).withColumnRenamed("value", "rule")


@query("tree_grid")
def tree_grid(spark, sf):
    _, _, table = _encoded(spark, sf, drop=None)
    folded = split.stratified_folds(encode.class_weights(_train(table), "y"), "id", "y", 5, "folds")
    grid = [{"impurity": i, "max_depth": d, "min_leaf": m} for i in ("gini", "entropy") for d in (3, 4, 5, 6) for m in (10, 20, 30)]
    return tune.grid_search(
        materialize(folded, "folded"),
        lambda d, p: trees.fit_tree(d, impurity=p["impurity"], max_depth=p["max_depth"], min_leaf=p["min_leaf"], weight="weight", max_bins=64),
        lambda m, d: m.transform(d).withColumn("pred", F.col("prediction").cast("int")),
        grid, scorer="f1", positive=1)


@query("complexity_curve")
def complexity_curve(spark, sf):
    _, _, table = _encoded(spark, sf, drop=None)
    return trees.complexity_curve(encode.class_weights(_train(table), "y"), _test(table), weight="weight")


def _forest(spark, sf, n_trees, max_depth, max_bins):
    rows, design, table = _encoded(spark, sf, drop=None)
    weighted = encode.class_weights(_train(table), "y")
    return rows, design, table, trees.fit_forest(weighted, n_trees=n_trees, max_depth=max_depth, weight="weight", max_bins=max_bins)


@query("importance")
def importance(spark, sf):
    _, design, _, model = _forest(spark, sf, TREES, DEPTH, BINS)
    return trees.impurity_importance(model, design.name_table(spark), 15)


@query("sensitive_audit")
def sensitive_audit(spark, sf):
    _, design, _, model = _forest(spark, sf, TREES, DEPTH, BINS)
    return explain.sensitive_audit(trees.impurity_importance(model, design.name_table(spark)), ["segment", "priority"])


@query("leak_ablation_forest")
def leak_ablation_forest(spark, sf):
    """The same forest with and without the column that gives the label away."""
    rows = split_campaign(spark, sf)
    variants = {}
    for name, numeric in (("with", ["price", "balance"]), ("without", ["balance"])):
        design = encode.fit_design(
            _train(rows), numeric, ["priority", "segment"], ignore=["id", "y", "split", "status", "nation", "price"])
        table = materialize(design.assemble(rows).select("id", "y", "split", "features"), name)
        model = trees.fit_forest(_train(table), n_trees=LEAK_TREES, max_depth=DEPTH, max_bins=BINS)
        variants[name] = linear.score_model(model, _test(table))
    return tune.ablation(variants)


@query("permutation_importance_forest")
def permutation_importance_forest(spark, sf):
    rows, design, _, model = _forest(spark, sf, TREES, DEPTH, BINS)
    held = materialize(_test(rows), "held")

    def scored(df):
        return linear.score_model(model, design.assemble(df))

    return explain.permutation_importance(held, "id", "y", ["price", "balance", "priority", "segment"], scored, repeats=10)


@query("ranked_forest_list")
def ranked_forest_list(spark, sf):
    """Call list from out-of-fold forest scores: no row is scored by a model that saw it."""
    rows, _, table = _encoded(spark, sf, drop=None)
    folded = materialize(split.stratified_folds(table.drop("split"), "id", "y", 3, "folds"), "folded")
    held = linear.out_of_fold(
        folded, lambda d: trees.fit_forest(d, n_trees=TREES, max_depth=DEPTH, max_bins=BINS), linear.score_model, 3)
    base = rows.withColumn("score", F.lit(0.0)).drop("split")
    return score.ranked_export(base, "id", "score", 5000, out_of_fold=held.select("id", "score"))
