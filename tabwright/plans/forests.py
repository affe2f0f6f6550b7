"""Forests of the own grower: 400 trees without a depth limit, and bagged stumps that SQL can state."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.functions.keys import tidy
from tabwright.operators import bayes, curves, encode, forest, linear, trees
from tabwright.plans.closed import urgent_levels
from tabwright.plans.encoders import fixed_design, split_campaign
from tabwright.plans.evaluate import AUC_SQL
from tabwright.plans.frames import CAMPAIGN_SQL, sql_tidy
from tabwright.plans.registry import query
from tabwright.session import materialize

# fixed values: trees of the forest, sizes of the size curve, depth of the tree it is compared with
TREES = 400
SIZES = [10, 20, 50, 100, 150, 200, 300, 400, 500]
TREE_DEPTH = 6


def _encoded(spark, sf):
    rows = split_campaign(spark, sf)
    design = fixed_design(rows, None)
    return design, materialize(design.assemble(rows).select("id", "y", "split", "features"), "encoded")


def _train(df):
    return df.where("split = 'train'")


def _test(df):
    return df.where("split = 'test'")


def _single(scored):
    return scored.withColumn("score", F.element_at("scores", -1))


@query("forest")
def forest_scores(spark, sf):
    _, table = _encoded(spark, sf)
    model = forest.fit_forest(_train(table), n_trees=TREES)
    scored = _single(forest.forest_scores(model, _test(table), ["y"]))
    return scored.select("id", "y", "score", (F.col("score") > 0.5).cast("int").alias("pred"))


@query("oob")
def oob(spark, sf):
    """Out-of-bag accuracy of the forest itself: each row by the trees whose bag misses it."""
    _, table = _encoded(spark, sf)
    train = _train(table)
    model = forest.fit_forest(train, n_trees=TREES)
    votes = _single(forest.forest_scores(model, train, ["y"], out_of_bag=True)).where("trees > 0")
    return trees.oob_score(votes)


@query("ensemble_curve")
def ensemble_curve(spark, sf):
    _, table = _encoded(spark, sf)
    model = forest.fit_forest(_train(table), n_trees=SIZES[-1])
    return forest.size_curve(forest.forest_scores(model, _test(table), ["y"], sizes=SIZES), SIZES)


@query("forest_report")
def forest_report(spark, sf):
    """Majority class, single tree and forest on the same test rows: AUC, AP, out-of-bag accuracy, gain over the tree."""
    _, table = _encoded(spark, sf)
    train, test = _train(table), _test(table)
    model = forest.fit_forest(train, n_trees=TREES)
    # in bag and test rows in one pass over the model
    votes = _single(forest.forest_scores(model, train, ["y"], out_of_bag=True)).where("trees > 0")
    tree = trees.fit_tree(encode.class_weights(train, "y"), max_depth=TREE_DEPTH, weight="weight")
    scored = {
        "majority": bayes.dummy_most_frequent(train, test, "y").select("y", "score"),
        "tree": linear.score_model(tree, test).select("y", "score"),
        "forest": _single(forest.forest_scores(model, test, ["y"])).select("y", "score"),
    }
    parts = [df.select(F.lit(name).alias("model"), "y", F.col("score").cast("double").alias("score")) for name, df in scored.items()]
    long = parts[0].unionByName(parts[1]).unionByName(parts[2])
    areas = curves.auc_and_ap(curves.curve_table(long, "y", "score", ["model"]), ["model"])
    accuracy = trees.oob_score(votes).first()["oob_accuracy"]
    base = {r["model"]: r["roc_auc"] for r in areas.collect()}
    return areas.withColumn("oob_accuracy", F.when(F.col("model") == "forest", F.lit(accuracy))).withColumn(
        "gain_over_tree", F.when(F.col("model") == "forest", F.lit(base["forest"] - base["tree"]))
    )


# ---- bagged stumps over indicators: one cut per tree, bags by hash, so SQL can state them ----

STUMPS = 7
_BAG_SQL = " ".join(f"WHEN u <= {int(cut)} THEN {m}" for m, cut in enumerate(forest._LADDER))
_STUMPS_SQL = f"""
WITH t AS (SELECT id, y, priority AS level FROM ({CAMPAIGN_SQL})),
d AS (SELECT id, y, level, CAST(k AS INTEGER) AS tree, CAST('0x' || substr(md5('bag~0~' || id), CAST(4 * k + 1 AS INTEGER), 4) AS INTEGER) AS u FROM t, range({STUMPS}) r(k)),
b AS (SELECT *, CASE {_BAG_SQL} ELSE 8 END AS n FROM d),
a AS (SELECT tree, sum(n) AS n, sum(n * y) AS p FROM b GROUP BY 1),
g AS (SELECT tree, level, sum(n) AS n1, sum(n * y) AS p1 FROM b GROUP BY 1, 2),
s AS (SELECT tree, level, p1 * (n / (2e0 * p)) AS u1, (n1 - p1) * (n / (2e0 * (n - p))) AS v1,
      (p - p1) * (n / (2e0 * p)) AS u0, (n - n1 - p + p1) * (n / (2e0 * (n - p))) AS v0 FROM g JOIN a USING (tree) WHERE n1 > 0 AND n1 < n),
c AS (SELECT tree, level AS best, u1 / (u1 + v1) AS r1, u0 / (u0 + v0) AS r0 FROM s
      QUALIFY row_number() OVER (PARTITION BY tree ORDER BY (u1 * u1 + v1 * v1) / (u1 + v1) + (u0 * u0 + v0 * v0) / (u0 + v0) DESC) = 1),
v AS (SELECT id, y, tree, n, CASE WHEN level = best THEN r1 ELSE r0 END AS p FROM b JOIN c USING (tree))"""


def _stumps(spark, sf):
    table = urgent_levels(spark, sf)
    return table, forest.fit_forest(table, n_trees=STUMPS, per_node=5, max_depth=1, seed="bag")


@query("bagged_stumps", f"""{_STUMPS_SQL}
SELECT id, y, {sql_tidy('avg(p)')} AS score, {sql_tidy('avg(p) FILTER (WHERE n = 0)')} AS oob_score, count(*) FILTER (WHERE n = 0) AS oob_trees FROM v GROUP BY 1, 2""")
def bagged_stumps(spark, sf):
    """Mean over all trees, and over the trees whose bag misses the row, from one model."""
    table, model = _stumps(spark, sf)
    whole = _single(forest.forest_scores(model, table, ["y"])).select("id", "y", "score")
    held = _single(forest.forest_scores(model, table, [], out_of_bag=True)).select("id", F.col("score").alias("oob_score"), F.col("trees").alias("oob_trees"))
    return whole.join(held, "id").withColumns({c: tidy(F.col(c)) for c in ("score", "oob_score")})


@query("bagged_stumps_oob", f"""{_STUMPS_SQL},
o AS (SELECT id, y, avg(p) AS score FROM v WHERE n = 0 GROUP BY 1, 2)
SELECT {sql_tidy('avg(CAST(CAST(score > 0.5e0 AS INTEGER) = y AS INTEGER))')} AS oob_accuracy, count(*) AS rows FROM o""")
def bagged_stumps_oob(spark, sf):
    table, model = _stumps(spark, sf)
    votes = _single(forest.forest_scores(model, table, ["y"], out_of_bag=True)).where("trees > 0")
    return trees.oob_score(votes).withColumn("oob_accuracy", tidy(F.col("oob_accuracy")))


@query("bagged_stumps_curve", f"""{_STUMPS_SQL},
z AS (SELECT s.s AS n_trees, id, y, round(avg(p), 9) AS score FROM v JOIN (VALUES (1), (3), ({STUMPS})) s(s) ON tree < s.s GROUP BY 1, 2, 3),
e AS (SELECT n_trees, score, count(*) AS n, sum(y) AS pos FROM z GROUP BY 1, 2),
w AS (SELECT *, CAST(sum(n) OVER w AS BIGINT) AS seen, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(n) OVER (PARTITION BY n_trees) AS BIGINT) AS rows,
      CAST(sum(pos) OVER (PARTITION BY n_trees) AS BIGINT) AS positives FROM e WINDOW w AS (PARTITION BY n_trees ORDER BY score DESC))
SELECT n_trees, {sql_tidy(AUC_SQL)} AS roc_auc FROM w GROUP BY 1""")
def bagged_stumps_curve(spark, sf):
    """AUC of the first trees of one model."""
    table, model = _stumps(spark, sf)
    sizes = [1, 3, STUMPS]
    scored = forest.forest_scores(model, table, ["y"], sizes=sizes)
    scored = scored.withColumn("scores", F.transform("scores", lambda s: F.round(s, 9)))
    return forest.size_curve(scored, sizes).select("n_trees", tidy(F.col("roc_auc")).alias("roc_auc"))
