"""Fitted models on designs whose solution has a closed form, so that SQL can state it.

The fits are those of the other plans; only the columns are chosen so that the optimum is a
ratio of counts: one indicator for a logistic model, two margin values for a calibration,
one split for a tree, disjoint column pairs for variance inflation.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tabwright.functions.keys import tidy
from tabwright.operators import curves, encode, explain, linear, profile, trees
from tabwright.plans.frames import CAMPAIGN_SQL, SCORED_SQL, VECTORS_SQL, campaign, scored_orders, sql_tidy, vectors
from tabwright.plans.registry import query
from tabwright.session import fresh_path, materialize
from tabwright.sources import tables

# ---- pairwise sums at any width ------------------------------------------------------------

WIDTH = 64


@query("correlation_with_nulls", f"""
WITH v AS ({VECTORS_SQL}), u AS (SELECT id, unnest(range(0, {WIDTH})) AS i, unnest(x) AS v FROM v),
w AS (SELECT id, i, v FROM u WHERE (id + 3 * i) % 5 <> 0)
SELECT 'e' || a.i AS a, 'e' || b.i AS b, {sql_tidy('corr(a.v, b.v)')} AS r FROM w a JOIN w b ON a.id = b.id GROUP BY 1, 2""")
def correlation_with_nulls(spark, sf):
    """Pairwise-complete correlations of 64 columns, a fifth of each null."""
    wide = profile.unpack_vector(vectors(spark, sf), "x", [f"e{i}" for i in range(WIDTH)])
    holed = wide.select("id", *[F.when((F.col("id") + 3 * i) % 5 != 0, F.col(f"e{i}")).alias(f"e{i}") for i in range(WIDTH)])
    return profile.correlation_matrix(holed, [f"e{i}" for i in range(WIDTH)]).withColumn("r", tidy(F.col("r")))


def _nation_pairs(spark, sf):
    """Per nation an indicator and a price beside it: pairs of different nations are orthogonal."""
    rows = campaign(spark, sf).select("nation", F.when(F.col("id") % 7 != 0, F.col("price") / 1e5).alias("price"))
    names, cols = [], []
    for k in range(25):
        here = F.col("nation") == k
        names += [f"in_{k}", f"price_{k}"]
        cols += [here.cast("double").alias(f"in_{k}"), F.when(here, F.col("price")).otherwise(0.0).alias(f"price_{k}")]
    return rows.select(*cols), names


_WIDE_VIF = f"""
WITH t AS (SELECT nation, CASE WHEN id % 7 <> 0 THEN price / 1e5 END AS p FROM ({CAMPAIGN_SQL})),
g AS (SELECT nation, count(*) AS n, sum(p) AS s, sum(p * p) AS q FROM t GROUP BY 1),
k AS (SELECT CAST(range AS INTEGER) AS k FROM range(25)),
v AS (SELECT k, coalesce(1e0 / (1e0 - s * s / (n * q)), 1e0) AS vif FROM k LEFT JOIN g ON nation = k),
w AS (SELECT 'in_' || k AS feature, vif FROM v UNION ALL SELECT 'price_' || k, vif FROM v)"""


@query("vif_wide", f"{_WIDE_VIF} SELECT feature, {sql_tidy('vif')} AS vif FROM w")
def vif_wide(spark, sf):
    """50 columns with nulls in half of them."""
    rows, names = _nation_pairs(spark, sf)
    return explain.vif(rows, names).withColumn("vif", tidy(F.col("vif")))


@query("vif_summary", f"""{_WIDE_VIF} SELECT {sql_tidy('max(vif)')} AS vif_max, CAST(0 AS BIGINT) AS infinite,
CAST(sum(CAST(vif > 5e0 AS BIGINT)) AS BIGINT) AS above_limit FROM w""")
def vif_summary(spark, sf):
    rows, names = _nation_pairs(spark, sf)
    return explain.vif_summary(explain.vif(rows, names), 5.0).withColumn("vif_max", tidy(F.col("vif_max")))


@query("kernel_poly_exact", f"""
WITH v AS ({VECTORS_SQL}), p AS (SELECT a.id AS id, a.x[1:6] AS x, b.x[1:6] AS y FROM v a JOIN v b ON b.id = a.id + 1)
SELECT id, {sql_tidy("pow(0.5e0 * list_dot_product(x, y), 3)")} AS k FROM p""")
def kernel_poly_exact(spark, sf):
    """Dot products of mapped neighbours in id order equal the degree-3 kernel."""
    six = vectors(spark, sf).select("id", F.slice("x", 1, 6).alias("x"))
    mapped = materialize(linear.kernel_map(six, "poly", 6, 0.5).select("id", "z"), "mapped")
    after = mapped.select((F.col("id") - 1).alias("id"), F.col("z").alias("w"))
    dot = F.aggregate(F.zip_with("z", "w", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    return mapped.join(after, "id").select("id", tidy(dot).alias("k"))


# ---- logistic and calibration --------------------------------------------------------------

def urgent_flag(spark, sf):
    return campaign(spark, sf).select("id", "y", (F.col("priority") == "1-URGENT").cast("double").alias("urgent"))


def _urgent(spark, sf):
    rows = urgent_flag(spark, sf)
    return materialize(VectorAssembler(inputCols=["urgent"], outputCol="features").transform(rows), "urgent")


_TWO_BY_TWO = f"""
WITH c AS (SELECT sum(u * y) AS a, sum(u * (1 - y)) AS b, sum((1 - u) * y) AS c, sum((1 - u) * (1 - y)) AS d
FROM (SELECT y, CAST(priority = '1-URGENT' AS INTEGER) AS u FROM ({CAMPAIGN_SQL})))"""


@query("odds_ratio_closed", f"""{_TWO_BY_TWO}
SELECT 'urgent' AS feature, {sql_tidy('ln(CAST(a AS DOUBLE) * d / (CAST(b AS DOUBLE) * c))', 3)} AS coefficient,
       {sql_tidy('CAST(a AS DOUBLE) * d / (CAST(b AS DOUBLE) * c)', 2)} AS odds_ratio FROM c""")
def odds_ratio_closed(spark, sf):
    """One indicator without penalty: the coefficient is the log of the cross-product ratio."""
    model = linear.fit_logistic(_urgent(spark, sf), C=1e6)
    odds = explain.odds_ratios(linear.coefficient_table(spark, ["urgent"], model))
    return odds.select("feature", tidy(F.col("coefficient"), 3).alias("coefficient"), tidy(F.col("odds_ratio"), 2).alias("odds_ratio"))


@query("logistic_closed", f"""
WITH t AS (SELECT id, y, priority = '1-URGENT' AS u FROM ({CAMPAIGN_SQL})),
g AS (SELECT u, avg(y) AS p FROM t GROUP BY 1) SELECT id, y, {sql_tidy('p', 4)} AS score FROM t JOIN g USING (u)""")
def logistic_closed(spark, sf):
    """One indicator without penalty: scores are the class shares of its two levels."""
    table = _urgent(spark, sf)
    scored = linear.score_model(linear.fit_logistic(table, C=1e6), table)
    return scored.select("id", "y", tidy(F.col("score"), 4).alias("score"))


@query("logistic_weighted_closed", f"""{_TWO_BY_TWO},
f AS (SELECT *, (a + b + c + d) / (2e0 * (a + c)) AS wp, (a + b + c + d) / (2e0 * (b + d)) AS wn FROM c)
SELECT 1e0 AS urgent, {sql_tidy('a * wp / (a * wp + b * wn)', 4)} AS score FROM f UNION ALL
SELECT 0e0, {sql_tidy('c * wp / (c * wp + d * wn)', 4)} FROM f""")
def logistic_weighted_closed(spark, sf):
    """Balanced weights: scores are the weighted class shares of the two levels."""
    table = _urgent(spark, sf)
    model = linear.fit_logistic(encode.class_weights(table, "y"), C=1e6, weight="weight")
    return linear.score_model(model, table).groupBy("urgent").agg(tidy(F.avg("score"), 4).alias("score"))


@query("calibrate_closed", f"""
WITH s AS ({SCORED_SQL}), n AS (SELECT count(*) FILTER (WHERE y = 1) AS p, count(*) FILTER (WHERE y = 0) AS q FROM s),
t AS (SELECT pred, CASE WHEN y = 1 THEN (p + 1e0) / (p + 2e0) ELSE 1e0 / (q + 2e0) END AS t FROM s, n)
SELECT pred, {sql_tidy('avg(t)', 4)} AS score FROM t GROUP BY 1""")
def calibrate_closed(spark, sf):
    """Two margin values: the sigmoid meets the mean smoothed target at both."""
    rows = materialize(scored_orders(spark, sf).select("pred", "y", (F.col("pred") - 0.5).alias("margin")), "margins")
    slope, offset = linear.fit_calibration(rows)
    return rows.groupBy("pred").agg(tidy(F.avg(linear.calibrated(slope, offset)), 4).alias("score"))


@query("support_census_fixed", f"""
WITH s AS (SELECT CAST(y AS VARCHAR) AS class, CASE WHEN y = 1 THEN 1e0 ELSE -1e0 END * (4e0 * score - 2e0) <= 1.0005e0 AS held FROM ({SCORED_SQL})),
g AS (SELECT class, count(*) AS rows, count(*) FILTER (WHERE held) AS support FROM s GROUP BY 1
UNION ALL SELECT '(total)', count(*), count(*) FILTER (WHERE held) FROM s)
SELECT class, rows, support, {sql_tidy('CAST(support AS DOUBLE) / rows')} AS share FROM g""")
def support_census_fixed(spark, sf):
    """Rows on or inside the margin of fixed margins, many of them exactly on it."""
    rows = scored_orders(spark, sf).withColumn("margin", 4.0 * F.col("score") - 2.0)
    return linear.support_census(rows, tol=0.0005).withColumn("share", tidy(F.col("share")))


# ---- trees of one split --------------------------------------------------------------------

# balanced weights, so that the two leaves predict different classes and are not merged
_STUMP_SQL = f"""
WITH t AS (SELECT id, y, priority AS level FROM ({CAMPAIGN_SQL})),
g AS (SELECT level, count(*) AS n1, sum(y) AS p1 FROM t GROUP BY 1), a AS (SELECT count(*) AS n, sum(y) AS p FROM t),
s AS (SELECT level, n1, n - n1 AS n0, p1, p - p1 AS p0, p1 * (n / (2e0 * p)) AS u1, (n1 - p1) * (n / (2e0 * (n - p))) AS v1,
      (p - p1) * (n / (2e0 * p)) AS u0, (n - n1 - p + p1) * (n / (2e0 * (n - p))) AS v0 FROM g, a),
b AS (SELECT *, u1 / (u1 + v1) AS r1, u0 / (u0 + v0) AS r0 FROM s ORDER BY u1 * v1 / (u1 + v1) + u0 * v0 / (u0 + v0), level LIMIT 1)"""


def urgent_levels(spark, sf):
    """(id, y, features): one indicator per order priority."""
    rows = materialize(campaign(spark, sf).select("id", "y", "priority"), "rows")
    design = encode.fit_design(rows, [], ["priority"], ignore=["id", "y"])
    return materialize(design.assemble(rows).select("id", "y", "features"), "encoded")


def _stump(spark, sf):
    rows = materialize(campaign(spark, sf).select("id", "y", "priority"), "rows")
    design = encode.fit_design(rows, [], ["priority"], ignore=["id", "y"])
    table = materialize(design.assemble(rows).select("id", "y", "features"), "encoded")
    return rows, design, table, trees.fit_tree(encode.class_weights(table, "y"), max_depth=1, weight="weight")


@query("tree_stump", f"""{_STUMP_SQL}
SELECT id, y, {sql_tidy('CASE WHEN t.level = b.level THEN r1 ELSE r0 END')} AS score FROM t, b""")
def tree_stump(spark, sf):
    """Best single split over indicators by Gini gain; scores are the weighted shares of its leaves."""
    _, _, table, model = _stump(spark, sf)
    return linear.score_model(model, table).select("id", "y", tidy(F.col("score")).alias("score"))


@query("importance_by_source", f"""{_STUMP_SQL}
SELECT 'cat__priority_' || g.level AS feature, 'priority' AS source_column, CASE WHEN g.level = b.level THEN 1e0 ELSE 0e0 END AS importance,
       1e0 AS of_source FROM g, b""")
def importance_by_source(spark, sf):
    """Impurity importance per feature and summed per source column."""
    _, design, _, model = _stump(spark, sf)
    found = trees.impurity_importance(model, design.name_table(spark))
    sums = trees.importance_by_source(found).withColumnRenamed("importance", "of_source")
    return found.join(sums, "source_column").select("feature", "source_column", "importance", "of_source")


_RULES_SQL = f"""{_STUMP_SQL},
l AS (SELECT 0 AS leaf, 'cat__priority_' || level || ' <= 0.50' AS words, n0 AS n, p0 AS p, r0 AS r FROM b UNION ALL
      SELECT 1, 'cat__priority_' || level || ' > 0.50', n1, p1, r1 FROM b),
c AS (SELECT *, CASE WHEN r > 0.5e0 THEN 1 ELSE 0 END AS class FROM l),
r AS (SELECT leaf, 'IF ' || words || ' THEN class ' || class AS rule, class, CAST(n AS BIGINT) AS support,
      {sql_tidy('CASE WHEN class = 1 THEN p ELSE n - p END * 1e0 / n')} AS purity FROM c)"""


def _rules(spark, sf):
    _, design, table, model = _stump(spark, sf)
    placed = trees.leaf_numbers(model, table)
    return trees.tree_rules(placed, trees.tree_paths(model, design, spark), leaf="leaf").withColumn("purity", tidy(F.col("purity")))


@query("stump_rules", f"{_RULES_SQL} SELECT leaf, rule, class, support, purity FROM r")
def stump_rules(spark, sf):
    return _rules(spark, sf)


@query("stump_rules_text", f"{_RULES_SQL} SELECT rule FROM r")
def stump_rules_text(spark, sf):
    """Rules exported as text and read back."""
    path = fresh_path(spark, "rules")
    tables.write_rules(_rules(spark, sf), path)
    return spark.read.text(path).withColumnRenamed("value", "rule")


def _best_level(source, out, name):
    """Best single indicator by weighted Gini inside ``source``: its level and the class of both sides."""
    return f"""{name}g AS (SELECT level, sum(wp) AS a, sum(wn) AS b FROM {source} GROUP BY 1), {name}a AS (SELECT sum(wp) AS p, sum(wn) AS q FROM {source}),
{out} AS (SELECT level, CAST(a > b AS INTEGER) AS yes, CAST(p - a > q - b AS INTEGER) AS no FROM {name}g, {name}a
ORDER BY (a * a + b * b) / (a + b) + ((p - a) * (p - a) + (q - b) * (q - b)) / (p - a + q - b) DESC, level LIMIT 1)"""


_DEPTHS_SQL = f"""
WITH t AS (SELECT id, y, priority AS level, id % 4 = 0 AS held FROM ({CAMPAIGN_SQL})),
n AS (SELECT count(*) AS n, sum(y) AS p FROM t WHERE NOT held),
f AS (SELECT level, y * (n / (2e0 * p)) AS wp, (1 - y) * (n / (2e0 * (n - p))) AS wn FROM t, n WHERE NOT held),
{_best_level('f', 'b1', 'x')}, r AS (SELECT f.* FROM f, b1 WHERE f.level <> b1.level), {_best_level('r', 'b2', 'z')},
s AS (SELECT held, y, CASE WHEN t.level = b1.level THEN b1.yes ELSE b1.no END AS d1,
      CASE WHEN t.level = b1.level THEN b1.yes WHEN t.level = b2.level THEN b2.yes ELSE b2.no END AS d2 FROM t, b1, b2)"""


@query("complexity_closed", f"""{_DEPTHS_SQL} """ + " UNION ALL ".join(
    f"SELECT {d} AS max_depth, {sql_tidy(f'avg(CAST(d{d} = y AS INTEGER)) FILTER (WHERE NOT held)')} AS train_accuracy, "
    f"{sql_tidy(f'avg(CAST(d{d} = y AS INTEGER)) FILTER (WHERE held)')} AS test_accuracy FROM s" for d in (1, 2)))
def complexity_closed(spark, sf):
    """Depths 1 and 2 over disjoint indicators, cut from one tree."""
    table = urgent_levels(spark, sf)
    train = encode.class_weights(table.where("id % 4 <> 0"), "y")
    curve = trees.complexity_curve(train, table.where("id % 4 = 0"), (1, 2), weight="weight")
    return curve.withColumns({c: tidy(F.col(c)) for c in ("train_accuracy", "test_accuracy")})


# ---- ranking beyond what one heap holds ----------------------------------------------------

@query("top_k_ranked", f"""
SELECT id, score FROM (SELECT id, CASE WHEN id % 3 <> 0 THEN score END AS score FROM ({SCORED_SQL}))
ORDER BY score DESC NULLS LAST, id LIMIT (SELECT count(*) * 4 // 5 FROM orders)""")
def top_k_ranked(spark, sf):
    """Four fifths of all rows through global ranks; a third of the scores are null and come last."""
    rows = scored_orders(spark, sf).select("id", F.when(F.col("id") % 3 != 0, F.col("score")).alias("score"))
    return curves.top_k(rows, "id", "score", rows.count() * 4 // 5, heap=0)
