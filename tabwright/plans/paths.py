"""Penalty paths, designs of many levels and streams scored by a saved model."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tabwright.functions.keys import tidy
from tabwright.operators import curves, encode, linear, metrics, penalty
from tabwright.plans.closed import urgent_flag
from tabwright.plans.encoders import fixed_design, split_campaign
from tabwright.plans.frames import CAMPAIGN_SQL, campaign, sql_hash, sql_tidy
from tabwright.plans.registry import query
from tabwright.session import fresh_path, materialize
from tabwright.sources import tables
from tabwright.sources.models import Decision
from tabwright.streaming import score as streaming

# fixed values: costs of the path, cost of the two compared penalties
COSTS = [0.0001, 0.0003, 0.001, 0.003, 0.01, 0.03, 0.1, 0.3, 1.0, 10.0]
COMPARED = 1.0

# ---- L1 paths ------------------------------------------------------------------------------


def _rows(spark, sf):
    rows = split_campaign(spark, sf)
    design = fixed_design(rows)
    return design, materialize(design.assemble(rows).select("id", "y", "split", vector_to_array("features").alias("x")), "encoded")


@query("l1_path")
def l1_path(spark, sf):
    """Coefficients at zero, size and certificate for every penalty."""
    _, table = _rows(spark, sf)
    return penalty.path_table(spark, penalty.fit_path(table.where("split = 'train'"), COSTS))


@query("penalty_compare")
def penalty_compare(spark, sf):
    """L1 and L2 of one cost on one test split: scores, areas and coefficients at zero."""
    design, table = _rows(spark, sf)
    train, test = table.where("split = 'train'"), table.where("split = 'test'")
    point = penalty.fit_path(train, [COMPARED])[0]
    ridge = linear.fit_logistic(train.withColumn("features", array_to_vector("x")), C=COMPARED)
    sides = {
        "l1": test.select("y", penalty.path_score(point).alias("score")),
        "l2": linear.score_model(ridge, test.select("y", array_to_vector("x").alias("features"))).select("y", "score"),
    }
    both = sides["l1"].select(F.lit("l1").alias("penalty"), "*").unionByName(sides["l2"].select(F.lit("l2").alias("penalty"), "*"))
    both = materialize(both.withColumn("pred", (F.col("score") >= 0.5).cast("int")), "scored")
    zeroed = {"l1": point.zeroed, "l2": int((abs(ridge.coefficients.toArray()) <= 1e-8).sum())}
    named = spark.createDataFrame([(k, n, len(design.names)) for k, n in zeroed.items()], "penalty string, zeroed int, coefficients int")
    found = metrics.binary_scores(both, "y", "pred", 1, ["penalty"], ["accuracy", "precision", "recall", "f1"])
    areas = curves.auc_and_ap(curves.curve_table(both, "y", "score", ["penalty"]), ["penalty"])
    return found.join(areas, "penalty").join(F.broadcast(named), "penalty")


# one indicator: each level's expected positives are its positives less 1 / C, in the direction of the pull
@query("l1_path_closed", f"""
WITH t AS (SELECT y, CAST(priority = '1-URGENT' AS INTEGER) AS u FROM ({CAMPAIGN_SQL})),
a AS (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(u) AS DOUBLE) AS n1, CAST(sum(y) AS DOUBLE) AS p, CAST(sum(u * y) AS DOUBLE) AS p1 FROM t),
c AS (SELECT CAST(unnest([{', '.join(f'{c!r}' for c in COSTS)}]) AS DOUBLE) AS C),
b AS (SELECT *, p1 - n1 * p / n AS pull FROM a, c),
w AS (SELECT *, sign(pull) / C AS off, C * abs(pull) <= 1e0 AS out FROM b),
l AS (SELECT C, out, (p1 - off) / n1 AS r1, (p - p1 + off) / (n - n1) AS r0, p / n AS r FROM w),
m AS (SELECT C, CASE WHEN out THEN 0e0 ELSE ln(greatest(r1, 1e-300) / (1e0 - r1)) - ln(r0 / (1e0 - r0)) END AS urgent,
      CASE WHEN out THEN ln(r / (1e0 - r)) ELSE ln(r0 / (1e0 - r0)) END AS base FROM l)
SELECT C, 'urgent' AS feature, {sql_tidy('urgent', 5)} AS coefficient FROM m UNION ALL
SELECT C, '(intercept)', {sql_tidy('base', 5)} FROM m""")
def l1_path_closed(spark, sf):
    """One indicator: zero up to the critical penalty, shrunk log odds beyond it."""
    rows = materialize(urgent_flag(spark, sf).select("y", F.array("urgent").alias("x")), "rows")
    found = penalty.path_coefficients(spark, penalty.fit_path(rows, COSTS), ["urgent"])
    return found.withColumn("coefficient", tidy(F.col("coefficient"), 5))


_LEVELS = range(25)


@query("l1_critical", f"""
WITH t AS (SELECT nation, y FROM ({CAMPAIGN_SQL})), a AS (SELECT avg(y) AS m FROM t),
g AS (SELECT nation, abs(sum(y - m)) AS pull FROM t, a WHERE nation BETWEEN 0 AND 24 GROUP BY 1)
SELECT {sql_tidy('1e0 / max(pull)', 8)} AS critical, CAST(25 AS BIGINT) AS zeroed_below, true AS used_above FROM g""")
def l1_critical(spark, sf):
    """25 indicators: just below the critical cost all coefficients are zero, above it one is not."""
    flags = F.array(*[(F.col("nation") == k).cast("double") for k in _LEVELS])
    rows = materialize(campaign(spark, sf).select("y", flags.alias("x")), "rows")
    critical = penalty.critical_cost(rows).first()["critical"]
    below, above = penalty.fit_path(rows, [critical * 0.999, critical * 1.2])
    return spark.range(1).select(
        tidy(F.lit(critical), 8).alias("critical"), F.lit(below.zeroed).cast("long").alias("zeroed_below"),
        F.lit(above.zeroed < len(_LEVELS)).alias("used_above"))


# ---- designs of many levels ----------------------------------------------------------------

@query("design_matrix_wide", f"""
WITH l AS (SELECT 'o_custkey' AS col, CAST(o_custkey AS VARCHAR) AS level FROM orders UNION SELECT 'o_orderpriority', o_orderpriority FROM orders),
k AS (SELECT col, level, row_number() OVER (PARTITION BY col ORDER BY {sql_hash('levels', 'level')}, level) AS r FROM l),
n AS (SELECT count(*) AS n FROM k WHERE col = 'o_custkey'), m AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM orders),
c AS (SELECT o_orderkey AS id, 0 AS place, (o_totalprice - m) / s AS value FROM orders, m UNION ALL
      SELECT o_orderkey, r, 1e0 FROM orders JOIN k ON col = 'o_custkey' AND level = CAST(o_custkey AS VARCHAR) UNION ALL
      SELECT o_orderkey, n + r, 1e0 FROM orders JOIN k ON col = 'o_orderpriority' AND level = o_orderpriority, n)
SELECT id, CAST(place AS INTEGER) AS place, {sql_tidy('value')} AS value FROM c""")
def design_matrix_wide(spark, sf):
    """A level per customer: the entries of sparse vectors of that width."""
    rows = tables.read_parquet(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    design = encode.fit_wide_design(rows, ["o_totalprice"], ["o_custkey", "o_orderpriority"])
    cells = F.arrays_zip(F.col("features.indices").alias("at"), F.col("features.values").alias("value"))
    entries = design.packed(rows, "o_orderkey").select(F.col("o_orderkey").alias("id"), F.explode(cells).alias("c"))
    return entries.select("id", F.col("c.at").alias("place"), tidy(F.col("c.value")).alias("value"))


# ---- a stream scored by a saved fit --------------------------------------------------------

@query("score_saved_stream", f"""
WITH t AS (SELECT y, priority = '1-URGENT' AS u FROM ({CAMPAIGN_SQL})), a AS (SELECT avg(y) AS base FROM t),
g AS (SELECT u, avg(y) AS p FROM t GROUP BY 1)
SELECT o_orderkey AS id, {sql_tidy('p', 4)} AS score, CASE WHEN p >= base THEN 'call' ELSE 'leave' END AS verdict
FROM orders JOIN g ON (o_orderpriority = '1-URGENT') = u, a""")
def score_saved_stream(spark, sf):
    """Fit, save model and decision, score arriving orders with what is read back."""
    raw = "SELECT *, CAST(priority = '1-URGENT' AS DOUBLE) AS urgent FROM __THIS__"
    stages = [SQLTransformer(statement=raw), VectorAssembler(inputCols=["urgent"], outputCol="features")]
    train = materialize(campaign(spark, sf).select("priority", "y"), "train")
    fit = LogisticRegression(labelCol="y", regParam=0.0, standardization=False, maxIter=300, tol=1e-9)
    base = train.agg(F.avg("y")).first()[0]
    bundle, sink = fresh_path(spark, "bundle"), fresh_path(spark, "sink")
    streaming.save_bundle(spark, Pipeline(stages=[*stages, fit]).fit(train), Decision(base, "call", "leave"), bundle)
    schema = tables.read_parquet(spark, sf, "orders").schema
    stream = streaming.read_stream(spark, sf, schema, "orders.parquet")
    stream = stream.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("priority"))
    streaming.score_saved_stream(stream, bundle, sink, fresh_path(spark, "stream-state"))
    return spark.read.parquet(sink).select("id", tidy(F.col("score"), 4).alias("score"), "verdict")
