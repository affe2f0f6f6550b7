"""Feature preparation, fixed-score pipelines and explanation tables on orders and customers."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from tabwright.functions.keys import POISSON_CDF, tidy
from tabwright.operators import bayes, clean, encode, explain, profile, score, split, tune
from tabwright.plans.evaluate import AP_SQL, AUC_SQL
from tabwright.plans.frames import CAMPAIGN_SQL, VECTORS_SQL, campaign, orders, sql_split, sql_tidy, sql_uniform, vectors
from tabwright.plans.registry import query
from tabwright.session import fresh_path, materialize
from tabwright.sources import models, tables
from tabwright.sources.models import Decision
from tabwright.streaming import score as streaming

_SPLIT = f"t AS ({CAMPAIGN_SQL}), s AS ({sql_split('t')}), f AS (SELECT * FROM s WHERE split = 'train')"


def split_campaign(spark, sf):
    # the join is run once; the split itself is a projection over the written table
    return split.stratified_split(materialize(campaign(spark, sf), "campaign"), "id", "y")


def _train(rows):
    return rows.where("split = 'train'")


@query("median_impute", f"""
WITH p AS (SELECT p_partkey AS id, nullif(p_size, 1) AS size, p_retailprice AS price, CAST(p_brand = 'Brand#1' AS INTEGER) AS y FROM part),
s AS ({sql_split('p')}), m AS (SELECT median(size) AS ms, median(price) AS mp FROM s WHERE split = 'train')
SELECT id, {sql_tidy('coalesce(size, ms)')} AS size, {sql_tidy('coalesce(price, mp)')} AS price FROM s, m""")
def median_impute(spark, sf):
    part = tables.read_parquet(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_size").alias("size"), F.col("p_retailprice").alias("price"),
        (F.col("p_brand") == "Brand#1").cast("int").alias("y"))
    rows = split.stratified_split(clean.sentinel_to_null(part, ["size"], 1), "id", "y")
    filled = encode.median_impute(_train(rows), rows, ["size", "price"])
    return filled.select("id", tidy(F.col("size")).alias("size"), tidy(F.col("price")).alias("price"))


@query("impute_scale", f"""
WITH {_SPLIT}, m AS (SELECT avg(price) AS mp, stddev_pop(price) AS sp, avg(balance) AS mb, stddev_pop(balance) AS sb FROM f)
SELECT id, {sql_tidy('(price - mp) / sp')} AS price, {sql_tidy('(balance - mb) / sb')} AS balance FROM s, m""")
def impute_scale(spark, sf):
    rows = split_campaign(spark, sf)
    scaled = encode.standardize(_train(rows), rows, ["price", "balance"])
    return scaled.select("id", tidy(F.col("price")).alias("price"), tidy(F.col("balance")).alias("balance"))


_LEVELS = """lv AS (SELECT 'priority' AS c, priority AS l, row_number() OVER (ORDER BY priority) AS pos FROM (SELECT DISTINCT priority FROM f)
UNION ALL SELECT 'nation', CAST(nation AS VARCHAR), row_number() OVER (ORDER BY nation) FROM (SELECT DISTINCT nation FROM f))"""
_LONG_CATS = "(SELECT id, 'priority' AS c, priority AS l FROM s UNION ALL SELECT id, 'nation', CAST(nation AS VARCHAR) FROM s)"


@query("one_hot", f"WITH {_SPLIT}, {_LEVELS} SELECT id, lv.c || '_' || lv.l AS feature FROM {_LONG_CATS} x JOIN lv ON x.c = lv.c AND x.l = lv.l")
def one_hot(spark, sf):
    rows = split_campaign(spark, sf)
    return encode.one_hot_long(_train(rows), rows, "id", ["priority", "nation"])


@query("one_hot_drop_first", f"WITH {_SPLIT}, {_LEVELS} SELECT id, lv.c || '_' || lv.l AS feature FROM {_LONG_CATS} x JOIN lv ON x.c = lv.c AND x.l = lv.l WHERE pos > 1")
def one_hot_drop_first(spark, sf):
    rows = split_campaign(spark, sf)
    return encode.one_hot_long(_train(rows), rows, "id", ["priority", "nation"], drop="first")


def fixed_design(rows, drop="first"):
    return encode.fit_design(
        _train(rows), numeric=["price", "balance"], categorical=["priority", "segment"], drop=drop,
        ignore=["id", "y", "split", "status", "nation"])


# the levels of the generated tables, in order: fixed values used by the SQL twins
_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_FEATURE_SQL = (
    [(f"cat__priority_{p}", "priority", f"CASE WHEN priority = '{p}' THEN 1e0 ELSE 0e0 END") for p in _PRIORITIES[1:]]
    + [(f"cat__segment_{p}", "segment", f"CASE WHEN segment = '{p}' THEN 1e0 ELSE 0e0 END") for p in _SEGMENTS[1:]]
    + [("num__price", "price", "(price - mp) / sp"), ("num__balance", "balance", "(balance - mb) / sb")]
)
_DESIGN_SQL = f"""
{_SPLIT}, m AS (SELECT avg(price) AS mp, stddev_pop(price) AS sp, avg(balance) AS mb, stddev_pop(balance) AS sb FROM f),
x AS (SELECT s.*, {', '.join(f'{q} AS x{i}' for i, (_, _, q) in enumerate(_FEATURE_SQL))} FROM s, m)"""


@query("design_matrix", f"WITH {_DESIGN_SQL} " + " UNION ALL ".join(
    f"SELECT id, '{n}' AS feature, {sql_tidy(f'x{i}')} AS value FROM x" for i, (n, _, _) in enumerate(_FEATURE_SQL)))
def design_matrix(spark, sf):
    rows = split_campaign(spark, sf)
    long = fixed_design(rows).long(rows, "id")
    return long.withColumn("value", tidy(F.col("value")))


@query("feature_names", f"""
WITH {_SPLIT}, a AS (SELECT 0 AS block, 'cat__priority_' || l AS feature, 'priority' AS source_column, l FROM (SELECT DISTINCT priority AS l FROM f)
UNION ALL SELECT 1, 'cat__segment_' || l, 'segment', l FROM (SELECT DISTINCT segment AS l FROM f)
UNION ALL SELECT 2, 'num__price', 'price', '0' UNION ALL SELECT 2, 'num__balance', 'balance', '1')
SELECT CAST(row_number() OVER (ORDER BY block, l) - 1 AS INTEGER) AS idx, feature, source_column FROM a""")
def feature_names(spark, sf):
    return fixed_design(split_campaign(spark, sf), drop=None).name_table(spark)


# a linear scorer that depends on no fit: fixed values, one weight per feature of the design
FIXED_INTERCEPT = -0.4
FIXED_WEIGHTS = [-0.9, -1.0, -1.1, -1.2, 0.05, 0.1, -0.05, 0.02, 1.5, 0.3]
_MARGIN_SQL = f"{FIXED_INTERCEPT}e0 " + " ".join(f"+ {w}e0 * x{i}" for i, w in enumerate(FIXED_WEIGHTS))


@query("saved_linear_scores", f"WITH {_DESIGN_SQL} SELECT id, {sql_tidy(f'1e0 / (1e0 + exp(-({_MARGIN_SQL})))')} AS score FROM x")
def saved_linear_scores(spark, sf):
    rows = split_campaign(spark, sf)
    design = fixed_design(rows)
    margin = f"{FIXED_INTERCEPT!r}D " + " ".join(f"+ {w!r}D * {f.sql}" for f, w in zip(design.features, FIXED_WEIGHTS))
    scorer = SQLTransformer(statement=f"SELECT *, 1.0D / (1.0D + exp(-({margin}))) AS score FROM __THIS__")
    path = fresh_path(spark, "pipeline")
    models.save_pipeline(PipelineModel([*design.stages(), scorer]), path)
    return models.load_pipeline(path).transform(rows).select("id", tidy(F.col("score")).alias("score"))


@query("explain_rows", f"WITH {_DESIGN_SQL}, p AS (SELECT *, 1e0 / (1e0 + exp(-({_MARGIN_SQL}))) AS prob FROM x) " + " UNION ALL ".join(
    f"SELECT id, '{n}' AS feature, {sql_tidy(f'x{i}')} AS value, {sql_tidy(f'x{i} * {w}e0')} AS contribution, {sql_tidy('prob')} AS probability FROM p WHERE x{i} <> 0"
    for i, ((n, _, _), w) in enumerate(zip(_FEATURE_SQL, FIXED_WEIGHTS))))
def explain_rows(spark, sf):
    rows = split_campaign(spark, sf)
    out = explain.explain_rows(fixed_design(rows), FIXED_WEIGHTS, FIXED_INTERCEPT, rows, "id")
    return out.withColumns({c: tidy(F.col(c)) for c in ("value", "contribution", "probability")})


@query("class_weights", f"""
WITH t AS ({CAMPAIGN_SQL}) SELECT id, y, {sql_tidy('(SELECT count(*) FROM t) / CAST(2 * count(*) OVER (PARTITION BY y) AS DOUBLE)')} AS weight FROM t""")
def class_weights(spark, sf):
    rows = encode.class_weights(campaign(spark, sf), "y")
    return rows.select("id", "y", tidy(F.col("weight")).alias("weight"))


_CDF_SQL = " ".join(f"WHEN u <= {b!r}e0 THEN {m}" for m, b in enumerate(POISSON_CDF))


@query("bag_weights", f"""
WITH t AS ({CAMPAIGN_SQL}), b AS (SELECT id, y, tree, CAST(CASE {_CDF_SQL} ELSE 8 END AS INTEGER) AS bag FROM (
  SELECT id, y, CAST(k AS INTEGER) AS tree, {sql_uniform('bag', 'k', 'id')} AS u FROM t, range(3) r(k))),
c AS (SELECT tree, y, sum(bag) AS n FROM b GROUP BY 1, 2)
SELECT b.id AS id, b.y AS y, b.tree AS tree, bag, {sql_tidy('bag * (sum(n) OVER (PARTITION BY b.tree, b.id) / (2e0 * max(CASE WHEN c.y = b.y THEN n END) OVER (PARTITION BY b.tree, b.id)))')} AS weight
FROM b JOIN c ON b.tree = c.tree QUALIFY c.y = b.y""")
def bag_weights(spark, sf):
    rows = encode.bag_weights(campaign(spark, sf), "id", "y", 3)
    return rows.withColumn("weight", tidy(F.col("weight")))


# ---- explanation tables with closed forms ------------------------------------------------

def _g(a, b):
    return f"sum(CAST({a} AS DOUBLE) * {b})"


@query("vif_small", f"""
WITH t AS (SELECT price / 1e5 AS a, balance / 1e3 AS b, CAST(nation AS DOUBLE) AS c FROM ({CAMPAIGN_SQL})),
g AS (SELECT {_g('a', 'a')} AS aa, {_g('a', 'b')} AS ab, {_g('a', 'c')} AS ac, {_g('b', 'b')} AS bb, {_g('b', 'c')} AS bc, {_g('c', 'c')} AS cc FROM t),
d AS (SELECT *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) AS det FROM g)
SELECT 'price' AS feature, {sql_tidy('aa * (bb * cc - bc * bc) / det')} AS vif FROM d UNION ALL
SELECT 'balance', {sql_tidy('bb * (aa * cc - ac * ac) / det')} FROM d UNION ALL
SELECT 'nation', {sql_tidy('cc * (aa * bb - ab * ab) / det')} FROM d""")
def vif_small(spark, sf):
    rows = campaign(spark, sf).select(
        (F.col("price") / 1e5).alias("price"), (F.col("balance") / 1e3).alias("balance"), F.col("nation").cast("double").alias("nation"))
    return explain.vif(rows, ["price", "balance", "nation"]).withColumn("vif", tidy(F.col("vif")))


@query("vif_encoded")
def vif_encoded(spark, sf):
    rows = split_campaign(spark, sf)
    design = fixed_design(rows)
    return explain.vif(design.columns(_train(rows)), design.names)


_PERM_COLS = ["price", "balance", "priority"]
_FIXED_RAW = """round(1e0 * price / 500000e0 + 0.1e0 * balance / 10000e0 + CASE WHEN priority = '1-URGENT' THEN 0.6e0 ELSE 0e0 END, 4)"""


def _fixed_raw(df):
    raw = F.col("price") / 500000.0 + 0.1 * F.col("balance") / 10000.0 + F.when(F.col("priority") == "1-URGENT", 0.6).otherwise(0.0)
    return df.withColumn("score", F.round(raw, 4))


_PERM_SQL = f"""
WITH t AS (SELECT id, price, balance, priority, y FROM ({CAMPAIGN_SQL})),
b AS (SELECT *, row_number() OVER (ORDER BY md5('perm~base~' || id), id) AS r FROM t),
k AS (SELECT c, CAST(n AS INTEGER) AS rep FROM (VALUES ('price'), ('balance'), ('priority')) v(c), range(3) q(n)),
d AS (SELECT c, rep, price, balance, priority, row_number() OVER (PARTITION BY c, rep ORDER BY md5('perm~' || c || '~' || rep || '~' || id)) AS r FROM t, k),
p AS (SELECT d.c AS c, d.rep AS rep, b.y AS y, CASE WHEN c = 'price' THEN d.price ELSE b.price END AS price,
      CASE WHEN c = 'balance' THEN d.balance ELSE b.balance END AS balance, CASE WHEN c = 'priority' THEN d.priority ELSE b.priority END AS priority
      FROM b JOIN d ON b.r = d.r),
z AS (SELECT c, rep, y, {_FIXED_RAW} AS score FROM p UNION ALL SELECT 'whole', 0, y, {_FIXED_RAW} FROM t),
e AS (SELECT c, rep, score, count(*) AS n, sum(y) AS pos FROM z GROUP BY 1, 2, 3),
cu AS (SELECT *, CAST(sum(n) OVER w AS BIGINT) AS seen, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(pos) OVER (PARTITION BY c, rep) AS BIGINT) AS positives
       FROM e WINDOW w AS (PARTITION BY c, rep ORDER BY score DESC)),
ap AS (SELECT c, rep, {AP_SQL} AS ap FROM cu GROUP BY 1, 2)
SELECT c AS "column", {sql_tidy("avg((SELECT ap FROM ap WHERE c = 'whole') - ap)")} AS importance,
       {sql_tidy("stddev_pop((SELECT ap FROM ap WHERE c = 'whole') - ap)")} AS std FROM ap WHERE c <> 'whole' GROUP BY c"""


@query("permutation_importance_fixed", _PERM_SQL)
def permutation_importance_fixed(spark, sf):
    rows = materialize(campaign(spark, sf).select("id", "price", "balance", "priority", "y"), "perm")
    out = explain.permutation_importance(rows, "id", "y", _PERM_COLS, _fixed_raw, repeats=3)
    return out.withColumns({c: tidy(F.col(c)) for c in ("importance", "std")})


_ABL_WITH = ["priority", "segment", "band"]


def _ablation_sql():
    cte = f"""
WITH {_SPLIT}, b AS (SELECT id, y, split, priority, segment, CASE WHEN price > 350000e0 THEN 'over' ELSE 'under' END AS band FROM s),
lt AS (SELECT id, y, split, 'priority=' || priority AS term, 0 AS leak FROM b UNION ALL SELECT id, y, split, 'segment=' || segment, 0 FROM b
       UNION ALL SELECT id, y, split, 'band=' || band, 1 FROM b),
x AS (SELECT variant, lt.* FROM lt JOIN (VALUES ('with', 1), ('without', 0)) v(variant, most) ON leak <= most),
st AS (SELECT variant, term, count(*) FILTER (WHERE y = 0) AS s0, count(*) FILTER (WHERE y = 1) AS s1 FROM x WHERE split = 'train' GROUP BY 1, 2),
tt AS (SELECT variant, sum(s0) AS t0, sum(s1) AS t1, count(*) AS v FROM st GROUP BY 1),
pr AS (SELECT ln(count(*) FILTER (WHERE y = 1) / CAST(count(*) FILTER (WHERE y = 0) AS DOUBLE)) AS p FROM s WHERE split = 'train'),
m AS (SELECT variant, id, x.y AS y, round(1e0 / (1e0 + exp(-(p + sum((ln(s1 + 1e0) - ln(t1 + v)) - (ln(s0 + 1e0) - ln(t0 + v)))))), 9) AS score
      FROM x JOIN st USING (variant, term) JOIN tt USING (variant), pr WHERE split = 'test' GROUP BY variant, id, x.y, p),
d AS (SELECT variant, score, count(*) AS n, sum(y) AS pos FROM m GROUP BY 1, 2),
c AS (SELECT *, CAST(sum(n) OVER w AS BIGINT) AS seen, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(n) OVER (PARTITION BY variant) AS BIGINT) AS rows,
      CAST(sum(pos) OVER (PARTITION BY variant) AS BIGINT) AS positives FROM d WINDOW w AS (PARTITION BY variant ORDER BY score DESC)),
a AS (SELECT variant, {AUC_SQL} AS auc FROM c GROUP BY 1)"""
    return f"{cte} SELECT variant, {sql_tidy('auc')} AS roc_auc, {sql_tidy('max(auc) OVER () - auc')} AS gap FROM a"


@query("leak_ablation", _ablation_sql())
def leak_ablation(spark, sf):
    rows = split_campaign(spark, sf).withColumn("band", F.when(F.col("price") > 350000.0, "over").otherwise("under"))

    def scored(cols):
        terms = F.explode(F.array(*[F.concat(F.lit(f"{c}="), F.col(c)) for c in cols])).alias("term")
        values = rows.select("id", "y", "split", terms, F.lit(1.0).alias("value"))
        model = bayes.fit_multinomial_nb(_train(values), _train(rows), "y", 1.0)
        out = bayes.nb_scores(model, rows.where("split = 'test'").select("id", "y"), values.where("split = 'test'"))
        return out.withColumn("score", F.round("score", 9))

    gaps = tune.ablation({"with": scored(_ABL_WITH), "without": scored(["priority", "segment"])})
    return gaps.withColumns({c: tidy(F.col(c)) for c in ("roc_auc", "gap")})


# ---- scoring -----------------------------------------------------------------------------

_EVENT_WEIGHTS = {"value": 0.04, "user": -0.01}
_EVENT_SQL = "1e0 / (1e0 + exp(-(-2e0 + 0.04e0 * value + -0.01e0 * CAST(user_id AS DOUBLE))))"


def score_event(df):
    ready = df.withColumn("user", F.col("user_id").cast("double"))
    return score.score_linear(ready, -2.0, _EVENT_WEIGHTS).select("event_id", "score")


@query("score_fixed", f"SELECT event_id, {sql_tidy(_EVENT_SQL)} AS score FROM events")
def score_fixed(spark, sf):
    return score_event(tables.read_parquet(spark, sf, "events")).withColumn("score", tidy(F.col("score")))


@query("score_stream", f"SELECT event_id, {sql_tidy(_EVENT_SQL)} AS score, CASE WHEN {_EVENT_SQL} >= 0.3e0 THEN 'act' ELSE 'wait' END AS verdict FROM events")
def score_stream(spark, sf):
    schema = tables.read_parquet(spark, sf, "events").schema
    stream = streaming.read_stream(spark, sf, schema, "events.parquet")
    out = streaming.score_available(spark, stream, score_event, Decision(0.3, "act", "wait"))
    return out.withColumn("score", tidy(F.col("score")))


@query("score_throughput")
def score_throughput(spark, sf):
    return streaming.score_throughput(tables.read_parquet(spark, sf, "events"), score_event)


@query("wide_correlation", f"""
WITH v AS ({VECTORS_SQL}), u AS (SELECT id, unnest(range(0, 64)) AS i, unnest(x) AS v FROM v)
SELECT 'e' || a.i AS a, 'e' || b.i AS b, {sql_tidy('corr(a.v, b.v)')} AS r FROM u a JOIN u b ON a.id = b.id GROUP BY 1, 2""")
def wide_correlation(spark, sf):
    names = [f"e{i}" for i in range(64)]
    wide = profile.unpack_vector(vectors(spark, sf), "x", names)
    return profile.correlation_matrix(wide, names).withColumn("r", tidy(F.col("r")))


@query("schema_guard", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def schema_guard(spark, sf):
    roles = clean.Roles(
        id="o_orderkey", label="o_orderstatus", numeric=("o_totalprice",), categorical=("o_orderpriority",),
        drop=("o_custkey", "o_orderdate"))
    return clean.check_declared(orders(spark, sf), roles).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
