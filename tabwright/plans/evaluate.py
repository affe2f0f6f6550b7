"""Metrics, curves, thresholds and ranked output on a fixed scorer over orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.functions.keys import hash_uniform, tidy
from tabwright.operators import curves, decide, metrics, score
from tabwright.plans.frames import SCORED_SQL, scored_orders, sql_tidy, sql_uniform
from tabwright.plans.registry import query
from tabwright.session import fresh_path
from tabwright.sources import tables


def _tidied(df, *cols):
    return df.withColumns({c: tidy(F.col(c)) for c in cols})


_RATIO = "CASE WHEN {d} = 0 THEN 0e0 ELSE CAST({n} AS DOUBLE) / {d} END"


def _r(n, d):
    return _RATIO.format(n=f"({n})", d=f"({d})")


_CELLS = """SELECT count(*) FILTER (WHERE y = {p} AND pred = {p}) AS tp, count(*) FILTER (WHERE y <> {p} AND pred = {p}) AS fp,
count(*) FILTER (WHERE y = {p} AND pred <> {p}) AS fn, count(*) FILTER (WHERE y <> {p} AND pred <> {p}) AS tn FROM """
_SCORE_SQL = {
    "accuracy": _r("tp + tn", "tp + tn + fp + fn"),
    "precision": _r("tp", "tp + fp"),
    "recall": _r("tp", "tp + fn"),
    "f1": _r("2 * tp", "2 * tp + fp + fn"),
    "f2": _r("5e0 * tp", "5e0 * tp + 4e0 * fn + fp"),
    "f1_weighted": f"((tp + fn) * ({_r('2 * tp', '2 * tp + fp + fn')}) + (tn + fp) * ({_r('2 * tn', '2 * tn + fn + fp')})) / (tp + fp + fn + tn)",
}


def _scores_sql(positive, names=tuple(_SCORE_SQL)):
    cols = ", ".join(f"{sql_tidy(_SCORE_SQL[n])} AS {n}" for n in names)
    return f"SELECT {cols} FROM ({_CELLS.format(p=positive)} ({SCORED_SQL}))"


@query("confusion", f"""
SELECT g.y AS y, g.pred AS pred, count(s.id) AS n FROM (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(y, pred)) g
LEFT JOIN ({SCORED_SQL}) s ON s.y = g.y AND s.pred = g.pred GROUP BY 1, 2""")
def confusion(spark, sf):
    return metrics.confusion_matrix(scored_orders(spark, sf), "y", "pred", [0, 1])


@query("accuracy", _scores_sql(1, ["accuracy"]))
def accuracy(spark, sf):
    return _tidied(metrics.binary_scores(scored_orders(spark, sf), "y", "pred", 1, names=["accuracy"]), "accuracy")


@query("precision_recall_f1", _scores_sql(0, ["precision", "recall", "f1"]))
def precision_recall_f1(spark, sf):
    names = ["precision", "recall", "f1"]
    return _tidied(metrics.binary_scores(scored_orders(spark, sf), "y", "pred", 0, names=names), *names)


@query("fbeta", _scores_sql(0, ["f2"]))
def fbeta(spark, sf):
    return _tidied(metrics.binary_scores(scored_orders(spark, sf), "y", "pred", 0, names=["f2"]), "f2")


@query("f1_weighted", _scores_sql(1, ["f1_weighted"]))
def f1_weighted(spark, sf):
    return _tidied(metrics.binary_scores(scored_orders(spark, sf), "y", "pred", 1, names=["f1_weighted"]), "f1_weighted")


@query("scorers", _scores_sql(1))
def scorers(spark, sf):
    return _tidied(metrics.binary_scores(scored_orders(spark, sf), "y", "pred", 1), *metrics.SCORERS)


REPORT_SQL = f"""
, cls AS (SELECT CAST(c AS VARCHAR) AS class, count(*) FILTER (WHERE y = c AND pred = c) AS tp, count(*) FILTER (WHERE y = c) AS support,
       count(*) FILTER (WHERE pred = c) AS called FROM s, (SELECT DISTINCT y AS c FROM s UNION SELECT DISTINCT pred FROM s) GROUP BY c),
m AS (SELECT class, {_r('tp', 'called')} AS p, {_r('tp', 'support')} AS r, {_r('2 * tp', 'called + support')} AS f, support, tp FROM cls),
u AS (SELECT class, p, r, f, support FROM m
UNION ALL SELECT 'accuracy', sum(tp) / CAST(sum(support) AS DOUBLE), sum(tp) / CAST(sum(support) AS DOUBLE),
       sum(tp) / CAST(sum(support) AS DOUBLE), sum(support) FROM m
UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM m
UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support), sum(f * support) / sum(support), sum(support) FROM m)
SELECT class, {sql_tidy('p')} AS precision, {sql_tidy('r')} AS recall, {sql_tidy('f')} AS f1, CAST(support AS BIGINT) AS support FROM u"""


def tidy_report(df):
    return _tidied(df, "precision", "recall", "f1")


@query("report", f"WITH s AS ({SCORED_SQL}) {REPORT_SQL}")
def report(spark, sf):
    return tidy_report(metrics.classification_report(scored_orders(spark, sf), "y", "pred"))


# ---- curves ------------------------------------------------------------------------------

CURVE_SQL = """
, d AS (SELECT score, count(*) AS n, sum(y) AS pos FROM s GROUP BY score),
c AS (SELECT *, CAST(sum(n) OVER w AS BIGINT) AS seen, CAST(sum(pos) OVER w AS BIGINT) AS tp,
             CAST(sum(n) OVER () AS BIGINT) AS rows, CAST(sum(pos) OVER () AS BIGINT) AS positives
      FROM d WINDOW w AS (ORDER BY score DESC))"""
AUC_SQL = "sum((n - pos) * (tp - pos + pos / 2e0)) / CAST(max(positives * (rows - positives)) AS DOUBLE)"
AP_SQL = "sum(pos / CAST(positives AS DOUBLE) * (tp / CAST(seen AS DOUBLE)))"
_PR = f"score AS threshold, {_r('tp', 'seen')} AS precision, {_r('tp', 'positives')} AS recall"


@query("roc_auc", f"WITH s AS ({SCORED_SQL}) {CURVE_SQL} SELECT {sql_tidy(AUC_SQL)} AS roc_auc FROM c")
def roc_auc(spark, sf):
    return _tidied(curves.roc_auc(curves.curve_table(scored_orders(spark, sf), "y", "score")), "roc_auc")


@query("average_precision", f"WITH s AS ({SCORED_SQL}) {CURVE_SQL} SELECT {sql_tidy(AP_SQL)} AS average_precision FROM c")
def average_precision(spark, sf):
    return _tidied(curves.average_precision(curves.curve_table(scored_orders(spark, sf), "y", "score")), "average_precision")


@query("roc_curve", f"""
WITH s AS ({SCORED_SQL}) {CURVE_SQL}
SELECT score AS threshold, {sql_tidy(_r('seen - tp', 'rows - positives'))} AS fpr, {sql_tidy(_r('tp', 'positives'))} AS tpr FROM c
UNION ALL SELECT CAST('inf' AS DOUBLE), 0e0, 0e0""")
def roc_curve(spark, sf):
    return _tidied(curves.roc_curve(curves.curve_table(scored_orders(spark, sf), "y", "score")), "fpr", "tpr")


@query("pr_curve", f"""
WITH s AS ({SCORED_SQL}) {CURVE_SQL}
SELECT threshold, {sql_tidy('precision')} AS precision, {sql_tidy('recall')} AS recall FROM (SELECT {_PR} FROM c)
UNION ALL SELECT CAST(NULL AS DOUBLE), 1e0, 0e0""")
def pr_curve(spark, sf):
    return _tidied(curves.pr_curve(curves.curve_table(scored_orders(spark, sf), "y", "score")), "precision", "recall")


@query("gain_curve", f"""
WITH s AS ({SCORED_SQL})
SELECT row_number() OVER w AS position, {sql_tidy('row_number() OVER w / CAST(count(*) OVER () AS DOUBLE)')} AS share_contacted,
       {sql_tidy('sum(y) OVER w / CAST(sum(y) OVER () AS DOUBLE)')} AS share_captured
FROM s WINDOW w AS (ORDER BY score DESC, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def gain_curve(spark, sf):
    gain = curves.cumulative_gain(scored_orders(spark, sf), "y", "id", "score")
    return _tidied(gain, "share_contacted", "share_captured")


@query("gain_deciles", f"""
WITH s AS ({SCORED_SQL}), g AS (SELECT row_number() OVER w AS position, sum(y) OVER w AS captured, count(*) OVER () AS n, sum(y) OVER () AS p
FROM s WINDOW w AS (ORDER BY score DESC, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT position, {sql_tidy('position / CAST(n AS DOUBLE)')} AS share_contacted, {sql_tidy('captured / CAST(p AS DOUBLE)')} AS share_captured
FROM g WHERE floor(position * 10 / CAST(n AS DOUBLE)) > floor((position - 1) * 10 / CAST(n AS DOUBLE))""")
def gain_deciles(spark, sf):
    gain = curves.cumulative_gain(scored_orders(spark, sf), "y", "id", "score", points=10)
    return _tidied(gain, "share_contacted", "share_captured")


@query("precision_lift_at_k", f"""
WITH s AS ({SCORED_SQL}), t AS (SELECT y FROM s ORDER BY score DESC, id LIMIT 5000), b AS (SELECT avg(y) AS base FROM s),
p AS (SELECT count(*) AS k, avg(y) AS prec FROM t)
SELECT k, {sql_tidy('prec')} AS precision_at_k, {sql_tidy('base')} AS base_rate, {sql_tidy('prec / base')} AS lift_at_k FROM p, b""")
def precision_lift_at_k(spark, sf):
    top = curves.precision_lift_at_k(scored_orders(spark, sf), "y", "id", "score", 5000)
    return _tidied(top, "precision_at_k", "base_rate", "lift_at_k")


@query("error_rows", f"SELECT id, y, pred, score FROM ({SCORED_SQL}) WHERE y <> pred")
def error_rows(spark, sf):
    return metrics.error_rows(scored_orders(spark, sf), "y", "pred", "id", "score")


# ---- thresholds --------------------------------------------------------------------------

def _choice_sql(test, order):
    return f"""
WITH s AS ({SCORED_SQL}) {CURVE_SQL}, p AS (SELECT {_PR} FROM c), b AS (SELECT * FROM p WHERE {test} ORDER BY threshold {order} LIMIT 1)
SELECT coalesce(b.threshold, 0.5e0) AS threshold, {sql_tidy('b.precision')} AS precision, {sql_tidy('b.recall')} AS recall,
       CAST(b.threshold IS NOT NULL AS INTEGER) AS met FROM (SELECT 1 AS one) LEFT JOIN b ON true"""


@query("threshold_recall", _choice_sql("recall >= 0.9e0", "DESC"))
def threshold_recall(spark, sf):
    return _tidied(decide.threshold_for_recall(scored_orders(spark, sf), "y", "score", 0.9), "precision", "recall")


@query("threshold_precision", _choice_sql("precision >= 0.98e0", "ASC"))
def threshold_precision(spark, sf):
    return _tidied(decide.threshold_for_precision(scored_orders(spark, sf), "y", "score", 0.98), "precision", "recall")


@query("threshold_scan", f"""
WITH s AS ({SCORED_SQL}), g AS (SELECT 0.05e0 + i * 0.05e0 AS t FROM range(10) r(i)),
m AS (SELECT t, {_r('count(*) FILTER (WHERE score >= t AND y = 1)', 'count(*) FILTER (WHERE y = 1)')} AS recall,
     {_r('count(*) FILTER (WHERE score >= t AND y = 1)', 'count(*) FILTER (WHERE score >= t)')} AS precision FROM s, g GROUP BY t)
SELECT t AS threshold, {sql_tidy('recall')} AS recall, {sql_tidy('precision')} AS precision,
  CAST(t = (SELECT coalesce(max(t) FILTER (WHERE recall >= 0.98e0), min(t)) FROM m) AS INTEGER) AS chosen FROM m""")
def threshold_scan(spark, sf):
    return _tidied(decide.threshold_scan(scored_orders(spark, sf), "y", "score", 0.98), "recall", "precision")


@query("apply_threshold", f"SELECT id, CASE WHEN score >= 0.45e0 THEN 'flag' ELSE 'pass' END AS verdict FROM ({SCORED_SQL})")
def apply_threshold(spark, sf):
    rows = decide.apply_threshold(scored_orders(spark, sf), "score", 0.45, "flag", "pass", "verdict")
    return rows.select("id", "verdict")


@query("degenerate_flag", f"""
SELECT rows, flagged, {sql_tidy('base')} AS base_rate, {sql_tidy('prec')} AS precision,
  CAST(flagged >= 0.95e0 * rows OR abs(prec - base) < 0.01e0 AS INTEGER) AS degenerate
FROM (SELECT count(*) AS rows, count(*) FILTER (WHERE score >= 0.02e0) AS flagged, avg(y) AS base,
      avg(y) FILTER (WHERE score >= 0.02e0) AS prec FROM ({SCORED_SQL}))""")
def degenerate_flag(spark, sf):
    return _tidied(metrics.degenerate_flag(scored_orders(spark, sf), "y", "score", 0.02), "base_rate", "precision")


# ---- comparison and output ---------------------------------------------------------------

def _scored_by_model(spark, sf):
    """Three scorers of different strength as one long (model, id, y, score, pred) table."""
    base = scored_orders(spark, sf).select("id", "y", "score")
    noise = hash_uniform("noise", F.col("id"))
    versions = F.array(
        F.struct(F.lit("strong").alias("model"), F.col("score").alias("score")),
        F.struct(F.lit("weak").alias("model"), F.round(0.5 * F.col("score") + 0.5 * noise, 3).alias("score")),
        F.struct(F.lit("none").alias("model"), F.round(noise, 3).alias("score")),
    )
    long = base.select("id", "y", F.explode(versions).alias("v")).select("id", "y", "v.*")
    return long.withColumn("pred", (F.col("score") >= 0.5).cast("int"))


_NOISE = sql_uniform("noise", "id")
_LONG_SQL = f"""
SELECT *, CAST(score >= 0.5e0 AS INTEGER) AS pred FROM (
SELECT id, y, 'strong' AS model, score FROM base UNION ALL
SELECT id, y, 'weak', round(0.5e0 * score + 0.5e0 * {_NOISE}, 3) FROM base UNION ALL
SELECT id, y, 'none', round({_NOISE}, 3) FROM base)"""
_BY_MODEL_SQL = f"""
WITH base AS ({SCORED_SQL}), s AS ({_LONG_SQL}),
d AS (SELECT model, score, count(*) AS n, sum(y) AS pos FROM s GROUP BY 1, 2),
c AS (SELECT *, CAST(sum(n) OVER w AS BIGINT) AS seen, CAST(sum(pos) OVER w AS BIGINT) AS tp,
   CAST(sum(n) OVER (PARTITION BY model) AS BIGINT) AS rows, CAST(sum(pos) OVER (PARTITION BY model) AS BIGINT) AS positives
   FROM d WINDOW w AS (PARTITION BY model ORDER BY score DESC)),
a AS (SELECT model, {AUC_SQL} AS roc_auc FROM c GROUP BY model),
k AS (SELECT model, count(*) FILTER (WHERE y = 1 AND pred = 1) AS tp, count(*) FILTER (WHERE y <> 1 AND pred = 1) AS fp,
   count(*) FILTER (WHERE y = 1 AND pred <> 1) AS fn, count(*) FILTER (WHERE y <> 1 AND pred <> 1) AS tn FROM s GROUP BY model)
SELECT k.model AS model, {', '.join(f'{sql_tidy(_SCORE_SQL[n])} AS {n}' for n in ['accuracy', 'precision', 'recall', 'f1'])},
  {sql_tidy('a.roc_auc')} AS roc_auc FROM k JOIN a ON k.model = a.model"""


@query("compare_models", _BY_MODEL_SQL)
def compare_models(spark, sf):
    from tabwright.operators.tune import compare_models as compare

    return _tidied(compare(_scored_by_model(spark, sf), "model"), "accuracy", "precision", "recall", "f1", "roc_auc")


@query("ranked_export", f"SELECT o_orderkey AS id, score, o_totalprice FROM orders JOIN ({SCORED_SQL}) ON id = o_orderkey ORDER BY score DESC, id LIMIT 5000")
def ranked_export(spark, sf):
    rows = scored_orders(spark, sf).join(
        tables.read_parquet(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), "o_totalprice", F.col("o_orderpriority").alias("duration")), "id")
    top = score.ranked_export(rows.drop("y", "pred"), "id", "score", 5000, drop=["duration"])
    path = fresh_path(spark, "call-list")
    tables.write_csv(top, path)
    return tables.read_csv(spark, path, top.schema)


@query("decode_label", f"SELECT id, CASE pred WHEN 1 THEN 'likely' WHEN 0 THEN 'unlikely' ELSE 'unknown' END AS verdict FROM ({SCORED_SQL})")
def decode_label(spark, sf):
    return score.decode_label(scored_orders(spark, sf), "pred", {1: "likely", 0: "unlikely"}).select("id", "verdict")


@query("metrics_sink", f"""
SELECT metric, value FROM (SELECT unnest(['accuracy', 'f1']) AS metric, unnest([accuracy, f1]) AS value FROM ({_scores_sql(1)}))""")
def metrics_sink(spark, sf):
    wide = _tidied(metrics.binary_scores(scored_orders(spark, sf), "y", "pred", 1), *metrics.SCORERS)
    long = metrics.metric_rows(wide, ["accuracy", "f1"])
    path = fresh_path(spark, "metrics")
    tables.write_metrics(long, path)
    return tables.read_metrics(spark, path, long.schema)
