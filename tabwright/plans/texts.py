"""Text preparation, naive Bayes and dummy classifiers on the standard tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.functions.keys import tidy
from tabwright.operators import bayes, clean, curves, decide, metrics, split, text, tune
from tabwright.plans.evaluate import AP_SQL, AUC_SQL, CURVE_SQL, REPORT_SQL, tidy_report
from tabwright.plans.frames import LABELLED_SQL, documents, labelled_documents, orders, sql_cut_folds, sql_folds, sql_split, sql_split3, sql_tidy, sql_uniform
from tabwright.plans.registry import query
from tabwright.session import fresh_path, materialize, release
from tabwright.sources import models
from tabwright.streaming import score as streaming

TOKENS_SQL = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}', 0)"


@query("tokens", f"SELECT doc_id AS id, CAST(len(w) AS BIGINT) AS n_tokens, md5(array_to_string(w, ' ')) AS digest FROM (SELECT doc_id, {TOKENS_SQL} AS w FROM documents)")
def tokens(spark, sf):
    words = text.tokenize(documents(spark, sf), "text")
    return words.select("id", F.size("tokens").cast("long").alias("n_tokens"), F.md5(F.array_join("tokens", " ")).alias("digest"))


@query("ngram_counts", f"""
WITH w AS (SELECT doc_id AS id, {TOKENS_SQL} AS w FROM documents),
t AS (SELECT id, unnest(w) AS term FROM w UNION ALL
      SELECT id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w WHERE len(w) > 1)
SELECT term, count(*) AS n, count(DISTINCT id) AS docs FROM t GROUP BY term""")
def ngram_counts(spark, sf):
    counts = text.term_counts(documents(spark, sf), "id", "text", 1, 2)
    return counts.groupBy("term").agg(F.sum("tf").alias("n"), F.count(F.lit(1)).alias("docs"))


_COUNTS_SQL = f"""
w AS (SELECT doc_id AS id, {TOKENS_SQL} AS w FROM documents),
k AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(w) AS term FROM w) GROUP BY 1, 2)"""


@query("term_counts", f"WITH {_COUNTS_SQL} SELECT id, term, tf FROM k")
def term_counts(spark, sf):
    return text.term_counts(documents(spark, sf), "id", "text")


@query("vocab", f"""
WITH {_COUNTS_SQL} SELECT term, count(*) AS df FROM k GROUP BY term
HAVING count(*) >= 2 AND count(*) <= 0.9e0 * (SELECT count(*) FROM documents)""")
def vocab(spark, sf):
    docs = documents(spark, sf)
    return text.prune_vocab(text.term_counts(docs, "id", "text"), docs.count())


@query("tfidf", f"""
WITH {_COUNTS_SQL}, n AS (SELECT count(*) AS n FROM documents),
v AS (SELECT term, ln((1e0 + n) / (1e0 + count(*))) + 1e0 AS idf FROM k, n GROUP BY term, n HAVING count(*) >= 2 AND count(*) <= 0.9e0 * n),
x AS (SELECT id, k.term AS term, (1e0 + ln(tf)) * idf AS x FROM k JOIN v ON k.term = v.term)
SELECT id, term, {sql_tidy('x / sqrt(sum(x * x) OVER (PARTITION BY id))')} AS value FROM x""")
def tfidf(spark, sf):
    docs = documents(spark, sf)
    counts = materialize(text.term_counts(docs, "id", "text"), "counts")
    values = text.tfidf(counts, text.fit_idf(counts, docs.count()))
    return values.withColumn("value", tidy(F.col("value")))


# ---- naive Bayes: duplicates out, split, tf-idf on train, fit, score test ----------------

_DEDUP_SQL = f"SELECT id, text, y FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY id) AS _d FROM ({LABELLED_SQL})) WHERE _d = 1"

TEXT_SQL = f"""
t AS ({_DEDUP_SQL}), s0 AS ({sql_split('t')}),
k AS (SELECT id, y, split, term, count(*) AS tf FROM (SELECT id, y, split, unnest({TOKENS_SQL}) AS term FROM s0) GROUP BY ALL),
n AS (SELECT count(*) AS n FROM s0 WHERE split = 'train'),
v AS (SELECT term, ln((1e0 + n) / (1e0 + count(*))) + 1e0 AS idf FROM k, n WHERE split = 'train' GROUP BY term, n
      HAVING count(*) >= 2 AND count(*) <= 0.9e0 * n),
xr AS (SELECT id, y, split, k.term AS term, (1e0 + ln(tf)) * idf AS x FROM k JOIN v ON k.term = v.term),
xv AS (SELECT id, y, split, term, x / sqrt(sum(x * x) OVER (PARTITION BY id)) AS value FROM xr)"""


def _nb_sql(values: str, alpha: float) -> str:
    return f"""
st AS (SELECT term, sum(CASE WHEN y = 0 THEN value ELSE 0e0 END) AS s0, sum(CASE WHEN y = 1 THEN value ELSE 0e0 END) AS s1
       FROM {values} WHERE split = 'train' GROUP BY term),
tot AS (SELECT sum(s0) AS t0, sum(s1) AS t1, count(*) AS v FROM st),
lw AS (SELECT term, ln(s0 + {alpha}e0) - ln(t0 + {alpha}e0 * v) AS w0, ln(s1 + {alpha}e0) - ln(t1 + {alpha}e0 * v) AS w1 FROM st, tot),
pr AS (SELECT ln(count(*) FILTER (WHERE y = 0) / CAST(count(*) AS DOUBLE)) AS p0,
              ln(count(*) FILTER (WHERE y = 1) / CAST(count(*) AS DOUBLE)) AS p1 FROM s0 WHERE split = 'train'),
jl AS (SELECT d.id AS id, d.y AS y, p0 + coalesce(sum(value * w0), 0e0) AS j0, p1 + coalesce(sum(value * w1), 0e0) AS j1
       FROM (SELECT id, y FROM s0 WHERE split = 'test') d CROSS JOIN pr
       LEFT JOIN (SELECT id, value, w0, w1 FROM {values} x JOIN lw ON x.term = lw.term) m ON d.id = m.id GROUP BY d.id, d.y, p0, p1),
sc AS (SELECT id, y, 1e0 / (1e0 + exp(j0 - j1)) AS score, CAST(j1 > j0 AS INTEGER) AS pred FROM jl)"""


def text_frames(spark, sf):
    """(documents with split, tf-idf values with y and split) of the deduplicated labelled texts."""
    docs = materialize(clean.dedup_rows(labelled_documents(spark, sf), ["text"], "id"), "texts")
    docs = split.stratified_split(docs, "id", "y")
    counts = materialize(text.term_counts(docs, "id", "text", keep=["y", "split"]), "counts")
    train = counts.where("split = 'train'")
    idf = text.fit_idf(train, docs.where("split = 'train'").count())
    return docs, counts, text.tfidf(counts, idf)


def _scored(spark, sf, alpha=0.1):
    docs, _, values = text_frames(spark, sf)
    values = materialize(values, "tfidf")
    model = bayes.fit_multinomial_nb(values.where("split = 'train'"), docs.where("split = 'train'"), "y", alpha)
    test = docs.where("split = 'test'").select("id", "y")
    return model, test, values.where("split = 'test'"), bayes.nb_scores(model, test, values.where("split = 'test'"))


_SCORES_OUT = f"SELECT id, y, {sql_tidy('score')} AS score, pred FROM sc"


@query("tfidf_plain", f"""
WITH {_COUNTS_SQL}, n AS (SELECT count(*) AS n FROM documents),
v AS (SELECT term, ln((1e0 + n) / (1e0 + count(*))) + 1e0 AS idf FROM k, n GROUP BY term, n HAVING count(*) >= 2 AND count(*) <= 0.9e0 * n),
x AS (SELECT id, CAST(tf AS DOUBLE) * idf AS x FROM k JOIN v ON k.term = v.term),
u AS (SELECT id, x / sqrt(sum(x * x) OVER (PARTITION BY id)) AS value FROM x)
SELECT id, count(*) AS terms, {sql_tidy('sum(value)')} AS total, {sql_tidy('max(value)')} AS top FROM u GROUP BY id""")
def tfidf_plain(spark, sf):
    docs = documents(spark, sf)
    counts = materialize(text.term_counts(docs, "id", "text"), "counts")
    values = text.tfidf(counts, text.fit_idf(counts, docs.count()), sublinear=False)
    return values.groupBy("id").agg(
        F.count(F.lit(1)).alias("terms"), tidy(F.sum("value")).alias("total"), tidy(F.max("value")).alias("top"))


@query("nb_multinomial", f"WITH {TEXT_SQL}, {_nb_sql('xv', 0.1)} {_SCORES_OUT}")
def nb_multinomial(spark, sf):
    return _scored(spark, sf)[3].withColumn("score", tidy(F.col("score")))


@query("nb_counts", f"WITH {TEXT_SQL}, kv AS (SELECT id, y, split, term, CAST(tf AS DOUBLE) AS value FROM k), {_nb_sql('kv', 1.0)} {_SCORES_OUT}")
def nb_counts(spark, sf):
    docs, counts, _ = text_frames(spark, sf)
    values = counts.withColumn("value", F.col("tf").cast("double"))
    model = bayes.fit_multinomial_nb(values.where("split = 'train'"), docs.where("split = 'train'"), "y", 1.0)
    scored = bayes.nb_scores(model, docs.where("split = 'test'").select("id", "y"), values.where("split = 'test'"))
    return scored.withColumn("score", tidy(F.col("score")))


_BERNOULLI_SQL = f"""
WITH {TEXT_SQL}, nc AS (SELECT count(*) FILTER (WHERE y = 0) AS n0, count(*) FILTER (WHERE y = 1) AS n1 FROM s0 WHERE split = 'train'),
pb AS (SELECT term, (count(*) FILTER (WHERE y = 0) + 1e0) / (n0 + 2e0) AS p0, (count(*) FILTER (WHERE y = 1) + 1e0) / (n1 + 2e0) AS p1
       FROM xv, nc WHERE split = 'train' GROUP BY term, n0, n1),
bs AS (SELECT ln(n0 / CAST(n0 + n1 AS DOUBLE)) + sum(ln(1e0 - p0)) AS b0, ln(n1 / CAST(n0 + n1 AS DOUBLE)) + sum(ln(1e0 - p1)) AS b1
       FROM pb, nc GROUP BY n0, n1),
jl AS (SELECT d.id AS id, d.y AS y, b0 + coalesce(sum(ln(p0) - ln(1e0 - p0)), 0e0) AS j0, b1 + coalesce(sum(ln(p1) - ln(1e0 - p1)), 0e0) AS j1
       FROM (SELECT id, y FROM s0 WHERE split = 'test') d CROSS JOIN bs
       LEFT JOIN (SELECT id, p0, p1 FROM xv JOIN pb ON xv.term = pb.term) m ON d.id = m.id GROUP BY d.id, d.y, b0, b1),
sc AS (SELECT id, y, 1e0 / (1e0 + exp(j0 - j1)) AS score, CAST(j1 > j0 AS INTEGER) AS pred FROM jl)"""


@query("nb_bernoulli", f"{_BERNOULLI_SQL} {_SCORES_OUT}")
def nb_bernoulli(spark, sf):
    docs, _, values = text_frames(spark, sf)
    values = text.binarize_presence(values)
    model = bayes.fit_bernoulli_nb(values.where("split = 'train'"), docs.where("split = 'train'"), "y", 1.0)
    scored = bayes.nb_scores(model, docs.where("split = 'test'").select("id", "y"), values.where("split = 'test'"))
    return scored.withColumn("score", tidy(F.col("score")))


@query("nb_presence", f"WITH {TEXT_SQL} SELECT id, count(*) AS present, {sql_tidy('sum(1e0)')} AS total FROM xv GROUP BY id")
def nb_presence(spark, sf):
    present = text.binarize_presence(text_frames(spark, sf)[2])
    return present.groupBy("id").agg(F.count(F.lit(1)).alias("present"), tidy(F.sum("value")).alias("total"))


@query("nb_top_terms", f"WITH {TEXT_SQL}, {_nb_sql('xv', 0.1)} SELECT term, {sql_tidy('w1 - w0')} AS log_ratio FROM lw ORDER BY w1 - w0 DESC, term LIMIT 20")
def nb_top_terms(spark, sf):
    return bayes.class_terms(_scored(spark, sf)[0]).withColumn("log_ratio", tidy(F.col("log_ratio")))


@query("model_roundtrip", f"WITH {TEXT_SQL}, {_nb_sql('xv', 0.1)} {_SCORES_OUT}")
def model_roundtrip(spark, sf):
    model, test, values, _ = _scored(spark, sf)
    path = fresh_path(spark, "nb-model")
    model.save(path)
    scored = bayes.nb_scores(bayes.TermModel.load(spark, path), test, values)
    return scored.withColumn("score", tidy(F.col("score")))


@query("decision_roundtrip", f"""
WITH {TEXT_SQL}, {_nb_sql('xv', 0.1)} SELECT id, CASE WHEN score >= 0.2e0 THEN 'toxic' ELSE 'fine' END AS verdict FROM sc""")
def decision_roundtrip(spark, sf):
    scored = _scored(spark, sf)[3]
    path = fresh_path(spark, "decision")
    models.save_decision(spark, models.Decision(0.2, "toxic", "fine"), path)
    rule = models.load_decision(spark, path)
    return decide.apply_threshold(scored, "score", rule.threshold, rule.positive, rule.negative, "verdict").select("id", "verdict")


@query("text_filter_report", f"""
WITH {TEXT_SQL}, {_nb_sql('xv', 0.1)}, s AS (SELECT id, y, CAST(round(score, 9) >= 0.2e0 AS INTEGER) AS pred FROM sc) {REPORT_SQL}""")
def text_filter_report(spark, sf):
    scored = _scored(spark, sf)[3].withColumn("score", F.round("score", 9))
    return tidy_report(metrics.classification_report(decide.apply_threshold(scored, "score", 0.2), "y", "pred"))


@query("text_filter_ranking", f"""
WITH {TEXT_SQL}, {_nb_sql('xv', 0.1)}, s AS (SELECT id, y, round(score, 9) AS score FROM sc) {CURVE_SQL}
SELECT {sql_tidy(AUC_SQL)} AS roc_auc, {sql_tidy(AP_SQL)} AS average_precision FROM c""")
def text_filter_ranking(spark, sf):
    scored = _scored(spark, sf)[3].withColumn("score", F.round("score", 9))
    both = curves.auc_and_ap(curves.curve_table(scored, "y", "score"))
    return both.select(*[tidy(F.col(c)).alias(c) for c in both.columns])


# ---- search over n-gram range and smoothing; folds and grid are columns ------------------

ALPHAS = [0.01, 0.1, 0.5, 1.0]

# every grid point on the folded documents f (id, text, y, fold)
_GRID_CTES = f"""w AS (SELECT id, {TOKENS_SQL} AS w FROM f),
g AS (SELECT id, 1 AS n, unnest(w) AS term FROM w UNION ALL
      SELECT id, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w WHERE len(w) > 1),
k AS (SELECT hi, id, term, count(*) AS tf FROM g JOIN (VALUES (1), (2)) h(hi) ON n <= hi GROUP BY ALL),
cv AS (SELECT v AS val FROM range(5) r(v)),
tr AS (SELECT val, f.id AS id, y, fold FROM f, cv),
nd AS (SELECT val, count(*) AS n, count(*) FILTER (WHERE y = 0) AS n0, count(*) FILTER (WHERE y = 1) AS n1 FROM tr WHERE fold <> val GROUP BY val),
vo AS (SELECT hi, val, term, ln((1e0 + n) / (1e0 + count(*))) + 1e0 AS idf FROM k JOIN tr USING (id) JOIN nd USING (val) WHERE fold <> val
       GROUP BY hi, val, term, n HAVING count(*) >= 2 AND count(*) <= 0.9e0 * n),
xr AS (SELECT hi, val, id, y, fold, term, (1e0 + ln(tf)) * idf AS x FROM k JOIN tr USING (id) JOIN vo USING (hi, val, term)),
xv AS (SELECT *, x / sqrt(sum(x * x) OVER (PARTITION BY hi, val, id)) AS value FROM xr),
st AS (SELECT hi, val, term, sum(CASE WHEN y = 0 THEN value ELSE 0e0 END) AS s0, sum(CASE WHEN y = 1 THEN value ELSE 0e0 END) AS s1
       FROM xv WHERE fold <> val GROUP BY hi, val, term),
tt AS (SELECT hi, val, sum(s0) AS t0, sum(s1) AS t1, count(*) AS v FROM st GROUP BY hi, val),
al AS (SELECT unnest([0.01e0, 0.1e0, 0.5e0, 1e0]) AS alpha),
ms AS (SELECT hi, val, alpha, id, sum(value * ((ln(s1 + alpha) - ln(t1 + alpha * v)) - (ln(s0 + alpha) - ln(t0 + alpha * v)))) AS m
       FROM xv JOIN st USING (hi, val, term) JOIN tt USING (hi, val), al WHERE fold = val GROUP BY hi, val, alpha, id),
pd AS (SELECT h.hi AS hi, alpha, tr.val AS val, y, CAST(coalesce(m, 0e0) + ln(n1 / CAST(n AS DOUBLE)) - ln(n0 / CAST(n AS DOUBLE)) > 0 AS INTEGER) AS pred
       FROM tr JOIN nd USING (val) CROSS JOIN (VALUES (1), (2)) h(hi) CROSS JOIN al
       LEFT JOIN ms USING (hi, val, alpha, id) WHERE fold = val),
cf AS (SELECT hi, alpha, val, count(*) FILTER (WHERE y = 1 AND pred = 1) AS tp, count(*) FILTER (WHERE y = 0 AND pred = 1) AS fp,
       count(*) FILTER (WHERE y = 1 AND pred = 0) AS fn, count(*) FILTER (WHERE y = 0 AND pred = 0) AS tn FROM pd GROUP BY 1, 2, 3),
fs AS (SELECT hi, alpha, val, ((tp + fn) * (CASE WHEN 2 * tp + fp + fn = 0 THEN 0e0 ELSE 2e0 * tp / (2 * tp + fp + fn) END)
       + (tn + fp) * (CASE WHEN 2 * tn + fp + fn = 0 THEN 0e0 ELSE 2e0 * tn / (2 * tn + fp + fn) END)) / (tp + fp + fn + tn) AS score FROM cf),
cr AS (SELECT hi, alpha, avg(score) AS mean_score, stddev_pop(score) AS std_score, count(*) AS folds FROM fs GROUP BY 1, 2)"""

_GRID_SQL = f"""
WITH t AS ({_DEDUP_SQL}), s0 AS (SELECT * FROM ({sql_split('t')}) WHERE split = 'train'),
s1 AS (SELECT id, text, y FROM s0), f AS ({sql_folds('s1', seed='folds')}),
{_GRID_CTES}
SELECT hi, alpha, {sql_tidy('mean_score')} AS mean_score, {sql_tidy('std_score')} AS std_score, folds, rank() OVER (ORDER BY round(mean_score, 9) DESC) AS rank FROM cr"""


@query("nb_grid", _GRID_SQL)
def nb_grid(spark, sf):
    docs = materialize(clean.dedup_rows(labelled_documents(spark, sf), ["text"], "id"), "texts")
    train = split.stratified_split(docs, "id", "y").where("split = 'train'").drop("split")
    # folds rank narrow rows; the texts only meet their fold number
    folds = split.stratified_folds(train.select("id", "y"), "id", "y", 5, "folds").select("id", "fold")
    folded = materialize(train.join(folds.hint("shuffle_hash"), "id"), "folded")
    release(spark, docs)
    results = tune.nb_grid(folded, "id", "text", "y", "fold", his=[1, 2], alphas=ALPHAS, k=5)
    return results.select("hi", "alpha", tidy(F.col("mean_score")).alias("mean_score"), tidy(F.col("std_score")).alias("std_score"), "folds", "rank")


# fixed value: wanted precision of the chosen threshold
PRECISION = 0.98

_TUNED_SQL = f"""
WITH t AS ({_DEDUP_SQL}), docs AS ({sql_split3('t')}),
s1 AS (SELECT id, text, y FROM docs WHERE split = 'train'), f AS ({sql_cut_folds('s1', seed='folds')}),
{_GRID_CTES},
b AS (SELECT hi AS best_hi, alpha AS best_alpha FROM cr ORDER BY round(mean_score, 9) DESC, hi, alpha LIMIT 1),
w2 AS (SELECT id, {TOKENS_SQL} AS w FROM docs),
g2 AS (SELECT id, 1 AS n, unnest(w) AS term FROM w2 UNION ALL
       SELECT id, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w2 WHERE len(w) > 1),
k2 AS (SELECT id, y, split, term, count(*) AS tf FROM g2 JOIN docs USING (id) JOIN b ON n <= best_hi GROUP BY ALL),
n2 AS (SELECT count(*) AS n, count(*) FILTER (WHERE y = 1) AS n1 FROM docs WHERE split = 'train'),
v2 AS (SELECT term, ln((1e0 + n) / (1e0 + count(*))) + 1e0 AS idf FROM k2, n2 WHERE split = 'train' GROUP BY term, n
       HAVING count(*) >= 2 AND count(*) <= 0.9e0 * n),
x2 AS (SELECT id, y, split, k2.term AS term, (1e0 + ln(tf)) * idf AS x FROM k2 JOIN v2 ON k2.term = v2.term),
z2 AS (SELECT *, x / sqrt(sum(x * x) OVER (PARTITION BY id)) AS value FROM x2),
c2 AS (SELECT term, sum(CASE WHEN y = 0 THEN value ELSE 0e0 END) AS s0, sum(CASE WHEN y = 1 THEN value ELSE 0e0 END) AS s1
       FROM z2 WHERE split = 'train' GROUP BY term),
t2 AS (SELECT sum(s0) AS t0, sum(s1) AS t1, count(*) AS v FROM c2),
l2 AS (SELECT term, (ln(s1 + best_alpha) - ln(t1 + best_alpha * v)) - (ln(s0 + best_alpha) - ln(t0 + best_alpha * v)) AS lean FROM c2, t2, b),
m2 AS (SELECT id, sum(value * lean) AS m FROM z2 JOIN l2 USING (term) GROUP BY id),
sc AS (SELECT id, y, split, round(1e0 / (1e0 + exp(-(coalesce(m, 0e0) + ln(n1 / CAST(n - n1 AS DOUBLE))))), 9) AS score
       FROM docs CROSS JOIN n2 LEFT JOIN m2 USING (id) WHERE split <> 'train'),
d2 AS (SELECT score, count(*) AS n, sum(y) AS pos FROM sc WHERE split = 'val' GROUP BY score),
p2 AS (SELECT score, sum(pos) OVER (ORDER BY score DESC) / CAST(sum(n) OVER (ORDER BY score DESC) AS DOUBLE) AS prec FROM d2),
th AS (SELECT coalesce(min(score) FILTER (WHERE prec >= {PRECISION}e0), 0.5e0) AS cut FROM p2),
s AS (SELECT y, CAST(score >= cut AS INTEGER) AS pred FROM sc, th WHERE split = 'test')
SELECT r.*, {sql_tidy('cut')} AS threshold, best_hi AS hi, best_alpha AS alpha FROM (WITH one AS (SELECT 1) {REPORT_SQL}) r, th, b"""


@query("nb_tuned_report", _TUNED_SQL)
def nb_tuned_report(spark, sf):
    """Search on the training rows, refit, threshold on validation, one evaluation on test."""
    docs = materialize(clean.dedup_rows(labelled_documents(spark, sf), ["text"], "id"), "texts")
    docs = split.stratified_split3(docs, "id", "y")
    train = docs.where("split = 'train'")
    folded = split.stratified_cut_folds(train.drop("split"), "id", "y", 5, "folds")
    best = tune.best_point(tune.nb_grid(folded, "id", "text", "y", "fold", his=[1, 2], alphas=ALPHAS, k=5), ["hi", "alpha"])
    release(spark)
    counts = materialize(text.term_counts(docs, "id", "text", 1, best["hi"], keep=["y", "split"]), "counts")
    idf = text.fit_idf(counts.where("split = 'train'"), train.count())
    release(spark)
    values = materialize(text.tfidf(counts, idf), "tfidf")
    release(spark, counts)
    model = bayes.fit_multinomial_nb(values.where("split = 'train'"), train, "y", best["alpha"])
    held = docs.where("split <> 'train'").select("id", "y", "split")
    scored = bayes.nb_scores(model, held, values.where("split <> 'train'"))
    scored = materialize(scored.withColumn("score", F.round("score", 9)).drop("pred"), "scored")
    report = tune.report_at_threshold(scored, lambda rows: decide.threshold_for_precision(rows, "y", "score", PRECISION))
    return tidy_report(report).withColumns(
        {"threshold": tidy(F.col("threshold")), "hi": F.lit(best["hi"]), "alpha": F.lit(best["alpha"])})


# ---- dummies -----------------------------------------------------------------------------

_STATUS_SQL = "SELECT o_orderkey AS id, CAST(o_orderstatus = 'F' AS INTEGER) AS y FROM orders"


def _status(spark, sf):
    rows = orders(spark, sf).select(F.col("o_orderkey").alias("id"), (F.col("o_orderstatus") == "F").cast("int").alias("y"))
    return split.stratified_split(rows, "id", "y")


@query("dummy_most_frequent", f"""
WITH t AS ({_STATUS_SQL}), s AS ({sql_split('t')}),
m AS (SELECT y AS major FROM s WHERE split = 'train' GROUP BY y ORDER BY count(*) DESC, y LIMIT 1)
SELECT id, s.y AS y, major AS pred, CAST(major = 1 AS INTEGER) + 0e0 AS score FROM s, m WHERE split = 'test'""")
def dummy_most_frequent(spark, sf):
    rows = _status(spark, sf)
    return bayes.dummy_most_frequent(rows.where("split = 'train'"), rows.where("split = 'test'").drop("split"), "y")


@query("dummy_stratified", f"""
WITH t AS ({_STATUS_SQL}), s AS ({sql_split('t')}), p AS (SELECT avg(y) AS prior FROM s WHERE split = 'train')
SELECT id, y, CAST({sql_uniform('dummy', 'id')} < prior AS INTEGER) AS pred, CAST({sql_uniform('dummy', 'id')} < prior AS INTEGER) + 0e0 AS score
FROM s, p WHERE split = 'test'""")
def dummy_stratified(spark, sf):
    rows = _status(spark, sf)
    return bayes.dummy_stratified(rows.where("split = 'train'"), rows.where("split = 'test'").drop("split"), "y", "id")


@query("text_score_throughput")
def text_score_throughput(spark, sf):
    """Rows per second of tokenising, weighting and scoring every document."""
    docs, counts, values = text_frames(spark, sf)
    train = docs.where("split = 'train'")
    idf = text.fit_idf(counts.where("split = 'train'"), train.count())
    model = bayes.fit_multinomial_nb(values.where("split = 'train'"), train, "y", 0.1)

    def scored(rows):
        return bayes.nb_scores(model, rows.select("id"), text.tfidf(text.term_counts(rows, "id", "text"), idf))

    return streaming.score_throughput(documents(spark, sf), scored)
