"""Sources, cleaning, profiling and splits on the standard tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.functions.keys import tidy
from tabwright.operators import clean, profile, split
from tabwright.plans.frames import (
    CAMPAIGN_SQL, LABELLED_SQL, campaign, labelled_documents, orders, sql_cut_folds, sql_folds, sql_quota, sql_hash, sql_split,
    sql_tidy,
)
from tabwright.plans.registry import query
from tabwright.session import fresh_path
from tabwright.sources import tables

STATUS_ORDERS_SQL = "SELECT o_orderkey AS id, o_orderstatus AS y FROM orders"


def _status_orders(spark, sf):
    return orders(spark, sf).select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("y"))


# ---- sources and sinks -------------------------------------------------------------------

@query("csv_roundtrip", "SELECT * FROM orders")
def csv_roundtrip(spark, sf):
    src = orders(spark, sf)
    path = fresh_path(spark, "orders-csv")
    tables.write_csv(src, path, sep=";")
    return tables.read_csv(spark, path, src.schema, sep=";")


@query("csv_latin1", "SELECT doc_id, text, lang FROM documents")
def csv_latin1(spark, sf):
    src = tables.read_parquet(spark, sf, "documents").select("doc_id", "text", "lang")
    path = fresh_path(spark, "documents-csv")
    tables.write_csv(src, path, encoding="ISO-8859-1")
    return tables.read_csv(spark, path, src.schema, encoding="ISO-8859-1", multiline=True)


@query("take_columns", "SELECT p_partkey AS key, p_name AS name FROM part")
def take_columns(spark, sf):
    return tables.take_columns(tables.read_parquet(spark, sf, "part"), 2, ["key", "name"])


@query("parquet_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 400000e0")
def parquet_scan(spark, sf):
    return tables.read_parquet(spark, sf, "orders").where("o_totalprice > 400000").select("o_orderkey", "o_totalprice")


@query("table_export", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1")
def table_export(spark, sf):
    counts = tables.read_parquet(spark, sf, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    path = fresh_path(spark, "segments")
    tables.write_table(counts, path, "csv", order_by=["c_mktsegment"])
    return tables.read_csv(spark, path, counts.schema)


# ---- columns, sentinels, labels, duplicates ----------------------------------------------

@query("drop_columns", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def drop_columns(spark, sf):
    return clean.drop_columns(orders(spark, sf), ["o_orderstatus", "o_orderdate", "duration"], missing_ok=True)


@query("select_columns", 'SELECT p_partkey AS "p.partkey", p_size AS "p.size" FROM part')
def select_columns(spark, sf):
    dotted = tables.read_parquet(spark, sf, "part").select(
        F.col("p_partkey").alias("p.partkey"), F.col("p_size").alias("p.size"), "p_name"
    )
    return clean.select_columns(dotted, ["p.partkey", "p.size"])


@query("sentinel_to_null", f"""
SELECT l_orderkey, count(*) AS n, count(nullif(l_discount, 0)) AS n_discount, {sql_tidy('avg(nullif(l_discount, 0))')} AS avg_discount
FROM lineitem GROUP BY 1""")
def sentinel_to_null(spark, sf):
    rows = clean.sentinel_to_null(tables.read_parquet(spark, sf, "lineitem"), ["l_discount"], 0.0)
    return rows.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.count("l_discount").alias("n_discount"),
        tidy(F.avg("l_discount")).alias("avg_discount"),
    )


@query("sentinel_flag", """
SELECT p_partkey, CAST(p_size <> 1 AS INTEGER) AS size_known, CASE WHEN p_size = 1 THEN -1 ELSE p_size END AS size_clean FROM part""")
def sentinel_flag(spark, sf):
    part = tables.read_parquet(spark, sf, "part")
    return clean.sentinel_flag(part, "p_size", 1, -1, "size_known", "size_clean").select(
        "p_partkey", "size_known", "size_clean")


@query("label_binarize", "SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS y FROM orders")
def label_binarize(spark, sf):
    return clean.label_binarize(orders(spark, sf), "o_orderstatus", "F").select("o_orderkey", "y")


@query("sentinel_census", """
SELECT 'l_discount' AS "column", count(*) FILTER (WHERE l_discount = 0) AS hits FROM lineitem
UNION ALL SELECT 'l_tax', count(*) FILTER (WHERE l_tax = 0) FROM lineitem
UNION ALL SELECT 'l_quantity', count(*) FILTER (WHERE l_quantity = 0) FROM lineitem""")
def sentinel_census(spark, sf):
    return clean.sentinel_census(tables.read_parquet(spark, sf, "lineitem"), ["l_discount", "l_tax", "l_quantity"], 0.0)


@query("dedup_rows", "SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def dedup_rows(spark, sf):
    return clean.dedup_rows(tables.read_parquet(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"))


@query("dedup_text", "SELECT min(doc_id) AS doc_id, text FROM documents GROUP BY text")
def dedup_text(spark, sf):
    docs = tables.read_parquet(spark, sf, "documents").select("doc_id", "text")
    return clean.dedup_rows(docs, ["text"], "doc_id")


@query("dedup_stats", """
SELECT count(*) AS rows_before, count(*) - count(DISTINCT text) AS duplicates_removed, count(DISTINCT text) AS rows_after
FROM documents""")
def dedup_stats(spark, sf):
    docs = tables.read_parquet(spark, sf, "documents").select(F.sha2("text", 256).alias("key"))
    return clean.dedup_stats(docs, ["key"])


@query("level_guard", f"""
WITH t AS ({CAMPAIGN_SQL}), s AS ({sql_split('t')})
SELECT "column", level, count(*) AS rows FROM (
  SELECT 'priority' AS "column", priority AS level FROM s UNION ALL
  SELECT 'nation', CAST(nation AS VARCHAR) FROM s) a
WHERE ("column", level) NOT IN (
  SELECT ('priority', priority) FROM s WHERE split = 'test' AND y = 1 AND priority <> '3-MEDIUM'
  UNION SELECT ('nation', CAST(nation AS VARCHAR)) FROM s WHERE split = 'test' AND y = 1 AND priority <> '3-MEDIUM')
GROUP BY 1, 2""")
def level_guard(spark, sf):
    rows = split.stratified_split(campaign(spark, sf), "id", "y")
    known = rows.where("split = 'test' AND y = 1 AND priority <> '3-MEDIUM'")
    levels = known.select(
        F.expr("stack(2, 'priority', priority, 'nation', CAST(nation AS STRING)) AS (column, level)")
    ).distinct()
    return clean.level_guard(rows, levels, ["priority", "nation"])


@query("null_census", """
WITH p AS (SELECT p_partkey, nullif(p_size, 1) AS p_size, p_retailprice FROM part), c AS (
SELECT 'p_partkey' AS "column", count(*) - count(p_partkey) AS missing FROM p
UNION ALL SELECT 'p_size', count(*) - count(p_size) FROM p
UNION ALL SELECT 'p_retailprice', count(*) - count(p_retailprice) FROM p)
SELECT * FROM c UNION ALL SELECT '(total)', CAST(sum(missing) AS BIGINT) FROM c""")
def null_census(spark, sf):
    part = clean.sentinel_to_null(tables.read_parquet(spark, sf, "part"), ["p_size"], 1)
    return clean.null_census(part, ["p_partkey", "p_size", "p_retailprice"])


@query("filtered_slice", f"SELECT id, price FROM ({CAMPAIGN_SQL}) WHERE y = 1 AND segment = 'BUILDING' AND price > 300000e0")
def filtered_slice(spark, sf):
    rows = clean.filter_rows(campaign(spark, sf), "y = 1 AND segment = 'BUILDING' AND price > 300000")
    return rows.select("id", "price")


@query("text_length", "SELECT doc_id, length(text) AS n_characters FROM documents")
def text_length(spark, sf):
    docs = tables.read_parquet(spark, sf, "documents")
    return clean.text_length(docs, "text").select("doc_id", "n_characters")


# account balance in right-closed ranges; balances above the last edge belong to no bin
BALANCE_EDGES = [-1000.0, 0.0, 2500.0, 5000.0, 7500.0]
BALANCE_LABELS = ["debt", "low", "middle", "high"]
_BIN_SQL = """CASE WHEN balance > -1000 AND balance <= 0 THEN 'debt' WHEN balance > 0 AND balance <= 2500 THEN 'low'
WHEN balance > 2500 AND balance <= 5000 THEN 'middle' WHEN balance > 5000 AND balance <= 7500 THEN 'high' END"""


@query("bin_column", f"SELECT id, {_BIN_SQL} AS bin FROM ({CAMPAIGN_SQL})")
def bin_column(spark, sf):
    return clean.bin_column(campaign(spark, sf), "balance", BALANCE_EDGES, BALANCE_LABELS).select("id", "bin")


# ---- profiling ---------------------------------------------------------------------------

@query("bin_rate", f"""
WITH t AS (SELECT {_BIN_SQL} AS bin, y FROM ({CAMPAIGN_SQL}))
SELECT l.bin AS bin, count(t.y) AS n, {sql_tidy('avg(t.y)')} AS rate
FROM (SELECT unnest(['debt', 'low', 'middle', 'high', 'vacant']) AS bin) l LEFT JOIN t ON l.bin = t.bin GROUP BY 1""")
def bin_rate(spark, sf):
    rows = clean.bin_column(campaign(spark, sf), "balance", BALANCE_EDGES, BALANCE_LABELS)
    rate = profile.group_rate(rows, "bin", "y", levels=[*BALANCE_LABELS, "vacant"])
    return rate.withColumn("rate", tidy(F.col("rate")))


@query("group_rate", f"SELECT segment, count(*) AS n, {sql_tidy('avg(y)')} AS rate FROM ({CAMPAIGN_SQL}) GROUP BY 1")
def group_rate(spark, sf):
    rate = profile.group_rate(campaign(spark, sf), "segment", "y")
    return rate.withColumn("rate", tidy(F.col("rate")))


@query("value_shares", f"""
SELECT o_orderpriority, count(*) AS n, {sql_tidy('count(*) / CAST(sum(count(*)) OVER () AS DOUBLE)')} AS share
FROM orders GROUP BY 1""")
def value_shares(spark, sf):
    counts = profile.value_counts(orders(spark, sf), "o_orderpriority")
    return counts.withColumn("share", tidy(F.col("share")))


_DESCRIBE = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {sql_tidy(f'avg({c})')} AS mean, {sql_tidy(f'stddev_samp({c})')} AS std,
    {sql_tidy(f'min({c})')} AS "min", {sql_tidy(f'max({c})')} AS "max" FROM lineitem"""
    for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@query("describe_columns", _DESCRIBE)
def describe_columns(spark, sf):
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    stats = profile.describe_columns(tables.read_parquet(spark, sf, "lineitem"), cols)
    return stats.select("column", *[tidy(F.col(c)).alias(c) for c in ["mean", "std", "min", "max"]])


@query("text_length_profile", f"""
SELECT y, count(*) AS "count", {sql_tidy('avg(n)')} AS mean, {sql_tidy('stddev_samp(n)')} AS std, {sql_tidy('min(n)')} AS "min",
  {sql_tidy('max(n)')} AS "max", {sql_tidy('quantile_cont(n, 0.25)')} AS q25, {sql_tidy('quantile_cont(n, 0.5)')} AS q50,
  {sql_tidy('quantile_cont(n, 0.75)')} AS q75
FROM (SELECT y, CAST(length(text) AS DOUBLE) AS n FROM ({LABELLED_SQL})) GROUP BY y""")
def text_length_profile(spark, sf):
    rows = clean.text_length(labelled_documents(spark, sf), "text").select("y", "n_characters")
    stats = profile.describe_by(rows, "y", "n_characters")
    return stats.select("y", "count", *[tidy(F.col(c)).alias(c) for c in ["mean", "std", "min", "max", "q25", "q50", "q75"]])


@query("length_histogram", f"""
WITH t AS (SELECT y, CAST(length(text) AS DOUBLE) AS n FROM ({LABELLED_SQL})),
s AS (SELECT y, min(n) AS lo, max(n) AS hi FROM t GROUP BY y)
SELECT t.y AS y, CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((n - lo) / ((hi - lo) / 50e0)), 49) END AS INTEGER) AS bin, count(*) AS n
FROM t JOIN s ON t.y = s.y GROUP BY 1, 2""")
def length_histogram(spark, sf):
    rows = clean.text_length(labelled_documents(spark, sf), "text").select("y", "n_characters")
    return profile.histogram_by(rows, "y", "n_characters", 50)


@query("box_stats", f"""
WITH q AS (SELECT o_orderpriority AS g, quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS median,
           quantile_cont(o_totalprice, 0.75) AS q3 FROM orders GROUP BY 1),
j AS (SELECT q.*, o_totalprice AS v, o_totalprice BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1) AS inside
      FROM orders JOIN q ON o_orderpriority = g)
SELECT g AS o_orderpriority, {sql_tidy('q1')} AS q1, {sql_tidy('median')} AS median, {sql_tidy('q3')} AS q3,
  {sql_tidy('min(v) FILTER (WHERE inside)')} AS whisker_low, {sql_tidy('max(v) FILTER (WHERE inside)')} AS whisker_high,
  count(*) FILTER (WHERE NOT inside) AS outliers FROM j GROUP BY g, q1, median, q3""")
def box_stats(spark, sf):
    box = profile.box_stats(orders(spark, sf), "o_orderpriority", "o_totalprice")
    return box.select("o_orderpriority", *[tidy(F.col(c)).alias(c) for c in ["q1", "median", "q3", "whisker_low", "whisker_high"]], "outliers")


_CORR_COLS = ["price", "balance", "nation", "y"]
_CORR_SQL = f"WITH t AS ({CAMPAIGN_SQL}) " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {sql_tidy(f'corr({a}, {b})')} AS r FROM t" for a in _CORR_COLS for b in _CORR_COLS)


@query("correlation_matrix", _CORR_SQL)
def correlation_matrix(spark, sf):
    matrix = profile.correlation_matrix(campaign(spark, sf), _CORR_COLS)
    return matrix.withColumn("r", tidy(F.col("r")))


@query("shape", "SELECT count(*) AS rows, 6 AS columns FROM orders")
def shape(spark, sf):
    return profile.table_shape(orders(spark, sf))


@query("base_rate", f"SELECT {sql_tidy('avg(y)')} AS base_rate FROM ({CAMPAIGN_SQL})")
def base_rate(spark, sf):
    return profile.base_rate(campaign(spark, sf), "y").select(tidy(F.col("base_rate")).alias("base_rate"))


# ---- splits ------------------------------------------------------------------------------

@query("split_holdout", f"WITH t AS ({STATUS_ORDERS_SQL}) SELECT id, y, split FROM ({sql_split('t')})")
def split_holdout(spark, sf):
    return split.stratified_split(_status_orders(spark, sf), "id", "y")


_THREE_SQL = f"""
q1 AS ({sql_quota('t', 0.4, out='_q1')}), q2 AS ({sql_quota('(SELECT y, _q1 AS _n FROM q1)', 0.5, n='_q1', out='_q2')}),
r AS (SELECT id, y, row_number() OVER (PARTITION BY y ORDER BY {sql_hash('42', 'id')}, id) AS _r FROM t),
p AS (SELECT id, r.y AS y, CASE WHEN _r <= _q2 THEN 'test' WHEN _r <= _q1 THEN 'val' ELSE 'train' END AS split
FROM r JOIN q1 ON r.y = q1.y JOIN q2 ON r.y = q2.y)"""


@query("split_three", f"WITH t AS ({STATUS_ORDERS_SQL}), {_THREE_SQL} SELECT id, y, split FROM p")
def split_three(spark, sf):
    return split.stratified_split3(_status_orders(spark, sf), "id", "y")


@query("folds", f"WITH t AS ({STATUS_ORDERS_SQL}) SELECT id, y, fold FROM ({sql_folds('t')})")
def folds(spark, sf):
    return split.stratified_folds(_status_orders(spark, sf), "id", "y")


@query("cut_folds", f"WITH t AS ({STATUS_ORDERS_SQL}) SELECT id, y, fold FROM ({sql_cut_folds('t')})")
def cut_folds(spark, sf):
    return split.stratified_cut_folds(_status_orders(spark, sf), "id", "y")


@query("merge_splits", f"WITH t AS ({STATUS_ORDERS_SQL}), {_THREE_SQL} SELECT id, split FROM p WHERE split IN ('train', 'val')")
def merge_splits(spark, sf):
    rows = split.stratified_split3(_status_orders(spark, sf), "id", "y")
    return split.merge_splits(rows, ["train", "val"]).select("id", "split")


@query("leak_check", f"""
WITH t AS ({LABELLED_SQL}), s AS ({sql_split('t')})
SELECT sha256(text) AS key, count(DISTINCT split) AS splits, count(*) AS rows FROM s GROUP BY 1 HAVING count(DISTINCT split) > 1""")
def leak_check(spark, sf):
    docs = labelled_documents(spark, sf).select("id", "y", F.sha2("text", 256).alias("key"))
    return split.leak_check(split.stratified_split(docs, "id", "y"), "key")
