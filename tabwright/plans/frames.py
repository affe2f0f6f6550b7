"""Labelled tables derived from the standard tables, in Spark and as SQL text.

The Spark function and the SQL fragment of one name describe the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.keys import HEX_SPAN, hash_uniform
from tabwright.sources.tables import read_parquet, spread_scan


def sql_hash(seed: str, *parts: str) -> str:
    inner = " || '~' || ".join([f"'{seed}'", *[f"CAST({p} AS VARCHAR)" for p in parts]])
    return f"md5({inner})"


def sql_uniform(seed: str, *parts: str) -> str:
    return f"(CAST(('0x' || substr({sql_hash(seed, *parts)}, 1, 12)) AS BIGINT) / CAST({HEX_SPAN} AS DOUBLE))"


def sql_tidy(expr: str, digits: int = 6) -> str:
    return f"(round(CAST({expr} AS DOUBLE), {digits}) + 0.0e0)"


def orders(spark: SparkSession, sf: str) -> DataFrame:
    return read_parquet(spark, sf, "orders")


def campaign(spark: SparkSession, sf: str) -> DataFrame:
    """orders joined to their customer with a planted 0/1 label ``y``; id is o_orderkey."""
    cust = read_parquet(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey")
    rows = orders(spark, sf).join(cust, F.col("o_custkey") == F.col("c_custkey"))
    return rows.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_totalprice").alias("price"),
        F.col("c_acctbal").alias("balance"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"),
        planted_label().alias("y"),
    )


def planted_label() -> Column:
    signal = (
        F.when(F.col("o_totalprice") > 350000.0, 1.2).otherwise(0.0)
        + F.when(F.col("o_orderpriority") == "1-URGENT", 0.8).otherwise(0.0)
        - F.when(F.col("c_acctbal") < 1000.0, 0.5).otherwise(0.0)
        + hash_uniform("label", F.col("o_orderkey"))
    )
    return (signal > 1.0).cast("int")


CAMPAIGN_SQL = f"""
SELECT o_orderkey AS id, o_totalprice AS price, c_acctbal AS balance, o_orderpriority AS priority,
       o_orderstatus AS status, c_mktsegment AS segment, c_nationkey AS nation,
       CAST(CASE WHEN (CASE WHEN o_totalprice > 350000e0 THEN 1.2e0 ELSE 0e0 END)
            + (CASE WHEN o_orderpriority = '1-URGENT' THEN 0.8e0 ELSE 0e0 END)
            - (CASE WHEN c_acctbal < 1000e0 THEN 0.5e0 ELSE 0e0 END)
            + {sql_uniform('label', 'o_orderkey')} > 1e0 THEN 1 ELSE 0 END AS INTEGER) AS y
FROM orders JOIN customer ON o_custkey = c_custkey"""


def scored_orders(spark: SparkSession, sf: str) -> DataFrame:
    """(id, y, score, pred): a fixed scorer with many ties, independent of any fit."""
    raw = 0.7 * hash_uniform("score", F.col("o_orderkey")) + F.when(F.col("o_orderstatus") == "F", 0.3).otherwise(0.0)
    base = orders(spark, sf).select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_orderstatus") == "F").cast("int").alias("y"),
        F.round(raw, 3).alias("score"),
    )
    return base.withColumn("pred", (F.col("score") >= 0.5).cast("int"))


SCORED_SQL = f"""
SELECT *, CAST(score >= 0.5e0 AS INTEGER) AS pred FROM (
SELECT o_orderkey AS id, CAST(o_orderstatus = 'F' AS INTEGER) AS y,
       round(0.7e0 * {sql_uniform('score', 'o_orderkey')}
             + (CASE WHEN o_orderstatus = 'F' THEN 0.3e0 ELSE 0e0 END), 3) AS score
FROM orders)"""


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """(id, text) of all documents."""
    scan = read_parquet(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    return spread_scan(scan)


def labelled_documents(spark: SparkSession, sf: str) -> DataFrame:
    """(id, text, y): documents with a toxicity label."""
    docs = documents(spark, sf)
    labels = read_parquet(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.col("toxic").alias("y"))
    return docs.join(labels, "id")


LABELLED_SQL = """
SELECT d.doc_id AS id, d.text AS text, l.toxic AS y
FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    """(id, x, y): embeddings as doubles with a binary label."""
    return read_parquet(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.col("embedding").cast("array<double>").alias("x"),
        (F.col("label") < 5).cast("int").alias("y"),
    )


VECTORS_SQL = """
SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS x, CAST(label < 5 AS INTEGER) AS y FROM embeddings"""


def sql_split(source: str, test: float = 0.2, seed: str = "42") -> str:
    """``source`` (a relation with id, y) plus a ``split`` column; the twin of stratified_split."""
    return f"""
SELECT r.*, CASE WHEN r._r <= q._q THEN 'test' ELSE 'train' END AS split
FROM (SELECT s.*, row_number() OVER (PARTITION BY y ORDER BY {sql_hash(seed, 'id')}, id) AS _r FROM {source} s) r
JOIN ({sql_quota(source, test)}) q ON r.y = q.y"""


def sql_quota(source: str, test: float, n: str = "_n", out: str = "_q") -> str:
    counts = f"SELECT y, count(*) AS _n FROM {source} GROUP BY y" if n == "_n" else source
    return f"""
SELECT y, _n, _floor + CASE WHEN row_number() OVER (ORDER BY _exact - _floor DESC, y) <= _size - sum(_floor) OVER ()
                       THEN 1 ELSE 0 END AS {out}
FROM (SELECT *, floor(_exact) AS _floor FROM (
        SELECT *, CAST(_n * _size AS DOUBLE) / sum(_n) OVER () AS _exact FROM (
          SELECT *, ceil(sum(_n) OVER () * {test}e0) AS _size FROM ({counts}))))"""


def sql_folds(source: str, k: int = 5, seed: str = "42") -> str:
    return f"""
SELECT r.*, CAST((o._before + r._r - 1) % {k} AS INTEGER) AS fold
FROM (SELECT s.*, row_number() OVER (PARTITION BY y ORDER BY {sql_hash(seed, 'id')}, id) AS _r FROM {source} s) r
JOIN (SELECT y, coalesce(sum(n) OVER (ORDER BY y ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _before
      FROM (SELECT y, count(*) AS n FROM {source} GROUP BY y)) o ON r.y = o.y"""


def sql_cut_folds(source: str, k: int = 5, seed: str = "42") -> str:
    """Twin of stratified_cut_folds: runs of each class's hash order."""
    share = [f"(o._before + o.n - 1 - {f} + {k}) // {k} - (o._before - 1 - {f} + {k}) // {k}" for f in range(k - 1)]
    cases = " ".join(f"WHEN r._r <= {' + '.join(share[: f + 1])} THEN {f}" for f in range(k - 1))
    return f"""
SELECT r.* EXCLUDE (_r), CAST(CASE {cases} ELSE {k - 1} END AS INTEGER) AS fold
FROM (SELECT s.*, row_number() OVER (PARTITION BY y ORDER BY {sql_hash(seed, 'id')}, id) AS _r FROM {source} s) r
JOIN (SELECT y, n, CAST(coalesce(sum(n) OVER (ORDER BY y ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS _before
      FROM (SELECT y, count(*) AS n FROM {source} GROUP BY y)) o ON r.y = o.y"""


def sql_split3(source: str, holdout: float = 0.4, test_of_holdout: float = 0.5, seed: str = "42") -> str:
    """``source`` plus a ``split`` column in train, val, test; the twin of stratified_split3."""
    return f"""
WITH q1 AS ({sql_quota(source, holdout, out='_q1')}), q2 AS ({sql_quota('(SELECT y, _q1 AS _n FROM q1)', test_of_holdout, n='_q1', out='_q2')}),
r AS (SELECT s.*, row_number() OVER (PARTITION BY y ORDER BY {sql_hash(seed, 'id')}, id) AS _r FROM {source} s)
SELECT r.* EXCLUDE (_r), CASE WHEN _r <= _q2 THEN 'test' WHEN _r <= _q1 THEN 'val' ELSE 'train' END AS split
FROM r JOIN q1 ON r.y = q1.y JOIN q2 ON r.y = q2.y"""
