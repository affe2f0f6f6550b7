"""Exact ranking metrics and curves from one table of distinct scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.ordering import ordered_rows, running_sums
from tabwright.operators.metrics import ratio
from tabwright.session import fitted, materialize

# a top list up to this length is cheap as a bounded heap per task
TOP_LIMIT = 100_000


def curve_table(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., score, n, pos, seen, tp, rows, positives), scores descending.

    Rows collapse to distinct scores with map-side combining before anything is ordered;
    ``seen`` and ``tp`` count rows and positives at or above the score.
    """
    keys = list(by)
    dist = df.groupBy(*keys, F.col(score).cast("double").alias("score")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(y).cast("long")).alias("pos")
    )
    dist = materialize(dist, "scores")
    total = [F.sum("n").alias("rows"), F.sum("pos").alias("positives")]
    upto = running_sums(dist, "score", {"n": "seen", "pos": "tp"}, keys, descending=True)
    if keys:
        return upto.join(fitted(dist.groupBy(*keys).agg(*total)), keys)
    sums = dist.agg(*total).first()
    return upto.withColumns({c: F.lit(sums[c] or 0).cast("long") for c in ("rows", "positives")})


def _auc() -> Column:
    # doubles: a product of two row counts leaves the range of a long at a few billion rows
    fp_here = (F.col("n") - F.col("pos")).cast("double")
    tp_before = (F.col("tp") - F.col("pos")).cast("double")
    pairs = F.col("positives").cast("double") * (F.col("rows") - F.col("positives")).cast("double")
    return ratio(F.sum(fp_here * (tp_before + F.col("pos") / 2.0)), F.max(pairs))


def _ap() -> Column:
    """Sum of recall steps times precision (no interpolation)."""
    step = F.col("pos") / F.col("positives") * (F.col("tp") / F.col("seen"))
    return F.coalesce(F.sum(F.when(F.col("positives") > 0, step)), F.lit(0.0))


def roc_auc(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Area under ROC; tied scores get half credit."""
    return curve.groupBy(*by).agg(_auc().alias("roc_auc"))


def average_precision(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return curve.groupBy(*by).agg(_ap().alias("average_precision"))


def auc_and_ap(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return curve.groupBy(*by).agg(_auc().alias("roc_auc"), _ap().alias("average_precision"))


def roc_curve(curve: DataFrame) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score plus the (0, 0) start at infinity."""
    fp = F.col("seen") - F.col("tp")
    points = curve.select(
        F.col("score").alias("threshold"),
        ratio(fp, F.col("rows") - F.col("positives")).alias("fpr"),
        ratio(F.col("tp"), F.col("positives")).alias("tpr"),
    )
    start = curve.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(start)


def pr_points(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., threshold, precision, recall) per distinct score; the rule is score >= threshold."""
    return curve.select(
        *by,
        F.col("score").alias("threshold"),
        ratio(F.col("tp"), F.col("seen")).alias("precision"),
        ratio(F.col("tp"), F.col("positives")).alias("recall"),
    )


def pr_curve(curve: DataFrame) -> DataFrame:
    """Precision-recall points plus the closing (1, 0) row, which has no threshold."""
    end = curve.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return pr_points(curve).unionByName(end)


def top_k(df: DataFrame, id_col: str, score: str, k: int, heap: int = TOP_LIMIT) -> DataFrame:
    """The k best rows by (score descending, id ascending), rows without a score last.

    Up to ``heap`` rows each task keeps its k best; beyond it rows are ranked globally. Both
    give the same rows.
    """
    if k <= heap:
        return df.orderBy(F.desc(score), id_col).limit(k)
    ranked = ordered_rows(df.withColumn("_one", F.lit(1)), id_col, score, {"_one": "_rank"})
    return df.join(ranked.where(F.col("_rank") <= k).select(id_col), id_col, "left_semi")


def precision_lift_at_k(df: DataFrame, y: str, id_col: str, score: str, k: int) -> DataFrame:
    """Precision among the top k, its lift over the base rate, and the k really used."""
    head = top_k(df.select(id_col, score, y), id_col, score, k).agg(
        F.count(F.lit(1)).alias("k"), F.avg(F.col(y).cast("double")).alias("precision_at_k")
    )
    rate = df.agg(F.avg(F.col(y).cast("double"))).first()[0]
    base = F.lit(rate).cast("double")
    return head.withColumn("base_rate", base).withColumn("lift_at_k", ratio(F.col("precision_at_k"), base))


def cumulative_gain(df: DataFrame, y: str, id_col: str, score: str, points: int | None = None) -> DataFrame:
    """Share of rows contacted against share of positives captured, best score first.

    ``points`` keeps that many evenly spaced rows of the curve.
    """
    flags = df.select(id_col, score, F.col(y).cast("long").alias("_y"), F.lit(1).cast("long").alias("_one"))
    sums = flags.agg(F.sum("_one").alias("n"), F.sum("_y").alias("p")).first()
    n, p = sums["n"] or 0, sums["p"] or 0
    ranked = ordered_rows(flags, id_col, score, {"_one": "position", "_y": "captured"})
    if points:
        step = lambda c: F.floor(c * points / F.lit(float(n)))
        ranked = ranked.where(step(F.col("position")) > step(F.col("position") - 1))
    return ranked.select(
        "position",
        ratio(F.col("position"), F.lit(n).cast("long")).alias("share_contacted"),
        ratio(F.col("captured"), F.lit(p).cast("long")).alias("share_captured"),
    )
