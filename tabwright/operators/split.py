"""Exact stratified holdouts and folds, reproducible from (seed, id) alone.

A holdout is "the first q rows of each class in hash order". Counts per hash bucket and one
look into the bucket at the edge give the hash of the q-th row; from then on the split is a
comparison inside a projection. Folds come in two forms: dealt in turn by rank, which needs
every row's rank and one bucketed window, or cut from the hash order, which moves nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.functions.keys import id_hash
from tabwright.functions.ordering import hash_buckets, hash_cuts, hash_rank
from tabwright.session import fitted


def _quota(counts: DataFrame, label: str, size: Column, n: str, out: str) -> DataFrame:
    """Per-class share of a holdout of ``size`` rows: floors plus largest remainders.

    ``counts`` has one row per class, so the unpartitioned windows see k rows only.
    """
    whole = Window.partitionBy()
    total = F.sum(n).over(whole)
    exact = F.col(n).cast("double") * F.col("_size") / total
    sized = counts.withColumn("_size", size).withColumn("_exact", exact)
    sized = sized.withColumn("_floor", F.floor("_exact"))
    left = F.col("_size") - F.sum("_floor").over(whole)
    place = F.row_number().over(
        Window.partitionBy().orderBy((F.col("_exact") - F.col("_floor")).desc(), label)
    )
    return sized.withColumn(out, (F.col("_floor") + (place <= left).cast("long")).cast("long")).drop(
        "_size", "_exact", "_floor"
    )


def _ceil_share(n: str, share: float) -> Column:
    return F.ceil(F.sum(n).over(Window.partitionBy()) * F.lit(float(share)))


def _by_cuts(
    df: DataFrame, id_col: str, label: str, seed, quotas: DataFrame, parts: dict, buckets, out: str, rest="train"
) -> DataFrame:
    """Name each row by the first cut its hash does not exceed; a projection, nothing moves."""
    cuts = hash_cuts(df, id_col, seed, label, quotas, list(parts.values()), buckets)
    renamed = cuts.select(F.col(label), *[F.col(q).alias(f"_cut{q}") for q in parts.values()])
    h, name = id_hash(seed, F.col(id_col)), None
    for part, q in parts.items():
        test = h <= F.col(f"_cut{q}")
        name = F.when(test, part) if name is None else name.when(test, part)
    return df.join(renamed, label, "left").withColumn(out, name.otherwise(rest)).select(*df.columns, out)


def stratified_split(
    df: DataFrame, id_col: str, label: str, test: float = 0.2, seed=42, out: str = "split"
) -> DataFrame:
    """Exact per-class holdout: adds ``split`` in {train, test}. Ids must be unique.

    The input is read to count, to find the edge, and to name the rows: write an expensive
    plan (a join, a parse) to a table first.
    """
    buckets = hash_buckets(df, id_col, seed, [label])
    counts = buckets.groupBy(label).agg(F.sum("_n").alias("_n"))
    quota = _quota(counts, label, _ceil_share("_n", test), "_n", "_q")
    return _by_cuts(df, id_col, label, seed, quota, {"test": "_q"}, buckets, out)


def stratified_split3(
    df: DataFrame, id_col: str, label: str, holdout: float = 0.4, test_of_holdout: float = 0.5,
    seed=42, out: str = "split",
) -> DataFrame:
    """train / val / test by a nested exact split, cut on one hash order."""
    buckets = hash_buckets(df, id_col, seed, [label])
    counts = buckets.groupBy(label).agg(F.sum("_n").alias("_n"))
    quota = _quota(counts, label, _ceil_share("_n", holdout), "_n", "_q1")
    quota = _quota(quota, label, _ceil_share("_q1", test_of_holdout), "_q1", "_q2")
    return _by_cuts(df, id_col, label, seed, quota, {"test": "_q2", "val": "_q1"}, buckets, out)


def stratified_folds(
    df: DataFrame, id_col: str, label: str, k: int = 5, seed=42, out: str = "fold"
) -> DataFrame:
    """Fold number 0..k-1; class counts of two folds differ by one at most."""
    buckets = hash_buckets(df, id_col, seed, [label])
    counts = buckets.groupBy(label).agg(F.sum("_n").alias("_n"))
    before = Window.partitionBy().orderBy(label).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(label, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    ranked = hash_rank(df, id_col, seed, [label], "_r", buckets)
    return (
        ranked.join(fitted(offsets), label)
        .withColumn(out, ((F.col("_before") + F.col("_r") - 1) % k).cast("int"))
        .select(*df.columns, out)
    )


def stratified_cut_folds(
    df: DataFrame, id_col: str, label: str, k: int = 5, seed=42, out: str = "fold"
) -> DataFrame:
    """Fold number 0..k-1 as runs of each class's hash order; class counts of two folds differ by one at most.

    Fold sizes are those of ``stratified_folds``, but k - 1 cuts per class name the rows in a
    projection, so wide rows (texts) are neither ranked nor moved. Ids must be unique.
    """
    if k < 2:
        return df.withColumn(out, F.lit(0))
    buckets = hash_buckets(df, id_col, seed, [label])
    counts = buckets.groupBy(label).agg(F.sum("_n").alias("_n"))
    before = Window.partitionBy().orderBy(label).rowsBetween(Window.unboundedPreceding, -1)
    dealt = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    # places of the class that fall to folds 0..f when all rows are dealt in turn
    upto, names = F.lit(0), {}
    quotas = dealt
    for f in range(k - 1):
        upto = upto + F.expr(f"(_before + _n - 1 - {f} + {k}) div {k} - (_before - 1 - {f} + {k}) div {k}")
        names[f] = f"_q{f}"
        quotas = quotas.withColumn(names[f], upto)
    return _by_cuts(df, id_col, label, seed, quotas, names, buckets, out, k - 1)


def merge_splits(df: DataFrame, names: Sequence[str], split: str = "split") -> DataFrame:
    """Rows of several splits together, for a refit before the single test evaluation."""
    return df.where(F.col(split).isin(*names))


def leak_check(df: DataFrame, key: str, split: str = "split") -> DataFrame:
    """Keys that occur in more than one split."""
    return (
        df.groupBy(F.col(key))
        .agg(F.count_distinct(split).alias("splits"), F.count(F.lit(1)).alias("rows"))
        .where("splits > 1")
    )
