"""Global ranks and running sums without a single-partition window.

Rows are first put into buckets that respect the wanted order, sums are taken per
bucket, and the (small) running sum over buckets is added back to the running sum
inside each bucket. No window ever sees more than one bucket of row-level data.
"""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.functions.keys import id_hash
from tabwright.session import SMALL_ROWS, bucket_target, fitted, materialize


def hash_digits(spark) -> int:
    """Leading hex digits used as bucket: 4096 buckets per group, 65536 on wide clusters."""
    return 3 if bucket_target(spark) <= 512 else 4


def hash_buckets(df: DataFrame, id_col: str, seed, by: Sequence[str] = (), groups: int = 2) -> DataFrame:
    """(by..., _hb, _n): rows per hash bucket, at most 16**digits per group.

    ``groups`` is the expected number of ``by`` groups; it decides whether the counts stay
    literal rows or are written.
    """
    digits = hash_digits(df.sparkSession)
    head = F.substring(id_hash(seed, F.col(id_col)), 1, digits)
    counts = df.groupBy(*by, head.alias("_hb")).agg(F.count(F.lit(1)).alias("_n"))
    return fitted(counts, "buckets") if groups * 16**digits <= SMALL_ROWS else materialize(counts, "buckets")


def hash_rank(
    df: DataFrame, id_col: str, seed, by: Sequence[str] = (), rank: str = "rank", buckets: DataFrame | None = None
) -> DataFrame:
    """1-based rank in seeded hash order inside each ``by`` group.

    The leading hex digits are the bucket, so one class holding most rows is still spread
    over thousands of window partitions. ``buckets`` reuses counts made by hash_buckets.
    """
    keys = [*by, "_hb"]
    counts = hash_buckets(df, id_col, seed, by) if buckets is None else buckets
    before = Window.partitionBy(*by).orderBy("_hb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    hashed = df.withColumn("_h", id_hash(seed, F.col(id_col))).withColumn(
        "_hb", F.substring("_h", 1, hash_digits(df.sparkSession))
    )
    inside = Window.partitionBy(*keys).orderBy("_h", id_col)
    return (
        hashed.withColumn("_in", F.row_number().over(inside))
        .join(offsets, keys)
        .withColumn(rank, F.col("_in") + F.col("_before"))
        .drop("_h", "_hb", "_in", "_before")
    )


def hash_cuts(
    df: DataFrame, id_col: str, seed, by: str, quotas: DataFrame, names: Sequence[str], buckets: DataFrame
) -> DataFrame:
    """(by, names...): the hash of the row at each wanted place of a group's hash order.

    With the cut known, "is among the first q rows" is a comparison on the row itself: no
    row has to be ranked or moved. Only the rows of the one bucket that holds a cut are
    sorted. A quota of 0 gives a null cut.
    """
    running = buckets.withColumn(
        "_upto",
        F.sum("_n").over(Window.partitionBy(by).orderBy("_hb").rowsBetween(Window.unboundedPreceding, 0)),
    )
    wanted = F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("q")) for n in names])
    targets = quotas.select(by, F.explode(wanted).alias("t")).select(by, "t.name", "t.q")
    edges = running.join(targets, by).where((F.col("_upto") >= F.col("q")) & (F.col("_upto") - F.col("_n") < F.col("q")))
    edges = fitted(edges.select(by, "_hb", "name", (F.col("q") - F.col("_upto") + F.col("_n")).alias("_place")), "edges")
    hashed = df.select(by, F.col(id_col).alias("_id"), id_hash(seed, F.col(id_col)).alias("_h"))
    near = hashed.withColumn("_hb", F.substring("_h", 1, hash_digits(df.sparkSession))).join(edges, [by, "_hb"])
    place = F.row_number().over(Window.partitionBy(by, "name").orderBy("_h", "_id"))
    cut = near.withColumn("_at", place).where(F.col("_at") == F.col("_place"))
    return fitted(cut.groupBy(by).agg(*[F.max(F.when(F.col("name") == n, F.col("_h"))).alias(n) for n in names]), "cuts")


def order_buckets(
    df: DataFrame, value: str, by: Sequence[str] = (), descending: bool = False, bucket: str = "_b"
) -> DataFrame:
    """Add an order-preserving bucket number to a table that has been materialised.

    Bucket edges are approximate quantiles, one bounded array per group. They are fixed
    before use (a literal without groups, a written table with them), so every reader of
    the plan sees the same edges and results stay exact.
    """
    n = bucket_target(df.sparkSession)
    step = max(2, math.isqrt(n))
    edges = df.groupBy(*by).agg(F.percentile_approx(value, [i / n for i in range(1, n)], 10 * n).alias("_cuts"))
    edges = edges.withColumn("_coarse", F.filter("_cuts", lambda c, i: (i + 1) % step == 0))
    if by:
        # long edge lists are written; short ones may stay literal rows
        rows = df.join((fitted if n <= 256 else materialize)(edges, "cuts"), list(by))
    else:
        found = edges.first()
        rows = df.withColumns({c: F.array(*[F.lit(v) for v in found[c] or []]) for c in ("_cuts", "_coarse")})

    def smaller(cuts: Column) -> Column:
        return F.size(F.filter(cuts, lambda c: c < F.col(value)))

    # every step-th edge first, then the edges up to the next one: about 2 * sqrt(n) comparisons
    rows = rows.withColumn("_at", smaller(F.col("_coarse")) * step)
    below = F.col("_at") + smaller(F.slice("_cuts", F.col("_at") + 1, step - 1))
    number = F.lit(n) - below if descending else below
    return rows.withColumn(bucket, number).drop("_cuts", "_coarse", "_at")


def running_sums(
    df: DataFrame,
    value: str,
    sums: Mapping[str, str],
    by: Sequence[str] = (),
    descending: bool = False,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Inclusive running sums in ``value`` order inside each ``by`` group.

    ``df`` must be materialised and hold one row per (by, value, ties).
    ``sums`` maps an input column to the name of its running sum.
    """
    keys = list(by)
    bucketed = order_buckets(df, value, keys, descending)
    per_bucket = bucketed.groupBy(*keys, "_b").agg(
        *[F.sum(src).alias(f"_t_{dst}") for src, dst in sums.items()]
    )
    # one row per bucket here, so this window is as small as the bucket count
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        *keys,
        "_b",
        *[F.coalesce(F.sum(f"_t_{d}").over(before), F.lit(0)).alias(f"_o_{d}") for d in sums.values()],
    )
    order = F.col(value).desc() if descending else F.col(value).asc()
    inside = (
        Window.partitionBy(*keys, "_b")
        .orderBy(order, *ties)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    out = bucketed.select("*", *[F.sum(s).over(inside).alias(f"_i_{d}") for s, d in sums.items()])
    out = out.join(offsets, [*keys, "_b"])
    for dst in sums.values():
        out = out.withColumn(dst, F.col(f"_i_{dst}") + F.col(f"_o_{dst}"))
    return out.select(*df.columns, *sums.values())


def ordered_rows(
    df: DataFrame, id_col: str, score: str, sums: Mapping[str, str], by: Sequence[str] = ()
) -> DataFrame:
    """Row-level running sums in (score descending, id ascending) order.

    A single score shared by a large part of the table is split further by id range,
    so tied rows never gather in one window partition. Rows without a score come last.
    """
    keys = list(by)
    base = materialize(df.select(*keys, id_col, score, *sums), "rows")
    rows = order_buckets(base, id_col, keys, bucket="_ib")
    cell = [*keys, score, "_ib"]
    cells = materialize(
        rows.groupBy(*cell).agg(*[F.sum(s).alias(f"_c_{d}") for s, d in sums.items()]), "cells"
    )
    upto = running_sums(
        cells, score, {f"_c_{d}": f"_u_{d}" for d in sums.values()}, keys, True, ties=["_ib"]
    )
    inside = (
        Window.partitionBy(*cell)
        .orderBy(id_col)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    out = rows.select("*", *[F.sum(s).over(inside).alias(f"_i_{d}") for s, d in sums.items()])
    # null-safe: rows without a score come last and keep their place
    upto = upto.withColumnsRenamed({c: f"_k_{c}" for c in cell})
    same = functools.reduce(operator.and_, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in cell])
    out = out.join(upto, same)
    for dst in sums.values():
        out = out.withColumn(dst, F.col(f"_i_{dst}") + F.col(f"_u_{dst}") - F.col(f"_c_{dst}"))
    return out.select(*by, id_col, score, *sums.keys(), *sums.values())


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Linear-interpolated quantiles, exact at any size: (by..., column, prob, value).

    Works on value frequencies and their running counts instead of holding a whole
    group's values in one aggregation buffer.
    """
    keys = [*by, "column"]
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    long = df.select(*by, F.expr(f"stack({len(cols)}, {pairs}) AS (column, value)"))
    long = long.where(F.col("value").isNotNull() & ~F.isnan("value"))
    freq = materialize(long.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n")), "freq")
    totals = freq.groupBy(*keys).agg(F.sum("n").alias("total"))
    upto = running_sums(freq, "value", {"n": "upto"}, keys)
    prob_rows = F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob")
    wanted = totals.select(*keys, (F.col("total") - 1).alias("_last"), prob_rows).withColumn(
        "_pos", F.col("prob") * F.col("_last")
    )
    ends = wanted.select(
        *keys,
        "prob",
        "_pos",
        F.explode(F.array_distinct(F.array(F.floor("_pos"), F.ceil("_pos")))).alias("_at"),
    )
    # each group asks for at most 2*len(probs) ranks; a value row keeps only those it covers
    grouped = fitted(ends.groupBy(*keys).agg(F.collect_list(F.struct("prob", "_pos", "_at")).alias("_ends")), "ranks")
    hit = (
        upto.join(grouped, keys)
        .withColumn(
            "_e",
            F.explode(
                F.filter(
                    "_ends",
                    lambda e: (e["_at"] < F.col("upto")) & (e["_at"] >= F.col("upto") - F.col("n")),
                )
            ),
        )
        .select(*keys, "_e.*", "value")
    )
    low, high = F.min("value"), F.max("value")
    part = F.col("_pos") - F.floor(F.col("_pos"))
    return hit.groupBy(*keys, "prob", "_pos").agg(low.alias("_lo"), high.alias("_hi")).select(
        *keys, "prob", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * part).alias("value")
    )


def pick(quantiles: DataFrame, by: Sequence[str], names: Mapping[float, str]) -> DataFrame:
    """Quantile rows to one wide row per (by, column)."""
    return quantiles.groupBy(*by, "column").agg(
        *[F.max(F.when(F.col("prob") == F.lit(float(p)), F.col("value"))).alias(n) for p, n in names.items()]
    )

