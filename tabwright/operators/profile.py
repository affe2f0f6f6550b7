"""Profiling aggregates and the data behind histograms, heat maps and box plots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.moments import pair_sums
from tabwright.functions.ordering import exact_quantiles, pick
from tabwright.session import fitted, materialize

def value_counts(df: DataFrame, col: str, normalize: bool = True) -> DataFrame:
    """Count (and share) per value, descending."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    if not normalize:
        return counts.orderBy(F.desc("n"), col)
    # the total is one number, summed over the per-value counts
    counts = materialize(counts, "value-counts")
    total = counts.agg(F.sum("n")).first()[0]
    return counts.withColumn("share", F.col("n") / F.lit(total)).orderBy(F.desc("n"), col)


def group_rate(df: DataFrame, by: str, target: str, levels: Sequence | None = None) -> DataFrame:
    """Mean target per group; declared levels stay in the result even when empty."""
    rate = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.avg(target).alias("rate"))
    if levels is None:
        return rate
    declared = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(v) for v in levels])).alias(by))
    return declared.join(rate, by, "left").withColumn("n", F.coalesce("n", F.lit(0)))


def describe_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """mean, sample std, min, max per column in one pass."""
    aggs = []
    for c in cols:
        v = F.col(f"`{c}`").cast("double")
        aggs.append(
            F.struct(F.lit(c).alias("column"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
                     F.min(v).alias("min"), F.max(v).alias("max"))
        )
    return df.agg(F.array(*aggs).alias("_all")).select(F.explode("_all").alias("_r")).select("_r.*")


def describe_by(df: DataFrame, by: str, col: str) -> DataFrame:
    """count, mean, std, min, quartiles and max per group; quartiles are exact."""
    v = F.col(col).cast("double")
    basic = df.groupBy(by).agg(
        F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"), F.max(v).alias("max"),
    )
    quart = pick(exact_quantiles(df, [col], [0.25, 0.5, 0.75], [by]), [by],
                 {0.25: "q25", 0.5: "q50", 0.75: "q75"}).drop("column")
    return basic.join(quart, by)


def histogram_by(df: DataFrame, by: str, col: str, bins: int = 50) -> DataFrame:
    """Equal-width bins between each group's own min and max; the last bin is closed."""
    v = F.col(col).cast("double")
    # one row per distinct value first: the join on a hot group then moves counts, not rows
    freq = materialize(df.groupBy(by, v.alias("_v")).agg(F.count(F.lit(1)).alias("_n")))
    span = freq.groupBy(by).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    number = F.when(F.col("_hi") == F.col("_lo"), 0).otherwise(
        F.least(F.floor((F.col("_v") - F.col("_lo")) / width), F.lit(bins - 1))
    )
    return (
        freq.join(fitted(span), by)
        .select(by, number.cast("int").alias("bin"), "_n")
        .groupBy(by, "bin")
        .agg(F.sum("_n").alias("n"))
    )


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long (a, b, r) of pairwise-complete correlations, by one rule at every width.

    A row takes part in a pair if both of its values are there. Fewer than two such rows, or
    a column without variance in them, give null. Columns are centred at their means first
    (a pass of its own), so large offsets cost no digits.
    """
    cols = list(cols)
    means = df.agg(*[F.avg(F.col(f"`{c}`").cast("double")) for c in cols]).first()
    sums = pair_sums(df, cols, [m or 0.0 for m in means])
    n = F.greatest("n", F.lit(1.0))
    vx, vy = F.col("sxx") - F.col("sx") * F.col("sx") / n, F.col("syy") - F.col("sy") * F.col("sy") / n
    flat = (vx <= 1e-13 * F.col("sxx")) | (vy <= 1e-13 * F.col("syy")) | (F.col("n") < 2)
    r = F.when(~flat, (F.col("sxy") - F.col("sx") * F.col("sy") / n) / (F.sqrt(vx) * F.sqrt(vy)))
    names = F.array(*[F.lit(c) for c in cols])
    cells = sums.select(F.element_at(names, F.col("i") + 1).alias("a"), F.element_at(names, F.col("j") + 1).alias("b"), r.alias("r"))
    both = F.array(F.struct("a", "b", "r"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "r"))
    return cells.select(F.explode(F.when(F.col("a") == F.col("b"), F.slice(both, 1, 1)).otherwise(both)).alias("c")).select("c.*")


def box_stats(df: DataFrame, by: str, col: str) -> DataFrame:
    """Quartiles, whiskers at 1.5 IQR clipped to the data, and the outlier count."""
    v = F.col(col).cast("double")
    freq = df.groupBy(by, v.alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    quart = pick(exact_quantiles(df, [col], [0.25, 0.5, 0.75], [by]), [by],
                 {0.25: "q1", 0.5: "median", 0.75: "q3"}).drop("column")
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("_v").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        freq.join(fitted(quart), by)
        .groupBy(by, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(F.col("_n"))).alias("outliers"),
        )
    )


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns"))


def base_rate(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.avg(F.col(label).cast("double")).alias("base_rate"))


def unpack_vector(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """Vector column to one double column per name."""
    arr = vector_to_array(vector) if df.schema[vector].dataType.typeName() == "vectorudt" else F.col(vector)
    return df.select("*", *[arr[i].cast("double").alias(n) for i, n in enumerate(names)])
