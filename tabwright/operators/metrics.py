"""Class metrics, all derived from one confusion aggregate."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ratio(num: Column, den: Column) -> Column:
    """num / den, 0 when the denominator is 0."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def f_beta(precision: Column, recall: Column, beta: float = 1.0) -> Column:
    b2 = float(beta) ** 2
    return ratio((1.0 + b2) * precision * recall, b2 * precision + recall)


def confusion_counts(df: DataFrame, y: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., y, pred, n): the only pass over the rows."""
    return df.groupBy(*by, F.col(y).alias("y"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, y: str, pred: str, labels: Sequence) -> DataFrame:
    """Counts for every declared (actual, predicted) pair, zero cells included."""
    cells = [F.struct(F.lit(a).alias("y"), F.lit(p).alias("pred")) for a in labels for p in labels]
    grid = df.sparkSession.range(1).select(F.explode(F.array(*cells)).alias("c")).select("c.*")
    counts = confusion_counts(df, y, pred)
    return grid.join(counts, ["y", "pred"], "left").select("y", "pred", F.coalesce("n", F.lit(0)).alias("n"))


def binary_counts(counts: DataFrame, positive, by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn, tn for one positive class from confusion counts."""
    is_pos, said_pos = F.col("y") == F.lit(positive), F.col("pred") == F.lit(positive)

    def cell(test: Column) -> Column:
        return F.sum(F.when(test, F.col("n")).otherwise(0))

    return counts.groupBy(*by).agg(
        cell(is_pos & said_pos).alias("tp"),
        cell(~is_pos & said_pos).alias("fp"),
        cell(is_pos & ~said_pos).alias("fn"),
        cell(~is_pos & ~said_pos).alias("tn"),
    )


def precision_of() -> Column:
    return ratio(F.col("tp"), F.col("tp") + F.col("fp"))


def recall_of() -> Column:
    return ratio(F.col("tp"), F.col("tp") + F.col("fn"))


def accuracy_of() -> Column:
    return ratio(F.col("tp") + F.col("tn"), F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn"))


def f_of(beta: float = 1.0) -> Column:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    b2 = float(beta) ** 2
    return ratio((1.0 + b2) * tp, (1.0 + b2) * tp + b2 * fn + fp)


def weighted_f1_of() -> Column:
    """Support-weighted F1 over both classes of a binary problem."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    pos, neg = tp + fn, tn + fp
    other = ratio(2 * tn, 2 * tn + fn + fp)
    return ratio(pos * f_of() + neg * other, pos + neg)


# name -> expression over (tp, fp, fn, tn) of the chosen positive class
SCORERS: dict[str, Callable[[], Column]] = {
    "accuracy": accuracy_of,
    "precision": precision_of,
    "recall": recall_of,
    "f1": f_of,
    "f2": lambda: f_of(2.0),
    "f1_weighted": weighted_f1_of,
}


def binary_scores(
    df: DataFrame, y: str, pred: str, positive=1, by: Sequence[str] = (), names: Sequence[str] = tuple(SCORERS)
) -> DataFrame:
    """One row per group with the named scores of the positive class."""
    cells = binary_counts(confusion_counts(df, y, pred, by), positive, by)
    return cells.select(*by, *[SCORERS[n]().alias(n) for n in names])


def classification_report(df: DataFrame, y: str, pred: str) -> DataFrame:
    """(class, precision, recall, f1, support) per class plus accuracy and averages."""
    counts = confusion_counts(df, y, pred)
    hit = F.when(F.col("y") == F.col("pred"), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("long")
    sides = counts.select(
        F.explode(
            F.array(
                F.struct(F.col("y").cast("string").alias("class"), F.col("n").alias("support"),
                         zero.alias("called"), hit.cast("long").alias("tp")),
                F.struct(F.col("pred").cast("string").alias("class"), zero.alias("support"),
                         F.col("n").alias("called"), zero.alias("tp")),
            )
        ).alias("s")
    ).select("s.*")
    tp, support, called = F.sum("tp"), F.sum("support"), F.sum("called")
    per_class = sides.groupBy("class").agg(
        ratio(tp, called).alias("precision"),
        ratio(tp, support).alias("recall"),
        ratio(2 * tp, called + support).alias("f1"),
        support.alias("support"),
        tp.alias("tp"),
    )
    scores = ["precision", "recall", "f1"]
    # every average comes from the k class rows in one step; rows of the table are not read again
    whole = Window.partitionBy()
    total = F.sum("support").over(whole)
    wide = per_class.select(
        "*",
        total.alias("_total"),
        (F.sum("tp").over(whole) / total).alias("_accuracy"),
        *[F.avg(c).over(whole).alias(f"_macro_{c}") for c in scores],
        *[(F.sum(F.col(c) * F.col("support")).over(whole) / total).alias(f"_weighted_{c}") for c in scores],
        F.row_number().over(Window.partitionBy().orderBy("class")).alias("_first"),
    )

    def row(name: Column, cols: Sequence[Column], support_col: Column) -> Column:
        named = [c.alias(n) for c, n in zip(cols, scores)]
        return F.struct(name.alias("class"), *named, support_col.alias("support"))

    own = row(F.col("class"), [F.col(c) for c in scores], F.col("support"))
    averages = [
        row(F.lit("accuracy"), [F.col("_accuracy")] * 3, F.col("_total")),
        row(F.lit("macro avg"), [F.col(f"_macro_{c}") for c in scores], F.col("_total")),
        row(F.lit("weighted avg"), [F.col(f"_weighted_{c}") for c in scores], F.col("_total")),
    ]
    rows = F.when(F.col("_first") == 1, F.array(own, *averages)).otherwise(F.array(own))
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def error_rows(df: DataFrame, y: str, pred: str, id_col: str, score: str, n: int | None = None) -> DataFrame:
    """Misclassified rows, most confident first; ``n`` keeps the head of the list."""
    wrong = df.where(F.col(y) != F.col(pred)).select(id_col, y, pred, score)
    return wrong.orderBy(F.desc(score), id_col).limit(n) if n else wrong


def degenerate_flag(df: DataFrame, y: str, score: str, threshold: float) -> DataFrame:
    """Does the threshold flag nearly everybody, or add nothing over the base rate?"""
    flagged = F.col(score) >= F.lit(float(threshold))
    stats = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(flagged.cast("long")).alias("flagged"),
        F.sum(F.when(flagged, F.col(y)).otherwise(0)).alias("_tp"),
        F.avg(F.col(y).cast("double")).alias("base_rate"),
    ).withColumn("precision", ratio(F.col("_tp"), F.col("flagged")))
    nearly_all = F.col("flagged") >= 0.95 * F.col("rows")
    no_gain = F.abs(F.col("precision") - F.col("base_rate")) < 0.01
    return stats.withColumn("degenerate", (nearly_all | no_gain).cast("int")).drop("_tp")


def metric_rows(wide: DataFrame, names: Sequence[str]) -> DataFrame:
    """One wide row to long (metric, value) rows."""
    pairs = [F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names]
    return wide.select(F.explode(F.array(*pairs)).alias("m")).select("m.*")
