"""Linear classifiers, kernel feature maps, calibration and support rows.

Penalty strength follows the convention  penalty + C * sum of weighted losses; Spark ML
minimises  mean loss + regParam * penalty, hence regParam = 1 / (C * sum of weights).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LinearSVC, LinearSVCModel, LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import SparseVector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.operators.wide import WideLogistic, fit_wide_logistic

KERNELS = ("linear", "rbf", "poly", "poly_random")
# numbers of mapped rows that a task holds at once
MAPPED_NUMBERS = 1 << 21
# more coefficients than that are not kept on the driver
WIDE = 1 << 19


def _weight_sum(df: DataFrame, weight: str | None) -> float:
    return float(df.agg(F.sum(weight) if weight else F.count(F.lit(1))).first()[0])


def fit_logistic(
    df: DataFrame, label: str = "y", features: str = "features", C: float = 1.0, penalty: str = "l2",
    weight: str | None = None, max_iter: int = 300, tol: float = 1e-9,
) -> LogisticRegressionModel | WideLogistic:
    """L1 or L2 logistic regression; the intercept is never penalised.

    Sparse vectors of more than WIDE columns are fitted with L2 by ``wide``, as Spark ML keeps some twenty
    vectors of all coefficients on the driver. L1 is always fitted by Spark ML.
    """
    first = df.select(features).first() if penalty == "l2" else None
    if first and isinstance(first[0], SparseVector) and first[0].size > WIDE:
        return fit_wide_logistic(df, label, features, C, weight, max_iter, tol)
    est = LogisticRegression(
        featuresCol=features, labelCol=label, maxIter=max_iter, tol=tol, standardization=False,
        regParam=1.0 / (C * _weight_sum(df, weight)), elasticNetParam=1.0 if penalty == "l1" else 0.0,
    )
    if weight:
        est = est.setWeightCol(weight)
    return est.fit(df)


def fit_linear_svm(
    df: DataFrame, label: str = "y", features: str = "features", C: float = 1.0, weight: str | None = None,
    max_iter: int = 200, tol: float = 1e-7,
) -> LinearSVCModel:
    est = LinearSVC(
        featuresCol=features, labelCol=label, maxIter=max_iter, tol=tol, standardization=False,
        regParam=1.0 / (C * _weight_sum(df, weight)),
    )
    if weight:
        est = est.setWeightCol(weight)
    return est.fit(df)


def converged(model, max_iter: int) -> bool:
    """Whether the optimiser of a freshly fitted linear model stopped by itself before ``max_iter``."""
    summary = model.summary() if callable(model.summary) else model.summary
    return summary.totalIterations < max_iter


def score_model(model, df: DataFrame, positive: int = 1, out: str = "score") -> DataFrame:
    """P(positive) as a plain column, for any probabilistic ML model."""
    scored = model.transform(df)
    keep = [c for c in scored.columns if c not in ("rawPrediction", "probability", "prediction", "leaf", "features")]
    return scored.withColumn(out, vector_to_array("probability")[positive]).select(
        *keep, out, F.col("prediction").cast("int").alias("pred")
    )


def margins(model: LinearSVCModel, df: DataFrame, out: str = "margin") -> DataFrame:
    return model.transform(df).withColumn(out, vector_to_array("rawPrediction")[1]).drop("rawPrediction", "prediction")


def coefficient_table(spark, names: list[str], model) -> DataFrame:
    """(feature, coefficient): p rows of fitted state."""
    coefs = model.coefficients.toArray()
    return spark.createDataFrame([(n, float(c)) for n, c in zip(names, coefs)], "feature string, coefficient double")


def zeroed_coefficients(coefs: DataFrame, tol: float = 1e-8) -> DataFrame:
    return coefs.agg(
        F.sum((F.abs("coefficient") <= tol).cast("long")).alias("zeroed"), F.count(F.lit(1)).alias("coefficients")
    )


def gamma_scale(df: DataFrame, x: str = "x") -> float:
    """1 / (p * variance over all entries of the feature matrix)."""
    row = df.select(
        F.size(x).alias("p"),
        F.aggregate(x, F.lit(0.0), lambda a, v: a + v).alias("s"),
        F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v).alias("q"),
    ).agg(F.sum("p").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"), F.max("p").alias("p")).first()
    mean = row["s"] / row["n"]
    var = row["q"] / row["n"] - mean * mean
    return 1.0 / (row["p"] * var) if var > 0 else 1.0 / row["p"]


def _monomials(p: int) -> tuple[np.ndarray, np.ndarray]:
    """Index triples i <= j <= k and the square roots of their multinomial counts."""
    triples = np.array([(i, j, k) for i in range(p) for j in range(i, p) for k in range(j, p)])
    kinds = (triples[:, 0] != triples[:, 1]).astype(int) + (triples[:, 1] != triples[:, 2])
    return triples, np.sqrt(np.array([1.0, 3.0, 6.0])[kinds])


@dataclass(frozen=True)
class FeatureMap:
    """Explicit feature map whose dot products equal or approximate a kernel.

    rbf: random Fourier features. poly: (gamma x.y)^3 exactly, p (p + 1) (p + 2) / 6 features.
    poly_random: the same kernel approximated by D random products of projections; the
    caller chooses between the two by name. A random map is p x D numbers drawn from the seed.
    """

    kernel: str
    gamma: float = 1.0
    D: int = 2048
    seed: int = 7

    def __post_init__(self):
        if self.kernel not in KERNELS:
            raise ValueError(f"kernel {self.kernel!r} is none of {KERNELS}")

    def width(self, p: int) -> int:
        """Number of features of mapped rows of ``p`` numbers."""
        return {"linear": p, "poly": p * (p + 1) * (p + 2) // 6}.get(self.kernel, self.D)

    def rows(self, m: np.ndarray) -> np.ndarray:
        """Mapped rows of a block."""
        p, scale3 = m.shape[1], self.gamma**1.5
        if self.kernel == "linear":
            return m
        if self.kernel == "poly":
            triples, root = _monomials(p)
            return scale3 * root * m[:, triples[:, 0]] * m[:, triples[:, 1]] * m[:, triples[:, 2]]
        rng = np.random.default_rng(self.seed)
        if self.kernel == "rbf":
            w = rng.normal(0.0, np.sqrt(2.0 * self.gamma), (p, self.D))
            b = rng.uniform(0.0, 2.0 * np.pi, self.D)
            return np.sqrt(2.0 / self.D) * np.cos(m @ w + b)
        signs = rng.choice([-1.0, 1.0], (3, p, self.D))
        return scale3 / np.sqrt(self.D) * (m @ signs[0]) * (m @ signs[1]) * (m @ signs[2])


@dataclass(frozen=True)
class Landmarks:
    """Feature map through kernel values with a bounded number of rows (Nystroem): exact between landmarks.

    Dot products of mapped rows are k(x, L) K^-1 k(L, y) with K the landmarks' own kernel matrix.
    """

    kernel: str
    gamma: float
    points: np.ndarray
    root: np.ndarray

    def width(self, p: int) -> int:
        return self.root.shape[1]

    def rows(self, m: np.ndarray) -> np.ndarray:
        return kernel_values(self.kernel, self.gamma, m, self.points) @ self.root


def kernel_values(kernel: str, gamma: float, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact kernel between two blocks of rows: rbf exp(-gamma |x - y|^2), poly (gamma x.y)^3."""
    dots = a @ b.T
    if kernel == "poly":
        return (gamma * dots) ** 3
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * dots
    return np.exp(-gamma * np.maximum(square, 0.0))


def fit_landmarks(rows: DataFrame, kernel: str, gamma: float, m: int = 256, seed: int = 7, x: str = "x") -> Landmarks:
    """Landmarks: the ``m`` rows that come first in hash order, a documented bound on what the driver gets.

    Directions in which the landmarks' kernel matrix has next to no extent are left out.
    """
    found = rows.select(x, F.xxhash64(F.col(x), F.lit(seed)).alias("_h")).orderBy("_h").limit(m).collect()
    points = np.unique(np.array([r[x] for r in found], dtype=float), axis=0)
    values, vectors = np.linalg.eigh(kernel_values(kernel, gamma, points, points))
    keep = values > 1e-9 * values.max()
    return Landmarks(kernel, gamma, points, vectors[:, keep] / np.sqrt(values[keep]))


def kernel_map(
    df: DataFrame, kernel: str, p: int, gamma: float, D: int = 2048, seed: int = 7, x: str = "x", out: str = "z"
) -> DataFrame:
    """``df`` with the mapped rows of an array column of ``p`` numbers, some million numbers at a time."""
    features = FeatureMap(kernel, gamma, D, seed)
    step = max(1, MAPPED_NUMBERS // max(1, features.width(p)))
    if kernel == "linear":
        return df.withColumn(out, F.col(x))

    @F.pandas_udf("array<double>")
    def mapped(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            for lo in range(0, len(batch), step):
                yield pd.Series(list(features.rows(np.array(batch.iloc[lo : lo + step].tolist(), dtype=float).reshape(-1, p))))

    return df.withColumn(out, mapped(F.col(x)))


def out_of_fold(df: DataFrame, fit, apply, k: int, fold: str = "fold") -> DataFrame:
    """Score every row with a model that did not see its fold."""
    parts = [apply(fit(df.where(F.col(fold) != f)), df.where(F.col(fold) == f)) for f in range(k)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def fit_calibration(held: DataFrame, label: str = "y", margin: str = "margin") -> tuple[float, float]:
    """Sigmoid (slope, offset) on out-of-fold margins with the usual smoothed targets.

    A target t is fitted as one positive row of weight t and one negative row of weight 1 - t.
    """
    counts = {r[0]: r[1] for r in held.groupBy(label).count().collect()}
    up = (counts.get(1, 0) + 1.0) / (counts.get(1, 0) + 2.0)
    down = 1.0 / (counts.get(0, 0) + 2.0)
    target = F.when(F.col(label) == 1, up).otherwise(down)
    rows = held.select(margin, target.alias("_t")).select(
        margin,
        F.explode(F.array(F.struct(F.lit(1.0).alias("c"), F.col("_t").alias("w")),
                          F.struct(F.lit(0.0).alias("c"), (1.0 - F.col("_t")).alias("w")))).alias("e"),
    ).select(margin, F.col("e.c").alias("c"), F.col("e.w").alias("w"))
    vec = VectorAssembler(inputCols=[margin], outputCol="_v").transform(rows)
    model = LogisticRegression(featuresCol="_v", labelCol="c", weightCol="w", maxIter=200, tol=1e-10).fit(vec)
    return float(model.coefficients[0]), float(model.intercept)


def calibrated(slope: float, offset: float, margin: str = "margin") -> Column:
    return 1.0 / (1.0 + F.exp(-(F.lit(slope) * F.col(margin) + F.lit(offset))))


def support_census(scored: DataFrame, label: str = "y", margin: str = "margin", tol: float = 1e-3) -> DataFrame:
    """Rows on or inside the margin per class: (class, rows, support, share of all rows).

    A fitted machine puts rows on the margin at 1 give or take the solver's error, so
    ``tol`` counts as on the margin.
    """
    sign = F.when(F.col(label) == 1, 1.0).otherwise(-1.0)
    held = (sign * F.col(margin) <= 1.0 + tol).cast("long")
    per_class = scored.groupBy(F.col(label).cast("string").alias("class")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(held).alias("support")
    )
    total = per_class.agg(F.lit("(total)").alias("class"), F.sum("rows").alias("rows"), F.sum("support").alias("support"))
    both = per_class.unionByName(total)
    return both.withColumn("share", F.col("support") / F.col("rows"))
