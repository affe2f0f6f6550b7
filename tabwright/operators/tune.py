"""Grid searches, their summaries, and model comparisons."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.operators import text
from tabwright.operators.curves import curve_table, roc_auc
from tabwright.operators.decide import apply_threshold
from tabwright.operators.metrics import binary_scores, classification_report
from tabwright.session import materialize, release


def compare_models(scored: DataFrame, by: str, positive=1) -> DataFrame:
    """One row per model from a long (model, id, y, score, pred) table, best AUC first."""
    classes = binary_scores(scored, "y", "pred", positive, [by], ["accuracy", "precision", "recall", "f1"])
    flags = scored.withColumn("_pos", (F.col("y") == F.lit(positive)).cast("int"))
    area = roc_auc(curve_table(flags, "_pos", "score", [by]), [by])
    return classes.join(area, by).orderBy(F.desc("roc_auc"), by)


def cv_results(fold_scores: DataFrame, params: Sequence[str], score: str = "score") -> DataFrame:
    """Mean and population std over folds, ranked; ties go to the first point in grid order.

    One row per grid point, so the unpartitioned rank sees the grid only.
    """
    per_point = fold_scores.groupBy(*params).agg(
        F.avg(score).alias("mean_score"), F.stddev_pop(score).alias("std_score"), F.count(score).alias("folds")
    )
    # rounding keeps points that differ only by summation order tied
    order = Window.partitionBy().orderBy(F.round("mean_score", 9).desc())
    return per_point.withColumn("rank", F.rank().over(order).cast("long"))


def best_point(results: DataFrame, params: Sequence[str], grid_order: Sequence | None = None) -> dict:
    """Parameters of rank 1; ties are broken by the given column order."""
    row = results.orderBy("rank", *(grid_order or params)).first()
    return {p: row[p] for p in params}


def score_curve(results: DataFrame, x: str, fixed: Mapping[str, object]) -> DataFrame:
    """Slice of a search at fixed other parameters, ordered by ``x``."""
    out = results
    for name, value in fixed.items():
        out = out.where(F.col(name) == F.lit(value))
    return out.select(x, "mean_score", "std_score").orderBy(x)


def pivot_scores(results: DataFrame, row: str, col: str, values: Sequence) -> DataFrame:
    """Mean score by two parameters (heat-map data); the column values are given, not searched."""
    return results.groupBy(row).pivot(col, list(values)).agg(F.avg("mean_score"))


def nb_grid(
    docs: DataFrame, id_col: str, text_col: str, label: str, fold: str,
    his: Sequence[int] = (1, 2), alphas: Sequence[float] = (0.01, 0.1, 0.5, 1.0), k: int = 5,
    min_df: int = 2, max_df: float = 0.9, scorer: str = "f1_weighted",
) -> DataFrame:
    """Cross-validated tf-idf + multinomial NB for every (n-gram range, alpha) at once.

    Folds and grid points are columns: training statistics of fold f are totals minus the
    counts of fold f, so the texts are read and tokenised once for all points. Labels are 0/1.
    """
    fs = range(k)
    # documents per (fold, class): k x 2 numbers of fitted state
    cells = {(r[0], r[1]): r[2] for r in docs.groupBy(fold, label).count().collect()}
    n_class = [[sum(c for (f2, y), c in cells.items() if f2 != f and y == v) for v in (0, 1)] for f in fs]
    n_train = [sum(n_class[f]) for f in fs]

    # documents move once, by id; their terms are counted where they are
    words = docs.select(id_col, label, fold, text_col).repartition(id_col)
    words = words.select(id_col, label, fold, text.tokens(F.col(text_col)).alias("_w"))

    def sized(n: int) -> Column:
        return F.transform(text.ngrams("_w", n, n), lambda t: F.struct(F.lit(n).alias("n"), t.alias("term")))

    by_size = [sized(n) for n in range(1, max(his) + 1)]
    terms = words.select(id_col, label, fold, F.explode(F.concat(*by_size)).alias("t")).select(
        id_col, label, fold, F.col("t.n").alias("n"), F.col("t.term").alias("term")
    )
    counts = materialize(terms.groupBy(id_col, label, fold, "n", "term").agg(F.count(F.lit(1)).alias("tf")), "grid-counts")

    # idf per fold, one row per term: document frequency outside fold f
    in_fold = [F.sum(F.when(F.col(fold) == f, 1).otherwise(0)).alias(f"_d{f}") for f in fs]
    freq = counts.groupBy("term").agg(F.count(F.lit(1)).alias("_df"), *in_fold)
    idf = []
    for f in fs:
        d = F.col("_df") - F.col(f"_d{f}")
        keep = (d >= min_df) & (d <= F.lit(max_df * n_train[f]))
        idf.append(F.when(keep, F.log((1.0 + n_train[f]) / (1.0 + d)) + 1.0).alias(f"_i{f}"))
    vocab = freq.select("term", "_df", *idf).where(" OR ".join(f"_i{f} IS NOT NULL" for f in fs))
    # from here on a term is a number, frozen by writing it
    vocab = materialize(vocab.withColumn("_t", F.monotonically_increasing_id()), "grid-idf")
    release(docs.sparkSession)

    # values of every document under every fold's idf, for each n-gram range it belongs to
    # narrow rows move by document and are written with its lengths, which take next to no room, before ranges and
    # folds multiply them
    own = [id_col, label, fold, "n", "_t", "tf"]
    idfs = [f"_i{f}" for f in fs]
    pairs = materialize(text.join_terms(counts, vocab, often="_df").select(*own, *idfs), "grid-pairs")
    release(docs.sparkSession, counts, vocab)
    raw = pairs.repartition(id_col)
    tf = 1.0 + F.log(F.col("tf").cast("double"))
    x = [tf * F.col(i) for i in idfs]
    per_doc = Window.partitionBy(id_col)
    lengths = [F.sqrt(F.sum(F.when(F.col("n") <= h, x[f] * x[f])).over(per_doc)).alias(f"_q{h}_{f}") for h in his for f in fs]
    raw = materialize(raw.select(*own, *idfs, *lengths), "grid-values")
    release(docs.sparkSession, pairs)
    ranged = raw.withColumn("hi", F.explode(F.filter(F.array(*[F.lit(h) for h in his]), lambda h: h >= F.col("n"))))
    values = ranged.select(
        "hi", id_col, label, fold, "_t",
        *[(x[f] / F.coalesce(*[F.when(F.col("hi") == h, F.col(f"_q{h}_{f}")) for h in his])).alias(f"_v{f}") for f in fs],
    )

    sums = []
    for f in fs:
        for c in (0, 1):
            part = (F.col(fold) != f) & (F.col(label) == c)
            sums.append(F.sum(F.when(part, F.coalesce(f"_v{f}", F.lit(0.0))).otherwise(0.0)).alias(f"_s{f}_{c}"))
        sums.append(F.count(F.when(F.col(fold) != f, F.col(f"_v{f}"))).alias(f"_n{f}"))
    fit = materialize(values.groupBy("hi", "_t").agg(*sums), "grid-sums")
    release(docs.sparkSession)
    totals = {
        r["hi"]: r
        for r in fit.groupBy("hi").agg(
            *[F.sum(f"_s{f}_{c}").alias(f"t{f}_{c}") for f in fs for c in (0, 1)],
            *[F.sum(F.when(F.col(f"_n{f}") > 0, 1).otherwise(0)).alias(f"v{f}") for f in fs],
        ).collect()
    }

    def of_fold(names: Sequence[str]) -> Column:
        return F.element_at(F.array(*[F.col(n) for n in names]), F.col(fold) + 1)

    held = values.select("hi", id_col, fold, "_t", of_fold([f"_v{f}" for f in fs]).alias("value")).where("value IS NOT NULL")
    held = text.join_terms(held, fit, ("hi", "_t")).select(
        "hi", id_col, fold, "value", of_fold([f"_s{f}_0" for f in fs]).alias("s0"), of_fold([f"_s{f}_1" for f in fs]).alias("s1")
    )
    margins = held.groupBy("hi", id_col).agg(
        F.sum("value").alias("_sv"),
        *[
            F.sum(F.col("value") * (F.log(F.col("s1") + a) - F.log(F.col("s0") + a))).alias(f"_m{i}")
            for i, a in enumerate(map(float, alphas))
        ],
    )

    def constant(hi: int, f: int, a: float) -> tuple[float, float]:
        """Smoothing denominators and prior of one grid point, as log differences."""
        t = totals.get(hi)
        n0, n1 = n_class[f]
        # a training set of one class predicts that class
        prior = math.log(n1 / n0) if n0 and n1 else math.inf * (1 if n1 else -1)
        if t is None or not t[f"v{f}"]:
            return 0.0, prior
        return math.log(t[f"t{f}_1"] + a * t[f"v{f}"]) - math.log(t[f"t{f}_0"] + a * t[f"v{f}"]), prior

    points = [
        F.struct(
            F.lit(h).alias("hi"), F.lit(float(a)).alias("alpha"), F.lit(i).alias("_a"),
            F.element_at(F.array(*[F.lit(constant(h, f, a)[0]) for f in fs]), F.col(fold) + 1).alias("_c"),
            F.element_at(F.array(*[F.lit(constant(h, f, a)[1]) for f in fs]), F.col(fold) + 1).alias("_p"),
        )
        for h in his for i, a in enumerate(alphas)
    ]
    all_points = docs.select(id_col, label, fold, F.explode(F.array(*points)).alias("g")).select(id_col, label, fold, "g.*")
    packed = margins.select("hi", id_col, "_sv", F.array(*[f"_m{i}" for i in range(len(alphas))]).alias("_m"))
    margin = F.coalesce(F.element_at("_m", F.col("_a") + 1) - F.col("_sv") * F.col("_c"), F.lit(0.0)) + F.col("_p")
    predicted = all_points.join(packed, ["hi", id_col], "left").select(
        "hi", "alpha", fold, F.col(label).alias("y"), (margin > 0).cast("int").alias("pred")
    )
    scores = binary_scores(predicted, "y", "pred", 1, ["hi", "alpha", fold], [scorer]).withColumnRenamed(scorer, "score")
    return cv_results(scores, ["hi", "alpha"])


def grid_search(
    rows: DataFrame, fit: Callable, predict: Callable, grid: Sequence[Mapping], scorer: str = "f1", positive=1,
    label: str = "y", fold: str = "fold", k: int = 5, parallelism: int = 4, settled: Callable | None = None,
) -> DataFrame:
    """Cross-validated search for iterative models: (params..., mean_score, std_score, folds, rank).

    With ``settled(model)`` a column ``converged`` tells whether every fit of a point settled.

    ``fit(train, params)`` gives a model, ``predict(model, rows)`` adds ``pred``. The encoded
    rows are kept once for all points; points run from a few driver threads so that small
    fits overlap, and each fit is itself a distributed job.
    """
    kept = rows.persist(StorageLevel.MEMORY_AND_DISK)

    def run(task: tuple[int, int]) -> tuple:
        point, f = task
        model = fit(kept.where(F.col(fold) != f), grid[point])
        held = predict(model, kept.where(F.col(fold) == f))
        value = float(binary_scores(held, label, "pred", positive, (), [scorer]).first()[0])
        return point, f, value, settled(model) if settled else True

    try:
        with ThreadPool(parallelism) as pool:
            done = pool.map(run, [(p, f) for p in range(len(grid)) for f in range(k)])
    finally:
        kept.unpersist()
    names = list(grid[0])
    scores = rows.sparkSession.createDataFrame([d[:3] for d in done], "point int, fold int, score double")
    table = cv_results(scores, ["point"])
    values = F.array(*[F.struct(*[F.lit(g[n]).alias(n) for n in names]) for g in grid])
    out = table.select(F.element_at(values, F.col("point") + 1).alias("_p"), "*").select(
        "point", "_p.*", "mean_score", "std_score", "folds", "rank"
    )
    if settled is None:
        return out
    fine = F.array(*[F.lit(all(d[3] for d in done if d[0] == p)) for p in range(len(grid))])
    return out.withColumn("converged", F.element_at(fine, F.col("point") + 1))


def report_at_threshold(scored: DataFrame, choose: Callable[[DataFrame], DataFrame], y: str = "y", score: str = "score", split: str = "split") -> DataFrame:
    """Classification report of the test rows at a threshold that ``choose`` picks on the validation rows.

    The last step of search, refit, threshold, one evaluation: the test rows are read once,
    after every choice is made. ``scored`` is a written table with rows of both splits.
    """
    cut = choose(scored.where(F.col(split) == "val")).first()["threshold"]
    test = apply_threshold(scored.where(F.col(split) == "test"), score, cut)
    return classification_report(test, y, "pred").withColumn("threshold", F.lit(float(cut)))


def ablation(scored: Mapping[str, DataFrame], label: str = "y") -> DataFrame:
    """AUC per variant and its gap to the best: a large gap flags a leaky column."""
    parts = [df.select(F.lit(name).alias("variant"), F.col(label).alias("y"), "score") for name, df in scored.items()]
    long = parts[0]
    for part in parts[1:]:
        long = long.unionByName(part)
    area = roc_auc(curve_table(long, "y", "score", ["variant"]), ["variant"])
    return area.withColumn("gap", F.max("roc_auc").over(Window.partitionBy()) - F.col("roc_auc"))
