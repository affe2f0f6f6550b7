"""Searches and reports of margin machines fitted together, and one machine that SQL can state."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabwright.functions.keys import tidy
from tabwright.operators import decide, encode, linear, machines, neighbors, split, tune
from tabwright.operators.linear import FeatureMap
from tabwright.plans.closed import urgent_flag
from tabwright.plans.encoders import fixed_design, split_campaign
from tabwright.plans.frames import CAMPAIGN_SQL, VECTORS_SQL, sql_tidy, vectors
from tabwright.plans.registry import query
from tabwright.session import materialize

# fixed values: costs, widths of the kernels and the recall the threshold must reach
COSTS = [0.1, 1.0, 10.0, 100.0]
GAMMAS = ["scale", "0.001", "0.01", "0.1"]
RECALL = 0.9


def _points(rows):
    """(kernel, name of gamma, map) of the search; the linear kernel has no gamma."""
    scale = linear.gamma_scale(rows)
    out = [("linear", "none", FeatureMap("linear"))]
    for kernel in ("rbf", "poly"):
        out += [(kernel, name, linear.fit_landmarks(rows, kernel, scale if name == "scale" else float(name))) for name in GAMMAS]
    return out


def _split_vectors(spark, sf):
    """Train, validation and test rows, scaled by the training rows, with balanced weights of all rows."""
    rows = split.stratified_split3(vectors(spark, sf), "id", "y")
    scaled = neighbors.scale_arrays(rows.where("split = 'train'"), rows)
    factors = encode.class_weights(scaled.where("split = 'train'"), "y").groupBy("y").agg(F.max("weight").alias("weight"))
    return materialize(scaled.join(factors, "y"), "vectors")


def _folded(rows):
    train = rows.where("split = 'train'").drop("split")
    return materialize(split.stratified_folds(train, "id", "y", 5, "folds").select("id", "x", "y", "fold", "weight"), "folded")


@query("svm_grid")
def svm_grid(spark, sf):
    rows = split_campaign(spark, sf)
    train = fixed_design(rows).assemble(rows).where("split = 'train'").select("id", "y", vector_to_array("features").alias("x"))
    folded = split.stratified_folds(encode.class_weights(train, "y"), "id", "y", 5, "folds")
    found = machines.machine_grid(materialize(folded.select("id", "x", "y", "fold", "weight"), "folded"), [("linear", "none", FeatureMap("linear"))], COSTS)
    return found.drop("kernel", "gamma")


@query("svm_kernel_grid")
def svm_kernel_grid(spark, sf):
    folded = _folded(_split_vectors(spark, sf))
    return machines.machine_grid(folded, _points(folded), COSTS)


@query("svm_tuned_report")
def svm_tuned_report(spark, sf):
    """Search on the training rows, calibrated refit, threshold on validation, refit on both, one evaluation on test."""
    rows = _split_vectors(spark, sf)
    folded = _folded(rows)
    points = _points(folded)
    best = tune.best_point(machines.machine_grid(folded, points, COSTS), ["kernel", "gamma", "C"])
    space = next(m for kernel, name, m in points if (kernel, name) == (best["kernel"], best["gamma"]))
    # out-of-fold margins of the best point shape the sigmoid
    fits, table = machines.fit_machines(folded, [space], [(0, best["C"], f) for f in range(5)])
    held = materialize(machines.machine_margins(fits, [space], table, {"y": "int"}), "held")
    slope, offset = linear.fit_calibration(held)
    # one machine on the training rows, one on training and validation rows; test rows weigh nothing
    place = F.when(F.col("split") == "train", 0).when(F.col("split") == "val", 1).otherwise(2)
    weight = F.when(F.col("split") == "test", 0.0).otherwise(F.col("weight"))
    whole = rows.select("id", "x", "y", "split", place.alias("fold"), weight.alias("weight"))
    fits, table = machines.fit_machines(whole, [space], [(0, best["C"], 1), (0, best["C"], None)])
    margins = machines.machine_margins(fits, [space], table, {"id": "long", "y": "int", "split": "string"}, held_only=False)
    chosen = (F.col("machine") == 0) & (F.col("split") == "val") | (F.col("machine") == 1) & (F.col("split") == "test")
    scored = margins.where(chosen).select("id", "y", "split", linear.calibrated(slope, offset).alias("score"))
    report = tune.report_at_threshold(materialize(scored, "scored"), lambda d: decide.threshold_for_recall(d, "y", "score", RECALL))
    return report.withColumns({c: F.lit(best[c]) for c in ("kernel", "gamma", "C")})


# ---- how well feature maps keep the kernel -------------------------------------------------

def _pairs(spark, sf):
    """Rows and their neighbours in id order."""
    rows = vectors(spark, sf).select("id", "x")
    return materialize(rows.join(rows.select((F.col("id") - 1).alias("id"), F.col("x").alias("z")), "id"), "pairs")


def _on_pairs(pairs, values, schema):
    """``values(x, z)`` per block of pairs, as columns behind the id."""

    def each(parts):
        for part in parts:
            for lo in range(0, len(part), 512):
                own = part.iloc[lo : lo + 512]
                x, z = (np.array(own[c].tolist(), float).reshape(len(own), -1) for c in ("x", "z"))
                yield pd.DataFrame({"id": own["id"], **values(x, z)})

    return pairs.mapInPandas(each, f"id long, {schema}")


def _exact(kernel, gamma, x, z):
    return np.concatenate([linear.kernel_values(kernel, gamma, a[None], b[None])[0] for a, b in zip(x, z, strict=True)])


@query("kernel_exact_pairs", f"""
WITH v AS ({VECTORS_SQL}), p AS (SELECT a.id AS id, a.x AS x, b.x AS z FROM v a JOIN v b ON b.id = a.id + 1)
SELECT id, {sql_tidy("exp(-0.5e0 * (list_dot_product(x, x) + list_dot_product(z, z) - 2e0 * list_dot_product(x, z)))")} AS rbf,
       {sql_tidy("pow(0.5e0 * list_dot_product(x, z), 3)")} AS poly FROM p""")
def kernel_exact_pairs(spark, sf):
    """The kernels themselves, which the maps are held against."""
    found = _on_pairs(_pairs(spark, sf), lambda x, z: {k: _exact(k, 0.5, x, z) for k in ("rbf", "poly")}, "rbf double, poly double")
    return found.select("id", tidy(F.col("rbf")).alias("rbf"), tidy(F.col("poly")).alias("poly"))


@query("kernel_map_error")
def kernel_map_error(spark, sf):
    """(kernel, map, pairs, mean_error, max_error): mapped dot products against the exact kernel."""
    pairs, parts = _pairs(spark, sf), []
    for kernel in ("rbf", "poly"):
        spaces = {"landmarks": linear.fit_landmarks(pairs, kernel, 0.5), "random": FeatureMap("rbf" if kernel == "rbf" else "poly_random", 0.5)}
        for name, space in spaces.items():
            gaps = _on_pairs(pairs, lambda x, z, k=kernel, m=space: {"gap": np.abs((m.rows(x) * m.rows(z)).sum(axis=1) - _exact(k, 0.5, x, z))}, "gap double")
            parts.append(gaps.agg(F.lit(kernel).alias("kernel"), F.lit(name).alias("map"), F.count(F.lit(1)).alias("pairs"), F.avg("gap").alias("mean_error"), F.max("gap").alias("max_error")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


# ---- one indicator: the optimum of each of its two levels is a ratio of weights ------------

_HINGE_SQL = f"""
WITH t AS (SELECT id, y, priority = '1-URGENT' AS u FROM ({CAMPAIGN_SQL})),
a AS (SELECT count(*) AS n, sum(y) AS pos FROM t),
g AS (SELECT u, sum(y) * (max(n) / (2e0 * max(pos))) AS p, sum(1 - y) * (max(n) / (2e0 * max(n - pos))) AS q FROM t, a GROUP BY 1),
m AS (SELECT u, CASE WHEN p > q THEN 1e0 - {machines.SOFT}e0 * q / p ELSE -1e0 + {machines.SOFT}e0 * p / q END AS margin FROM g)"""


@query("hinge_closed", f"""{_HINGE_SQL}
SELECT id, y, {sql_tidy('margin', 4)} AS margin FROM t JOIN m USING (u)""")
def hinge_closed(spark, sf):
    """Balanced weights, one indicator, large C: each level's margin rests where its classes pull alike."""
    rows = encode.class_weights(urgent_flag(spark, sf), "y").select("id", F.array("urgent").alias("x"), "y", F.lit(0).alias("fold"), "weight")
    space = FeatureMap("linear")
    fits, table = machines.fit_machines(materialize(rows, "rows"), [space], [(0, 1e4, None)], tol=1e-6)
    margins = machines.machine_margins(fits, [space], table, {"id": "long", "y": "int"}, held_only=False)
    return margins.select("id", "y", tidy(F.col("margin"), 4).alias("margin"))
