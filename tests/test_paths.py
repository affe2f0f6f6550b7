"""Penalty paths, wide designs, rules of deep trees and streams scored by a saved model."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tabwright.operators import encode, linear, penalty, text, trees
from tabwright.session import fresh_path, materialize
from tabwright.sources.models import Decision
from tabwright.streaming import score as streaming


def problem(spark, n=300, p=6):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, p))
    x[:, p - 1] = x[:, 0]  # a repeated column
    y = (x @ np.array([2.0, -1.0, 0.5, 0.0, 0.0, 0.0])[:p] + rng.normal(size=n) > 0.3).astype(int)
    weight = rng.uniform(0.5, 2.0, n)
    rows = [(x[i].tolist(), int(y[i]), float(weight[i])) for i in range(n)]
    return spark.createDataFrame(rows, "x array<double>, y int, weight double"), x, y, weight


def objective(w, x, y, weight, C):
    at = x @ w[:-1] + w[-1]
    return np.abs(w[:-1]).sum() + C * (weight * (np.logaddexp(0, at) - y * at)).sum()


def test_every_point_of_a_path_is_optimal(spark):
    df, x, y, weight = problem(spark)
    costs = [0.001, 0.02, 0.3, 5.0, 500.0]
    points = penalty.fit_path(df, costs, weight="weight")
    assert all(m.converged and m.departure <= 1e-5 for m in points)
    rng = np.random.default_rng(1)
    for m in points:
        off = weight * (1 / (1 + np.exp(-(x @ m.w[:-1] + m.w[-1]))) - y)
        grad = np.append(x.T @ off, off.sum())
        assert penalty.departures(m.C, m.w, grad).max() <= 1.1e-5
        best = objective(m.w, x, y, weight, m.C)
        assert all(best <= objective(m.w + rng.normal(0, s, len(m.w)), x, y, weight, m.C) for s in (0.3, 0.01) for _ in range(50))
    zeros = [m.zeroed for m in points]
    assert zeros[0] == 6 and zeros == sorted(zeros, reverse=True) and zeros[-1] < 3


def test_path_agrees_with_the_iterative_fit(spark):
    df, *_ = problem(spark, p=4)
    df = df.withColumn("x", F.slice("x", 1, 3))
    point = penalty.fit_path(df, [0.1])[0]
    rows = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(
        df.select("y", *[F.col("x")[i].alias(n) for i, n in enumerate("abc")]))
    model = linear.fit_logistic(rows, C=0.1, penalty="l1")
    assert np.allclose(point.w, np.append(model.coefficients.toArray(), model.intercept), atol=1e-3)
    # scores as columns are those of the coefficients
    got = [r["s"] for r in df.select(penalty.path_score(point).alias("s")).limit(5).collect()]
    x = np.array([r["x"] for r in df.limit(5).collect()])
    assert np.allclose(got, 1 / (1 + np.exp(-(x @ point.w[:-1] + point.w[-1]))))


def test_critical_cost_and_bad_input(spark):
    df, x, y, _ = problem(spark)
    critical = penalty.critical_cost(df).first()["critical"]
    assert critical == pytest.approx(1 / np.abs(x.T @ (y - y.mean())).max())
    below, above = penalty.fit_path(df, [critical * 0.999, critical * 1.05])
    assert below.zeroed == 6 and above.zeroed < 6
    with pytest.raises(ValueError, match="both classes"):
        penalty.fit_path(df.where("y = 1"), [1.0])
    with pytest.raises(ValueError, match="both classes"):
        penalty.fit_path(df.where("y = 7"), [1.0])
    holed = df.unionByName(spark.createDataFrame([(None, 1, 1.0), ([0.0] * 6, None, 1.0)], df.schema))
    assert np.allclose(penalty.fit_path(holed, [0.1])[0].w, penalty.fit_path(df, [0.1])[0].w)
    assert not penalty.fit_path(df, [5.0], max_rounds=1)[0].converged


def test_wide_design_holds_100_000_levels(spark):
    rows = spark.range(100_000).select(
        "id", F.concat(F.lit("k"), "id").alias("many"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("few"),
        (F.col("id") % 10).cast("double").alias("v"), (F.col("id") % 3 == 1).cast("int").alias("y"))
    rows = materialize(rows, "rows")
    design = encode.fit_wide_design(rows, ["v"], ["many", "few"])
    assert design.size == 1 + 100_000 + 2 and design.name_table().count() == design.size
    packed = design.packed(rows, "id")
    assert len(packed._jdf.queryExecution().optimizedPlan().toString()) < 20_000
    stats = packed.select(F.size("features.indices").alias("n"), F.col("features.values")[0].alias("v"), (F.col("id") % 3 > 0).alias("two"))
    assert stats.groupBy("two", "n").count().orderBy("n").collect() == [(False, 2, 33_334), (True, 3, 66_666)]
    assert stats.agg(F.avg("v")).first()[0] == pytest.approx(0.0, abs=1e-9)
    places = design.name_table().agg(F.min("idx"), F.max("idx"), F.count_distinct("idx")).first()
    assert tuple(places) == (0, design.size - 1, design.size)
    table = design.assemble(rows.where("id < 300"), "id")
    assert table.count() == 300 and linear.fit_logistic(table, max_iter=3).numFeatures == design.size


def test_wide_design_matches_the_narrow_one(table, monkeypatch):
    df = table("id long, c string, n int, v double", [(1, "a", 10, 1.0), (2, "b", 2, None), (3, None, 2, 5.0), (4, "a", None, 3.0), (5, "a", 1, 3.0)])
    for limit in (64 << 20, 0):  # dictionary broadcast; frequent levels only
        monkeypatch.setattr(text, "BROADCAST_BYTES", limit)
        design = encode.fit_wide_design(df, ["v"], ["c", "n"], impute=True, drop="first")
        names = {r["idx"]: r["feature"] for r in design.name_table().collect()}
        assert set(names.values()) == {"num__v", "cat__c_b", "cat__n_2", "cat__n_10"}
        unseen = df.unionByName(df.limit(1).select(F.lit(9).cast("long").alias("id"), F.lit("zz").alias("c"), "n", "v"))
        got = {r["id"]: {names[i]: v for i, v in zip(r["f"]["indices"], r["f"]["values"])} for r in design.packed(unseen, "id", "f").collect()}
        assert {k: set(v) - {"num__v"} for k, v in got.items()} == {1: {"cat__n_10"}, 2: {"cat__c_b", "cat__n_2"}, 3: {"cat__n_2"}, 4: set(), 5: set(), 9: {"cat__n_10"}}
        assert got[2]["num__v"] == pytest.approx(0.0) and got[1]["num__v"] == -got[3]["num__v"]


def test_rules_of_a_deep_tree_keep_the_plan_small(spark):
    rng = np.random.default_rng(2)
    rows = [(i, float(a), float(b), int(rng.random() < 0.5)) for i, (a, b) in enumerate(rng.normal(size=(600, 2)))]
    df = spark.createDataFrame(rows, "id long, a double, b double, y int")
    design = encode.fit_design(df, ["a", "b"], ignore=["id", "y"], scale=False)
    sizes = {}
    for depth in (2, 15):
        model = trees.fit_tree(design.assemble(df), max_depth=depth)
        paths = trees.tree_paths(model, design, spark)
        placed = trees.leaf_numbers(model, design.assemble(df))
        sizes[depth] = len(placed.groupBy("leaf").count()._jdf.queryExecution().optimizedPlan().toString())
        by_sql = trees.tree_rules(df, paths) if depth == 2 else None
        rules = trees.tree_rules(placed, paths, leaf="leaf")
        if by_sql:
            assert sorted(rules.collect()) == sorted(by_sql.collect())
        else:
            assert len(paths) > 60 and rules.agg(F.sum("support")).first()[0] == 600
            # the rules' own conditions agree, leaf by leaf
            want = {r["id"]: r["leaf"] for r in placed.select("id", "leaf").collect()}
            for leaf, _, test, _ in paths[::25]:
                assert {r["id"] for r in df.where(test).select("id").collect()} == {k for k, v in want.items() if v == leaf}
    assert sizes[15] <= sizes[2] + 100


class Stopped(Exception):
    pass


def test_a_stopped_stream_goes_on_and_counts_no_batch_twice(spark):
    df = spark.createDataFrame([(i, float(i % 7), int(i % 7 > 3 or i % 5 == 0)) for i in range(200)], "id long, a double, y int")
    stages = [VectorAssembler(inputCols=["a"], outputCol="features"), LogisticRegression(labelCol="y")]
    bundle, folder, sink, state = (fresh_path(spark, n) for n in ("bundle", "in", "out", "state"))
    streaming.save_bundle(spark, Pipeline(stages=stages).fit(df), Decision(0.5, "yes", "no"), bundle)
    df.repartition(4).write.parquet(folder)
    stream = streaming.read_stream(spark, folder, df.schema, max_files=1)
    seen = []

    def stop_at(number):
        seen.append(number)
        if number == 1 and seen.count(1) == 1:
            raise Stopped  # written, not yet noted

    with pytest.raises(Exception, match="Stopped"):
        streaming.score_saved_stream(stream, bundle, sink, state, stop_at)
    assert seen == [0, 1]
    streaming.score_saved_stream(streaming.read_stream(spark, folder, df.schema, max_files=1), bundle, sink, state, stop_at)
    assert seen == [0, 1, 1, 2, 3]
    got = spark.read.parquet(sink)
    want = streaming.score_bundle(df, bundle)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert {r["verdict"] for r in got.collect()} == {"yes", "no"}
