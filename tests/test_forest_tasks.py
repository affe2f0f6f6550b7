"""Forests of Spark ML: passes use all cores on tables of few bytes, and batches of trees are one forest."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tabwright.operators import explain, linear, trees


@pytest.fixture(scope="module")
def rows(spark):
    x = F.array(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(97)), F.pmod(F.xxhash64("id", F.lit(2)), F.lit(7)), (F.col("id") % 5).cast("long"))
    df = spark.range(900).select("id", array_to_vector(x.cast("array<double>")).alias("features"))
    first = vector_to_array("features")[0] + 9 * vector_to_array("features")[1]
    return df.withColumn("y", (first > 70).cast("int")).coalesce(1).persist()


def test_a_narrow_table_is_dealt_to_many_tasks(spark, rows, monkeypatch):
    class Asked(Exception):
        pass

    class Classifier:
        def __init__(self, **asked):
            pass

        def fit(self, df):
            raise Asked(df)

    monkeypatch.setattr(trees, "RandomForestClassifier", Classifier)
    wide = rows.crossJoin(spark.range(60).withColumnRenamed("id", "copy")).coalesce(1)
    found = []
    for _ in range(2):
        with pytest.raises(Asked) as got:
            trees.fit_forest(wide, n_trees=400)
        df = got.value.args[0]
        assert df.rdd.getNumPartitions() == 11
        found.append(df.withColumn("_t", F.spark_partition_id()).select("_t", "id", "copy").collect())
    # the same rows in the same order, so the same bags; none is lost
    assert found[0] == found[1] and len({(r["id"], r["copy"]) for r in found[0]}) == len(found[0]) == 54_000


def test_few_rows_stay_where_they_are(rows, monkeypatch):
    seen = []
    monkeypatch.setattr(trees, "_dealt", lambda df, n: seen.append(n) or df)
    trees.fit_forest(rows, n_trees=3, max_depth=2)
    assert not seen


def test_batches_are_one_forest(spark, rows, monkeypatch):
    whole = trees.fit_forest(rows, n_trees=7, max_depth=4)
    monkeypatch.setattr(trees, "KEPT_NODES", 900 * 3)
    model = trees.fit_forest(rows, n_trees=7, max_depth=4)
    assert [m.getNumTrees for m in model.members] == [2, 2, 3] and whole.getNumTrees == 7
    votes = trees.tree_votes(model, rows, ["id"]).groupBy("id").agg(F.avg("p").alias("p"), F.countDistinct("tree").alias("n")).collect()
    scored = {r["id"]: r for r in linear.score_model(model, rows).collect()}
    assert len(votes) == len(scored) == 900
    for r in votes:
        assert r["n"] == 7 and scored[r["id"]]["score"] == pytest.approx(r["p"])
        assert scored[r["id"]]["pred"] == int(scored[r["id"]]["score"] > 0.5)
    assert np.mean([s["pred"] == s["y"] for s in scored.values()]) > 0.9
    shares = np.array([t.featureImportances.toArray() for m in model.members for t in m.trees])
    assert model.featureImportances.toArray() == pytest.approx(shares.mean(axis=0))


def test_shuffled_rows_are_scored_by_many_tasks(spark):
    df = spark.range(300).select("id", (F.col("id") % 2).cast("int").alias("y"), F.pmod(F.xxhash64("id"), F.lit(11)).cast("double").alias("a"))
    tasks = []

    def score(rows):
        tasks.append(rows.rdd.getNumPartitions())
        return rows.withColumn("score", F.col("a"))

    explain.permutation_importance(df, "id", "y", ["a"], score, repeats=2).collect()
    assert tasks[1] == 2 * spark.sparkContext.defaultParallelism
