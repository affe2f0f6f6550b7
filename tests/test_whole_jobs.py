"""Steps that do the whole job: independent shuffles, rules tested on all labels, blocks of bounded size."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.llm import quality
from tabwright.operators import explain, linear, text


def test_shuffles_are_independent_of_each_other(spark):
    n = 60
    df = spark.range(n).select("id", F.col("id").alias("a"))
    rows = explain.shuffled_columns(df, "id", ["a"], 2).collect()
    donor = [{r["id"]: r["a"] for r in rows if r["repeat"] == k} for k in range(2)]
    assert all(sorted(d.values()) == list(range(n)) for d in donor)
    # if one shuffle were the other one moved by some places, all cycles between them would be equally long
    step = {donor[0][i]: donor[1][i] for i in range(n)}
    lengths = set()
    while step:
        at, size = next(iter(step)), 0
        while at in step:
            at, size = step.pop(at), size + 1
        lengths.add(size)
    assert len(lengths) > 1


def test_all_labelled_documents_test_the_rules(spark):
    n = 30_000
    counts = dict.fromkeys([*quality.COUNTS, *quality.EXTRA], 0)
    good = counts | {"n_words": 100, "word_chars": 500, "n_lines": 10, "n_distinct": 60, "n_top": 5, "n_letters": 480, "n_upper": 20, "n_chars": 500}
    cells = F.struct(*[F.lit(v).cast("long").alias(c) for c, v in good.items()])
    rows = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), cells.alias("features"))
    rules = quality.fit_rules(rows, spark.range(n).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality")))
    assert [c["holdout"] for c in rules.certificates] == [n] * len(quality.MULTIPLES)


@pytest.mark.parametrize(("k", "n"), [(5000, 600_000), (30_000, 4_000_000)])
def test_bounds_of_many_rejections(k, n):
    bound = quality.upper_bound(k, n, 0.01)
    spread = 2.326 * np.sqrt(k) / n
    assert k / n + 0.95 * spread < bound < k / n + 1.1 * spread


def test_maps_hold_a_bounded_number_of_rows(spark, monkeypatch):
    seen = []

    class Rows(linear.FeatureMap):
        def rows(self, m):
            assert len(m) * self.width(m.shape[1]) <= linear.MAPPED_NUMBERS
            return super().rows(m)

    monkeypatch.setattr(linear, "FeatureMap", Rows)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(900, 24))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, x array<double>").coalesce(1)
    for r in linear.kernel_map(df, "poly", 24, 0.5).where("id % 300 = 7").select("id", F.size("z").alias("n"), "z").collect():
        seen.append(r["id"])
        assert r["n"] == 24 * 25 * 26 // 6
        assert np.dot(r["z"], r["z"]) == pytest.approx((0.5 * x[r["id"]] @ x[r["id"]]) ** 3)
    assert sorted(seen) == [7, 307, 607]


def test_terms_are_counted_where_their_document_is(spark):
    df = spark.createDataFrame([(1, "aa bb aa"), (1, "aa cc"), (None, "aa"), (None, "aa bb"), (2, None)], "id long, text string")
    counts = text.term_counts(df, "id", "text", 1, 2)
    assert counts._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    got = {(r["id"], r["term"]): r["tf"] for r in counts.collect()}
    assert got[1, "aa"] == 3 and got[1, "aa bb"] == 1 and got[None, "aa"] == 2 and (1, "aa aa") not in got and not any(k[0] == 2 for k in got)
