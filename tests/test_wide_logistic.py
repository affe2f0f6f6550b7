"""Logistic regression whose coefficients stay off the driver equals that of Spark ML."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql.types import IntegerType, LongType, DoubleType, StructField, StructType

from tabwright.operators import linear, wide

SCHEMA = StructType([
    StructField("id", LongType()), StructField("y", IntegerType()), StructField("weight", DoubleType()), StructField("features", VectorUDT())
])


def _rows(n, size, seed, one_class=False):
    rng = np.random.default_rng(seed)
    truth, out = rng.normal(0, 3, size), []
    for i in range(n):
        at = np.unique(rng.integers(0, size, 9)) if i % 17 else np.array([0])
        x = rng.uniform(0.1, 1.0, len(at))
        x /= np.linalg.norm(x)
        y = 1 if one_class else int(x @ truth[at] + rng.normal() > 0.7)
        out.append((i // 2, y, 1.0 + i % 3, Vectors.sparse(size, at.tolist(), x.tolist() if i % 29 else [0.0] * len(at))))
    return [*out, (n, 1, 1.0, Vectors.sparse(size, [], []))]


@pytest.mark.parametrize("weight", [None, "weight"])
def test_wide_fit_equals_spark_ml(table, monkeypatch, weight):
    rows = table(SCHEMA, _rows(400, 700, 3), 3)
    want = linear.fit_logistic(rows, weight=weight, C=2.0, tol=1e-12)
    monkeypatch.setattr(linear, "WIDE", 100)
    monkeypatch.setattr(wide, "CELLS", 256)
    monkeypatch.setattr(wide, "PRODUCTS", 3)
    got = linear.fit_logistic(rows, weight=weight, C=2.0, tol=1e-9)
    assert got.converged and got.iterations < 20
    blocks = {r["block"]: r["w"] for r in got.blocks.collect()}
    assert len(blocks) > 8 and max(map(len, blocks.values())) < 100
    flat = np.concatenate([blocks[c] for c in sorted(blocks)])
    assert np.allclose(flat[:700], want.coefficients.toArray(), atol=1e-5) and not flat[700:].any()
    assert got.intercept == pytest.approx(want.intercept, abs=1e-5)
    test = table(SCHEMA, _rows(90, 700, 4), 4)
    a, b = (sorted((r["id"], r["y"], r["pred"], round(r["score"], 4)) for r in linear.score_model(m, test).collect()) for m in (want, got))
    assert a == b


def test_one_class_and_odd_labels(table, monkeypatch):
    monkeypatch.setattr(linear, "WIDE", 100)
    rows = table(SCHEMA, _rows(40, 700, 5, one_class=True), 2)
    model = linear.fit_logistic(rows)
    assert model.intercept == float("inf")
    assert {(r["pred"], r["score"]) for r in linear.score_model(model, rows).collect()} == {(1, 1.0)}
    for label in (2, None):
        with pytest.raises(ValueError):
            linear.fit_logistic(table(SCHEMA, [(1, label, 1.0, Vectors.sparse(700, [1], [1.0]))]))
