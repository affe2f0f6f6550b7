"""Machines fitted together against their optimality conditions."""

import numpy as np
import pytest

from tabwright.operators import linear, machines
from tabwright.operators.linear import FeatureMap


def problem(spark, n=160, p=4):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, p))
    y = (x @ np.arange(1, p + 1) + 2 * rng.normal(size=n) > 0).astype(int)
    fold, weight = np.arange(n) % 3, rng.uniform(0.5, 2.0, n)
    rows = [(int(i), x[i].tolist(), int(y[i]), int(fold[i]), float(weight[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, x array<double>, y int, fold int, weight double"), x, y, fold, weight


def test_every_machine_is_optimal(spark):
    df, x, y, fold, weight = problem(spark)
    spaces = [FeatureMap("linear"), FeatureMap("rbf", 0.3, 64), FeatureMap("poly", 0.2)]
    wanted = [(s, C, f) for s in range(3) for C in (0.1, 10.0) for f in (0, 2, None)]
    fits, table = machines.fit_machines(df, spaces, wanted, tol=1e-4, block=50)
    assert all(m.converged for m in fits) and table.count() == 3 * len(x)
    sign = 2 * y - 1
    for m in fits:
        z, use = spaces[m.space].rows(x), weight * (fold != m.fold if m.fold is not None else 1)
        gap = 1 - sign * (z @ m.w[:-1] + m.w[-1])
        pull = -sign * use * np.clip(gap / machines.SOFT, 0, 1)
        assert np.linalg.norm(m.w[:-1] + m.C * z.T @ pull) <= 1.1e-4 * max(1, np.linalg.norm(m.w[:-1])) and abs(m.C * pull.sum()) < 1e-2
        # no better by the hinge itself than the rounding allows
        hinge = lambda w: 0.5 * w[:-1] @ w[:-1] + m.C * (use * np.maximum(0, 1 - sign * (z @ w[:-1] + w[-1]))).sum()
        rng = np.random.default_rng(1)
        slack = m.C * use.sum() * machines.SOFT / 2
        assert all(hinge(m.w) <= hinge(m.w + rng.normal(0, 0.05, len(m.w))) + slack for _ in range(50))
    held = machines.machine_margins(fits, spaces, table, {"id": "long", "y": "int"}).collect()
    for r in held:
        m = fits[r["machine"]]
        assert m.fold is None or fold[r["id"]] == m.fold
        assert r["margin"] == pytest.approx(float(spaces[m.space].rows(x[r["id"]][None])[0] @ m.w[:-1] + m.w[-1]))
    assert len(held) == 3 * 2 * ((fold == 0).sum() + (fold == 2).sum() + len(x))


def test_grid_has_every_point_and_reports_unsettled_fits(spark):
    df, *_ = problem(spark)
    points = [("linear", "none", FeatureMap("linear")), ("rbf", "0.1", FeatureMap("rbf", 0.1, 32))]
    grid = machines.machine_grid(df, points, [0.1, 1.0], k=3).collect()
    assert {(r["kernel"], r["gamma"], r["C"]) for r in grid} == {(k, g, c) for k, g, _ in points for c in (0.1, 1.0)}
    assert all(r["converged"] and r["folds"] == 3 and 0 <= r["mean_score"] <= 1 for r in grid) and min(r["rank"] for r in grid) == 1
    assert not any(r["converged"] for r in machines.machine_grid(df, points, [1.0], k=3, max_rounds=1).collect())


def test_landmarks_keep_the_kernel(spark):
    df, x, *_ = problem(spark, 120, 3)
    for kernel in ("rbf", "poly"):
        exact = linear.kernel_values(kernel, 0.4, x, x)
        want = np.exp(-0.4 * ((x[:, None] - x[None]) ** 2).sum(axis=2)) if kernel == "rbf" else (0.4 * x @ x.T) ** 3
        assert np.allclose(exact, want)
        # with every row a landmark the map is exact; with few it is exact between these
        z = linear.fit_landmarks(df, kernel, 0.4, m=500).rows(x)
        assert np.abs(z @ z.T - exact).max() < 1e-4
        few = linear.fit_landmarks(df, kernel, 0.4, m=30)
        z = few.rows(few.points)
        assert len(few.points) == 30 and np.abs(z @ z.T - linear.kernel_values(kernel, 0.4, few.points, few.points)).max() < 1e-4
