import random

import pytest
from pyspark.sql import functions as F

from tabwright.operators import curves, decide, metrics
from tabwright.operators.tune import compare_models


def _from_matrix(table, m, labels):
    rows, i = [], 0
    for a, line in zip(labels, m):
        for p, n in zip(labels, line):
            for _ in range(n):
                rows.append((i, a, p))
                i += 1
    kind = "int" if isinstance(labels[0], int) else "string"
    return table(f"id long, y {kind}, pred {kind}", rows)


def test_report_from_published_matrix(table):
    df = _from_matrix(table, [[84, 16], [25, 29]], [0, 1])
    rep = {r["class"]: r for r in metrics.classification_report(df, "y", "pred").collect()}
    assert rep["accuracy"]["f1"] == pytest.approx(0.7338, abs=5e-5)
    assert rep["1"]["precision"] == pytest.approx(0.6444, abs=5e-5)
    assert rep["1"]["recall"] == pytest.approx(0.5370, abs=5e-5)
    assert rep["1"]["f1"] == pytest.approx(0.5859, abs=5e-5)
    assert rep["macro avg"]["recall"] == pytest.approx((0.84 + 29 / 54) / 2)
    assert rep["weighted avg"]["support"] == 154


def test_scores_from_second_published_matrix(table):
    df = _from_matrix(table, [[181, 66], [19, 28]], ["No", "Yes"])
    s = metrics.binary_scores(df, "y", "pred", "Yes").first()
    assert s["accuracy"] == pytest.approx(0.7109, abs=5e-5)
    assert s["f1"] == pytest.approx(0.3972, abs=5e-5)
    assert s["f1_weighted"] == pytest.approx(0.7439, abs=5e-5)


def test_positive_class_may_be_zero_and_denominators_may_be_zero(table):
    df = table("y int, pred int", [(0, 1), (1, 1), (1, 1)])
    s = metrics.binary_scores(df, "y", "pred", 0).first()
    assert (s["precision"], s["recall"], s["f1"], s["f2"]) == (0.0, 0.0, 0.0, 0.0)
    cm = {(r["y"], r["pred"]): r["n"] for r in metrics.confusion_matrix(df, "y", "pred", [0, 1]).collect()}
    assert cm == {(0, 0): 0, (0, 1): 1, (1, 0): 0, (1, 1): 2}


def _scored(n=300, seed=1, digits=2):
    rng = random.Random(seed)
    return [(i, y := rng.randint(0, 1), round(min(0.99, 0.3 * y + 0.7 * rng.random()), digits)) for i in range(n)]


def _pair_auc(rows):
    pos, neg = [s for _, y, s in rows if y], [s for _, y, s in rows if not y]
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


def test_auc_equals_pair_count_and_flips(table):
    rows = _scored()
    df = table("id long, y int, s double", rows, 5)
    auc = curves.roc_auc(curves.curve_table(df, "y", "s")).first()[0]
    assert auc == pytest.approx(_pair_auc(rows))
    flipped = curves.roc_auc(curves.curve_table(df.withColumn("s", -F.col("s")), "y", "s")).first()[0]
    assert auc + flipped == pytest.approx(1.0)


def test_average_precision_steps(table):
    rows = _scored(seed=2, digits=1)
    want, tp, seen = 0.0, 0, 0
    positives = sum(y for _, y, _ in rows)
    for s in sorted({s for _, _, s in rows}, reverse=True):
        here = [y for _, y, v in rows if v == s]
        tp, seen = tp + sum(here), seen + len(here)
        want += sum(here) / positives * tp / seen
    df = table("id long, y int, s double", rows)
    assert curves.average_precision(curves.curve_table(df, "y", "s")).first()[0] == pytest.approx(want)
    perfect = table("y int, s double", [(1, 0.9), (1, 0.8), (0, 0.2)])
    assert curves.average_precision(curves.curve_table(perfect, "y", "s")).first()[0] == 1.0


def test_auc_survives_row_counts_beyond_int_products(table):
    # counts as they would be at five billion rows per class
    curve = table(
        "score double, n long, pos long, seen long, tp long, rows long, positives long",
        [(0.9, 5 * 10**9, 4 * 10**9, 5 * 10**9, 4 * 10**9, 10**10, 5 * 10**9),
         (0.1, 5 * 10**9, 10**9, 10**10, 5 * 10**9, 10**10, 5 * 10**9)],
    )
    assert curves.roc_auc(curve).first()[0] == pytest.approx(0.8)


def test_thresholds_are_tight(table):
    rows = _scored(seed=3)
    df = table("id long, y int, s double", rows)
    pos = sum(y for _, y, _ in rows)

    def recall(t):
        return sum(y for _, y, s in rows if s >= t) / pos

    t = decide.threshold_for_recall(df, "y", "s", 0.9).first()
    larger = min(s for _, _, s in rows if s > t["threshold"])
    assert recall(t["threshold"]) >= 0.9 > recall(larger) and t["recall"] == pytest.approx(recall(t["threshold"]))
    p = decide.threshold_for_precision(df, "y", "s", 0.95).first()
    ok = [s for s in {s for _, _, s in rows}
          if (hit := [y for _, y, v in rows if v >= s]) and sum(hit) / len(hit) >= 0.95]
    assert p["threshold"] == min(ok) and p["met"] == 1


def test_threshold_fallback(table):
    df = table("y int, s double", [(0, 0.9), (1, 0.8)])
    r = decide.threshold_for_precision(df, "y", "s", 0.98).first()
    assert (r["threshold"], r["met"], r["precision"]) == (0.5, 0, None)
    scan = decide.threshold_scan(table("y int, s double", [(1, 0.01), (0, 0.9)]), "y", "s").collect()
    assert [r["chosen"] for r in scan] == [1] + [0] * 9 and scan[0]["recall"] == 0.0


def test_threshold_is_inclusive(table):
    df = decide.apply_threshold(table("s double", [(0.5,), (0.49,)]), "s", 0.5)
    assert [r["pred"] for r in df.collect()] == [1, 0]


def test_gain_and_top_k(table):
    rows = _scored(seed=4, digits=1)
    df = table("id long, y int, s double", rows)
    gain = curves.cumulative_gain(df, "y", "id", "s").orderBy("position").collect()
    assert len(gain) == 300 and gain[-1]["share_captured"] == 1.0 and gain[-1]["share_contacted"] == 1.0
    assert len(curves.cumulative_gain(df, "y", "id", "s", points=10).collect()) == 10
    top = sorted(rows, key=lambda r: (-r[2], r[0]))[:50]
    got = curves.precision_lift_at_k(df, "y", "id", "s", 50).first()
    assert got["precision_at_k"] == pytest.approx(sum(y for _, y, _ in top) / 50)
    assert curves.precision_lift_at_k(df, "y", "id", "s", 9999).first()["k"] == 300


def test_long_top_list_equals_short_path(table, monkeypatch):
    df = table("id long, y int, s double", _scored(seed=5, digits=1))
    short = {r["id"] for r in curves.top_k(df, "id", "s", 77).collect()}
    monkeypatch.setattr(curves, "TOP_LIMIT", 10)
    assert {r["id"] for r in curves.top_k(df, "id", "s", 77).collect()} == short


def test_degenerate_threshold_is_flagged(table):
    df = table("y int, s double", [(i % 2, 0.1 + i / 100) for i in range(50)])
    assert metrics.degenerate_flag(df, "y", "s", 0.0).first()["degenerate"] == 1
    clear = table("y int, s double", [(1, 0.9), (0, 0.1)])
    assert metrics.degenerate_flag(clear, "y", "s", 0.5).first()["degenerate"] == 0


def test_compare_models_sorts_by_auc(table):
    rows = [(m, i, y, s if m == "good" else 1 - s, int(s > 0.5)) for m in ("good", "bad") for i, y, s in _scored()]
    got = compare_models(table("model string, id long, y int, score double, pred int", rows), "model").collect()
    assert [r["model"] for r in got] == ["good", "bad"]
    assert got[0]["roc_auc"] == pytest.approx(_pair_auc(_scored()))
