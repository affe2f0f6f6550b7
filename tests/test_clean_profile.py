import pytest
from pyspark.sql import functions as F

from tabwright.operators import clean, curves, encode, explain, profile


def test_drop_columns_raises_only_when_asked(table):
    df = table("a int, b int", [(1, 2)])
    assert clean.drop_columns(df, ["b", "c"], missing_ok=True).columns == ["a"]
    with pytest.raises(ValueError):
        clean.drop_columns(df, ["c"])


def test_sentinels(table):
    df = table("a int, b int", [(0, 0), (999, 3)])
    assert [tuple(r) for r in clean.sentinel_to_null(df, ["a"], 0).collect()] == [(None, 0), (999, 3)]
    out = clean.sentinel_flag(df, "a", 999, -1, "seen", "clean").select("seen", "clean").collect()
    assert [tuple(r) for r in out] == [(1, 0), (0, -1)]
    assert {r["column"]: r["hits"] for r in clean.sentinel_census(df, ["a", "b"], 0).collect()} == {"a": 1, "b": 1}


def test_dedup_keeps_smallest_id_and_counts(table):
    rows = [(i, "copy" if i % 3 else f"text {i}") for i in range(300)]
    df = table("id long, text string", rows, 6)
    kept = {r["id"] for r in clean.dedup_rows(df, ["text"], "id").collect()}
    assert kept == {i for i in range(300) if i % 3 == 0} | {1}
    stats = clean.dedup_stats(df, ["text"]).first()
    assert tuple(stats) == (300, 199, 101)
    assert tuple(clean.dedup_stats(clean.dedup_rows(df, ["text"], "id"), ["text"]).first()) == (101, 0, 101)


def test_bins_are_right_closed(table):
    df = table("v double", [(39.0,), (39.5,), (0.0,), (49.0,), (50.0,)])
    got = [r["bin"] for r in clean.bin_column(df, "v", [0, 39, 49], ["young", "mid"]).collect()]
    assert got == ["young", "mid", None, "mid", None]


def test_schema_checks(table):
    df = table("id long, y int, c string", [(1, 0, "a"), (2, 1, "b"), (3, 1, "b")])
    roles = clean.Roles(id="id", label="y", categorical=("c",))
    assert clean.check_declared(df, roles) is df
    with pytest.raises(ValueError, match="missing"):
        clean.check_declared(df.drop("c"), roles)
    levels = table("column string, level string", [("c", "a")])
    assert [tuple(r) for r in clean.level_guard(df, levels, ["c"]).collect()] == [("c", "b", 2)]


def test_null_census_total(table):
    df = table("a int, b string", [(1, None), (None, None)])
    assert {r[0]: r[1] for r in clean.null_census(df).collect()} == {"a": 1, "b": 2, "(total)": 3}


def test_empty_declared_groups_stay(table):
    df = table("g string, y int", [("a", 1), ("a", 0), ("b", 1)])
    got = {r["g"]: (r["n"], r["rate"]) for r in profile.group_rate(df, "g", "y", ["a", "b", "c"]).collect()}
    assert got == {"a": (2, 0.5), "b": (1, 1.0), "c": (0, None)}


def test_histogram_last_bin_is_closed(table):
    df = table("g int, v double", [(1, float(v)) for v in range(11)] + [(2, 5.0), (2, 5.0)])
    got = {(r["g"], r["bin"]): r["n"] for r in profile.histogram_by(df, "g", "v", 5).collect()}
    assert got == {(1, 0): 2, (1, 1): 2, (1, 2): 2, (1, 3): 2, (1, 4): 3, (2, 0): 2}


def test_box_stats_outliers(table):
    df = table("g int, v double", [(1, float(v)) for v in [1, 2, 3, 4, 5, 100]])
    r = profile.box_stats(df, "g", "v").first()
    assert (r["q1"], r["median"], r["q3"]) == (2.25, 3.5, 4.75)
    assert (r["whisker_low"], r["whisker_high"], r["outliers"]) == (1.0, 5.0, 1)


def test_wide_correlation_equals_narrow(spark, table):
    import random

    random.seed(1)
    cols = [f"c{i}" for i in range(50)]
    df = table(", ".join(f"{c} double" for c in cols), [tuple(random.random() for _ in cols) for _ in range(60)])
    wide = {(r["a"], r["b"]): r["r"] for r in profile.correlation_matrix(df, cols).collect()}
    narrow = {(r["a"], r["b"]): r["r"] for r in profile.correlation_matrix(df, cols[:4]).collect()}
    assert all(abs(wide[k] - v) < 1e-9 for k, v in narrow.items())


def test_text_length_counts_characters(table):
    assert clean.text_length(table("t string", [("héé",)]), "t").first()["n_characters"] == 3
    assert profile.table_shape(table("a int, b int", [(1, 2)])).first().asDict() == {"rows": 1, "columns": 2}
    assert profile.value_counts(table("a int", [(1,), (1,), (2,)]), "a").collect()[0]["share"] == pytest.approx(2 / 3)
    assert profile.base_rate(table("y int", [(1,), (0,)]), "y").select(F.round("base_rate", 2)).first()[0] == 0.5


@pytest.mark.parametrize("width", [2, 48, 49])
def test_pairwise_complete_at_every_width(table, width):
    import numpy as np

    rng = np.random.default_rng(width)
    x = rng.normal(1e6, 1.0, (80, width))
    x[:, 1] += x[:, 0]
    gone = rng.random((80, width)) < 0.15
    cols = [f"c{i}" for i in range(width)]
    rows = [tuple(None if g else float(v) for v, g in zip(r, h)) for r, h in zip(x, gone)]
    df = table(", ".join(f"{c} double" for c in cols), rows, 5)
    got = {(r["a"], r["b"]): r["r"] for r in profile.correlation_matrix(df, cols).collect()}
    for i in range(width):
        for j in range(width):
            both = ~gone[:, i] & ~gone[:, j]
            assert got[cols[i], cols[j]] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-8)
    filled = np.where(gone, 0.0, x)
    assert np.allclose(explain.gram(df, cols), filled.T @ filled)


def test_correlation_without_rows_or_variance(table):
    df = table("a double, b double, c double", [(0.1, 1.0, None), (0.1, 2.0, None), (0.1, 4.0, 1.0)])
    got = {(r["a"], r["b"]): r["r"] for r in profile.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert len(got) == 9 and got["b", "b"] == pytest.approx(1.0) and [v for v in got.values() if v is not None] == [got["b", "b"]]
    empty = profile.correlation_matrix(df.where("b > 9"), ["a", "b"]).collect()
    assert len(empty) == 4 and all(r["r"] is None for r in empty)


def test_top_lists_agree_around_the_heap_limit(table):
    df = table("id long, s double", [(i, None if i % 4 == 0 else float(i % 5)) for i in range(40)], 4)
    for k in (9, 10, 11, 35, 40):
        want = sorted(range(40), key=lambda i: (i % 4 == 0, -(i % 5) if i % 4 else 0, i))[:k]
        assert {r["id"] for r in curves.top_k(df, "id", "s", k, heap=10).collect()} == set(want)


def test_level_limit_is_per_column_and_named(table):
    df = table("a string, b string", [(str(i), str(i % 2)) for i in range(6)])
    assert len(encode.fit_levels(df, ["a", "b"], 6)["a"]) == 6
    with pytest.raises(ValueError, match="column a has 6 levels"):
        encode.fit_levels(df, ["a", "b"], 5)
