from collections import Counter

import pytest

from tabwright.operators import split


def _labels(counts):
    return [(i, y) for i, y in enumerate(y for y, n in counts.items() for _ in range(n))]


@pytest.mark.parametrize(
    "counts, want", [({0: 500, 1: 268}, {0: 100, 1: 54}), ({"No": 1233, "Yes": 237}, {"No": 247, "Yes": 47})]
)
def test_published_holdout_sizes(table, counts, want):
    kind = "int" if 0 in counts else "string"
    rows = split.stratified_split(table(f"id long, y {kind}", _labels(counts), 5), "id", "y").collect()
    assert Counter(r["y"] for r in rows if r["split"] == "test") == want
    assert len(rows) == sum(counts.values())


def test_split_ignores_partitioning_and_order(table):
    rows = _labels({0: 300, 1: 45})
    a = split.stratified_split(table("id long, y int", rows, 2), "id", "y").collect()
    b = split.stratified_split(table("id long, y int", rows[::-1], 9), "id", "y").collect()
    assert {r["id"]: r["split"] for r in a} == {r["id"]: r["split"] for r in b}


def test_three_way_sizes_and_merge(table):
    rows = split.stratified_split3(table("id long, y int", _labels({0: 212, 1: 357}), 4), "id", "y")
    assert Counter(r["split"] for r in rows.collect()) == {"train": 341, "val": 114, "test": 114}
    assert split.merge_splits(rows, ["train", "val"]).count() == 455


def test_folds_cover_and_balance(table):
    rows = split.stratified_folds(table("id long, y int", _labels({0: 203, 1: 51}), 3), "id", "y", 5).collect()
    assert len({r["id"] for r in rows}) == 254
    for y in (0, 1):
        sizes = Counter(r["fold"] for r in rows if r["y"] == y).values()
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_leak_check_finds_crossing_keys(table):
    rows = table("k string, split string", [("a", "train"), ("a", "test"), ("b", "train"), ("b", "train")])
    assert [tuple(r) for r in split.leak_check(rows, "k").collect()] == [("a", 2, 2)]


def test_holdout_is_the_head_of_the_hash_order(table):
    import hashlib

    rows = [(i, "big" if i < 900 else "tiny" if i < 903 else "one") for i in range(904)]
    got = split.stratified_split(table("id long, y string", rows, 6), "id", "y", 0.3, seed=9).collect()
    test = {r["id"] for r in got if r["split"] == "test"}
    assert len(got) == 904 and len(test) == 272  # ceil(0.3 * 904)
    for y in ("big", "tiny", "one"):
        order = sorted((i for i, c in rows if c == y), key=lambda i: hashlib.md5(f"9~{i}".encode()).hexdigest())
        mine = [i for i in order if i in test]
        assert mine == order[: len(mine)]


def test_split_moves_no_rows(table):
    df = split.stratified_split(table("id long, y int", _labels({0: 50, 1: 9}), 3), "id", "y")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SinglePartition" not in plan and "BroadcastHashJoin" in plan


def test_cut_folds_are_runs_of_the_hash_order(table):
    import hashlib

    rows = [(i, "big" if i < 403 else "small" if i < 410 else "one") for i in range(411)]
    df = table("id long, y string", rows, 5)
    got = {r["id"]: r["fold"] for r in split.stratified_cut_folds(df, "id", "y", 5, seed=3).collect()}
    assert len(got) == 411
    dealt = Counter((r["y"], r["fold"]) for r in split.stratified_folds(df, "id", "y", 5).collect())
    assert Counter((y, got[i]) for i, y in rows) == dealt
    for y in ("big", "small", "one"):
        order = sorted((i for i, c in rows if c == y), key=lambda i: hashlib.md5(f"3~{i}".encode()).hexdigest())
        assert [got[i] for i in order] == sorted(got[i] for i in order)


def test_cut_folds_move_no_rows(table):
    df = table("id long, y int, text string", [(i, i % 2, "x") for i in range(50)], 3)
    plan = split.stratified_cut_folds(df, "id", "y", 5)._jdf.queryExecution().executedPlan().toString()
    assert "Window [" not in plan and "SortMergeJoin" not in plan
