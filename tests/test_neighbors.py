import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.operators import neighbors


def _data(n, seed, dims=4, spread=1.0):
    rng = np.random.default_rng(seed)
    return [(i, [float(v) for v in row], int(row[0] > 0)) for i, row in enumerate(rng.normal(0, spread, (n, dims)))]


def _brute(train, query, k, metric):
    out = {}
    for qid, qx, _ in query:
        d = [(np.sqrt(((np.array(qx) - x) ** 2).sum()) if metric == "euclidean" else np.abs(np.array(qx) - x).sum(), i) for i, x, _ in train]
        out[qid] = [i for _, i in sorted(d)[:k]]
    return out


def _collect(near):
    out = {}
    for r in near.orderBy("rank").collect():
        out.setdefault((r["metric"], r["query"]), []).append(r["neighbor"])
    return out


@pytest.mark.parametrize("block", [10, 4096])
def test_neighbors_equal_brute_force(table, monkeypatch, block):
    monkeypatch.setattr(neighbors, "BLOCK", block)
    train, query = _data(90, 1), _data(35, 2)
    schema = "id long, x array<double>, y int"
    got = _collect(neighbors.knn_neighbors(table(schema, train, 3), table(schema, query, 2), 5, neighbors.METRICS))
    for metric in neighbors.METRICS:
        want = _brute(train, query, 5, metric)
        assert {q: got[(metric, q)] for q in want} == want


def test_ties_are_broken_by_id(table):
    schema = "id long, x array<double>, y int"
    train = table(schema, [(i, [float(i % 2)], 0) for i in range(20)])
    got = neighbors.knn_neighbors(train, table(schema, [(0, [0.0], 0)]), 3)
    assert [r["neighbor"] for r in got.orderBy("rank").collect()] == [0, 2, 4]


def test_crowded_space_is_cut_into_tiles(table, monkeypatch):
    monkeypatch.setattr(neighbors, "BLOCK", 16)
    schema = "id long, x array<double>, y int, s long"
    train = [(i, x, y, 0 if i % 8 else 1) for i, x, y in _data(160, 3)]
    query = [(i, x, y, 0) for i, x, y in _data(40, 4)]
    got = _collect(neighbors.knn_neighbors(table(schema, train), table(schema, query), 4, ["euclidean"], "s"))
    want = _brute([r[:3] for r in train if r[3] == 0], [r[:3] for r in query], 4, "euclidean")
    assert {q: got[("euclidean", q)] for q in want} == want


def test_votes_weighting_and_ties(table):
    near = table(
        "metric string, query long, rank int, neighbor long, y long, distance double",
        [("e", 1, 1, 10, 1, 1.0), ("e", 1, 2, 11, 0, 4.0), ("e", 1, 3, 12, 0, 4.0),
         ("e", 2, 1, 10, 1, 0.0), ("e", 2, 2, 11, 0, 0.5), ("e", 2, 3, 12, 0, 0.5)],
    )
    got = {(r["query"], r["weights"], r["k"]): r["pred"] for r in neighbors.knn_predict(near, [0, 1], [1, 2, 3, 9]).collect()}
    assert got[(1, "uniform", 1)] == 1 and got[(1, "uniform", 2)] == 0  # a tie goes to the smaller class
    assert got[(1, "distance", 3)] == 1 and got[(1, "uniform", 3)] == 0
    assert got[(2, "distance", 3)] == 1  # only the exact match votes
    assert got[(2, "uniform", 9)] == 0  # k beyond the table uses all rows


def test_folds_never_see_their_own_rows(table):
    rows = [(i, x, y, i % 3) for i, x, y in _data(60, 5)]
    df = table("id long, x array<double>, y int, fold int", rows)
    pred = neighbors.knn_grid_predictions(df, [1, 5], "fold", 3, ["euclidean"], scale=False).where("weights = 'uniform'")
    got = {(r["query"], r["k"]): r["pred"] for r in pred.collect()}
    lab = {i: y for i, _, y, _ in rows}
    for i, x, _, f in rows:
        near = _brute([r[:3] for r in rows if r[3] != f], [(i, x, 0)], 5, "euclidean")[i]
        assert got[(i, 1)] == lab[near[0]] and got[(i, 5)] == int(sum(lab[n] for n in near) > 2)


def test_scaling_by_space_uses_its_own_rows(table):
    df = table("id long, x array<double>, s int", [(1, [1.0, 7.0], 0), (2, [3.0, 7.0], 0), (3, [10.0, 1.0], 1), (4, [30.0, 5.0], 1)])
    got = {r["id"]: r["x"] for r in neighbors.scale_arrays(df, df, "x", "s").collect()}
    assert got == {1: [-1.0, 0.0], 2: [1.0, 0.0], 3: [-1.0, -1.0], 4: [1.0, 1.0]}


def test_hashed_search_finds_most_neighbours(table):
    schema = "id long, x array<double>, y int"
    train, query = table(schema, _data(400, 6, 3)), table(schema, _data(40, 7, 3))
    exact = neighbors.knn_neighbors(train, query, 5)
    found = neighbors.knn_approx(train, query, 5, bucket_length=2.0, tables=6)
    recall = neighbors.neighbor_recall(found, exact).first()[0]
    assert recall > 0.9
    assert found.groupBy("query").count().agg(F.max("count")).first()[0] <= 5


def test_many_copies_of_one_row(table):
    schema = "id long, x array<double>, y int"
    train = [(i, x if i % 3 else [0.1, 0.2, 0.3, 0.4], y) for i, x, y in _data(300, 8)]
    query = _data(20, 9) + [(50 + i, [0.1, 0.2, 0.3, 0.4], 0) for i in range(10)]
    got = _collect(neighbors.knn_neighbors(table(schema, train, 4), table(schema, query, 2), 7))
    want = _brute(train, query, 7, "euclidean")
    assert {q: got[("euclidean", q)] for q in want} == want


def test_medians_come_from_each_spaces_own_rows(table):
    df = table("id long, x array<double>, s int", [(1, [1.0], 0), (2, [None], 0), (3, [4.0], 0), (4, [None], 1), (5, [9.0], 1)])
    got = {r["id"]: r["x"][0] for r in neighbors.impute_arrays(df, df, "x", "s").collect()}
    assert got == {1: 1.0, 2: 2.5, 3: 4.0, 4: 9.0, 5: 9.0}
    assert neighbors.impute_arrays(df, df).where("id = 2").first()["x"] == [4.0]


@pytest.mark.parametrize("strip", [1, 3, 64])
def test_strips_keep_the_best_of_all_blocks(table, monkeypatch, strip):
    monkeypatch.setattr(neighbors, "BLOCK", 16)
    monkeypatch.setattr(neighbors, "STRIP", strip)
    schema = "id long, x array<double>, y int"
    # whole numbers: many equal distances, which only the id decides
    train = [(i, [float(round(v)) for v in x], y) for i, x, y in _data(1300, 11, 3, 2.0)]
    query = [(i, [float(round(v)) for v in x], y) for i, x, y in _data(50, 12, 3, 2.0)]
    got = _collect(neighbors.knn_neighbors(table(schema, train[::-1], 5), table(schema, query, 2), 9, neighbors.METRICS))
    for metric in neighbors.METRICS:
        want = _brute(train, query, 9, metric)
        assert {q: got[(metric, q)] for q in want} == want


def test_fewer_training_rows_than_neighbours(table):
    schema = "id long, x array<double>, y int"
    near = neighbors.knn_neighbors(table(schema, _data(3, 1)), table(schema, _data(4, 2)), 7)
    assert near.count() == 12
    assert neighbors.knn_neighbors(table(schema, []), table(schema, _data(4, 2)), 7).count() == 0


def test_cells_find_most_neighbours_with_less_work(table):
    rng = np.random.default_rng(13)
    schema = "id long, x array<double>, y int"
    centre = rng.normal(0, 4, (20, 8))
    rows = [(i, (centre[i % 20] + rng.normal(0, 1, 8)).tolist(), 0) for i in range(1200)]
    # a third of the rows is one vector
    rows = [(i, rows[0][1] if i % 3 == 0 else x, y) for i, x, y in rows]
    train, query = table(schema, rows[:1100], 4), table(schema, rows[1100:], 2)
    exact = neighbors.knn_neighbors(train, query, 5)
    found = neighbors.knn_cells(train, query, 5, cells=32, probes=8)
    assert neighbors.neighbor_recall(found, exact).first()[0] > 0.95
    assert neighbors.cell_cost(train, query, cells=32, probes=8).first()[0] < 0.7
    assert found.groupBy("query").count().agg(F.max("count")).first()[0] <= 5
    every = neighbors.knn_cells(train, query, 5, cells=32, probes=32)
    assert neighbors.neighbor_recall(every, exact).first()[0] == 1.0
