"""The work of one task of the neighbour search: exact results from rough bounds, within little memory."""

import tracemalloc

import numpy as np
import pandas as pd
import pytest

from tabwright.operators import neighbors
from tabwright.session import SMALL_ROWS as SMALL


def _frames(q, t, batch=10_000):
    both = [(0, q, 0), (1, t, 1000)]
    rows = [pd.DataFrame({"space": 0, "qb": 0, "tb": 0, "side": side, "id": np.arange(len(x)) + first, "x": list(x), "y": 0}) for side, x, first in both]
    whole = pd.concat(rows, ignore_index=True)
    return [whole.iloc[lo : lo + batch] for lo in range(0, len(whole), batch)]


def _found(q, t, k, batch=10_000):
    return pd.concat(list(neighbors._strip_function(neighbors.METRICS, k)(iter(_frames(q, t, batch)))))


_rng = np.random.default_rng(4)
_ODD = {
    "normal": (_rng.normal(size=(70, 9)), _rng.normal(size=(900, 9))),
    "whole numbers": (_rng.integers(0, 3, (70, 3)).astype(float), _rng.integers(0, 3, (900, 3)).astype(float)),
    "far from zero": (1e9 + _rng.normal(size=(70, 3)), 1e9 + _rng.normal(size=(900, 3))),
    "huge": (1e200 * _rng.normal(size=(20, 3)), 1e200 * _rng.normal(size=(300, 3))),
    "tiny": (1e-25 * _rng.normal(size=(20, 3)), 1e-25 * _rng.normal(size=(300, 3))),
    "skewed": (np.exp(4 * _rng.normal(size=(70, 3))), np.exp(4 * _rng.normal(size=(900, 3)))),
    "wide": (_rng.normal(size=(10, 600)), _rng.normal(size=(100, 600))),
    "not finite": (np.array([[0.0, 1.0], [np.nan, 1.0]]), np.array([[0.0, 1.0], [np.inf, 0.0], [np.nan, 2.0], [3.0, 4.0]])),
}


@pytest.mark.filterwarnings("ignore::RuntimeWarning")
@pytest.mark.parametrize("name", _ODD)
def test_bounds_lose_no_neighbour(name):
    q, t = _ODD[name]
    got = _found(q, t, 7, 250)
    for number, metric in enumerate(neighbors.METRICS):
        for i, x in enumerate(q):
            diff = x - t
            dist = np.sqrt((diff * diff).sum(axis=1)) if metric == "euclidean" else np.abs(diff).sum(axis=1)
            want = [j for j in np.argsort(dist, kind="stable") if np.isfinite(dist[j])][:7]
            own = got[(got["metric"] == number) & (got["query"] == i)]
            assert own["neighbor"].tolist() == [j + 1000 for j in want]
            assert own["distance"].tolist() == dist[want].tolist()


def test_a_task_holds_tiles_not_all_differences():
    q, t = _rng.normal(size=(400, 64)), _rng.normal(size=(6000, 64))
    frames = _frames(q, t)
    tracemalloc.start()
    list(neighbors._strip_function(neighbors.METRICS, 31)(iter(frames)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20


def _counted(metrics, k):
    """In place of the search: one row per task, with the pairs it would compare as the neighbour."""

    def count(batches):
        from pyspark import TaskContext

        rows = pd.concat([pd.DataFrame(columns=["space", "qb", "tb", "side"]), *batches], ignore_index=True)
        tiles = rows.groupby(["space", "qb", "tb", "side"]).size().unstack(fill_value=0).reindex(columns=[0, 1], fill_value=0)
        one = {"metric": 0, "space": 0, "query": TaskContext.get().partitionId(), "neighbor": int((tiles[0] * tiles[1]).sum())}
        yield pd.DataFrame([one | {"y": 0, "distance": 0.0}])

    return count


@pytest.mark.parametrize("rows", [SMALL, 0], ids=["dealt", "by hash"])
def test_tiles_are_dealt_evenly(table, monkeypatch, rows):
    monkeypatch.setattr(neighbors, "_strip_function", _counted)
    monkeypatch.setattr(neighbors, "SMALL_ROWS", rows)
    schema = "id long, x array<double>, y int, s int"
    train = table(schema, [(i, [float(i)], 0, i % 5) for i in range(1000)])
    query = table(schema, [(i, [float(i)], 0, i % 5) for i in range(1000)])
    work = [r["neighbor"] for r in neighbors.knn_neighbors(train, query, 300, space="s").collect()]
    assert sum(work) == 5 * 200 * 200  # every pair once
    if rows:
        assert max(work) < 2 * 5 * 200 * 200 / 10  # ten tiles: no task gets two
