"""Explained and ranked forests are fitted with the reference's number of trees."""

import pytest

from tabwright.operators import trees
from tabwright.plans import catalog

SIZES = {
    "ranked_forest_list": 400, "leak_ablation_forest": 200, "permutation_importance_forest": 400, "importance": 400,
    "sensitive_audit": 400,
}


@pytest.mark.parametrize("name", SIZES)
def test_forest_has_the_reference_size(spark, monkeypatch, name):
    class Asked(Exception):
        pass

    def fit_forest(df, **asked):
        raise Asked(asked)

    monkeypatch.setattr(trees, "fit_forest", fit_forest)
    with pytest.raises(Asked) as got:
        catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
    asked = got.value.args[0]
    assert asked["n_trees"] == SIZES[name] and asked["max_depth"] >= 10 and asked["max_bins"] >= 128
