"""Every query with a SQL twin against DuckDB on the smallest tables, plus plan shape checks."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tabwright.operators import curves, split
from tabwright.plans import frames

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES.split():
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def _text(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return str(v)


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    res = con.execute(entry.oracle_sql()[name])
    heads = [d[0] for d in res.description]
    assert sorted(heads) == cols
    at = [heads.index(c) for c in cols]
    want = sorted(tuple(_text(r[i]) for i in at) for r in res.fetchall())
    assert sorted(tuple(_text(r[c]) for c in cols) for r in df.collect()) == want


def test_flagship_has_rows(spark):
    assert entry.entry(spark).count() >= 4


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_level_work_never_meets_in_one_partition(spark):
    scored = frames.scored_orders(spark, SF)
    for df in (
        split.stratified_folds(scored, "id", "y"),
        curves.cumulative_gain(scored, "y", "id", "score"),
        curves.pr_points(curves.curve_table(scored, "y", "score")),
    ):
        lines = _plan(df).splitlines()
        assert any("Window [" in line for line in lines)
        for at, line in enumerate(lines):
            if "SinglePartition" in line:  # only the table of bucket sums may be gathered
                assert any("HashAggregate(keys=[_b#" in below for below in lines[at + 1 : at + 4]), line


def test_scans_read_only_needed_columns(spark):
    plan = _plan(entry.queries()["parquet_scan"](spark, SF))
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,400000.0)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan
    assert "CartesianProduct" not in _plan(entry.queries()["knn_neighbors"](spark, SF))
