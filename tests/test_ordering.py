import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from tabwright.functions.keys import hash_uniform, poisson_count
from tabwright.functions.ordering import exact_quantiles, hash_rank, ordered_rows, running_sums
from tabwright.session import materialize


def test_hash_rank_is_the_global_hash_order(table):
    rows = [(i, "big" if i % 10 else "small") for i in range(2000)]
    df = hash_rank(table("id long, g string", rows, 7), "id", "s", ["g"], "r")
    for g in ("big", "small"):
        ids = sorted((i for i, h in rows if h == g), key=lambda i: hashlib.md5(f"s~{i}".encode()).hexdigest())
        got = {r["id"]: r["r"] for r in df.where(F.col("g") == g).collect()}
        assert got == {i: n for n, i in enumerate(ids, 1)}


def test_hash_rank_without_groups(table):
    df = hash_rank(table("id long", [(i,) for i in range(500)], 3), "id", 1, (), "r")
    assert sorted(r["r"] for r in df.collect()) == list(range(1, 501))


def test_hash_uniform_matches_definition(table):
    got = table("id long", [(5,)]).select(hash_uniform("a", F.col("id"))).first()[0]
    assert got == int(hashlib.md5(b"a~5").hexdigest()[:12], 16) / 16**12


def test_poisson_share_of_zeros(table):
    bags = table("id long", [(i,) for i in range(5000)]).select(poisson_count(hash_uniform("b", F.col("id"))).alias("m"))
    counts = [r["m"] for r in bags.collect()]
    assert abs(counts.count(0) / 5000 - 0.3679) < 0.02 and abs(np.mean(counts) - 1.0) < 0.05


def test_running_sums_by_group(table):
    random.seed(3)
    rows = [(g, float(v), random.randint(1, 9)) for g in ("a", "b") for v in random.sample(range(10_000), 400)]
    df = materialize(table("g string, v double, n int", rows, 5))
    for descending in (False, True):
        got = {(r["g"], r["v"]): r["s"] for r in running_sums(df, "v", {"n": "s"}, ["g"], descending).collect()}
        for g in ("a", "b"):
            total = 0
            for _, v, n in sorted((r for r in rows if r[0] == g), key=lambda r: r[1], reverse=descending):
                total += n
                assert got[(g, v)] == total


def test_ordered_rows_with_one_score_on_most_rows(table):
    random.seed(4)
    rows = [(i, 0.5 if random.random() < 0.7 else round(random.random(), 2), random.randint(0, 1)) for i in range(1500)]
    df = table("id long, s double, y int", rows, 6).withColumn("one", F.lit(1))
    got = {r["id"]: (r["pos"], r["tp"]) for r in ordered_rows(df, "id", "s", {"one": "pos", "y": "tp"}).collect()}
    tp = 0
    for pos, (i, _, y) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])), 1):
        tp += y
        assert got[i] == (pos, tp)


def test_exact_quantiles_match_linear_interpolation(table):
    random.seed(5)
    rows = [("a" if i % 3 else "b", random.choice([1.0, 2.0, random.random() * 10, None])) for i in range(900)]
    df = table("g string, v double", rows, 4)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {(r["g"], r["prob"]): r["value"] for r in exact_quantiles(df, ["v"], probs, ["g"]).collect()}
    for g in ("a", "b"):
        values = [v for h, v in rows if h == g and v is not None]
        for p in probs:
            assert np.isclose(got[(g, p)], np.quantile(values, p))


def test_median_of_even_count_is_not_an_element(table):
    assert exact_quantiles(table("v int", [(1,), (2,), (3,), (4,)]), ["v"], [0.5]).first()["value"] == 2.5


def test_many_buckets_keep_the_order(spark, table):
    random.seed(6)
    values = random.sample(range(100_000), 3000)
    df = materialize(table("v double, n int", [(float(v), 1) for v in values], 4))
    spark.conf.set("spark.sql.shuffle.partitions", "300")
    try:
        got = {r["v"]: r["s"] for r in running_sums(df, "v", {"n": "s"}).collect()}
        empty = running_sums(df.where("v < 0"), "v", {"n": "s"}).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert got == {float(v): i for i, v in enumerate(sorted(values), 1)} and empty == []


def test_ordered_rows_keep_rows_without_a_score(table):
    rows = [(i, None if i % 8 == 0 else float(i % 5), 1) for i in range(40)]
    got = ordered_rows(table("id int, s double, one int", rows, parts=4), "id", "s", {"one": "rank"}).collect()
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert [r["id"] for r in sorted(got, key=lambda r: r["rank"])] == [r[0] for r in want]
