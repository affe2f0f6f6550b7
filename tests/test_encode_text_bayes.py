import math
from collections import Counter
from pathlib import Path
from urllib.parse import unquote, urlparse

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from tabwright import session
from tabwright.operators import bayes, encode, text, tune
from tabwright.operators.linear import score_model
from tabwright.session import fresh_path
from tabwright.sources import models, tables


def _rows(table):
    rows = [(i, i % 2, float(i % 7), None if i % 5 == 0 else float(i % 11), "abc"[i % 3], i % 12) for i in range(240)]
    return table("id long, y int, a double, b double, c string, k int", rows, 4)


def test_impute_and_scale(table):
    df = table("v double, w double", [(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (4.0, 5.0), (None, 5.0)])
    filled = encode.median_impute(df, df, ["v"])
    assert [r["v"] for r in filled.collect()] == [1.0, 2.0, 3.0, 4.0, 2.5]
    scaled = encode.standardize(df.where("v IS NOT NULL"), df, ["v", "w"]).collect()
    assert scaled[0]["v"] == pytest.approx(-1.5 / np.std([1, 2, 3, 4])) and scaled[0]["w"] == 0.0


def test_fit_ignores_rows_it_is_not_given(table):
    df = _rows(table)
    train = df.where("id < 120")
    changed = df.withColumn("a", F.when(F.col("id") >= 120, 1e9).otherwise(F.col("a")))
    assert encode.fit_scaler(train, ["a"]) == encode.fit_scaler(changed.where("id < 120"), ["a"])


def test_one_hot_unseen_and_numeric_order(table):
    df = _rows(table)
    levels = encode.fit_levels(df, ["k", "c"])
    assert levels["k"] == [str(i) for i in range(12)] and levels["c"] == ["a", "b", "c"]
    new = table("id long, c string", [(1, "a"), (2, "zzz"), (3, None), (4, "b")])
    got = {tuple(r) for r in encode.one_hot_long(df, new, "id", ["c"]).collect()}
    assert got == {(1, "c_a"), (4, "c_b")}
    assert {tuple(r) for r in encode.one_hot_long(df, new, "id", ["c"], "first").collect()} == {(4, "c_b")}


def test_design_remainder_and_names(table):
    df = _rows(table)
    with pytest.raises(ValueError, match="without a role"):
        encode.fit_design(df, numeric=["a"], ignore=["id", "y"])
    d = encode.fit_design(df, numeric=["a"], categorical=["c"], ignore=["id", "y", "b"], remainder="passthrough", scale=False)
    assert d.names == ["cat__c_a", "cat__c_b", "cat__c_c", "num__a", "rest__k"]
    d = encode.fit_design(df, numeric=["a"], categorical=["c"], drop="first", ignore=["id", "y"], remainder="drop")
    assert d.names == ["cat__c_b", "cat__c_c", "num__a"]


def test_saved_pipeline_cleans_and_scores_raw_rows(spark, table):
    df = _rows(table)
    d = encode.fit_design(df, numeric=["a", "b"], categorical=["c"], impute=True, sentinels={"a": 0.0}, ignore=["id", "y", "k"])
    model = encode.fit_pipeline(d, LogisticRegression(labelCol="y", regParam=0.1), df)
    path = fresh_path(spark, "m")
    models.save_pipeline(model, path)
    want = {r["id"]: r["score"] for r in score_model(model, df).collect()}
    got = {r["id"]: r["score"] for r in score_model(models.load_pipeline(path), df).collect()}
    assert got == want
    raw = df.where("id = 0").union(df.where("id = 0").withColumn("a", F.lit(None).cast("double")))
    assert len({r["score"] for r in score_model(model, raw).collect()}) == 1  # sentinel 0 and null are the same


def test_quotes_in_levels(table):
    df = table("id long, c string", [(1, "o'clock"), (2, "back\\slash"), (3, 'q"')])
    d = encode.fit_design(df, categorical=["c"], ignore=["id"])
    got = d.long(df, "id").where("value = 1").count()
    assert got == 3


def test_weights(table):
    df = table("id long, y int", [(i, int(i < 2)) for i in range(10)])
    w = {r["y"]: r["weight"] for r in encode.class_weights(df, "y").collect()}
    assert w == {1: 10 / 4, 0: 10 / 16}
    bags = encode.bag_weights(df, "id", "y", 4).collect()
    for t in range(4):
        mine = [r for r in bags if r["tree"] == t]
        sums = {y: sum(r["weight"] for r in mine if r["y"] == y) for y in (0, 1)}
        if all(sums.values()):
            assert sums[0] == pytest.approx(sums[1])


DOCS = [
    (1, "Win CASH now, win big!", 1), (2, "cash prize: win now", 1), (3, "See you at lunch", 0),
    (4, "lunch at noon? see you", 0), (5, "big lunch now", 0), (6, "a b c", 0),
]


def _counts(rows):
    import re

    return {i: Counter(re.findall(r"\w{2,}", t.lower())) for i, t, _ in rows}


def _tfidf(rows, min_df=2, max_df=0.9):
    counts = _counts(rows)
    df = Counter(t for c in counts.values() for t in c)
    keep = {t for t, n in df.items() if n >= min_df and n <= max_df * len(rows)}
    out = {}
    for i, c in counts.items():
        raw = {t: (1 + math.log(n)) * (math.log((1 + len(rows)) / (1 + df[t])) + 1) for t, n in c.items() if t in keep}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        out.update({(i, t): v / norm for t, v in raw.items()})
    return out


def test_tokens_and_ngrams(table):
    df = text.tokenize(table("t string", [("It's a Ünï_code 42!",), ("x",)]), "t")
    assert [r["tokens"] for r in df.collect()] == [["it", "ünï_code", "42"], []]
    got = [r[0] for r in df.select(text.ngrams("tokens", 1, 2)).collect()]
    assert got == [["it", "ünï_code", "42", "it ünï_code", "ünï_code 42"], []]


def test_tfidf_and_vectors_match_definition(table):
    df = table("id long, text string, y int", DOCS)
    counts = text.term_counts(df, "id", "text")
    got = {(r["id"], r["term"]): r["value"] for r in text.tfidf(counts, text.fit_idf(counts, 6)).collect()}
    want = _tfidf(DOCS)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(v) for k, v in want.items())
    toks = text.tokenize(df, "text")
    vec = text.fit_tfidf_vectors(toks, "tokens").transform(toks)
    for r in vec.collect():
        norm = math.sqrt(sum(v * v for v in r["features"].values))
        assert norm == pytest.approx(1.0) or not len(r["features"].indices)
        assert len(r["features"].indices) == sum(1 for i, _ in want if i == r["id"])


def test_salted_term_join_equals_broadcast(table, monkeypatch):
    df = table("id long, text string, y int", DOCS)
    counts = text.term_counts(df, "id", "text")
    idf = text.fit_idf(counts, 6)
    want = {tuple(r) for r in text.tfidf(counts, idf).collect()}
    monkeypatch.setattr(text, "BROADCAST_BYTES", 0)
    assert {tuple(r) for r in text.tfidf(counts, idf).collect()} == want


def _nb(table):
    df = table("id long, text string, y int", DOCS)
    values = text.term_counts(df, "id", "text", keep=["y"]).withColumn("value", F.col("tf").cast("double"))
    return df, values


def test_multinomial_matches_definition(spark, table):
    df, values = _nb(table)
    model = bayes.fit_multinomial_nb(values, df, "y", 0.5)
    counts = _counts(DOCS)
    vocab = {t for c in counts.values() for t in c}
    lab = {i: y for i, _, y in DOCS}
    s = {c: Counter() for c in (0, 1)}
    for i, c in counts.items():
        s[lab[i]].update(c)
    lp = {c: {t: math.log(s[c][t] + 0.5) - math.log(sum(s[c].values()) + 0.5 * len(vocab)) for t in vocab} for c in s}
    prior = {0: math.log(4 / 6), 1: math.log(2 / 6)}
    got = {r["id"]: r for r in bayes.nb_scores(model, df.select("id", "y"), values).collect()}
    for i, c in counts.items():
        j = [prior[k] + sum(n * lp[k][t] for t, n in c.items()) for k in (0, 1)]
        assert got[i]["score"] == pytest.approx(1 / (1 + math.exp(j[0] - j[1])))
        assert got[i]["pred"] == int(j[1] > j[0])
    assert got[6]["score"] == pytest.approx(2 / 6)  # no usable term: the prior
    path = fresh_path(spark, "nb")
    model.save(path)
    again = {r["id"]: r["score"] for r in bayes.nb_scores(bayes.TermModel.load(spark, path), df.select("id"), values).collect()}
    assert again == {i: r["score"] for i, r in got.items()}


def test_bernoulli_matches_definition(table):
    df, values = _nb(table)
    present = text.binarize_presence(values)
    model = bayes.fit_bernoulli_nb(present, df, "y", 1.0)
    counts = _counts(DOCS)
    vocab = {t for c in counts.values() for t in c}
    lab = {i: y for i, _, y in DOCS}
    n = {0: 4, 1: 2}
    p = {c: {t: (sum(t in counts[i] for i in counts if lab[i] == c) + 1) / (n[c] + 2) for t in vocab} for c in n}
    got = {r["id"]: r["score"] for r in bayes.nb_scores(model, df.select("id"), present).collect()}
    for i, c in counts.items():
        j = [math.log(n[k] / 6) + sum(math.log(p[k][t] if t in c else 1 - p[k][t]) for t in vocab) for k in (0, 1)]
        assert got[i] == pytest.approx(1 / (1 + math.exp(j[0] - j[1])))


def test_zero_smoothing_is_refused(table):
    df, values = _nb(table)
    with pytest.raises(ValueError):
        bayes.fit_multinomial_nb(values, df, "y", 0.0)


def test_class_terms_lead_with_the_positive_class(table):
    df, values = _nb(table)
    terms = bayes.class_terms(bayes.fit_multinomial_nb(values, df, "y", 1.0), n=2).collect()
    assert {r["term"] for r in terms} == {"win", "cash"}


def test_dummies(table):
    train = table("id long, y int", [(i, int(i % 4 == 0)) for i in range(400)])
    flat = bayes.dummy_most_frequent(train, train, "y").select("pred", "score").distinct().collect()
    assert [tuple(r) for r in flat] == [(0, 0.0)]
    tie = table("id long, y int", [(1, 1), (2, 0)])
    assert bayes.dummy_most_frequent(tie, tie, "y").first()["pred"] == 0
    drawn = bayes.dummy_stratified(train, train, "y", "id").agg(F.avg("pred")).first()[0]
    assert abs(drawn - 0.25) < 0.08


def test_nb_grid_equals_separate_fits(table):
    rows = [(i, " ".join(w for j, w in enumerate("win cash now lunch see you big noon".split()) if (i * 7 + j * (3 if i % 3 else 5)) % 4), int(i % 3 == 0), i // 3 % 3)
            for i in range(36)]
    df = table("id long, text string, y int, fold int", rows, 3)
    grid = {(r["hi"], r["alpha"]): r["mean_score"] for r in tune.nb_grid(df, "id", "text", "y", "fold", [1, 2], [0.1, 1.0], 3, scorer="accuracy").collect()}
    for hi in (1, 2):
        counts = text.term_counts(df, "id", "text", 1, hi, keep=["y", "fold"])
        for alpha in (0.1, 1.0):
            acc = []
            for f in range(3):
                train, held = counts.where(f"fold <> {f}"), counts.where(f"fold = {f}")
                idf = text.fit_idf(train, 24)
                model = bayes.fit_multinomial_nb(text.tfidf(train, idf), df.where(f"fold <> {f}"), "y", alpha)
                scored = bayes.nb_scores(model, df.where(f"fold = {f}").select("id", "y"), text.tfidf(held, idf))
                acc.append(scored.agg(F.avg((F.col("pred") == F.col("y")).cast("double"))).first()[0])
            assert grid[(hi, alpha)] == pytest.approx(np.mean(acc)), (hi, alpha)


def test_csv_latin1_and_rules_files(spark, table):
    df = table("k string, t string", [("ham", "café £ 5, \"quoted\"\nnext line"), ("spam", "plain; text")])
    path = fresh_path(spark, "csv")
    tables.write_csv(df, path, sep=";", encoding="ISO-8859-1")
    back = tables.read_csv(spark, path, df.schema, ";", "ISO-8859-1", multiline=True)
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in df.collect()}
    assert tables.take_columns(df, 1, ["label"]).columns == ["label"]
    with pytest.raises(Exception):
        tables.write_csv(df, path)  # an export never overwrites silently


def test_hot_terms_of_a_large_table_stay_where_they_are(table, monkeypatch):
    monkeypatch.setattr(text, "BROADCAST_BYTES", 0)
    rows = [(i, "common") for i in range(400)] + [(i, f"rare{i}") for i in range(300)] + [(1, "unknown")]
    terms = [("common", 0.5), *[(f"rare{i}", float(i)) for i in range(300)]]
    joined = text.join_terms(table("id long, term string", rows, 4), table("term string, w double", terms))
    assert sorted((r["id"], r["term"], r["w"]) for r in joined.collect()) == sorted(
        [(i, "common", 0.5) for i in range(400)] + [(i, f"rare{i}", float(i)) for i in range(300)])
    assert "LeftAnti, BuildRight" in joined._jdf.queryExecution().executedPlan().toString()


def test_term_vectors_equal_the_vectorizer_up_to_order(table):
    df = table("id long, text string, y int", [*DOCS, (99, "?", 0)], 3)
    counts = text.term_counts(df, "id", "text")
    idf = text.fit_idf(counts, df.count())
    values = text.tfidf(counts, idf)
    got = {r["id"]: r["features"] for r in text.term_vectors(df.select("id", "y"), values, idf).collect()}
    want: dict = {}
    for r in values.collect():
        want.setdefault(r["id"], []).append(r["value"])
    assert len(got) == df.count() and not len(got[99].indices)
    for i, v in got.items():
        assert v.size == idf.count() and list(v.indices) == sorted(set(v.indices))
        assert sorted(v.values) == pytest.approx(sorted(want.get(i, [])))


def test_scratch_scope_removes_what_was_written_inside(spark, table):
    import os

    from tabwright.session import materialize, scratch_scope

    kept = materialize(table("a int", [(1,)]), "outer")
    with scratch_scope(spark):
        inner = materialize(table("a int", [(2,)]), "inner")
        with scratch_scope(spark):
            deep = materialize(table("a int", [(3,)]), "deep").inputFiles()[0]
        assert inner.count() == 1 and not os.path.exists(deep.removeprefix("file://"))
        gone = inner.inputFiles()[0].removeprefix("file://")
    assert kept.count() == 1 and not os.path.exists(gone)


def test_finished_steps_of_the_grid_give_their_disk_back(spark, monkeypatch):
    """Term counts and pairs are removed once read, and values of all folds and ranges are not written."""
    columns, files = {}, {}

    def keep(df, label="table"):
        out = session.materialize(df, label)
        columns[label], files[label] = out.columns, out.inputFiles()
        return out

    monkeypatch.setattr(tune, "materialize", keep)
    docs = spark.createDataFrame([(i, f"w{i % 3} w{i % 4} w{i % 5}", i % 2, i % 3) for i in range(30)], "id long, text string, y int, fold int")
    assert tune.nb_grid(docs, "id", "text", "y", "fold", [1, 2], [0.1], 3).count() == 2
    there = {label for label, names in files.items() if names and all(Path(unquote(urlparse(n).path)).exists() for n in names)}
    assert {"grid-values", "grid-sums"} <= there and not {"grid-counts", "grid-idf", "grid-pairs"} & there
    assert files["grid-pairs"] and not {"term", "hi", "_v0"} & set(columns["grid-values"])
