"""Trees and forests on Spark ML, plus what it does not expose: votes of single trees and rules
as a table. ``forest`` has forests with their own bags."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    DecisionTreeClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.operators.encode import Design
from tabwright.session import fitted, fresh_path

# (row, tree) pairs of a forest: so few stay in the tasks they come in, so many make a task, of so many the node numbers are kept
FEW_NODES = 1 << 24
TASK_NODES = 1 << 21
KEPT_NODES = 1 << 29


def fit_tree(
    df: DataFrame, label: str = "y", features: str = "features", impurity: str = "gini", max_depth: int = 5,
    min_leaf: int = 1, weight: str | None = None, max_bins: int = 256, seed: int = 42,
) -> DecisionTreeClassificationModel:
    est = DecisionTreeClassifier(
        featuresCol=features, labelCol=label, impurity=impurity, maxDepth=max_depth, minInstancesPerNode=min_leaf,
        maxBins=max_bins, leafCol="leaf", seed=seed,
    )
    return (est.setWeightCol(weight) if weight else est).fit(df)


def _dealt(df: DataFrame, n: int) -> DataFrame:
    """``df`` in ``n`` tasks, each in an order that follows from its rows, so a repeated task draws the same bags."""
    key = F.xxhash64(*df.columns)
    return df.repartition(n, key).sortWithinPartitions(key)


class ForestBatches:
    """One forest whose trees were fitted in batches: a row's scores are means over all trees."""

    def __init__(self, members: Sequence[RandomForestClassificationModel]):
        self.members = list(members)

    @property
    def featureImportances(self) -> DenseVector:
        """As of one model: shares of each tree, averaged over the trees that split."""
        split = [sum(t.numNodes > 1 for t in m.trees) for m in self.members]
        sums = sum(n * m.featureImportances.toArray() for n, m in zip(split, self.members, strict=True))
        return Vectors.dense(sums / max(1, sum(split)))

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with probability, prediction and leaf, a leaf number per tree."""
        out, sizes = df, [m.getNumTrees for m in self.members]
        for k, m in enumerate(self.members):
            names = {m.probabilityCol: f"_p{k}", m.leafCol: f"_l{k}", m.rawPredictionCol: "", m.predictionCol: ""}
            out = m.copy(names).transform(out)

        def share(k: int) -> Column:
            return F.transform(vector_to_array(f"_p{k}"), lambda v: v * (sizes[k] / sum(sizes)))

        mean = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), [share(k) for k in range(len(sizes))])
        leaf = F.concat(*[vector_to_array(f"_l{k}") for k in range(len(sizes))])
        made = out.withColumns({"probability": mean, "leaf": array_to_vector(leaf)})
        made = made.withColumn("prediction", (F.array_position("probability", F.array_max("probability")) - 1).cast("double"))
        return made.withColumn("probability", array_to_vector("probability")).drop(*[f"{c}{k}" for c in ("_p", "_l") for k in range(len(sizes))])


def fit_forest(
    df: DataFrame, label: str = "y", features: str = "features", n_trees: int = 50, subset: str = "sqrt",
    max_depth: int = 10, weight: str | None = None, max_bins: int = 128, seed: int = 42,
) -> RandomForestClassificationModel | ForestBatches:
    """A forest whose passes use all cores, however few bytes the rows take.

    Beyond ``FEW_NODES`` rows x trees, rows are dealt to tasks, at most two per core: every task sends the
    statistics of all open nodes. Node numbers of all (row, tree) are kept between passes, so a pass does not walk the trees
    again; trees are fitted in batches that keep at most ``KEPT_NODES`` of them.
    """
    rows = df.count()
    if rows * n_trees > FEW_NODES:
        df = _dealt(df, min(2 * df.sparkSession.sparkContext.defaultParallelism, -(-rows * n_trees // TASK_NODES)))
    batches = min(n_trees, max(1, -(-rows * n_trees // KEPT_NODES)))
    made = []
    for k in range(batches):
        est = RandomForestClassifier(
            featuresCol=features, labelCol=label, numTrees=n_trees * (k + 1) // batches - n_trees * k // batches,
            featureSubsetStrategy=subset, maxDepth=max_depth, maxBins=max_bins, leafCol="leaf", seed=seed + 1_000_003 * k,
            cacheNodeIds=True, checkpointInterval=-1,
        )
        made.append((est.setWeightCol(weight) if weight else est).fit(df))
    return made[0] if batches == 1 else ForestBatches(made)


def node_table(model, spark) -> DataFrame:
    """Nodes of a fitted tree or forest: (tree, id, prediction, stats, left, right, feature, threshold).

    Read back from Spark ML's own model format; its size is that of the model.
    """
    if isinstance(model, ForestBatches):
        parts, before = [], 0
        for m in model.members:
            parts.append(node_table(m, spark).withColumn("tree", (F.col("tree") + before).cast("int")))
            before += m.getNumTrees
        return reduce(DataFrame.unionByName, parts)
    path = fresh_path(spark, "nodes")
    model.save(path)
    raw = spark.read.parquet(f"{path}/data")
    node = "nodeData." if "nodeData" in raw.columns else ""
    tree = F.col("treeID") if node else F.lit(0)

    def of(name: str) -> Column:
        return F.col(f"{node}{name}")

    return raw.select(
        tree.alias("tree"), of("id").alias("id"), of("prediction").alias("prediction"),
        of("impurityStats").alias("stats"), of("leftChild").alias("left"), of("rightChild").alias("right"),
        of("split.featureIndex").alias("feature"),
        F.try_element_at(of("split.leftCategoriesOrThreshold"), F.lit(1)).alias("threshold"),
    )


def leaf_table(model, spark, positive: int = 1) -> DataFrame:
    """(tree, leaf, p): class share of every leaf; leaves are numbered in node order."""
    nodes = node_table(model, spark).where("left < 0")
    order = Window.partitionBy("tree").orderBy("id")
    share = F.element_at("stats", positive + 1) / F.aggregate("stats", F.lit(0.0), lambda a, v: a + v)
    return nodes.select("tree", (F.row_number().over(order) - 1).alias("leaf"), share.alias("p"))


def tree_votes(model, df: DataFrame, keep: Sequence[str], positive: int = 1) -> DataFrame:
    """(keep..., tree, p): every tree's own probability from the leaf each row falls in."""
    leaves = fitted(leaf_table(model, df.sparkSession, positive))
    rows = model.transform(df).select(*keep, F.posexplode(vector_to_array("leaf")).alias("tree", "_l"))
    return rows.withColumn("leaf", F.col("_l").cast("int")).drop("_l").join(leaves, ["tree", "leaf"]).drop("leaf")


def oob_score(votes: DataFrame, label: str = "y") -> DataFrame:
    """Accuracy of out-of-bag votes over the rows that have any."""
    hit = (F.col("score") > 0.5).cast("int") == F.col(label)
    return votes.agg(F.avg(hit.cast("double")).alias("oob_accuracy"), F.count(F.lit(1)).alias("rows"))


def impurity_importance(model, names: DataFrame, n: int | None = None) -> DataFrame:
    """(feature, source_column, importance) descending; ``names`` is (idx, feature, source_column)."""
    values = model.featureImportances.toArray()
    cells = F.array(*[F.struct(F.lit(i).alias("idx"), F.lit(float(v)).alias("importance")) for i, v in enumerate(values)])
    table = names.sparkSession.range(1).select(F.explode(cells).alias("c")).select("c.*")
    out = names.join(table, "idx").select("feature", "source_column", "importance").orderBy(
        F.desc("importance"), "feature"
    )
    return out.limit(n) if n else out


def importance_by_source(importance: DataFrame) -> DataFrame:
    return importance.groupBy("source_column").agg(F.sum("importance").alias("importance")).orderBy(
        F.desc("importance"), "source_column"
    )


def tree_paths(model, design: Design, spark) -> list[tuple[int, str, str, float]]:
    """Leaves of one tree as (leaf, readable rule, SQL predicate, predicted class), in node order.

    Works on the node list of the fitted model (at most 2^depth entries).
    """
    nodes = {r["id"]: r for r in node_table(model, spark).where("tree = 0").collect()}
    feats = {f.idx: f for f in design.features}
    leaves: list[tuple[int, str, str, float]] = []
    stack: list[tuple[int, list[str], list[str]]] = [(0, [], [])]
    while stack:
        at, words, tests = stack.pop()
        node = nodes[at]
        if node["left"] < 0:
            leaves.append((len(leaves), " AND ".join(words) or "always", " AND ".join(tests) or "true", node["prediction"]))
            continue
        f, cut = feats[node["feature"]], node["threshold"]
        low = [*words, f"{f.name} <= {cut:.2f}"], [*tests, f"({f.sql}) <= {cut!r}D"]
        high = [*words, f"{f.name} > {cut:.2f}"], [*tests, f"({f.sql}) > {cut!r}D"]
        stack += [(node["right"], *high), (node["left"], *low)]
    return leaves


def apply_rules(df: DataFrame, paths, out: str = "leaf") -> DataFrame:
    """Number of the rule each raw row satisfies, by the rules' own SQL."""
    rule = None
    for leaf, _, test, _ in paths:
        rule = F.when(F.expr(test), leaf) if rule is None else rule.when(F.expr(test), leaf)
    return df.withColumn(out, rule)


def leaf_numbers(model, df: DataFrame, out: str = "leaf") -> DataFrame:
    """``df`` (with features) and the number of the leaf each row falls in, numbered as in ``tree_paths``.

    The model walks its nodes, so the plan is the same for a tree of any depth.
    """
    return model.transform(df).withColumn(out, F.col("leaf").cast("int")).drop("rawPrediction", "probability", "prediction")


def tree_rules(df: DataFrame, paths, label: str = "y", merge: bool = False, leaf: str | None = None) -> DataFrame:
    """(leaf, rule, class, support, purity) with support and purity counted on ``df``.

    ``leaf`` names a column of leaf numbers (see ``leaf_numbers``); without it the rules' own SQL
    decides, one condition per leaf. ``merge`` collapses leaves of one class into one row per class.
    """
    spark = df.sparkSession
    table = spark.createDataFrame([(n, words, int(c)) for n, words, _, c in paths], "leaf int, words string, class int")
    found = df.withColumn("leaf", F.col(leaf)) if leaf else apply_rules(df, paths)
    hits = found.groupBy("leaf", F.col(label).alias("_y")).agg(F.count(F.lit(1)).alias("_n"))
    counted = table.join(hits, "leaf", "left").groupBy("leaf", "words", "class").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("support"),
        F.coalesce(F.sum(F.when(F.col("_y") == F.col("class"), F.col("_n"))), F.lit(0)).alias("_hit"),
    )
    if merge:
        counted = counted.groupBy("class").agg(
            F.min("leaf").alias("leaf"),
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("leaf", "words"))), lambda r: r["words"]), " OR ").alias("words"),
            F.sum("support").alias("support"), F.sum("_hit").alias("_hit"),
        )
    purity = F.when(F.col("support") > 0, F.col("_hit") / F.col("support")).otherwise(0.0)
    text = F.concat(F.lit("IF "), F.col("words"), F.lit(" THEN class "), F.col("class").cast("string"))
    return counted.select("leaf", text.alias("rule"), "class", "support", purity.alias("purity"))


def complexity_curve(
    train: DataFrame, test: DataFrame, depths: Sequence[int] = tuple(range(1, 16)), label: str = "y", features: str = "features",
    **options,
) -> DataFrame:
    """(max_depth, train_accuracy, test_accuracy) for every depth, from one fit of the deepest tree.

    Trees grow from the top, so a shallower tree is the deepest one cut off: at depth d a row is
    predicted by the node it passes there. Each leaf carries the predictions of the nodes
    on its path, so one join by leaf serves all depths; the leaf table is as large as the model.
    """
    depths = [int(d) for d in depths]
    model = fit_tree(train, label, features, max_depth=max(depths), **options)
    spark = train.sparkSession
    nodes = {r["id"]: r for r in node_table(model, spark).collect()}
    leaves: list[tuple[int, list[float]]] = []
    stack: list[tuple[int, list[float]]] = [(0, [])]
    while stack:
        at, above = stack.pop()
        path = [*above, float(nodes[at]["prediction"])]
        if nodes[at]["left"] < 0:
            leaves.append((at, [path[min(d, len(path) - 1)] for d in depths]))
        else:
            stack += [(nodes[at]["left"], path), (nodes[at]["right"], path)]
    table = spark.createDataFrame([(n, told) for n, (_, told) in enumerate(sorted(leaves))], "leaf int, told array<double>")
    both = train.select(label, features, F.lit("train").alias("_s")).unionByName(test.select(label, features, F.lit("test").alias("_s")))
    rows = model.transform(both).select(label, "_s", F.col("leaf").cast("int").alias("leaf")).join(table, "leaf")

    def share(k: int, side: str) -> Column:
        return F.avg(F.when(F.col("_s") == side, (F.col("told")[k] == F.col(label)).cast("double")))

    wide = rows.agg(*[share(k, side).alias(f"{side}{k}") for k in range(len(depths)) for side in ("train", "test")])
    cells = [
        F.struct(F.lit(d).alias("max_depth"), F.col(f"train{k}").alias("train_accuracy"), F.col(f"test{k}").alias("test_accuracy"))
        for k, d in enumerate(depths)
    ]
    return wide.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
