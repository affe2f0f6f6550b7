"""Feature preparation. Every fit reads the training rows only; its state is p-sized."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tabwright.functions.keys import hash_uniform, poisson_count
from tabwright.functions.ordering import exact_quantiles, hash_rank
from tabwright.operators.text import join_terms
from tabwright.session import fitted, fresh_path, materialize


def fit_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Exact median per column, nulls ignored."""
    return {r["column"]: r["value"] for r in exact_quantiles(df, cols, [0.5]).collect()}


def median_impute(fit_df: DataFrame, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    medians = fit_medians(fit_df, cols)
    return df.withColumns(
        {c: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(medians.get(c))) for c in cols}
    )


def fit_scaler(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """(mean, population std) per column; a constant column gets std 1."""
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(f"`{c}`").cast("double")
        aggs += [F.avg(v).alias(f"m{i}"), F.stddev_pop(v).alias(f"s{i}")]
    row = df.agg(*aggs).first()
    return {c: (row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0) for i, c in enumerate(cols)}


def standardize(fit_df: DataFrame, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    state = fit_scaler(fit_df, cols)
    return df.withColumns(
        {c: (F.col(f"`{c}`").cast("double") - F.lit(m)) / F.lit(s) for c, (m, s) in state.items()}
    )


def level_table(fit_df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct (column, level, number) of several columns in one scan.

    ``number`` carries the numeric value, so integer codes sort 1, 2, 10.
    """
    types = dict(fit_df.dtypes)
    packed = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"`{c}`").cast("string").alias("level"),
            (F.lit(None) if types[c] == "string" else F.col(f"`{c}`")).cast("double").alias("number"),
        )
        for c in cols
    ]
    cells = fit_df.select(F.explode(F.array(*packed)).alias("p")).select("p.*")
    return cells.where("level IS NOT NULL").distinct()


def fit_levels(fit_df: DataFrame, cols: Sequence[str], max_levels: int = 10_000) -> dict[str, list[str]]:
    """Sorted training levels per column, as text.

    Levels become columns of a plan, so a column of more than ``max_levels`` levels is
    refused by name; ``fit_wide_design`` and ``one_hot_long`` encode it without a limit.
    """
    levels = level_table(fit_df, cols)
    if cols:
        levels = materialize(levels, "levels")
        wide = levels.groupBy("column").count().where(F.col("count") > max_levels).first()
        if wide:
            raise ValueError(f"column {wide['column']} has {wide['count']} levels, over {max_levels}; use one_hot_long")
    rows = levels.collect()
    found: dict[str, list] = {c: [] for c in cols}
    for r in sorted(rows, key=lambda r: (r["number"] or 0.0, r["level"])):
        found[r["column"]].append(r["level"])
    return found


def one_hot_long(
    fit_df: DataFrame, df: DataFrame, id_col: str, cols: Sequence[str], drop: str | None = None
) -> DataFrame:
    """(id, feature) for every indicator equal to 1; unseen levels and nulls give no row."""
    levels = level_table(fit_df, cols)
    if drop == "first":
        first = levels.groupBy("column").agg(F.min(F.struct("number", "level")).alias("_first"))
        levels = levels.join(first, "column").where(F.col("level") != F.col("_first.level"))
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("level")) for c in cols]
    long = df.select(id_col, F.explode(F.array(*pairs)).alias("p")).select(id_col, "p.*")
    hit = long.join(fitted(levels.select("column", "level")), ["column", "level"])
    return hit.select(id_col, F.concat_ws("_", "column", "level").alias("feature"))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Feature:
    idx: int
    name: str
    source: str
    sql: str


@dataclass(frozen=True)
class Design:
    """Fitted encoder: one SQL expression per feature, in order."""

    features: tuple[Feature, ...]

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.features]

    def columns(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Wide form: kept columns plus one double column per feature."""
        return df.select(*keep, *[F.expr(f.sql).alias(f.name) for f in self.features])

    def long(self, df: DataFrame, id_col: str, keep: Sequence[str] = ()) -> DataFrame:
        """(id, feature, value) rows."""
        cells = [F.struct(F.lit(f.name).alias("feature"), F.expr(f.sql).alias("value")) for f in self.features]
        return df.select(id_col, *keep, F.explode(F.array(*cells)).alias("c")).select(id_col, *keep, "c.*")

    def stages(self, out: str = "features") -> list:
        """Built-in pipeline stages, so a saved model loads without this package."""
        exprs = ", ".join(f"{f.sql} AS _f{f.idx}" for f in self.features)
        assembler = VectorAssembler(inputCols=[f"_f{f.idx}" for f in self.features], outputCol=out)
        temps = ", ".join(f"_f{f.idx}" for f in self.features)
        return [
            SQLTransformer(statement=f"SELECT *, {exprs} FROM __THIS__"),
            assembler,
            SQLTransformer(statement=f"SELECT * EXCEPT ({temps}) FROM __THIS__"),
        ]

    def assemble(self, df: DataFrame, out: str = "features") -> DataFrame:
        for stage in self.stages(out):
            df = stage.transform(df)
        return df

    def name_table(self, spark) -> DataFrame:
        """(idx, feature, source_column)"""
        rows = [(f.idx, f.name, f.source) for f in self.features]
        return spark.createDataFrame(rows, "idx int, feature string, source_column string")


def fit_design(
    df: DataFrame,
    numeric: Sequence[str] = (),
    categorical: Sequence[str] = (),
    scale: bool = True,
    impute: bool = False,
    drop: str | None = None,
    remainder: str = "error",
    ignore: Sequence[str] = (),
    sentinels: Mapping[str, float] | None = None,
    max_levels: int = 10_000,
) -> Design:
    """Fit the encoders of all blocks on training rows and concatenate them.

    Columns that are in no block and not in ``ignore`` follow ``remainder``:
    "error", "drop" or "passthrough".
    """
    used = {*numeric, *categorical, *ignore}
    rest = [c for c in df.columns if c not in used]
    if rest and remainder == "error":
        raise ValueError(f"columns without a role: {rest}")
    sentinels = dict(sentinels or {})
    raw = {
        c: f"nullif(CAST(`{c}` AS DOUBLE), {float(sentinels[c])!r}D)" if c in sentinels else f"CAST(`{c}` AS DOUBLE)"
        for c in [*numeric, *rest]
    }
    clean = df.withColumns({c: F.expr(raw[c]) for c in numeric}) if numeric else df
    if impute and numeric:
        medians = fit_medians(clean, numeric)
        raw |= {c: f"coalesce({raw[c]}, {medians[c]!r}D)" for c in numeric}
        clean = df.withColumns({c: F.expr(raw[c]) for c in numeric})
    if scale and numeric:
        raw |= {c: f"(({raw[c]} - {m!r}D) / {s!r}D)" for c, (m, s) in fit_scaler(clean, numeric).items()}
    feats: list[tuple[str, str, str]] = []
    if categorical:
        for c, levels in fit_levels(df, categorical, max_levels).items():
            for level in levels[1:] if drop == "first" else levels:
                test = f"CASE WHEN CAST(`{c}` AS STRING) = {_text(level)} THEN 1.0D ELSE 0.0D END"
                feats.append((f"cat__{c}_{level}", c, test))
    feats += [(f"num__{c}", c, raw[c]) for c in numeric]
    if remainder == "passthrough":
        feats += [(f"rest__{c}", c, raw[c]) for c in rest]
    return Design(tuple(Feature(i, n, s, q) for i, (n, s, q) in enumerate(feats)))


@dataclass(frozen=True)
class WideDesign:
    """Fitted encoder whose levels are a written table (column, level, at), of any number.

    Numeric columns take the first places of a vector, levels the places behind them.
    """

    numeric: tuple[tuple[str, str], ...]
    categorical: tuple[str, ...]
    levels: DataFrame
    size: int

    def name_table(self) -> DataFrame:
        """(idx, feature, source_column)"""
        found = self.levels.select("at", F.concat_ws("_", F.lit("cat_"), "column", "level"), "column")
        spark = self.levels.sparkSession
        first = [(i, f"num__{c}", c) for i, (c, _) in enumerate(self.numeric)]
        names = spark.createDataFrame(first, "idx int, feature string, source_column string")
        return names.unionByName(found.toDF("idx", "feature", "source_column"))

    def packed(self, df: DataFrame, id_col: str, out: str = "features") -> DataFrame:
        """``df`` plus the fields of a sparse vector as Spark ML stores it; ``id_col`` must be unique.

        A row meets its levels by join: a small dictionary is broadcast, of a larger one only its
        frequent levels are. Unseen levels and nulls have no entry, numeric nulls are NaN.
        """
        pairs = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("level")) for c in self.categorical]
        long = df.select(F.col(id_col).alias("_key"), F.explode(F.array(*pairs)).alias("p")).select("_key", "p.*").where("level IS NOT NULL")
        hit = join_terms(long, self.levels, ["column", "level"]).groupBy("_key").agg(F.sort_array(F.collect_list("at")).alias("_at"))
        at = F.coalesce("_at", F.array().cast("array<int>"))
        values = [F.coalesce(F.expr(q), F.lit(float("nan"))) for _, q in self.numeric]
        front = F.array(*[F.lit(i) for i in range(len(values))]).cast("array<int>")
        vector = F.struct(
            F.lit(0).cast("byte").alias("type"), F.lit(self.size).cast("int").alias("size"), F.concat(front, at).alias("indices"),
            F.concat(F.array(*values).cast("array<double>"), F.transform(at, lambda _: F.lit(1.0))).alias("values"),
        )
        rows = df.join(hit, F.col(id_col) == F.col("_key"), "left")
        return rows.select(*[F.col(f"`{c}`") for c in df.columns], vector.alias(out))

    def assemble(self, df: DataFrame, id_col: str, out: str = "features") -> DataFrame:
        """``df`` plus sparse vectors, written once."""
        spark = df.sparkSession
        path = fresh_path(spark, "wide-design")
        self.packed(df, id_col, out).write.parquet(path)
        return spark.read.schema(StructType([*df.schema.fields, StructField(out, VectorUDT())])).parquet(path)


def fit_wide_design(
    df: DataFrame, numeric: Sequence[str] = (), categorical: Sequence[str] = (), scale: bool = True, impute: bool = False,
    drop: str | None = None,
) -> WideDesign:
    """Encoder for columns of many levels: no level visits the driver or becomes part of a plan.

    Levels of one column stand together, in hash order. ``drop`` "first" leaves out the smallest
    level of every column, by number and then by text. Rows with a null give no level.
    """
    raw = {c: f"CAST(`{c}` AS DOUBLE)" for c in numeric}
    if impute and numeric:
        raw = {c: f"coalesce({raw[c]}, {m!r}D)" for c, m in fit_medians(df, numeric).items()}
    if scale and numeric:
        clean = df.select(*[F.expr(raw[c]).alias(c) for c in numeric])
        raw = {c: f"(({raw[c]} - {m!r}D) / {s!r}D)" for c, (m, s) in fit_scaler(clean, numeric).items()}
    spark = df.sparkSession
    if not categorical:
        none = spark.createDataFrame([], "column string, level string, at int")
        return WideDesign(tuple((c, raw[c]) for c in numeric), (), none, len(raw))
    found = materialize(level_table(df, categorical), "levels")
    if drop == "first":
        first = found.groupBy("column").agg(F.min(F.struct("number", "level")).alias("_first"))
        found = found.join(F.broadcast(first), "column").where(F.col("level") != F.col("_first.level"))
    ranked = materialize(hash_rank(found.select("column", "level"), "level", "levels", by=["column"], rank="_at"), "level-ranks")
    sizes = {r["column"]: r["count"] for r in ranked.groupBy("column").count().collect()}
    before, start = {}, len(raw)
    for c in categorical:
        before[c] = start
        start += sizes.get(c, 0)
    offset = F.create_map(*[F.lit(v) for pair in before.items() for v in pair])
    levels = ranked.select("column", "level", (F.element_at(offset, F.col("column")) + F.col("_at") - 1).cast("int").alias("at"))
    return WideDesign(tuple((c, raw[c]) for c in numeric), tuple(categorical), materialize(levels, "level-places"), start)


def fit_pipeline(design: Design, estimator, df: DataFrame) -> PipelineModel:
    """Transforms and estimator as one model that can be applied to raw rows anywhere."""
    return Pipeline(stages=[*design.stages(), estimator]).fit(df)


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Balanced weights n / (k * n_c) as a column."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy()
    table = counts.select(
        label, (F.sum("_n").over(whole) / (F.count(F.lit(1)).over(whole) * F.col("_n"))).alias(out)
    )
    return df.join(fitted(table), label)


def bag_count(seed, tree, id_col: str):
    """Bootstrap multiplicity of a row in one tree's bag."""
    return poisson_count(hash_uniform(seed, F.lit(tree) if isinstance(tree, int) else tree, F.col(id_col)))


def bag_weights(
    df: DataFrame, id_col: str, label: str, trees: int, seed="bag", balanced: bool = True
) -> DataFrame:
    """(id, label, tree, bag, weight) for every row and tree.

    The balanced factor is computed inside each bag: n_bag / (k * n_bag_c).
    """
    rows = df.select(id_col, label, F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    rows = rows.withColumn("bag", bag_count(seed, F.col("tree"), id_col))
    if not balanced:
        return rows.withColumn("weight", F.col("bag").cast("double"))
    sums = rows.groupBy("tree", label).agg(F.sum("bag").alias("_c")).where("_c > 0")
    per_tree = Window.partitionBy("tree")
    factor = sums.select(
        "tree", label,
        (F.sum("_c").over(per_tree) / (F.count(F.lit(1)).over(per_tree) * F.col("_c"))).alias("_f"),
    )
    return rows.join(fitted(factor), ["tree", label], "left").select(
        id_col, label, "tree", "bag", (F.col("bag") * F.coalesce("_f", F.lit(0.0))).alias("weight")
    )
