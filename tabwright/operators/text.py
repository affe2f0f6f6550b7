"""Text to weighted terms in long form: (id, term, value)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import IDF, CountVectorizer, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tabwright.functions.ordering import hash_rank
from tabwright.session import bucket_target, fresh_path, materialize

# Fixed value: a token is a run of two or more letters, digits or underscores.
TOKEN = r"[\p{L}\p{N}_]{2,}"

# A fitted table up to this size is broadcast; of a larger one only the hot terms are.
BROADCAST_BYTES = 64 << 20


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def _run(words: Column, n: int) -> Column:
    """All runs of n neighbouring tokens, joined by one blank."""
    last = F.size(words) - n
    return F.when(
        last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(words, i + 1, n), " "))
    ).otherwise(F.array().cast("array<string>"))


def ngrams(words: str, lo: int = 1, hi: int = 1) -> Column:
    """Runs of lo to hi tokens of a token column.

    Takes the name of a computed column: an expression would be evaluated again per run.
    """
    col = F.col(words)
    parts = [col if n == 1 else _run(col, n) for n in range(lo, hi + 1)]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def tokenize(df: DataFrame, text: str, out: str = "tokens") -> DataFrame:
    return df.withColumn(out, tokens(F.col(text)))


def term_counts(df: DataFrame, id_col: str, text: str, lo: int = 1, hi: int = 1, keep: Sequence[str] = ()) -> DataFrame:
    """Bag of words: (id, keep..., term, tf). Columns of the document in ``keep`` ride along.

    Documents move once, by id; their terms are counted where they are.
    """
    own = [id_col, *keep]
    dealt = df.select(*own, F.col(text).alias("_text")).repartition(id_col)
    terms = dealt.select(*own, tokens(F.col("_text")).alias("_w")).select(
        *own, F.explode(ngrams("_w", lo, hi)).alias("term")
    )
    return terms.groupBy(*own, "term").agg(F.count(F.lit(1)).alias("tf"))


def document_frequency(counts: DataFrame) -> DataFrame:
    return counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def prune_vocab(counts: DataFrame, n_docs: int, min_df: int = 2, max_df: float = 0.9) -> DataFrame:
    """(term, df) of terms in at least min_df documents and at most max_df of all."""
    return document_frequency(counts).where(
        (F.col("df") >= min_df) & (F.col("df") <= F.lit(float(max_df)) * F.lit(float(n_docs)))
    )


def _table_bytes(table: DataFrame) -> int:
    """Size of a per-term table in memory, from its row count and the lengths of its texts."""
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in table.dtypes if kind == "string"]
    row = table.agg(F.count(F.lit(1)).alias("n"), F.sum(sum(texts, F.lit(0))).alias("b")).first()
    return (row["b"] or 0) + row["n"] * (32 + 8 * len(table.columns))


def join_terms(rows: DataFrame, table: DataFrame, keys: Sequence[str] = ("term",), often: str | None = None) -> DataFrame:
    """Inner join of row-level terms to a written per-term table.

    Frequent terms are hot keys. A table measured below BROADCAST_BYTES is broadcast, so no
    row moves. Of a larger one the entries of hot terms are broadcast: those above 1/(4P) of
    all rows (P = shuffle width), hence fewer than 4P; the rows of all other terms meet
    their entry in an ordinary shuffle join. ``often`` names a column of the table that says
    how many rows a term has, so that they need not be counted; it is left out of the result.
    """
    keys = list(keys)
    if _table_bytes(table) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(table.drop(often) if often else table), keys)
    if often:
        counted = table.select(*keys, F.col(often).alias("_n"))
        table = table.drop(often)
    else:
        counted = materialize(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), "term-rows")
    limit = (counted.agg(F.sum("_n")).first()[0] or 0) / (4 * bucket_target(rows.sparkSession))
    hot = counted.where(F.col("_n") > limit).select(*keys)
    near = rows.join(F.broadcast(table.join(F.broadcast(hot), keys, "left_semi")), keys)
    far = rows.join(F.broadcast(hot), keys, "left_anti").join(table, keys)
    return near.unionByName(far)


def fit_idf(train_counts: DataFrame, n_docs: int, min_df: int = 2, max_df: float = 0.9) -> DataFrame:
    """(term, df, idf) with idf = ln((1 + n) / (1 + df)) + 1, written once."""
    vocab = prune_vocab(train_counts, n_docs, min_df, max_df)
    idf = F.log((1.0 + F.lit(float(n_docs))) / (1.0 + F.col("df"))) + 1.0
    return materialize(vocab.withColumn("idf", idf), "idf")


def tfidf(counts: DataFrame, idf: DataFrame, id_col: str = "id", sublinear: bool = True) -> DataFrame:
    """Unit-length tf-idf values (id, term, value); terms outside ``idf`` are ignored."""
    tf = F.col("tf").cast("double")
    weight = (1.0 + F.log(tf)) if sublinear else tf
    keep = [c for c in counts.columns if c not in ("tf",)]
    # narrow rows move by document, before weights widen them
    raw = join_terms(counts, idf.select("term", "idf", F.col("df").alias("_df")), often="_df").repartition(id_col).withColumn(
        "_x", weight * F.col("idf")
    )
    norm = F.sqrt(F.sum(F.col("_x") * F.col("_x")).over(Window.partitionBy(id_col)))
    return raw.select(*keep, (F.col("_x") / norm).alias("value"))


def binarize_presence(values: DataFrame) -> DataFrame:
    """Any positive weight counts as present."""
    return values.where("value > 0").withColumn("value", F.lit(1.0))


def term_vectors(docs: DataFrame, values: DataFrame, vocab: DataFrame, id_col: str = "id", out: str = "features") -> DataFrame:
    """``docs`` plus sparse vectors of their (id, term, value) rows, written once.

    Terms are numbered by their rank in a hash order of ``vocab``, found without gathering it:
    the vocabulary never visits the driver. Documents without a known term get an empty
    vector. Only the optimiser's coefficients, one number per term, are kept whole.
    """
    spark = docs.sparkSession
    numbers = materialize(hash_rank(vocab.select("term"), "term", "vocabulary", rank="_at"), "term-numbers")
    cells = join_terms(values.select(id_col, "term", "value"), numbers).groupBy(id_col).agg(
        F.sort_array(F.collect_list(F.struct((F.col("_at") - 1).cast("int").alias("at"), "value"))).alias("_c")
    )
    rows = docs.join(cells, id_col, "left")
    # the fields of a sparse vector as Spark ML stores it
    vector = F.struct(
        F.lit(0).cast("byte").alias("type"), F.lit(vocab.count()).cast("int").alias("size"),
        F.coalesce(F.col("_c.at"), F.array().cast("array<int>")).alias("indices"),
        F.coalesce(F.col("_c.value"), F.array().cast("array<double>")).alias("values"),
    )
    path = fresh_path(spark, "term-vectors")
    rows.select(*docs.columns, vector.alias(out)).write.parquet(path)
    schema = StructType([*docs.schema.fields, StructField(out, VectorUDT())])
    return spark.read.schema(schema).parquet(path)


def fit_tfidf_vectors(train: DataFrame, terms: str, min_df: int = 2, max_df: float = 0.9, out: str = "features") -> PipelineModel:
    """The same weights as sparse vectors, for optimisers that keep one coefficient per term.

    Such an optimiser holds a dense vector of vocabulary size on the driver anyway, so the
    vocabulary may too; it is sized from the data, never truncated.
    """
    distinct = train.select(F.explode(F.array_distinct(F.col(terms))).alias("term"))
    size = distinct.groupBy("term").count().where(F.col("count") >= min_df).count()
    counter = CountVectorizer(inputCol=terms, outputCol="_tf", minDF=min_df, maxDF=max_df, vocabSize=max(size, 1))
    counts = counter.fit(train)
    idf = IDF(inputCol="_tf", outputCol="_idf").fit(counts.transform(train))
    plus_one = Vectors.dense(idf.idf.toArray() + 1.0)
    scale = ElementwiseProduct(scalingVec=plus_one, inputCol="_tf", outputCol="_w")
    return PipelineModel([counts, scale, Normalizer(p=2.0, inputCol="_w", outputCol=out)])
