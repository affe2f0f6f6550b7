"""Corpus pipeline: documents through five stages, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.llm import lines, mixing, ngrams, packing, quality
from tabwright.llm.common import read, row_key, scratch_name
from tabwright.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _recounted(docs: DataFrame) -> DataFrame:
    """Character counts that follow a changed text."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base checks or a certified quality rule go."""
    name = scratch_name(docs, "_quality")
    rows = materialize(quality.with_features(docs, out=name), "features")
    rules = quality.fit_rules(rows, read(spark, sf_dir, "labels"), f=name)
    return rows.where(~quality.base_failed(name) & ~rules.rejects(F.col("lang"), name)).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines shared by many documents go; documents left without any word go with them."""
    lost, count = scratch_name(docs, "_n_dropped"), scratch_name(docs, "_n_lines")
    kept = lines.drop_common_lines(docs, n_lines=count, n_dropped=lost)
    emptied = (F.col(lost) > 0) & (F.btrim("text", F.lit(lines.WHITE)) == "")
    return _recounted(kept.where(~F.coalesce(emptied, F.lit(False))).select(*docs.columns))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest id."""
    a, b = scratch_name(docs, "_a"), scratch_name(docs, "_b")
    found = ngrams.near_duplicates(docs, with_key=True)
    first = found.where(F.col("key") == F.col("class_key")).select(F.col("key.a").alias(a), F.col("key.b").alias(b)).distinct()
    key = row_key("doc_id", "text")
    keyed = docs.withColumns({a: key["a"], b: key["b"]})
    return keyed.join(first, [a, b]).dropDuplicates([a, b]).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The drawn mix as documents: one row per document and epoch, with the words taken."""
    return _recounted(mixing.mixed_documents(docs, mixing.mix_sources(docs)))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of all documents in sequences of 2048 tokens."""
    pieces = packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), 2048, 0, task_words=150_000)
    return packing.pack_best_fit(pieces, 2048).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("ngram_join", near_duplicate_stage),
    ("mix_sources", mixing_stage),
    ("best_fit_packing", packing_stage),
]

# cutoffs, the drawn mix and greedy packing are not expressible in SQL
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
