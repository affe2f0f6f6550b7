"""Saving fitted state so another session can score with it."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Decision:
    """Threshold kept beside a model: score >= threshold means ``positive``."""

    threshold: float
    positive: str
    negative: str


def save_decision(spark: SparkSession, decision: Decision, path: str) -> None:
    one = spark.range(1).select(*[F.lit(v).alias(k) for k, v in asdict(decision).items()])
    one.coalesce(1).write.parquet(path)


def load_decision(spark: SparkSession, path: str) -> Decision:
    row = spark.read.parquet(path).first()
    return Decision(row["threshold"], row["positive"], row["negative"])


def save_pipeline(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_state(state: DataFrame, path: str) -> None:
    state.write.parquet(path)


def load_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
