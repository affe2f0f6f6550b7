"""Reading and writing labelled tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_CSV = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true"}


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    sep: str = ",",
    encoding: str = "UTF-8",
    multiline: bool = False,
) -> DataFrame:
    """Headered delimited file with a declared schema.

    ``multiline`` is for text with line breaks inside quotes; such files cannot be
    split, so leave it off for large tables without them.
    """
    options = dict(_CSV, sep=sep, encoding=encoding, multiLine=str(multiline).lower())
    return spark.read.schema(schema).options(**options).csv(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", encoding: str = "UTF-8") -> None:
    df.write.options(
        header="true", sep=sep, encoding=encoding, quote='"', escape='"', emptyValue='""',
        ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false",
    ).csv(path)


def read_parquet(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def spread_scan(scan: DataFrame) -> DataFrame:
    """Spread a small file over the cores before row-heavy work (tokenising long texts).

    A table of many files or row groups is returned as it is; only a scan that would leave
    three quarters of the cores idle is redistributed. ``scan`` must be a plain scan.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() * 4 <= cores else scan


def take_columns(df: DataFrame, count: int, names: Sequence[str]) -> DataFrame:
    """Keep the first ``count`` columns by position and rename them."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns[:count]]).toDF(*names)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", order_by: Sequence = ()) -> None:
    """Export a table; ``order_by`` makes the files follow the wanted order."""
    out = df.orderBy(*order_by) if order_by else df
    if fmt == "csv":
        write_csv(out, path)
    else:
        out.write.format(fmt).save(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Long (metric, value) rows as JSON lines."""
    metrics.write.json(path)


def read_metrics(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_rules(rules: DataFrame, path: str, text_col: str = "rule") -> None:
    """One rule per line, in leaf order."""
    rules.orderBy("leaf").select(text_col).write.text(path)
