"""Cleaning: columns, sentinels, labels, duplicates, schema checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Roles:
    """What each column of a labelled table is for."""

    id: str
    label: str
    positive: object = 1
    numeric: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    text: tuple[str, ...] = ()
    drop: tuple[str, ...] = ()
    sensitive: tuple[str, ...] = ()

    def declared(self) -> set[str]:
        return {self.id, self.label, *self.numeric, *self.categorical, *self.text, *self.drop}


def drop_columns(df: DataFrame, cols: Sequence[str], missing_ok: bool = False) -> DataFrame:
    absent = [c for c in cols if c not in df.columns]
    if absent and not missing_ok:
        raise ValueError(f"columns not in table: {absent}")
    return df.drop(*cols)


def select_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in cols])


def sentinel_to_null(df: DataFrame, cols: Sequence[str], sentinel=0) -> DataFrame:
    return df.withColumns({c: F.nullif(F.col(f"`{c}`"), F.lit(sentinel)) for c in cols})


def sentinel_flag(df: DataFrame, col: str, sentinel, fill, flag: str, clean: str) -> DataFrame:
    """Sentinel value becomes a 0/1 'was present' flag plus a replaced numeric column."""
    hit = F.col(f"`{col}`") == F.lit(sentinel)
    return df.withColumns(
        {flag: (~hit).cast("int"), clean: F.when(hit, F.lit(fill)).otherwise(F.col(f"`{col}`"))}
    )


def label_binarize(df: DataFrame, col: str, positive, out: str = "y") -> DataFrame:
    return df.withColumn(out, (F.col(col) == F.lit(positive)).cast("int"))


def dedup_rows(df: DataFrame, cols: Sequence[str] | None = None, id_col: str | None = None) -> DataFrame:
    """Remove exact duplicates; with a key subset the smallest id of each key is kept.

    Both forms combine on the map side, so many copies of one row never meet in one task.
    """
    if cols is None:
        return df.dropDuplicates()
    if id_col is None:
        raise ValueError("a key subset needs id_col to decide which row stays")
    # long text travels as its SHA-256, so the shuffle moves 64 bytes per row and key
    string_cols = {f.name for f in df.schema.fields if f.dataType.simpleString() == "string"}
    keys = [
        (F.sha2(F.col(c), 256) if c in string_cols else F.col(c)).alias(f"_k{i}")
        for i, c in enumerate(cols)
    ]
    keep = (
        df.select(*keys, F.col(id_col).alias("_id"))
        .groupBy(*[f"_k{i}" for i in range(len(cols))])
        .agg(F.min("_id").alias(id_col))
        .select(id_col)
    )
    return df.join(keep, id_col, "left_semi")


def dedup_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(rows_before, duplicates_removed, rows_after) in one aggregation."""
    kept = df.groupBy(*[F.col(c) for c in cols]).agg(F.count(F.lit(1)).alias("n"))
    before, after = F.sum("n"), F.count(F.lit(1))
    return kept.agg(
        before.alias("rows_before"), (before - after).alias("duplicates_removed"), after.alias("rows_after")
    )


def check_declared(df: DataFrame, roles: Roles) -> DataFrame:
    """Declared columns must be exactly the columns of the table."""
    declared, actual = roles.declared(), set(df.columns)
    if declared != actual:
        raise ValueError(
            f"undeclared: {sorted(actual - declared)}; missing: {sorted(declared - actual)}"
        )
    return df


def level_guard(df: DataFrame, levels: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows per column whose category is outside the known levels (column, level, rows).

    ``levels`` is (column, level). Values are counted before they are compared, so the
    anti join runs on distinct values only.
    """
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in cols)
    seen = (
        df.select(F.expr(f"stack({len(cols)}, {pairs}) AS (column, level)"))
        .groupBy("column", "level")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return seen.join(levels, ["column", "level"], "left_anti")


def _census(df: DataFrame, tests: Mapping[str, Column], out: str) -> DataFrame:
    wide = df.agg(*[F.coalesce(F.sum(t.cast("long")), F.lit(0)).alias(c) for c, t in tests.items()])
    pairs = ", ".join(f"'{c}', `{c}`" for c in tests)
    return wide.select(F.expr(f"stack({len(tests)}, {pairs}) AS (column, {out})"))


def null_census(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column plus a total row."""
    cols = list(cols or df.columns)
    per_column = _census(df, {c: F.col(f"`{c}`").isNull() for c in cols}, "missing")
    return per_column.unionByName(
        per_column.agg(F.lit("(total)").alias("column"), F.sum("missing").alias("missing"))
    )


def sentinel_census(df: DataFrame, cols: Sequence[str], value) -> DataFrame:
    tests = {c: F.coalesce(F.col(f"`{c}`") == F.lit(value), F.lit(False)) for c in cols}
    return _census(df, tests, "hits")


def filter_rows(df: DataFrame, predicate: Column | str) -> DataFrame:
    return df.where(predicate)


def text_length(df: DataFrame, col: str, out: str = "n_characters") -> DataFrame:
    return df.withColumn(out, F.length(col).cast("long"))


def bin_column(
    df: DataFrame, col: str, edges: Sequence[float], labels: Sequence[str], out: str = "bin"
) -> DataFrame:
    """Right-closed labelled bins (e0, e1], (e1, e2] ...; outside every bin gives null."""
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per interval")
    value, rule = F.col(col), None
    for lo, hi, name in zip(edges, edges[1:], labels):
        test = (value > F.lit(lo)) & (value <= F.lit(hi))
        rule = F.when(test, name) if rule is None else rule.when(test, name)
    return df.withColumn(out, rule)
