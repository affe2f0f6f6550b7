"""Shared pieces: white space, row keys, a join that survives hot keys, component labels."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.session import bucket_target, materialize

WHITE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not use yet."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def row_key(id_col: str, text_col: str) -> Column:
    """Two longs that tell rows apart by id and text; equal rows share a key."""
    parts = [F.col(id_col).cast("string"), F.col(text_col)]
    present = [F.col(id_col).isNull(), F.col(text_col).isNull()]
    return F.struct(
        F.xxhash64(F.lit(1), *parts, *present).alias("a"), F.xxhash64(F.lit(2), *parts, *present).alias("b")
    )


def join_spread(rows: DataFrame, keyed: DataFrame, keys: Sequence[str], weight: str) -> DataFrame:
    """Inner join of written ``rows`` with one row per key, where a key may hold a third of all rows.

    ``weight`` is at most the number of ``rows`` with that key. Keys above 1/(4P) of the rows
    are hot; there can be at most 4P of them (P = shuffle partitions), so they are broadcast
    and their rows never meet in one task. All other keys take the ordinary shuffle join.
    """
    limit = rows.count() / (4 * bucket_target(rows.sparkSession))
    hot = keyed.where(F.col(weight) > limit)
    cold = keyed.where(F.col(weight) <= limit)
    near = rows.join(F.broadcast(hot), list(keys))
    far = rows.join(F.broadcast(hot.select(*keys)), list(keys), "left_anti").join(cold, list(keys))
    return near.unionByName(far)


def components(edges: DataFrame, label: str = "links") -> DataFrame:
    """(node, root): smallest node of each connected component, from edges (u, v) of longs.

    Alternates two star steps: every node points its larger neighbours at its smallest one,
    then its smaller ones. Each step is a grouped minimum and a join; a star centre with
    very many leaves goes through ``join_spread``. Each step is written, so a lost executor
    costs one step at most. Ends when the edges (their number and the sum of their hashes)
    stay as they are. Nodes without an edge to another node are not in the result.
    """
    apart = edges.where(F.col("u") != F.col("v"))
    now = materialize(apart.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), label)
    seen = _mark(now)
    while True:
        now = _star(_star(now, larger=True, label=label), larger=False, label=label)
        mark = _mark(now)
        if mark == seen:
            break
        seen = mark
    tips = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return tips.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _mark(edges: DataFrame) -> tuple:
    hashed = F.xxhash64("u", "v").cast("decimal(20,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(hashed)).first())


def _star(edges: DataFrame, larger: bool, label: str) -> DataFrame:
    """One star step over written edges (u > v)."""
    arcs = edges.select(F.col("u").alias("c"), F.col("v").alias("n"))
    if larger:
        arcs = materialize(arcs.unionByName(edges.select(F.col("v").alias("c"), F.col("u").alias("n"))), label)
    least = arcs.groupBy("c").agg(F.min("n").alias("m"), F.count(F.lit(1)).alias("k"))
    least = materialize(least.select("c", F.least("m", "c").alias("m"), "k"), label)
    joined = join_spread(arcs, least, ["c"], "k")
    if larger:
        moved = joined.where(F.col("n") > F.col("c")).select(F.col("n").alias("u"), F.col("m").alias("v"))
    else:
        centres = least.select(F.col("c").alias("u"), F.col("m").alias("v"))
        moved = joined.select(F.col("n").alias("u"), F.col("m").alias("v")).unionByName(centres)
    moved = moved.where(F.col("u") != F.col("v"))
    return materialize(moved.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), label)


def whole_groups(parts: Iterator[pd.DataFrame], keys: Sequence[str]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Batches of a partition sorted by ``keys``, re-cut so that no group is divided, with group borders."""
    held: list[pd.DataFrame] = []

    def borders(frame: pd.DataFrame) -> np.ndarray:
        new = np.zeros(len(frame), bool)
        for k in keys:
            values = frame[k].to_numpy()
            new[1:] |= values[1:] != values[:-1]
        return np.flatnonzero(new)

    for part in parts:
        if not len(part):
            continue
        held.append(part)
        first, last = held[0][list(keys)].iloc[0], part[list(keys)].iloc[-1]
        if (first == last).all():
            continue
        frame = pd.concat(held, ignore_index=True) if len(held) > 1 else part.reset_index(drop=True)
        cut = borders(frame)
        held = [frame.iloc[cut[-1] :]]
        done = frame.iloc[: cut[-1]]
        yield done, np.concatenate([[0], cut[:-1], [len(done)]])
    if held:
        frame = pd.concat(held, ignore_index=True)
        yield frame, np.concatenate([[0], borders(frame), [len(frame)]])
