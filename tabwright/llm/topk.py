"""Exact top-k by inner product with one KD-tree per shard.

A shard's vectors are split at medians of the widest dimension down to leaves with tight
bounding boxes. A query visits leaves in the order of the largest inner product their box
allows, and stops when no box can reach its k-th best score. The k-th score found in the
query's home shard travels with it to the other shards, where search starts from it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tabwright.session import bucket_target, materialize

SHARD_ROWS = 65_536
BLOCK_ROWS = 8_192
LEAF = 256
REACH = 2.0**61


def quantized(vector: Column, scale: int) -> Column:
    """floor(scale * x) per component; null for vectors that are null, or hold null, NaN or infinity.

    Components beyond the root of ``REACH`` / width count as that, so that every score fits into a long.
    """
    fine = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    most = F.floor(F.sqrt(F.lit(REACH) / F.greatest(F.size(vector), F.lit(1)))).cast("double")
    return F.when(fine, F.transform(vector, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, most), -most)).cast("long")))


def kd_leaves(x: np.ndarray, leaf: int = LEAF) -> list[np.ndarray]:
    """Row numbers of the leaves: median splits of the widest dimension until small or all equal."""
    out, todo = [], [np.arange(len(x))]
    while todo:
        rows = todo.pop()
        part = x[rows]
        spread = part.max(axis=0) - part.min(axis=0) if part.shape[1] else np.zeros(1)
        if len(rows) <= leaf or not spread.any():
            out.append(rows)
            continue
        middle = len(rows) // 2
        order = np.argpartition(part[:, spread.argmax()], middle)
        todo += [rows[order[:middle]], rows[order[middle:]]]
    return out


def search(ids: np.ndarray, rows: np.ndarray, x: np.ndarray, query_rows: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int) -> tuple:
    """(query, id, score) of each query's k best rows with a score of at least ``floor``.

    Ties go to smaller ids; a query never meets its own row. ``rows`` are distinct, ``ids`` may repeat.
    """
    order = np.lexsort((rows, ids))
    ids, rows, x = ids[order], rows[order], x[order]
    reach = int(np.abs(x).max(initial=0)) * int(np.abs(q).max(initial=0)) * max(1, x.shape[1])
    kind = np.float32 if reach < 1 << 24 else np.float64 if reach < 1 << 53 else np.int64
    leaves = kd_leaves(x)
    # of equal vectors no more than the k + 1 first rows can be in any answer
    leaves = [np.sort(r)[: k + 1] if len(r) > k + 1 and not (x[r].max(axis=0) - x[r].min(axis=0)).any() else r for r in leaves]
    low = np.stack([x[r].min(axis=0) for r in leaves]).astype(kind)
    high = np.stack([x[r].max(axis=0) for r in leaves]).astype(kind)
    points = [x[r].astype(kind) for r in leaves]
    qk = q.astype(kind)
    bound = (np.maximum(qk, 0) @ high.T + np.minimum(qk, 0) @ low.T).astype(np.int64)
    visit = np.argsort(-bound, axis=1, kind="stable")
    best = Best(len(q), k, len(ids), reach)
    floor = floor.astype(np.int64)
    by_row = np.argsort(rows)
    at = np.minimum(np.searchsorted(rows[by_row], query_rows), len(rows) - 1)
    own = np.where(rows[by_row[at]] == query_rows, by_row[at], -1)
    for turn in range(len(leaves)):
        at = visit[:, turn]
        live = np.flatnonzero(bound[np.arange(len(q)), at] >= np.maximum(best.kth(), floor))
        if not len(live):
            break
        live = live[np.argsort(at[live], kind="stable")]
        cuts = np.flatnonzero(np.diff(at[live])) + 1
        for asked in np.split(live, cuts):
            leaf = at[asked[0]]
            members = leaves[leaf]
            score = (qk[asked] @ points[leaf].T).astype(np.int64)
            lost = (score < floor[asked][:, None]) | (members[None, :] == own[asked][:, None])
            best.add(asked, score, members, lost)
    row, member, score = best.found()
    return row, ids[member], score


class Best:
    """The k best (score, member) of every query: a higher score first, then the smaller member.

    One long holds both where it is wide enough, else they are two arrays.
    """

    LEAST = np.iinfo(np.int64).min

    def __init__(self, queries: int, k: int, members: int, reach: int):
        self.k, self.bits = k, max(1, members.bit_length())
        self.packed = reach < 1 << (62 - self.bits)
        self.mask = (1 << self.bits) - 1
        self.score = np.full((queries, k), self.LEAST, np.int64)
        self.member = None if self.packed else np.zeros((queries, k), np.int64)

    def kth(self) -> np.ndarray:
        """The k-th score of each query, least where there are fewer."""
        last = self.score.min(axis=1)
        return np.where(last == self.LEAST, last, last >> self.bits) if self.packed else last

    def add(self, queries: np.ndarray, score: np.ndarray, members: np.ndarray, lost: np.ndarray) -> None:
        if self.packed:
            score = score << self.bits | (self.mask - members)[None, :]
        score[lost] = self.LEAST
        both = np.concatenate([self.score[queries], score], axis=1)
        if self.packed:
            self.score[queries] = np.partition(both, both.shape[1] - self.k, axis=1)[:, -self.k :]
            return
        held = np.concatenate([self.member[queries], np.broadcast_to(members, score.shape)], axis=1)
        first = np.lexsort((held, -(both + 1)), axis=1)[:, : self.k]
        self.score[queries], self.member[queries] = (np.take_along_axis(v, first, 1) for v in (both, held))

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row, col = np.nonzero(self.score != self.LEAST)
        score = self.score[row, col]
        if self.packed:
            return row, self.mask - (score & self.mask), score >> self.bits
        return row, self.member[row, col], score


def _tile(k: int):
    def run(key, vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(vectors) or not len(queries):
            return pd.DataFrame({"query": [], "query_id": [], "vec_id": [], "score": []}, dtype="int64")
        dim = len(vectors["v"].iloc[0])
        x = np.stack(vectors["v"].to_numpy()) if dim else np.zeros((len(vectors), 0), np.int64)
        q = np.stack(queries["v"].to_numpy()) if dim else np.zeros((len(queries), 0), np.int64)
        row, ids, score = search(
            vectors["id"].to_numpy(), vectors["row"].to_numpy(), x, queries["row"].to_numpy(), q, queries["floor"].to_numpy(np.int64), k
        )
        return pd.DataFrame({
            "query": queries["row"].to_numpy()[row], "query_id": queries["id"].to_numpy()[row], "vec_id": ids, "score": score,
        })

    return run


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the highest integer inner product.

    Rows where ``is_query`` holds are queries; every row but the query's own is a candidate, so
    rows that repeat an id are rows of their own, and a repeated query has an answer each. Rows
    without an id, and vectors that are null, or hold null or non-finite components, take no
    part; ``quantized`` says what counts for components that are too large for a long. Vectors of
    different widths are never compared. Fewer than k candidates give fewer rows; ties go to the smaller id.
    Queries meet shards in blocks, so a task holds one shard and one block.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), quantized(F.col(vector_col), scale).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull())
    # the number that tells rows apart is read back from the written table
    rows = materialize(rows.withColumns({"dim": F.size("v"), "row": F.monotonically_increasing_id()}), "vectors")
    n, width = rows.count(), bucket_target(vectors.sparkSession)
    shards = max(1, -(-n // SHARD_ROWS), min(width, -(-n // 8_192)))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    asked = rows.where("asks")
    asked = asked.withColumn("block", F.pmod(F.xxhash64("row", F.lit(3)), F.lit(max(1, -(-n // BLOCK_ROWS // 8)))).cast("int"))
    schema = "query long, query_id long, vec_id long, score long"
    lowest = F.lit(-(1 << 62)).cast("long")
    home = (
        rows.groupBy("dim", "shard").cogroup(asked.withColumn("floor", lowest).groupBy("dim", "shard")).applyInPandas(_tile(k), schema)
    )
    home = materialize(home, "home")
    kth = home.groupBy("query").agg(F.min("score").alias("s"), F.count(F.lit(1)).alias("n"))
    kth = kth.select(F.col("query").alias("row"), F.when(F.col("n") >= k, F.col("s")).alias("s"))
    told = materialize(asked.join(kth, "row", "left").withColumn("floor", F.coalesce("s", lowest)).drop("s"), "told")
    others = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != F.col("shard"))
    sent = told.withColumn("to", F.explode(others)).select("id", "row", "v", "floor", "dim", "block", F.col("to").alias("shard"))
    blocks = told.select("dim", "block").distinct()
    # own column instances on both sides of the cogroup
    tiles = rows.join(blocks, "dim").select("id", "row", "v", *[(F.col(c) + 0).alias(c) for c in ("dim", "shard", "block")])
    tile = ["dim", "shard", "block"]
    away = tiles.groupBy(*tile).cogroup(sent.groupBy(*tile)).applyInPandas(_tile(k), schema)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    found = home.unionByName(away).withColumn("rank", F.row_number().over(best))
    return found.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

