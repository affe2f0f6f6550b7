"""k nearest neighbours: exact by streamed blocks, approximate by hashing or by cells.

A task holds one block of query rows and streams training rows past it, keeping the k best
of each query so far. It emits k rows per query row for a whole strip of training blocks,
never the pairs it compares, so the volume that leaves a task is (query rows) x k. Pairs are
compared by rough values first, in tiles that fit a core's cache; those that may come among
the k best, by a bound with a margin above the rounding, get their distance in double precision.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.functions.ordering import exact_quantiles
from tabwright.session import SMALL_ROWS, bucket_target, fitted, materialize

BLOCK = 4096
# blocks of training rows that one task compares at most
STRIP = 64
METRICS = ("euclidean", "manhattan")
# pairs that make a task of its own worth while, and how many tasks there may be for each partition of a shuffle
_WORK, _WAVES = 1 << 28, 8
# numbers held at once while distances of near pairs are computed
_CELLS = 2_000_000


def _tile_plan(q: DataFrame, t: DataFrame, width: int, k: int) -> DataFrame:
    """(space, nq, nt, pairs): query blocks and training strips per space, and what they compare; a crowded space gets more.

    Every training row is sent once per query block, so where vectors and k are small enough a
    query block holds up to 4 * BLOCK rows. Strips hold up to STRIP blocks. Where more tiles are
    needed to use ``width`` tasks (several times that, if each still has _WORK pairs), query
    blocks get smaller down to BLOCK, then strips, then query blocks again.
    """
    sizes = fitted(
        q.groupBy("space").agg(F.count(F.lit(1)).alias("_q")).join(
            t.groupBy("space").agg(F.count(F.lit(1)).alias("_t"), F.max(F.size("tx")).alias("_w")), "space"
        )
    )
    spaces, pairs = sizes.agg(F.count(F.lit(1)), F.sum(F.col("_q") * F.col("_t").cast("double"))).first()
    tiles = math.ceil(max(width, min(_WAVES * width, (pairs or 0) / _WORK)) / max(1, spaces))
    most = min(4 * BLOCK, 128 * BLOCK // max(1, k))
    wide = F.greatest(F.lit(BLOCK), F.least(F.lit(most), F.floor(256 * BLOCK / F.greatest(F.col("_w"), F.lit(1)))))
    strips, blocks = F.ceil(F.col("_t") / (BLOCK * STRIP)), F.ceil(F.col("_t") / BLOCK)
    nq = F.greatest(F.ceil(F.col("_q") / wide), F.least(F.ceil(F.col("_q") / BLOCK), F.ceil(F.lit(tiles) / strips)))
    nt = F.greatest(strips, F.least(blocks, F.ceil(F.lit(tiles) / nq)))
    spread = F.least(F.col("_q"), F.ceil(F.lit(tiles) / nt))
    return sizes.select(
        "space", F.greatest(nq, spread).cast("long").alias("nq"), nt.cast("long").alias("nt"),
        (F.col("_q") * F.col("_t").cast("double")).alias("pairs"),
    )


def _dealt(plan: DataFrame, width: int) -> tuple[DataFrame | None, int]:
    """(space, qb, tb, part) of every tile, and the number of parts; equal work for all parts.

    Tiles are few and heavy, so by hash some parts would get several and others none. The
    largest come first, each into the part with the least work. None if there are more than
    SMALL_ROWS: so many are even enough by hash.
    """
    tasks, pairs = plan.agg(F.sum(F.col("nq") * F.col("nt")), F.sum("pairs")).first()
    tasks, pairs = tasks or 1, pairs or 0
    parts = min(tasks, max(4 * width, math.ceil(pairs / _WORK)))
    if tasks > SMALL_ROWS:
        return None, max(parts, math.ceil(tasks / 64))
    tiles = [
        (r["pairs"] / (r["nq"] * r["nt"]), r["space"], qb, tb)
        for r in plan.collect() for qb in range(r["nq"]) for tb in range(r["nt"])
    ]
    held, rows = [(0.0, part) for part in range(parts)], []
    for work, *tile in sorted(tiles, reverse=True):
        load, part = heapq.heappop(held)
        heapq.heappush(held, (load + work, part))
        rows.append((*tile, part))
    return plan.sparkSession.createDataFrame(rows, "space long, qb long, tb long, part int"), parts


# one row per query and neighbour of a tile; numbers only, the metric is its position in the list
_TILE = {"metric": "int32", "space": "int64", "query": "int64", "neighbor": "int64", "y": "int64", "distance": "float64"}


def _strip_function(metrics: Sequence[str], k: int):
    """The work of a task over rows sorted by tile, queries before training rows, then by id.

    Self-contained, so executors need numpy and pandas only.
    """
    types, cells, lines, columns, most_rows = dict(_TILE), _CELLS, 64, 2048, 16384

    def grid(x: np.ndarray) -> dict:
        """Where the rough values of a query block lie: its middle, and a grid of whole steps over the bulk of each column."""
        x = x[np.isfinite(x).all(axis=1)]
        if not len(x):
            x = np.zeros((1, x.shape[1]))
        whole = np.int16 if x.shape[1] <= 512 else np.int32
        most = np.iinfo(whole).max // max(1, x.shape[1])
        with np.errstate(over="ignore", invalid="ignore"):
            low, high = np.quantile(x, [0.005, 0.995], axis=0)
            step = float(np.max(high - low, initial=0.0)) / most
            return {"middle": x.mean(axis=0), "low": low, "step": step if 0 < step < np.inf else 1.0, "most": most, "whole": whole}

    def rough(x: np.ndarray, of: dict) -> dict:
        """Rows in single precision with their squares, and as whole steps (cut to the grid, which only brings rows nearer)."""
        with np.errstate(over="ignore", invalid="ignore"):
            near = x - of["middle"]
            safe = not len(x) or bool(np.nanmax(np.abs(near), initial=0.0) < 1e15)
            near = near.astype(np.float32)
            square = np.einsum("ij,ij->i", near, near, dtype=float)
            at = np.nan_to_num(np.rint(np.clip((x - of["low"]) / of["step"], 0, of["most"]))).astype(of["whole"])
        return {"x": near, "turned": np.ascontiguousarray(-2 * near.T), "square": square, "safe": safe, "at": at, "at_turned": np.ascontiguousarray(at.T)}

    def near(q: dict, part: slice, t: dict, use: slice, limit: np.ndarray, metric: str, of: dict, out: np.ndarray) -> None:
        """Marks pairs whose distance may be below ``limit``: a bound from rough values, with a margin above their rounding."""
        width, size = q["x"].shape[1], out.shape
        if metric == "euclidean":
            if not (q["safe"] and t["safe"]):
                out[:] = True
                return
            lost = (width + 16) * 2.0**-22
            low = q["x"][part] @ t["turned"][:, use]
            low += (t["square"][use] * (1 - lost)).astype(np.float32)
            reach = limit * limit * (1 + 1e-6) + 1e-30 - q["square"][part] * (1 - lost)
            np.less_equal(low, reach.astype(np.float32)[:, None], out=out)
            return
        rows, most = q["at"][part], np.iinfo(of["whole"]).max
        low, gap = np.zeros(size, of["whole"]), np.empty(size, of["whole"])
        for j in range(width):
            np.subtract(rows[:, j, None], t["at_turned"][j, use], out=gap)
            np.abs(gap, out=gap)
            low += gap
        # a value is half a step off at most
        reach = np.minimum(limit / of["step"] * (1 + 1e-6) + width + 1, most)
        np.less_equal(low, reach.astype(of["whole"])[:, None], out=out)

    def marked(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and columns of the few marks, looked for in words of eight."""
        words = np.flatnonzero(found.view(np.uint64).ravel())
        which, byte = np.nonzero(found.reshape(-1, 8)[words])
        return np.divmod(words[which] * 8 + byte, found.shape[1])

    def nearer(q: np.ndarray, best: dict, t: np.ndarray, tid: np.ndarray, y: np.ndarray, metric: str, q_rough: dict, t_rough: dict, of: dict) -> None:
        """Merge training rows into the k best of every query row."""
        step = max(1, cells // max(1, q.shape[1]))
        all_marks = np.zeros((lines, -(-len(t) // 8) * 8), bool)
        for lo in range(0, len(q), lines):
            part = slice(lo, lo + lines)
            limit = best["distance"][part, -1]
            marks = all_marks[: len(limit)]
            for c in range(0, len(t), columns):
                use = slice(c, min(c + columns, len(t)))
                near(q_rough, part, t_rough, use, limit, metric, of, marks[:, use])
            rows, use = marked(marks)
            parts = []
            for at in range(0, len(rows), step):
                piece = slice(at, at + step)
                diff = q[rows[piece] + lo] - t[use[piece]]
                parts.append(np.sqrt((diff * diff).sum(axis=1)) if metric == "euclidean" else np.abs(diff).sum(axis=1))
            if not parts:
                continue
            # training rows come by ascending id, so a tie with the k-th loses and a stable sort orders ties
            dist = np.concatenate(parts)
            hit = np.flatnonzero(dist < limit[rows])
            if not len(hit):
                continue
            rows, use, dist = rows[hit], use[hit], dist[hit]
            at, first = np.unique(rows, return_index=True)
            every = np.concatenate([best["distance"][at + lo].ravel(), dist])
            owner = np.concatenate([np.repeat(at, k), rows])
            order = np.lexsort((every, owner))
            start = np.arange(len(at)) * k + first
            order = order[start[:, None] + np.arange(k)]
            best["distance"][at + lo] = every[order]
            for name, values in (("neighbor", tid), ("y", y)):
                both = np.concatenate([best[name][at + lo].ravel(), values[use]])
                best[name][at + lo] = both[order]

    def found(space: int, ids: np.ndarray, state: list[dict]) -> pd.DataFrame:
        parts: dict[str, list] = {c: [] for c in types}
        for number, best in enumerate(state):
            full = np.isfinite(best["distance"])
            n = int(full.sum())
            parts["metric"].append(np.full(n, number))
            parts["space"].append(np.full(n, space))
            parts["query"].append(np.repeat(ids, full.sum(axis=1)))
            for name in ("neighbor", "y", "distance"):
                parts[name].append(best[name][full])
        return pd.DataFrame({c: np.concatenate(v).astype(types[c]) for c, v in parts.items()})

    def strips(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tile, ids, x, state, seen = None, [], [], None, 0
        for batch in batches:
            keys = batch[["space", "qb", "tb", "side"]].to_numpy()
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(batch)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if lo == hi:
                    continue
                key, rows = tuple(keys[lo, :3]), batch.iloc[lo:hi]
                if key != tile:
                    if state:
                        yield found(tile[0], ids, state)
                    tile, ids, x, state, seen = key, [], [], None, 0
                values = np.array(rows["x"].tolist(), dtype=float)
                if keys[lo, 3] == 0:
                    ids.append(rows["id"].to_numpy())
                    x.append(values)
                    continue
                if not len(ids):
                    continue  # a strip that met no query
                if state is None:
                    ids, x = np.concatenate(ids), np.concatenate(x)
                    of = grid(x)
                    q_rough = rough(x, of)
                    size = (len(ids), k)
                    state = [
                        {"distance": np.full(size, np.inf), "neighbor": np.zeros(size, np.int64), "y": np.zeros(size, np.int64)}
                        for _ in metrics
                    ]
                tid, y = rows["id"].to_numpy(), rows["y"].to_numpy().astype(np.int64)
                at = 0
                while at < len(tid):
                    # few rows at first: they set the limits that later ones must undercut
                    part = slice(at, at + min(most_rows, max(64, k, seen)))
                    t_rough = rough(values[part], of)
                    for best, metric in zip(state, metrics, strict=True):
                        nearer(x, best, values[part], tid[part], y[part], metric, q_rough, t_rough, of)
                    seen += part.stop - part.start
                    at = part.stop
        if state:
            yield found(tile[0], ids, state)

    return strips


def knn_neighbors(
    train: DataFrame, query: DataFrame, k: int, metrics: Sequence[str] = ("euclidean",), space: str | None = None
) -> DataFrame:
    """(metric, [space], query, rank, neighbor, y, distance) of the k nearest training rows.

    ``train`` is (id, x, y), ``query`` (id, x); x is array<double>. With ``space`` both
    carry that integral column and only rows of one space are compared (one space per fold).
    Neighbours are ordered by (distance, id). Ids are whole numbers; rows whose distance is no
    finite number are not neighbours.
    """
    key = F.lit(0) if space is None else F.col(space)
    q = query.select(key.cast("long").alias("space"), "id", "x")
    t = train.select(
        key.cast("long").alias("space"), F.col("id").alias("tid"), F.col("x").alias("tx"), F.col("y").cast("long").alias("y")
    )
    # of equal vectors only the k smallest ids can be neighbours: many copies cost as much as k
    t = t.withColumn("_c", F.row_number().over(Window.partitionBy("space", "tx").orderBy("tid"))).where(
        F.col("_c") <= k
    ).drop("_c")
    t = materialize(t, "train")
    width = bucket_target(train.sparkSession)
    plan = _tile_plan(q, t, width, k)
    tile = ["space", "qb", "tb"]
    # a fixed number of partitions: strips are small in bytes but heavy in work, so they must
    # not be merged by size
    dealt, parts = _dealt(plan, width)

    def placed(rows: DataFrame, own: str, other: str, count: str) -> DataFrame:
        if dealt is not None:
            return rows.join(F.broadcast(dealt), ["space", own])
        every = rows.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1)))
        return every.withColumn("part", F.pmod(F.xxhash64(*tile), F.lit(parts)).cast("int"))

    q_tiles = placed(q.join(plan, "space").withColumn("qb", F.pmod(F.xxhash64("id"), F.col("nq"))), "qb", "tb", "nt")
    t_tiles = placed(t.join(plan, "space").withColumn("tb", F.pmod(F.xxhash64("tid"), F.col("nt"))), "tb", "qb", "nq")
    both = q_tiles.select(*tile, "part", F.lit(0).alias("side"), "id", "x", F.lit(0).cast("long").alias("y")).unionByName(
        t_tiles.select(*tile, "part", F.lit(1).alias("side"), F.col("tid").alias("id"), F.col("tx").alias("x"), "y")
    )
    found = (
        both.repartitionById(parts, "part").drop("part")
        .sortWithinPartitions(*tile, "side", "id")
        .mapInPandas(
            _strip_function(tuple(metrics), k),
            "metric int, space long, query long, neighbor long, y long, distance double",
        )
    )
    nearest = Window.partitionBy("metric", "space", "query").orderBy("distance", "neighbor")
    found = found.withColumn("metric", F.array(*[F.lit(m) for m in metrics])[F.col("metric")])
    ranked = found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
    return ranked.drop("space") if space is None else ranked.withColumnRenamed("space", space)


def knn_votes(neighbors: DataFrame, classes: Sequence, keys: Sequence[str] = ("metric", "query")) -> DataFrame:
    """Running votes by rank for both weightings: one row per (keys, weights, rank) with v0, v1, ...

    Row k holds the votes of the k nearest, so one table answers every k of a search.
    With any zero distance only the zero distances vote.
    """
    by = Window.partitionBy(*keys).orderBy("rank")
    running = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.first("distance").over(running)
    near = F.when(first == 0.0, (F.col("distance") == 0.0).cast("double")).otherwise(1.0 / F.col("distance"))
    both = F.array(
        F.struct(F.lit("uniform").alias("weights"), F.lit(1.0).alias("w")),
        F.struct(F.lit("distance").alias("weights"), near.alias("w")),
    )
    weighted = neighbors.withColumn("_b", both).select("*", F.explode("_b").alias("_e")).select(
        *keys, "rank", "y", F.col("_e.weights").alias("weights"), F.col("_e.w").alias("_w")
    )
    upto = Window.partitionBy(*keys, "weights").orderBy("rank").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    votes = [F.sum(F.when(F.col("y") == F.lit(c), F.col("_w")).otherwise(0.0)).over(upto).alias(f"v{i}") for i, c in enumerate(classes)]
    return weighted.select(*keys, "weights", "rank", *votes)


def knn_predict(
    neighbors: DataFrame, classes: Sequence, ks: Sequence[int], keys: Sequence[str] = ("metric", "query"), positive=1
) -> DataFrame:
    """(keys, weights, k, pred, score) for every k asked; vote ties go to the smallest class.

    A query with fewer than k training rows keeps the votes of all of them.
    """
    votes = knn_votes(neighbors, classes, keys)
    votes = votes.withColumn("_last", F.max("rank").over(Window.partitionBy(*keys, "weights")))
    wanted = F.array(*[F.lit(int(k)) for k in ks])
    votes = votes.withColumn(
        "k", F.explode(F.filter(wanted, lambda k: F.least(k, F.col("_last")) == F.col("rank")))
    )
    cols = [F.col(f"v{i}") for i in range(len(classes))]
    total = cols[0]
    best, top = F.lit(classes[0]), cols[0]
    for c, v in zip(classes[1:], cols[1:]):
        total = total + v
        best = F.when(v > top, F.lit(c)).otherwise(best)
        top = F.greatest(top, v)
    return votes.select(
        *keys, "weights", "k", best.alias("pred"), (cols[list(classes).index(positive)] / total).alias("score")
    )


def _per_space(state: Mapping[int, Sequence[float]], space: str | None) -> Column:
    """The fitted array that belongs to a row's space."""
    cells = F.array(
        *[F.struct(F.lit(k).alias("k"), F.array(*[F.lit(float(v)) for v in vs]).alias("v")) for k, vs in state.items()]
    )
    key = F.col(space) if space else F.lit(0)
    return F.filter(cells, lambda r: r["k"] == key)[0]["v"]


def impute_arrays(fit_df: DataFrame, df: DataFrame, x: str = "x", space: str | None = None) -> DataFrame:
    """Fill nulls of an array column with the exact medians of ``fit_df`` by position (and space)."""
    keys = [space] if space else []
    entries = fit_df.select(*keys, F.posexplode(x).alias("at", "v"))
    state: dict[int, dict[int, float]] = {}
    for r in exact_quantiles(entries, ["v"], [0.5], [*keys, "at"]).collect():
        state.setdefault(r[space] if space else 0, {})[r["at"]] = r["value"]
    fill = _per_space({k: [m[i] for i in sorted(m)] for k, m in state.items()}, space)
    return df.withColumn(x, F.zip_with(F.col(x), fill, lambda a, b: F.coalesce(a, b)))


def scale_arrays(fit_df: DataFrame, df: DataFrame, x: str = "x", space: str | None = None) -> DataFrame:
    """Standardise an array column by position with the mean and population std of ``fit_df``.

    With ``space`` the state is fitted and applied per space.
    """
    keys = [space] if space else []
    dims = fit_df.select(F.size(x)).first()[0]
    sums = []
    for i in range(dims):
        sums += [F.avg(F.col(x)[i]).alias(f"m{i}"), F.stddev_pop(F.col(x)[i]).alias(f"s{i}")]
    means, stds = {}, {}
    for r in fit_df.groupBy(*keys).agg(*sums).collect():
        key = r[space] if space else 0
        means[key] = [r[f"m{i}"] for i in range(dims)]
        stds[key] = [r[f"s{i}"] or 1.0 for i in range(dims)]
    centred = F.zip_with(F.col(x), _per_space(means, space), lambda a, b: a - b)
    return df.withColumn(x, F.zip_with(centred, _per_space(stds, space), lambda a, b: a / b))


def knn_grid_predictions(
    rows: DataFrame, ks: Sequence[int], fold: str = "fold", k_folds: int = 5,
    metrics: Sequence[str] = METRICS, classes: Sequence = (0, 1), scale: bool = True, impute: bool = False,
) -> DataFrame:
    """(metric, weights, k, fold, y, pred) of every grid point from one neighbour table.

    ``rows`` is (id, x, y, fold). Each fold is a space: its rows are the queries, all other
    rows its training set; medians, means and deviations come from that training set only.
    """
    spaced = rows.withColumn("space", F.explode(F.sequence(F.lit(0), F.lit(k_folds - 1))))
    held = F.col(fold) == F.col("space")
    if impute:
        spaced = materialize(impute_arrays(spaced.where(~held), spaced, "x", "space"), "imputed")
    if scale:
        spaced = scale_arrays(spaced.where(~held), spaced, "x", "space")
    train, query = spaced.where(~held), spaced.where(held)
    near = materialize(knn_neighbors(train, query, max(ks), metrics, "space"), "neighbors")
    pred = knn_predict(near, classes, ks, ("metric", "space", "query"))
    truth = rows.select(F.col("id").alias("query"), "y")
    return pred.join(truth, "query").withColumnRenamed("space", fold)


def knn_approx(
    train: DataFrame, query: DataFrame, k: int, bucket_length: float, tables: int = 8, seed: int = 7,
    metric: str = "euclidean",
) -> DataFrame:
    """Neighbours found through random-projection buckets: rows sharing a bucket are compared.

    Cost follows bucket sizes instead of (query rows) x (training rows); missed neighbours are
    the price. A bucket is a space of the tiled search, so a crowded one is cut into bounded
    tiles and still emits k rows per query, not its pairs.
    """
    lsh = BucketedRandomProjectionLSH(
        inputCol="_v", outputCol="_h", bucketLength=bucket_length, numHashTables=tables, seed=seed
    )
    t = train.select("id", "x", "y", array_to_vector("x").alias("_v"))
    q = query.select("id", "x", array_to_vector("x").alias("_v"))
    model = lsh.fit(t)

    def bucketed(df: DataFrame) -> DataFrame:
        hashed = model.transform(df).drop("_v")
        return hashed.select("*", F.posexplode("_h").alias("_table", "_bucket")).withColumn(
            "space", F.xxhash64("_table", vector_to_array("_bucket")[0])
        ).drop("_h", "_table", "_bucket")

    found = knn_neighbors(bucketed(t), bucketed(q), k, [metric], "space")
    once = found.groupBy("query", "neighbor").agg(F.min("distance").alias("distance"), F.min("y").alias("y"))
    nearest = Window.partitionBy("query").orderBy("distance", "neighbor")
    return once.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)


def neighbor_recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of exact neighbours that the approximate search also returned."""
    hits = exact.select("query", "neighbor").join(
        found.select("query", "neighbor", F.lit(1).alias("_hit")), ["query", "neighbor"], "left"
    )
    return hits.agg(F.avg(F.coalesce("_hit", F.lit(0)).cast("double")).alias("recall"))


def _cell_numbers(pivots: np.ndarray, n: int):
    """The ``n`` nearest pivots of each vector, nearest first; ties go to the smaller number."""

    @F.pandas_udf("array<long>")
    def numbers(x: pd.Series) -> pd.Series:
        out = []
        for lo in range(0, len(x), 4096):
            m = np.array(x.iloc[lo : lo + 4096].tolist(), dtype=float).reshape(-1, pivots.shape[1])
            far = (pivots * pivots).sum(axis=1) - 2.0 * (m @ pivots.T)
            out += list(np.argsort(far, axis=1, kind="stable")[:, :n])
        return pd.Series(out)

    return numbers


def _pivots(train: DataFrame, cells: int, seed: int) -> np.ndarray:
    drawn = train.select("x").distinct().orderBy(F.xxhash64(F.col("x").cast("string"), F.lit(seed)), "x").limit(cells)
    return np.array([r["x"] for r in drawn.collect()], dtype=float)


def knn_cells(
    train: DataFrame, query: DataFrame, k: int, cells: int = 64, probes: int = 24, metric: str = "euclidean", seed: int = 7,
) -> DataFrame:
    """Neighbours found in the ``probes`` cells nearest to a query, out of ``cells``.

    Pivots are that many distinct training vectors, first in hash order: the only thing the
    driver gets. Every training row belongs to the cell of its nearest pivot, so no pair is
    compared twice and the work stays below that of the exact search, whatever the data;
    ``cell_cost`` measures it. A cell is a space of the exact search, so a crowded one is cut.
    Unlike buckets of projections this needs no bucket length. (query, rank, neighbor, y, distance).
    """
    pivots = _pivots(train, cells, seed)
    if not len(pivots):
        return knn_neighbors(train, query, k, [metric]).drop("metric")
    t, q = _in_cells(train, query, pivots, probes)
    found = knn_neighbors(t, q, k, [metric], "space")
    nearest = Window.partitionBy("query").orderBy("distance", "neighbor")
    ranked = found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
    return ranked.select("query", "rank", "neighbor", "y", "distance")


def _in_cells(train: DataFrame, query: DataFrame, pivots: np.ndarray, probes: int) -> tuple[DataFrame, DataFrame]:
    t = train.select("id", "x", "y", _cell_numbers(pivots, 1)("x")[0].alias("space"))
    q = query.select("id", "x", F.explode(_cell_numbers(pivots, probes)("x")).alias("space"))
    return materialize(t, "train-cells"), materialize(q, "query-cells")


def cell_cost(train: DataFrame, query: DataFrame, cells: int = 64, probes: int = 24, seed: int = 7) -> DataFrame:
    """Share of all (query, training row) pairs that ``knn_cells`` compares: (compared_share)."""
    pivots = _pivots(train, cells, seed)
    t, q = _in_cells(train, query, pivots, probes)
    held = t.groupBy("space").agg(F.count(F.lit(1)).alias("_t")).join(q.groupBy("space").agg(F.count(F.lit(1)).alias("_q")), "space")
    return held.agg((F.sum(F.col("_t") * F.col("_q")) / F.lit(float(train.count()) * query.count())).alias("compared_share"))
