"""Many margin machines at once: one pass over the rows serves every cost, fold and feature map.

A machine minimises |w|^2 / 2 + C * sum of weight * loss(1 - s (w z + b)), s = -1 or 1, over the rows
outside its fold. The loss is the hinge with its corner rounded over a width: at most half of
the width below the hinge, and smooth, so that the fit has a gradient that vanishes at its
optimum. The width starts wide and shrinks to ``SOFT`` while the machine follows its optimum by
Newton steps, so a fit takes some tens of passes whatever C is.

A pass computes the margins of a block for all machines of one map as one matrix product,
then gradients and curvatures; feature maps are recomputed inside the pass, so mapped rows
are never written. Sums are merged and the steps solved per machine by Spark; a second pass
evaluates all step lengths at once, as margins are linear in them. The driver keeps only
the parameters. A machine whose gradient has vanished takes no part in later passes. Curvatures
are width x width numbers per machine and block, so maps should have some hundred features.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabwright.operators.linear import FeatureMap
from tabwright.operators.metrics import binary_scores
from tabwright.operators.tune import cv_results
from tabwright.session import materialize

SOFT = 0.05
# widths of the rounded corner on the way to SOFT
WIDTHS = (2.0, 1.0, 0.5, 0.2, 0.1, SOFT)
STEPS = np.array([2.0, 1.5, 1.0, 0.75, *(0.5**j for j in range(1, 15))])
FULL = 1 + STEPS.tolist().index(1.0)
BLOCK = 4096


@dataclass
class Machine:
    """One problem and the state of its optimiser: parameters end with the intercept."""

    space: int
    C: float
    fold: int | None
    w: np.ndarray
    level: int = 0
    damping: float = 1e-9
    passes: int = 0
    converged: bool = False

    @property
    def soft(self) -> float:
        return WIDTHS[self.level]


def _rounded(gap: np.ndarray, soft: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(loss, slope) of the rounded hinge."""
    inside = np.clip(gap / soft, 0.0, 1.0)
    return np.where(gap >= soft, gap - soft / 2, inside * inside * soft / 2), inside


def _spread(rows: DataFrame, spaces: int, block: int) -> DataFrame:
    """(space, x, s, weight, fold): every row once per map, blocks of one map in files of their own.

    A pass sends one curvature per machine and file, so there are no more files than keep all
    cores busy, however many rows they hold.
    """
    n = rows.count()
    files = -(-2 * rows.sparkSession.sparkContext.defaultParallelism // spaces)
    blocks = max(1, min(-(-n // block), files))
    one = rows.withColumn("_b", F.pmod(F.xxhash64(*rows.columns), F.lit(blocks)))
    each = one.withColumn("space", F.explode(F.array(*[F.lit(k) for k in range(spaces)])))
    dealt = each.repartition(min(spaces * blocks, 4096), "space", "_b").drop("_b")
    return materialize(dealt, "spread")


def _blocks(parts: Iterator[pd.DataFrame], spaces: Sequence[FeatureMap], live: list[dict]) -> Iterator[tuple]:
    """Per block and map: its machines, mapped rows with a one behind, signs, weights (rows x machines)."""
    for part in parts:
        for space, own in part.groupby("space"):
            mine = [m for m in live if m["space"] == space]
            if mine:
                z = spaces[space].rows(np.array(own["x"].tolist(), float))
                z = np.concatenate([z, np.ones((len(z), 1))], axis=1)
                sign = np.where(own["y"].to_numpy() == 1, 1.0, -1.0)[:, None]
                folds = np.array([-1 if m["fold"] is None else m["fold"] for m in mine])
                weight = own["weight"].to_numpy()[:, None] * (own["fold"].to_numpy()[:, None] != folds[None, :])
                yield mine, z, sign, weight


def fit_machines(
    rows: DataFrame, spaces: Sequence[FeatureMap], wanted: Sequence[tuple[int, float, int | None]], tol: float = 1e-3, max_rounds: int = 60,
    block: int = BLOCK,
) -> tuple[list[Machine], DataFrame]:
    """Fitted machines for (map number, C, held-out fold or none), and the rows they were fitted on, once per map.

    ``rows`` is (x, y, fold, weight): x an array of doubles, y 0 or 1; further columns are carried. A
    fit ends when the length of its gradient is at most ``tol`` times that of w (1 at least):
    w is then within that distance of the optimum. ``converged`` tells which did. A round is
    two passes over the rows.
    """
    spark = rows.sparkSession
    table = _spread(rows, len(spaces), block)
    read = table.select("space", "x", "y", "fold", "weight")
    width = len(rows.select("x").first()["x"])
    machines = [Machine(s, float(C), fold, np.zeros(spaces[s].width(width) + 1)) for s, C, fold in wanted]

    for _ in range(max_rounds):
        live = [
            {"k": k, "space": m.space, "fold": m.fold, "C": m.C, "soft": m.soft, "damping": m.damping, "w": m.w}
            for k, m in enumerate(machines) if not m.converged
        ]
        if not live:
            break
        shared = spark.sparkContext.broadcast(live)

        def curves(parts: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            sums: dict[int, list] = {}
            for mine, z, sign, weight in _blocks(parts, spaces, shared.value):
                soft = np.array([m["soft"] for m in mine])
                gap = 1.0 - sign * (z @ np.stack([m["w"] for m in mine], axis=1))
                _, inside = _rounded(gap, soft)
                slope = z.T @ (-sign * weight * inside)
                bend = np.where((gap > 0) & (gap < soft), weight / soft, 0.0)
                for c, m in enumerate(mine):
                    use = np.flatnonzero(bend[:, c])
                    held = sums.setdefault(m["k"], [np.zeros((2, z.shape[1])), np.zeros((z.shape[1],) * 2)])
                    held[0][0] += slope[:, c]
                    held[0][1] += weight[:, c] / soft[c] @ (z * z)
                    held[1] += (z[use] * bend[use, c, None]).T @ z[use]
            for k, (slope, bend) in sums.items():
                yield pd.DataFrame({"k": [k], "slope": [slope.tobytes()], "bend": [bend.tobytes()]})

        def solve(part: pd.DataFrame) -> pd.DataFrame:
            m = next(m for m in shared.value if m["k"] == part["k"].iloc[0])  # noqa: B023, run before the next round
            slope, most = sum(np.frombuffer(b).reshape(2, -1) for b in part["slope"])
            bend = sum(np.frombuffer(b) for b in part["bend"]).reshape(len(slope), -1)
            own = np.append(m["w"][:-1], 0.0)
            grad = own + m["C"] * slope
            whole = m["C"] * bend + np.diag(np.append(np.ones(len(own) - 1), 0.0))
            # a share of the curvature that all rows together could have
            whole += m["damping"] * np.diag(1.0 + m["C"] * most)
            step = -np.linalg.solve(whole, grad)
            return pd.DataFrame({"k": [m["k"]], "size": [float(np.sqrt(grad @ grad))], "step": [step.tobytes()]})

        found = read.mapInPandas(curves, "k int, slope binary, bend binary")
        found = {r["k"]: r for r in found.groupBy("k").applyInPandas(solve, "k int, size double, step binary").collect()}
        shared.unpersist()
        moving = []
        for m in live:
            own, r = machines[m["k"]], found.get(m["k"])
            own.passes += 1
            if r is None:  # no rows outside the fold
                own.converged = True
            elif own.level == len(WIDTHS) - 1 and r["size"] <= tol * max(1.0, float(np.sqrt(own.w[:-1] @ own.w[:-1]))):
                own.converged = True
            else:
                moving.append(m | {"step": np.frombuffer(r["step"])})
        if not moving:
            continue
        shared = spark.sparkContext.broadcast(moving)

        def losses(parts: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            sums: dict[int, np.ndarray] = {}
            for mine, z, sign, weight in _blocks(parts, spaces, shared.value):
                soft = np.array([m["soft"] for m in mine])
                gap = 1.0 - sign * (z @ np.stack([m["w"] for m in mine], axis=1))
                turn = -sign * (z @ np.stack([m["step"] for m in mine], axis=1))
                # the point itself, then all step lengths
                each = np.stack([(weight * _rounded(gap + t * turn, soft)[0]).sum(axis=0) for t in (0.0, *STEPS)], axis=1)
                for c, m in enumerate(mine):
                    sums[m["k"]] = sums.get(m["k"], 0.0) + each[c]
            for k, loss in sums.items():
                yield pd.DataFrame({"k": [k], "loss": [loss.tolist()]})

        found = read.mapInPandas(losses, "k int, loss array<double>")
        found = found.groupBy("k").agg(Summarizer.sum(array_to_vector("loss")).alias("loss")).collect()
        by = {m["k"]: m for m in moving}
        for r in found:
            own, step = machines[r["k"]], by[r["k"]]["step"]
            points = [own.w + t * step for t in (0.0, *STEPS)]
            values = [0.5 * p[:-1] @ p[:-1] + own.C * x for p, x in zip(points, r["loss"].toArray(), strict=True)]
            best, last = int(np.argmin(values)), own.level == len(WIDTHS) - 1
            if best:
                own.w, own.damping = points[best], max(own.damping / 10, 1e-10)
                # the path goes on where a step of about full length was right
                own.level += not last and 0.5 <= STEPS[best - 1] <= 1.5
            elif values[FULL] - values[0] <= 1e-11 * abs(values[0]):
                # level at working precision
                own.w, own.level = points[FULL], own.level + (not last)
            else:
                own.damping = max(own.damping * 30, 1e-6)
        shared.unpersist()
    return machines, table


def machine_margins(machines: Sequence[Machine], spaces: Sequence[FeatureMap], table: DataFrame, keep: Mapping[str, str], held_only: bool = True) -> DataFrame:
    """(machine, keep..., margin) for the rows of each machine's held-out fold, or for all rows.

    ``table`` holds rows once per map; ``keep`` names carried columns and their types.
    """
    shared = table.sparkSession.sparkContext.broadcast([(k, m.space, m.fold, m.w) for k, m in enumerate(machines)])
    names = list(keep)

    def score(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for space, own in part.groupby("space"):
                z = None
                for k, s, fold, w in shared.value:
                    if s != space:
                        continue
                    z = spaces[space].rows(np.array(own["x"].tolist(), float)) if z is None else z
                    here = own["fold"].to_numpy() == fold if held_only and fold is not None else np.ones(len(own), bool)
                    if here.any():
                        yield own.loc[here, names].assign(machine=k, margin=z[here] @ w[:-1] + w[-1])[["machine", *names, "margin"]]

    kinds = ", ".join(f"`{c}` {t}" for c, t in keep.items())
    return table.select("space", "x", "fold", *[c for c in names if c not in ("space", "x", "fold")]).mapInPandas(score, f"machine int, {kinds}, margin double")


def machine_grid(
    rows: DataFrame, points: Sequence[tuple[str, str, FeatureMap]], costs: Sequence[float], k: int = 5, scorer: str = "f2", positive=0,
    tol: float = 1e-3, max_rounds: int = 60,
) -> DataFrame:
    """(kernel, gamma, C, mean_score, std_score, folds, converged, rank) over all maps, costs and folds, fitted together.

    ``points`` is (kernel, name of gamma, feature map). ``converged`` holds for a point if all its folds' fits settled.
    """
    spark = rows.sparkSession
    spaces = [m for *_, m in points]
    wanted = [(s, float(C), f) for s in range(len(spaces)) for C in costs for f in range(k)]
    machines, table = fit_machines(rows, spaces, wanted, tol, max_rounds)
    names = spark.createDataFrame(
        [(n, points[m.space][0], points[m.space][1], m.C, m.fold, m.converged) for n, m in enumerate(machines)],
        "machine int, kernel string, gamma string, C double, fold int, ok boolean",
    )
    held = machine_margins(machines, spaces, table, {"y": "int"}).withColumn("pred", (F.col("margin") > 0).cast("int"))
    scores = binary_scores(materialize(held, "held"), "y", "pred", positive, ["machine"], [scorer]).withColumnRenamed(scorer, "score")
    scores = scores.join(F.broadcast(names), "machine")
    settled = names.groupBy("kernel", "gamma", "C").agg(F.min("ok").alias("converged"))
    out = cv_results(scores, ["kernel", "gamma", "C"]).drop("rank").join(settled, ["kernel", "gamma", "C"])
    order = Window.partitionBy().orderBy(F.round("mean_score", 9).desc())
    return out.withColumn("rank", F.rank().over(order).cast("long"))
