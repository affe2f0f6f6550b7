"""Sums over pairs of columns, whatever their number."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")


def pair_sums(df: DataFrame, cols: Sequence[str], shift: Sequence[float] | None = None) -> DataFrame:
    """(i, j, n, sx, sy, sxx, syy, sxy) for all i <= j, over the rows where both columns have a value.

    One pass with matrix products inside each task; p * (p + 1) / 2 rows leave a task. A null
    takes no part in any pair of its column; NaN and infinite values count as values and make
    the sums of their column NaN. ``shift`` is subtracted from each column first. An empty
    table gives zero sums.
    """
    p = len(cols)
    centre = np.zeros(p) if shift is None else np.array(shift, dtype=float)
    names = SUMS

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, q, c = np.zeros((4, p, p))
        for batch in batches:
            if not batch.num_rows:
                continue
            there = np.column_stack([x.is_valid().to_numpy(zero_copy_only=False) for x in batch.columns]).astype(float)
            x = np.column_stack([x.fill_null(0.0).to_numpy(zero_copy_only=False) for x in batch.columns])
            x = np.where(there > 0, x - centre, 0.0)
            n += there.T @ there
            s += x.T @ there
            q += (x * x).T @ there
            c += x.T @ x
        i, j = np.triu_indices(p)
        values = (n[i, j], s[i, j], s[j, i], q[i, j], q[j, i], c[i, j])
        arrays = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), *[pa.array(v, pa.float64()) for v in values]]
        yield pa.RecordBatch.from_arrays(arrays, names=["i", "j", *names])

    schema = "i int, j int, " + ", ".join(f"{name} double" for name in SUMS)
    parts = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{k}") for k, c in enumerate(cols)]).mapInArrow(products, schema)
    pairs = df.sparkSession.range(1).select(F.explode(F.sequence(F.lit(0), F.lit(p - 1))).alias("i"))
    pairs = pairs.select("i", F.explode(F.sequence("i", F.lit(p - 1))).alias("j"), *[F.lit(0.0).alias(s) for s in SUMS])
    return parts.unionByName(pairs).groupBy("i", "j").agg(*[F.sum(s).alias(s) for s in SUMS])
