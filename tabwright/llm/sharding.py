"""Histogram sort: splitters are found by counting bytes below candidate keys, then rows move once.

Main path: DataFrame functions only. Rows are sorted by (text hash, id), so equal texts are
neighbours. Each round counts rows and bytes between candidate boundaries in all partitions
and looks closer only into the intervals that still hold a wanted byte position, or more
rows than one task should order.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tabwright.llm.common import scratch_name
from tabwright.session import bucket_target, materialize

SPAN = 1 << 60


@dataclass
class Cell:
    """Keys in [lo, hi) of the text hash, or of the id where ``hash`` is fixed."""

    hash: int | None
    lo: int
    hi: int
    rows: int
    size: int

    @property
    def start(self) -> tuple[int, int]:
        return (self.lo, -(1 << 63)) if self.hash is None else (self.hash, self.lo)


def text_hash(text: Column) -> Column:
    """60 leading bits of the MD5 of the text (null as empty), as a long."""
    return F.conv(F.substring(F.md5(F.coalesce(text, F.lit(""))), 1, 15), 16, 10).cast("long")


def _place(cuts: list[tuple[int, int]], h: Column, i: Column) -> Column:
    """How many sorted cuts (hash, id) are at or below the row's key; two-step search."""
    step = max(2, math.isqrt(len(cuts)))
    pairs = F.array(*[F.struct(F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b")) for a, b in cuts])
    firsts = F.array(
        *[F.struct(F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b")) for a, b in cuts[step - 1 :: step]]
    ) if len(cuts) >= step else None

    def below(c: Column) -> Column:
        return (c["a"] < h) | ((c["a"] == h) & (c["b"] <= i))

    if firsts is None:
        return F.size(F.filter(pairs, below))
    coarse = F.size(F.filter(firsts, below)) * step
    return coarse + F.size(F.filter(F.slice(pairs, coarse + 1, step - 1), below))


def _count(keys: DataFrame, open_cells: list[Cell], probes: int) -> list[list[Cell]]:
    """Rows and bytes between evenly spaced probes inside each open cell: one pass, one small result."""
    order = sorted(range(len(open_cells)), key=lambda j: open_cells[j].start)
    cells = [open_cells[j] for j in order]
    at = _place([c.start for c in cells], F.col("h"), F.col("i")) - 1
    info = F.array(
        *[
            F.struct(
                F.lit(c.hash is None).alias("wide"), F.lit(c.hash if c.hash is not None else 0).cast("long").alias("hash"),
                F.lit(c.lo).cast("long").alias("lo"), F.lit(c.hi - 1).cast("long").alias("top"),
                F.lit(max(1, -(-(c.hi - c.lo) // probes))).cast("decimal(20,0)").alias("step"),
            )
            for c in cells
        ]
    )
    rows = keys.withColumn("at", at).where(F.col("at") >= 0).withColumn("c", F.get(info, F.col("at")))
    value = F.when(F.col("c.wide"), F.col("h")).otherwise(F.col("i"))
    inside = (value >= F.col("c.lo")) & (value <= F.col("c.top")) & (F.col("c.wide") | (F.col("h") == F.col("c.hash")))
    gap = value.cast("decimal(20,0)") - F.col("c.lo").cast("decimal(20,0)")
    rows = rows.where(inside).withColumn("p", F.floor(gap / F.col("c.step")).cast("int"))
    got = rows.groupBy("at", "p").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("size").alias("size"), F.min("h").alias("h0"), F.max("h").alias("h1"),
        F.min("i").alias("i0"), F.max("i").alias("i1"),
    )
    out: list[list[Cell]] = [[] for _ in open_cells]
    for r in sorted(got.collect(), key=lambda r: (r["at"], r["p"])):
        if r["h0"] == r["h1"]:
            cell = Cell(r["h0"], r["i0"], r["i1"] + 1, r["rows"], r["size"])
        else:
            cell = Cell(None, r["h0"], r["h1"] + 1, r["rows"], r["size"])
        out[order[r["at"]]].append(cell)
    return out


def splitters(keys: DataFrame, shards: int, tolerance: float, probes: int = 64) -> tuple[list[Cell], int]:
    """Sorted cells that cover all keys of (h, i, size), and the total size.

    Refined until every cell lies in one shard, is one key, or misses the wanted position
    by at most ``tolerance`` of a shard; and until none holds more than 1/(4P) of the rows
    (unless it is one key). The driver holds counts only: at most ``probes`` per open cell,
    of which there are at most ``shards`` + 4P.
    """
    whole = keys.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("s")).first()
    if not whole["n"]:
        return [], 0
    total = int(whole["s"])
    limit = max(1, whole["n"] // (4 * max(shards, bucket_target(keys.sparkSession))))
    slack = tolerance * total / shards
    cells = [Cell(None, 0, SPAN, whole["n"], total)]
    while True:
        todo, before = [], 0
        for c in cells:
            first, last = before * shards // total, (before + c.size - 1) * shards // total
            miss = min(abs(last * total / shards - before), abs(before + c.size - last * total / shards))
            crossed = first != last and miss > slack and c.rows > 1
            one_key = c.hash is not None and c.hi - c.lo <= 1
            if (crossed or c.rows > limit) and not one_key:
                todo.append(c)
            before += c.size
        if not todo:
            return cells, total
        parts = dict(zip(map(id, todo), _count(keys, todo, probes), strict=True))
        nxt = []
        for c in cells:
            nxt.extend(parts.get(id(c)) or [c])
        cells = nxt


def histogram_shards(
    docs: DataFrame,
    shards: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    tolerance: float = 0.0,
    shard: str = "shard",
    slot: str = "slot",
    size: str = "size",
) -> DataFrame:
    """``docs`` plus size, shard and gapless slot in the shard, in (text hash, id) order.

    Size is the UTF-8 length plus 1 (null text: 1). A row belongs to the shard in which its
    first byte falls when all rows are laid end to end and cut into ``shards`` equal parts
    (with ``tolerance`` 0: exactly), so shards differ by less than the longest row. Equal
    texts are neighbours in the order. A null id sorts first, as the smallest long; rows of
    equal text and id are interchangeable and stay in one shard. An empty table gives an
    empty table; existing columns with the three new names are replaced.
    """
    docs = docs.drop(*({shard, slot, size} & set(docs.columns)))
    h, i, cell, base = (scratch_name(docs, c) for c in ("_h", "_i", "_cell", "_base"))
    lowest = F.lit(-(1 << 63)).cast("long")
    rows = docs.withColumns(
        {
            h: text_hash(F.col(text_col)),
            i: F.coalesce(F.col(id_col).cast("long"), lowest),
            size: (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long"),
        }
    )
    keys = materialize(rows.select(F.col(h).alias("h"), F.col(i).alias("i"), F.col(size).alias("size")), "keys")
    cells, total = splitters(keys, shards, tolerance)
    if not cells:
        return rows.drop(h, i).withColumns({shard: F.lit(0), slot: F.lit(0).cast("long")})
    cells = _merged(cells, shards, total, bucket_target(docs.sparkSession))
    starts, bases, owners, before, seen, owner = [], [], [], 0, {}, 0
    for c in cells:
        owner = max(owner, _shard_of(before, c, shards, total))
        starts.append(c.start)
        owners.append(owner)
        bases.append(seen.get(owner, 0))
        seen[owner] = bases[-1] + c.rows
        before += c.size
    place = _place(starts[1:], F.col(h), F.col(i)) if len(starts) > 1 else F.lit(0)
    found = rows.withColumn(cell, place).withColumns(
        {
            shard: F.get(F.array(*[F.lit(x) for x in owners]), F.col(cell)).cast("int"),
            base: F.get(F.array(*[F.lit(x).cast("long") for x in bases]), F.col(cell)),
        }
    )
    inside = Window.partitionBy(cell).orderBy(h, i)
    return found.withColumn(slot, F.row_number().over(inside).cast("long") - 1 + F.col(base)).drop(h, i, cell, base)


def _shard_of(before: int, c: Cell, shards: int, total: int) -> int:
    """Shard of a cell: of its first byte, or, where tolerance left a cut inside, of its larger part."""
    first, last = before * shards // total, (before + c.size - 1) * shards // total
    if first == last or c.rows == 1 or (c.hash is not None and c.hi - c.lo <= 1):
        return first
    cut = last * total / shards
    return first if abs(before + c.size - cut) <= abs(cut - before) else last


def _merged(cells: list[Cell], shards: int, total: int, width: int) -> list[Cell]:
    """Neighbouring cells of one shard become one, up to the size one task should order.

    A wide cluster keeps more cells than shards need, so that all of its tasks share the
    ordering. A key repeated in more rows than that stays a cell of its own.
    """
    limit = sum(c.rows for c in cells) // max(8 * shards, 2 * width) + 1
    out: list[Cell] = []
    before, owner = 0, -1
    for c in cells:
        mine = max(owner, _shard_of(before, c, shards, total))
        if out and mine == owner and out[-1].rows + c.rows <= limit:
            last = out[-1]
            out[-1] = Cell(last.hash, last.lo, last.hi, last.rows + c.rows, last.size + c.size)
        else:
            out.append(Cell(c.hash, c.lo, c.hi, c.rows, c.size))
        before, owner = before + c.size, mine
    return out
