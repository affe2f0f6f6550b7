"""Mixing sources to target weights by blocks of nearly one length.

Documents of a source are laid end to end and cut into the fewest blocks of at most a fixed
number of words, equal up to one word. As many blocks are drawn as the target needs; of the
last one only the words still missing are taken, so small sources come near their target too.
Each output shard draws how many of its slots go to each source (multinomial); a slot's
number within its source is mapped through a pseudorandom permutation of the source's
blocks, and slots meet blocks by (source, block index). Nothing but one row per source and
one count per (shard, source) reaches the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql import types as T

from tabwright.llm.common import WHITE, WORD, join_spread, scratch_name
from tabwright.session import bucket_target, materialize

CHUNK = 4096


def word_count(text: Column) -> Column:
    """Words separated by ASCII white space; null has none."""
    trimmed = F.btrim(text, F.lit(WHITE))
    words = F.regexp_count(trimmed, F.lit(r"[\x20\x09-\x0D]+")) + 1
    return F.when(F.coalesce(F.length(trimmed), F.lit(0)) == 0, F.lit(0)).otherwise(words).cast("long")


def fill_targets(sizes: Sequence[int], weights: Sequence[float], share: float, most: float) -> list[float]:
    """Targets by weight that sum to ``share`` of all sizes, none above ``most`` times its source.

    The excess of capped sources is dealt again by weight among the others until none is above.
    """
    total = share * float(sum(sizes))
    caps = [most * float(z) for z in sizes]
    target = [0.0] * len(sizes)
    open_, left = set(range(len(sizes))), total
    while open_:
        unit = left / sum(weights[s] for s in open_)
        over = [s for s in sorted(open_) if unit * weights[s] >= caps[s]]
        if not over:
            for s in open_:
                target[s] = unit * weights[s]
            break
        for s in over:
            target[s] = caps[s]
            left -= caps[s]
            open_.remove(s)
    return target


def slots_wanted(size: int, target: float, blocks: int, most: float) -> tuple[int, int]:
    """Slots that reach ``target`` words of a source, and the words taken from the last of them."""
    words = min(round(target), int(most) * size)
    if not words:
        return 0, 0
    slots = -(-words * blocks // size)
    return slots, words - (slots - 1) * size // blocks


def draw_counts(wanted: Sequence[int], shards: int, seed: int) -> np.ndarray:
    """Slots per (shard, source): multinomial draws, then settled so that each source gets ``wanted``.

    A plain multinomial misses the totals by about their square root; the surplus of some
    sources is swapped for the deficit of others, evenly over the shards, and shard lengths
    stay as they are.
    """
    wanted_now = np.asarray(wanted, dtype=np.int64)
    total = int(wanted_now.sum())
    if not total:
        return np.zeros((shards, len(wanted_now)), dtype=np.int64)
    lengths = np.full(shards, total // shards, dtype=np.int64)
    lengths[: total % shards] += 1
    drawn = np.stack(
        [np.random.default_rng([seed, i]).multinomial(int(n), wanted_now / total) for i, n in enumerate(lengths)]
    ).astype(np.int64)
    while (off := drawn.sum(axis=0) - wanted_now).any():
        for i in range(shards):
            excess = np.maximum(off, 0)
            give = np.minimum(drawn[i], -(-excess // (shards - i)))
            need, lack = int(give.sum()), np.maximum(-off, 0)
            ends = np.cumsum(lack)
            take = np.minimum(ends, need) - np.minimum(ends - lack, need)
            drawn[i] += take - give
            off = off + take - give
    return drawn


def permuted(k: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Pseudorandom permutation of range(n) applied to k, elementwise: four Feistel rounds, walked into range."""
    half = np.ones(len(k), dtype=np.uint64)
    while ((np.uint64(1) << (half * np.uint64(2))) < n.astype(np.uint64)).any():
        half = half + ((np.uint64(1) << (half * np.uint64(2))) < n.astype(np.uint64)).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = k.astype(np.uint64), np.arange(len(k))
    while len(todo):
        x, h, m, seed = out[todo], half[todo], mask[todo], key[todo].astype(np.uint64)
        left, right = x >> h, x & m
        for turn in range(4):
            mixed = (right + seed + np.uint64(turn)) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= mixed >> np.uint64(32)
            left, right = right, left ^ (mixed & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= n[todo].astype(np.uint64)]
    return out.astype(np.int64)


def _slots(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        for lo in range(0, len(part), 64):
            p = part.iloc[lo : lo + 64]
            count = p["count"].to_numpy()
            which = np.repeat(np.arange(len(p)), count)
            inside = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
            pick = lambda c, p=p, which=which: p[c].to_numpy()[which]
            k, n = pick("first") + inside, pick("blocks")
            epoch = k // n
            last = k == pick("wanted") - 1
            yield pd.DataFrame(
                {
                    "source_no": pick("source_no"), "shard": pick("shard"), "slot": pick("place") + inside,
                    "block": permuted(k % n, n, pick("seed") + epoch), "epoch": epoch.astype("int32"),
                    "upto": np.where(last, pick("rest"), pick("length")),
                }
            )


class Mix:
    """A drawn mix: ``sources`` (one row each), ``docs`` (places of documents), ``spans`` (words taken)."""

    def __init__(self, sources: DataFrame, places: DataFrame, slots: DataFrame | None, spans: DataFrame | None):
        self.sources, self.places, self.slots, self.spans = sources, places, slots, spans


def _key(*cols: str) -> Column:
    """Two longs that tell rows apart by id, text and source, nulls included."""
    parts = [p for c in cols for p in (F.col(c).cast("string"), F.col(c).isNull())]
    return F.struct(F.xxhash64(F.lit(1), *parts).alias("a"), F.xxhash64(F.lit(2), *parts).alias("b"))


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    most: float = 2.0,
    block: int = 128,
    shards: int = 64,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> Mix:
    """Draw a mix of whole ``docs``.

    Sources in code point order, null last, take ``weights`` in turn. Rows are told apart by
    a hash of id, text and source; equal rows are interchangeable, each with its own place.
    Null and empty texts have no words and are never taken. A document longer than a block
    spans several. ``slots``: (source_no, shard, slot, block, epoch, upto), the order of the
    mix, with the words taken from the block's begin (at least its length: all of it);
    ``spans``: (key, nth, size, epoch, from_word, words) of each block's part of each document.
    Each block is taken at most ``most`` times (rounded down), so no document is taken more
    often. Reruns with one seed agree. An empty table gives empty tables.
    """
    spark = docs.sparkSession
    key = _key(id_col, text_col, source_col)
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), key.alias("key"),
        word_count(F.col(text_col)).alias("size"),
    )
    rows = materialize(rows, "sizes")
    found = rows.groupBy("source").agg(F.sum("size").alias("source_size")).collect()
    order = sorted(found, key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    sizes = [int(r["source_size"]) for r in order]
    targets = fill_targets(sizes, [weights[i % len(weights)] for i in range(len(order))], share, most) if order else []
    blocks = [-(-z // block) for z in sizes]
    wanted = [slots_wanted(z, t, n, most) for z, t, n in zip(sizes, targets, blocks, strict=True)]
    table = [(i, r["source"], z, t, n) for i, (r, z, t, n) in enumerate(zip(order, sizes, targets, blocks, strict=True))]
    sources = spark.createDataFrame(table, "source_no int, source string, source_size long, target double, blocks long")

    # places: running word counts inside each source, through hash buckets so that none is a hot key
    wide = 16 * bucket_target(spark)
    rows = rows.join(F.broadcast(sources.select("source_no", "source")), rows["source"].eqNullSafe(sources["source"])).select(
        "id", "key", "size", "source_no", F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(wide)).alias("bucket")
    )
    rows = materialize(rows, "places")
    sums = rows.groupBy("source_no", "bucket").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("source_no", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("source_no", "bucket").orderBy("key", "id", "size")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    places = rows.withColumn("in", F.sum("size").over(upto) - F.col("size"))
    places = places.withColumn("nth", F.row_number().over(inside)).join(starts, ["source_no", "bucket"])
    places = materialize(
        places.select("id", "key", "nth", "size", "source_no", (F.col("in") + F.col("start")).alias("begin")), "begins"
    )

    drawn = draw_counts([w for w, _ in wanted], shards, seed) if order else np.zeros((0, 0), dtype=np.int64)
    firsts = np.cumsum(drawn, axis=0) - drawn if order else drawn
    within = np.cumsum(drawn, axis=1) - drawn if order else drawn
    lots = [
        (s, i, int(firsts[i, s]), int(within[i, s]), int(drawn[i, s]), blocks[s], (seed * 1_000_003 + s * 7919) % (1 << 40),
         *wanted[s], block)
        for i in range(drawn.shape[0])
        for s in range(drawn.shape[1])
        if drawn[i, s]
    ]
    lots = spark.createDataFrame(
        lots, "source_no int, shard int, first long, place long, lot long, blocks long, seed long, wanted long, rest long, length long"
    )
    chunks = lots.withColumn("c", F.explode(F.sequence(F.lit(0), ((F.col("lot") - 1) / CHUNK).cast("long"))))
    at = F.col("c") * CHUNK
    chunks = chunks.select(
        "source_no", "shard", (F.col("first") + at).alias("first"), (F.col("place") + at).alias("place"),
        F.least(F.lit(CHUNK).cast("long"), F.col("lot") - at).alias("count"), "blocks", "seed", "wanted", "rest", "length",
    )
    slots = chunks.repartition(bucket_target(spark)).mapInPandas(
        _slots, "source_no int, shard int, slot long, block long, epoch int, upto long"
    )
    slots = materialize(slots, "slots")

    # the first ``longer`` blocks of a source hold ``least`` + 1 words, the others ``least``
    cuts = sources.where(F.col("blocks") > 0).select(
        "source_no", F.expr("source_size div blocks").alias("least"), (F.col("source_size") % F.col("blocks")).alias("longer")
    )
    held = places.where(F.col("size") > 0).join(F.broadcast(cuts), "source_no")
    edge = F.col("longer") * (F.col("least") + 1)

    def block_of(word: Column) -> Column:
        late = F.col("longer") + F.floor((word - edge) / F.col("least"))
        return F.when(word < edge, F.floor(word / (F.col("least") + 1))).otherwise(late)

    def begin_of(at: Column) -> Column:
        return at * F.col("least") + F.least(at, F.col("longer"))

    end = F.col("begin") + F.col("size")
    held = held.withColumn("block", F.explode(F.sequence(block_of(F.col("begin")), block_of(end - 1))))
    head = begin_of(F.col("block"))
    low, high = F.greatest(head, F.col("begin")), F.least(begin_of(F.col("block") + 1), end)
    held = held.select(
        "id", "key", "nth", "size", "source_no", "block", (low - F.col("begin")).alias("from_word"), (high - low).alias("words"),
        (low - head).alias("inside"),
    )
    spans = slots.select("source_no", "block", "epoch", "upto").join(held, ["source_no", "block"])
    spans = spans.where(F.col("upto") > F.col("inside"))
    spans = spans.withColumn("words", F.least(F.col("words"), F.col("upto") - F.col("inside"))).drop("upto", "inside")
    return Mix(sources, places, slots, spans)


def taken_words(mix: Mix) -> DataFrame:
    """One row per document: id, size, source_size, target, taken (words, repeats counted)."""
    got = mix.spans.groupBy("source_no", "key", "id", "nth").agg(F.sum("words").alias("taken"))
    got = got.select("source_no", "key", F.col("id").alias("got_id"), "nth", "taken")
    places = mix.places.alias("p").join(
        got.alias("g"),
        (F.col("p.key") == F.col("g.key")) & (F.col("p.source_no") == F.col("g.source_no"))
        & (F.col("p.nth") == F.col("g.nth")) & F.col("p.id").eqNullSafe(F.col("g.got_id")),
        "left",
    )
    return places.join(F.broadcast(mix.sources), F.col("p.source_no") == mix.sources["source_no"]).select(
        F.col("p.id").alias("id"), F.col("p.size").alias("size"), "source_size", "target",
        F.coalesce("g.taken", F.lit(0)).cast("long").alias("taken"),
    )


def mixed_documents(docs: DataFrame, mix: Mix, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix as documents: per epoch, each taken document with the words taken from it.

    Neighbouring blocks of one document become one run of words again; a document taken
    whole keeps its text as it is. Otherwise the runs are cut out of the text and put one
    per line. Of rows equal in id, text and source one lends its other columns to all.
    """
    runs = mix.spans.groupBy("key", "nth", "epoch").agg(
        F.max("size").alias("size"), F.sort_array(F.collect_list(F.struct("from_word", "words"))).alias("runs")
    )
    name = {c: scratch_name(docs, c) for c in ("_key", "_takes")}
    takes = runs.groupBy(F.col("key").alias(name["_key"])).agg(
        F.collect_list(F.struct("epoch", "nth", "size", "runs")).alias(name["_takes"])
    )
    key = _key(id_col, text_col, source_col)
    once = docs.withColumn(name["_key"], key).dropDuplicates([name["_key"]])
    joined = once.join(takes, name["_key"])
    pieces = _cut(F.col(text_col), F.col(name["_takes"]))
    rest = [c for c in docs.columns if c != text_col]
    return joined.select(*rest, F.explode(pieces).alias(text_col)).select(*docs.columns)


WORDS = re.compile(WORD)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _cut(text: pd.Series, takes: pd.Series) -> pd.Series:
    out = []
    for body, many in zip(text, takes, strict=True):
        at: list[tuple[int, int]] = []
        made = []
        for take in sorted(many, key=lambda t: (t["epoch"], t["nth"])):
            runs: list[list[int]] = []
            for r in take["runs"]:
                if runs and runs[-1][1] == r["from_word"]:
                    runs[-1][1] += r["words"]
                else:
                    runs.append([r["from_word"], r["from_word"] + r["words"]])
            if runs == [[0, take["size"]]]:
                made.append(body)
                continue
            at = at or [m.span() for m in WORDS.finditer(body)]
            made.append("\n".join(body[at[a][0] : at[b - 1][1]] for a, b in runs))
        out.append(made)
    return pd.Series(out)
