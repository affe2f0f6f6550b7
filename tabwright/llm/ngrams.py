"""N-gram Jaccard join with Bayesian candidate pruning.

Documents of equal shingle sets form a class. Classes that agree on a band of MinHash
values meet in a bucket; there values are compared a few at a time, and a pair is dropped
as soon as the posterior probability that its similarity reaches the threshold falls below
a tolerance. Surviving pairs only leave as links of each class to the smallest class of its
bucket component, so their number stays linear. Exact similarity is then computed inside
the resulting clusters, from the shingle sets themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import components, join_spread, row_key, whole_groups
from tabwright.session import bucket_target, materialize

WORDS = 5
THRESHOLD = (4, 5)
PERMUTATIONS, BAND = 128, 4
CHECKS = (16, 32, 64, 96, 128)
BLOCK = 1024
TILE = 512
WHITE = (9, 10, 11, 12, 13, 32)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """64-bit hashes of words and shingles of whole texts, and their MinHash values."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(1, 1 << 63, 256, dtype=np.uint64)
        self.table[list(WHITE)] = 0
        self.white = np.zeros(256, bool)
        self.white[list(WHITE)] = True
        self.up = self.down = np.ones(1, np.uint64)
        self.a = (rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
        self.b = rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            size = max(1 << 16, 2 * n)
            for name, step in (("up", self.BASE), ("down", pow(self.BASE, -1, 1 << 64))):
                powers = np.full(size, step, np.uint64)
                powers[0] = 1
                setattr(self, name, np.multiply.accumulate(powers))

    def words(self, text: str | None) -> np.ndarray:
        """Hash per word; words are runs without ASCII white space."""
        raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
        if not len(raw):
            return np.zeros(0, np.uint64)
        edge = np.diff(np.concatenate([[True], self.white[raw], [True]]).astype(np.int8))
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        self._powers(len(raw) + 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.table[raw] * self.up[: len(raw)])])
        return mix((total[ends] - total[starts]) * self.down[starts])

    def shingles(self, text: str | None, words: int = WORDS) -> np.ndarray:
        """Sorted distinct hashes of word runs; a shorter text is one shingle, an empty one none."""
        w = self.words(text)
        if not len(w):
            return w
        size = min(words, len(w))
        total = np.full(len(w) - size + 1, size, np.uint64)
        for i in range(size):
            total = total * np.uint64(self.BASE) + w[i : len(w) - size + 1 + i]
        return np.unique(mix(total))

    def minhash(self, shingles: np.ndarray) -> np.ndarray:
        """PERMUTATIONS minima, 32 bits each."""
        out = np.full(PERMUTATIONS, np.iinfo(np.uint32).max, np.uint32)
        for lo in range(0, len(shingles), 4096):
            part = shingles[None, lo : lo + 4096] * self.a[:, None] + self.b[:, None]
            out = np.minimum(out, (part >> np.uint64(32)).min(axis=1).astype(np.uint32))
        return out

    def sketch(self, text: str | None) -> tuple[int, int, int, bytes, list[int]]:
        """(set hash 1, set hash 2, size, one byte per MinHash value, key per band)."""
        s = self.shingles(text)
        if not len(s):
            return 0, 0, 0, b"", []
        values = self.minhash(s)
        bands = np.zeros(PERMUTATIONS // BAND, np.uint64)
        for column in values.reshape(-1, BAND).T.astype(np.uint64):
            bands = mix(bands * np.uint64(self.BASE) + column + np.uint64(1))
        bands = mix(bands + np.arange(len(bands), dtype=np.uint64))
        one, two = np.add.reduce(mix(s)), np.add.reduce(mix(s ^ np.uint64(self.BASE)))
        signed = lambda x: int(np.uint64(x).astype(np.int64))
        return signed(one), signed(two), len(s), (values & 255).astype(np.uint8).tobytes(), bands.astype(np.int64).tolist()


def least_matches(tolerance: float, threshold: float) -> list[int]:
    """For each of CHECKS compared values: the fewest matches with which a pair is kept.

    Values are one byte, so they match with probability r = s + (1 - s) / 256 at similarity
    s. With s uniform beforehand, a pair is kept while P(s >= threshold | matches) is at
    least ``tolerance``.
    """
    s = (np.arange(20_000) + 0.5) / 20_000
    log_r, log_not = np.log(s + (1 - s) / 256), np.log1p(-(s + (1 - s) / 256))
    high = s >= threshold
    out = []
    for n in CHECKS:
        for m in range(n + 1):
            weight = m * log_r + (n - m) * log_not
            weight = np.exp(weight - weight.max())
            if weight[high].sum() >= tolerance * weight.sum():
                out.append(m)
                break
    return out


def _similar(one: np.ndarray, n_one: int, many: np.ndarray, n_many: np.ndarray, least: list[int], ratio: float) -> np.ndarray:
    """Rows of ``many`` that stay possible partners of ``one``; values are compared step by step."""
    rows = np.flatnonzero((np.minimum(n_many, n_one) >= ratio * np.maximum(n_many, n_one)))
    matches, done = np.zeros(len(rows), np.int64), 0
    for upto, need in zip(CHECKS, least, strict=True):
        matches = matches + (many[rows, done:upto] == one[done:upto]).sum(axis=1)
        keep = matches >= need
        rows, matches, done = rows[keep], matches[keep], upto
        if not len(rows):
            break
    return rows


def _stars(nodes: np.ndarray, sizes: np.ndarray, values: np.ndarray, least: list[int], ratio: float) -> list[tuple[int, int]]:
    """(node, smallest node of its component) for the possible pairs of one bucket.

    Search from node to node: each is compared with those not reached yet, so a dense
    bucket costs little more than its size.
    """
    out, left = [], np.arange(len(nodes))
    while len(left):
        todo, group = [left[0]], [left[0]]
        left = left[1:]
        while todo and len(left):
            at = todo.pop()
            hit = _similar(values[at], sizes[at], values[left], sizes[left], least, ratio)
            if len(hit):
                todo += left[hit].tolist()
                group += left[hit].tolist()
                left = np.delete(left, hit)
        if len(group) > 1:
            root = int(nodes[group].min())
            out += [(int(nodes[g]), root) for g in group]
    return out


def _bucket_links(least: list[int], ratio: float):
    def link(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, borders in whole_groups(parts, ["bucket", "t"]):
            nodes, sizes = frame["node"].to_numpy(), frame["n"].to_numpy()
            values = np.frombuffer(b"".join(frame["sketch"]), np.uint8).reshape(len(frame), -1)
            out = []
            width = np.diff(borders)
            # most buckets hold two: all of these at once
            first = borders[:-1][width == 2]
            a, b = values[first], values[first + 1]
            fine = np.minimum(sizes[first], sizes[first + 1]) >= ratio * np.maximum(sizes[first], sizes[first + 1])
            for upto, need in zip(CHECKS, least, strict=True):
                fine &= (a[:, :upto] == b[:, :upto]).sum(axis=1) >= need
            first = first[fine]
            low = np.minimum(nodes[first], nodes[first + 1])
            high = np.maximum(nodes[first], nodes[first + 1])
            for lo, hi in zip(borders[:-1][width > 2], borders[1:][width > 2], strict=True):
                out += _stars(nodes[lo:hi], sizes[lo:hi], values[lo:hi], least, ratio)
            more = np.array(out, np.int64).reshape(-1, 2)
            yield pd.DataFrame({"u": np.concatenate([high, more[:, 0]]), "v": np.concatenate([low, more[:, 1]])})

    return link


def _exact(sets: list[np.ndarray], threshold: tuple[int, int]) -> np.ndarray:
    """Which pairs of shingle sets reach the similarity, as a square matrix."""
    top, bottom = threshold
    sizes = np.array([len(s) for s in sets], np.int64)
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, code, times = np.unique(every, return_inverse=True, return_counts=True)
    # shingles of one set only meet nothing
    shared = times > 1
    number = np.cumsum(shared) - 1
    keep = shared[code]
    code, owner = number[code[keep]], owner[keep]
    common = np.zeros((len(sets), len(sets)), np.float32)
    width = 8192
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    for lo in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(code, [lo, lo + width])
        there = np.zeros((len(sets), width), np.float32)
        there[owner[a:b], code[a:b] - lo] = 1
        common += there @ there.T
    both = common.astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - both
    return (bottom * both >= top * union) & (both > 0)


def _verify(threshold: tuple[int, int]):
    def check(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, borders in whole_groups(parts, ["cluster", "t"]):
            out: list[tuple[int, int, int]] = []
            for lo, hi in zip(borders[:-1], borders[1:], strict=True):
                g = frame.iloc[lo:hi].drop_duplicates("node")
                nodes, weight, block = g["node"].to_numpy(), g["docs"].to_numpy(), g["block"].to_numpy()
                if len(g) < 2:
                    continue
                linked = _exact([np.frombuffer(x, np.uint64) for x in g["shingles"]], threshold)
                np.fill_diagonal(linked, False)
                # reached within this tile, also through pairs counted elsewhere
                root = np.arange(len(g))
                while True:
                    reach = np.where(linked, root[None, :], len(g)).min(axis=1)
                    now = np.minimum(root, reach)
                    now = now[now]
                    if (now == root).all():
                        break
                    root = now
                if block.min() != block.max():
                    linked &= block[:, None] != block[None, :]
                links = (linked * weight[None, :]).sum(axis=1)
                out += list(zip(nodes.tolist(), nodes[root].tolist(), links.tolist(), strict=True))
            made = np.array(out, np.int64).reshape(-1, 3)
            made = made[(made[:, 0] != made[:, 1]) | (made[:, 2] > 0)]
            yield pd.DataFrame({"u": made[:, 0], "v": made[:, 1], "links": made[:, 2]})

    return check


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: tuple[int, int] = THRESHOLD,
    tolerance: float = 1e-6, with_key: bool = False,
) -> DataFrame:
    """(id, class_id, copy_of, n_links) per row of ``docs``: groups linked by Jaccard similarity.

    Shingles are runs of five words of the whole text; a text of one to four words is a
    single shingle. Two documents are linked if their shingle sets reach ``threshold``
    (numerator, denominator). ``copy_of`` is the smallest id with the same set, ``class_id``
    the smallest id of all documents linked directly or through others, ``n_links`` the
    number of other documents linked directly, copies included. Null, empty and blank texts
    have no shingles: never linked, each is its own class (equal rows share one). A null id
    counts as larger than any other; ids may repeat. An empty table gives no rows. Rows of
    ``docs`` are told apart by a hash of id and text, returned as ``key`` if asked for.

    Pairs at the threshold miss every common band with probability 5e-8, and are dropped by
    the posterior with about ``tolerance``; all that remain are verified exactly.
    """
    spark = docs.sparkSession
    ratio = threshold[0] / threshold[1]
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), row_key(id_col, text_col).alias("key"))

    def sketches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher()
        for part in parts:
            made = [hasher.sketch(t) for t in part.pop("text")]
            for i, name in enumerate(("s1", "s2", "n", "sketch", "bands")):
                part[name] = [m[i] for m in made]
            yield part

    kind = docs.schema[id_col].dataType.simpleString()
    flat = base.select("id", F.col("key.a").alias("a"), F.col("key.b").alias("b"), "text")
    rows = flat.mapInPandas(
        sketches, f"id {kind}, a long, b long, s1 long, s2 long, n long, sketch binary, bands array<long>"
    )
    none = F.col("n") == 0
    rows = rows.withColumn("s1", F.when(none, F.col("a")).otherwise(F.col("s1")))
    rows = materialize(rows.withColumn("s2", F.when(none, F.col("b")).otherwise(F.col("s2"))), "sketches")

    # one row per class of equal sets; its first row (by id, nulls last) stands for it
    place = F.struct(F.col("id").isNull().alias("last"), "id", "a", "b")
    classes = rows.groupBy("s1", "s2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("docs"), F.max("n").alias("n"))
    classes = materialize(classes.select("s1", "s2", F.col("first.*"), "docs", "n"), "classes")
    chosen = rows.where(~none).select("a", "b", "s1", "s2", "n", "sketch", "bands").join(
        classes.select("a", "b", "s1", "s2"), ["a", "b", "s1", "s2"], "left_semi"
    ).dropDuplicates(["s1", "s2"])
    chosen = materialize(chosen.select(F.col("s1").alias("node"), "n", "sketch", "bands"), "chosen")

    # buckets with company; large ones are cut into blocks, and pairs of blocks meet in tiles
    keys = chosen.select("node", F.explode("bands").alias("bucket"))
    counts = keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > 1)
    counts = materialize(counts.withColumn("blocks", F.ceil(F.col("c") / BLOCK).cast("int")), "buckets")
    keys = materialize(keys, "bands")
    met = join_spread(keys, counts, ["bucket"], "c").select("node", "bucket", "blocks")
    met = _tiled(met, "bucket").join(chosen.select("node", "n", "sketch"), "node")
    met = met.select("bucket", "t", "node", "n", "sketch").repartition(bucket_target(spark), "bucket", "t")
    least = least_matches(tolerance, ratio)
    stars = met.sortWithinPartitions("bucket", "t").mapInPandas(_bucket_links(least, ratio), "u long, v long")
    clusters = materialize(components(stars, "candidates").withColumnRenamed("root", "cluster"), "clusters")

    # exact similarity inside clusters
    sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("c"))
    sizes = materialize(sizes.withColumn("blocks", F.ceil(F.col("c") / TILE).cast("int")), "cluster_sizes")
    members = join_spread(clusters, sizes, ["cluster"], "c").select("node", "cluster", "blocks")
    members = members.join(classes.where(F.col("n") > 0).select(F.col("s1").alias("node"), "a", "b", "docs"), "node")
    texts = flat.select("a", "b", "text").join(members, ["a", "b"]).select("node", "cluster", "blocks", "docs", "text")

    def shingled(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher()
        for part in parts:
            part["shingles"] = [hasher.shingles(t).tobytes() for t in part.pop("text")]
            yield part

    sets = texts.mapInPandas(shingled, "node long, cluster long, blocks int, docs long, shingles binary")
    tiles = _tiled(sets, "cluster").select("cluster", "t", "node", "docs", "block", "shingles")
    tiles = tiles.repartition(bucket_target(spark), "cluster", "t").sortWithinPartitions("cluster", "t")
    links = materialize(tiles.mapInPandas(_verify(threshold), "u long, v long, links long"), "links")
    groups = components(links.select("u", "v"), "groups")
    counted = links.groupBy("u").agg(F.sum("links").alias("links")).select(F.col("u").alias("node"), "links")

    named = classes.withColumn("node", F.col("s1")).join(groups, "node", "left").join(counted, "node", "left")
    named = named.withColumn("root", F.when(F.col("n") == 0, None).otherwise(F.col("root")))
    named = materialize(named.withColumn("links", F.coalesce("links", F.lit(0)) + F.when(F.col("n") == 0, 0).otherwise(F.col("docs") - 1)), "named")
    place = F.struct("last", "id", "a", "b")
    tops = named.where(F.col("root").isNotNull()).groupBy("root").agg(F.min(place).alias("top"), F.count(F.lit(1)).alias("c"))
    tops = materialize(tops, "tops")
    grouped = join_spread(named.where(F.col("root").isNotNull()), tops, ["root"], "c").select("s1", "s2", "id", "links", "docs", "top")
    alone = named.where(F.col("root").isNull()).select("s1", "s2", "id", "links", "docs", place.alias("top"))
    answers = materialize(grouped.unionByName(alone).withColumnRenamed("id", "copy_of"), "answers")
    out = join_spread(rows.select("id", "a", "b", "s1", "s2"), answers, ["s1", "s2"], "docs")
    found = ["id", F.col("top.id").alias("class_id"), "copy_of", F.col("links").cast("long").alias("n_links")]
    if with_key:
        found += [F.struct("a", "b").alias("key"), F.struct("top.a", "top.b").alias("class_key")]
    return out.select(*found)


def _tiled(rows: DataFrame, key: str) -> DataFrame:
    """Each row once per tile: blocks i <= j of its group meet in tile (i, j)."""
    block = F.pmod(F.xxhash64("node", F.lit(9)), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pair = rows.withColumn("block", block).withColumn("other", other)
    number = F.least("block", "other").cast("long") * F.col("blocks") + F.greatest("block", "other")
    return pair.withColumn("t", number).drop("other", "blocks")
