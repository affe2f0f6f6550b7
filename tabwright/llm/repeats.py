"""Repeated byte strings across a corpus, by prefix-free parsing.

A rolling hash over every text marks triggers: the smallest hash in a window of the wanted
length. Triggers depend on content only, so equal windows hold the same trigger at the same
place, and the windows around one trigger form a phrase (a run of window starts). Phrases go
into a dictionary by their hash; the corpus becomes a parse, a list of dictionary entries.
What occurs twice in the dictionary is settled at once; only phrases that share a trigger
string with a different phrase are looked at more closely, in blocks and then in single
windows, through names (128-bit hashes) of their contents.

The names stand in for ranks of suffix arrays of dictionary and parse: the question is
which strings of a fixed length are equal, not which is smaller, and equality is settled by
grouped counts that never need one trigger's occurrences in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import join_spread, row_key
from tabwright.session import materialize

GRAM = 32
STEP = 32
CHUNK = 1 << 22


class Parser:
    """Triggers and phrases of one text."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, length: int, seed: int = 3):
        self.length = length
        self.gram = min(GRAM, length)
        self.table = np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64)
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            size = max(1 << 16, 2 * n)
            for name, step in (("up", self.BASE), ("down", pow(self.BASE, -1, 1 << 64))):
                powers = np.full(size, step, np.uint64)
                powers[0] = 1
                setattr(self, name, np.multiply.accumulate(powers))

    def _grams(self, raw: np.ndarray) -> np.ndarray:
        """Hash of every gram: differences of a running sum, then mixed."""
        self._powers(len(raw) + 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.table[raw] * self.up[: len(raw)])])
        x = (total[self.gram :] - total[: -self.gram]) * self.down[: len(raw) - self.gram + 1]
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(27))

    def phrases(self, data: bytes) -> tuple[np.ndarray, ...]:
        """(trigger position, least and largest distance to a window start, trigger hash) per phrase.

        Windows [position - distance, + length) cover every window of the text exactly once.
        """
        windows = len(data) - self.length + 1
        found = [
            self._part(np.frombuffer(data, np.uint8, min(CHUNK, windows - lo) + self.length - 1, lo), lo)
            for lo in range(0, windows, CHUNK)
        ]
        if not found:
            return tuple(np.zeros(0, np.int64) for _ in range(4))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def _part(self, raw: np.ndarray, base: int) -> tuple[np.ndarray, ...]:
        grams = self._grams(raw)
        spot = np.uint64((1 << 24) - 1)
        least = (grams & ~spot) | np.arange(len(grams), dtype=np.uint64)
        span, width = self.length - self.gram + 1, 1
        while 2 * width <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = span - width
        if rest:
            least = np.minimum(least[:-rest], least[rest:])
        at = (least & spot).astype(np.int64)
        cut = np.flatnonzero(at[1:] != at[:-1]) + 1
        starts, ends = np.concatenate([[0], cut]), np.concatenate([cut, [len(at)]]) - 1
        where = at[starts]
        return where + base, where - ends, where - starts, grams[where].astype(np.int64)


def _name(data: memoryview, seed: int) -> bytes:
    return xxhash.xxh3_128_digest(data, seed=seed)


def _longs(names: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(names), "<i8").reshape(-1, 2)


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _parse(length: int):
    def parse(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parser = Parser(length)
        for part in parts:
            columns: list[list] = [[] for _ in range(7)]
            names: list[bytes] = []
            for a, b, text in zip(part["a"], part["b"], part["text"], strict=True):
                data = _bytes(text)
                if len(data) < length:
                    continue
                pos, lo, hi, gram = parser.phrases(data)
                view = memoryview(data)
                names += [
                    _name(view[p - h : p - x + length], h << 16 | x)
                    for p, x, h in zip(pos.tolist(), lo.tolist(), hi.tolist(), strict=True)
                ]
                for c, x in zip(columns, (np.full(len(pos), a), np.full(len(pos), b), pos, lo, hi, gram), strict=False):
                    c.append(x)
            if names:
                two = _longs(names)
                made = [np.concatenate(c) for c in columns[:6]] + [two[:, 0], two[:, 1]]
                yield pd.DataFrame(dict(zip(("a", "b", "pos", "lo", "hi", "g", "u1", "u2"), made, strict=True)))

    return parse


def _spans(length: int):
    """Bytes under the windows of the phrases asked for."""

    def take(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for a, b, text, runs in zip(part["a"], part["b"], part["text"], part["runs"], strict=True):
                data = _bytes(text)
                out += [
                    (a, b, r["pos"], r["lo"], r["hi"], r["times"], data[r["pos"] - r["hi"] : r["pos"] - r["lo"] + length])
                    for r in runs
                ]
            yield pd.DataFrame(out, columns=["a", "b", "pos", "lo", "hi", "times", "span"])

    return take


def _blocks(length: int):
    """Blocks of neighbouring windows: name of what all share, name of what they cover."""

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows, cores, unions = [], [], []
            for a, b, pos, lo, hi, times, span in part.itertuples(index=False):
                view, left = memoryview(span), pos - hi
                for k in range(lo // STEP, hi // STEP + 1):
                    first, last = max(lo, k * STEP), min(hi, k * STEP + STEP - 1)
                    core = max(0, pos - k * STEP - left), pos - k * STEP - STEP + 1 + length - left
                    cores.append(_name(view[core[0] : core[1]], k))
                    unions.append(_name(view[pos - last - left : pos - first + length - left], (first << 32) | last))
                    rows.append((a, b, pos, first, last, times))
            made = pd.DataFrame(rows, columns=["a", "b", "pos", "lo", "hi", "times"])
            for name, values in (("c", _longs(cores)), ("u", _longs(unions))):
                made[f"{name}1"], made[f"{name}2"] = values[:, 0], values[:, 1]
            yield made

    return cut


def _windows(length: int):
    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows, names = [], []
            for a, b, pos, hi, span, asked in part[["a", "b", "pos", "hi", "span", "asked"]].itertuples(index=False):
                view = memoryview(span)
                for r in asked:
                    for o in range(r["lo"], r["hi"] + 1):
                        names.append(_name(view[hi - o : hi - o + length], 0))
                        rows.append((a, b, pos - o, r["times"]))
            made = pd.DataFrame(rows, columns=["a", "b", "start", "times"])
            two = _longs(names)
            made["u1"], made["u2"] = two[:, 0], two[:, 1]
            yield made

    return cut


def _settled(rows: DataFrame, name: Sequence[str], wider: Sequence[str], rep: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose name occurs twice, one row per name that shares ``wider`` with another name)."""
    same = rows.groupBy(*dict.fromkeys([*wider, *name])).agg(
        F.min(F.struct(*rep)).alias("rep"), F.sum("times").alias("all"), F.count(F.lit(1)).alias("rows")
    )
    same = materialize(same, "names")
    found = join_spread(rows, same.where(F.col("all") > 1).select(*dict.fromkeys([*wider, *name]), "rows"), list(dict.fromkeys([*wider, *name])), "rows")
    mixed = same.groupBy(*wider).agg(F.count(F.lit(1)).alias("names")).where(F.col("names") > 1)
    rest = join_spread(same, materialize(mixed, "mixed"), list(wider), "names")
    return found, rest.select("rep.*", F.least("all", F.lit(2)).cast("int").alias("times"))


def repeated_spans(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(a, b, from, to): byte ranges covered by strings of ``length`` bytes that start in two places.

    (a, b) is the row key of id and text. Ranges may overlap; their union is exact.
    """
    texts = docs.select(F.col(text_col).alias("text"), row_key(id_col, text_col).alias("key")).select("key.a", "key.b", "text")
    kind = "a long, b long, pos long, lo int, hi int"
    runs = materialize(texts.mapInPandas(_parse(length), f"{kind}, g long, u1 long, u2 long"), "phrases")
    shared = runs.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    runs = join_spread(runs, materialize(shared, "triggers"), ["g"], "n").drop("n").withColumn("times", F.lit(1))
    runs = materialize(runs, "shared")
    run = ["a", "b", "pos", "lo", "hi"]
    covered, rest = _settled(runs, ["u1", "u2"], ["g"], run)
    covered = materialize(covered.select("a", "b", (F.col("pos") - F.col("hi")).alias("from"), (F.col("pos") - F.col("lo") + length).alias("to")), "covered")

    asked = rest.groupBy("a", "b").agg(F.collect_list(F.struct("pos", "lo", "hi", "times")).alias("runs"))
    # equal rows are one text from here on; the join has already put them side by side
    asked = texts.join(asked, ["a", "b"]).dropDuplicates(["a", "b"])
    spans = materialize(asked.mapInPandas(_spans(length), f"{kind}, times int, span binary"), "spans")
    blocks = spans.mapInPandas(_blocks(length), f"{kind}, times int, c1 long, c2 long, u1 long, u2 long")
    blocks = materialize(blocks, "blocks")
    found, rest = _settled(blocks, ["u1", "u2"], ["c1", "c2"], run)
    covered_blocks = found.select("a", "b", (F.col("pos") - F.col("hi")).alias("from"), (F.col("pos") - F.col("lo") + length).alias("to"))

    near = rest.groupBy("a", "b", "pos").agg(F.collect_list(F.struct("lo", "hi", "times")).alias("asked"))
    windows = spans.withColumnRenamed("times", "all").join(near, ["a", "b", "pos"]).mapInPandas(
        _windows(length), "a long, b long, start long, times int, u1 long, u2 long"
    )
    windows = materialize(windows, "windows")
    twice = windows.groupBy("u1", "u2").agg(F.sum("times").alias("all"), F.count(F.lit(1)).alias("rows")).where(F.col("all") > 1)
    twice = materialize(twice, "twice")
    single = join_spread(windows, twice, ["u1", "u2"], "rows")
    single = single.select("a", "b", F.col("start").alias("from"), (F.col("start") + length).alias("to"))
    return covered.unionByName(covered_blocks).unionByName(single)


def _kept(keep: str | None):
    """Removes the ranges from the texts, some hundred rows at a time."""

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in parts:
            for at in range(0, len(whole), 500):
                part = whole.iloc[at : at + 500].copy()
                removed, spans, digests, texts = [], [], [], []
                for text, ranges in zip(part.pop("text"), part.pop("ranges"), strict=True):
                    data = _bytes(text)
                    gone: list[list[int]] = []
                    for lo, hi in sorted((r["from"], r["to"]) for r in ranges) if ranges is not None else ():
                        if gone and lo <= gone[-1][1]:
                            gone[-1][1] = max(gone[-1][1], hi)
                        else:
                            gone.append([lo, hi])
                    edges = [0, *[x for g in gone for x in g], len(data)]
                    kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                    removed.append(len(data) - len(kept))
                    spans.append(len(gone))
                    digests.append(hashlib.sha256(kept).hexdigest())
                    texts.append(kept.decode("utf-8", "ignore") if keep == "text" else kept)
                made = part.assign(n_removed=removed, n_spans=spans, kept_sha256=digests)
                yield made.assign(**{keep: texts}) if keep else made

    return cut


def remove_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", keep: str | None = None) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256[, kept or text]) per row: texts without repeated strings.

    Texts are whole UTF-8 texts (null: empty). Every byte goes that a string of ``length``
    bytes covers which also starts anywhere else, in the same text too; overlaps count, and
    strings never cross texts. Rows that repeat id and text are texts of their own, so each
    repeats the other. Texts shorter than ``length`` stay. With ``keep``
    "kept" the bytes left are returned, with "text" the whole characters among them. An
    empty table gives no rows; other columns are not needed and not returned.
    """
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), row_key(id_col, text_col).alias("key"))
    ranges = repeated_spans(docs, length, id_col, text_col)
    # a phrase found twice in one row (equal rows) is one range
    ranges = ranges.groupBy("a", "b").agg(F.collect_set(F.struct("from", "to")).alias("ranges"))
    base = base.select("id", "key.a", "key.b", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    kind = docs.schema[id_col].dataType.simpleString()
    last = {None: "", "kept": ", kept binary", "text": ", text string"}[keep]
    schema = f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string{last}"
    whole = base.join(ranges, ["a", "b"], "left").select("id", "text", "n_bytes", "ranges")
    return whole.mapInPandas(_kept(keep), schema)
